"""Partial states of part files, kept and merged.

A trace grows by part files.  Each file gets its own states, once: the counted
(key, value) pairs, which merge to exact row and distinct counts, and a sketch of the
values per key, which merges to approximate distinct counts at a few kB a key.
Any set of files is then answered from states, and a later run reads new files only.

Layout below ``folder``: ``pairs/`` and ``sketches/``, one sub-folder a run, and
``files/``, the register of (file, length, modified, run).  The register is written
last, by one job of one file; states that it does not name do not count, so a run that dies
leaves nothing behind that is read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracelens.sources.published import Folder

_FILES = "file string, length long, modified timestamp, run string, at timestamp"


def _present(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, length, modified) of the files at ``path``; their content is not read."""
    return spark.read.format("binaryFile").load(path).select(
        F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified"))


def _register(spark: SparkSession, folder: str) -> DataFrame:
    """The newest entry of each file."""
    if not any(n.startswith("part-") for n in Folder(spark, f"{folder}/files").names()):
        return spark.createDataFrame([], _FILES)
    newest = Window.partitionBy("file").orderBy(F.col("at").desc(), "run")
    return spark.read.schema(_FILES).parquet(f"{folder}/files").withColumn("_n", F.row_number().over(newest)) \
        .where("_n = 1").drop("_n")


def update_states(spark: SparkSession, path: str | list[str], folder: str, read: Callable[[list[str]], DataFrame],
                  key: str, value: str, *, lg_config_k: int = 12) -> list[str]:
    """Add the states of the files at ``path`` that are new, or have changed, since the last run; returns their paths.

    ``read`` makes the table of a list of files (a reader with file metadata: CSV, text, parquet).
    Null keys are a key of their own; null values count as rows, not as values.
    """
    folder = folder.rstrip("/")
    known = _register(spark, folder)
    fresh = _present(spark, path).join(known, ["file", "length", "modified"], "left_anti").orderBy("file").collect()
    if not fresh:
        return []
    run, names = uuid.uuid4().hex, [r["file"] for r in fresh]
    rows = read(names).select(F.col("_metadata.file_path").alias("file"), F.col(key).alias("key"), F.col(value).alias("value"))
    pairs = f"{folder}/pairs/run={run}"
    counted = rows.groupBy("file", "key", "value").agg(F.count(F.lit(1)).alias("n"))
    counted.write.parquet(pairs)
    # The sketch of a file and key is made of its distinct values, so the pairs suffice.
    text = F.col("value").cast("string")
    spark.read.schema(counted.schema).parquet(pairs).groupBy("file", "key").agg(
        F.sum("n").alias("n"), F.hll_sketch_agg(text, F.lit(lg_config_k)).alias("sketch")) \
        .write.parquet(f"{folder}/sketches/run={run}")
    register = spark.createDataFrame([(*r, run) for r in fresh], "file string, length long, modified timestamp, run string")
    register.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{folder}/files")
    return names


def _states(spark: SparkSession, folder: str, kind: str, files: list[str] | None) -> DataFrame:
    folder = folder.rstrip("/")
    named = _register(spark, folder)
    if files is not None:
        named = named.join(spark.createDataFrame([(f,) for f in files], "file string"), "file", "left_semi")
    states = spark.read.option("basePath", f"{folder}/{kind}").parquet(f"{folder}/{kind}")
    return states.join(named.select("file", "run"), ["file", "run"], "left_semi")


def merged_counts(spark: SparkSession, folder: str, files: list[str] | None = None, *, key: str = "key",
                  rows: str = "n_rows", distinct: str = "n_distinct") -> DataFrame:
    """(key, n_rows, n_distinct), exact, of all registered files or the given ones: the same as one pass over them."""
    return _states(spark, folder, "pairs", files).groupBy(F.col("key").alias(key), "value").agg(F.sum("n").alias("n")) \
        .groupBy(key).agg(F.sum("n").alias(rows), F.count("value").alias(distinct))


def merged_sketches(spark: SparkSession, folder: str, files: list[str] | None = None, *, key: str = "key",
                    rows: str = "n_rows", distinct: str = "approx_distinct") -> DataFrame:
    """(key, n_rows, approx_distinct) from the sketches; the row counts are exact."""
    return _states(spark, folder, "sketches", files).groupBy(F.col("key").alias(key)).agg(
        F.sum("n").alias(rows), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(distinct))
