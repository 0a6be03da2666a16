"""Readers for trace tables.

* ``read_trace_table``  header-less CSV with the registry schema (S1, S3)
* ``read_lines_table``  the same files as raw text lines, split naively (S2)
* ``read_parquet_table`` a parquet table below a root folder
* ``sample_rows``        seeded Bernoulli sample (S4, S4b); ``operators.ranks.exact_sample``
                         for one of exact size that does not depend on the layout
* ``hash_sample``        deterministic key sample, reproducible across engines

A path may be a file, a folder of part files or a glob on any Hadoop file
system (object stores included): the reader splits the input into tasks by
``spark.sql.files.maxPartitionBytes``, so a folder of 500 parts is read in
parallel without listing it on the driver beyond Spark's own file index.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tracelens.sources.ledger import read_with_ledger
from tracelens.sources.schemas import schema_of, string_schema


def read_trace_table(
    spark: SparkSession,
    table: str,
    path: str | list[str],
    *,
    sample: float | None = None,
    seed: int = 42,
    typed: bool = True,
    schema: StructType | str | None = None,
) -> DataFrame:
    """Read a header-less CSV trace table with an explicit schema.

    ``schema`` replaces the registry's for files laid out otherwise.

    Short rows are padded with nulls, extra trailing fields are dropped and
    quoted fields may contain commas (Spark's PERMISSIVE CSV parser).  A field
    that does not parse as its column's type is null, without a trace;
    ``ledger.read_with_ledger`` keeps account of such lines.  With
    ``typed=False`` all columns are strings.  Sampling is skipped for a
    fraction of 1 or more, so filters still reach the scan.
    """
    if schema is None:
        schema = schema_of(table) if typed else string_schema(table)
    df = (
        spark.read.schema(schema)
        .option("header", "false")
        .option("sep", ",")
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    return sample_rows(df, sample, seed)


def read_lines_table(
    spark: SparkSession,
    table: str,
    path: str | list[str],
    *,
    sample: float | None = None,
    seed: int = 42,
    typed: bool = True,
    schema: StructType | None = None,
) -> DataFrame:
    """Read trace files as text lines and split each line at every comma.

    ``schema`` replaces the registry's for files laid out otherwise.

    This is the line-oriented reading of the trace: no quoting rules, an
    empty field is missing, a short row yields nulls for the absent fields
    and fields past the schema are ignored.  Values that do not parse as
    the column type become null (``try_cast``) instead of failing the job.
    """
    schema = schema or schema_of(table)
    raw = spark.read.text(path)
    parts = F.split(F.col("value"), ",", -1)
    cols = []
    for i, field in enumerate(schema.fields):
        text = F.get(parts, i)
        text = F.when(text == "", F.lit(None)).otherwise(text)
        if typed and field.dataType.simpleString() != "string":
            text = text.try_cast(field.dataType)
        cols.append(text.alias(field.name))
    return sample_rows(raw.select(*cols), sample, seed)


def read_ingested_table(spark: SparkSession, table: str, path: str | list[str], *,
                        sample: float | None = None, seed: int = 42) -> DataFrame:
    """Read a trace table previously written by ``ingest_trace_table``.

    The registry schema is supplied, so no footer-reading job runs, only
    the columns an analysis uses are read, equality / range filters are
    pushed into the parquet scan and filters on partition columns prune
    folders.  Columns come back in registry order.
    """
    schema = schema_of(table)
    df = spark.read.schema(schema).parquet(path)
    return sample_rows(df.select(*[f.name for f in schema.fields]), sample, seed)


# Fixed choice: ingested tables partitioned by their event code, so the
# analyses' event filters (evictions, submits, leaving PENDING) prune whole
# folders instead of scanning every row group.  Few distinct codes: few folders.
INGEST_PARTITIONS = {"task_events": ["event_type"], "job_events": ["event_type"]}


def ingest_trace_table(spark: SparkSession, table: str, src: str | list[str], dst: str, *,
                       mode: str = "overwrite", compression: str = "zstd",
                       partition_by: list[str] | None = None, quarantine: str | None = None) -> str:
    """Convert a CSV trace table (plain or gzipped) to typed parquet, once.

    Gzipped CSV cannot be split (one task per file) and every scan parses
    every column.  After ingestion each analysis reads only the columns it
    needs from splittable, compressed column chunks, and tables listed in
    ``INGEST_PARTITIONS`` are laid out in one folder per event code, so an
    event filter becomes partition pruning.  Rows of such a table are first
    rebalanced by event code: AQE splits a frequent code and joins rare ones
    by size, so the files of a code grow with its data and not with the number
    of input splits.  Other tables are written by the scanning tasks.

    With ``quarantine`` (a folder) only whole rows are converted, and every malformed line is
    written there with its file and reasons (``read_with_ledger``); without it, short rows
    are padded and values that do not parse are null.
    """
    if quarantine is None:
        df = read_trace_table(spark, table, src)
    else:
        ledger = read_with_ledger(spark, table, src)
        ledger.quarantined.write.mode(mode).parquet(quarantine)
        df = ledger.rows
    parts = INGEST_PARTITIONS.get(table, []) if partition_by is None else partition_by
    if parts:
        df = df.hint("rebalance", *[F.col(c) for c in parts])
    writer = df.write.mode(mode).option("compression", compression)
    if parts:
        writer = writer.partitionBy(*parts)
    writer.parquet(dst)
    return dst


def read_parquet_table(spark: SparkSession, root: str, name: str,
                       schema: str | None = None) -> DataFrame:
    """``{root}/{name}.parquet`` (a file or a folder of parts).

    With a known ``schema`` (DDL string or StructType) Spark skips schema
    inference, which otherwise reads parquet footers in a job of its own.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{root.rstrip('/')}/{name}.parquet")


def sample_rows(df: DataFrame, fraction: float | None, seed: int = 42) -> DataFrame:
    """Seeded sample without replacement; a no-op for ``None`` or >= 1.

    The sample is reproducible for a fixed input partitioning (Spark seeds
    each partition with ``seed + partition index``).
    """
    if fraction is None or fraction >= 1:
        return df
    if fraction <= 0:
        raise ValueError(f"sample fraction must be positive, got {fraction}")
    return df.sample(withReplacement=False, fraction=float(fraction), seed=seed)


def hash_width(fraction: float) -> int:
    """Hex digits (2 at least) whose buckets come within a hundredth of ``fraction``."""
    if not 0 < fraction <= 1:
        raise ValueError(f"fraction must be in (0, 1], got {fraction}")
    width = 2
    while width < 16 and abs(round(fraction * 16 ** width) / 16 ** width - fraction) > fraction / 100:
        width += 1
    return width


def hash_bucket_prefix(fraction: float, width: int = 2) -> str:
    """``width`` hex digits: keys whose md5 starts below this are kept."""
    if not 0 < fraction <= 1:
        raise ValueError(f"fraction must be in (0, 1], got {fraction}")
    buckets = int(round(fraction * 16 ** width))
    if buckets == 0:
        raise ValueError(f"fraction {fraction} is below one bucket of {16 ** width}; "
                         f"use a larger width")
    return format(buckets, f"0{width}x")


def hash_sample_condition(key: Column | str, fraction: float, width: int | None = None) -> Column:
    """Keep a key when the first ``width`` hex digits of md5(key) fall below the bound.

    All rows of a key are kept or dropped together, the choice is the same
    in every engine that has md5, and the condition is a plain filter
    evaluated inside the scan stage (no shuffle).  The kept share is
    ``fraction`` rounded to a multiple of ``16 ** -width``; by default as many
    digits as bring it within a hundredth of the fraction.
    """
    if fraction >= 1:
        return F.lit(True)
    width = width or hash_width(fraction)
    key = F.col(key) if isinstance(key, str) else key
    return (F.substring(F.md5(key.cast("string")), 1, width)
            < F.lit(hash_bucket_prefix(fraction, width)))


def hash_sample(df: DataFrame, key: str, fraction: float, width: int | None = None) -> DataFrame:
    return df.where(hash_sample_condition(key, fraction, width))


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """``cache_table`` for the length of a block: the blocks are given back at its end."""
    kept = cache_table(df)
    try:
        yield kept
    finally:
        kept.unpersist()


def cache_table(df: DataFrame) -> DataFrame:
    """Keep a table that several results are drawn from.

    Cached blocks lost with an executor are recomputed from lineage, so a
    cache never changes results; use ``sinks.checkpoint_table`` to cut a
    long lineage instead.
    """
    return df.cache()
