"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tracelens.session import remove_at_exit, shared_dir

_blocks: list[list[str]] = []  # the folders of each open ``scratch`` block


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir`` that goes with its ``scratch`` block, or else when the session ends."""
    path = shared_dir(spark, name)
    remove_at_exit(spark, path)
    if _blocks:
        _blocks[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made inside the block are removed at its end; results must be written by then."""
    _blocks.append([])
    try:
        yield
    finally:
        for path in _blocks.pop():
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def table(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage and survives lost executors; the known schema is given to
    the reader, so no file is opened to infer it.  The files go when the session ends.
    """
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def columns_first(df: DataFrame, **named: str) -> DataFrame:
    """Only the given columns of ``df``, under the operator's own names.

    Extra columns, whatever their names, never meet the operator's columns.
    """
    return df.select(*[df[column].alias(name) for name, column in named.items()])
