"""Joins (N1-N3).

The analyses aggregate each side to one row per key *before* joining and
join on exactly the grouping keys.  Both sides then arrive hash
partitioned on the join key, so the sort-merge join adds no exchange, and
a key that held a third of the raw rows is a single row by then (no join
skew).  Strategy choice (broadcast vs. sort-merge) is left to Spark: the
static size estimate of an aggregate never undercounts its input, and AQE
re-plans from the measured shuffle sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tracelens.functions.keys import name_list


def join_on_keys(left: DataFrame, right: DataFrame, keys: str | Sequence[str],
                 how: str = "inner") -> DataFrame:
    """Equi-join on one or several key columns."""
    return left.join(right, on=name_list(keys), how=how)


def semi_join(df: DataFrame, keys_df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys_df``.

    The keys are deduplicated first.  ``distinct`` is a hash aggregate with
    a map-side partial step, so a key that occurs in a billion rows leaves
    every map task as one row, and the join meets exactly one row per key
    on the right (no skewed join partition, no buffered duplicates).  When
    ``df`` is itself grouped by the key, both sides arrive hash-partitioned
    on it and the join adds no exchange.  Rows of ``df`` are never
    duplicated.
    """
    keys = name_list(keys)
    return df.join(keys_df.select(*keys).distinct(), on=keys, how="left_semi")
