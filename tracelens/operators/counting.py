"""Counting operators.

All are hash aggregations that Spark runs as partial (map-side) plus final
aggregates, so a key holding a third of all rows is reduced to one row per
map task before the shuffle.  Distinct counts are exact by default; Spark
plans them as an aggregation on (key, value) first, so the values of a hot
key are spread over many reducers instead of being collected in one set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelens.functions.keys import name_list
from tracelens.functions.missing import label_missing


def value_counts(df: DataFrame, cols: str | Sequence[str], *, name: str = "n_rows",
                 missing_label: str | None = None) -> DataFrame:
    """Rows per value of ``cols`` (A1).

    With ``missing_label`` the key is shown as text and missing values form
    one group under that label (F7); without it nulls still form one group
    and the key keeps its type.
    """
    keys = []
    for c in name_list(cols):
        keys.append(label_missing(c, missing_label).alias(c) if missing_label else F.col(c))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def rows_per_key(df: DataFrame, keys: str | Sequence[str], name: str = "n_rows") -> DataFrame:
    """Rows per key (A1 without labelling)."""
    return df.groupBy(*name_list(keys)).agg(F.count(F.lit(1)).alias(name))


def frequency_of_counts(counts: DataFrame, count_col: str, name: str = "n_keys") -> DataFrame:
    """How many keys have each count (A3): the frequency of frequencies."""
    return counts.groupBy(count_col).agg(F.count(F.lit(1)).alias(name))


def count_present(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """Number of non-missing values of ``col`` (A4), as a one-row table."""
    return df.agg(F.count(F.col(col)).alias(name or f"n_{col}"))


def distinct_count(value: str, *, count_missing: bool = True, approx: bool = False,
                   rsd: float = 0.05):
    """Column expression: distinct values of ``value`` in a group (A5).

    ``count_missing`` counts a missing value as one more distinct value
    (the ``'NA'`` semantics of the trace) without casting keys to text.
    ``approx`` switches to HyperLogLog++ with relative error ``rsd``.
    """
    if approx:
        base = F.approx_count_distinct(F.col(value), rsd)
    else:
        base = F.count_distinct(F.col(value))
    if count_missing:
        base = base + F.max(F.when(F.col(value).isNull(), F.lit(1)).otherwise(F.lit(0)))
    return base


def distinct_per_key(df: DataFrame, keys: str | Sequence[str], value: str, *,
                     name: str = "n_distinct", count_missing: bool = True,
                     approx: bool = False) -> DataFrame:
    """Distinct values of ``value`` per key (A5)."""
    expr = distinct_count(value, count_missing=count_missing, approx=approx)
    return df.groupBy(*name_list(keys)).agg(expr.alias(name))


def distinct_and_rows(df: DataFrame, group: str | Sequence[str], distinct_col: str, *,
                      distinct_name: str = "n_distinct", rows_name: str = "n_rows",
                      count_missing: bool = False, approx: bool = False) -> DataFrame:
    """Distinct values and row count per group in one aggregation."""
    return df.groupBy(*name_list(group)).agg(
        distinct_count(distinct_col, count_missing=count_missing, approx=approx)
        .alias(distinct_name),
        F.count(F.lit(1)).alias(rows_name),
    )


def distinct_rows(df: DataFrame, cols: str | Sequence[str] | None = None) -> DataFrame:
    """Distinct rows, optionally of a projection."""
    return (df.select(*name_list(cols)) if cols else df).distinct()


__all__ = [
    "count_present", "distinct_and_rows", "distinct_count", "distinct_per_key",
    "distinct_rows", "frequency_of_counts", "rows_per_key", "value_counts",
]
