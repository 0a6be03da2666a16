"""Shares of a total and rates within groups.

The total of a share is a *scalar subquery*: Spark runs the one-row
aggregate as its own small job and substitutes the value into the outer
plan.  That avoids both a second action on the driver and an
un-partitioned window (``sum(...) over ()``), which would move every
group into a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelens.functions.arith import ratio, round_half_up


def total_of(df: DataFrame, col: str) -> Column:
    """Scalar-subquery column holding ``sum(col)`` over ``df`` (A2)."""
    return df.agg(F.sum(F.col(col))).scalar()


def share_of_total(df: DataFrame, count_col: str, *, name: str = "share",
                   digits: int | None = 6, percent: bool = False) -> DataFrame:
    """Append ``count / sum(count)`` (or the percentage) to each row."""
    value = ratio(F.col(count_col), total_of(df, count_col))
    if percent:
        value = value * F.lit(100.0)
    out = df.withColumn(name, value)
    if digits is not None:
        # Round the materialised column: the total's subquery then appears
        # once in the plan instead of once per use inside the rounding.
        out = out.withColumn(name, round_half_up(F.col(name), digits))
    return out


def rate_per_group(df: DataFrame, group: str | Sequence[str], condition: Column, *,
                   rows_name: str = "n_rows", events_name: str = "n_events",
                   name: str = "rate", digits: int | None = 6) -> DataFrame:
    """Share of rows meeting ``condition`` within each group.

    One aggregation computes both the group size and the number of
    matching rows; missing conditions count as not matching.
    """
    group = [group] if isinstance(group, str) else list(group)
    hit = F.when(condition, F.lit(1)).otherwise(F.lit(0))
    out = df.groupBy(*group).agg(
        F.count(F.lit(1)).alias(rows_name),
        F.sum(hit).alias(events_name),
    )
    value = ratio(F.col(events_name), F.col(rows_name))
    if digits is not None:
        value = round_half_up(value, digits)
    return out.withColumn(name, value)
