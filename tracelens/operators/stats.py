"""Global statistics over per-key results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelens.functions.arith import clamp, round_half_up


def _maybe_round(col, digits: int | None):
    return col if digits is None else round_half_up(col, digits)


def summary_stats(df: DataFrame, col: str, *, digits: int | None = 2,
                  prefix: str = "") -> DataFrame:
    """Mean, both standard deviations, min, max and the clamped band.

    ``low_mean = max(mean - std_pop, min)`` and ``high_mean = min(mean +
    std_pop, max)``; the band is clamped first and rounded afterwards.
    One global aggregate: every task folds its rows into one partial
    buffer, so only one small row per task crosses the shuffle.
    """
    x = F.col(col).cast("double")
    stats = df.agg(
        F.avg(x).alias("_mean"),
        F.stddev_samp(x).alias("_std_samp"),
        F.stddev_pop(x).alias("_std_pop"),
        F.min(col).alias("_min"),
        F.max(col).alias("_max"),
    )
    mean, std = F.col("_mean"), F.col("_std_pop")
    lo, hi = F.col("_min").cast("double"), F.col("_max").cast("double")
    return stats.select(
        _maybe_round(mean, digits).alias(f"{prefix}mean"),
        _maybe_round(F.col("_std_samp"), digits).alias(f"{prefix}std_samp"),
        _maybe_round(std, digits).alias(f"{prefix}std_pop"),
        F.col("_min").alias(f"{prefix}min"),
        F.col("_max").alias(f"{prefix}max"),
        _maybe_round(clamp(mean - std, lo, hi), digits).alias(f"{prefix}low_mean"),
        _maybe_round(clamp(mean + std, lo, hi), digits).alias(f"{prefix}high_mean"),
    )


def exact_median(df: DataFrame, col: str, name: str = "median") -> DataFrame:
    """Exact (interpolated) median of ``col`` as a one-row table.

    Rows are first counted per value, with map-side combination; the
    percentile then reads (value, count) rows.  Over per-key counts there
    are at most sqrt(2 * rows) values, so one task holds a small table even
    for trillions of rows.  For continuous values with many distinct values
    use ``approx_median``.
    """
    sizes = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.agg(F.percentile(F.col(col), 0.5, F.col("_n")).cast("double").alias(name))


def approx_median(df: DataFrame, col: str, name: str = "median",
                  accuracy: int = 10000) -> DataFrame:
    """Bounded-memory median (percentile_approx) as a one-row table."""
    return df.agg(F.percentile_approx(F.col(col), 0.5, accuracy).alias(name))


def correlation(df: DataFrame, x: str, y: str, name: str = "corr",
                digits: int | None = 6) -> DataFrame:
    """Pearson correlation of two columns as a one-row table.

    Written as ``covar_pop / (stddev_pop(x) * stddev_pop(y))`` with a
    null-safe division: with ANSI mode on, ``corr`` itself raises a
    division-by-zero error when either column is constant; here that case
    (and fewer than two rows) gives null.
    """
    xd, yd = F.col(x).cast("double"), F.col(y).cast("double")
    den = F.stddev_pop(xd) * F.stddev_pop(yd)
    value = F.covar_pop(xd, yd) / F.nullif(den, F.lit(0.0))
    return df.agg(_maybe_round(value, digits).alias(name))
