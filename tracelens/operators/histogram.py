"""Histograms as data (V2, V3).

``equal_width_histogram`` reproduces ``numpy.histogram(x, bins)`` on a
distributed column: the value range comes from a one-row scalar subquery
(min and max, partial-aggregated per task), every row is assigned its bin
in the scan stage, and a partial + final aggregation counts rows per bin.
At most ``bins`` rows, and one for values that are not finite, leave the
aggregation and are joined to the table of all bin ids.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelens.functions.arith import round_half_up


NOT_FINITE = -1  # the bin of NaN and the infinities, which have no place between edges


def _edge(i: Column, lo: Column, hi: Column, step: Column, bins: int) -> Column:
    # Edges as numpy.linspace builds them: i * step + lo, the last one exactly hi.  A range wider
    # than the largest double has no step; its edges are weighted means of the two ends.
    part = i.cast("double") / F.lit(float(bins))
    inner = F.when(step.isNull(), lo * (F.lit(1.0) - part) + hi * part).otherwise(i.cast("double") * step + lo)
    return F.when(i >= F.lit(bins), hi).otherwise(inner)


def equal_width_histogram(df: DataFrame, col: str, bins: int = 10, *,
                          name: str = "n_rows", fill_empty: bool = True) -> DataFrame:
    """Counts in ``bins`` equal-width bins from min to max (last bin closed).

    Output columns: ``bin`` (0-based), ``bin_lo``, ``bin_hi`` and ``name``.
    A column with a single distinct value uses the range value +- 0.5, as
    numpy does; missing values are not counted.  With ``fill_empty`` every
    bin appears, empty ones with count 0.

    The counts sum to the number of non-missing values: the range is that of
    the finite ones, and NaN and infinite values, if any, are counted in a
    row of their own, bin ``NOT_FINITE`` without edges.
    """
    if bins < 1:
        raise ValueError("bins must be positive")
    x = F.col(col).cast("double")
    present = df.where(x.isNotNull())
    finite = F.abs(x) <= F.lit(sys.float_info.max)
    # One scalar subquery for the range, projected once per side as a struct
    # column; later expressions read its fields, so the subquery is not
    # copied into every expression that needs lo or hi.
    inside = F.when(finite, x)
    rng = present.agg(F.struct(F.min(inside).alias("lo"), F.max(inside).alias("hi"))).scalar()

    def with_range(frame: DataFrame) -> DataFrame:
        frame = frame.withColumn("_r", rng)
        lo0, hi0 = F.col("_r.lo"), F.col("_r.hi")
        frame = frame.select(
            *[c for c in frame.columns if c != "_r"],
            F.when(lo0 == hi0, lo0 - F.lit(0.5)).otherwise(lo0).alias("_lo"),
            F.when(lo0 == hi0, hi0 + F.lit(0.5)).otherwise(hi0).alias("_hi"),
        )
        span = F.col("_hi") - F.col("_lo")
        return frame.withColumn("_step", F.when(span <= F.lit(sys.float_info.max), span / F.lit(float(bins))))

    los, his, steps = F.col("_lo"), F.col("_hi"), F.col("_step")
    staged = with_range(present.select(x.alias("_x")))
    xs = F.col("_x")
    # First guess from the scaled offset, then a one-step correction against
    # the actual edges (floating error near an edge can be off by one).
    offset = F.when(steps.isNull(), (xs / 2 - los / 2) / (his / 2 - los / 2)).otherwise((xs - los) / (his - los))
    guess = F.least(F.floor(offset * F.lit(float(bins))).cast("int"), F.lit(bins - 1))
    staged = staged.withColumn("_i", F.when(F.abs(xs) <= F.lit(sys.float_info.max), guess))
    i = F.col("_i")
    staged = staged.withColumn(
        "_i", F.when(xs < _edge(i, los, his, steps, bins), i - 1).otherwise(i))
    i = F.col("_i")
    staged = staged.withColumn(
        "_i",
        F.when((xs >= _edge(i + 1, los, his, steps, bins)) & (i != F.lit(bins - 1)), i + 1)
        .otherwise(i))
    counts = staged.groupBy(F.coalesce("_i", F.lit(NOT_FINITE)).alias("bin")).agg(F.count(F.lit(1)).alias(name))

    spark = df.sparkSession
    ids = with_range(spark.range(NOT_FINITE, bins).select(F.col("id").cast("int").alias("bin")))
    real = F.col("bin") >= 0
    edges = ids.select(
        "bin",
        F.when(real, _edge(F.col("bin"), los, his, steps, bins)).alias("bin_lo"),
        F.when(real, _edge(F.col("bin") + 1, los, his, steps, bins)).alias("bin_hi"),
    )
    out = edges.join(counts, on="bin", how="left" if fill_empty else "inner")
    return out.where((F.col("bin") >= 0) | F.col(name).isNotNull()).select(
        "bin", "bin_lo", "bin_hi", F.coalesce(F.col(name), F.lit(0).cast("long")).alias(name))


def integer_histogram(df: DataFrame, col: str, *, bucket: str | None = None,
                      name: str = "n_rows") -> DataFrame:
    """Rows per value of ``col`` rounded half-up to an integer (V3)."""
    bucket = bucket or f"{col}_int"
    key = round_half_up(F.col(col), 0).cast("long")
    return (df.where(F.col(col).isNotNull())
            .groupBy(key.alias(bucket)).agg(F.count(F.lit(1)).alias(name)))


def scatter_grid(df: DataFrame, x: str, y: str, *, max_cells: int = 1024, depth: int = 8) -> DataFrame:
    """A scatter plot of any size as cells, at most ``max_cells`` of them (V6): (level, cx, cy, x_lo, x_hi, y_lo, y_hi, n_rows).

    The bounding square is halved both ways where points are dense: a cell with more rows than
    ``3 * depth * rows / (max_cells - 1)`` is replaced by its non-empty quarters, down to ``depth``
    halvings.  Fewer than (max_cells - 1) / 3 cells can be that full, so the bound holds for any
    data.  Level 0 is the whole square; ``cx``, ``cy`` count cells of a level from the low end, and a
    cell holds its low edges; the last ones hold the high edges too.

    Pairs with a null are left out.  Pairs with a value that is not finite, if any, are counted in one more
    row, level ``NOT_FINITE`` without place.  The counts sum to the pairs.  Two passes over
    the pairs (range, finest cells); all else works on at most 4**depth rows.
    """
    if max_cells < 2 or not 0 <= depth <= 12:
        raise ValueError("need max_cells >= 2 and 0 <= depth <= 12")
    xs, ys = F.col(x).cast("double"), F.col(y).cast("double")
    pairs = df.where(xs.isNotNull() & ys.isNotNull()).select(xs.alias("_x"), ys.alias("_y"))
    finite = (F.abs("_x") <= F.lit(sys.float_info.max)) & (F.abs("_y") <= F.lit(sys.float_info.max))
    ranges = pairs.where(finite).agg(F.struct(
        F.min("_x").alias("x0"), F.max("_x").alias("x1"), F.min("_y").alias("y0"), F.max("_y").alias("y1"),
        F.count(F.lit(1)).alias("n"))).scalar()

    def place(value: str, lo: str, hi: str) -> Column:
        low, high = F.col(f"_r.{lo}"), F.col(f"_r.{hi}")
        # Halves keep the difference of two large values finite.
        part = (F.col(value) / 2 - low / 2) / (high / 2 - low / 2)
        return F.when(high > low, F.least(F.floor(part * F.lit(float(1 << depth))), F.lit((1 << depth) - 1))) \
            .otherwise(F.lit(0)).cast("int")

    # Numbers of the finest cells; one row more for pairs without a place.
    cells = pairs.withColumn("_r", F.when(finite, ranges)).select(
        place("_x", "x0", "x1").alias("ix"), place("_y", "y0", "y1").alias("iy"), finite.alias("real")) \
        .groupBy("real", "ix", "iy").agg(F.count(F.lit(1)).alias("n"))
    levels = cells.withColumn("level", F.explode(F.when(F.col("real"), F.sequence(F.lit(0), F.lit(depth)))
                                                 .otherwise(F.array(F.lit(NOT_FINITE)))))
    shift = F.pow(F.lit(2), F.lit(depth) - F.col("level"))

    def up(c: str, by: Column) -> Column:
        return F.floor(F.col(c) / by).cast("int")

    pyramid = levels.select("level", F.when(F.col("real"), up("ix", shift)).alias("cx"),
                            F.when(F.col("real"), up("iy", shift)).alias("cy"), "n") \
        .groupBy("level", "cx", "cy").agg(F.sum("n").alias("n"))
    most = F.ceil(F.lit(3.0 * depth) * F.col("_r.n") / F.lit(max_cells - 1))
    full = pyramid.withColumn("_r", ranges).where((F.col("n") > most) & (F.col("level") >= 0) & (F.col("level") < depth))
    parents = full.select((F.col("level") + 1).alias("level"), F.col("cx").alias("px"), F.col("cy").alias("py"))
    two = F.lit(2)
    reached = pyramid.withColumn("px", up("cx", two)).withColumn("py", up("cy", two)) \
        .join(parents, ["level", "px", "py"], "left_semi").drop("px", "py") \
        .unionByName(pyramid.where("level <= 0"))
    leaves = reached.join(full.select("level", "cx", "cy"), ["level", "cx", "cy"], "left_anti").withColumn("_r", ranges)

    def edge(c: str, lo: str, hi: str, at: int) -> Column:
        part = (F.col(c) + at) / F.pow(F.lit(2.0), F.col("level"))
        return F.col(f"_r.{lo}") * (F.lit(1.0) - part) + F.col(f"_r.{hi}") * part

    return leaves.select("level", "cx", "cy", edge("cx", "x0", "x1", 0).alias("x_lo"), edge("cx", "x0", "x1", 1).alias("x_hi"),
                         edge("cy", "y0", "y1", 0).alias("y_lo"), edge("cy", "y0", "y1", 1).alias("y_hi"),
                         F.col("n").alias("n_rows"))
