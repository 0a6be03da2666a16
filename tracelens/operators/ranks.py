"""Exact ranks, quantiles and samples by position, without a task that holds a whole column.

* ``value_ranks``      range partitions of the distinct values, each with its offset
* ``rank_correlation`` Spearman's coefficient with averaged ties (X2)
* ``exact_quantiles``  selection by repeated narrowing of the value range (X3, A7)
* ``exact_sample``     the k rows with the smallest keyed hashes (S4, S4b)
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelens.functions.arith import round_half_up
from tracelens.sources.sinks import checkpoint_table

PIVOTS = 63  # values that cut a range in one round of narrowing
LAST_ROWS = 10_000  # distinct values that the last step of a selection fetches at most
SMALL_SAMPLE = 10_000  # rows that tasks keep each, and one task merges
HASH_DIGITS, PASS_DIGITS = 15, 4  # hex digits of a sample's hash, and those that one pass of its selection settles


def value_ranks(df: DataFrame, col: str, *, rank: str = "rank2") -> DataFrame:
    """(col, n, rank2) of every value that is not null: its rows, and twice their average rank (a whole number).

    Values are counted, with map-side combination, and cut into ranges of whole values; a
    range's ranks are its own running counts plus the rows of the ranges before it.  The
    largest task holds one range; the offsets are one row a range.  The ranges are
    checkpointed, so that both of their readers see the same cut.
    """
    return _ranks_of_counts(df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n")), col, rank)


def _ranks_of_counts(counts: DataFrame, col: str, rank: str) -> DataFrame:
    placed = checkpoint_table(counts.repartitionByRange(col).withColumn("_range", F.spark_partition_id()))
    ranges = placed.groupBy("_range").agg(F.sum("n").alias("_rows"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = ranges.select("_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    below = Window.partitionBy("_range").orderBy(col).rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("_below", F.coalesce(F.sum("n").over(below), F.lit(0))).join(offsets, "_range").select(
        col, "n", (2 * (F.col("_offset") + F.col("_below")) + F.col("n") + 1).alias(rank))


def rank_correlation(df: DataFrame, x: str, y: str, name: str = "rank_corr", digits: int | None = 6) -> DataFrame:
    """Spearman's rank correlation of two columns, ties averaged, as a one-row table.

    Rows with a null in either column are left out.  Null if a column is constant or there are no
    rows.  Equal pairs are counted first, so a pair that a third of all rows share is one row.  The
    doubled ranks are whole numbers, and their sums decimals: exact for up to 10^12 rows.
    """
    pairs = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(
        F.col(x).alias("_x"), F.col(y).alias("_y")).agg(F.count(F.lit(1)).alias("_m"))
    ranked = pairs
    for c in ("_x", "_y"):  # ranks among the rows that have both values
        ranks = _ranks_of_counts(pairs.groupBy(c).agg(F.sum("_m").alias("n")), c, f"{c}r")
        ranked = ranked.join(ranks.drop("n"), c)

    def total(*cols: str) -> Column:
        wide = [F.col(c).cast("decimal(38,0)") for c in cols]
        return F.sum(reduce(lambda a, b: (a * b).cast("decimal(38,0)"), wide)).cast("decimal(38,0)")

    sums = ranked.agg(F.sum("_m").alias("n"), total("_m", "_xr").alias("x"), total("_m", "_yr").alias("y"),
                      total("_m", "_xr", "_yr").alias("xy"), total("_m", "_xr", "_xr").alias("xx"),
                      total("_m", "_yr", "_yr").alias("yy"))

    def mean(c: str) -> Column:
        return F.col(c).cast("double") / F.nullif(F.col("n"), F.lit(0)).cast("double")

    cov = mean("xy") - mean("x") * mean("y")
    spread = F.sqrt(mean("xx") - mean("x") * mean("x")) * F.sqrt(mean("yy") - mean("y") * mean("y"))
    value = cov / F.nullif(spread, F.lit(0.0))
    return sums.select((value if digits is None else round_half_up(value, digits)).alias(name))


def _place(x: Column, cuts: list, first: int = 0) -> Column:
    """2j for a value between cuts j - 1 and j of ascending cuts, 2j + 1 for one equal to cut j, found by halving."""
    if not cuts:
        return F.lit(2 * first)
    mid = len(cuts) // 2
    return F.when(x < F.lit(cuts[mid]), _place(x, cuts[:mid], first)).when(x == F.lit(cuts[mid]), F.lit(2 * (first + mid) + 1)) \
        .otherwise(_place(x, cuts[mid + 1:], first + mid + 1))


def select_positions(df: DataFrame, col: str, positions: Sequence[int]) -> list:
    """The values at the given places (from 0) of the sorted values of ``col``, nulls left out.

    Each round takes approximate quantiles of what is left as pivots, counts the rows below and
    up to each of them exactly, and keeps the ranges between two pivots that hold a place; a
    place inside a pivot's own rows is found.  A range of at most ``LAST_ROWS`` rows is
    fetched as counted values.  Places share ranges and all ranges a round's two passes; rounds grow with the
    logarithm of the rows to the base of the pivots in a range, whatever the values are.
    """
    x = F.col(col)
    rows = df.where(x.isNotNull()).select(x)
    n_rows = rows.count()
    if positions and not 0 <= min(positions) <= max(positions) < n_rows:
        raise ValueError(f"no place {min(positions)} or {max(positions)} among {n_rows} values")
    found: dict[int, object] = {}
    # (highest pivot below, lowest pivot above, rows up to the former, rows in between) -> places.
    ranges = {(None, None, 0, n_rows): set(positions)}

    def inside(lo, hi) -> Column:
        return (F.lit(True) if lo is None else x > F.lit(lo)) & (F.lit(True) if hi is None else x < F.lit(hi))

    while True:
        for (lo, hi, below, n), places in [r for r in ranges.items() if r[0][3] <= LAST_ROWS]:
            for value, times in rows.where(inside(lo, hi)).groupBy(col).count().orderBy(col).collect():
                found |= {p: value for p in places if below <= p < below + times}
                below += times
        asked = [r for r in ranges.items() if r[0][3] > LAST_ROWS and r[1]]
        if not asked:
            return [found[p] for p in positions]
        each = max(3, PIVOTS // len(asked))
        probs = F.array(*[F.lit((i + 0.5) / each) for i in range(each)])
        pivots = rows.agg(*[F.percentile_approx(F.when(inside(lo, hi), x), probs, 1000).alias(f"c{i}")
                            for i, ((lo, hi, _, _), _) in enumerate(asked)]).first()
        cuts = [sorted(set(c)) for c in pivots]
        # Counted by the place among all cuts, which ascend as the ranges do: 2j between the cuts before and at j, 2j + 1 at j.
        counts = rows.groupBy(_place(x, [v for c in cuts for v in c]).alias("at")).agg(F.count(F.lit(1)).alias("n"))
        sizes = counts.agg(F.map_from_entries(F.collect_list(F.struct("at", "n")))).first()[0]
        ranges, at, upto = {}, 0, 0
        for i, ((lo, hi, below, n), places) in enumerate(asked):
            end = below + n
            for v in cuts[i]:
                less = upto + sizes.get(at, 0)
                at, upto = at + 2, less + sizes.get(at + 1, 0)
                ranges[(lo, v, below, less - below)] = {p for p in places if below <= p < less}
                found |= {p: v for p in places if less <= p < upto}
                lo, below = v, upto
            ranges[(lo, hi, below, end - below)] = {p for p in places if below <= p}
        ranges = {r: places for r, places in ranges.items() if places}


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], *, name: str = "value") -> DataFrame:
    """(prob, value): exact quantiles of a numeric column, interpolated between neighbours.

    Nulls are left out; without any value all quantiles are null.  Runs the selection at once
    (``select_positions``); no task or driver list holds more than ``LAST_ROWS`` values.
    """
    n = df.agg(F.count(col)).first()[0]
    places = {}
    for p in probs:
        at = Fraction(str(p)) * max(n - 1, 0)
        places[p] = (at.__floor__(), float(at - at.__floor__()))
    wanted = sorted({q for low, part in places.values() for q in ([low, low + 1] if part else [low])})
    values = dict(zip(wanted, map(float, select_positions(df, col, wanted)))) if n else {}

    def value(low: int, part: float) -> float | None:
        if not n:
            return None
        return values[low] if not part else values[low] + (values[low + 1] - values[low]) * part

    return df.sparkSession.createDataFrame([(float(p), value(*places[p])) for p in probs], f"prob double, {name} double")


def sample_hash(keys: Sequence[str], seed: int) -> Column:
    """The first 15 hex digits of md5 of the seed and the keys' text: the same in every engine that has md5, in the order of the number."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("\\N")) for k in keys])
    return F.substring(F.md5(text), 1, HASH_DIGITS)


def _hash_at(marked: DataFrame, col: str, n: int, place: int) -> tuple[str, int, int]:
    """(hash, rows below it, its rows): the hash at a place (from 0) of the sorted hashes of ``n`` rows.

    Rows are counted by the hash's first digits, so that a pass leaves about one row in 65,536; once at most
    ``LAST_ROWS`` are left they are counted by the whole hash.  Each pass fetches 65,536 counts at most.
    """
    prefix, below = "", 0
    while len(prefix) < HASH_DIGITS:
        width = HASH_DIGITS if n <= LAST_ROWS else min(len(prefix) + PASS_DIGITS, HASH_DIGITS)
        left = marked.where(F.col(col).startswith(prefix)) if prefix else marked
        counts = left.groupBy(F.substring(col, 1, width).alias("first")).agg(F.count(F.lit(1)).alias("n"))
        for prefix, n in sorted(map(tuple, counts.collect())):
            if place < below + n:
                break
            below += n
    return prefix, below, n


def exact_sample(df: DataFrame, *, rows: int | None = None, fraction: float | None = None, keys: Sequence[str] | None = None,
                 seed: int = 42, weight: str | None = None) -> DataFrame:
    """Exactly ``rows`` rows (or ``fraction`` of them, rounded half up) without replacement.

    The rows with the smallest keyed hash of ``keys`` (default: all columns), ties by all
    columns in their order: the same rows however the table is laid out in files or
    partitions.  Every row is equally likely over the choice of ``seed``; with ``weight`` each
    gets the number of rows that it stands for.  Asking for more rows than there are gives all.

    Up to ``SMALL_SAMPLE`` rows every task keeps its own smallest; beyond, the bounding hash is
    selected exactly, in two passes up to 600 million rows, and the sample is a filter.  Only if the
    rows of the bounding hash are not all taken, they are sorted.
    """
    if (rows is None) == (fraction is None):
        raise ValueError("give either rows or fraction")
    if fraction is not None and not 0 <= fraction <= 1 or rows is not None and rows < 0:
        raise ValueError("fraction must be in [0, 1], rows 0 or more")
    n = df.count()
    k = min(n, rows if rows is not None else (Fraction(str(fraction)) * n + Fraction(1, 2)).__floor__())
    marked = df.withColumn("_h", sample_hash(list(keys) if keys else df.columns, seed))
    if k == n:
        some = marked
    elif k <= SMALL_SAMPLE:
        some = marked.orderBy("_h", *df.columns).limit(k)
    else:
        bound, below, tied = _hash_at(marked, "_h", n, k - 1)
        some = marked.where(F.col("_h") <= F.lit(bound))
        if below + tied > k:
            some = marked.where(F.col("_h") < F.lit(bound)).unionByName(
                marked.where(F.col("_h") == F.lit(bound)).orderBy(*df.columns).limit(k - below))
    some = some.drop("_h")
    return some.withColumn(weight, F.lit(n / k if k else None).cast("double")) if weight else some
