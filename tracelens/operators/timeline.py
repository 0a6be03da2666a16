"""Event order within a key: pending periods (J8) and as-of joins.

Both need the rows of a key in time order.  A key may hold a third of all rows,
so the time axis is cut into equal pieces and a task holds one piece of one key.
What a piece needs to know of the time before it (a period that is still open, the
last row of the other side) is one row per (key, piece), found by windows over
those summaries, and joined back.  Rows of one instant are combined before
anything is ordered, so many events at one time are one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracelens.functions.keys import name_list

PIECES = 256


def _in_pieces(df: DataFrame, times: DataFrame, pieces: int) -> DataFrame:
    """``df`` with the number of the equal piece of the range of ``times`` that holds its ``t``.

    Later times have larger numbers.  The range is one scalar subquery that reads the times alone.
    """
    span = times.agg(F.struct(F.min("t").alias("low"), F.max("t").alias("high"))).scalar()
    low, high = F.col("_span.low"), F.col("_span.high")
    width = F.greatest(F.ceil((high - low + 1) / F.lit(pieces)), F.lit(1))
    return df.withColumn("_span", span).withColumn("piece", F.floor((F.col("t") - low) / width).cast("int")).drop("_span")


def pending_periods(events: DataFrame, keys: str | Sequence[str], event_col: str, start_codes: Sequence,
                    end_codes: Sequence, time_col: str, *, time_scale: float = 1.0,
                    pieces: int = PIECES) -> DataFrame:
    """Every period that a key waits: (keys, start, end, n_starts, delay), in event order.

    A start event opens a period unless one is open; the next end event closes it, at the
    same instant at the earliest (of one instant, starts come before ends).  ``n_starts``
    counts the different instants at which start events fall into the period, the opening
    one included.  Ends without an open period and periods that never end give no row, so
    no delay is negative; ``delay`` is end - start, divided by ``time_scale``.

    Rows with a null time or a null key part are left out, other columns are ignored.
    ``time_col`` is a whole number; ``pieces`` has no effect on the result.
    """
    keys, ev = name_list(keys), F.col(event_col)
    start, end = list(start_codes), list(end_codes)
    key = [f"k{i}" for i in range(len(keys))]
    rows = events.where(ev.isin(start + end)).select(
        *[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col(time_col).cast("long").alias("t"),
        ev.isin(start).alias("starts"), ev.isin(end).alias("ends")).dropna(subset=[*key, "t"])
    instants = _in_pieces(rows.groupBy(*key, "t").agg(F.max("starts").alias("starts"), F.max("ends").alias("ends")),
                          rows, pieces)

    # Ends before a row (an end closes after the starts of its instant) number the periods of a piece.
    in_piece = Window.partitionBy(*key, "piece").orderBy("t")
    number = F.sum(F.col("ends").cast("int")).over(in_piece.rowsBetween(Window.unboundedPreceding, -1))
    opening = F.when(F.col("starts"), F.col("t"))
    local = instants.withColumn("nth", F.coalesce(number, F.lit(0))).groupBy(*key, "piece", "nth").agg(
        F.min(opening).alias("start"), F.max(F.when(F.col("ends"), F.col("t"))).alias("end"),
        F.count(opening).alias("n_starts"))

    # A piece hands on its last, unclosed part; pieces without an end add to what they were handed.
    pieces_of = local.groupBy(*key, "piece").agg(
        F.max(F.col("end").isNotNull()).alias("closes"),
        F.min(F.when(F.col("end").isNull(), F.col("start"))).alias("left"),
        F.sum(F.when(F.col("end").isNull(), F.col("n_starts")).otherwise(F.lit(0))).alias("n_left"))
    by_time = Window.partitionBy(*key).orderBy("piece")
    so_far = pieces_of.withColumn("island", F.sum(F.col("closes").cast("int")).over(
        by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    within = Window.partitionBy(*key, "island").orderBy("piece").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    handed = so_far.withColumn("open", F.min("left").over(within)).withColumn("n_open", F.sum("n_left").over(within)) \
        .select(*key, "piece", F.lag("open").over(by_time).alias("carry"), F.lag("n_open").over(by_time).alias("n_carry"))

    first = F.col("nth") == 0
    whole = local.where(F.col("end").isNotNull()).join(handed, [*key, "piece"]).select(
        *key, F.when(first & F.col("carry").isNotNull(), F.col("carry")).otherwise(F.col("start")).alias("start"), "end",
        (F.col("n_starts") + F.when(first, F.coalesce("n_carry", F.lit(0))).otherwise(F.lit(0))).alias("n_starts"))
    delay = F.col("end") - F.col("start")
    if time_scale != 1:
        delay = delay.cast("double") / F.lit(float(time_scale))
    return whole.where(F.col("start").isNotNull()).select(
        *[F.col(k).alias(name) for k, name in zip(key, keys)], "start", "end", "n_starts", delay.alias("delay"))


def as_of_join(events: DataFrame, states: DataFrame, keys: str | Sequence[str], time_col: str, state_time_col: str,
               values: Sequence[str], *, state_time_name: str = "state_time", pieces: int = PIECES) -> DataFrame:
    """Every row of ``events`` (keys, time) with the last row of ``states`` of its key that is not later.

    Returns keys, ``time_col``, the state's time (``state_time_name``) and its ``values``, all
    null where no state is as early.  Of several states of one key and instant the largest
    by ``values``, in their order, counts.  Both sides meet in one sorted pass per (key, piece):
    a state is never paired with an event, so rows grow with the two tables, not with their pairs.

    Events with a null time, and null keys, find nothing; states with a null time are left out.
    Repeated events give repeated rows.  ``pieces`` has no effect on the result.
    """
    keys, values = name_list(keys), list(values)
    key = [f"k{i}" for i in range(len(keys))]

    def side(df: DataFrame, time: str, carried: bool) -> DataFrame:
        state = F.struct(F.col(time).cast("long").alias("at"), *[F.col(v).alias(f"v{i}") for i, v in enumerate(values)]) \
            if carried else F.lit(None)
        return df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col(time).cast("long").alias("t"),
                         state.alias("state"))

    known = side(states, state_time_col, True).dropna(subset=[*key, "t"]).groupBy(*key, "t").agg(F.max("state").alias("state"))
    asked = side(events, time_col, False).groupBy(*key, "t").agg(F.count(F.lit(1)).alias("times"))
    kind = known.schema["state"].dataType
    both = known.select(*key, "t", "state", F.lit(0).cast("long").alias("times")).unionByName(
        asked.select(*key, "t", F.lit(None).cast(kind).alias("state"), "times"))
    times = [df.select(F.col(time).cast("long").alias("t")) for df, time in ((states, state_time_col), (events, time_col))]
    placed = _in_pieces(both, times[0].unionByName(times[1]), pieces)

    # Of one instant the state comes first: it holds from its own time on.
    in_piece = Window.partitionBy(*key, "piece").orderBy("t", "times").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = placed.withColumn("own", F.last("state", ignorenulls=True).over(in_piece)).where("times > 0")
    ends = placed.where("state is not null").groupBy(*key, "piece").agg(F.max("state").alias("last"))
    # Summaries of both kinds of pieces, so that a piece with events only knows what came before it.
    asked_pieces = found.where("own is null").select(*key, "piece").distinct()
    before = Window.partitionBy(*key).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = asked_pieces.withColumn("last", F.lit(None).cast(kind)).unionByName(ends) \
        .groupBy(*key, "piece").agg(F.max("last").alias("last")) \
        .withColumn("carry", F.last("last", ignorenulls=True).over(before)).where("carry is not null").drop("last")
    state = F.coalesce("own", "carry")
    return found.join(carried, [*key, "piece"], "left").select(
        *key, "t", state.alias("state"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("nth")).select(
        *[F.col(k).alias(name) for k, name in zip(key, keys)], F.col("t").alias(time_col),
        F.col("state.at").alias(state_time_name), *[F.col(f"state.v{i}").alias(v) for i, v in enumerate(values)])
