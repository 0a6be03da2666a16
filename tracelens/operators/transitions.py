"""First transitions between event states (J8a-J8d).

For every (job, task) the first time of a *start* event (e.g. submit) and
the first time of an *end* event (e.g. leaving PENDING) are found, and the
delay between them is taken.  Both minima come from one conditional
aggregation keyed by (job, task) -- a single shuffle instead of two
aggregations and a join -- and keys lacking either event are dropped,
exactly as an inner join of the two minima would.  The delay may be
negative: the first end event need not follow the first start event.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelens.functions.keys import name_list


def first_event_time(df: DataFrame, keys: str | Sequence[str], event_col: str,
                     codes: Sequence, time_col: str, name: str = "first_time") -> DataFrame:
    """Earliest ``time_col`` per key among rows whose event is in ``codes``."""
    return (df.where(F.col(event_col).isin(list(codes)))
            .groupBy(*name_list(keys)).agg(F.min(time_col).alias(name)))


def transition_delay(df: DataFrame, keys: str | Sequence[str], event_col: str,
                     start_codes: Sequence, end_codes: Sequence, time_col: str, *,
                     name: str = "delay", time_scale: float = 1.0) -> DataFrame:
    """Per key: first end time minus first start time, divided by ``time_scale``."""
    ev, t = F.col(event_col), F.col(time_col)
    start, end = list(start_codes), list(end_codes)
    firsts = (df.where(ev.isin(start + end))
              .groupBy(*name_list(keys))
              .agg(F.min(F.when(ev.isin(start), t)).alias("_start"),
                   F.min(F.when(ev.isin(end), t)).alias("_end")))
    delay = F.col("_end") - F.col("_start")
    if time_scale != 1:
        delay = delay.cast("double") / F.lit(float(time_scale))
    return (firsts.where(F.col("_start").isNotNull() & F.col("_end").isNotNull())
            .select(*name_list(keys), delay.alias(name)))


def positive_delays(delays: DataFrame, col: str = "delay") -> DataFrame:
    """Only the rows with a delay above zero (J8d)."""
    return delays.where(F.col(col) > 0)


def mean_rows_per_key(df: DataFrame, job: str | Sequence[str], task: str | Sequence[str], *,
                      name: str = "avg_rows", below: float | None = None) -> DataFrame:
    """Rows per (job, task), averaged per job, optionally kept below a bound."""
    job, task = name_list(job), name_list(task)
    counts = df.groupBy(*job, *task).agg(F.count(F.lit(1)).alias("_n"))
    out = counts.groupBy(*job).agg(F.avg("_n").alias(name))
    if below is not None:
        out = out.where(F.col(name) < F.lit(below))
    return out
