"""The eight trace analyses (J1-J8) and their companions.

Each analysis takes DataFrames plus the names of the columns that play
each role, and returns a lazy DataFrame.  Defaults are the trace's own
column names (``sources.schemas``), so on the trace they are called with
the tables alone; ``plans.bindings`` maps other tables onto the roles.

Points where the two historical implementations of a job disagreed are
parameters (``std``, ``distinct``, rounding digits); defaults are noted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelens.functions.missing import NA, is_present, label_missing
from tracelens.functions.arith import round_half_even, round_half_up, scale_round
from tracelens.operators.counting import (
    distinct_and_rows,
    distinct_per_key,
    frequency_of_counts,
    rows_per_key,
    value_counts,
)
from tracelens.operators.histogram import equal_width_histogram, integer_histogram
from tracelens.operators.joins import join_on_keys, semi_join
from tracelens.operators.ordering import bottom_k, sort_by, top_k
from tracelens.operators.ranks import rank_correlation
from tracelens.operators.shares import rate_per_group, share_of_total
from tracelens.operators.stats import correlation, exact_median, summary_stats
from tracelens.operators.timeline import as_of_join, pending_periods
from tracelens.operators.transitions import mean_rows_per_key, positive_delays, transition_delay
from tracelens.sources.schemas import EVICT, LEAVE_PENDING, SUBMIT

# ---------------------------------------------------------------- J1 / V1


def value_distribution(df: DataFrame, col: str = "cpus", *, name: str = "n_rows",
                       missing_label: str | None = NA) -> DataFrame:
    """Rows per value of ``col``; missing values form the ``'NA'`` group.

    On ``machine_events`` this counts *events* per CPU capacity, not
    distinct machines (see ``entities_per_value`` for that).
    """
    return value_counts(df, col, name=name, missing_label=missing_label)


def value_share(df: DataFrame, col: str = "cpus", *, name: str = "n_rows",
                share_name: str = "pct", digits: int = 2,
                missing_label: str | None = NA) -> DataFrame:
    """V1: J1 plus each value's percentage of all rows."""
    counts = value_distribution(df, col, name=name, missing_label=missing_label)
    return share_of_total(counts, name, name=share_name, digits=digits, percent=True)


def entities_per_value(df: DataFrame, col: str = "cpus", entity: str = "machine_id", *,
                       name: str = "n_entities", missing_label: str | None = NA) -> DataFrame:
    """Distinct entities (e.g. machines) per value instead of rows."""
    key = label_missing(col, missing_label) if missing_label else F.col(col)
    return distinct_per_key(df.select(key.alias(col), entity), col, entity, name=name,
                            count_missing=False)


# ---------------------------------------------------------------- J2 / X3


def rows_per_key_stats(df: DataFrame, key: str = "job_id", *, entity: str | None = None,
                       digits: int = 2) -> DataFrame:
    """Rows per key, then mean, both standard deviations, min, max and
    the mean +- population std band clamped to [min, max].

    With ``entity`` (X4) a key's size is its number of distinct entities
    (e.g. distinct task indexes) instead of its number of rows.
    """
    if entity is None:
        sizes = rows_per_key(df, key, "_size")
    else:
        sizes = distinct_per_key(df, key, entity, name="_size", count_missing=False)
    return summary_stats(sizes, "_size", digits=digits)


def rows_per_key_median(df: DataFrame, key: str = "job_id", *, entity: str | None = None,
                        name: str = "median_rows") -> DataFrame:
    """Exact median of the rows (or distinct entities) per key."""
    if entity is None:
        sizes = rows_per_key(df, key, "_size")
    else:
        sizes = distinct_per_key(df, key, entity, name="_size", count_missing=False)
    return exact_median(sizes, "_size", name)


# ---------------------------------------------------------------- J3


def class_distribution(df: DataFrame, class_col: str = "scheduling_class",
                       job_col: str = "job_id", *, jobs_name: str = "n_jobs",
                       rows_name: str = "n_tasks", approx: bool = False) -> DataFrame:
    """Distinct jobs and rows per class, ordered by class.

    Distinct counts per class are not additive: a job seen in two classes
    counts in both.  ``approx`` uses HyperLogLog++ (about 5 % error) in
    place of the exact two-stage distinct aggregation.
    """
    out = distinct_and_rows(df, class_col, job_col, distinct_name=jobs_name,
                            rows_name=rows_name, approx=approx)
    return sort_by(out, class_col)


# ---------------------------------------------------------------- J4 / X1


def event_share(df: DataFrame, priority_col: str = "priority",
                event_col: str = "event_type", event_value=EVICT, *,
                name: str = "n_events", share_name: str = "prob",
                digits: int = 6) -> DataFrame:
    """Among rows with the event, the share of each priority.

    This is P(priority | event), e.g. how evictions split over priorities;
    ``event_rate`` gives P(event | priority).  The event filter is a plain
    equality, so it reaches the parquet / CSV scan.
    """
    hits = df.where(F.col(event_col) == F.lit(event_value)).select(priority_col)
    counts = rows_per_key(hits, priority_col, name)
    return sort_by(share_of_total(counts, name, name=share_name, digits=digits), priority_col)


def event_rate(df: DataFrame, priority_col: str = "priority",
               event_col: str = "event_type", event_value=EVICT, *,
               digits: int = 6) -> DataFrame:
    """Per priority, the share of rows that carry the event."""
    out = rate_per_group(df.select(priority_col, event_col), priority_col,
                         F.col(event_col) == F.lit(event_value), digits=digits)
    return sort_by(out, priority_col)


# ---------------------------------------------------------------- J5 / V5


def rows_per_key_topk(df: DataFrame, key: str = "job_id", k: int = 10, *,
                      name: str = "n_rows") -> DataFrame:
    """J5 (``distinct=False``): the k keys with the most rows."""
    return top_k(rows_per_key(df, key, name), name, k, tie_break=key)


def distinct_per_key_topk(df: DataFrame, key: str = "job_id", value: str = "machine_id",
                          k: int = 10, *, name: str = "n_distinct",
                          count_missing: bool = True, approx: bool = False) -> DataFrame:
    """The k keys with the most distinct values (a missing value counts once)."""
    counts = distinct_per_key(df, key, value, name=name, count_missing=count_missing,
                              approx=approx)
    return top_k(counts, name, k, tie_break=key)


def distinct_frequency(df: DataFrame, key: str = "job_id", value: str = "machine_id", *,
                       name: str = "n_distinct", keys_name: str = "n_keys",
                       count_missing: bool = False, approx: bool = False) -> DataFrame:
    """V5: how many keys have each number of distinct values."""
    counts = distinct_per_key(df, key, value, name=name, count_missing=count_missing,
                              approx=approx)
    return frequency_of_counts(counts, name, keys_name)


# ---------------------------------------------------------------- J6 / V2 / X2


def request_vs_usage(requests: DataFrame, usage: DataFrame, *, key: str = "job_id",
                     request_col: str = "cpu_request", usage_col: str = "cpu_rate",
                     factor: float = 100.0, value_digits: int = 4, mean_digits: int = 4,
                     delta_digits: int = 2, request_name: str = "request",
                     usage_name: str = "usage", delta_name: str = "delta") -> DataFrame:
    """Mean request and mean usage per key and their difference.

    Missing values are dropped on each side before anything else, each
    value is scaled by ``factor`` and rounded, each side is averaged per
    key (one row per key), the sides are inner-joined on the key and
    ``delta = request - usage``.  A negative delta means more was used
    than requested.  Defaults follow the DataFrame job (4 / 4 / 2 digits);
    the RDD job used 4 / 3 / 4.
    """
    def side(df: DataFrame, col: str, name: str) -> DataFrame:
        vals = (df.where(is_present(col))
                .select(F.col(key), scale_round(col, factor, value_digits).alias("_v")))
        return vals.groupBy(key).agg(round_half_up(F.avg("_v"), mean_digits).alias(name))

    joined = join_on_keys(side(requests, request_col, request_name),
                          side(usage, usage_col, usage_name), key)
    return joined.withColumn(
        delta_name, round_half_up(F.col(request_name) - F.col(usage_name), delta_digits))


def request_vs_usage_pairs(requests: DataFrame, usage: DataFrame,
                           pairs: Sequence[tuple[str, str, str]], *, key: str = "job_id",
                           factor: float = 100.0, value_digits: int = 4,
                           mean_digits: int = 4) -> DataFrame:
    """J6 for several (name, request column, usage column) pairs in one pass.

    Each side is grouped by key once for all pairs (an average ignores
    missing values, which equals dropping them per column first), and the
    sides are joined once.  Output: key, then ``{name}_request`` and
    ``{name}_usage`` per pair; ``pair_result`` turns one pair into the
    shape of ``request_vs_usage``.  Scans each table once instead of once
    per pair.
    """
    def side(df: DataFrame, cols: list[tuple[str, str]]) -> DataFrame:
        aggs = [round_half_up(F.avg(scale_round(col, factor, value_digits)), mean_digits)
                .alias(out) for col, out in cols]
        return df.groupBy(key).agg(*aggs)

    req = side(requests, [(r, f"{n}_request") for n, r, _ in pairs])
    use = side(usage, [(u, f"{n}_usage") for n, _, u in pairs])
    return join_on_keys(req, use, key)


def pair_result(per_key: DataFrame, name: str, *, key: str = "job_id",
                delta_digits: int = 2) -> DataFrame:
    """One pair of ``request_vs_usage_pairs`` as ``request_vs_usage`` returns it."""
    req, use = F.col(f"{name}_request"), F.col(f"{name}_usage")
    return (per_key.where(req.isNotNull() & use.isNotNull())
            .select(key, req.alias("request"), use.alias("usage"),
                    round_half_up(req - use, delta_digits).alias("delta")))


def most_over(result: DataFrame, k: int = 10, *, key: str = "job_id",
              delta: str = "delta") -> DataFrame:
    """The k keys using most beyond their request (lowest delta)."""
    return bottom_k(result, delta, k, tie_break=key)


def most_under(result: DataFrame, k: int = 10, *, key: str = "job_id",
               delta: str = "delta") -> DataFrame:
    """The k keys using least of their request (highest delta)."""
    return top_k(result, delta, k, tie_break=key)


def delta_histogram(result: DataFrame, bins: int = 10, *, delta: str = "delta") -> DataFrame:
    """V2: equal-width histogram of the deltas, all bins present."""
    return equal_width_histogram(result, delta, bins)


def request_usage_corr(result: DataFrame, *, request_name: str = "request",
                       usage_name: str = "usage", digits: int = 6) -> DataFrame:
    """Correlation of mean request and mean usage over keys."""
    return correlation(result, request_name, usage_name, "corr", digits)


# ---------------------------------------------------------------- J7 / V3


def _peaks(usage: DataFrame, key: str, peak_col: str, factor: float, digits: int | None,
           rnd, name: str) -> DataFrame:
    """Per key: the largest ``peak_col * factor``, rounded.

    Scaling by a positive factor and rounding keep the order of values, so the
    largest raw value is scaled and rounded once per key, not once per row.
    """
    if factor <= 0:
        raise ValueError("factor must be positive")
    value = F.col("_p").cast("double") * F.lit(float(factor))
    return (usage.where(is_present(peak_col)).groupBy(key).agg(F.max(peak_col).alias("_p"))
            .select(key, (value if digits is None else rnd(value, digits)).alias(name)))


def peak_vs_event(usage: DataFrame, events: DataFrame, *, key: str = "job_id",
                  peak_col: str = "maximum_cpu_rate", event_col: str = "event_type",
                  event_value=EVICT, factor: float = 100.0, digits: int | None = 2,
                  below: float = 100.0, name: str = "peak",
                  half_even: bool = False) -> DataFrame:
    """Per key the peak of ``peak_col * factor``, kept below ``below``,
    for keys that have at least one row with the event.

    ``digits=2`` keeps 99.6 below 100 (DataFrame job); ``digits=0``
    rounds it to 100 and drops it (RDD job; ``half_even=True`` rounds ties
    to even per row as that job did).  The event side is a semi-join on
    deduplicated keys, so keys with many events neither multiply rows nor
    skew the join.
    """
    peaks = _peaks(usage, key, peak_col, factor, digits,
                   round_half_even if half_even else round_half_up, name)
    peaks = peaks.where(F.col(name) < F.lit(float(below)))
    hit_keys = events.where(F.col(event_col) == F.lit(event_value))
    return semi_join(peaks, hit_keys, key)


def peak_table(usage: DataFrame, events: DataFrame, *, key: str = "job_id",
               peak_col: str = "maximum_cpu_rate", event_col: str = "event_type",
               event_value=EVICT, factor: float = 100.0, digits: int | None = 2) -> DataFrame:
    """Per key: the peak (as in ``peak_vs_event``) and ``had_event`` (1.0 / 0.0).

    One aggregation of ``usage`` and one left join to the deduplicated
    event keys (both one row per key, partitioned alike); J7's peaks and
    its correlation are both filters / aggregates of this table.
    """
    peaks = _peaks(usage, key, peak_col, factor, digits, round_half_up, "peak")
    hit = (events.where(F.col(event_col) == F.lit(event_value)).select(key).distinct()
           .withColumn("_hit", F.lit(1.0)))
    return (join_on_keys(peaks, hit, key, how="left")
            .select(key, "peak", F.coalesce(F.col("_hit"), F.lit(0.0)).alias("had_event")))


def peak_event_corr(usage: DataFrame, events: DataFrame, *, key: str = "job_id",
                    peak_col: str = "maximum_cpu_rate", event_col: str = "event_type",
                    event_value=EVICT, factor: float = 100.0, digits: int | None = 2,
                    below: float = 100.0, corr_digits: int = 6) -> DataFrame:
    """X2 for J7: correlation of a key's peak with whether it had the event.

    Peaks as in ``peak_vs_event`` but for every key below ``below``.
    """
    table = peak_table(usage, events, key=key, peak_col=peak_col, event_col=event_col,
                       event_value=event_value, factor=factor, digits=digits)
    return peak_corr_of(table, below=below, corr_digits=corr_digits)


def peak_corr_of(table: DataFrame, *, below: float = 100.0, corr_digits: int = 6) -> DataFrame:
    """``peak_event_corr`` from a ``peak_table``."""
    return correlation(table.where(F.col("peak") < F.lit(float(below))),
                       "peak", "had_event", "corr", corr_digits)


def peaks_of(table: DataFrame, *, key: str = "job_id", below: float = 100.0) -> DataFrame:
    """``peak_vs_event`` from a ``peak_table``: keys with the event, peak below ``below``."""
    return (table.where((F.col("had_event") == F.lit(1.0)) & (F.col("peak") < F.lit(float(below))))
            .select(key, "peak"))


def peak_histogram(peaks: DataFrame, *, peak: str = "peak", name: str = "n_keys") -> DataFrame:
    """V3: keys per integer peak value."""
    return integer_histogram(peaks, peak, bucket=f"{peak}_int", name=name)


# ---------------------------------------------------------------- J8


def pending_delays(events: DataFrame, *, job: str = "job_id", task: str = "task_index",
                   event_col: str = "event_type", time_col: str = "time",
                   submit: Sequence = (SUBMIT,), leave: Sequence = LEAVE_PENDING,
                   time_scale: float = 1.0, name: str = "delay") -> DataFrame:
    """Per (job, task) the first leave-pending time minus the first submit time."""
    return transition_delay(events, [job, task], event_col, submit, leave, time_col,
                            name=name, time_scale=time_scale)


def first_transition_delay(events: DataFrame, constraints: DataFrame, *,
                           job: str = "job_id", task: str = "task_index",
                           event_col: str = "event_type", time_col: str = "time",
                           submit: Sequence = (SUBMIT,), leave: Sequence = LEAVE_PENDING,
                           max_constraints: float = 50, time_scale: float = 1.0,
                           digits: int | None = 3, delay_name: str = "avg_delay",
                           constraints_name: str = "avg_constraints") -> DataFrame:
    """Mean pending delay per job against its mean constraints per task.

    Delays come from ``pending_delays`` and are averaged per job; the
    constraint side counts rows per (job, task), averages per job and keeps
    jobs below ``max_constraints`` (on the unrounded mean).  Both sides
    are one row per job before the inner join.
    """
    delays = pending_delays(events, job=job, task=task, event_col=event_col,
                            time_col=time_col, submit=submit, leave=leave,
                            time_scale=time_scale)
    return delay_vs_constraints(delays, constraints, job=job, task=task,
                                max_constraints=max_constraints, digits=digits,
                                delay_name=delay_name, constraints_name=constraints_name)


def delay_vs_constraints(delays: DataFrame, constraints: DataFrame, *, job: str = "job_id",
                         task: str = "task_index", delay_col: str = "delay",
                         max_constraints: float = 50, digits: int | None = 3,
                         delay_name: str = "avg_delay",
                         constraints_name: str = "avg_constraints") -> DataFrame:
    """J8 from precomputed (job, task) delays (the output of ``pending_delays``)."""
    avg_delay = delays.groupBy(job).agg(F.avg(delay_col).alias(delay_name))
    cons = mean_rows_per_key(constraints, job, task, name=constraints_name,
                             below=max_constraints)
    out = join_on_keys(avg_delay, cons, job)
    if digits is not None:
        out = out.select(job, round_half_up(F.col(delay_name), digits).alias(delay_name),
                         round_half_up(F.col(constraints_name), digits).alias(constraints_name))
    return out


def positive_pending_delays(events: DataFrame, **kwargs) -> DataFrame:
    """J8d: the (job, task) delays above zero."""
    return positive_delays(pending_delays(events, **kwargs), "delay")


def constraints_per_job(constraints: DataFrame, *, job: str = "job_id",
                        task: str = "task_index", max_constraints: float | None = 50,
                        digits: int | None = 3, name: str = "avg_constraints") -> DataFrame:
    """Mean constraint rows per task, per job, kept below the bound."""
    out = mean_rows_per_key(constraints, job, task, name=name, below=max_constraints)
    if digits is not None:
        out = out.withColumn(name, round_half_up(F.col(name), digits))
    return out


def delay_constraints_corr(result: DataFrame, *, delay_name: str = "avg_delay",
                           constraints_name: str = "avg_constraints",
                           digits: int = 6) -> DataFrame:
    """Correlation of mean constraints and mean pending delay over jobs."""
    return correlation(result, constraints_name, delay_name, "corr", digits)


def pending_intervals(events: DataFrame, *, job: str = "job_id", task: str = "task_index",
                      event_col: str = "event_type", time_col: str = "time",
                      submit: Sequence = (SUBMIT,), leave: Sequence = LEAVE_PENDING,
                      time_scale: float = 1.0) -> DataFrame:
    """J8 in event order: every PENDING period of every (job, task), resubmissions included.

    Unlike ``pending_delays``, which takes the first submit and the first leave whichever
    comes first, a period starts at a submit and ends at the next leave, so no delay is negative.
    """
    return pending_periods(events, [job, task], event_col, submit, leave, time_col, time_scale=time_scale)


def waiting_per_job(periods: DataFrame, *, job: str = "job_id", task: str = "task_index") -> DataFrame:
    """Per job, from ``pending_intervals``: tasks that waited, periods, resubmitted periods, total and longest wait.

    Waits are in the time unit of the events.
    """
    wait = F.col("end") - F.col("start")
    return periods.groupBy(job, task).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(wait).alias("_sum"), F.max(wait).alias("_max")).groupBy(job).agg(
        F.count(F.lit(1)).alias("n_tasks"), F.sum("_n").alias("n_periods"), F.sum(F.col("_n") - 1).alias("n_again"),
        F.sum("_sum").alias("total_wait"), F.max("_max").alias("longest_wait"))


# ---------------------------------------------------------------- J7 in time


def usage_at_event(usage: DataFrame, events: DataFrame, *, key: str | Sequence[str] = ("job_id", "task_index"),
                   start_col: str = "start_time", end_col: str = "end_time", peak_col: str = "maximum_cpu_rate",
                   event_col: str = "event_type", event_value=EVICT, time_col: str = "time") -> DataFrame:
    """J7 in time: each event with the last usage window of its key that had begun, and whether it was still open.

    Returns key, ``time_col``, ``start_col``, ``end_col``, ``peak_col`` and ``inside`` (the event is before the
    window's end); all but the first two are null, and ``inside`` false, for an event before any window.
    """
    hits = events.where(F.col(event_col) == F.lit(event_value))
    found = as_of_join(hits, usage.where(is_present(peak_col)), key, time_col, start_col, [peak_col, end_col],
                       state_time_name=start_col)
    inside = F.coalesce(F.col(time_col) < F.col(end_col), F.lit(False))
    keys = [key] if isinstance(key, str) else list(key)
    return found.select(*keys, time_col, start_col, end_col, peak_col, inside.alias("inside"))


def event_peaks(usage: DataFrame, events: DataFrame, *, job: str = "job_id", key: str | Sequence[str] = ("job_id", "task_index"),
                peak_col: str = "maximum_cpu_rate", **roles) -> DataFrame:
    """J7 in time, per job with events: events, those inside a usage window, the highest peak of those windows
    (``event_peak``) and of all windows (``peak``).

    ``peak_vs_event`` asks only whether a job was ever evicted; here the peak is that of the eviction's time.
    """
    at = usage_at_event(usage, events, key=key, peak_col=peak_col, **roles).groupBy(job).agg(
        F.count(F.lit(1)).alias("n_events"), F.count_if("inside").alias("n_inside"),
        F.max(F.when(F.col("inside"), F.col(peak_col))).alias("event_peak"))
    peaks = usage.where(is_present(peak_col)).groupBy(job).agg(F.max(peak_col).alias("peak"))
    return join_on_keys(at, peaks, job, how="left")


# ---------------------------------------------------------------- X2 by rank


def request_usage_rank_corr(result: DataFrame, *, request_name: str = "request", usage_name: str = "usage",
                            digits: int = 6) -> DataFrame:
    """Rank correlation (Spearman, ties averaged) of mean request and mean usage over keys."""
    return rank_correlation(result, request_name, usage_name, "rank_corr", digits)


def delay_constraints_rank_corr(result: DataFrame, *, delay_name: str = "avg_delay",
                                constraints_name: str = "avg_constraints", digits: int = 6) -> DataFrame:
    """Rank correlation of mean constraints and mean pending delay over jobs."""
    return rank_correlation(result, constraints_name, delay_name, "rank_corr", digits)
