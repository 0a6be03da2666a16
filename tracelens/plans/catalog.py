"""Query catalogue: every analysis bound to the driver tables.

``QUERIES[name](spark, sf_dir)`` returns the Spark DataFrame;
``ORACLE_SQL[name]`` is the same question written as plain SQL over the
tables as views (run by an independent engine as a cross-check).  Column
names and types agree between the two.  Queries whose result depends on
Spark's partition-seeded sampler have no SQL twin.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tracelens.functions.arith import round_even_sql as _even
from tracelens.functions.arith import round_half_up
from tracelens.functions.arith import round_sql as R
from tracelens.functions.keys import concat_key, split_key
from tracelens.functions.missing import NA
from tracelens.operators.counting import count_present, distinct_rows, rows_per_key, value_counts
from tracelens.operators.histogram import scatter_grid
from tracelens.operators.joins import join_on_keys
from tracelens.operators.ordering import sort_by
from tracelens.operators.partials import merged_counts, update_states
from tracelens.operators.ranks import exact_quantiles, exact_sample, value_ranks
from tracelens.operators.transitions import first_event_time
from tracelens.plans import analyses as A
from tracelens.plans import bindings as B
from tracelens.sources import readers, sinks
from tracelens.sources.ledger import ledger_summary, read_with_ledger
from tracelens.sources.published import publish, read_published
from tracelens.sources.readers import hash_sample_condition
from tracelens.session import remove_at_exit, shared_dir

Query = Callable[[SparkSession, str], DataFrame]

# ------------------------------------------------------------------ Spark side


def q_value_distribution(spark, sf):
    return A.value_distribution(B.returnflags(spark, sf), "l_returnflag")


def q_value_share(spark, sf):
    return A.value_share(B.returnflags(spark, sf), "l_returnflag")


def q_entities_per_value(spark, sf):
    return A.entities_per_value(B.returnflags(spark, sf), "l_returnflag", "l_orderkey",
                                name="n_orders")


def q_rows_per_key_stats(spark, sf):
    return A.rows_per_key_stats(B.lineitem(spark, sf), "l_orderkey")


def q_distinct_per_key_stats(spark, sf):
    return A.rows_per_key_stats(B.lineitem(spark, sf), "l_orderkey", entity="l_linenumber")


def q_rows_per_key(spark, sf):
    return rows_per_key(B.lineitem(spark, sf), "l_orderkey")


def q_count_present(spark, sf):
    return count_present(B.part_suppliers(spark, sf), "l_suppkey", "n_present")


def q_rows_per_key_median(spark, sf):
    return A.rows_per_key_median(B.lineitem(spark, sf), "l_orderkey")


def q_class_distribution(spark, sf):
    return A.class_distribution(B.lineitem(spark, sf), "l_returnflag", "l_orderkey")


def q_event_share(spark, sf):
    return A.event_share(B.order_priorities(spark, sf), "priority", "event_type", B.ORDER_EVENT)


def q_event_rate(spark, sf):
    return A.event_rate(B.order_priorities(spark, sf), "priority", "event_type", B.ORDER_EVENT)


def q_rows_per_key_topk(spark, sf):
    return A.rows_per_key_topk(B.lineitem(spark, sf), "l_partkey", 10)


def q_distinct_per_key_topk(spark, sf):
    return A.distinct_per_key_topk(B.part_suppliers(spark, sf), "l_partkey", "l_suppkey", 10)


def q_distinct_frequency(spark, sf):
    return A.distinct_frequency(B.part_suppliers(spark, sf, missing=False),
                                "l_partkey", "l_suppkey")


def _cpu(spark, sf):
    return A.request_vs_usage(B.cpu_requests(spark, sf), B.cpu_usage(spark, sf),
                              request_col="cpu_request", usage_col="cpu_rate")


def _mem(spark, sf):
    return A.request_vs_usage(B.mem_requests(spark, sf), B.mem_usage(spark, sf),
                              request_col="memory_request",
                              usage_col="canonical_memory_usage")


def q_request_vs_usage(spark, sf):
    return _cpu(spark, sf)


def q_request_vs_usage_rdd(spark, sf):
    # Rounding of the RDD job: means to 3 digits, deltas to 4.
    return A.request_vs_usage(B.cpu_requests(spark, sf), B.cpu_usage(spark, sf),
                              request_col="cpu_request", usage_col="cpu_rate",
                              mean_digits=3, delta_digits=4)


def q_request_vs_usage_mem(spark, sf):
    return _mem(spark, sf)


def q_most_over(spark, sf):
    return A.most_over(_cpu(spark, sf), 10)


def q_most_under(spark, sf):
    return A.most_under(_cpu(spark, sf), 10)


def q_most_over_mem(spark, sf):
    return A.most_over(_mem(spark, sf), 10)


def q_most_under_mem(spark, sf):
    return A.most_under(_mem(spark, sf), 10)


def q_delta_histogram(spark, sf):
    return A.delta_histogram(_cpu(spark, sf), 10)


def q_delta_histogram_mem(spark, sf):
    return A.delta_histogram(_mem(spark, sf), 10)


def q_request_usage_corr(spark, sf):
    return A.request_usage_corr(_cpu(spark, sf))


def _peaks(spark, sf):
    return A.peak_vs_event(B.peak_usage(spark, sf), B.order_events(spark, sf),
                           event_value=B.ORDER_EVENT, below=B.PEAK_BELOW)


def q_peak_vs_event(spark, sf):
    return _peaks(spark, sf)


def q_peak_vs_event_int(spark, sf):
    # RDD job: peaks rounded to integers per row (ties to even), so 9.6 -> 10 is dropped.
    return A.peak_vs_event(B.peak_usage(spark, sf), B.order_events(spark, sf),
                           event_value=B.ORDER_EVENT, below=B.PEAK_BELOW, digits=0,
                           half_even=True)


def q_peak_event_corr(spark, sf):
    return A.peak_event_corr(B.peak_usage(spark, sf), B.order_events(spark, sf),
                             event_value=B.ORDER_EVENT, below=B.PEAK_BELOW)


def q_peak_histogram(spark, sf):
    return A.peak_histogram(_peaks(spark, sf))


_J8_ARGS = dict(submit=B.SUBMIT_EVENTS, leave=B.LEAVE_EVENTS, time_scale=B.MICROS)


def _j8(spark, sf):
    return A.first_transition_delay(B.task_events(spark, sf), B.task_constraints(spark, sf),
                                    max_constraints=B.MAX_CONSTRAINTS, **_J8_ARGS)


def q_first_transition_delay(spark, sf):
    return _j8(spark, sf)


def q_positive_delays(spark, sf):
    return A.positive_pending_delays(B.task_events(spark, sf), **_J8_ARGS)


def q_first_event_time(spark, sf):
    return first_event_time(B.task_events(spark, sf), ["job_id", "task_index"], "event_type",
                            B.SUBMIT_EVENTS, "time", "first_time")


def q_constraints_per_job(spark, sf):
    return A.constraints_per_job(B.task_constraints(spark, sf),
                                 max_constraints=B.MAX_CONSTRAINTS)


def q_delay_constraints_corr(spark, sf):
    return A.delay_constraints_corr(_j8(spark, sf))


def q_event_keys(spark, sf):
    o = B.table(spark, sf, "orders")
    return distinct_rows(o.where(F.col("o_orderstatus") == B.ORDER_EVENT), "o_custkey")


def q_hash_sample(spark, sf):
    li = B.lineitem(spark, sf)
    return rows_per_key(li.where(hash_sample_condition("l_orderkey", 0.5)), "l_orderkey")


_SAMPLE_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def q_seeded_sample(spark, sf):
    return exact_sample(B.lineitem(spark, sf), fraction=0.2, keys=_SAMPLE_KEYS, seed=42)


def q_result_sample(spark, sf):
    """A hundred rows of a result, each with the number of rows that it stands for."""
    return exact_sample(q_request_vs_usage(spark, sf), rows=100, keys=["job_id"], seed=7, weight="weight")


def q_sample_invariants(spark, sf):
    """What a seeded sample promises, as one row: of a table read once and kept, and of a result."""
    result = q_request_vs_usage(spark, sf)
    some = readers.sample_rows(result, 0.5, seed=7)

    def n(df):
        return df.agg(F.count(F.lit(1))).scalar()

    with readers.cached(B.lineitem(spark, sf).select("l_orderkey", "l_linenumber")) as rows:
        first, again = (readers.sample_rows(rows, 0.2, seed=42) for _ in range(2))
        held = spark.range(1).select(
            (n(first.exceptAll(rows)) == 0).alias("in_source"),
            (n(first.intersectAll(again)) == n(first)).alias("repeatable"),
            (F.abs(n(first) / n(rows) - 0.2) < 0.03).alias("share_ok"),
            (n(some.exceptAll(result)) == 0).alias("result_in_source"),
            (F.abs(n(some) / n(result) - 0.5) < 0.15).alias("result_share_ok"))
        # Looked up while the rows are kept: one row of five answers.
        return spark.createDataFrame([tuple(held.first())], held.schema)


# Written part files, by application and source folder; each is removed when its JVM ends.
_WRITTEN: dict[tuple[str, str], str] = {}


def _messy_csv(spark, sf) -> str:
    """Machine events as untidy header-less CSV, written once a session.

    Every line has a quoted comma; a third of the lines are short (the last two
    fields are absent), a third have two fields too many, and some fields are empty.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key not in _WRITTEN:
        kind = F.col("l_linenumber") % 3
        flag = F.when(F.col("l_returnflag") == B.RETURNFLAG_MISSING, F.lit("")).otherwise(F.col("l_returnflag"))
        fixed = F.format_string('%d,%d,%d,"%s, %s"', "l_orderkey", "l_partkey", "l_linenumber",
                                "l_returnflag", "l_linestatus")
        whole = F.concat_ws(",", fixed, flag, F.col("l_discount").cast("string"))
        line = F.when(kind == 0, fixed).when(kind == 1, F.concat(whole, F.lit(",spare,fields"))).otherwise(whole)
        path = shared_dir(spark, "machine-events-csv")
        sinks.write_lines(B.lineitem(spark, sf).select(line.alias("line")), path)
        remove_at_exit(spark, path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def q_csv_round_trip(spark, sf):
    return readers.read_trace_table(spark, "machine_events", _messy_csv(spark, sf))


# The same lines split at every comma: the quoted field falls in two.
_SPLIT_SCHEMA = "time LONG, machine_id LONG, event_type INT, platform_a STRING, platform_b STRING, " \
                "cpus STRING, memory DOUBLE"


def q_line_scan(spark, sf):
    lines = readers.read_lines_table(spark, "machine_events", _messy_csv(spark, sf),
                                     schema=StructType.fromDDL(_SPLIT_SCHEMA))
    return value_counts(lines, ["platform_a", "cpus"], missing_label=NA)


def q_text_report(spark, sf):
    counts = A.value_distribution(B.returnflags(spark, sf), "l_returnflag")
    return sinks.format_lines(counts, "%s: %d rows", "l_returnflag", "n_rows")


def q_text_preview(spark, sf):
    """The first rows of a result as a fixed-width text table, one row per line."""
    counts = A.value_distribution(B.returnflags(spark, sf), "l_returnflag")
    return sinks.text_lines(counts, 10, "l_returnflag")


def q_rows_per_key_ascending(spark, sf):
    """The keys with the fewest rows, count first."""
    counts = rows_per_key(B.lineitem(spark, sf), "l_partkey").select("n_rows", "l_partkey")
    return sinks.head_rows(sort_by(counts, ["n_rows", "l_partkey"]), 20)


def q_delays_by_constraints(spark, sf):
    """J8, the jobs with most constraints first."""
    return sinks.head_rows(sort_by(q_first_transition_delay(spark, sf), "avg_constraints", ascending=False,
                                   tie_break="job_id"), 20)


def q_task_delay_events(spark, sf):
    """Per (job, task): pending delay and number of events, joined on both keys, most events first."""
    events = B.task_events(spark, sf)
    delays = A.pending_delays(events, submit=B.SUBMIT_EVENTS, leave=B.LEAVE_EVENTS, time_scale=B.MICROS)
    keys = ["job_id", "task_index"]
    joined = join_on_keys(delays, rows_per_key(events, keys, "n_events"), keys) \
        .withColumn("task_key", concat_key(*keys)).withColumn("task_text", split_key("task_key", 1))
    return sinks.head_rows(sort_by(joined, "n_events", ascending=False, tie_break=keys), 20)


def _periods(spark, sf):
    return A.pending_intervals(B.task_events(spark, sf), **_J8_ARGS)


def q_pending_intervals(spark, sf):
    return _periods(spark, sf)


def q_waiting_per_job(spark, sf):
    return A.waiting_per_job(_periods(spark, sf))


_J7_TIME = dict(key="job_id", event_value="error")


def q_usage_at_event(spark, sf):
    return A.usage_at_event(B.usage_windows(spark, sf), B.user_events(spark, sf), **_J7_TIME)


def q_event_peaks(spark, sf):
    return A.event_peaks(B.usage_windows(spark, sf), B.user_events(spark, sf), **_J7_TIME)


def q_request_usage_rank_corr(spark, sf):
    return A.request_usage_rank_corr(_cpu(spark, sf))


def q_delay_constraints_rank_corr(spark, sf):
    return A.delay_constraints_rank_corr(_j8(spark, sf))


def q_price_ranks(spark, sf):
    """Ranks of all prices, ties averaged, as one row a price."""
    ranks = value_ranks(B.lineitem(spark, sf), "l_extendedprice")
    return ranks.select("l_extendedprice", "n", (F.col("rank2") / F.lit(2.0)).alias("rank"))


_QUANTILES = (0.0, 0.01, 0.25, 0.5, 0.75, 0.95, 0.999, 1.0)


def q_exact_quantiles(spark, sf):
    found = exact_quantiles(B.lineitem(spark, sf), "l_extendedprice", _QUANTILES)
    return found.select("prob", round_half_up("value", 6).alias("value"))


def _faulty_csv(spark, sf) -> str:
    """Machine events as CSV of which four lines in five have a fault, by line number."""
    key = (spark.sparkContext.applicationId, sf + "#faulty")
    if key not in _WRITTEN:
        def text(c):
            return F.coalesce(F.col(c).cast("string"), F.lit("null"))

        number = F.when(F.col("l_linenumber") % 5 == 2, F.lit("x")).otherwise(F.lit(""))
        start = F.concat(number, F.concat_ws(",", text("l_orderkey"), text("l_partkey"), text("l_linenumber")))
        name = F.concat_ws(", ", text("l_returnflag"), text("l_linestatus"))
        whole = F.concat(start, F.lit(',"'), name, F.lit('",'), F.col("l_returnflag"), F.lit(","),
                         F.col("l_quantity").cast("int").cast("string"))
        line = F.when(F.col("l_linenumber") % 5 == 0, start).when(F.col("l_linenumber") % 5 == 1, F.concat(whole, F.lit(",spare"))) \
            .when(F.col("l_linenumber") % 5 == 3, F.concat(start, F.lit(',"'), name)).otherwise(whole)
        path = shared_dir(spark, "machine-events-faulty")
        sinks.write_lines(B.lineitem(spark, sf).select(line.alias("line")), path)
        remove_at_exit(spark, path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def _ledger(spark, sf):
    return read_with_ledger(spark, "machine_events", _faulty_csv(spark, sf))


def q_quarantined_lines(spark, sf):
    return _ledger(spark, sf).quarantined.select("line", F.array_join("reasons", "; ").alias("reasons"))


def q_rows_beside_quarantine(spark, sf):
    return _ledger(spark, sf).rows


def q_ledger_summary(spark, sf):
    return ledger_summary(_ledger(spark, sf))


def q_published_result(spark, sf):
    """A result published twice and read by its manifest."""
    path = shared_dir(spark, "published")
    remove_at_exit(spark, path)
    counts = A.value_distribution(B.returnflags(spark, sf), "l_returnflag")
    publish(counts.limit(1), path)
    publish(counts, path, keep=1)
    return read_published(spark, path)


def q_merged_file_states(spark, sf):
    """J3 from the stored states of part files, the first two files registered by a run of their own."""
    key = (spark.sparkContext.applicationId, sf + "#states")
    if key not in _WRITTEN:
        path = shared_dir(spark, "file-states")
        remove_at_exit(spark, path)
        B.lineitem(spark, sf).select("l_returnflag", "l_orderkey").repartition(5).write.csv(f"{path}/parts")
        _WRITTEN[key] = path
    path = _WRITTEN[key]

    def read(files):
        return spark.read.schema("l_returnflag STRING, l_orderkey BIGINT").csv(files)

    for files in (f"{path}/parts/part-0000[01]*", f"{path}/parts/part-*"):
        update_states(spark, files, f"{path}/states", read, "l_returnflag", "l_orderkey")
    return merged_counts(spark, f"{path}/states", key="l_returnflag", rows="n_tasks", distinct="n_jobs")


def q_scatter_grid(spark, sf):
    return scatter_grid(_j8(spark, sf), "avg_constraints", "avg_delay", max_cells=200, depth=6)


QUERIES: dict[str, Query] = {
    "value_distribution": q_value_distribution,
    "value_share": q_value_share,
    "entities_per_value": q_entities_per_value,
    "rows_per_key_stats": q_rows_per_key_stats,
    "rows_per_key": q_rows_per_key,
    "count_present": q_count_present,
    "distinct_per_key_stats": q_distinct_per_key_stats,
    "rows_per_key_median": q_rows_per_key_median,
    "class_distribution": q_class_distribution,
    "event_share": q_event_share,
    "event_rate": q_event_rate,
    "rows_per_key_topk": q_rows_per_key_topk,
    "distinct_per_key_topk": q_distinct_per_key_topk,
    "distinct_frequency": q_distinct_frequency,
    "request_vs_usage": q_request_vs_usage,
    "request_vs_usage_mem": q_request_vs_usage_mem,
    "request_vs_usage_rdd": q_request_vs_usage_rdd,
    "most_over": q_most_over,
    "most_under": q_most_under,
    "most_over_mem": q_most_over_mem,
    "most_under_mem": q_most_under_mem,
    "delta_histogram": q_delta_histogram,
    "delta_histogram_mem": q_delta_histogram_mem,
    "request_usage_corr": q_request_usage_corr,
    "peak_vs_event": q_peak_vs_event,
    "peak_vs_event_int": q_peak_vs_event_int,
    "peak_event_corr": q_peak_event_corr,
    "peak_histogram": q_peak_histogram,
    "first_transition_delay": q_first_transition_delay,
    "positive_delays": q_positive_delays,
    "first_event_time": q_first_event_time,
    "constraints_per_job": q_constraints_per_job,
    "delay_constraints_corr": q_delay_constraints_corr,
    "event_keys": q_event_keys,
    "hash_sample": q_hash_sample,
    "seeded_sample": q_seeded_sample,
    "csv_round_trip": q_csv_round_trip,
    "line_scan": q_line_scan,
    "text_report": q_text_report,
    "sample_invariants": q_sample_invariants,
    "text_preview": q_text_preview,
    "rows_per_key_ascending": q_rows_per_key_ascending,
    "delays_by_constraints": q_delays_by_constraints,
    "task_delay_events": q_task_delay_events,
    "pending_intervals": q_pending_intervals,
    "waiting_per_job": q_waiting_per_job,
    "usage_at_event": q_usage_at_event,
    "event_peaks": q_event_peaks,
    "request_usage_rank_corr": q_request_usage_rank_corr,
    "delay_constraints_rank_corr": q_delay_constraints_rank_corr,
    "price_ranks": q_price_ranks,
    "exact_quantiles": q_exact_quantiles,
    "result_sample": q_result_sample,
    "quarantined_lines": q_quarantined_lines,
    "rows_beside_quarantine": q_rows_beside_quarantine,
    "ledger_summary": q_ledger_summary,
    "published_result": q_published_result,
    "merged_file_states": q_merged_file_states,
    "scatter_grid": q_scatter_grid,
}

OPERATORS: dict[str, str] = {
    "value_distribution": "J1 A1 F7 P1",
    "value_share": "V1 A1 A2 F5 F2",
    "entities_per_value": "X4 A5 F7",
    "rows_per_key_stats": "J2 A1 A7 A8s A8p F6 F2",
    "rows_per_key": "V4 A1",
    "count_present": "A4 P8",
    "distinct_per_key_stats": "X4 J2 A5 A7 A8s A8p F6",
    "rows_per_key_median": "X3 A1",
    "class_distribution": "J3 A16 A5 O1",
    "event_share": "J4 V7 P7 A1 A2 F5 F2 O1",
    "event_rate": "X1 A11 F5 O1",
    "rows_per_key_topk": "J5 A1 O2",
    "distinct_per_key_topk": "J5 A5 F7 O2",
    "distinct_frequency": "V5 A5 A3",
    "request_vs_usage": "J6 P8 F1 F2 A6 N1 F4",
    "request_vs_usage_mem": "J6 P8 F1 F2 A6 N1 F4",
    "request_vs_usage_rdd": "J6 (RDD rounding) F2 A6 N1",
    "most_over": "J6 O3",
    "most_under": "J6 O2",
    "most_over_mem": "J6 O3",
    "most_under_mem": "J6 O2",
    "delta_histogram": "V2",
    "delta_histogram_mem": "V2",
    "request_usage_corr": "X2",
    "peak_vs_event": "J7 A10 P10 N3 P7 F2",
    "peak_vs_event_int": "J7 (RDD rounding) A10 P10 N3",
    "peak_event_corr": "X2 J7 A10 A14",
    "peak_histogram": "V3",
    "first_transition_delay": "J8 V6 A9 F4 A6 A15 P9 P10 N1",
    "positive_delays": "J8d P11",
    "first_event_time": "J8a A9 P9",
    "constraints_per_job": "J8c A15 P10",
    "delay_constraints_corr": "X2 J8",
    "event_keys": "A14 P7",
    "hash_sample": "S4 A1",
    "seeded_sample": "S4",
    "csv_round_trip": "S1 S3 S5 S9",
    "line_scan": "S2 S3 S9 F3 F7 A1",
    "text_report": "S10",
    "sample_invariants": "S4 S4b S11",
    "text_preview": "S6 S8",
    "rows_per_key_ascending": "O4 O5 P13 A1",
    "delays_by_constraints": "O4 O6 J8",
    "task_delay_events": "N2 F8 O4 O6 J8b A1",
    "pending_intervals": "J8 J8b P9",
    "waiting_per_job": "J8 A11 A10",
    "usage_at_event": "J7 P7 P8",
    "event_peaks": "J7 A10 N1",
    "request_usage_rank_corr": "X2 J6",
    "delay_constraints_rank_corr": "X2 J8",
    "price_ranks": "X2 A1",
    "exact_quantiles": "X3 A7",
    "result_sample": "S4b",
    "quarantined_lines": "S1 S2 S3",
    "rows_beside_quarantine": "S1 S5 F3",
    "ledger_summary": "S1 A1 A2",
    "published_result": "S9",
    "merged_file_states": "A12 A5 S3 J3",
    "scatter_grid": "V6 J8",
}

# ------------------------------------------------------------------ SQL side

_FLAGS = "coalesce(CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END, 'NA')"
_J1 = f"SELECT {_FLAGS} AS l_returnflag, count(*) AS n_rows FROM lineitem GROUP BY 1"


def _stats_sql(sizes: str) -> str:
    return f"""
WITH s AS ({sizes}),
a AS (SELECT avg(CAST(n AS DOUBLE)) AS m, stddev_samp(CAST(n AS DOUBLE)) AS ss,
             stddev_pop(CAST(n AS DOUBLE)) AS sp, min(n) AS lo, max(n) AS hi FROM s)
SELECT {R('m', 2)} AS "mean", {R('ss', 2)} AS std_samp, {R('sp', 2)} AS std_pop,
       lo AS "min", hi AS "max",
       {R('least(greatest(m - sp, CAST(lo AS DOUBLE)), CAST(hi AS DOUBLE))', 2)} AS low_mean,
       {R('least(greatest(m + sp, CAST(lo AS DOUBLE)), CAST(hi AS DOUBLE))', 2)} AS high_mean
FROM a"""


def _j6_sql(req_table, req_key, req_expr, use_table, use_key, use_expr,
            mean_digits: int = 4, delta_digits: int = 2) -> str:
    return f"""
WITH rv AS (SELECT {req_key} AS job_id, {R(f'CAST({req_expr} AS DOUBLE) * 100.0', 4)} AS v
            FROM {req_table} WHERE ({req_expr}) IS NOT NULL),
r AS (SELECT job_id, {R('avg(v)', mean_digits)} AS request FROM rv GROUP BY 1),
uv AS (SELECT {use_key} AS job_id, {R(f'CAST({use_expr} AS DOUBLE) * 100.0', 4)} AS v
       FROM {use_table} WHERE ({use_expr}) IS NOT NULL),
u AS (SELECT job_id, {R('avg(v)', mean_digits)} AS usage FROM uv GROUP BY 1)
SELECT r.job_id AS job_id, request, usage, {R('request - usage', delta_digits)} AS delta
FROM r JOIN u ON r.job_id = u.job_id"""


_J6 = _j6_sql("orders", "o_custkey",
              "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice / 1000 END",
              "events", "user_id",
              "CASE WHEN event_type = 'error' THEN NULL ELSE value END")
_J6_RDD = _j6_sql("orders", "o_custkey",
                  "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice / 1000 END",
                  "events", "user_id",
                  "CASE WHEN event_type = 'error' THEN NULL ELSE value END",
                  mean_digits=3, delta_digits=4)
_J6_MEM = _j6_sql("customer", "c_nationkey",
                  "CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_acctbal / 100 END",
                  "supplier", "s_nationkey", "s_acctbal / 100")


def _hist_sql(source: str, col: str = "delta", bins: int = 10) -> str:
    lo, hi, step = "(SELECT lo FROM q)", "(SELECT hi FROM q)", "(SELECT step FROM q)"

    def edge(i: str) -> str:
        return f"(CASE WHEN {i} >= {bins} THEN {hi} ELSE CAST({i} AS DOUBLE) * {step} + {lo} END)"
    return f"""
WITH d AS ({source}),
rng AS (SELECT min({col}) AS lo0, max({col}) AS hi0 FROM d WHERE {col} IS NOT NULL),
p AS (SELECT CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo,
             CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM rng),
q AS (SELECT lo, hi, (hi - lo) / {float(bins)} AS step FROM p),
g AS (SELECT CAST({col} AS DOUBLE) AS x,
             least(CAST(floor((CAST({col} AS DOUBLE) - {lo}) / ({hi} - {lo}) * {float(bins)})
                        AS INTEGER), {bins - 1}) AS i0
      FROM d WHERE {col} IS NOT NULL),
g1 AS (SELECT x, CASE WHEN x < {edge('i0')} THEN i0 - 1 ELSE i0 END AS i1 FROM g),
g2 AS (SELECT CASE WHEN x >= {edge('i1 + 1')} AND i1 <> {bins - 1} THEN i1 + 1 ELSE i1 END AS bin
       FROM g1),
c AS (SELECT bin, count(*) AS n FROM g2 GROUP BY 1),
b AS (SELECT CAST(range AS INTEGER) AS bin FROM range({bins}))
SELECT b.bin AS bin, {edge('b.bin')} AS bin_lo, {edge('b.bin + 1')} AS bin_hi,
       coalesce(c.n, 0) AS n_rows
FROM b LEFT JOIN c ON b.bin = c.bin"""


_J7 = f"""
WITH p AS (SELECT l_orderkey AS job_id, {R(f"max({R('CAST(l_discount AS DOUBLE) * 100.0', 2)})", 2)} AS peak
           FROM lineitem WHERE l_discount IS NOT NULL GROUP BY 1)
SELECT job_id, peak FROM p
WHERE peak < 10.0 AND job_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')"""

_J7_INT = f"""
WITH p AS (SELECT l_orderkey AS job_id,
                  {_even(f"max({_even('CAST(l_discount AS DOUBLE) * 100.0', 0)})", 0)} AS peak
           FROM lineitem WHERE l_discount IS NOT NULL GROUP BY 1)
SELECT job_id, peak FROM p
WHERE peak < 10.0 AND job_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')"""

_J8_EVENTS = """
e AS (SELECT user_id AS job_id, event_id % 4 AS task_index, event_type, epoch_us(ts) AS t
      FROM events),
f AS (SELECT job_id, task_index,
             min(CASE WHEN event_type IN ('signup') THEN t END) AS s,
             min(CASE WHEN event_type IN ('click', 'purchase', 'error') THEN t END) AS x
      FROM e WHERE event_type IN ('signup', 'click', 'purchase', 'error') GROUP BY 1, 2),
d AS (SELECT job_id, task_index, CAST(x - s AS DOUBLE) / 1000000.0 AS delay
      FROM f WHERE s IS NOT NULL AND x IS NOT NULL)"""

_J8_CONS = """
c AS (SELECT job_id, avg(n) AS avg_constraints
      FROM (SELECT o_custkey AS job_id, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2)
      GROUP BY 1 HAVING avg(n) < 4)"""

_J8 = f"""
WITH {_J8_EVENTS},
ad AS (SELECT job_id, avg(delay) AS avg_delay FROM d GROUP BY 1),
{_J8_CONS}
SELECT ad.job_id AS job_id, {R('avg_delay', 3)} AS avg_delay,
       {R('avg_constraints', 3)} AS avg_constraints
FROM ad JOIN c ON ad.job_id = c.job_id"""

def _corr_sql(x: str, y: str) -> str:
    return (f"covar_pop({x}, {y}) / "
            f"nullif(stddev_pop({x}) * stddev_pop({y}), 0.0)")


_PERIODS = """
e AS (SELECT DISTINCT user_id AS job_id, event_id % 4 AS task_index, epoch_us(ts) AS t,
             CASE WHEN event_type = 'signup' THEN 0 ELSE 1 END AS kind
      FROM events WHERE event_type IN ('signup', 'click', 'purchase', 'error')),
g AS (SELECT *, coalesce(sum(kind) OVER (PARTITION BY job_id, task_index ORDER BY t, kind
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nth FROM e),
p AS (SELECT job_id, task_index, min(CASE WHEN kind = 0 THEN t END) AS start, max(CASE WHEN kind = 1 THEN t END) AS "end",
             count(CASE WHEN kind = 0 THEN t END) AS n_starts
      FROM g GROUP BY job_id, task_index, nth HAVING count(DISTINCT kind) = 2)"""

_USAGE_AT = """
u AS (SELECT user_id AS job_id, epoch_us(ts) AS start_time, epoch_us(ts) + 21600000000 AS end_time,
             max(value) AS maximum_cpu_rate
      FROM events WHERE event_type IN ('view', 'purchase') AND value IS NOT NULL GROUP BY 1, 2, 3),
v AS (SELECT user_id AS job_id, epoch_us(ts) AS "time" FROM events WHERE event_type = 'error'),
w AS (SELECT v.job_id AS job_id, v."time" AS "time", start_time, end_time, maximum_cpu_rate,
             coalesce(v."time" < end_time, false) AS inside
      FROM v ASOF LEFT JOIN u ON v.job_id = u.job_id AND v."time" >= u.start_time)"""


def _ranks_sql(source: str, x: str, y: str) -> str:
    def rank(c):
        return f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0"
    return f"SELECT CAST({rank(x)} AS DOUBLE) AS x, CAST({rank(y)} AS DOUBLE) AS y FROM ({source})"


def _sample_sql(source: str, keys: list[str], seed: int, order: str, k: str, columns: str = "s.*") -> str:
    text = ", ".join(f"CAST({c} AS VARCHAR)" for c in keys)
    return f"""
WITH s AS ({source}),
h AS (SELECT s.*, CAST('0x' || substr(md5(concat_ws('|', '{seed}', {text})), 1, 15) AS BIGINT) AS h FROM s),
r AS (SELECT *, row_number() OVER (ORDER BY h, {order}) AS place FROM h)
SELECT {columns} FROM r AS s WHERE place <= {k}"""


_LINEITEM = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, " \
            "l_returnflag, l_linestatus, l_shipdate"

# What a line of the faulty files holds, and what is wrong with it, by line number.
_FAULTY = """
l AS (SELECT *, CASE WHEN l_linenumber % 5 = 2 THEN 'x' ELSE '' END || l_orderkey || ',' || l_partkey || ',' || l_linenumber AS start,
             l_returnflag || ', ' || l_linestatus AS name, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS q FROM lineitem),
f AS (SELECT l_linenumber % 5 AS kind, CASE l_linenumber % 5 WHEN 0 THEN start WHEN 3 THEN start || ',"' || name
                  ELSE start || ',"' || name || '",' || l_returnflag || ',' || q || CASE l_linenumber % 5 WHEN 1 THEN ',spare' ELSE '' END
             END AS line,
             CASE l_linenumber % 5 WHEN 0 THEN 'too few fields' WHEN 1 THEN 'too many fields' WHEN 2 THEN 'time: not a bigint'
                  WHEN 3 THEN 'quote is not closed' END AS reasons FROM l)"""


def _grid_sql(source: str, x: str, y: str, max_cells: int, depth: int) -> str:
    def place(v, lo, hi):
        return f"""CASE WHEN {hi} > {lo} THEN least(CAST(floor(({v} / 2 - {lo} / 2) / ({hi} / 2 - {lo} / 2)
            * {float(1 << depth)}) AS INTEGER), {(1 << depth) - 1}) ELSE 0 END"""

    def edge(c, lo, hi, at):
        part = f"(({c} + {at}) / power(2.0, level))"
        return f"{lo} * (1.0 - {part}) + {hi} * {part}"
    return f"""
WITH s AS (SELECT CAST({x} AS DOUBLE) AS x, CAST({y} AS DOUBLE) AS y FROM ({source}) WHERE {x} IS NOT NULL AND {y} IS NOT NULL),
r AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, count(*) AS n FROM s),
c AS (SELECT {place('x', 'x0', 'x1')} AS ix, {place('y', 'y0', 'y1')} AS iy FROM s, r),
p AS (SELECT level, ix >> ({depth} - level) AS cx, iy >> ({depth} - level) AS cy, count(*) AS n
      FROM c, (SELECT CAST(range AS INTEGER) AS level FROM range({depth + 1})) GROUP BY ALL),
full_cell AS (SELECT p.* FROM p, r WHERE p.n > ceil({3.0 * depth} * r.n / {max_cells - 1}) AND level < {depth}),
leaf AS (SELECT p.* FROM p LEFT JOIN full_cell AS up ON up.level = p.level - 1 AND up.cx = p.cx >> 1 AND up.cy = p.cy >> 1
         WHERE (p.level = 0 OR up.level IS NOT NULL)
           AND NOT EXISTS (SELECT 1 FROM full_cell AS o WHERE o.level = p.level AND o.cx = p.cx AND o.cy = p.cy))
SELECT level, CAST(cx AS INTEGER) AS cx, CAST(cy AS INTEGER) AS cy, {edge('cx', 'x0', 'x1', 0)} AS x_lo,
       {edge('cx', 'x0', 'x1', 1)} AS x_hi, {edge('cy', 'y0', 'y1', 0)} AS y_lo, {edge('cy', 'y0', 'y1', 1)} AS y_hi,
       leaf.n AS n_rows FROM leaf, r"""


_CPUS = "CASE WHEN l_linenumber % 3 = 0 OR l_returnflag = 'N' THEN NULL ELSE l_returnflag END"

ORACLE_SQL: dict[str, str] = {
    "value_distribution": _J1,
    "value_share": f"""
WITH c AS ({_J1})
SELECT l_returnflag, n_rows,
       {R('CAST(n_rows AS DOUBLE) / CAST((SELECT sum(n_rows) FROM c) AS DOUBLE) * 100.0', 2)} AS pct
FROM c""",
    "entities_per_value": f"""
SELECT {_FLAGS} AS l_returnflag, count(DISTINCT l_orderkey) AS n_orders
FROM lineitem GROUP BY 1""",
    "rows_per_key_stats": _stats_sql("SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1"),
    "distinct_per_key_stats": _stats_sql(
        "SELECT l_orderkey, count(DISTINCT l_linenumber) AS n FROM lineitem GROUP BY 1"),
    "rows_per_key": "SELECT l_orderkey, count(*) AS n_rows FROM lineitem GROUP BY 1",
    "count_present": """
SELECT count(CASE WHEN l_suppkey = 0 THEN NULL ELSE l_suppkey END) AS n_present FROM lineitem""",
    "rows_per_key_median": """
SELECT CAST(median(n) AS DOUBLE) AS median_rows
FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)""",
    "class_distribution": """
SELECT l_returnflag, count(DISTINCT l_orderkey) AS n_jobs, count(*) AS n_tasks
FROM lineitem GROUP BY 1 ORDER BY 1""",
    "event_share": f"""
WITH c AS (SELECT TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority,
                  count(*) AS n_events
           FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT priority, n_events,
       {R('CAST(n_events AS DOUBLE) / CAST((SELECT sum(n_events) FROM c) AS DOUBLE)', 6)} AS prob
FROM c ORDER BY 1""",
    "event_rate": f"""
WITH c AS (SELECT TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority,
                  count(*) AS n_rows,
                  CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS n_events
           FROM orders GROUP BY 1)
SELECT priority, n_rows, n_events,
       {R('CAST(n_events AS DOUBLE) / CAST(n_rows AS DOUBLE)', 6)} AS rate
FROM c ORDER BY 1""",
    "rows_per_key_topk": """
SELECT l_partkey, count(*) AS n_rows FROM lineitem GROUP BY 1
ORDER BY n_rows DESC, l_partkey ASC LIMIT 10""",
    "distinct_per_key_topk": """
WITH m AS (SELECT l_partkey, CASE WHEN l_suppkey = 0 THEN NULL ELSE l_suppkey END AS s
           FROM lineitem)
SELECT l_partkey, count(DISTINCT s) + max(CASE WHEN s IS NULL THEN 1 ELSE 0 END) AS n_distinct
FROM m GROUP BY 1 ORDER BY n_distinct DESC, l_partkey ASC LIMIT 10""",
    "distinct_frequency": """
SELECT n_distinct, count(*) AS n_keys
FROM (SELECT l_partkey, count(DISTINCT l_suppkey) AS n_distinct FROM lineitem GROUP BY 1)
GROUP BY 1""",
    "request_vs_usage": _J6,
    "request_vs_usage_mem": _J6_MEM,
    "request_vs_usage_rdd": _J6_RDD,
    "most_over": f"SELECT * FROM ({_J6}) ORDER BY delta ASC, job_id ASC LIMIT 10",
    "most_under": f"SELECT * FROM ({_J6}) ORDER BY delta DESC, job_id ASC LIMIT 10",
    "most_over_mem": f"SELECT * FROM ({_J6_MEM}) ORDER BY delta ASC, job_id ASC LIMIT 10",
    "most_under_mem": f"SELECT * FROM ({_J6_MEM}) ORDER BY delta DESC, job_id ASC LIMIT 10",
    "delta_histogram": _hist_sql(_J6),
    "delta_histogram_mem": _hist_sql(_J6_MEM),
    "request_usage_corr": f"SELECT {R(_corr_sql('request', 'usage'), 6)} AS corr FROM ({_J6})",
    "peak_vs_event": _J7,
    "peak_vs_event_int": _J7_INT,
    "peak_event_corr": f"""
WITH p AS (SELECT l_orderkey AS job_id, {R(f"max({R('CAST(l_discount AS DOUBLE) * 100.0', 2)})", 2)} AS peak
           FROM lineitem WHERE l_discount IS NOT NULL GROUP BY 1),
k AS (SELECT DISTINCT o_orderkey AS job_id FROM orders WHERE o_orderstatus = 'F'),
j AS (SELECT p.peak AS peak, CASE WHEN k.job_id IS NULL THEN 0.0 ELSE 1.0 END AS had_event
      FROM p LEFT JOIN k ON p.job_id = k.job_id WHERE p.peak < 10.0)
SELECT {R(_corr_sql('peak', 'had_event'), 6)} AS corr FROM j""",
    "peak_histogram": f"""
SELECT CAST({R('peak', 0)} AS BIGINT) AS peak_int, count(*) AS n_keys
FROM ({_J7}) GROUP BY 1""",
    "first_transition_delay": _J8,
    "positive_delays": f"WITH {_J8_EVENTS} SELECT job_id, task_index, delay FROM d WHERE delay > 0",
    "first_event_time": """
SELECT user_id AS job_id, event_id % 4 AS task_index, min(epoch_us(ts)) AS first_time
FROM events WHERE event_type IN ('signup') GROUP BY 1, 2""",
    "constraints_per_job": f"""
WITH {_J8_CONS} SELECT job_id, {R('avg_constraints', 3)} AS avg_constraints FROM c""",
    "delay_constraints_corr": f"""
SELECT {R(_corr_sql('avg_constraints', 'avg_delay'), 6)} AS corr FROM ({_J8})""",
    "event_keys": "SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F'",
    "hash_sample": """
SELECT l_orderkey, count(*) AS n_rows FROM lineitem
WHERE substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 2) < '80' GROUP BY 1""",
    "csv_round_trip": f"""
SELECT l_orderkey AS "time", l_partkey AS machine_id, l_linenumber AS event_type,
       l_returnflag || ', ' || l_linestatus AS platform_id, {_CPUS} AS cpus,
       CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_discount END AS memory
FROM lineitem""",
    "line_scan": f"""
SELECT '"' || l_returnflag AS platform_a, coalesce({_CPUS}, 'NA') AS cpus, count(*) AS n_rows
FROM lineitem GROUP BY 1, 2""",
    "sample_invariants": """
SELECT true AS in_source, true AS repeatable, true AS share_ok, true AS result_in_source, true AS result_share_ok""",
    "text_preview": f"""
WITH c AS ({_J1}),
w AS (SELECT CAST(greatest(12, max(length(l_returnflag))) AS INTEGER) AS a,
             CAST(greatest(6, max(length(CAST(n_rows AS VARCHAR)))) AS INTEGER) AS b FROM c),
bar AS (SELECT '+' || repeat('-', a) || '+' || repeat('-', b) || '+' AS line FROM w),
body AS (SELECT row_number() OVER (ORDER BY l_returnflag) AS n,
                '|' || lpad(l_returnflag, a, ' ') || '|' || lpad(CAST(n_rows AS VARCHAR), b, ' ') || '|' AS line
         FROM c, w),
head AS (SELECT '|' || lpad('l_returnflag', a, ' ') || '|' || lpad('n_rows', b, ' ') || '|' AS line FROM w)
SELECT CAST(line_no AS INTEGER) AS line_no, line FROM (
    SELECT 0 AS line_no, line FROM bar UNION ALL SELECT 1, line FROM head UNION ALL SELECT 2, line FROM bar
    UNION ALL SELECT n + 2, line FROM body UNION ALL SELECT (SELECT count(*) FROM body) + 3, line FROM bar)""",
    "rows_per_key_ascending": """
SELECT count(*) AS n_rows, l_partkey FROM lineitem GROUP BY 2 ORDER BY n_rows, l_partkey LIMIT 20""",
    "delays_by_constraints": f"SELECT * FROM ({_J8}) ORDER BY avg_constraints DESC, job_id LIMIT 20",
    "task_delay_events": f"""
WITH {_J8_EVENTS},
n AS (SELECT job_id, task_index, count(*) AS n_events FROM e GROUP BY 1, 2)
SELECT d.job_id AS job_id, d.task_index AS task_index, delay, n_events,
       d.job_id || '/' || d.task_index AS task_key, CAST(d.task_index AS VARCHAR) AS task_text
FROM d JOIN n ON d.job_id = n.job_id AND d.task_index = n.task_index
ORDER BY n_events DESC, d.job_id, d.task_index LIMIT 20""",
    "text_report": f"SELECT printf('%s: %d rows', l_returnflag, n_rows) AS line FROM ({_J1})",
    "seeded_sample": _sample_sql("SELECT * FROM lineitem", _SAMPLE_KEYS, 42, _LINEITEM,
                                 "(SELECT floor(0.2 * count(*) + 0.5) FROM lineitem)", _LINEITEM),
    "result_sample": _sample_sql(_J6, ["job_id"], 7, "job_id", "100", f"""job_id, request, usage, delta,
        CAST((SELECT count(*) FROM s) AS DOUBLE) / least(100, (SELECT count(*) FROM s)) AS weight""").replace(
        "FROM r AS s WHERE", "FROM r WHERE"),
    "pending_intervals": f"""
WITH {_PERIODS} SELECT job_id, task_index, start, "end", n_starts, CAST("end" - start AS DOUBLE) / 1000000.0 AS delay FROM p""",
    "waiting_per_job": f"""
WITH {_PERIODS},
t AS (SELECT job_id, task_index, count(*) AS n, sum("end" - start) AS s, max("end" - start) AS m FROM p GROUP BY 1, 2)
SELECT job_id, count(*) AS n_tasks, CAST(sum(n) AS BIGINT) AS n_periods, CAST(sum(n - 1) AS BIGINT) AS n_again,
       CAST(sum(s) AS BIGINT) AS total_wait, max(m) AS longest_wait FROM t GROUP BY 1""",
    "usage_at_event": f"WITH {_USAGE_AT} SELECT * FROM w",
    "event_peaks": f"""
WITH {_USAGE_AT},
a AS (SELECT job_id, count(*) AS n_events, count(CASE WHEN inside THEN 1 END) AS n_inside,
             max(CASE WHEN inside THEN maximum_cpu_rate END) AS event_peak FROM w GROUP BY 1),
m AS (SELECT job_id, max(maximum_cpu_rate) AS peak FROM u GROUP BY 1)
SELECT a.*, peak FROM a LEFT JOIN m ON a.job_id = m.job_id""",
    "request_usage_rank_corr": f"""
SELECT {R(_corr_sql('x', 'y'), 6)} AS rank_corr FROM ({_ranks_sql(_J6, 'request', 'usage')})""",
    "delay_constraints_rank_corr": f"""
SELECT {R(_corr_sql('x', 'y'), 6)} AS rank_corr FROM ({_ranks_sql(_J8, 'avg_constraints', 'avg_delay')})""",
    "price_ranks": """
SELECT l_extendedprice, n, CAST(sum(n) OVER (ORDER BY l_extendedprice) AS DOUBLE) - (n - 1) / 2.0 AS rank
FROM (SELECT l_extendedprice, count(*) AS n FROM lineitem GROUP BY 1)""",
    "exact_quantiles": " UNION ALL ".join(
        f"SELECT CAST({p} AS DOUBLE) AS prob, {R(f'quantile_cont(l_extendedprice, {p})', 6)} AS value FROM lineitem"
        for p in _QUANTILES),
    "quarantined_lines": f"WITH {_FAULTY} SELECT line, reasons FROM f WHERE kind < 4",
    "rows_beside_quarantine": """
SELECT l_orderkey AS "time", l_partkey AS machine_id, l_linenumber AS event_type,
       l_returnflag || ', ' || l_linestatus AS platform_id, l_returnflag AS cpus, floor(l_quantity) AS memory
FROM lineitem WHERE l_linenumber % 5 = 4""",
    "ledger_summary": f"""
WITH {_FAULTY} SELECT reason, count(*) AS n_lines
FROM (SELECT unnest(string_split(coalesce(reasons, 'ok'), '; ')) AS reason FROM f) GROUP BY 1
UNION ALL SELECT 'ok', 0 WHERE NOT EXISTS (SELECT 1 FROM f WHERE kind = 4)""",
    "published_result": _J1,
    "merged_file_states": """
SELECT l_returnflag, count(DISTINCT l_orderkey) AS n_jobs, count(*) AS n_tasks FROM lineitem GROUP BY 1""",
    "scatter_grid": _grid_sql(_J8, "avg_constraints", "avg_delay", 200, 6),
}
