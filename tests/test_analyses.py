"""The eight analyses on the hand-made trace (see conftest for the rows)."""

from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tracelens.plans import analyses as A
from tracelens.sources.published import read_published
from tracelens.sources.readers import read_trace_table

BIG = 3000000000


def test_j1_value_distribution_counts_events(trace):
    got = rows(A.value_distribution(trace["machine_events"]))
    # machine 1 has two events: rows are counted, not machines; missing -> NA
    assert got == [("0.5", 3), ("1", 1), ("NA", 1)]
    share = {r.cpus: r.pct for r in A.value_share(trace["machine_events"]).collect()}
    assert share == {"0.5": 60.0, "1": 20.0, "NA": 20.0}
    ent = rows(A.entities_per_value(trace["machine_events"]))
    assert ent == [("0.5", 2), ("1", 1), ("NA", 1)]


def test_j2_rows_per_key_stats(trace):
    r = A.rows_per_key_stats(trace["task_events"], digits=None).collect()[0]
    sizes = np.array([6, 3, 3, 1], dtype=float)  # jobs 1, BIG, 4, 5
    assert r["mean"] == pytest.approx(sizes.mean())
    assert r["std_samp"] == pytest.approx(sizes.std(ddof=1))
    assert r["std_pop"] == pytest.approx(sizes.std())
    assert (r["min"], r["max"]) == (1, 6)
    assert r["low_mean"] == pytest.approx(max(sizes.mean() - sizes.std(), 1))
    assert r["high_mean"] == pytest.approx(min(sizes.mean() + sizes.std(), 6))
    med = A.rows_per_key_median(trace["task_events"]).collect()[0][0]
    assert med == 3.0
    tasks = A.rows_per_key_stats(trace["task_events"], entity="task_index").collect()[0]
    assert (tasks["min"], tasks["max"]) == (1, 2)


def test_j3_class_distribution_ordered_numerically(trace):
    got = [tuple(r) for r in A.class_distribution(trace["task_events"]).collect()]
    assert got == [(0, 1, 6), (1, 1, 3), (2, 1, 3), (None, 1, 1)]


def test_j4_event_share_and_rate(trace):
    got = [tuple(r) for r in A.event_share(trace["task_events"]).collect()]
    assert got == [(0, 1, 0.25), (1, 2, 0.5), (9, 1, 0.25)]
    rate = {r.priority: (r.n_rows, r.n_events, r.rate)
            for r in A.event_rate(trace["task_events"]).collect()}
    assert rate[0] == (6, 1, round(1 / 6, 6))
    assert rate[1] == (3, 2, round(2 / 3, 6))
    assert rate[9] == (3, 1, round(1 / 3, 6))
    assert rate[None] == (1, 0, 0.0)


def test_j5_rows_and_distinct_machines(trace):
    top = [tuple(r) for r in A.rows_per_key_topk(trace["task_events"], k=2).collect()]
    assert top == [(1, 6), (4, 3)]  # tie of 3 rows broken by the smaller key
    d = [tuple(r) for r in A.distinct_per_key_topk(trace["task_events"], k=10).collect()]
    # the missing machine of job BIG counts as one machine ('NA' semantics)
    assert d == [(1, 2), (4, 2), (BIG, 2), (5, 1)]
    freq = rows(A.distinct_frequency(trace["task_events"]))
    assert freq == [(0, 1), (1, 1), (2, 2)]  # job 5 has no machine at all


def test_j6_request_vs_usage(trace):
    res = A.request_vs_usage(trace["task_events"], trace["task_usage"])
    got = rows(res, "job_id", "request", "usage", "delta")
    # job 1: requests 50,50,50,30,30,30 -> 40; usage 20, 40 -> 30.
    # job 4: request 20; usage 5.  BIG has no request, 6 no request, 5 no usage.
    assert got == [(1, 40.0, 30.0, 10.0), (4, 20.0, 5.0, 15.0)]
    assert [r.job_id for r in A.most_over(res, 1).collect()] == [1]
    assert [r.job_id for r in A.most_under(res, 1).collect()] == [4]
    hist = A.delta_histogram(res, 10).orderBy("bin").collect()
    assert [r.n_rows for r in hist] == list(np.histogram([10.0, 15.0], bins=10)[0])
    mem = A.request_vs_usage(trace["task_events"], trace["task_usage"],
                             request_col="memory_request",
                             usage_col="canonical_memory_usage")
    assert rows(mem, "job_id", "delta") == [(1, 12.5), (4, 0.0), (BIG, 0.0)]  # 22.5 - 10


def test_j7_peaks_of_evicted_jobs(trace):
    df = A.peak_vs_event(trace["task_usage"], trace["task_events"])
    # 99.4 and 99.6 stay below 100; job 4 peaks at 100; job 6 was never evicted
    assert rows(df) == [(1, 99.4), (BIG, 99.6)]
    rdd_like = A.peak_vs_event(trace["task_usage"], trace["task_events"], digits=0)
    assert rows(rdd_like) == [(1, 99.0)]
    assert rows(A.peak_histogram(df)) == [(99, 1), (100, 1)]


def test_j8_first_transition_delay(trace):
    delays = rows(A.pending_delays(trace["task_events"]))
    assert delays == [(1, 0, 5), (1, 1, 21), (BIG, 0, -10)]
    assert rows(A.positive_pending_delays(trace["task_events"])) == [(1, 0, 5), (1, 1, 21)]
    res = rows(A.first_transition_delay(trace["task_events"], trace["task_constraints"]))
    # job BIG averages 60 constraints per task (>= 50), job 4 never left PENDING
    assert res == [(1, 13.0, 3.0)]
    cons = rows(A.constraints_per_job(trace["task_constraints"]))
    assert cons == [(1, 3.0), (4, 1.0)]
    loose = A.first_transition_delay(trace["task_events"], trace["task_constraints"],
                                     max_constraints=100)
    assert rows(loose) == [(1, 13.0, 3.0), (BIG, -10.0, 60.0)]
    corr = A.delay_constraints_corr(loose).collect()[0][0]
    assert corr == pytest.approx(-1.0)


def test_analyses_on_empty_input(spark, trace_dir):
    from tracelens.sources.readers import read_trace_table

    empty = read_trace_table(spark, "task_events", f"{trace_dir}/empty")
    assert A.value_distribution(empty, "user").count() == 0
    assert A.class_distribution(empty).count() == 0
    assert A.event_share(empty).count() == 0
    assert A.first_transition_delay(empty, empty.select("job_id", "task_index")).count() == 0
    hist = A.delta_histogram(empty.selectExpr("cpu_request AS delta")).collect()
    assert len(hist) == 10 and all(r.n_rows == 0 for r in hist)


def test_jobs_runner_writes_every_result(spark, trace_dir):
    from tracelens.plans.jobs import JOBS, run_job
    from tracelens.session import shared_dir

    out = shared_dir(spark, "jobs")
    for name in sorted(JOBS):
        paths = run_job(spark, name, trace_dir, out)
        assert "report" in paths
        report = spark.read.parquet(paths["report"]).where(F.col("job") == name)
        assert {r.result for r in report.collect()} == set(paths) - {"report"}
    per_job = A.pair_result(read_published(spark, f"{out}/job6/per_job"), "cpu")
    assert rows(per_job, "job_id", "delta") == [(1, 10.0), (4, 15.0)]
    j8 = rows(read_published(spark, f"{out}/job8/delay_vs_constraints"))
    assert j8 == [(1, 13.0, 3.0)]
    deltas = read_published(spark, f"{out}/job6/cpu_deltas")
    assert rows(deltas, "job_id", "delta") == [(1, 10.0), (4, 15.0)]
    me, te = (read_trace_table(spark, t, f"{trace_dir}/{t}") for t in ("machine_events", "task_events"))
    for path, want in (("job1/cpus", A.value_distribution(me)), ("job1/cpus_share", A.value_share(me)),
                       ("job1/machines_per_cpus", A.entities_per_value(me)),
                       ("job4/evictions_by_priority", A.event_share(te)), ("job4/eviction_rate", A.event_rate(te))):
        assert rows(read_published(spark, f"{out}/{path}"), *want.columns) == rows(want), path


def test_infinite_and_nan_requests_agree_on_both_paths(spark):
    nan, inf = float("nan"), float("inf")
    req = spark.createDataFrame([(1, nan), (1, 0.5), (2, inf), (3, 1e31), (4, 0.25), (5, None)], "job_id long, cpu_request double")
    use = spark.createDataFrame([(i, 0.1) for i in range(1, 6)], "job_id long, cpu_rate double")
    single = A.request_vs_usage(req, use)
    pairs = A.pair_result(A.request_vs_usage_pairs(req, use, [("cpu", "cpu_request", "cpu_rate")]), "cpu")
    as_text = lambda df: sorted(str(tuple(r)) for r in df.collect())
    assert as_text(single) == as_text(pairs) and single.count() == 4
    assert "(1, nan, 10.0, nan)" in as_text(single) and "(2, inf, 10.0, inf)" in as_text(single)


def test_micros_do_not_depend_on_the_session_zone(spark):
    from tracelens.plans.bindings import micros

    df = spark.sql("SELECT CAST(x AS timestamp_ntz) AS ts FROM VALUES ('2024-03-10 02:30:00'), "
                   "('2024-03-10 03:30:00.000001'), ('1969-12-31 23:59:59.5') AS t(x)")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert sorted(r[0] for r in df.select(micros("ts")).collect()) == \
                [-500_000, 1_710_037_800_000_000, 1_710_041_400_000_001]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_peaks_are_rounded_once_per_key(trace):
    from conftest import plan_text

    plan = plan_text(A.peak_vs_event(trace["task_usage"], trace["task_events"]))
    scan = plan[plan.index("partial_max("):]
    assert "decimal" not in scan.split("Exchange")[0]
    with pytest.raises(ValueError):
        A.peak_vs_event(trace["task_usage"], trace["task_events"], factor=-1.0)


def test_ingest_then_parquet_jobs_match_csv_jobs(spark, trace_dir):
    from tracelens.plans.jobs import ingest, run_job
    from tracelens.sources.readers import read_ingested_table
    from tracelens.session import shared_dir

    tables = ["machine_events", "task_events", "task_usage", "task_constraints"]
    pq_root = shared_dir(spark, "ingested")
    ingest(spark, trace_dir, pq_root, tables)
    te = read_ingested_table(spark, "task_events", f"{pq_root}/task_events")
    assert te.count() == 13 and te.schema["job_id"].dataType.simpleString() == "bigint"
    out_csv, out_pq = shared_dir(spark, "jobs-csv"), shared_dir(spark, "jobs-pq")
    for job in ["job4", "job6", "job8"]:
        a = run_job(spark, job, trace_dir, out_csv)
        b = run_job(spark, job, pq_root, out_pq, input_format="parquet")
        for key in a:
            if key != "report":
                assert rows(spark.read.parquet(a[key])) == rows(spark.read.parquet(b[key])), key


def test_reference_variant_parameters(trace):
    # Variant of J6 that rounds means to 3 and deltas to 4 digits.
    res = A.request_vs_usage(trace["task_events"], trace["task_usage"], mean_digits=3,
                             delta_digits=4)
    assert rows(res, "job_id", "delta") == [(1, 10.0), (4, 15.0)]
    # J5 counting rows (not distinct machines), top 5.
    assert [tuple(r) for r in A.rows_per_key_topk(trace["task_events"], k=5).collect()] == [
        (1, 6), (4, 3), (BIG, 3), (5, 1)]
    # approximate distinct counts agree on small inputs
    exact = [tuple(r) for r in A.class_distribution(trace["task_events"]).collect()]
    approx = [tuple(r) for r in A.class_distribution(trace["task_events"], approx=True).collect()]
    assert exact == approx


def test_ingested_events_prune_by_event_type(spark, trace_dir):
    from conftest import plan_text
    from tracelens.plans.jobs import ingest
    from tracelens.session import shared_dir
    from tracelens.sources.readers import read_ingested_table, read_trace_table

    root = shared_dir(spark, "ingested-pruning")
    ingest(spark, trace_dir, root, ["task_events"])
    te = read_ingested_table(spark, "task_events", f"{root}/task_events")
    csv = read_trace_table(spark, "task_events", f"{trace_dir}/task_events")
    assert te.columns == csv.columns
    assert rows(te) == rows(csv)  # null event codes survive the partitioned layout
    plan = plan_text(A.event_share(te))
    assert "PartitionFilters: [isnotnull(event_type" in plan and "(event_type#" in plan
    assert rows(A.event_share(te)) == rows(A.event_share(csv))
    assert rows(A.pending_delays(te)) == rows(A.pending_delays(csv))
    j8 = plan_text(A.pending_delays(te))
    assert re.search(r"PartitionFilters: \[[^\]]*event_type#\d+ IN \(0,1,3,5,6\)", j8)


def test_jobs_share_one_scan_but_match_the_analyses(spark, trace_dir, trace):
    from tracelens.plans.jobs import run_job
    from tracelens.session import shared_dir

    out = shared_dir(spark, "jobs-shared")
    te = trace["task_events"]
    p2 = run_job(spark, "job2", trace_dir, out)
    assert rows(spark.read.parquet(p2["tasks_per_job"])) == rows(A.rows_per_key_stats(te))
    assert rows(spark.read.parquet(p2["distinct_tasks_per_job"])) == rows(
        A.rows_per_key_stats(te, entity="task_index"))
    assert rows(spark.read.parquet(p2["median_tasks_per_job"])) == rows(A.rows_per_key_median(te))
    p5 = run_job(spark, "job5", trace_dir, out)
    assert rows(spark.read.parquet(p5["machines_per_job_top"])) == rows(
        A.distinct_per_key_topk(te, "job_id", "machine_id"))
    assert rows(spark.read.parquet(p5["rows_per_job_top"])) == rows(A.rows_per_key_topk(te))
    assert rows(spark.read.parquet(p5["machines_per_job_frequency"])) == rows(
        A.distinct_frequency(te, "job_id", "machine_id"))


def test_request_vs_usage_pairs_equal_single_runs(trace):
    te, tu = trace["task_events"], trace["task_usage"]
    both = A.request_vs_usage_pairs(te, tu, [("cpu", "cpu_request", "cpu_rate"),
                                             ("mem", "memory_request", "canonical_memory_usage")])
    assert rows(A.pair_result(both, "cpu")) == rows(A.request_vs_usage(te, tu))
    assert rows(A.pair_result(both, "mem")) == rows(A.request_vs_usage(
        te, tu, request_col="memory_request", usage_col="canonical_memory_usage"))


def test_job8_results_match_the_analyses(spark, trace_dir, trace):
    from tracelens.plans.jobs import run_job
    from tracelens.session import shared_dir

    p = run_job(spark, "job8", trace_dir, shared_dir(spark, "jobs-j8"))
    te, tc = trace["task_events"], trace["task_constraints"]
    assert rows(spark.read.parquet(p["positive_delays"])) == rows(A.positive_pending_delays(te))
    corr = spark.read.parquet(p["corr"]).collect()[0][0]
    assert corr == A.delay_constraints_corr(A.first_transition_delay(te, tc)).collect()[0][0]


def test_peak_event_corr(trace):
    # peaks below 100: job 1 99.4 (evicted), BIG 99.6 (evicted), 6 50.0 (never); job 4 is at 100
    got = A.peak_event_corr(trace["task_usage"], trace["task_events"]).collect()[0][0]
    x, y = np.array([99.4, 99.6, 50.0]), np.array([1.0, 1.0, 0.0])
    assert got == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-6)


def test_jobs_cli(spark, trace_dir, capsys):
    from tracelens.plans.jobs import main
    from tracelens.session import shared_dir

    pq, out = shared_dir(spark, "cli-pq"), shared_dir(spark, "cli-out")
    main(["ingest", "--trace", trace_dir, "--out", pq,
          "--tables", "machine_events,task_events,task_usage,task_constraints"])
    main(["job4", "--trace", pq, "--input-format", "parquet", "--out", out,
          "--shuffle-partitions", "8"])
    printed = capsys.readouterr().out
    assert "evictions_by_priority\t" in printed and "report\t" in printed
    got = rows(read_published(spark, f"{out}/job4/evictions_by_priority"), "priority", "n_events")
    assert got == [(0, 1), (1, 2), (9, 1)]


def test_job7_results_match_the_analyses(spark, trace_dir, trace):
    from tracelens.plans.jobs import run_job
    from tracelens.session import shared_dir

    p = run_job(spark, "job7", trace_dir, shared_dir(spark, "jobs-j7"))
    tu, te = trace["task_usage"], trace["task_events"]
    assert rows(spark.read.parquet(p["peaks"])) == rows(A.peak_vs_event(tu, te))
    assert rows(spark.read.parquet(p["peak_histogram"])) == rows(
        A.peak_histogram(A.peak_vs_event(tu, te)))
    got = spark.read.parquet(p["peak_event_corr"]).collect()[0][0]
    assert got == A.peak_event_corr(tu, te).collect()[0][0]
