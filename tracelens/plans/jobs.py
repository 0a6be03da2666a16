"""Run the eight analyses on a cluster trace laid out as one folder per table.

    python -m tracelens.plans.jobs job6 --trace <root> --out <root> [--sample 0.5]

``<trace>/<table>/`` holds the header-less CSV part files of each table
(any Hadoop file system URI).  Every result is written whole by the
executors and then published at ``<out>/<job>/<result>/`` (parquet by default;
``sources.published.read_published`` reads it, also while the next run is
writing); each run appends its time and the first rows of each result to the
table ``<out>/reports/``.

Results that several others are derived from (the per-job tables of J2,
J5, J6 and J7, J8's per-task delays and pairs) are written once and read back, so the
big tables are scanned once per job and the derived results carry no long
lineage.
"""

from __future__ import annotations

import argparse
import time
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelens.functions.missing import label_missing
from tracelens.operators.counting import distinct_and_rows, frequency_of_counts
from tracelens.operators.histogram import scatter_grid
from tracelens.operators.ordering import sort_by, top_k
from tracelens.operators.shares import share_of_total
from tracelens.operators.stats import exact_median, summary_stats
from tracelens.operators.transitions import positive_delays
from tracelens.plans import analyses as A
from tracelens.session import build_session
from tracelens.sources.published import publish, published_version, read_published
from tracelens.sources.readers import ingest_trace_table, read_ingested_table, read_trace_table
from tracelens.sources.schemas import TABLES
from tracelens.sources.sinks import render_table, write_report

Tables = Callable[[str], DataFrame]


class Written(NamedTuple):
    """A result that is already in its place."""

    df: DataFrame
    path: str


Results = dict[str, DataFrame | Written]


def _persisted(spark: SparkSession, df: DataFrame, path: str, fmt: str) -> Written:
    """Publish ``df`` at ``path`` and read it back; the path returned is that of this version's files."""
    found = published_version(spark, path, publish(df, path, fmt))
    return Written(read_published(spark, path, found["number"]), f"{path}/versions/{found['version']}")


def job1(spark, t: Tables, out: str, fmt: str) -> Results:
    # One pass over machine_events: rows and distinct machines per value.
    me = t("machine_events").withColumn("cpus", label_missing("cpus"))
    per_value = _persisted(spark, distinct_and_rows(
        me, "cpus", "machine_id", distinct_name="n_entities", rows_name="n_rows"), f"{out}/per_value", fmt)
    rows = per_value.df.select("cpus", "n_rows")
    return {"per_value": per_value, "cpus": rows,
            "cpus_share": share_of_total(rows, "n_rows", name="pct", digits=2, percent=True),
            "machines_per_cpus": per_value.df.select("cpus", "n_entities")}


def job2(spark, t, out, fmt):
    # One pass over task_events: rows and distinct tasks per job, persisted;
    # the three results are read from that per-job table.
    per_job = _persisted(spark, t("task_events").groupBy("job_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("task_index").alias("n_tasks")),
        f"{out}/per_job", fmt)
    sizes = per_job.df
    return {"per_job": per_job, "tasks_per_job": summary_stats(sizes, "n_rows", digits=2),
            "distinct_tasks_per_job": summary_stats(sizes, "n_tasks", digits=2),
            "median_tasks_per_job": exact_median(sizes, "n_rows", "median_rows")}


def job3(spark, t, out, fmt):
    return {"per_class": A.class_distribution(t("task_events"))}


def job4(spark, t, out, fmt):
    # Rows and evictions per priority in one pass; the shares of all evictions come from them.
    rate = _persisted(spark, A.event_rate(t("task_events")), f"{out}/eviction_rate", fmt)
    evicted = rate.df.where("n_events > 0").select("priority", "n_events")
    return {"eviction_rate": rate, "evictions_by_priority": sort_by(
        share_of_total(evicted, "n_events", name="prob", digits=6), "priority")}


def job5(spark, t, out, fmt):
    # One pass over task_events: rows, distinct machines and whether a
    # machine is missing, per job; the three results come from that table.
    m = F.col("machine_id")
    per_job = _persisted(spark, t("task_events").groupBy("job_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(m).alias("n_known"),
        F.max(F.when(m.isNull(), F.lit(1)).otherwise(F.lit(0))).alias("has_missing")),
        f"{out}/per_job", fmt)
    sizes = per_job.df
    with_missing = sizes.select("job_id", (F.col("n_known") + F.col("has_missing"))
                                  .alias("n_distinct"))
    return {"per_job": per_job, "machines_per_job_top": top_k(with_missing, "n_distinct", 10, tie_break="job_id"),
            "rows_per_job_top": top_k(sizes.select("job_id", "n_rows"), "n_rows", 10,
                                      tie_break="job_id"),
            "machines_per_job_frequency": frequency_of_counts(
                sizes.select(F.col("n_known").alias("n_distinct")), "n_distinct", "n_keys")}


def job6(spark, t, out, fmt):
    # CPU and memory in one pass over each table, joined once and persisted;
    # every result below reads that per-job table.
    per_job = _persisted(spark, A.request_vs_usage_pairs(
        t("task_events"), t("task_usage"),
        [("cpu", "cpu_request", "cpu_rate"), ("mem", "memory_request", "canonical_memory_usage")]),
        f"{out}/per_job", fmt)
    results: Results = {"per_job": per_job}
    for kind in ["cpu", "mem"]:
        pair = A.pair_result(per_job.df, kind)
        results[f"{kind}_deltas"] = pair
        results[f"{kind}_most_over"] = A.most_over(pair)
        results[f"{kind}_most_under"] = A.most_under(pair)
        results[f"{kind}_delta_histogram"] = A.delta_histogram(pair)
        results[f"{kind}_corr"] = A.request_usage_corr(pair)
        results[f"{kind}_rank_corr"] = A.request_usage_rank_corr(pair)
    return results


def job7(spark, t, out, fmt):
    # Peak and eviction flag per job from one pass over each table; the
    # evicted jobs' peaks and the correlation are both read from it.
    table = _persisted(spark, A.peak_table(t("task_usage"), t("task_events")),
                       f"{out}/per_job", fmt)
    peaks = A.peaks_of(table.df)
    at_event = _persisted(spark, A.event_peaks(t("task_usage"), t("task_events")), f"{out}/event_peaks", fmt)
    return {"event_peaks": at_event, "per_job": table, "peaks": peaks, "peak_histogram": A.peak_histogram(peaks),
            "peak_event_corr": A.peak_corr_of(table.df)}


def job8(spark, t, out, fmt):
    # Delays per (job, task) computed once from task_events and persisted;
    # the per-job pairs and the positive delays are both read from them.
    periods = _persisted(spark, A.pending_intervals(t("task_events")), f"{out}/periods", fmt)
    delays = _persisted(spark, A.pending_delays(t("task_events")), f"{out}/delays", fmt)
    res = _persisted(spark, A.delay_vs_constraints(delays.df, t("task_constraints")),
                     f"{out}/delay_vs_constraints", fmt)
    return {"delay_vs_constraints": res, "delays": delays, "corr": A.delay_constraints_corr(res.df),
            "positive_delays": positive_delays(delays.df), "periods": periods,
            "waiting_per_job": A.waiting_per_job(periods.df),
            "rank_corr": A.delay_constraints_rank_corr(res.df),
            "scatter": scatter_grid(res.df, "avg_constraints", "avg_delay")}


JOBS = {"job1": job1, "job2": job2, "job3": job3, "job4": job4,
        "job5": job5, "job6": job6, "job7": job7, "job8": job8}


def ingest(spark: SparkSession, trace_root: str, out_root: str,
           tables: list[str] | None = None, quarantine: str | None = None) -> dict[str, str]:
    """Convert the trace's CSV tables to parquet below ``out_root`` (one folder each).

    With ``quarantine`` malformed lines go to a folder each below that root, with file and reasons.
    """
    root, out = trace_root.rstrip("/"), out_root.rstrip("/")
    return {t: ingest_trace_table(spark, t, f"{root}/{t}", f"{out}/{t}",
                                  quarantine=f"{quarantine.rstrip('/')}/{t}" if quarantine else None)
            for t in (tables or sorted(TABLES))}


def run_job(spark: SparkSession, name: str, trace_root: str, out_root: str, *,
            sample: float | None = None, seed: int = 42, fmt: str = "parquet",
            preview_rows: int = 20, input_format: str = "csv") -> dict[str, str]:
    """Run one job end to end; returns result name -> written path.

    ``input_format='parquet'`` reads tables written by ``ingest``.
    """
    if name not in JOBS:
        raise ValueError(f"unknown job {name!r}; known: {sorted(JOBS)}")
    root = trace_root.rstrip("/")
    out = f"{out_root.rstrip('/')}/{name}"

    def tables(table: str) -> DataFrame:
        if input_format == "parquet":
            return read_ingested_table(spark, table, f"{root}/{table}", sample=sample, seed=seed)
        return read_trace_table(spark, table, f"{root}/{table}", sample=sample, seed=seed)

    t0 = time.time()
    results = JOBS[name](spark, tables, out, fmt)
    paths, previews = {}, {}
    for key, result in results.items():
        if not isinstance(result, Written):
            result = _persisted(spark, result, f"{out}/{key}", fmt)
        paths[key] = result.path
        previews[key] = render_table(result.df, preview_rows)
    paths["report"] = write_report(spark, f"{out_root.rstrip('/')}/reports", name,
                                   round(time.time() - t0, 2), previews)
    return paths


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("job", choices=sorted(JOBS) + ["ingest"],
                   help="a job, or 'ingest' to convert the trace CSVs to parquet under --out")
    p.add_argument("--trace", required=True, help="root folder with one sub-folder per table")
    p.add_argument("--out", required=True, help="output root on shared storage")
    p.add_argument("--sample", type=float, default=None, help="row fraction (default: all)")
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--format", default="parquet", choices=["parquet", "csv", "json", "orc"])
    p.add_argument("--input-format", default="csv", choices=["csv", "parquet"],
                   help="parquet: read tables written by 'ingest'")
    p.add_argument("--tables", default=None,
                   help="ingest only these tables (comma-separated; default: all five)")
    p.add_argument("--quarantine", default=None,
                   help="ingest: root folder for malformed lines, which are then not converted")
    p.add_argument("--shuffle-partitions", type=int, default=None,
                   help="initial shuffle partition count (AQE coalesces it down); "
                        "size it so a partition of the largest shuffle is ~128 MB, "
                        "e.g. 20000 for a 100 TB trace.  Default: the session's setting")
    args = p.parse_args(argv)
    spark = build_session(shuffle_partitions=args.shuffle_partitions, app_name=f"tracelens-{args.job}")
    if args.job == "ingest":
        tables = [t.strip() for t in args.tables.split(",")] if args.tables else None
        paths = ingest(spark, args.trace, args.out, tables, args.quarantine)
    else:
        paths = run_job(spark, args.job, args.trace, args.out, sample=args.sample,
                        seed=args.seed, fmt=args.format, input_format=args.input_format)
    for key, path in paths.items():
        print(f"{key}\t{path}")


if __name__ == "__main__":
    main()
