"""Analyses on skewed input (one job holds a third of all rows), checked
against a pandas brute force of the same rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tracelens.plans import analyses as A

N = 30000


@pytest.fixture(scope="module")
def skewed(spark):
    i = F.col("id")
    hot = (i % 3) == 0  # a third of all rows belong to job 7
    df = spark.range(N).select(
        F.when(hot, F.lit(7)).otherwise(i % 997 + 100).cast("long").alias("job_id"),
        (i % 13).alias("task_index"),
        F.when(i % 17 == 0, F.lit(None)).otherwise(i % 41).cast("long").alias("machine_id"),
        (i % 7).cast("int").alias("event_type"),
        (i % 11).cast("int").alias("priority"),
        ((i * 7919) % 100003).alias("time"),
        F.when(i % 19 == 0, F.lit(None)).otherwise((i % 100) / 100.0).alias("cpu_request"),
        ((i % 37) / 40.0).alias("cpu_rate"),
        ((i % 101) / 101.0).alias("maximum_cpu_rate"),
    ).repartition(6)
    return df, df.toPandas()


def test_counts_and_distincts_under_skew(skewed):
    df, pdf = skewed
    per_job = pdf.groupby("job_id").size()
    r = A.rows_per_key_stats(df, digits=None).collect()[0]
    assert r["max"] == per_job.max() == N // 3
    assert r["mean"] == pytest.approx(per_job.mean())
    assert r["std_pop"] == pytest.approx(per_job.std(ddof=0))
    top = [tuple(x) for x in A.rows_per_key_topk(df, k=3).collect()]
    assert top[0] == (7, N // 3)
    machines = pdf.assign(m=pdf.machine_id.fillna(-1)).groupby("job_id").m.nunique()
    got = dict(rows(A.distinct_per_key_topk(df, k=2000)))
    assert got == machines.to_dict()


def test_event_share_under_skew(skewed):
    df, pdf = skewed
    ev = pdf[pdf.event_type == 2].groupby("priority").size()
    got = {r.priority: (r.n_events, r.prob) for r in A.event_share(df).collect()}
    assert {k: v[0] for k, v in got.items()} == ev.to_dict()
    assert sum(v[1] for v in got.values()) == pytest.approx(1.0, abs=1e-5)


def test_request_vs_usage_under_skew(skewed):
    df, pdf = skewed
    req = pdf.dropna(subset=["cpu_request"]).assign(v=lambda d: (d.cpu_request * 100).round(4))
    use = pdf.assign(v=lambda d: (d.cpu_rate * 100).round(4))
    exp = (req.groupby("job_id").v.mean().rename("request").to_frame()
           .join(use.groupby("job_id").v.mean().rename("usage"), how="inner"))
    got = {r.job_id: (r.request, r.usage) for r in A.request_vs_usage(df, df).collect()}
    assert set(got) == set(exp.index)
    for job, (rq, us) in got.items():
        assert rq == pytest.approx(exp.loc[job, "request"], abs=1e-4)
        assert us == pytest.approx(exp.loc[job, "usage"], abs=1e-4)


def test_peaks_and_delays_under_skew(skewed):
    df, pdf = skewed
    peaks = (pdf.assign(p=lambda d: (d.maximum_cpu_rate * 100).round(2))
             .groupby("job_id").p.max())
    evicted = set(pdf[pdf.event_type == 2].job_id)
    exp = {j: p for j, p in peaks.items() if p < 100 and j in evicted}
    got = dict(rows(A.peak_vs_event(df, df)))
    assert got.keys() == exp.keys()
    assert all(got[j] == pytest.approx(exp[j]) for j in exp)

    sub = pdf[pdf.event_type == 0].groupby(["job_id", "task_index"]).time.min()
    out = pdf[pdf.event_type.isin([1, 3, 5, 6])].groupby(["job_id", "task_index"]).time.min()
    both = pd.concat([sub.rename("s"), out.rename("e")], axis=1, join="inner")
    delays = (both.e - both.s)
    got = {(j, t): d for j, t, d in rows(A.pending_delays(df))}
    assert got == {k: v for k, v in delays.items()}
    hist = A.delta_histogram(df.select(F.col("time").cast("double").alias("delta"))).orderBy("bin")
    assert [r.n_rows for r in hist.collect()] == list(np.histogram(pdf.time.astype(float), 10)[0])
