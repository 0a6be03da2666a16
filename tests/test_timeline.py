"""Pending periods and as-of joins against plain Python, with resubmissions, ties and a hot key."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import plan_text, rows
from tracelens.operators.timeline import as_of_join, pending_periods
from tracelens.plans import analyses as A

SUBMIT, LEAVE = (0,), (1, 3, 5, 6)


def periods(events):
    """(job, task, start, end, n_starts) in event order; of one instant, starts come first."""
    by_key = defaultdict(set)
    for job, task, kind, t in events:
        if None not in (job, task, t) and kind in SUBMIT + LEAVE:
            by_key[job, task].add((t, kind not in SUBMIT))
    out = []
    for (job, task), seen in by_key.items():
        open_at, n = None, 0
        for t, is_end in sorted(seen):
            if not is_end:
                open_at, n = (t if open_at is None else open_at), n + 1
            elif open_at is not None:
                out.append((job, task, open_at, t, n))
                open_at, n = None, 0
    return sorted(out)


def frame(spark, events):
    return spark.createDataFrame(events, "job_id long, task_index long, event_type int, time long")


@pytest.fixture(scope="module")
def events():
    r = random.Random(1)
    out = []
    for job in range(12):
        for task in range(3):
            for _ in range(r.randrange(0, 14)):
                out.append((job, task, r.choice([0, 0, 1, 2, 4, 5, 6]), r.randrange(0, 40)))
    # A hot task: a third of all rows, long stretches without an end, one instant with many events.
    for _ in range(150):
        out.append((99, 0, r.choice([0, 0, 0, 0, 1]), r.randrange(0, 1000)))
    out += [(99, 0, 0, 500)] * 20 + [(99, 0, 1, 500)] * 20 + [(99, 0, 0, t) for t in range(600, 700)]
    out += [(None, 1, 0, 1), (None, 1, 1, 2), (5, None, 0, 1), (5, 1, 0, None), (7, 0, None, 3), (50, 0, 1, 3), (51, 0, 0, 3)]
    r.shuffle(out)
    return out


@pytest.mark.parametrize("pieces", [1, 7, 256, 5000])
def test_pending_periods_against_plain_python(spark, events, pieces):
    got = pending_periods(frame(spark, events), ["job_id", "task_index"], "event_type", SUBMIT, LEAVE, "time", pieces=pieces)
    assert got.columns == ["job_id", "task_index", "start", "end", "n_starts", "delay"]
    assert rows(got, "job_id", "task_index", "start", "end", "n_starts") == periods(events)
    assert got.where("delay < 0 or delay <> end - start").count() == 0


def test_periods_with_other_names_and_scale(spark):
    df = spark.createDataFrame([("a", "s", 10, 1), ("a", "s", 20, 1), ("a", "e", 40, 1), ("a", "e", 50, 1)],
                               "t string, piece string, start long, k0 int")
    got = pending_periods(df, ["t"], "piece", ["s"], ["e"], "start", time_scale=10.0, pieces=3)
    assert rows(got) == [("a", 10, 40, 2, 3.0)]
    assert pending_periods(frame(spark, []), ["job_id"], "event_type", SUBMIT, LEAVE, "time").count() == 0


def test_first_delays_can_be_negative_where_periods_are_not(spark, trace):
    """The trace leaves a task before its submit: the first-times delay is negative, the period is none."""
    first = {(r["job_id"], r["task_index"]): r["delay"] for r in A.pending_delays(trace["task_events"]).collect()}
    assert first[3000000000, 0] < 0
    got = A.pending_intervals(trace["task_events"])
    assert (3000000000, 0) not in {(r["job_id"], r["task_index"]) for r in got.collect()}
    assert got.where("delay < 0").count() == 0
    assert rows(got.where("job_id = 1")) == [(1, 0, 10, 15, 2, 5), (1, 1, 9, 30, 1, 21)]


def test_waiting_per_job(spark, events):
    want = defaultdict(lambda: [set(), 0, 0, 0])
    for job, task, start, end, _ in periods(events):
        w = want[job]
        w[0].add(task)
        w[1] += 1
        w[2] += end - start
        w[3] = max(w[3], end - start)
    got = A.waiting_per_job(A.pending_intervals(frame(spark, events)))
    assert rows(got) == sorted((j, len(w[0]), w[1], w[1] - len(w[0]), w[2], w[3]) for j, w in want.items())


def test_a_hot_task_is_dealt_over_pieces(spark, events):
    """No window but that over one row a piece is partitioned by the key alone."""
    plan = plan_text(pending_periods(frame(spark, events), ["job_id", "task_index"], "event_type", SUBMIT, LEAVE, "time"))
    ordered = re.findall(r"Window .*?windowspecdefinition\(([^)]*)", plan)
    assert ordered and all("piece" in w for w in ordered)


def as_of(events, states):
    best = {}
    for k, t, *values in states:
        if t is not None and k is not None:
            best[k, t] = max(best.get((k, t), tuple(values)), tuple(values))
    out = []
    for k, t in events:
        at = [(s, v) for (key, s), v in best.items() if key == k and t is not None and s <= t]
        out.append((k, t, *((max(at)[0], *max(at)[1]) if at else (None, None, None))))
    return sorted(out, key=lambda r: tuple((v is None, v or 0) for v in r))


@pytest.mark.parametrize("pieces", [1, 5, 256])
def test_as_of_join_against_plain_python(spark, pieces):
    r = random.Random(3)
    states = [(r.randrange(8), r.randrange(0, 300), r.randrange(5), r.randrange(5)) for _ in range(150)]
    states += [(77, t, 1, t) for t in range(0, 2000, 40)] + [(1, None, 1, 1), (None, 3, 1, 1), (2, 50, 9, 0), (2, 50, 9, 1)]
    events = [(r.randrange(10), r.randrange(-20, 320)) for _ in range(120)]
    events += [(77, r.randrange(0, 2100)) for _ in range(200)] + [(3, 100)] * 3 + [(None, 5), (4, None)]
    s = spark.createDataFrame(states, "job long, begin long, a int, b int")
    e = spark.createDataFrame(events, "job long, at long")
    got = as_of_join(e, s, "job", "at", "begin", ["a", "b"], state_time_name="begin", pieces=pieces)
    assert got.columns == ["job", "at", "begin", "a", "b"]
    assert rows(got) == as_of(events, states)


def test_as_of_join_of_empty_sides(spark):
    s = spark.createDataFrame([], "job long, begin long, a int")
    e = spark.createDataFrame([(1, 5)], "job long, at long")
    assert rows(as_of_join(e, s, "job", "at", "begin", ["a"])) == [(1, 5, None, None)]
    assert as_of_join(e.where("job = 2"), s, "job", "at", "begin", ["a"]).count() == 0


def test_as_of_join_makes_no_pairs(spark):
    """A thousand states and a thousand events of one key: no operator returns more rows than both tables."""
    s = spark.range(1000).select(F.lit(1).alias("job"), (F.col("id") * 7).alias("begin"), F.col("id").alias("a"))
    e = spark.range(1000).select(F.lit(1).alias("job"), (F.col("id") * 7 + 3).alias("at"))
    got = as_of_join(e, s, "job", "at", "begin", ["a"])
    plan = plan_text(got)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    # The only joins look up one carried row per (key, piece).
    assert all("piece" in line for line in plan.splitlines() if re.search(r"(SortMerge|BroadcastHash|ShuffledHash)Join", line))
    assert rows(got) == [(1, i * 7 + 3, i * 7, i) for i in range(1000)]


def test_usage_at_event_and_peaks(spark):
    usage = spark.createDataFrame([(1, 0, 0, 10, 0.5), (1, 0, 10, 20, 0.9), (1, 0, 20, 30, None), (1, 1, 0, 10, 0.7),
                                   (2, 0, 5, 9, 0.1)],
                                  "job_id long, task_index long, start_time long, end_time long, maximum_cpu_rate double")
    events = spark.createDataFrame([(1, 0, 2, 9), (1, 0, 2, 10), (1, 0, 2, 25), (1, 1, 2, 50), (2, 0, 2, 1), (3, 0, 2, 1),
                                    (2, 0, 0, 6)], "job_id long, task_index long, event_type int, time long")
    assert rows(A.usage_at_event(usage, events)) == rows(spark.createDataFrame([
        (1, 0, 9, 0, 10, 0.5, True), (1, 0, 10, 10, 20, 0.9, True), (1, 0, 25, 10, 20, 0.9, False),
        (1, 1, 50, 0, 10, 0.7, False), (2, 0, 1, None, None, None, False), (3, 0, 1, None, None, None, False)],
        "job_id long, task_index long, time long, start_time long, end_time long, maximum_cpu_rate double, inside boolean"))
    assert rows(A.event_peaks(usage, events)) == [(1, 4, 2, 0.9, 0.9), (2, 1, 0, None, 0.1), (3, 1, 0, None, None)]
