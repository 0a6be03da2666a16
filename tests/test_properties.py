"""Property tests: operators against brute-force Python on random inputs."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from tracelens import operators as op

SETTINGS = settings(max_examples=20, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

finite = st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False)


@SETTINGS
@given(values=st.lists(finite, min_size=1, max_size=120), bins=st.integers(1, 12))
def test_histogram_matches_numpy(spark, values, bins):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = op.equal_width_histogram(df, "x", bins).orderBy("bin").collect()
    counts, edges = np.histogram(np.array(values, dtype=float), bins=bins)
    assert [r.n_rows for r in got] == list(counts)
    assert [r.bin_lo for r in got] == list(edges[:-1])
    assert [r.bin_hi for r in got] == list(edges[1:])


events = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2), st.integers(0, 7),
                            st.integers(-50, 50)), min_size=0, max_size=60)


@SETTINGS
@given(evs=events)
def test_transition_delay_matches_brute_force(spark, evs):
    df = spark.createDataFrame(evs, "job long, task long, ev int, t long")
    got = rows(op.transition_delay(df, ["job", "task"], "ev", [0], [1, 3, 5, 6], "t"))
    expected = []
    for key in sorted({(j, k) for j, k, _, _ in evs}):
        starts = [t for j, k, e, t in evs if (j, k) == key and e == 0]
        ends = [t for j, k, e, t in evs if (j, k) == key and e in (1, 3, 5, 6)]
        if starts and ends:
            expected.append((*key, min(ends) - min(starts)))
    assert got == expected


pairs = st.lists(st.tuples(st.integers(0, 5), st.one_of(st.none(), st.integers(0, 6))),
                 min_size=0, max_size=80)


@SETTINGS
@given(data=pairs)
def test_distinct_per_key_matches_pandas(spark, data):
    df = spark.createDataFrame(data, "k long, v long")
    got = dict(rows(op.distinct_per_key(df, "k", "v")))
    pdf = pd.DataFrame(data, columns=["k", "v"])
    expected = pdf.groupby("k").v.nunique(dropna=False).to_dict() if data else {}
    assert got == expected
    plain = dict(rows(op.distinct_per_key(df, "k", "v", count_missing=False)))
    assert plain == (pdf.groupby("k").v.nunique().to_dict() if data else {})


@SETTINGS
@given(data=st.lists(st.integers(0, 9), min_size=1, max_size=100))
def test_shares_sum_to_one(spark, data):
    df = spark.createDataFrame([(v,) for v in data], "k long")
    counts = op.rows_per_key(df, "k")
    shares = op.share_of_total(counts, "n_rows", name="s", digits=None).collect()
    assert abs(sum(r.s for r in shares) - 1.0) < 1e-9
    assert {r.k: r.n_rows for r in shares} == pd.Series(data).value_counts().to_dict()


@SETTINGS
@given(sizes=st.lists(st.integers(1, 10_000), min_size=2, max_size=80))
def test_summary_stats_match_numpy(spark, sizes):
    df = spark.createDataFrame([(s,) for s in sizes], "n long")
    r = op.summary_stats(df, "n", digits=None).collect()[0]
    a = np.array(sizes, dtype=float)
    mean, sp = a.mean(), a.std()
    assert r["mean"] == pytest.approx(mean, rel=1e-12)
    assert r["std_samp"] == pytest.approx(a.std(ddof=1), rel=1e-9, abs=1e-9)
    assert r["std_pop"] == pytest.approx(sp, rel=1e-9, abs=1e-9)
    assert (r["min"], r["max"]) == (min(sizes), max(sizes))
    assert r["low_mean"] == pytest.approx(min(max(mean - sp, a.min()), a.max()), rel=1e-9)
    assert r["high_mean"] == pytest.approx(min(max(mean + sp, a.min()), a.max()), rel=1e-9)
