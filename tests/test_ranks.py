"""Ranks, rank correlation, quantiles and exact samples against numpy and plain Python."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tracelens.operators import ranks
from tracelens.operators.histogram import scatter_grid


def average_ranks(values):
    order = sorted(values)
    return {v: sum(i + 1 for i, x in enumerate(order) if x == v) / order.count(v) for v in set(values)}


@pytest.fixture(scope="module")
def pairs():
    r = random.Random(1)
    out = [(r.choice([1.5, 2.5, 7.0, r.random() * 9]), float(r.randrange(20))) for _ in range(300)]
    return out + [(7.0, 3.0)] * 150 + [(None, 1.0), (2.0, None), (None, None)]  # a pair that a third of the rows share


def test_value_ranks_average_ties(spark, pairs):
    for c, of in (("x", [p[0] for p in pairs]), ("y", [p[1] for p in pairs])):
        of = [v for v in of if v is not None]
        got = ranks.value_ranks(spark.createDataFrame(pairs, "x double, y double").repartition(7), c)
        assert rows(got) == sorted((v, of.count(v), int(2 * a)) for v, a in average_ranks(of).items())


def test_rank_correlation_against_numpy(spark, pairs):
    df = spark.createDataFrame(pairs, "x double, y double")
    known = [(x, y) for x, y in pairs if x is not None and y is not None]
    rx, ry = average_ranks([x for x, _ in known]), average_ranks([y for _, y in known])
    want = np.corrcoef([rx[x] for x, _ in known], [ry[y] for _, y in known])[0, 1]
    assert ranks.rank_correlation(df, "x", "y", digits=None).first()[0] == pytest.approx(want, abs=1e-12)
    assert ranks.rank_correlation(df, "x", "x").first()[0] == 1.0
    assert ranks.rank_correlation(df.withColumn("z", -F.col("x")), "x", "z").first()[0] == -1.0
    assert ranks.rank_correlation(df.withColumn("z", F.lit(3)), "x", "z").first()[0] is None
    assert ranks.rank_correlation(df.where("x > 100"), "x", "y").first()[0] is None


def test_no_rank_task_holds_the_whole_column(spark, monkeypatch):
    """The ordering window is partitioned by range; the one without a key reads a row a range."""
    df = spark.range(2000).select((F.col("id") % 700).alias("x"))
    seen = []
    keep = ranks.checkpoint_table
    monkeypatch.setattr(ranks, "checkpoint_table", lambda d: seen.append(keep(d)) or seen[-1])
    joins = "spark.sql.adaptive.coalescePartitions.enabled"  # else so few rows are one partition
    spark.conf.set(joins, "false")
    try:
        assert ranks.value_ranks(df, "x").count() == 700
    finally:
        spark.conf.set(joins, "true")
    sizes = [r["count"] for r in seen[0].groupBy("_range").count().collect()]
    assert sum(sizes) == 700 and len(sizes) > 1 and max(sizes) < 300


@pytest.mark.parametrize("last_rows", [5, 10_000])
def test_quantiles_against_numpy(spark, monkeypatch, last_rows):
    """Skewed, tied, negative and huge values; also where only a few values may be fetched at the end."""
    monkeypatch.setattr(ranks, "LAST_ROWS", last_rows)
    monkeypatch.setattr(ranks, "PIVOTS", 9)
    r = random.Random(2)
    values = [r.choice([-1.0, 5.0, r.expovariate(1) ** 9, -r.random() * 1e300]) for _ in range(900)] + [5.0] * 400
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    probs = [0, 0.001, 0.25, 0.5, 0.9, 0.999, 1]
    got = {x["prob"]: x["value"] for x in ranks.exact_quantiles(df, "v", probs).collect()}
    for p in probs:
        assert got[p] == pytest.approx(np.quantile(values, p), rel=1e-12)
    order = sorted(values)
    assert ranks.select_positions(df, "v", [0, 17, 640, len(values) - 1]) == [order[i] for i in (0, 17, 640, -1)]
    with pytest.raises(ValueError):
        ranks.select_positions(df, "v", [len(values)])
    whole = spark.createDataFrame([(v,) for v in range(100)], "v long")
    assert ranks.select_positions(whole, "v", [42, 7]) == [42, 7]


def test_quantiles_without_values(spark):
    assert rows(ranks.exact_quantiles(spark.createDataFrame([(None,)], "v double"), "v", [0.5])) == [(0.5, None)]


def test_a_value_is_placed_among_the_cuts(spark):
    for cuts in ([], [4], [0, 3, 4, 9], [2, 5, 6, 7, 8, 11, 30]):
        got = spark.range(-1, 32).select(ranks._place(F.col("id"), cuts)).collect()
        assert [r[0] for r in got] == [2 * sum(c < x for c in cuts) + (x in cuts) for x in range(-1, 32)]


def test_the_last_step_of_a_selection_is_bounded(spark, monkeypatch):
    fetched = []
    monkeypatch.setattr(ranks, "LAST_ROWS", 50)
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("v"))
    kind = type(df.groupBy("v").count())
    keep = kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: fetched.append(keep(self)) or fetched[-1])
    assert ranks.select_positions(df, "v", [10_000]) == [sorted(i * 7919 % 20_011 for i in range(20_000))[10_000]]
    assert all(len(f) <= 50 for f in fetched)


@pytest.mark.parametrize("small", [0, 10_000])
def test_sample_is_exact_and_independent_of_the_layout(spark, monkeypatch, small):
    monkeypatch.setattr(ranks, "SMALL_SAMPLE", small)
    df = spark.range(3000).select("id", (F.col("id") % 5).alias("g"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("n"))
    df = df.unionByName(spark.createDataFrame([(1, 1, 1)] * 900, df.schema))  # repeated rows
    one = ranks.exact_sample(df.coalesce(1), rows=700, seed=3)
    other = ranks.exact_sample(df.repartition(13, "g"), rows=700, seed=3)
    assert one.count() == 700 and rows(one) == rows(other)
    assert not Counter(rows(one)) - Counter(rows(df))
    assert rows(one) != rows(ranks.exact_sample(df, rows=700, seed=4))
    assert ranks.exact_sample(df, fraction=0.333).count() == round(0.333 * 3900)
    weighted = ranks.exact_sample(df, rows=39, weight="w", keys=["id"])
    assert {r["w"] for r in weighted.collect()} == {100.0}
    assert rows(ranks.exact_sample(df, rows=10**6)) == rows(df)
    assert ranks.exact_sample(df, rows=0).count() == 0
    assert ranks.exact_sample(df.where("id < 0"), rows=5, weight="w").count() == 0
    for bad in ({}, {"rows": 1, "fraction": 0.5}, {"fraction": 1.5}, {"rows": -1}):
        with pytest.raises(ValueError):
            ranks.exact_sample(df, **bad)


@pytest.mark.parametrize("digits, last", [(4, 10_000), (4, 3), (1, 3), (2, 0)])
def test_sample_is_selected_by_the_first_digits_of_its_hash(spark, monkeypatch, digits, last):
    monkeypatch.setattr(ranks, "SMALL_SAMPLE", 0)
    monkeypatch.setattr(ranks, "PASS_DIGITS", digits)
    monkeypatch.setattr(ranks, "LAST_ROWS", last)
    df = spark.range(900).select((F.col("id") % 300).alias("a"), "id").unionByName(spark.range(200).select(F.lit(None).alias("a"), "id"))
    key = {a: hashlib.md5(f"5|{'\\N' if a is None else a}".encode()).hexdigest()[:15] for a in [None, *range(300)]}
    order = sorted(rows(df), key=lambda r: (key[r[0]], r[1]))
    nulls = next(i for i, r in enumerate(order) if r[0] is None)  # 200 rows of one hash
    for k in (1, 3, 4, nulls, nulls + 77, nulls + 200, 1099):
        assert sorted(map(str, order[:k])) == sorted(map(str, rows(ranks.exact_sample(df, rows=k, keys=["a"], seed=5)))), k


def test_a_sample_reads_its_table_a_few_times(spark, monkeypatch):
    monkeypatch.setattr(ranks, "SMALL_SAMPLE", 100)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = spark.range(30_000).mapInArrow(counted, "id long")
    assert len(ranks.exact_sample(df, fraction=0.2, keys=["id"]).collect()) == 6000
    assert read.value <= 4 * 30_000  # counted, two passes of the selection, the sample


def test_sample_takes_every_row_equally_often(spark):
    df = spark.range(40)
    times = Counter(r["id"] for seed in range(60) for r in ranks.exact_sample(df, rows=10, seed=seed).collect())
    assert sum(times.values()) == 600 and len(times) == 40 and max(times.values()) < 30


def test_scatter_grid_counts_every_pair_within_its_bound(spark):
    r = random.Random(4)
    values = [(r.gauss(0, 1e-3), r.gauss(5, 1e-3)) for _ in range(2000)] + [(r.random() * 1e6, r.random()) for _ in range(500)]
    values += [(0.25, 5.0)] * 1000
    odd = [(float("nan"), 1.0), (float("inf"), 2.0), (3.0, float("-inf"))]
    df = spark.createDataFrame(values + odd + [(None, 1.0), (1.0, None)], "x double, y double")
    for cells, depth in ((40, 6), (1000, 10), (2, 3), (50, 0)):
        got = scatter_grid(df, "x", "y", max_cells=cells, depth=depth).collect()
        real = [g for g in got if g["level"] >= 0]
        assert len(real) <= cells and sum(g["n_rows"] for g in real) == len(values)
        assert [g["n_rows"] for g in got if g["level"] < 0] == [3]
        for g in real:  # each cell has the pairs between its edges
            x1 = max(v[0] for v in values) if g["cx"] + 1 == 2 ** g["level"] else None
            y1 = max(v[1] for v in values) if g["cy"] + 1 == 2 ** g["level"] else None
            n = sum(g["x_lo"] <= x and (x < g["x_hi"] or x == x1) and g["y_lo"] <= y and (y < g["y_hi"] or y == y1)
                    for x, y in values)
            assert n == g["n_rows"]
    same = spark.createDataFrame([(1.0, 2.0)] * 5, "x double, y double")
    assert sum(g["n_rows"] for g in scatter_grid(same, "x", "y", max_cells=4).collect()) == 5
    assert scatter_grid(same.where("x > 1"), "x", "y").count() == 0
    with pytest.raises(ValueError):
        scatter_grid(same, "x", "y", max_cells=1)
