"""Periodic runs, fingerprint groups and spelling variants against brute force."""

from __future__ import annotations

import os
import random
import sys
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402

from tracelens.llm import periodic_runs, queries, simhash_dedup, spelling_variants  # noqa: E402

CLASHING = ", id string, runs string, fp long, bucket long, component long, word string, run string, n long, words string, h long"


def table(spark, rows, columns="doc_id long, text string"):
    """The rows with extra columns of clashing names, all of them null."""
    extra = len(CLASHING.split(",")) - 1
    return spark.createDataFrame([tuple(r) + (None,) * extra for r in rows], columns + CLASHING)


def words(n, seed=0):
    r = random.Random(seed)
    return [f"w{r.randrange(10**6)}" for _ in range(n)]


@pytest.fixture(scope="module")
def edge():
    base = words(60, 1)
    return [
        (0, None), (1, ""), (2, " \t\n "), (3, "one"), (4, "a a a a a a"), (5, "a a a a a"), (6, "A a " * 8),
        (7, " ".join(base + base[:7] * 5 + words(40, 2))), (8, "x\x0by\x0cx\ty\nx y x\r\ny"), (9, "naïve ß " * 20),
        (10, " ".join(["p q"] * 6 + ["p q r"] * 6)), (11, " ".join(words(5000, 3) + words(200, 4) * 10 + words(5000, 5))),
        (12, "a " * 30000), (None, "u v " * 9), (None, None), (4, "a a a a a a"), (4, "b b b b b b b"),
        (13, " ".join(base)), (14, "!!! ... " * 10),
    ]


def key(row):
    return (row[0] is None, row[0] or 0, str(row[1:]))


def test_runs_of_blocks_against_brute_force():
    """Random words over small alphabets, planted periods, several texts and empty ones in a block."""
    r = random.Random(1)
    for _ in range(400):
        docs = []
        for _ in range(r.randrange(1, 6)):
            n, k = r.choice([0, 1, 2, 5, 8, 20, 40, 80]), r.choice([1, 2, 3, 10])
            w = [r.randrange(k) for _ in range(n)]
            if r.random() < 0.4 and n:
                a = r.randrange(n)
                p = 1 + r.randrange(max(1, (n - a) // 3))
                w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
            docs.append(w)
        first = np.cumsum([0] + [len(d) for d in docs])
        for length, exponent in ((6, 4), (2, 2), (1, 3)):
            start, end, period = periodic_runs.runs_of_block(np.array(sum(docs, []), dtype=np.int64), first, length, exponent)
            assert sorted(zip(start.tolist(), (end - start).tolist(), period.tolist())) == sorted(
                (int(first[i]) + s, n, p) for i, d in enumerate(docs) for s, n, p in brute.runs(d, length, exponent))


def test_nearest_smaller_values_where_candidates_jump_one_by_one():
    """A rising row that falls at once needs the table of range minima."""
    value = np.array([0, *range(1, 500), 1, 1, 0, 3, 2, 2, 5])
    for or_equal in (False, True):
        want = [i if not v else max(j for j in range(i) if value[j] < v or or_equal and value[j] == v)
                for i, v in enumerate(value.tolist())]
        assert periodic_runs.previous_below(value, or_equal).tolist() == want


def test_runs_against_brute_force(spark, edge):
    got = periodic_runs.find_runs(table(spark, edge)).collect()
    want = []
    for i, t in edge:
        w = brute.SPACE_WORD.findall(t or "")
        found = brute.runs(w) if len(w) < 3000 else {11: [(5000, 2000, 200)], 12: [(0, 30000, 1)]}[i]
        want.append((i, found, brute.collapsed(w, found)))
    assert sorted(((r[0], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got), key=key) == sorted(want, key=key)
    assert periodic_runs.find_runs(table(spark, edge), min_exponent=2, min_length=2).where("doc_id = 10").first()["runs"]
    with pytest.raises(ValueError):
        periodic_runs.find_runs(table(spark, edge), min_exponent=1)


def test_runs_of_query_rows(spark, edge, tmp_path):
    """The planted runs, the best run by exact exponent and the digests, by their definitions."""
    rows = edge + [(i, " ".join(words(random.Random(i).randrange(1, 90), i))) for i in range(100, 400)]
    table(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op11_branching_tandem_runs(spark, str(tmp_path)).collect()
    want = []
    for i, t in rows:
        w = brute.SPACE_WORD.findall(t or "")
        if i is not None and w and zlib.crc32(str(i).encode()) % 10 == 0:
            g = zlib.crc32(str(i).encode()) // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[a + (j - a) % p] if j >= a else w[j] for j in range(len(w))]
        found = brute.runs(w) if len(w) < 3000 else {11: [(5000, 2000, 200)], 12: [(0, 30000, 1)]}[i]
        best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
        want.append((i, len(found), *best, 1000 * best[1] // best[2] if found else None,
                     brute.sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), brute.sha(brute.collapsed(w, found))))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert sum(r["n_runs"] > 0 for r in got) > 15


def test_covering_masks_share_a_table_for_every_pair_within_the_radius():
    """Every set of at most three places is left out by some mask, as any pair of fingerprints needs."""
    masks = np.array(simhash_dedup.covering_masks(3), dtype=np.int64).view(np.uint64)
    assert len(masks) == 15
    places = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for i in range(64):
        for j in range(i, 64):
            differing = places[i] | places[j] | places[j:]
            assert ((masks[:, None] & differing[None, :]) == 0).any(axis=0).all()


def test_fingerprints_and_groups_against_brute_force(spark, edge):
    r = random.Random(5)
    base = words(400, 30)
    rows = list(edge)
    for i in range(100, 220):  # families whose fingerprints differ in few bits
        own = base[:] if i % 2 else base[:200] + words(200, 31)
        for _ in range(r.choice([0, 1, 2, 6, 12])):
            own[r.randrange(400)] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    rows += rows[:40]
    got = simhash_dedup.near_duplicates(spark, table(spark, rows), block=4).collect()
    prints = {}
    for i, t in rows:
        prints.setdefault(brute.simhash(t), []).append(i)
    of = brute.groups_by({p: p for p in prints}, lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for p, ids in prints.items():
        least[of[p]] = min([i for i in [*ids, least.get(of[p])] if i is not None], default=None)
    want = [(i, f"{brute.simhash(t):016x}", least[of[brute.simhash(t)]]) for i, t in rows]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert len(set(of.values())) < len(of) - 20  # many links between different fingerprints


def test_groups_of_fingerprints_that_miss_their_pivot(spark):
    """Chains and balls of fingerprints: buckets with several groups, of more classes than a block."""
    r = random.Random(6)
    some = set()
    for _ in range(6):
        centre = r.getrandbits(64)
        for _ in range(80):
            some.add(centre ^ sum(1 << b for b in r.sample(range(64), r.choice([1, 2, 3, 4, 5]))))
        step = r.getrandbits(64)
        for _ in range(30):
            some.add(step)
            step ^= sum(1 << b for b in r.sample(range(64), 3))
    signed = {p - 2**64 if p >> 63 else p for p in some}
    fps = spark.createDataFrame([(p,) for p in signed], "fp long")
    want = brute.groups_by({p: p for p in signed}, lambda a, b: ((a ^ b) % 2**64).bit_count() <= 3)
    for block in (8, 4096):
        got = {x["fp"]: x["component"] for x in simhash_dedup.near_fingerprints(spark, fps, block=block).collect()}
        assert got == want
    assert 12 < len(set(want.values())) < len(want)


def test_components_without_ids(spark):
    got = simhash_dedup.near_duplicates(spark, table(spark, [(None, "a b c d"), (5, "quite another text here")])).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(None, None), (5, 5)}


def test_variants_against_brute_force(spark):
    r = random.Random(7)
    letters = "abçé"
    counts = {}
    for _ in range(60):
        word = "".join(r.choice(letters) for _ in range(r.randrange(1, 9)))
        counts[word] = r.choice([2, 3, 20, 30, 200, 2000])
        for _ in range(4):
            at, c = r.randrange(len(word) + 1), r.choice(letters)
            for other in (word[:at] + c + word[at:], word[:at] + c + word[at + 1:], word[:at] + word[at + 1:]):
                if other:
                    counts.setdefault(other, r.choice([2, 3, 20, 30, 200, 2000]))
    counts |= {"aaaa": 5, "aaaaa": 50, "aaaaaa": 500, "aaaaaaa": 5000, "tiex": 300, "tiey": 300, "tie": 3, "ÿÀ": 2}
    for ratio in (2, 10):
        df = spark.createDataFrame([*counts.items(), (None, 9), ("", 9)], "word string, n long")
        got = spelling_variants.variants(spark, df.withColumn("form", F.lit("clash")), ratio)
        assert got.columns == ["word", "n", "n_near", "form", "form_n", "root"]
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, brute.variants(counts, ratio)))
    with pytest.raises(ValueError):
        spelling_variants.variants(spark, df, 1)


def test_variants_of_query_rows(spark, tmp_path):
    """Runs of letters, planted deletions and counts, by their definitions, from texts with the usual trouble."""
    r = random.Random(8)
    common = ["".join(r.choice("abcdeéÉß") for _ in range(r.randrange(5, 11))) for _ in range(30)]
    texts = [" ".join(r.choice(common) for _ in range(60)) for _ in range(40)]
    texts += [None, "", "1234 -- ", "A" * 5000 + " " + "Straßenbahn×÷Àÿ " * 3, "naïve_Walking-WALKING;walking " * 2, texts[0]]
    rows = list(enumerate(texts)) + [(None, "loosened loosened loosened"), (3, texts[3])]
    table(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    counts = Counter()
    for i, t in rows:
        for m in brute.re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = m.translate(brute.LOWER)
            h = zlib.crc32((run if i is None else f"{i}:{run}").encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += len(run) >= 7
    counts = {w: n for w, n in counts.items() if n >= 2}
    got = queries.op13_permuterm_spelling_variants(spark, str(tmp_path)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute.variants(counts)))
    assert any(x["form"] for x in got)


def test_empty_tables(spark):
    empty = table(spark, [])
    assert periodic_runs.find_runs(empty).count() == 0
    assert simhash_dedup.near_duplicates(spark, empty).count() == 0
    counts = spelling_variants.word_counts(spelling_variants.letter_runs(empty).withColumnRenamed("run", "word"))
    assert spelling_variants.variants(spark, counts).count() == 0
