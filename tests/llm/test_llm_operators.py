"""Operators on training text: brute force, exact round trips and held-out accuracy on small tables."""

from __future__ import annotations

import gzip
import json
import os
import random
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402

from tracelens.llm import (decontaminate, dom, exact_dedup, graph, html_extract, language_id, minhash_dedup,  # noqa: E402
                           packing, queries, store, substring_dedup, tokens, training_order, url_filter, warc_derive)
from tracelens.session import shared_dir  # noqa: E402

SF = "/root/testdata/sf0.001"
# Columns of a caller that carry names the operators use inside.
CLASHING = ", id string, key string, row long, n long, digest string, rep long, component long, prefix long, items string"


def table(spark, rows, columns="doc_id long, text string"):
    """The rows with extra columns of clashing names, some of them null."""
    names = columns + CLASHING
    extra = len(CLASHING.split(",")) - 1
    return spark.createDataFrame([tuple(r) + (None,) * extra for r in rows], names)


def words(n, seed=0, start="w"):
    r = random.Random(seed)
    return [f"{start}{r.randrange(10**6)}" for _ in range(n)]


@pytest.fixture(scope="module")
def edge():
    """Nulls, empty and blank texts, ties, repeated rows, a very long text, near copies and shared passages."""
    base, passage = words(120, 1), words(60, 2)
    near = base[:]
    near[60] = "changed"
    far = base[:40] + words(80, 3)
    long = words(30000, 4) + passage + words(30000, 5)
    line = " ".join(words(9, 6))
    return [
        (0, " ".join(base)), (1, " ".join(near)), (2, " ".join(far)), (3, None), (4, ""), (5, " \t\n "),
        (6, " ".join(base)), (7, "\t".join(base) + " "), (8, "one"), (9, "ONE"), (10, "a b c d e"),
        (11, " ".join(long)), (12, " ".join(words(50, 7) + passage + words(50, 8))), (13, "\n".join([line] * 40)),
        (14, "naïve Ünïcode ß " * 20), (None, " ".join(base)), (None, None), (12, " ".join(words(50, 7) + passage + words(50, 8))),
        (15, " ".join(passage).upper()), (16, "same " * 100), (17, "!!! ... 123"),
    ]


def test_repeats_against_brute_force(spark, edge):
    for window, gram, group_bytes in ((35, 5, 1 << 20), (35, 5, 0), (35, 5, 1000), (12, 3, 400), (5, 5, 1000)):
        got = substring_dedup.remove_repeats(table(spark, edge), window=window, gram=gram, group_bytes=group_bytes)
        want = [(i, *w) for (i, _), w in zip(edge, brute.repeats([t for _, t in edge], window))]
        key = lambda r: (r[0] is None, r[0] or 0, r[1:])
        assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)
    with pytest.raises(ValueError):
        substring_dedup.cut_repeats(table(spark, edge), window=100, gram=5)


def test_repeats_of_a_passage_that_thousands_of_texts_share(spark, monkeypatch):
    """Its prefixes are lengthened; no group holds more than its bytes allow, and no windows are joined to counts."""
    passage, other = words(60, 70), words(50, 71)
    texts = []
    for i in range(5000):
        own = words(25, 1000 + i)
        texts.append(" ".join(own[:12] + passage + own[12:] + (other[:20 + i % 30] if i % 3 == 0 else [])))
    texts += texts[:50]
    got = substring_dedup.remove_repeats(table(spark, list(enumerate(texts))), group_bytes=100_000)
    want = brute.repeats(texts, 35)
    assert {tuple(r) for r in got.collect()} == {(i, *w) for i, w in enumerate(want)}
    assert all(gone >= 60 for _, gone, _ in want)


def test_repeats_with_very_long_words(spark):
    """A stretch is as large as the number of its words, not as their letters."""
    long = [c * (1 << 20) for c in "xyz"]
    shared = words(10, 72) + long + words(30, 73)
    texts = [" ".join(words(5, 74 + i) + shared + words(5, 84 + i)) for i in range(3)] + ["q" * (2 << 20)]
    got = substring_dedup.remove_repeats(table(spark, list(enumerate(texts))))
    assert {tuple(r) for r in got.collect()} == {(i, *w) for i, w in enumerate(brute.repeats(texts, 35))}


def test_anchor_of_a_window_is_the_leftmost_smallest():
    r = np.random.default_rng(5)
    for width in (1, 2, 3, 7, 31):
        h = r.integers(0, 6, 200).astype(np.uint64)
        want = [i + int(np.argmin(h[i:i + width])) for i in range(len(h) - width + 1)]
        assert substring_dedup.least_in_window(h, width).tolist() == want


def test_near_duplicates_against_brute_force(spark, edge):
    got = minhash_dedup.near_duplicates(spark, table(spark, edge), block=2).collect()
    want = brute.near_groups([(i, t) for i, t in edge if i is not None])
    assert len(got) == len(edge)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
            assert r["kept"] == (r["doc_id"] == r["component_id"])
    kept = minhash_dedup.keep_one_per_group(spark, table(spark, edge))
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == \
        sorted(i for i, _ in edge if i is not None and want[i][1] == i)
    assert kept.columns == table(spark, edge).columns


def test_near_duplicates_of_large_groups_against_brute_force(spark):
    """Groups above a block, members that miss their pivot, bridges between groups and an id with two texts."""
    r = random.Random(11)
    rows, base = [], words(150, 20)
    for i in range(60):
        own = base[:]
        for _ in range(r.choice([0, 1, 2, 3, 5, 8])):
            own[r.randrange(150)] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    other = base[:75] + words(75, 21)
    for i in range(60, 90):
        own = other[:]
        own[r.randrange(150)] = f"x{r.randrange(10**6)}"
        own[r.randrange(150)] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    bridge = [(90 + j, " ".join(base[:75 + 5 * j] + other[75 + 5 * j:])) for j in range(15)]
    for some, block in ((rows, 16), (rows + bridge, 3)):
        got = minhash_dedup.near_duplicates(spark, table(spark, r.sample(some, len(some))), block=block).collect()
        assert {g["doc_id"]: (g["n_shingles"], g["component_id"]) for g in got} == brute.near_groups(some)
    # Id 0 has two texts; id 2 is near the second one only.
    first, second = words(100, 22), words(100, 23)
    twice = [(0, " ".join(first)), (0, " ".join(second)), (1, " ".join(first[:-1])), (2, " ".join(second[:-1]))]
    got = minhash_dedup.near_duplicates(spark, table(spark, twice)).collect()
    assert {g["component_id"] for g in got} == {0}


def test_near_duplicates_of_repeated_rows_against_brute_force(spark):
    """Pairs that meet only in buckets of a smaller id near neither, in a table where every row comes twice."""
    r, rows = random.Random(12), []
    for family in range(10):
        base = words(120, 100 + family)
        for i, changes in enumerate([3] * 20 + [1, 2]):
            own = base[:]
            for at in r.sample(range(5, 115, 10), changes):
                own[at] = f"x{r.randrange(10**6)}"
            rows.append((100 * family + i, " ".join(own)))
    want = brute.near_groups(rows)
    assert sum(i != root for i, (_, root) in want.items()) >= 10
    for some in (rows, rows * 2):
        got = minhash_dedup.near_duplicates(spark, table(spark, r.sample(some, len(some))), block=16).collect()
        assert len(got) == len(some)
        assert {(g["doc_id"], g["n_shingles"], g["component_id"]) for g in got} == \
            {(i, n, root) for i, (n, root) in want.items()}


def test_superminhash_estimates_similarity():
    """The share of equal slots is an unbiased, low-variance estimate; equal sets agree in every slot."""
    r = np.random.default_rng(3)
    for n in (3, 40, 1000):
        a = r.integers(0, 2**63, n).astype(np.uint64)
        b = np.concatenate([a[: n // 2], r.integers(0, 2**63, n - n // 2).astype(np.uint64)])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        sig = minhash_dedup.superminhash(np.concatenate([a, b, a]), np.array([0, n, 2 * n, 3 * n]), 400, 1)
        assert np.isfinite(sig).all() and (sig[0] == sig[2]).all()
        assert abs((sig[0] == sig[1]).mean() - true) < 0.12
        # One rank of each element per slot: a single set's slots hold a permutation of ranks.
        alone = minhash_dedup.superminhash(a[:1], np.array([0, 1]), 64, 1)
        assert sorted(np.floor(alone[0]).astype(int)) == list(range(64))


def test_components_of_paths_and_stars(spark):
    r = random.Random(5)
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(1, i) for i in range(2, 60)]
    edges = path + star + [(500, 500), (700, 600), (600, 650)]
    r.shuffle(edges)
    got = {x["node"]: x["component"] for x in graph.components(
        spark, spark.createDataFrame(edges, "a long, b long"), "test-components").collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 1 for i in range(1, 60)}, 600: 600, 650: 600, 700: 600}
    assert graph.components(spark, spark.createDataFrame([], "a long, b long"), "test-components").count() == 0


def test_exact_duplicates(spark, edge):
    got = exact_dedup.exact_duplicates(spark, table(spark, edge)).collect()
    groups = {}
    for i, t in edge:
        groups.setdefault("".join((t or "").split()), []).append((-len(t or ""), i is None, i))
    assert len(got) == len(edge)
    by_digest = {brute.sha(k): (len(v), min(v, key=lambda x: (x[0], x[1], x[2] or 0))[2]) for k, v in groups.items()}
    for r in got:
        assert (r["group_size"], r["keep_id"]) == by_digest[r["text_sha256"]]
    kept = [r["text_sha256"] for r in got if r["kept"]]
    assert sorted(kept) == sorted(by_digest)  # exactly one row of each group, repeated rows included
    stay = exact_dedup.keep_first_copies(spark, table(spark, edge))
    assert stay.count() == len(groups) and stay.columns == table(spark, edge).columns


def test_exact_state_continues_and_clashes_are_found(spark, tmp_path):
    """Later files meet the state of earlier ones; a digest with two texts is told apart by bytes."""
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "state")
    first = exact_dedup.arrivals(table(spark, [(5, "a b"), (6, "c")]), "doc_id", "text")
    first.write.parquet(folder)
    exact_dedup.keep_state(spark, folder, first.schema, checkpoint)
    exact_dedup.arrivals(table(spark, [(1, "ab "), (2, "d")]), "doc_id", "text").write.mode("append").parquet(folder)
    state = exact_dedup.keep_state(spark, folder, first.schema, checkpoint).collect()
    assert sorted((r["best"]["id"], r["group_size"]) for r in state) == [(1, 2), (2, 1), (6, 1)]
    assert exact_dedup.digest_clashes(spark, table(spark, [(1, "a"), (2, "a ")])).count() == 0


def test_digest_clash_is_resolved_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "_digest", lambda normal: F.unhex(F.sha2(F.substring(normal, 1, 1).cast("binary"), 256)))
    rows = [(1, "aa"), (2, "ab"), (3, "a a"), (4, "b")]
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"])
           for r in exact_dedup.exact_duplicates(spark, table(spark, rows)).collect()}
    assert got == {1: (3, 2, False), 2: (2, 1, True), 3: (3, 2, True), 4: (4, 1, True)}


ITEMS = [("a", 60), ("b", 5), ("c", 0), (None, 20), ("e", 13)]


def test_contamination_against_brute_force(spark, edge):
    sources = {"a": words(60, 2), "b": ["One"], "c": [], None: words(20, 11), "e": words(120, 1)[30:43]}
    items = [(k, " ".join(v)) for k, v in sources.items()] + [("n", None)]
    bench = spark.createDataFrame(items, "item_id string, text string")
    want = brute.contamination([t for _, t in edge], [(k or "", t) for k, t in items if t is not None])
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    for block_bytes in (1 << 20, 10):  # one block of items, and one per item
        got = decontaminate.contamination(spark, table(spark, edge), bench, block_bytes=block_bytes).collect()
        assert sorted((tuple(r) for r in got), key=key) == sorted(((i, *w) for (i, _), w in zip(edge, want)), key=key)
        clean = decontaminate.drop_contaminated(spark, table(spark, edge), bench, block_bytes=block_bytes)
        assert clean.count() == sum(not w[3] for w in want) and clean.columns == table(spark, edge).columns
    found = decontaminate.longest_matches(spark, table(spark, edge), bench).where("doc_id = 12 and item_id = 'a'")
    assert {(r["item_word"], r["word"], r["n_words"]) for r in found.collect()} == {(0, 50, 60)}
    none = decontaminate.contamination(spark, table(spark, edge), bench.where("false"))
    assert none.where("contaminated or n_hit > 0").count() == 0


def test_windows_that_items_share_are_one_class():
    """A template of 100,000 items in 2,000 places: memory and output follow the results, not the pairs of windows."""
    import tracemalloc
    from types import SimpleNamespace

    template = words(13, 90)
    n, places = 100_000, 2000
    test = decontaminate.index_items([(f"i{k}", " ".join(template + [f"own{k}"])) for k in range(n)], 13)
    assert len(test.starts) == n + 1 and len(test.window_start) == 2 * n
    one = " ".join(template)
    text = ("x " + one + " ") * places
    batch = decontaminate.pa.RecordBatch.from_arrays(
        [decontaminate.pa.array([0, 0, 0]), decontaminate.pa.array([1, 2, 3]), decontaminate.pa.array([text, "none", one])],
        names=["row", "doc", "text"])
    tracemalloc.start()
    got = [r for out in decontaminate._hits(SimpleNamespace(value=test))(iter([batch])) for r in
           zip(out.column("doc").to_pylist(), [len(x) // 2 for x in out.column("ranges").to_pylist()],
               out.column("items").value_lengths().to_pylist())]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == [(1, places, n), (2, 0, 0), (3, 1, n)] and peak < 500e6


def test_longest_matches_against_brute_force(spark):
    r = random.Random(21)
    letters = "abc"
    items = [(f"i{k}", " ".join(r.choice(letters) for _ in range(r.randrange(0, 14)))) for k in range(12)]
    items += [("i1", "a b c a b c a b"), ("i12", items[3][1])]
    docs = [(d, " ".join(r.choice(letters) for _ in range(r.randrange(0, 40)))) for d in range(25)] + [(None, "a b c a b c a b"), (30, None)]
    want = set()
    for d, text in docs:
        t = (text or "").split()
        for name, item in items:
            w = item.split()
            n = min(4, len(w))
            for p in range(len(t)):
                for q in range(len(w)):
                    size = 0
                    while p + size < len(t) and q + size < len(w) and t[p + size] == w[q + size]:
                        size += 1
                    if size >= n and not (p and q and t[p - 1] == w[q - 1]):
                        want.add((d, name, q, p, size))
    bench = spark.createDataFrame(items, "item_id string, text string")
    for block_bytes in (1 << 20, 10):
        got = decontaminate.longest_matches(spark, table(spark, docs), bench, window=4, block_bytes=block_bytes).collect()
        assert {tuple(x) for x in got} == want
    # A match of many thousand words is one row, found without walking back from each of its windows.
    long = words(30_000, 91)
    got = decontaminate.longest_matches(
        spark, table(spark, [(1, " ".join(["x"] + long))]), spark.createDataFrame([("l", " ".join(long))], "item_id string, text string"))
    assert [tuple(x) for x in got.collect()] == [(1, "l", 0, 1, 30_000)]


def test_language_id_held_out_accuracy_and_edges(spark):
    found = queries.op8_mixture_language_id(spark, SF).join(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert found.count() > 20 and right > 0.95
    docs = table(spark, [(1, "la casa de la que", "es"), (3, "the thing of and that", "en"), (2, None, None), (4, "12 ...", None),
                         (5, "", "es"), (6, "日本 語", None), (7, "☃ ✓", None), (None, "the that", "en")],
                 "doc_id long, text string, lang string")
    model = language_id.train(docs)
    assert model.langs == ["en", "es"]
    got = {r["doc"]["doc_id"]: r for r in language_id.identify(spark, docs, model).collect()}
    assert got[1]["lang_pred"] == "es" and got[3]["lang_pred"] == "en"
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 and got[i]["langs"] == [] for i in (2, 4, 5, 7))
    assert got[6]["lang_pred"] in ("en", "es") and all(0 <= r["score"] <= 1 for r in got.values())
    blank = language_id.train(docs.where("false"))
    assert {r["lang_pred"] for r in language_id.identify(spark, docs, blank).collect()} == {"und"}


def test_rows_with_letters_stay_without_usable_labels(spark):
    texts = ["the thing of", None, "", "12 ...", "日本 語", "☃ ✓", "x", "𐐀"]
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2][:len(texts)]
    for lang in (None, "en"):  # no labels; labels on held-out rows only
        docs = table(spark, [(i, t, lang) for i, t in zip(held, texts)], "doc_id long, text string, lang string")
        kept = language_id.drop_unknown(spark, docs)
        assert kept.columns == docs.columns
        assert sorted(r["doc_id"] for r in kept.collect()) == [held[j] for j in (0, 4, 6, 7)]


def test_labels_that_are_no_languages_are_refused(spark):
    rows = spark.range(40).select(F.lit("some words").alias("text"), F.concat(F.lit("l"), F.col("id")).alias("lang"))
    with pytest.raises(ValueError, match="labels"):
        language_id.train(rows, most_langs=39)
    assert len(language_id.train(rows, most_langs=40).langs) == 40


def test_few_rounds_name_the_language_that_convergence_names(spark):
    """Expectation-maximisation by ``steps`` rounds against 500 rounds, on texts of one and of two languages."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang is not null").orderBy("doc_id").limit(120)
    texts = [r["text"] for r in docs.collect()]
    texts += [a + " " + b for a, b in zip(texts[:40], texts[40:80])]
    few = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = language_id.train(docs)
    got = {steps: {r["doc"]["doc_id"]: r for r in language_id.identify(spark, few, model, steps=steps).collect()} for steps in (6, 500)}
    same = sum(got[6][i]["lang_pred"] == got[500][i]["lang_pred"] for i in got[6])
    assert same >= 0.99 * len(texts)
    assert np.mean([abs(got[6][i]["score"] - got[500][i]["score"]) for i in got[6]]) < 0.02


def test_language_mixture_finds_both_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang in ('en', 'de')")
    model = language_id.train(docs)
    en, de = (" ".join(r["text"] for r in docs.where(f"lang = '{x}'").limit(3).collect()).split()[:300] for x in ("en", "de"))
    mixed = spark.createDataFrame([(1, " ".join(en + de)), (2, " ".join(en))], "doc_id long, text string")
    got = {r["doc"]["doc_id"]: r for r in language_id.identify(spark, mixed, model).collect()}
    assert sorted(got[1]["langs"]) == ["de", "en"] and abs(got[1]["shares"][0] - 0.5) < 0.15
    assert got[2]["lang_pred"] == "en" and got[2]["score"] > 0.9


def test_packing_patterns_hold_every_piece():
    r = random.Random(9)
    for _ in range(50):
        size = r.choice([1, 7, 64, 2048])
        histogram = {r.randint(1, size): r.randint(1, 500) for _ in range(r.randint(1, 30))}
        found = packing.patterns(histogram, size)
        held = {}
        for lengths, packs in found:
            assert sum(lengths) <= size and packs > 0
            for x in lengths:
                held[x] = held.get(x, 0) + packs
        assert held == histogram


def test_packing_round_trip(spark, edge, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 3)  # several rank groups for one length
    rows = edge + [(100 + i, "same text here") for i in range(20)] + [(200, "mark <|endoftext|> inside")]
    got = packing.pack(spark, table(spark, rows), size=64).toPandas()
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokens.vocabulary().json)
    want = sorted(zlib.crc32(np.array(ids[s:s + 64], "<u4").tobytes())
                  for ids in ([*whole.encode(t or "", add_special_tokens=False).ids, 1] for _, t in rows)
                  for s in range(0, len(ids), 64))
    assert sorted(got["ids_crc32"]) == want
    got = got.sort_values(["sequence_id", "offset"])
    ends = got.groupby("sequence_id")["length"].cumsum()
    assert (ends - got["length"] == got["offset"]).all() and ends.max() <= 64
    assert sorted(got["sequence_id"].unique()) == list(range(got["sequence_id"].max() + 1))
    assert packing.pack(spark, table(spark, [])).count() == 0


def test_encoding_equals_tokenizers(spark):
    from tokenizers import Tokenizer

    where = tokens.vocabulary()
    whole, encode = Tokenizer.from_file(where.json), tokens.encoder(where)
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    texts += ["", " ", "\n\n \t x", "a'll  b\u00a0c\u2003d", "naïve 日本語 ☃️ ١٢٣ ½", "<|endoftext|> x <|endoftext|>", "\x00\x01"]
    assert all(encode(t) == whole.encode(t, add_special_tokens=False).ids for t in texts)


def test_encoding_of_very_long_white_space():
    from tokenizers import Tokenizer

    where = tokens.vocabulary()
    whole, encode = Tokenizer.from_file(where.json), tokens.encoder(where)
    for t in (" " * 1_200_000, "\n" * 1_200_000, "a" + "\u3000" * 1_200_000 + "b", "a" + " " * 99_999 + "b",
              "a\n" + "\t " * 50_000 + "b"):
        assert encode(t) == whole.encode(t, add_special_tokens=False).ids


def test_training_order(spark, edge):
    for total in (1, 2, 3, 64, 1000, 4097):
        p = training_order.positions(np.arange(total), total, 7)
        assert sorted(p.tolist()) == list(range(total))
        assert total < 64 or (p != training_order.positions(np.arange(total), total, 8)).any()
    folder = shared_dir(spark, "order-test")
    got = training_order.materialise(spark, table(spark, edge), folder, stride=16, shards=5, pad_id=9).toPandas().sort_values("slot")
    assert got["slot"].tolist() == list(range(len(got)))
    encode = tokens.encoder(tokens.vocabulary())
    want = sorted(tuple(ids[s:s + 16]) for ids in ([*encode(t or ""), 1] for _, t in edge) for s in range(0, len(ids), 16))
    records = training_order.read_slots(folder, 0, len(got) + 10)
    assert sorted(tuple(r[:n].tolist()) for r, n in zip(records, got["length"])) == want
    assert all((r[n:] == 9).all() for r, n in zip(records, got["length"]))
    assert all(zlib.crc32(r[:n].astype("<u4").tobytes()) == c
               for r, n, c in zip(records, got["length"], got["ids_crc32"]))
    for first, n in ((0, 1), (3, 50), (len(got) - 1, 5), (len(got), 3)):  # resumes anywhere
        assert (training_order.read_slots(folder, first, n) == records[first:first + n]).all()
    empty = training_order.materialise(spark, table(spark, []), shared_dir(spark, "order-test"))
    assert empty.count() == 0


def test_training_order_does_not_depend_on_the_split(spark, tmp_path):
    """Other file splits, cores and partitions: the same slots, shards and order.json; other keys, other slots."""
    rows = [(i, " ".join(words(3 + i * 7 % 90, i))) for i in range(300)] + [(300, None), (None, "x"), (3, "twice")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "docs"))
    setting, found = "spark.sql.files.maxPartitionBytes", []
    before = spark.conf.get(setting)
    for split, key in (("128m", 1), ("1k", 1), ("9k", 2)):
        spark.conf.set(setting, split)
        try:
            folder = shared_dir(spark, "order-test")
            docs = spark.read.parquet(str(tmp_path / "docs"))
            got = training_order.materialise(spark, docs, folder, stride=32, key=key)
            slots = sorted((r["slot"], r["ids_crc32"], r["shard"], r["byte_offset"]) for r in got.collect())
            with open(f"{folder.removeprefix('file://')}/order.json") as file:
                found.append((slots, json.load(file) | {"key": 0}))
        finally:
            spark.conf.set(setting, before)
    assert found[0] == found[1] and found[0][0] != found[2][0]
    assert sorted(c for _, c, _, _ in found[0][0]) == sorted(c for _, c, _, _ in found[2][0])


def test_url_rules(spark):
    urls = ["http://a.net/x", "http://NET/", "https://blog.example.net/en/1", "http://example.net/english", "http://example.com/de/q?x#y",
            "http://example.com/den", "ftp://x.org/fr/", "http://net", "http://xnet/", "no url", None, "", "http://example.net/en/1#/de/",
            "http://a.example.com:80/de/", "x://y://z.net/", "http://example.net/en/1"]
    pages = table(spark, list(enumerate(urls)), "page_id long, url string")
    rules = spark.createDataFrame(queries.URL_RULES + [("net", "/", "block"), (None, "/", "block")],
                                  "host string, path string, verdict string")
    got = {r["page_id"]: r for r in url_filter.judge_urls(spark, pages, rules).collect()}
    want = {0: "net/", 1: "net/", 2: "example.net/en/", 3: "net/", 4: "example.com/de/", 5: None, 6: "org/fr/", 7: None,
            8: None, 9: None, 10: None, 11: None, 12: "example.net/en/", 13: None, 14: None, 15: "example.net/en/"}
    assert {i: r["rule"] for i, r in got.items()} == want
    verdict = {h + p: v for h, p, v in queries.URL_RULES}
    assert all(r["verdict"] == verdict.get(r["rule"], "allow") for r in got.values())
    assert (got[10]["host"], got[10]["path"], got[1]["host"], got[4]["path"]) == ("", "", "net", "/de/q")
    none = url_filter.judge_urls(spark, pages, rules.where("false"), default="block")
    assert {r["verdict"] for r in none.collect()} == {"block"} and none.count() == len(urls)


def test_bloom_filter_passes_every_listed_key_and_few_others(spark):
    keys = spark.range(20000).select(F.xxhash64("id").alias("h"))
    blocks = 1 << 11
    bloom = url_filter.bloom_blocks(keys, blocks)
    probe = spark.range(40000).select("id", F.xxhash64("id").alias("h")).withColumn("block", url_filter._block(F.col("h"), blocks))
    passed = probe.join(bloom, "block")
    for j in range(url_filter.LANES):
        passed = passed.where(F.col(f"lane{j}").bitwiseAND(url_filter._bit(F.col("h"), j)) != 0)
    assert passed.where("id < 20000").count() == 20000
    assert passed.where("id >= 20000").count() < 400


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href="/a">Menu one</a>
<li><a href="/b">Menu two</a></ul></nav><div class="ad">Buy this now.</div>%s<h1>Head &amp; line</h1>
<p>First <b>bold</b>text of the story, with enough words to count as prose, and more.<br>Next line
<p>Second&nbsp;paragraph of the story, again with a good number of words in it, and a <a href="/x">link</a>.</p>
<script>var t = "</p>";</script><section class="comments"><p>Great story, thanks a lot!</p></section>%s
<footer>&copy; somebody</footer><form><input><p>Sign up here.</p></form></body></html>"""
TEXT = ("Head & line First boldtext of the story, with enough words to count as prose, and more. Next line "
        "Second paragraph of the story, again with a good number of words in it, and a link.")


def test_extraction(spark):
    model = html_extract.train(spark, spark.read.parquet(f"{SF}/pages.parquet"))
    rows = [(1, PAGE % ("<article>", "</article>")), (2, PAGE % ('<div id="content">', "</div>")), (3, None), (4, ""),
            (5, "plain < text"), (6, "<div>" * 5000 + "deep"), (7, "<!-- open"), (1, PAGE % ("<article>", "</article>"))]
    got = html_extract.extract(spark, table(spark, rows, "page_id long, html string"), model).collect()
    assert len(got) == len(rows)
    text = {r["page"]["page_id"]: r["text"] for r in got}
    assert text[1] == TEXT and text[2] == TEXT and text[3] == text[4] == text[7] == ""
    empty = html_extract.train(spark, spark.createDataFrame([], "page_id long, html string"))
    assert empty.trees == [] and html_extract.extract(
        spark, spark.createDataFrame([], "page_id long, html string"), empty).count() == 0


def test_extraction_of_pages_without_head_end_or_blocks(spark):
    """A head ends at the first thing that it cannot hold; text at top level is judged like any other."""
    model = html_extract.train(spark, spark.read.parquet(f"{SF}/pages.parquet"))
    say = "The river rose in the night, and by the morning the whole lower town stood under water."
    rows = [(1, f"<html><head><title>T</title><meta x><script>s</script><h1>Flood</h1><p>{say}</p>", f"Flood {say}"),
            (2, f"<head><title>T</title>\n{say}", say), (3, f"<head><head><title>T</title><p>{say}", say), (4, say, say),
            (5, f"{say}<br>{say} <b>More</b> of it", f"{say} {say} More of it"), (6, "plain < text", "plain < text"),
            (7, f'{say}<div class="nav"><a href="x">Home</a></div>{say}', f"{say} {say}"),
            (8, f"<title>T</title><head><noscript>no</noscript></head><p>{say}", say)]
    pages = table(spark, [r[:2] for r in rows], "page_id long, html string")
    got = html_extract.extract(spark, pages, model).collect()
    assert {r["page"]["page_id"]: r["text"] for r in got} == {i: text for i, _, text in rows}
    whole = {i: text for i, _, text in rows} | {7: f"{say} Home {say}"}
    responses = warc_derive.responses_of_pages(pages.withColumn("url", F.lit("http://a/")))
    for r in warc_derive.derive(responses, "key").where("warc_type = 'conversion'").collect():
        assert r["block"] == whole[r["key"]]


def test_extraction_of_the_given_pages(spark):
    import html
    import re

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    right = 0
    for r in queries.op2_boosted_tree_extraction(spark, SF).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        plain = re.sub(r"<[^>]+>", "", re.sub(r"</?(p|h1|br|ul|li|div)[^>]*>", " ", article))
        right += r["text"] == " ".join(html.unescape(plain).split()) and r["n_chars"] == len(r["text"])
    assert right == len(pages)


def test_decoding_never_contradicts_ancestors():
    r = np.random.default_rng(1)
    for _ in range(50):
        n = int(r.integers(1, 40))
        parent = [-1] + [int(r.integers(0, i)) for i in range(1, n)]
        margin, own = r.normal(0, 3, n), r.integers(0, 200, n)
        kept = html_extract.decode(parent, margin, own)
        for i in range(1, n):
            above, cut = parent[i], False
            while above > 0:
                cut |= not kept[above] and any(kept[a] for a in _ancestors(parent, above))
                above = parent[above]
            assert not (kept[i] and cut)  # nothing inside a part that was cut out


def _ancestors(parent, i):
    while parent[i] > 0:
        i = parent[i]
        yield i


def test_page_reading():
    page = dom.Page("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table><p>e<p>f<textarea><p>no</textarea>g</div>h")
    assert page.text([True] * len(page.tag)) == "a b c d e fgh"


def test_warc_derivatives(spark, tmp_path):
    rows = [(1, "http://a/x y\r\n", PAGE % ("<article>", "</article>")), (2, None, None), (None, "http://b/", "<p>x"),
            (1, "http://a/x y\r\n", PAGE % ("<article>", "</article>"))]
    responses = warc_derive.responses_of_pages(table(spark, rows, "page_id long, url string, html string"))
    sources = {r["record_id"]: r for r in responses.collect()}
    derived = warc_derive.derive(responses, "key")
    got = derived.collect()
    assert len(got) == 2 * len(rows)
    for r in got:
        source = sources[r["refers_to"]]
        assert r["source_digest"] == source["payload_digest"] and r["digest_ok"]
        assert r["block_digest"] == warc_derive.sha1_digest(r["block"].encode()) and r["content_length"] == len(r["block"].encode())
        assert f"WARC-Refers-To: {r['refers_to']}\r\n" in r["header"] and "\r\nx" not in r["header"]
        if r["warc_type"] == "metadata":
            meta = json.loads(r["block"])["Envelope"]["Payload-Metadata"]["HTTP-Response-Metadata"]
            assert meta["Headers"]["content-type"].startswith("text/html")
            assert meta["Entity-Digest"] == r["source_digest"]
    first = next(r for r in got if r["key"] == 1 and r["warc_type"] == "conversion")
    assert "boldtext of the story" in first["block"] and "var t" not in first["block"]
    assert sorted(r["record_id"] for r in got) == sorted(r["record_id"] for r in derived.collect())  # repeatable

    index = warc_derive.write_warc(derived, str(tmp_path / "warc")).collect()
    blocks = {r["record_id"]: r for r in got}
    assert len(index) == len(got)
    for r in index:
        with open(r["file"], "rb") as file:
            file.seek(r["offset"])
            data = gzip.decompress(file.read(r["length"])).decode()
        assert data == blocks[r["record_id"]]["header"] + blocks[r["record_id"]]["block"] + "\r\n\r\n"

    other = spark.createDataFrame([
        (1, "<urn:x>", "u", "d", "sha1:WRONG", bytearray(b"HTTP/1.1 200 OK\r\nContent-Type: image/png\r\n\r\n\x89")),
        (2, "<urn:y>", None, None, None, None)], "key long, " + warc_derive.RESPONSE)
    assert [(r["key"], r["warc_type"], r["digest_ok"]) for r in warc_derive.derive(other, "key").collect()] == \
        [(1, "metadata", False), (2, "metadata", True)]


def test_warc_repeated_headers_and_upper_case_content_type(spark):
    block = (b"HTTP/1.1 200 OK\r\nSet-Cookie: a=1\r\nContent-Type: Text/HTML; Charset=UTF-8\r\nset-cookie: b=2\r\n"
             b"Server: s\r\n\r\n<title>T</title><p>text <a href='/x'>link</a>")
    other = spark.createDataFrame([(1, "<urn:x>", "u", "d", None, bytearray(block))], "key long, " + warc_derive.RESPONSE)
    got = {r["warc_type"]: r["block"] for r in warc_derive.derive(other, "key").collect()}
    meta = json.loads(got["metadata"])["Envelope"]["Payload-Metadata"]["HTTP-Response-Metadata"]
    assert meta["Headers"] == {"set-cookie": ["a=1", "b=2"], "content-type": "Text/HTML; Charset=UTF-8", "server": "s"}
    assert meta["HTML-Metadata"] == {"Title": "T", "Links": [{"path": "a@/href", "url": "/x"}]}
    assert got["conversion"] == "text link"


def test_empty_tables(spark):
    docs, pages = table(spark, []), table(spark, [], "page_id long, url string, html string")
    bench = spark.createDataFrame([], "item_id string, text string")
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    for out in (substring_dedup.remove_repeats(docs), minhash_dedup.near_duplicates(spark, docs),
                exact_dedup.exact_duplicates(spark, docs), exact_dedup.keep_first_copies(spark, docs),
                decontaminate.contamination(spark, docs, bench), decontaminate.longest_matches(spark, docs, bench),
                url_filter.judge_urls(spark, pages, rules),
                warc_derive.derive(warc_derive.responses_of_pages(pages), "key")):
        assert out.count() == 0 and isinstance(out.schema, StructType)


def test_sql_twins(spark):
    import oracle_compare

    found = oracle_compare.compare(spark, SF, sorted(queries.ORACLE_SQL))
    assert set(found) == set(queries.ORACLE_SQL) and all(v.startswith("ok") for v in found.values()), found


def test_native_queries_run_no_python(spark):
    from conftest import plan_text

    for name in ("op4_bloom_url_filter", "op9_streaming_exact_dedup"):
        plan = plan_text(queries.QUERIES[name](spark, SF))
        assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "ExistingRDD", "Cartesian"))


def test_pipeline_against_brute_force(spark):
    """Every stage's decisions, recomputed in plain Python on the rows that the stage before kept."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = store.table(spark, stage(spark, docs, SF), f"test-{name}")
        assert out.columns == docs.columns
        kept = {r["doc_id"] for r in out.collect()}
        if name == "language_id":
            want = {i for i, t in rows.items() if any(c.isalpha() for c in t or "")}
        elif name == "exact_dedup":
            best = {}
            for i, t in rows.items():
                k = "".join((t or "").split())
                best[k] = min(best.get(k, (1, 0)), (-len(t or ""), i))
            want = {i for _, i in best.values()}
        elif name == "near_dedup":
            want = {i for i, (_, root) in brute.near_groups(sorted(rows.items())).items() if root == i}
        else:
            ids = sorted(rows)
            want = {i for i, w in zip(ids, brute.contamination([rows[i] for i in ids], bench)) if not w[3]}
        assert kept == want, name
        rows, docs = {i: rows[i] for i in kept}, out
    packed = corpus_pipeline.run(spark, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == set(rows)
