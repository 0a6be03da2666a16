"""Malformed pages and responses, repeated ids and columns with the names used inside."""

from __future__ import annotations

import gzip
import json
import os
import sys
import time
import zlib

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tracelens.llm import dom, exact_dedup, html_extract, minhash_dedup, warc_derive  # noqa: E402

SIZE = 1 << 20


@pytest.mark.parametrize("source", [
    *(unit * (SIZE // len(unit)) for unit in (
        "<a", "<!", "<a ", "<title>", "<p ", "<p>", '<a x="', "<a x='>", "<!--", "<script>", "</script ", "<div>", "<svg>", '<a ">" ',
        "<span class=ad>", "</x>", "&#9", '"<a', "<?", "<a href='")),
    "<div>" * 100_000 + "</x>" * 100_000, "<svg>" * 100_000 + "</x>" * 100_000, "<svg>" * 100_000 + "</svg>" * 100_000,
    "<p><li>" + "<span class=ad>" * 40_000 + "<div></div>" * 40_000, "<li><ul>" + "<div>" * 80_000 + "<li></li>" * 60_000,
    "&#" + "9" * SIZE, "<script>" + "</script " * 100_000, "<a " * 100_000 + '">', "<title>" + "</title " * 100_000,
], ids=lambda s: s[:12])
def test_a_megabyte_of_malformed_markup_is_read_at_once(source):
    began = time.process_time()
    page = dom.Page(source)
    read = time.process_time() - began
    warc_derive.links_and_title(page)
    html_extract.with_asides(source)
    took = time.process_time() - began
    machine = time.process_time()  # some two seconds of plain Python on this machine, as a measure
    sum(i * i % 7 for i in range(10_000_000))
    machine = time.process_time() - machine
    assert read < 6 * machine and took < 12 * machine


def test_markup_that_ends_early_is_text_or_a_tag_up_to_the_next_bracket():
    page = dom.Page('a < b <c <d "x> e <p class="x>f</p>g <!-- h')
    assert page.text([True] * len(page.tag)) == "a < b fg"  # the quotes close round the second bracket
    assert dom.Page("x &#99999999999999999999; &#x41; &#65").text([True] * 2) == "x � A A"
    page = dom.Page("<p>one<p <b>two</b <p>three")
    assert page.text([True] * len(page.tag)).split() == ["one", "twothree"]  # the third one is inside an end tag


def test_links_and_title_come_from_tags():
    links, title = warc_derive.links_and_title(dom.Page(
        '<!-- <a href="no"> --><TITLE>A &amp;\n B</title><title>C</title><script src=s.js>"<a href=no>"</script>'
        '<a data-href="no" HREF = "x?a=1&amp;b">t</a><img alt="src=no" src=\'i.png\'><p href="no"><a name=n><form action=/f>'))
    assert title == "A & B"
    assert links == [{"path": "script@/src", "url": "s.js"}, {"path": "a@/href", "url": "x?a=1&b"},
                     {"path": "img@/src", "url": "i.png"}, {"path": "form@/action", "url": "/f"}]


def response(head: bytes, body: bytes) -> bytearray:
    return bytearray(b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + head + b"\r\n\r\n" + body)


def chunks(body: bytes, size: int) -> bytes:
    return b"".join(b"%x;ext=1\r\n%s\r\n" % (len(part), part) for part in
                    (body[i:i + size] for i in range(0, len(body), size))) + b"0\r\nTrailer: x\r\n\r\n"


def test_chunked_and_compressed_bodies_are_undone(spark):
    page = "<title>Tü</title><p>Straße eins</p>".encode()
    raw = zlib.compressobj(wbits=-15)
    deflated = raw.compress(page) + raw.flush()
    half = len(page) // 2
    bodies = {
        1: (b"Transfer-Encoding: chunked", chunks(page, 7), page),
        2: (b"Content-Encoding: gzip", gzip.compress(page), gzip.compress(page)),
        3: (b"Content-Encoding: gzip\r\nTransfer-Encoding: Chunked", chunks(gzip.compress(page, mtime=0), 11), gzip.compress(page, mtime=0)),
        4: (b"Content-Encoding: deflate", zlib.compress(page), zlib.compress(page)),
        5: (b"Content-Encoding: deflate", deflated, deflated),
        6: (b"Content-Encoding: x-gzip, identity", gzip.compress(page[:half]) + gzip.compress(page[half:]), None),
        7: (b"Transfer-Encoding: chunked", page, page),  # says so, and is not
        8: (b"Content-Encoding: gzip", page, page),
        9: (b"Transfer-Encoding: chunked", b"ffffffff\r\n" + page, b"ffffffff\r\n" + page),
        10: (b"Content-Encoding: gzip", gzip.compress(page) + b"tail", None),
    }
    rows = [(k, f"<urn:{k}>", "u", "d", warc_derive.sha1_digest(b[2]) if b[2] else None, response(b[0], b[1])) for k, b in bodies.items()]
    rows += [(20, "<urn:20>", "u", "d", warc_derive.sha1_digest(bodies[1][1]), response(*bodies[1][:2])),  # digest of the chunks
             (21, None, "u", "d", None, response(b"X: y", page))]
    got = warc_derive.derive(spark.createDataFrame(rows, "key long, " + warc_derive.RESPONSE), "key").collect()
    text = {r["key"]: r["block"] for r in got if r["warc_type"] == "conversion"}
    assert {k: t for k, t in text.items() if k != 9} == {k: "Straße eins" for k in [*range(1, 9), 10, 20, 21]}
    assert text[9].endswith("Straße eins")
    assert all(r["digest_ok"] for r in got)
    assert all(("WARC-Refers-To:" in r["header"]) == (r["key"] != 21) for r in got)


def test_header_values_cannot_break_lines(spark):
    rows = [(1, "<urn:a>\r\nX-Evil: 1", "http://a/\r\nb c", "2020\r\nX: y", "sha1:A\r\n\r\nB", response(b"X: y", b"<p>t"))]
    for r in warc_derive.derive(spark.createDataFrame(rows, "key long, " + warc_derive.RESPONSE), "key").collect():
        head, mark, rest = r["header"].partition("\r\n\r\n")
        assert mark and not rest
        lines = head.split("\r\n")[1:]
        names = [line.split(": ")[0] for line in lines]
        assert len(set(names)) == len(names) == 11 and all(n.startswith(("WARC-", "Content-")) for n in names)
        json.loads(r["block"]) if r["warc_type"] == "metadata" else None


CLASHING = "doc_id long, text string, __own string, __id long, __digest string, __gone long, whole string, id long, n long, kept boolean"


@pytest.mark.parametrize("turned", [False, True])
def test_the_exact_stage_keeps_the_row_of_the_operator(spark, turned):
    rows = [(1, "ab"), (1, "a b"), (1, "a b"), (2, "ab "), (3, "x"), (3, "x"), (None, "y"), (None, " y"), (4, None), (5, " ")]
    rows = rows[::-1] if turned else rows
    docs = spark.createDataFrame([(*r, f"own{i}", i, "d", 1, "w", i, i, False) for i, r in enumerate(rows)], CLASHING)
    kept = exact_dedup.keep_first_copies(spark, docs)
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    # Of equal texts the most code points stay, then the smallest id.
    assert got == sorted([(1, "a b"), (3, "x"), (None, " y"), (5, " ")], key=str)
    decided = exact_dedup.exact_duplicates(spark, docs).where("kept").collect()
    assert sorted((r["doc_id"] for r in decided), key=str) == sorted((i for i, _ in got), key=str)
    every = {(r["doc_id"], r["text"], r["__own"], r["__id"], r["__digest"], r["__gone"]) for r in docs.collect()}
    assert all((r["doc_id"], r["text"], r["__own"], r["__id"], r["__digest"], r["__gone"]) in every for r in kept.collect())


def test_the_near_stage_keeps_columns_of_any_name(spark):
    text = " ".join(f"w{i}" for i in range(50))
    docs = spark.createDataFrame([(i, t, "o", 1, "d", i, "w", i, i, True) for i, t in enumerate([text, text + " x", "other"])], CLASHING)
    kept = minhash_dedup.keep_one_per_group(spark, docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [0, 2]


def test_functions_are_shipped_without_the_tables_of_the_driver():
    """What the driver has hashed itself does not travel with the functions of later plans."""
    from pyspark import cloudpickle

    from tracelens.llm import decontaminate, substring_dedup
    from tracelens.llm import text as tx

    decontaminate.index_items([("a", "some words of an item " * 9)], 13)
    assert tx._powers
    for f in (minhash_dedup._sketches(5, 40, 5, 1), substring_dedup._prefixes(35, 5), minhash_dedup._verify(5, 75)):
        assert len(cloudpickle.dumps(f)) < 200_000
    h = tx.hash_words(*tx_words("a bc a"))
    assert h[0] == h[2] != h[1] and len(cloudpickle.loads(cloudpickle.dumps(tx.hash_words))(*tx_words("a bc a"))) == 3


def tx_words(text):
    import numpy as np

    from tracelens.llm import text as tx

    buf = np.frombuffer(text.encode(), dtype=np.uint8)
    starts, ends, _ = tx.words(buf, np.array([0, len(buf)]), tx.space_words())
    return buf, starts, ends


def test_a_text_longer_than_the_kept_tables_is_hashed_alike():
    from tracelens.llm import text as tx

    size = 2 * tx.BLOCK_BYTES
    buf, starts, ends = tx_words("word " * (size // 5 + 100) + "other word")
    h = tx.hash_words(buf, starts, ends)
    assert (h[:-2] == h[0]).all() and h[-1] == h[0] != h[-2] and len(tx._powers[str(tx._BASE)]) <= size


def test_names_of_both_kinds_speak_against_main_text(spark):
    say = "The river rose in the night, and by the morning the whole lower town stood under water."
    labels = html_extract.weak_labels(dom.Page(f'<article><p>{say}</p><div class="comment-content"><p>{say}</p></div></article>'
                                               f'<div id="main-menu"><p>{say}</p></div>'))
    assert labels.tolist() == [-1, 1, 1, 0, 0, 0, 0]


def test_margins_are_those_of_the_fitted_trees(spark):
    """The trees that tasks evaluate give Spark's own raw predictions."""
    import numpy as np
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector
    from types import SimpleNamespace

    r = np.random.default_rng(4)
    x = r.normal(size=(400, len(html_extract.FEATURES))).round(3)
    y = (x[:, 0] + x[:, 3] * x[:, 5] > 0.2).astype(float)
    df = spark.createDataFrame([(float(b), [float(v) for v in a]) for a, b in zip(x, y)], "label double, values array<double>") \
        .select("label", array_to_vector("values").alias("values"))
    fitted = GBTClassifier(featuresCol="values", labelCol="label", maxIter=6, maxDepth=4, seed=7).fit(df)
    own = html_extract.margins(SimpleNamespace(base=0.0, trees=html_extract._tree_tables(fitted.toDebugString)), x)
    raw = np.array([v["rawPrediction"][1] for v in fitted.transform(df).collect()])
    assert np.allclose(own, 2 * raw) or np.allclose(own, raw)


def test_the_training_sample_is_bounded_by_distinct_pages(spark, monkeypatch):
    say = "The river rose in the night, and by the morning the whole lower town stood under water."
    pages = spark.createDataFrame([(i % 30, f"<article><p>{say} {i % 30}</p></article><div class=ad><p>{say}</p></div>")
                                   for i in range(90)], "page_id long, html string")
    seen, keep = [], html_extract.table
    monkeypatch.setattr(html_extract, "table", lambda s, df, name: seen.append(keep(s, df, name)) or seen[-1])
    html_extract.train(spark, pages, sample_pages=10, rounds=2)
    per_page = len(html_extract.node_features(dom.Page(pages.first()["html"]))[0])
    assert 0 < seen[0].count() <= 10 * 2 * 3 * per_page


def test_a_failed_attempt_leaves_no_file(tmp_path):
    from tracelens.llm.files import whole_file

    with pytest.raises(ZeroDivisionError), whole_file(str(tmp_path), "a.bin") as out:
        out.write(b"half")
        1 / 0
    assert os.listdir(tmp_path) == []
    with whole_file(str(tmp_path), "a.bin") as out:
        out.write(b"whole")
    assert os.listdir(tmp_path) == ["a.bin"]


def test_scratch_tables_go_with_their_block(spark):
    from tracelens.llm.store import scratch, scratch_dir, table

    outer = scratch_dir(spark, "scratch-test")
    with scratch(spark):
        inner = scratch_dir(spark, "scratch-test")
        assert table(spark, spark.range(3), "scratch-test").count() == 3
        for path in (outer, inner):
            spark.range(5).write.parquet(path)
    assert spark.read.parquet(outer).count() == 5
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(inner)
