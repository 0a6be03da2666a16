"""Published results, the ledger of malformed lines and states of part files."""

from __future__ import annotations

import os
import subprocess
import sys
import textwrap
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import ROOT, plan_text, rows
from tracelens.operators.partials import merged_counts, merged_sketches, update_states
from tracelens.session import shared_dir
from tracelens.sources import ledger as L
from tracelens.sources import published as P


def test_readers_follow_the_manifest(spark):
    path = shared_dir(spark, "published-test")
    assert P.published_version(spark, path) is None
    with pytest.raises(FileNotFoundError):
        P.read_published(spark, path)
    assert P.publish(spark.range(3), path) == 1
    held = P.read_published(spark, path)
    assert P.publish(spark.range(5).withColumn("x", F.lit("a")), path) == 2
    assert P.read_published(spark, path).columns == ["id", "x"] and P.read_published(spark, path).count() == 5
    assert held.count() == 3  # a reader that looked up the version before can finish
    assert P.read_published(spark, path, 1).count() == 3
    assert P.publish(spark.range(7), path, keep=1) == 3
    with pytest.raises(FileNotFoundError):
        P.read_published(spark, path, 1)
    assert P.read_published(spark, path).count() == 7 and P.orphans(spark, path) == []


def test_a_version_that_was_not_swapped_in_is_not_read(spark):
    path = shared_dir(spark, "published-test")
    P.publish(spark.range(3), path, fmt="csv")
    version = P.write_version(spark.range(9), path, "csv")
    assert P.read_published(spark, path).count() == 3 and P.orphans(spark, path) == [version]
    P.expire(spark, path, 1)
    assert P.orphans(spark, path) == [version]  # it may belong to a running job
    assert P.swap(spark, path, version, spark.range(9).schema, "csv") == 2
    assert rows(P.read_published(spark, path)) == [(i,) for i in range(9)]


def test_two_publishers_never_share_a_number(spark):
    path = shared_dir(spark, "published-test")
    first, second = P.write_version(spark.range(1), path), P.write_version(spark.range(2), path)
    folder = P.Folder(spark, path)
    folder.create("_attempt-a.json", "{}")
    assert P.swap(spark, path, first, spark.range(1).schema) == 1
    assert not folder.claim("_attempt-a.json", "manifest-000000000001.json")
    assert P.swap(spark, path, second, spark.range(1).schema) == 2


def test_a_job_killed_between_write_and_swap_leaves_the_published_result(spark, tmp_path):
    """The process dies after all files are written; readers still see the version before."""
    path = str(tmp_path / "result")
    P.publish(spark.range(4), path)
    code = textwrap.dedent(f"""
        import os, sys
        sys.path.insert(0, {ROOT!r})
        from tracelens.session import build_session
        from tracelens.sources import published
        spark = build_session("local[1]", shuffle_partitions=1)
        published.swap = lambda *a: os._exit(9)
        published.publish(spark.range(1000), {path!r})
    """)
    done = subprocess.run([sys.executable, "-c", code], timeout=120, capture_output=True)
    assert done.returncode == 9
    assert len(os.listdir(tmp_path / "result" / "versions")) == 2 and len(P.orphans(spark, path)) == 1
    assert P.read_published(spark, path).count() == 4
    assert P.publish(spark.range(6), path) == 2 and P.read_published(spark, path).count() == 6


LINES = [
    ('1,2,3,p,0.5,0.25', []), ('1,2,3,"p, q",0.5,', []), ('1,2,3,,,', []), ('1,2,3,p,0.5', [L.SHORT]), ('1', [L.SHORT]),
    ('', [L.SHORT]), ('1,2,3,p,0.5,0.25,x,y', [L.LONG]), ('1,2,3,p,0.5,0.25,', [L.LONG]), ('x1,2,3,p,0.5,0.25', ["time: not a bigint"]),
    ('1,99999999999999999999,3.5,p,0.5,abc', ["machine_id: not a bigint", "event_type: not a int", "memory: not a double"]),
    ('1,2,x,p', [L.SHORT, "event_type: not a int"]), ('naïve,2,3,ß,,', ["time: not a bigint"]),
]


@pytest.fixture
def untidy(tmp_path):
    (tmp_path / "a.csv").write_text("\n".join(t for t, _ in LINES[:7]) + "\n")
    (tmp_path / "b.csv").write_text("\n".join(t for t, _ in LINES[7:]) + "\n1,2,3,\"open,0.5,0.25\n")
    return str(tmp_path)


def test_every_line_is_a_row_or_in_quarantine(spark, untidy):
    got = L.read_with_ledger(spark, "machine_events", untidy)
    bad = {r["line"]: (r["file"].rsplit("/")[-1], r["reasons"]) for r in got.quarantined.collect()}
    for i, (line, reasons) in enumerate(LINES):
        assert (bad[line][1] if reasons else bad.get(line, (None, []))[1]) == reasons, line
        assert not reasons or bad[line][0] == ("a.csv" if i < 7 else "b.csv")
    assert L.QUOTE in bad['1,2,3,"open,0.5,0.25'][1]
    assert got.rows.count() + got.quarantined.count() == len(LINES) + 1
    assert rows(got.rows) == rows(spark.createDataFrame(
        [(1, 2, 3, "p", "0.5", 0.25), (1, 2, 3, "p, q", "0.5", None), (1, 2, 3, None, None, None)], got.rows.schema))
    summary = {r["reason"]: r["n_lines"] for r in L.ledger_summary(got).collect()}
    assert summary["ok"] == 3 and summary[L.SHORT] >= 4 and summary["time: not a bigint"] == 2


def test_the_summary_reads_each_line_once(spark, untidy, tmp_path):
    got = L.read_with_ledger(spark, "machine_events", untidy)
    assert plan_text(L.ledger_summary(got)).count("FileScan text") == 1
    bad = [r["reasons"] for r in got.quarantined.collect()]
    counts = Counter(reason for reasons in bad for reason in reasons) | Counter(ok=got.rows.count())
    assert {r["reason"]: r["n_lines"] for r in L.ledger_summary(got).collect()} == counts
    assert got.judged.count() == len(LINES) + 1
    (tmp_path / "short.csv").write_text("1\n2\n")
    none = L.read_with_ledger(spark, "machine_events", str(tmp_path / "short.csv"))
    assert rows(L.ledger_summary(none)) == [("ok", 0), (L.SHORT, 2)]


def test_only_what_looks_like_a_number_is_cast(spark):
    marks = ["", "+", "-", ".", "e", "E5", "e-3", "d", "F", "L", "x", "0x", "0x1p3", "0X1.8P-1f", "nan", "NaN", "-Infinity", "+inf", "INF", "infinit",
             "_", ",", "\t", "\n", "\x00", "\x7f", "\x1f", "\x85", "\u00a0", "\u2028", "\u0661", "\uff11", " "]
    numbers = ["", "0", "-0", "7", "12", "1 2", "1-2", "2024-01-01", "1.5", ".5", "5.", "1.2.3", "1e400", "127", "128", "-129", "32768", "-32768",
               "2147483647", "2147483648", "-2147483648", "-2147483649", "9223372036854775807", "9223372036854775808", "-9223372036854775808",
               "-9223372036854775809", "999999999999999999", "0000000000000000000000042", "99999999999999999999"]
    texts = spark.createDataFrame([(a + n + b,) for n in numbers for a in marks for b in marks], "s string")
    kinds = ["tinyint", "smallint", "int", "bigint", "float", "double", "boolean", "date", "decimal(10,2)"]
    for k in kinds:
        both = texts.select("s", L._typed(F.col("s"), k).alias("a"), F.col("s").try_cast(k).alias("b"))
        assert both.where(~F.col("a").eqNullSafe(F.col("b"))).collect() == [], k
    assert "try_cast" in plan_text(texts.select(L._typed(F.col("s"), "int"))) and texts.where(L._typed(F.col("s"), "int").isNotNull()).count() > 50


def test_tolerated_faults_are_rows(spark, untidy):
    got = L.read_with_ledger(spark, "machine_events", untidy, tolerate=[L.SHORT, L.LONG, "time"])
    assert got.rows.count() + got.quarantined.count() == len(LINES) + 1
    assert got.rows.where("time is null and machine_id = 2").count() == 2
    assert got.rows.where("cpus = '0.5' and memory is null").count() == 2
    assert all(not {L.SHORT, L.LONG, "time: not a bigint"} & set(r["reasons"]) for r in got.quarantined.collect())
    empty = L.read_with_ledger(spark, "machine_events", untidy + "/a.csv", schema="a string")
    assert empty.rows.count() == 2 and empty.quarantined.count() == 5  # one field each, the blank line among them


def test_ingest_puts_malformed_lines_beside_the_rows(spark, untidy, tmp_path):
    from tracelens.sources.readers import ingest_trace_table, read_ingested_table

    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    ingest_trace_table(spark, "machine_events", untidy, out, quarantine=bad)
    assert read_ingested_table(spark, "machine_events", out).count() == 3
    lines = spark.read.parquet(bad)
    assert lines.columns == ["file", "line", "reasons"] and lines.count() == len(LINES) - 2
    ingest_trace_table(spark, "machine_events", untidy, out)
    assert read_ingested_table(spark, "machine_events", out).count() == len(LINES)  # the blank line gives no row


def test_states_of_part_files_merge_to_one_pass(spark, tmp_path):
    parts, states = tmp_path / "parts", str(tmp_path / "states")
    parts.mkdir()

    def put(name, lines):
        (parts / name).write_text("\n".join(lines) + "\n")

    def read(files):
        seen.append(sorted(f.rsplit("/")[-1] for f in files))
        return spark.read.schema("cls string, job long").csv(files)

    def one_pass():
        df = spark.read.schema("cls string, job long").csv(str(parts))
        return rows(df.groupBy("cls").agg(F.count("*").alias("r"), F.count_distinct("job").alias("d")))

    seen: list = []
    put("a.csv", ["x,1", "x,1", "y,2", ",3", "x,"])
    put("b.csv", ["x,1", "x,5", "z,1"])
    update = lambda: update_states(spark, str(parts), states, read, "cls", "job")
    assert [f.rsplit("/")[-1] for f in update()] == ["a.csv", "b.csv"]
    assert rows(merged_counts(spark, states)) == one_pass()
    assert update() == [] and seen == [["a.csv", "b.csv"]]  # nothing new: nothing read
    put("c.csv", ["x,9", "y,2", "y,7"] + [f"w,{i}" for i in range(3000)])
    assert [f.rsplit("/")[-1] for f in update()] == ["c.csv"] and seen[-1] == ["c.csv"]
    assert rows(merged_counts(spark, states)) == one_pass()
    approx = {r["key"]: (r["n_rows"], r["approx_distinct"]) for r in merged_sketches(spark, states).collect()}
    for key, n, distinct in one_pass():
        assert approx[key][0] == n and abs(approx[key][1] - distinct) <= 0.05 * distinct
    some = [f for f in merged_files(spark, states) if not f.endswith("c.csv")]
    assert dict((k, n) for k, n, _ in rows(merged_counts(spark, states, some))) == {"x": 5, "y": 1, "z": 1, None: 1}
    # A changed file replaces its own states; a run that dies before the register leaves no trace.
    put("b.csv", ["x,1", "q,1", "q,2"])
    with pytest.MonkeyPatch.context() as m:
        m.setattr(spark, "createDataFrame", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            update()
    assert [f.rsplit("/")[-1] for f in update()] == ["b.csv"]
    assert rows(merged_counts(spark, states)) == one_pass()


def merged_files(spark, states):
    return [r["file"] for r in spark.read.parquet(f"{states}/files").select("file").distinct().collect()]
