from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tracelens.session import ensure_checkpoint_dir, shared_dir
from tracelens.sources import readers, schemas, sinks
from tracelens.sources.schemas import TABLES, column_names, schema_of


def test_schema_registry():
    assert set(TABLES) == {"machine_events", "job_events", "task_events", "task_usage",
                           "task_constraints"}
    assert column_names("task_events")[:6] == ["time", "missing_info", "job_id", "task_index",
                                               "machine_id", "event_type"]
    assert len(column_names("task_usage")) == 20
    assert "disk_i/o_time" in column_names("task_usage")
    assert schema_of("task_events")["job_id"].dataType.simpleString() == "bigint"
    with pytest.raises(KeyError):
        schema_of("nope")


def test_csv_reader_messy_rows(trace):
    te = trace["task_events"]
    assert te.count() == 13  # both part files of the folder
    big = te.where(F.col("job_id") == 3000000000)
    assert big.count() == 3  # id above 2^31 survives as LONG
    assert rows(big.where(F.col("event_type") == 0), "machine_id", "cpu_request") == [(None, None)]
    quoted = te.where(F.col("job_id") == 4).select("user").distinct().collect()
    assert [r.user for r in quoted] == ["u,3"]  # quoted comma kept in one field
    short = te.where(F.col("job_id") == 5).collect()[0]
    assert short.task_index == 0 and short.event_type is None and short.priority is None
    extra = te.where((F.col("job_id") == 1) & (F.col("event_type") == 2)).collect()[0]
    assert extra.different_machines_restriction == "0"  # trailing extra fields dropped


def test_untyped_reader_keeps_text(spark, trace_dir):
    te = readers.read_trace_table(spark, "task_events", f"{trace_dir}/task_events", typed=False)
    assert all(f.dataType.simpleString() == "string" for f in te.schema.fields)


def test_line_reader_naive_split(spark, trace_dir):
    lines = readers.read_lines_table(spark, "task_events", f"{trace_dir}/task_events")
    assert lines.count() == 13
    # Empty fields are missing; a short row yields nulls.
    big = lines.where((F.col("job_id") == 3000000000) & (F.col("event_type") == 0)).collect()[0]
    assert big.machine_id is None and big.cpu_request is None
    short = lines.where(F.col("job_id") == 5).collect()[0]
    assert short.event_type is None
    # No quoting rules: the quoted comma splits the user field.
    q = lines.where(F.col("job_id") == 4).select("user").distinct().collect()
    assert [r.user for r in q] == ['"u']


def test_empty_table(spark, trace_dir):
    df = readers.read_trace_table(spark, "task_events", f"{trace_dir}/empty")
    assert df.count() == 0


def test_sample_rows(spark):
    df = spark.range(10000)
    assert readers.sample_rows(df, None) is df
    assert readers.sample_rows(df, 1.0) is df
    a = readers.sample_rows(df, 0.3, seed=7).count()
    b = readers.sample_rows(df, 0.3, seed=7).count()
    assert a == b and 2500 < a < 3500
    with pytest.raises(ValueError):
        readers.sample_rows(df, 0.0)


def test_hash_sample_keeps_whole_keys(spark):
    df = spark.range(2000).select((F.col("id") % 100).alias("k"), "id")
    kept = readers.hash_sample(df, "k", 0.5)
    per_key = kept.groupBy("k").count().collect()
    assert all(r["count"] == 20 for r in per_key)  # a key is kept whole or not at all
    assert 25 < len(per_key) < 75
    assert readers.hash_sample(df, "k", 1.0).count() == 2000
    assert readers.hash_bucket_prefix(0.5) == "80"


def test_sinks_render_and_lines(spark):
    df = spark.createDataFrame([("a", 1), ("bb", 22)], "k string, n long")
    text = sinks.render_table(df.orderBy("k"), 10).splitlines()
    assert text == ["+--+--+", "| k| n|", "+--+--+", "| a| 1|", "|bb|22|", "+--+--+"]
    lines = sinks.format_lines(df, "%s=%d", "k", "n")
    assert sorted(r.line for r in lines.collect()) == ["a=1", "bb=22"]
    assert sinks.head_rows(df, 1).count() == 1


def test_write_result_and_report(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a long, b string")
    path = shared_dir(spark, "test-out")
    sinks.write_result(df, path, fmt="csv")
    back = spark.read.schema(df.schema).csv(path)
    assert rows(back) == [(1, None), (2, "x")]
    reports = shared_dir(spark, "reports")
    for seconds in (1.5, 2.0):
        sinks.write_report(spark, reports, "counts", seconds, {"first": "x\ny", "second": "z"})
    back = spark.read.parquet(reports)
    assert rows(back, "job", "seconds", "result", "line_no", "line") == sorted(
        ("counts", s, r, i, t) for s in (1.5, 2.0) for r, i, t in (("first", 0, "x"), ("first", 1, "y"), ("second", 0, "z")))


def test_checkpoint_cuts_lineage(spark):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    cp = sinks.checkpoint_table(df)
    assert cp.count() == 100
    assert sorted(r.x for r in cp.collect())[-1] == 198


def test_cache_table_keeps_results(spark):
    df = spark.range(50).withColumn("y", F.col("id") % 5)
    cached = readers.cache_table(df)
    assert cached.is_cached
    assert cached.groupBy("y").count().count() == 5
    cached.unpersist()


def test_slash_column_is_usable(trace):
    tu = trace["task_usage"]
    got = tu.select(F.col("disk_i/o_time")).where(F.col("disk_i/o_time") == 0).count()
    assert got == tu.count()
    tu.createOrReplaceTempView("tu_slash")
    sql = tu.sparkSession.sql("SELECT count(`disk_i/o_time`) AS n FROM tu_slash").collect()[0].n
    assert sql == tu.count()


def test_hash_sample_width(spark):
    assert readers.hash_bucket_prefix(0.001, 4) == "0042"
    with pytest.raises(ValueError):
        readers.hash_bucket_prefix(0.001)
    df = spark.range(20000).select((F.col("id") % 5000).alias("k"))
    kept = readers.hash_sample(df, "k", 0.01, width=3).select("k").distinct().count()
    assert 20 < kept < 90  # about 1 % of 5000 keys


def test_hash_sample_widens_for_small_fractions(spark):
    assert readers.hash_width(0.5) == 2 and readers.hash_width(0.001) > 2
    kept = readers.hash_sample(spark.range(200_000).select(F.col("id").alias("k")), "k", 0.001).count()
    assert 120 < kept < 280


def test_checkpoint_folder_is_only_made_for_one_process(spark, monkeypatch):
    class Context:
        master = "local-cluster[2,1,1024]"

        def getCheckpointDir(self):
            return None

    monkeypatch.setattr("tracelens.session._context", lambda s: Context())
    monkeypatch.setattr("tracelens.session._configured_checkpoint_dir", lambda s: None)
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(spark)


def test_ingest_files_follow_data_not_splits(spark, tmp_path):
    """Many small inputs give few files per event code, and every row."""
    src = spark.range(4000).select(*[
        {"job_id": F.col("id"), "event_type": F.col("id") % 9}.get(c, F.lit(1)).cast("string").alias(c)
        for c in schemas.column_names("task_events")])
    src.repartition(24).write.csv(str(tmp_path / "csv"))
    out = readers.ingest_trace_table(spark, "task_events", str(tmp_path / "csv"), str(tmp_path / "pq"))
    files = [f for _, _, names in os.walk(out) for f in names if f.endswith(".parquet")]
    assert len(files) <= 2 * 9
    assert readers.read_ingested_table(spark, "task_events", out).count() == 4000
