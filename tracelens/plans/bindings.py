"""Bindings: tables of another schema mapped onto the analyses' roles.

The analyses speak in trace roles (job, task, machine, event, priority,
time, request, usage).  A binding is a projection that renames and
derives those role columns from a concrete table; it never filters rows
or drops data, so it composes with the analysis into one plan and
Catalyst still prunes columns and pushes filters down to the scan.

The functions below bind the driver's star-schema tables (orders,
lineitem, events, customer, supplier) to the roles used by the query
catalogue.  "Read as missing" marks values that play the trace's
missing fields, so the missing-value semantics are exercised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelens.functions.missing import as_missing, missing_if_equal
from tracelens.sources.readers import read_parquet_table

# Fixed values of the bindings (role -> value in the driver tables).
RETURNFLAG_MISSING = "N"           # l_returnflag read as missing
SUPPKEY_MISSING = 0                # l_suppkey read as missing
ORDER_EVENT = "F"                  # o_orderstatus marking the event (J4, J7)
REQUEST_MISSING_STATUS = "P"       # o_orderstatus whose request is missing (J6)
USAGE_MISSING_EVENT = "error"      # events.event_type whose usage is missing (J6)
MEM_MISSING_SEGMENT = "MACHINERY"  # c_mktsegment whose request is missing (J6 memory)
SUBMIT_EVENTS = ("signup",)                     # J8 start events
LEAVE_EVENTS = ("click", "purchase", "error")   # J8 end events
TASKS_PER_USER = 4                 # J8 task = event_id % 4
MAX_CONSTRAINTS = 4                # J8 keep jobs with mean constraints below
PEAK_BELOW = 10                    # J7 keep peaks below
USAGE_EVENTS = ("view", "purchase")  # J7 in time: events read as usage windows
USAGE_WINDOW = 6 * 3_600 * 1_000_000  # J7 in time: length of a usage window, microseconds
MICROS = 1_000_000                 # J8 delays in seconds


# Schemas of the driver tables that the bindings read.  A
# supplied schema spares Spark the footer-reading job it otherwise runs to
# infer one, on every read.
DRIVER_SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet_table(spark, sf_dir, name, schema=DRIVER_SCHEMAS.get(name))


def micros(col: str) -> Column:
    """Microseconds since 1970 of a TIMESTAMP_NTZ column, independent of the
    session time zone: the day number and the time of day, neither of which
    passes through an instant of some zone."""
    c = F.col(col)
    seconds = F.unix_date(c.cast("date")).cast("long") * 86_400 + F.hour(c) * 3_600 + F.minute(c) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")


def returnflags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``l_returnflag`` with ``'N'`` read as missing."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(missing_if_equal("l_returnflag", RETURNFLAG_MISSING).alias("l_returnflag"),
                     "l_orderkey")


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem as is (job = l_orderkey or l_partkey)."""
    return table(spark, sf_dir, "lineitem")


def part_suppliers(spark: SparkSession, sf_dir: str, *, missing: bool = True) -> DataFrame:
    """job = l_partkey, machine = l_suppkey (0 read as missing)."""
    li = table(spark, sf_dir, "lineitem")
    supp = missing_if_equal("l_suppkey", SUPPKEY_MISSING) if missing else F.col("l_suppkey")
    return li.select("l_partkey", supp.alias("l_suppkey"))


def order_priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """priority = first digit of o_orderpriority, event = o_orderstatus."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("priority"),
        F.col("o_orderstatus").alias("event_type"),
    )


def cpu_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6 request side: o_totalprice / 1000 per o_custkey ('P' orders missing)."""
    o = table(spark, sf_dir, "orders")
    req = as_missing(F.col("o_totalprice") / F.lit(1000),
                     F.col("o_orderstatus") == F.lit(REQUEST_MISSING_STATUS))
    return o.select(F.col("o_custkey").alias("job_id"), req.alias("cpu_request"))


def cpu_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6 usage side: events.value per user_id ('error' events missing)."""
    e = table(spark, sf_dir, "events")
    used = as_missing(F.col("value"), F.col("event_type") == F.lit(USAGE_MISSING_EVENT))
    return e.select(F.col("user_id").alias("job_id"), used.alias("cpu_rate"))


def mem_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6 memory request side: c_acctbal / 100 per c_nationkey (MACHINERY missing)."""
    c = table(spark, sf_dir, "customer")
    req = as_missing(F.col("c_acctbal") / F.lit(100),
                     F.col("c_mktsegment") == F.lit(MEM_MISSING_SEGMENT))
    return c.select(F.col("c_nationkey").alias("job_id"), req.alias("memory_request"))


def mem_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6 memory usage side: s_acctbal / 100 per s_nationkey."""
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_nationkey").alias("job_id"),
                    (F.col("s_acctbal") / F.lit(100)).alias("canonical_memory_usage"))


def peak_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J7 usage side: peak rate = l_discount per l_orderkey."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("job_id"),
                     F.col("l_discount").alias("maximum_cpu_rate"))


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J7 event side: o_orderkey with o_orderstatus as the event."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("job_id"), F.col("o_orderstatus").alias("event_type"))


def task_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J8 events: job = user_id, task = event_id % 4, time = ts in microseconds."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("job_id"),
        (F.col("event_id") % F.lit(TASKS_PER_USER)).alias("task_index"),
        "event_type",
        micros("ts").alias("time"),
    )


def task_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J8 constraints: one row per order of (o_custkey, o_orderpriority)."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias("job_id"),
                    F.col("o_orderpriority").alias("task_index"))


def usage_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J7 in time, usage side: a window of fixed length from each viewing or purchase, peak = value, job = user_id."""
    e = table(spark, sf_dir, "events").where(F.col("event_type").isin(list(USAGE_EVENTS)))
    return e.select(F.col("user_id").alias("job_id"), micros("ts").alias("start_time"),
                    (micros("ts") + F.lit(USAGE_WINDOW)).alias("end_time"), F.col("value").alias("maximum_cpu_rate"))


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J7 in time, event side: job = user_id, time = ts in microseconds."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("job_id"), "event_type", micros("ts").alias("time"))
