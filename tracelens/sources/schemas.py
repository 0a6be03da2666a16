"""Schema registry of the cluster-trace tables (header-less CSV).

The trace files carry no header, so column position is the only link
between a field and its name.  Types are chosen from how each column is
used: identifiers that exceed 32 bits are LONG, times are LONG
(microseconds), rates and requests are DOUBLE, event codes and classes
INT.  Columns no analysis reads stay STRING.  Every column is nullable:
an empty field is a missing value, never the string ``'NA'``.
"""

from __future__ import annotations

from pyspark.sql import types as T

L, I, D, S = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()

# Column names and their order in each trace table.  These
# must match the trace files exactly (position -> name).
MACHINE_EVENTS = [
    ("time", L), ("machine_id", L), ("event_type", I), ("platform_id", S),
    ("cpus", S), ("memory", D),
]
JOB_EVENTS = [
    ("time", L), ("missing_info", S), ("job_id", L), ("event_type", I),
    ("user", S), ("scheduling_class", I), ("job_name", S),
    ("logical_job_name", S),
]
TASK_EVENTS = [
    ("time", L), ("missing_info", S), ("job_id", L), ("task_index", L),
    ("machine_id", L), ("event_type", I), ("user", S),
    ("scheduling_class", I), ("priority", I), ("cpu_request", D),
    ("memory_request", D), ("disk_space_request", D),
    ("different_machines_restriction", S),
]
TASK_USAGE = [
    ("start_time", L), ("end_time", L), ("job_id", L), ("task_index", L),
    ("machine_id", L), ("cpu_rate", D), ("canonical_memory_usage", D),
    ("assigned_memory_usage", D), ("unmapped_page_cache", D),
    ("total_page_cache", D), ("maximum_memory_usage", D),
    ("disk_i/o_time", D), ("local_disk_space_usage", D),
    ("maximum_cpu_rate", D), ("maximum_disk_io_time", D),
    ("cycles_per_instruction", D), ("memory_accesses_per_instruction", D),
    ("sample_portion", D), ("aggregation_type", S), ("sampled_cpu_usage", D),
]
TASK_CONSTRAINTS = [
    ("time", L), ("job_id", L), ("task_index", L), ("comparison_operator", S),
    ("attribute_name", S), ("attribute_value", S),
]

# Event codes of the trace (task_events.event_type).
SUBMIT = 0
EVICT = 2
LEAVE_PENDING = (1, 3, 5, 6)


def _struct(fields: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


TABLES: dict[str, T.StructType] = {
    "machine_events": _struct(MACHINE_EVENTS),
    "job_events": _struct(JOB_EVENTS),
    "task_events": _struct(TASK_EVENTS),
    "task_usage": _struct(TASK_USAGE),
    "task_constraints": _struct(TASK_CONSTRAINTS),
}


def schema_of(table: str) -> T.StructType:
    """Typed schema of a trace table; unknown names raise ``KeyError``."""
    try:
        return TABLES[table]
    except KeyError:
        raise KeyError(f"unknown trace table {table!r}; known: {sorted(TABLES)}") from None


def column_names(table: str) -> list[str]:
    return [f.name for f in schema_of(table).fields]


def string_schema(table: str) -> T.StructType:
    """All-string variant of a table schema (raw text fields)."""
    return T.StructType([T.StructField(f.name, S, True) for f in schema_of(table).fields])
