from tracelens.sources.readers import (
    cache_table,
    hash_sample,
    hash_sample_condition,
    read_lines_table,
    read_parquet_table,
    read_trace_table,
    sample_rows,
)
from tracelens.sources.schemas import TABLES, column_names, schema_of
from tracelens.sources.sinks import (
    checkpoint_table,
    format_lines,
    head_rows,
    render_table,
    write_lines,
    write_report,
    write_result,
)

__all__ = [
    "TABLES", "cache_table", "checkpoint_table", "column_names", "format_lines",
    "hash_sample", "hash_sample_condition", "head_rows", "read_lines_table",
    "read_parquet_table", "read_trace_table", "render_table", "sample_rows",
    "schema_of", "write_lines", "write_report", "write_result",
]
