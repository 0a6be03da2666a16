"""Result sinks.

Results are DataFrames; the caller decides how much of one reaches the
driver.  Whole results are written by executors (``write_result``); only
bounded previews (``head_rows``, ``render_table``, report bodies of at
most ``max_rows`` rows) are pulled to the driver.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def head_rows(df: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` rows (S6, O4): a ``limit`` the caller may collect."""
    return df.limit(n)


def format_lines(df: DataFrame, template: str, *cols: str, name: str = "line") -> DataFrame:
    """One formatted text line per row (S10), evaluated on the executors."""
    return df.select(F.format_string(template, *[F.col(c) for c in cols]).alias(name))


def render_table(df: DataFrame, n: int = 20, truncate: int = 20) -> str:
    """Fixed-width text of the first ``n`` rows (S8); at most ``n`` rows are fetched."""
    rows = df.limit(n).collect()
    names = df.columns

    def cell(v) -> str:
        text = "null" if v is None else str(v)
        if truncate and len(text) > truncate:
            text = text[: max(truncate - 3, 0)] + "..."
        return text

    body = [[cell(v) for v in r] for r in rows]
    widths = [max([len(h)] + [len(b[i]) for b in body]) for i, h in enumerate(names)]
    sep = "+" + "+".join("-" * w for w in widths) + "+"
    fmt = lambda vals: "|" + "|".join(v.rjust(w) for v, w in zip(vals, widths)) + "|"
    lines = [sep, fmt(names), sep] + [fmt(b) for b in body] + [sep]
    return "\n".join(lines)


def text_lines(df: DataFrame, n: int, order_by: str | list[str], truncate: int = 20) -> DataFrame:
    """(line_no, line): the first ``n`` rows by ``order_by`` as a fixed-width text table, as data.

    Widths are one aggregate of those rows, the lines are formatted by the executors, and
    nothing reaches the driver.  ``n`` is a preview's size: its rows are numbered in one task.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    head = df.orderBy(*order).limit(n)

    def cell(c: str) -> Column:
        text = F.coalesce(F.col(c).cast("string"), F.lit("null"))
        if not truncate:
            return text
        return F.when(F.length(text) > truncate, F.concat(F.substring(text, 1, max(truncate - 3, 0)), F.lit("..."))) \
            .otherwise(text)

    cells = head.select(F.row_number().over(Window.orderBy(*order)).alias("_n"),
                        *[cell(c).alias(f"c{i}") for i, c in enumerate(df.columns)])
    widths = cells.agg(F.struct(F.count(F.lit(1)).alias("n"), *[
        F.greatest(F.lit(len(c)), F.coalesce(F.max(F.length(f"c{i}")), F.lit(0))).cast("int").alias(f"w{i}")
        for i, c in enumerate(df.columns)])).scalar()
    frame = df.sparkSession.range(1).withColumn("_w", widths)
    bar = F.concat(F.lit("+"), *[F.concat(F.repeat(F.lit("-"), F.col(f"_w.w{i}")), F.lit("+")) for i in range(len(df.columns))])

    def row(values: list[Column]) -> Column:
        return F.concat(F.lit("|"), *[F.concat(F.lpad(v, F.col(f"_w.w{i}"), F.lit(" ")), F.lit("|"))
                                      for i, v in enumerate(values)])

    fixed = frame.select(F.explode(F.array(
        F.struct(F.lit(0).alias("line_no"), bar.alias("line")),
        F.struct(F.lit(1).alias("line_no"), row([F.lit(c) for c in df.columns]).alias("line")),
        F.struct(F.lit(2).alias("line_no"), bar.alias("line")),
        F.struct((F.col("_w.n") + 3).cast("int").alias("line_no"), bar.alias("line")))).alias("l")).select("l.line_no", "l.line")
    body = cells.withColumn("_w", widths).select(
        (F.col("_n") + 2).alias("line_no"), row([F.col(f"c{i}") for i in range(len(df.columns))]).alias("line"))
    return fixed.unionByName(body)


def write_result(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                 partition_by: list[str] | None = None) -> str:
    """Write a whole result from the executors (S9); returns the path."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", "false")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def write_lines(df: DataFrame, path: str, column: str = "line") -> str:
    """Write one text column as plain text files."""
    df.select(F.col(column).alias("value")).write.mode("overwrite").text(path)
    return path


def write_report(spark: SparkSession, path: str, job: str, seconds: float,
                 previews: dict[str, str], fmt: str = "parquet") -> str:
    """Append one run of a job to the report table at ``path`` (S9); returns the path.

    One row per preview line: job, finished (time stamp), seconds of the run, result,
    line number and line.  The previews are bounded (``render_table``).
    """
    finished = datetime.now()
    rows = [(job, finished, float(seconds), result, i, line)
            for result, text in previews.items() for i, line in enumerate(text.splitlines())]
    table = spark.createDataFrame(
        rows, "job string, finished timestamp_ntz, seconds double, result string, line_no int, line string")
    return write_result(table.coalesce(1), path, fmt, mode="append")


def checkpoint_table(df: DataFrame, spark: SparkSession | None = None,
                     eager: bool = True) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder.

    The folder is the cluster's ``spark.checkpoint.dir`` (see
    ``session.ensure_checkpoint_dir``); a lost executor then costs a
    re-read of the checkpoint, not a recomputation of the whole plan.
    """
    from tracelens.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark or df.sparkSession)
    return df.checkpoint(eager=eager)
