"""Trace files read with a ledger: typed rows, and every malformed line with its file and reasons.

Each line is one record and goes to exactly one side, so rows + quarantined lines = lines.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tracelens.sources.schemas import schema_of

SHORT, LONG, QUOTE = "too few fields", "too many fields", "quote is not closed"
_END = "\x02"  # a last field put after each line: where it comes to lie tells the number of fields
_BITS = {"tinyint": 7, "smallint": 15, "int": 31, "bigint": 63}
_NUMBER = r"^[\x00-\x20\x7f]*[+-]?(?:%s)[\x00-\x20\x7f]*$"
_WHOLE, _LONG_WHOLE = _NUMBER % "[0-9]{1,18}", _NUMBER % "[0-9]{19,}"
_REAL = _NUMBER % r"(?i:nan|inf(?:inity)?|0x[0-9a-f.]+p[+-]?[0-9]+[fd]?|(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?[fd]?)"


class Ledger(NamedTuple):
    """``rows``: typed rows; ``quarantined``: (file, line, reasons) of the lines that are not among them;
    ``judged``: the same of every line, without reasons if it is among the rows."""

    rows: DataFrame
    quarantined: DataFrame
    judged: DataFrame


def _once(lines: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """(file, line, r): the columns as a struct.

    The generator keeps the optimiser from copying them into every use.  It is given no more than their
    names, as what a projection's columns share is evaluated once, and what a generator's or a filter's do is not.
    """
    named = lines.select("file", "line", *[c.alias(name) for name, c in columns.items()])
    return named.select("file", "line", F.explode(F.array(F.struct(*columns))).alias("r"))


def _typed(text: Column, kind: str) -> Column:
    """``text.try_cast(kind)``, which is only asked for texts that look like a number of that kind.

    A cast that fails raises and catches an exception inside the task, at many times the cost of one that
    does not.
    """
    if kind in ("float", "double"):
        return F.when(text.rlike(_REAL), text.try_cast(kind))
    if kind not in _BITS:
        return text.try_cast(kind)
    whole = text.try_cast("bigint")
    if kind != "bigint":
        whole = F.when(whole.between(-(1 << _BITS[kind]), (1 << _BITS[kind]) - 1), whole).try_cast(kind)
    return F.when(text.rlike(_WHOLE), whole).when(text.rlike(_LONG_WHOLE), text.try_cast(kind))


def read_with_ledger(spark: SparkSession, table: str, path: str | list[str], *, schema: StructType | str | None = None,
                     tolerate: Sequence[str] = ()) -> Ledger:
    """Read a header-less CSV table and keep account of every line that does not fit it.

    A line is malformed if it has fewer or more fields than the schema, a quote that is not
    closed, or a field that is not empty and does not parse as its column's type; ``reasons``
    names all that apply (``<column>: not a <type>`` for the latter).  Faults listed in
    ``tolerate`` (``SHORT``, ``LONG``, ``QUOTE`` or a column's name) are let pass: missing fields are
    null, extra ones dropped, values that do not parse null.  Fields may be quoted and then
    hold commas; an empty field is null and never a fault.  A blank line is a record of one
    empty field.  The fields of a line whose quote is not closed are not counted.  All sides are lazy scans of the files; write ``quarantined`` beside the rows.
    """
    schema = schema_of(table) if schema is None else StructType.fromDDL(schema) if isinstance(schema, str) else schema
    n = len(schema.fields)
    text = StructType([StructField(f"f{i}", StringType()) for i in range(n + 1)])
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    # Parsed as one field more than there should be.
    parts = F.from_csv(F.concat("line", F.lit("," + _END)), F.lit(text.toDDL()), {"mode": "PERMISSIVE", "sep": ","})
    quotes = (F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))) % 2 == 1
    parsed = _once(lines, {"p": parts, "odd": quotes})
    odd = F.col("r.odd")  # the end then lies inside the open quote
    at = F.coalesce(*[F.when(F.col(f"r.p.f{i}") == _END, F.lit(i)) for i in range(n, -1, -1)])
    fields = F.when(~odd, F.coalesce(at, F.lit(n + 1)))
    faults, columns = [], []
    for fault, holds in ((SHORT, fields < n), (LONG, fields > n), (QUOTE, odd)):
        if fault not in tolerate:
            faults.append(F.when(holds, F.lit(fault)))
    for i, f in enumerate(schema.fields):
        raw = F.col(f"r.p.f{i}")
        value = F.when((raw != "") & (raw != _END), raw)
        kind = f.dataType.simpleString()
        if kind != "string":
            typed = _typed(F.trim(value), kind)
            if f.name not in tolerate:
                faults.append(F.when(value.isNotNull() & typed.isNull(), F.lit(f"{f.name}: not a {kind}")))
            value = typed
        columns.append(value)
    # Each reason is another text.  Not filter(): what a lambda is applied to is not compiled.
    reasons = F.array_except(F.array(*faults).cast("array<string>"), F.array(F.lit(None).cast("string")))
    judged = _once(parsed, {"reasons": reasons} | {f"v{i}": c for i, c in enumerate(columns)})
    account = judged.select("file", "line", "r.reasons")
    return Ledger(judged.where(F.size("r.reasons") == 0).select(*[F.col(f"r.v{i}").alias(f.name) for i, f in enumerate(schema.fields)]),
                  account.where(F.size("reasons") > 0), account)


def ledger_summary(ledger: Ledger) -> DataFrame:
    """(reason, n_lines), a line counted under each of its reasons, and the typed rows under ``ok``; one pass over the lines."""
    reasons = F.when(F.size("reasons") == 0, F.array(F.lit("ok"))).otherwise(F.col("reasons"))
    counts = ledger.judged.select(F.explode(reasons).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n_lines"))
    none = counts.sparkSession.range(1).select(F.lit("ok").alias("reason"), F.lit(0).cast("long").alias("n_lines"))
    return counts.unionByName(none).groupBy("reason").agg(F.sum("n_lines").alias("n_lines"))
