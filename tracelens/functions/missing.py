"""Missing values.

Data keep real nulls end to end.  ``'NA'`` is only a *label*: applied to a
grouping key (so missing values form one group) or for display.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the label that stands for a missing value in results.
NA = "NA"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def label_missing(col: Column | str, label: str = NA) -> Column:
    """Null (or empty text) -> ``label``; other values as text."""
    text = _col(col).cast("string")
    return F.when(text.isNull() | (text == ""), F.lit(label)).otherwise(text)


def as_missing(col: Column | str, condition: Column) -> Column:
    """Treat values matching ``condition`` as missing (null)."""
    return F.when(condition, F.lit(None)).otherwise(_col(col))


def missing_if_equal(col: Column | str, value) -> Column:
    """Null where the column equals ``value``; keeps the column's type."""
    c = _col(col)
    return F.when(c == F.lit(value), F.lit(None)).otherwise(c)


def is_present(col: Column | str) -> Column:
    """Not missing: the typed replacement of ``col != 'NA'``."""
    return _col(col).isNotNull()
