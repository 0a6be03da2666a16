"""Composite keys (F8).

Analyses group and join on several key columns directly.  These helpers
exist for inputs that carry a composite key as one text field
(``"job/task"``) and for producing such a field for export.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_SEP = "/"


def concat_key(*cols: str, sep: str = KEY_SEP) -> Column:
    return F.concat_ws(sep, *[F.col(c).cast("string") for c in cols])


def split_key(col: str, index: int, sep: str = KEY_SEP) -> Column:
    """Part ``index`` (0-based) of a composite key; null when absent."""
    pattern = "".join("\\" + ch if not ch.isalnum() and ch != " " else ch for ch in sep)
    return F.get(F.split(F.col(col), pattern, -1), index)


def name_list(cols: str | Sequence[str] | None) -> list[str]:
    """One column name, several or none as a list."""
    return [] if cols is None else [cols] if isinstance(cols, str) else list(cols)
