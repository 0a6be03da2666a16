"""Sorting and top-k.

``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``: every task
keeps its own k best rows and only those k x tasks rows meet in the final
merge, so a top-k never sorts the whole input.  A key column is always
added as the last sort column so the chosen *set* is fixed under ties.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelens.functions.keys import name_list


def _order(by: Sequence[str], ascending: bool, tie_break: Sequence[str]):
    main = [F.col(c).asc_nulls_last() if ascending else F.col(c).desc_nulls_last() for c in by]
    return main + [F.col(c).asc_nulls_last() for c in tie_break]


def sort_by(df: DataFrame, by: str | Sequence[str], *, ascending: bool = True,
            tie_break: str | Sequence[str] | None = None) -> DataFrame:
    """Total order by ``by`` then ``tie_break`` ascending."""
    return df.orderBy(*_order(name_list(by), ascending, name_list(tie_break)))


def top_k(df: DataFrame, by: str | Sequence[str], k: int, *,
          tie_break: str | Sequence[str] | None = None) -> DataFrame:
    """The ``k`` rows with the largest ``by`` (O2)."""
    return df.orderBy(*_order(name_list(by), False, name_list(tie_break))).limit(k)


def bottom_k(df: DataFrame, by: str | Sequence[str], k: int, *,
             tie_break: str | Sequence[str] | None = None) -> DataFrame:
    """The ``k`` rows with the smallest ``by`` (O3)."""
    return df.orderBy(*_order(name_list(by), True, name_list(tie_break))).limit(k)
