"""tracelens: Spark-native analytics for cluster activity traces.

Layout
------
sources/    table schemas, CSV / text-line / parquet readers, sampling, sinks
functions/  column expressions: missing-value handling, rounding, ratios
operators/  reusable DataFrame -> DataFrame operators (counts, stats,
            shares, top-k, histograms, joins, first-transition delays)
plans/      the eight analyses, their bindings to concrete tables and
            the query catalogue used by ``__spark_entry__``
llm/        operators on training text, on their own

Every operator builds a lazy plan; nothing inside the library calls an
action except the explicit sinks in ``sources.sinks``.
"""

from tracelens.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
