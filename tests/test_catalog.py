"""Every catalogue query against its SQL twin (DuckDB) on the smallest tables."""

from __future__ import annotations

import __spark_entry__ as entry
from oracle_compare import compare

SF = "/root/testdata/sf0.001"


def test_every_query_has_sql_or_is_rows_only():
    from tracelens.plans import catalog

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.QUERIES) <= set(entry.queries())
    assert set(catalog.QUERIES) == set(catalog.ORACLE_SQL)


def test_catalogue_matches_sql(spark):
    from tracelens.plans import catalog

    res = compare(spark, SF, list(catalog.QUERIES))
    bad = {k: v for k, v in res.items() if not (v.startswith("ok") or v.startswith("rows-only"))}
    assert not bad, bad


def test_seeded_sample_is_repeatable(spark):
    fn = entry.queries()["seeded_sample"]
    assert fn(spark, SF).count() == fn(spark, SF).count()


def test_every_query_documents_its_operators():
    from tracelens.plans import catalog

    assert set(catalog.OPERATORS) == set(catalog.QUERIES)
