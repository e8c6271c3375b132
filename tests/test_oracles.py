"""Every core query that has a SQL twin, over whole tables."""

import oracle
import pytest

from weftline.plans import catalogue

SQL = catalogue.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return oracle.connect(small)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, con, small, name):
    assert oracle.compare(catalogue.queries()[name](spark, small), con, SQL[name]) == ""


def rows_of(df) -> list[str]:
    cols = sorted(df.columns)
    return sorted(repr(tuple(oracle.plain(r[c]) for c in cols)) for r in df.collect())


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(SQL)))
def test_query_without_twin_has_the_same_rows_however_it_is_partitioned(spark, small, name):
    """Their results are tested against brute force elsewhere (test_notices, test_operators, test_recovery, test_timestamps)."""
    got = rows_of(catalogue.queries()[name](spark, small))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        again = rows_of(catalogue.queries()[name](spark, small))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got and got == again


def test_entry_has_rows(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
