"""Every query of the catalogue runs; those with SQL give its rows."""

import pytest

from eventloom.plans import catalogue


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_sql(name, same_rows):
    same_rows(catalogue.QUERIES[name], catalogue.ORACLE_SQL[name])


def test_upsert_query(spark):
    rows = catalogue.QUERIES["q10b_upsert"](spark, "/root/testdata/sf0.001").collect()
    assert rows and {r["outcome"] for r in rows} <= {"new", "merged"}


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns == ["left_key", "right_key"]
