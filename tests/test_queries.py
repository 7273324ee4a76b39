"""Every registered query of the engine against DuckDB, on the smallest tables."""

import pytest

from lexiforge.plans import queries as Q
from tests.compare import check, connect


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query(spark, sf_dir, name):
    df = Q.QUERIES[name](spark, sf_dir)
    if name in Q.SQL:
        check(df, connect(sf_dir), Q.SQL[name])
    else:
        assert df.columns and df.collect() is not None


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    df = Q.read(spark, sf_dir, "documents").filter("lang = 'de' and n_chars > 100").select("doc_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(lang), IsNotNull(n_chars), EqualTo(lang,de), GreaterThan(n_chars,100)]" in plan
    assert "text" not in plan.split("ReadSchema")[1]
