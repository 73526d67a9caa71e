"""Every query with an oracle equals DuckDB on the same tables (sf0.001, exact values)."""

import pytest

import __spark_entry__ as entry
from tools.oracle_check import compare, type_mismatches

ORACLE_NAMES = sorted(entry.oracle_sql())
ROWS_ONLY = sorted(set(entry.queries()) - set(ORACLE_NAMES))


@pytest.mark.parametrize("name", ORACLE_NAMES)
def test_matches_oracle(spark, duck, registry, name):
    qs, sqls = registry
    df = qs[name](spark, "/root/testdata/sf0.001")
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(sqls[name])
    drows = cur.fetchall()
    dcols = [c[0] for c in cur.description]
    assert compare(rows, df.columns, drows, dcols) is None
    assert type_mismatches(df.schema, dcols, duck.sql(sqls[name]).types) == []


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_queries_run(spark, registry, name):
    qs, _ = registry
    df = qs[name](spark, "/root/testdata/sf0.001")
    assert df.count() > 0
    assert df.schema == qs[name](spark, "/root/testdata/sf0.001").schema


def test_every_query_has_unique_lowercase_name(registry):
    qs, sqls = registry
    assert set(sqls) <= set(qs)
    assert all(n == n.lower() for n in qs)


def test_entry_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["date", "stocks_sgd", "crypto_sgd"]
