"""Driver contract and the oracle comparison on the smallest tables."""

from conftest import SF_SMALL

import __spark_entry__ as E
from gradeflow.plans import catalog, oracle_sql, whole_tables, whole_tables_sql
from oracle_check import compare


def all_queries():
    return catalog.all_queries() | whole_tables.all_queries()


def all_sql():
    return oracle_sql.all_sql() | whole_tables_sql.all_sql()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["eval_name", "model_name", "metric", "value"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(all_sql()) <= set(E.queries())


def test_queries_match_duckdb_oracle(spark):
    res = compare(spark, SF_SMALL, list(all_queries()), verbose=False)
    bad = {k: v for k, v in res.items() if not v.startswith("ok")}
    assert not bad, bad
