"""Queries that SQL can express, against their DuckDB SQL."""

import duckdb
import pytest

import __spark_entry__ as entry
from llm_cases import SF
from salesmart.llm.queries import ORACLE_SQL, QUERIES

TABLES = ("documents", "embeddings", "benchmark", "conversations")


def test_operators_and_the_pipeline_are_registered():
    numbers = sorted(int(k[2:].split("_")[0]) for k in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    result = duck.execute(ORACLE_SQL[name])
    columns = [c[0] for c in result.description]
    want = sorted(map(repr, result.fetchall()))
    got = sorted(repr(tuple(r)) for r in QUERIES[name](spark, SF).select(*columns).collect())
    assert got == want
