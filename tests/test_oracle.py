"""Every registered query against its DuckDB SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from salesmart.plans.registry import all_queries

import importlib.util
import os
_spec = importlib.util.spec_from_file_location(
    "check_oracle", os.path.join(os.path.dirname(os.path.dirname(__file__)), "scripts", "check_oracle.py"))
check = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(check)


@pytest.fixture(scope="module")
def duck():
    return check.duck_connection(SF_SMALL)


def test_every_query_has_sql():
    assert set(all_queries()) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["store_rank_in_provice", "province", "store_num", "total_sales",
                          "avg_store_total_sales_in_province"]


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_sql(spark, duck, name):
    res = check.compare(spark, duck, name, entry.queries()[name], entry.oracle_sql().get(name),
                        SF_SMALL)
    assert res["spark_rows"] == res["duck_rows"], res
    assert res["cols_match"] and res["types_match"], res
    assert res["values_match"], res
