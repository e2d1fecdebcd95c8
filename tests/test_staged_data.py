"""Data checks on the staged tables, one group per table (locations,
products, transaction facts), asserted rather than printed."""

import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, plan_text
from salesmart.contracts import LOCATION, PRODUCT, TRANSACTIONS
from salesmart.operators import quality as dq
from salesmart.operators import staging as stg
from salesmart.plans import fixtures, jobs
from salesmart.sources import landing as ld
from salesmart.sources.tables import read_table


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("staged"))
    landing = f"{root}/landing"
    fixtures.write_landing(spark, SF_SMALL, landing)
    fixtures.write_location_landing(spark, SF_SMALL, landing)
    fixtures.write_product_landing(spark, SF_SMALL, landing)
    for action in ("stage-locations", "stage-products", "stage-transactions"):
        jobs.run(spark, root, action)
    z = jobs.Zones(root)
    return {"root": root,
            "location": read_table(spark, z.location, LOCATION),
            "product": read_table(spark, z.product, PRODUCT),
            "transactions": read_table(spark, z.transactions, TRANSACTIONS)}


def source_rows(table):
    return pq.ParquetFile(f"{SF_SMALL}/{table}.parquet").metadata.num_rows


def nulls(df):
    return {r["column_name"]: r["null_count"] for r in dq.null_profile(df).collect()}


# ------------------------------------------------------------- locations

def test_locations_schema_and_count(staged):
    assert staged["location"].schema == LOCATION.schema
    assert staged["location"].count() == source_rows("supplier")


def test_locations_no_null_columns(staged):
    assert set(nulls(staged["location"]).values()) == {0}


def test_locations_keys_unique(staged):
    for key in ("store_num", "store_location_key"):
        assert dq.duplicate_keys(staged["location"], key).count() == 0, key


def test_locations_per_province_add_up(staged):
    counts = dq.group_counts(staged["location"], "province").collect()
    assert sum(r["row_count"] for r in counts) == source_rows("supplier")
    assert all(r["value_count"] == r["row_count"] for r in counts)


# -------------------------------------------------------------- products

def test_products_schema_and_count(staged):
    assert staged["product"].schema == PRODUCT.schema
    assert staged["product"].count() == source_rows("part")


def test_products_keys_unique_and_canonical(staged):
    for key in ("product_key", "upc"):
        assert dq.duplicate_keys(staged["product"], key).count() == 0, key
    assert staged["product"].where(F.col("product_key").rlike("^0[0-9]")).count() == 0


def test_product_lookup_is_pushed_down(staged):
    df = dq.key_lookup(staged["product"], "product_key", "7")
    assert df.count() == 1
    assert "EqualTo(product_key,7)" in plan_text(df)


# ------------------------------------------------------------ transactions

def test_transactions_schema_and_count(staged):
    assert staged["transactions"].schema == TRANSACTIONS.schema
    assert staged["transactions"].count() == 6000


def test_transactions_required_columns_not_null(staged):
    got = nulls(staged["transactions"])
    for c in ("trans_dt", "trans_key", "sales", "units", "trans_year", "trans_month",
              "product_key", "store_location_key"):
        assert got[c] == 0, c
    assert got["collector_key"] > 0  # customers without a card


def test_transactions_date_range(spark, staged):
    r = dq.date_range(staged["transactions"]).first()
    line = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").agg(
        F.min("l_shipdate").cast("date").alias("lo"), F.max("l_shipdate").cast("date").alias("hi")).first()
    assert (r["min_date"], r["max_date"], r["rows_without_date"]) == (line["lo"], line["hi"], 0)
    assert isinstance(r["min_date"], dt.date)


def test_transactions_daily_counts_add_up(staged):
    daily = dq.daily_counts(staged["transactions"]).orderBy("trans_dt").collect()
    assert sum(r["row_count"] for r in daily) == 6000
    assert [r["trans_dt"] for r in daily] == sorted(r["trans_dt"] for r in daily)


def test_transactions_year_month_match_date(staged):
    bad = staged["transactions"].where((F.year("trans_dt") != F.col("trans_year"))
                                       | (F.month("trans_dt") != F.col("trans_month")))
    assert bad.count() == 0


def test_transactions_null_profile_per_landing_file(spark, staged):
    paths = ld.landing_paths(ld.list_files(spark, f"{staged['root']}/landing"))
    clean = stg.clean_transactions(ld.read_transactions(spark, paths))
    prof = dq.null_profile_by(clean.select(ld.LANDING_NAME, "trans_dt", "trans_key", "sales"),
                              ld.LANDING_NAME).collect()
    assert {r["landing_name"] for r in prof} == set(fixtures.LAYOUTS)
    assert all(r["null_count"] == 0 for r in prof)
