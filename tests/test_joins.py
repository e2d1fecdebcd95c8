"""Join strategies: size-checked broadcast and the salted hot-key split."""

import math

from pyspark.sql import functions as F

from conftest import SF_SMALL, plan_text
from salesmart.operators.joins import (HOT_KEY, ROW_ID, SALTS, hot_key_tables, join_dimension,
                                       salted_join)
from salesmart.plans import adapter


def skewed_fact(spark):
    """Transactions where one product key holds every line number 1 and 2
    (about a third of all rows) and some keys are NULL."""
    line = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")
    key = (F.when(F.col("l_linenumber") <= 2, F.lit("1"))
            .when(F.col("l_linenumber") == 7, F.lit(None).cast("string"))
            .otherwise(F.col("l_partkey").cast("string")))
    return line.select(key.alias("product_key"), F.col("l_orderkey").alias("trans_key"),
                       F.col("l_extendedprice").alias("sales"))


def test_hot_key_found_exactly(spark):
    fact = skewed_fact(spark)
    n_hot = fact.where(F.col("product_key") == "1").count()
    assert n_hot > fact.count() / 4
    hot = {r[HOT_KEY]: r[SALTS] for r in hot_key_tables(fact, ["product_key"], 500)["product_key"].collect()}
    assert hot["1"] == math.ceil(n_hot / 500)


def test_salted_join_equals_plain_join(spark):
    fact = skewed_fact(spark)
    prod = adapter.products(spark, SF_SMALL).select("product_key", "category")
    plain = fact.join(prod, "product_key", "left")
    salted = salted_join(fact, prod, "product_key", row_budget=200)
    cols = ["product_key", "trans_key", "sales", "category"]
    a = sorted((tuple(r) for r in plain.select(*cols).collect()), key=str)
    b = sorted((tuple(r) for r in salted.select(*cols).collect()), key=str)
    assert a == b
    assert HOT_KEY not in salted.columns and "_salt" not in salted.columns


def test_hot_key_rows_spread_over_salts(spark):
    fact = skewed_fact(spark)
    budget = 200
    hot = F.broadcast(hot_key_tables(fact, ["product_key"], budget)["product_key"])
    salted = (fact.withColumn(ROW_ID, F.monotonically_increasing_id()).join(hot, F.col("product_key").eqNullSafe(F.col(HOT_KEY)), "left")
              .select("product_key",
                      F.pmod(F.xxhash64(ROW_ID), F.coalesce(F.col(SALTS), F.lit(1))).alias("s")))
    per_salt = [r["count"] for r in salted.where(F.col("product_key") == "1")
                .groupBy("s").count().collect()]
    assert len(per_salt) > 1
    assert max(per_salt) < 2 * budget  # no salted group is much over budget


def test_left_join_dimension_broadcasts_small_side(spark):
    fact = skewed_fact(spark)
    prod = adapter.products(spark, SF_SMALL).select("product_key", "category")
    df = join_dimension(fact, prod, "product_key", broadcast_rows=10_000)
    assert "BroadcastHashJoin" in plan_text(df)
    df = join_dimension(fact, prod, "product_key", broadcast_rows=0, row_budget=200)
    assert df.count() == fact.count()


def test_fanout_guard(spark):
    import pytest
    from salesmart.operators.enrich import enrich
    txn, prod, loc = adapter.staging_frames(spark, SF_SMALL)
    doubled = prod.unionByName(prod.limit(1))
    with pytest.raises(ValueError):
        enrich(txn, doubled, loc, allow_fanout=False)
    assert enrich(txn, prod, loc, allow_fanout=False).count() == txn.count()


def test_size_check_bounds_rows_and_bytes(spark):
    from salesmart.operators.joins import size_within
    df = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("s"), "id")
    assert not size_within(df, 99, 100 * 1008)
    assert size_within(df, 100, 100 * 1008)
    assert not size_within(df, 100, 100 * 1008 - 1)


def test_salted_inner_join_equals_plain_inner_join(spark):
    from salesmart.operators.joins import salted_join
    fact = skewed_fact(spark)
    prod = adapter.products(spark, SF_SMALL).select("product_key", "category")
    plain = fact.join(prod, "product_key", "inner")
    salted = salted_join(fact, prod, "product_key", "inner", row_budget=200)
    cols = ["product_key", "trans_key", "sales", "category"]
    assert sorted(map(tuple, plain.select(*cols).collect())) == \
        sorted(map(tuple, salted.select(*cols).collect()))


def test_hot_key_tables_hold_the_keys_over_the_budget(spark):
    fact = skewed_fact(spark)
    tables = hot_key_tables(fact, ["product_key", "trans_key"], 5)
    for key in ("product_key", "trans_key"):
        counts = {r[key]: r["count"] for r in fact.groupBy(key).count().collect()}
        want = {k: math.ceil(n / 5) for k, n in counts.items() if n > 5}
        assert {r[HOT_KEY]: r[SALTS] for r in tables[key].collect()} == want, key


def test_most_hot_keys_are_salted_when_there_are_too_many(spark, monkeypatch):
    from salesmart.operators import joins
    monkeypatch.setattr(joins, "MAX_HOT_KEYS", 1)
    fact = skewed_fact(spark)
    tables = hot_key_tables(fact, ["product_key"], 5)
    assert [r[HOT_KEY] for r in tables["product_key"].collect()] == ["1"]
