"""Map the generated test tables onto the pipeline's three staging tables.

The test tables have full referential integrity and no missing customers, so
gaps are made on purpose to exercise the left joins and the loyalty flag:

* transactions: one per ``lineitem`` row, collector taken from ``orders``;
  customers divisible by 3 are non-members (``-1``), by 7 have no card (NULL);
* sales of every tenth part or twentieth store carry a product or store key
  that no dimension row has (the key behind a prefix); both dimensions are
  loaded whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.contracts import LOCATION, PRODUCT, TRANSACTIONS
from salesmart.functions.keys import NON_MEMBER_KEY
from salesmart.operators.joins import dimension_join
from salesmart.sources.tables import test_table

# Fixed gap rules of the test mapping.
NON_MEMBER_EVERY = 3
NO_CARD_EVERY = 7
UNKNOWN_PRODUCT_EVERY = 10
UNKNOWN_STORE_EVERY = 20
UNKNOWN_PREFIX = "9000"


def product_of(key):
    """The sale's product key: unknown to the dimension for every tenth part."""
    return F.when(key % UNKNOWN_PRODUCT_EVERY == 0, F.concat(F.lit(UNKNOWN_PREFIX), key.cast("string"))).otherwise(key.cast("string"))


def store_of(key):
    """The sale's store key: unknown to the dimension for every twentieth store."""
    return F.when(key % UNKNOWN_STORE_EVERY == 0, F.concat(F.lit(UNKNOWN_PREFIX), key.cast("string"))).otherwise(key.cast("string"))


def _s(c: str):
    return F.col(c).cast("string")


def order_join(spark: SparkSession, sf_dir: str, line: DataFrame):
    """How parts of the lines get their order's customer (inner join on the
    order key): broadcast when the orders are proven small, else a shuffle join
    that splits an order key holding a large share of the lines. Decided once,
    on all of ``line``."""
    orders = test_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return dimension_join(line, orders, "l_orderkey", how="inner")


def with_orders(spark: SparkSession, sf_dir: str, line: DataFrame) -> DataFrame:
    return order_join(spark, sf_dir, line)(line)


def sale_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension keys of all sales, read off the lines alone: keys that many
    sales share are found without the join with the orders."""
    line = test_table(spark, sf_dir, "lineitem")
    return line.select(store_of(F.col("l_suppkey")).alias("store_location_key"),
                       product_of(F.col("l_partkey")).alias("product_key"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = test_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_shipdate")
    cust = F.col("o_custkey")
    day = F.col("l_shipdate").cast("date")
    df = with_orders(spark, sf_dir, line).select(
        store_of(F.col("l_suppkey")).alias("store_location_key"),
        product_of(F.col("l_partkey")).alias("product_key"),
        F.when(cust % NON_MEMBER_EVERY == 0, F.lit(NON_MEMBER_KEY))
         .when(cust % NO_CARD_EVERY == 0, F.lit(None).cast("string"))
         .otherwise(_s("o_custkey")).alias("collector_key"),
        day.alias("trans_dt"),
        F.col("l_extendedprice").alias("sales"),
        F.col("l_quantity").cast("int").alias("units"),
        _s("l_orderkey").alias("trans_key"),
        F.year(day).alias("trans_year"),
        F.month(day).alias("trans_month"),
    )
    return TRANSACTIONS.conform(df)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = test_table(spark, sf_dir, "part")
    df = part.select(
        _s("p_partkey").alias("product_key"),
        _s("p_size").alias("sku"),
        _s("p_partkey").alias("upc"),
        F.col("p_name").alias("item_name"),
        F.col("p_type").alias("item_description"),
        F.col("p_brand").alias("department"),
        F.col("p_name").alias("category"),
    )
    return PRODUCT.conform(df)


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = test_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = test_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = test_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # Plain joins: the planner broadcasts a side whose measured size is small.
    df = (supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
          .join(region, F.col("n_regionkey") == region.r_regionkey)
          .select(_s("s_suppkey").alias("store_location_key"),
                  F.lit("NA").alias("region"),
                  F.col("r_name").alias("province"),
                  F.col("n_name").alias("city"),
                  F.lit("NA").alias("postal_code"),
                  F.col("s_name").alias("banner"),
                  _s("s_suppkey").alias("store_num")))
    return LOCATION.conform(df)


def staging_frames(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(transactions, products, locations) for ``sf_dir``."""
    return transactions(spark, sf_dir), products(spark, sf_dir), locations(spark, sf_dir)
