"""Dirty landing files rendered from the test tables.

Each ``lineitem`` row becomes one landing transaction line in one of four
layouts, picked by ``l_linenumber % 4`` — the layouts of real landing drops:

=========  ==================================  ===================  =========================
name       column order                        trans_dt text        other damage
=========  ==================================  ===================  =========================
trans_fact_5  collector_key, trans_dt, store,  ``2015-07-24 00:00:00``  —
              product, sales, units, trans_key
trans_fact_4  as trans_fact_5                  ``7/24/2015``        E-notation key, units as
                                                                    ``1.0``, zero-padded product
trans_fact_6  as trans_fact_5, key ``trans_id``  ``7/24/2015``      E-notation key, units blank
trans_fact_8  product first, key ``trans_id``  ``7/24/2015``        E-notation key, sales blank,
                                                                    zero-padded store
=========  ==================================  ===================  =========================

Every layout is written as its own CSV folder named ``trans_fact_<n>``.
The dimension files are written with shuffled column order and zero-padded
keys, so staging must read by header name and canonicalise keys.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.plans import adapter
from salesmart.session import shuffles_freed
from salesmart.sources.tables import test_table

# Fixed landing layouts: layout number -> (line remainder, header).
T5_HEADER = ("collector_key", "trans_dt", "store_location_key", "product_key", "sales",
             "units", "trans_key")
T4_HEADER = T5_HEADER
T6_HEADER = ("collector_key", "trans_dt", "store_location_key", "product_key", "sales",
             "units", "trans_id")
T8_HEADER = ("product_key", "collector_key", "trans_dt", "store_location_key", "sales",
             "units", "trans_id")
LAYOUTS = {
    "trans_fact_5": (0, T5_HEADER),
    "trans_fact_4": (1, T4_HEADER),
    "trans_fact_6": (2, T6_HEADER),
    "trans_fact_8": (3, T8_HEADER),
}
LOCATION_HEADER = ("store_num", "province", "city", "store_location_key", "region",
                   "postal_code", "banner")
PRODUCT_HEADER = ("category", "department", "product_key", "sku", "upc", "item_name",
                  "item_description")
ISO_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
SLASH_FORMAT = "M/d/yyyy"
KEY_PAD = 12
SPOILED_EVERY = 11


def e_notation(digits: Column) -> Column:
    """Exact scientific text of an integer: ``1234`` -> ``1.2340E+3``."""
    return F.concat(F.substring(digits, 1, 1), F.lit("."), F.substring(digits, 2, 1 << 20),
                    F.lit("0E+"), (F.length(digits) - 1).cast("string"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return test_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_shipdate")


def _layout(rem: Column) -> Column:
    """A line without a number goes to the last layout (its columns rendered
    like those of no layout in particular)."""
    names = list(LAYOUTS)
    return F.when(rem.isNull(), F.lit(names[-1])).otherwise(
        F.element_at(F.array(*[F.lit(n) for n in names]), (rem + 1).cast("int")))


def landing_lines(spark: SparkSession, sf_dir: str, spoiled: bool = False) -> DataFrame:
    """All landing transaction lines as text, tagged by layout name;
    ``spoiled``: every eleventh order has a month and a day past their ends."""
    return _rendered(adapter.with_orders(spark, sf_dir, _lines(spark, sf_dir)), spoiled)


def _rendered(lines: DataFrame, spoiled: bool) -> DataFrame:
    cust = F.col("o_custkey")
    rem = F.col("l_linenumber") % 4
    key = F.col("l_orderkey").cast("string")
    product = adapter.product_of(F.col("l_partkey"))
    store = adapter.store_of(F.col("l_suppkey"))
    units = F.col("l_quantity").cast("int").cast("string")
    day = F.col("l_shipdate")
    bad = (F.col("l_orderkey") % SPOILED_EVERY == 0) if spoiled else F.lit(False)
    bad_month, bad_day, year = (x.cast("string") for x in (F.month(day) + 12, F.dayofmonth(day) + 31, F.year(day)))
    return lines.select(
        _layout(rem).alias("layout"),
        F.when(cust % adapter.NON_MEMBER_EVERY == 0, F.lit("-1"))
         .when(cust % adapter.NO_CARD_EVERY == 0, F.lit(None).cast("string"))
         .otherwise(cust.cast("string")).alias("collector_key"),
        F.when(bad & (rem == 0), F.concat(year, F.lit("-"), bad_month, F.lit("-"), bad_day, F.lit(" 00:00:00")))
         .when(bad, F.concat(bad_month, F.lit("/"), bad_day, F.lit("/"), year))
         .when(rem == 0, F.date_format("l_shipdate", ISO_TIME_FORMAT))
         .otherwise(F.date_format("l_shipdate", SLASH_FORMAT)).alias("trans_dt"),
        F.when(rem == 3, F.lpad(store, KEY_PAD, "0")).otherwise(store).alias("store_location_key"),
        F.when(rem == 1, F.lpad(product, KEY_PAD, "0")).otherwise(product).alias("product_key"),
        F.when(rem == 3, F.lit(None).cast("string"))
         .otherwise(F.col("l_extendedprice").cast("string")).alias("sales"),
        F.when(rem == 2, F.lit(None).cast("string"))
         .when(rem == 1, F.col("l_quantity").cast("int").cast("double").cast("string"))
         .otherwise(units).alias("units"),
        F.when(rem == 0, key).otherwise(e_notation(key)).alias("trans_key"),
    )


def write_landing(spark: SparkSession, sf_dir: str, landing_dir: str,
                  layouts: tuple[str, ...] | None = None, spell=str,
                  where: Column | None = None, suffix: str = "", spoiled: bool = False) -> list[str]:
    """Write the chosen layouts (default: all) under ``landing_dir``, with
    header names spelled by ``spell``; ``where`` picks lines by the columns of
    ``lineitem``, ``suffix`` ends the folders' names. Each layout joins its own
    lines only, straight into its files; nothing is kept in between."""
    lines = _lines(spark, sf_dir)
    lines = lines if where is None else lines.where(where)
    names = list(layouts or LAYOUTS)
    with_customer = adapter.order_join(spark, sf_dir, lines)

    def write(name: str) -> None:
        _, header = LAYOUTS[name]
        cols = [F.col("trans_key" if c == "trans_id" else c).alias(spell(c)) for c in header]
        mine = lines.where(_layout(F.col("l_linenumber") % 4) == name)
        (_rendered(with_customer(mine), spoiled).select(*cols)
         .write.mode("overwrite").option("header", True)
         .csv(f"{landing_dir.rstrip('/')}/{name}{suffix}"))

    # Independent jobs: submitted together, so that one's last tasks leave no core idle.
    with shuffles_freed(spark), ThreadPoolExecutor(max_workers=len(names)) as pool:
        list(pool.map(write, names))
    return names


def write_location_landing(spark: SparkSession, sf_dir: str, landing_dir: str, part: int | None = None) -> str:
    """``part``: 0 or 1 drops only the stores with that key remainder, as a
    folder of their own below location.csv."""
    loc = adapter.locations(spark, sf_dir)
    path = f"{landing_dir.rstrip('/')}/location.csv"
    if part is not None:
        loc = loc.where(F.col("store_location_key").cast("int") % 2 == part)
        path = f"{path}/part={part}"
    loc = loc.withColumn("store_location_key", F.lpad("store_location_key", KEY_PAD, "0"))
    loc.select(*LOCATION_HEADER).write.mode("overwrite").option("header", True).csv(path)
    return path


def write_product_landing(spark: SparkSession, sf_dir: str, landing_dir: str,
                          change=None, drop: int | None = None) -> str:
    """``change`` maps the products to those of one drop, which ``drop`` puts
    into a folder of its own below product.csv."""
    prod = adapter.products(spark, sf_dir)
    prod = (change(prod) if change else prod).withColumn(
        "product_key", F.lpad("product_key", KEY_PAD, "0"))
    path = f"{landing_dir.rstrip('/')}/product.csv"
    if drop is not None:
        path = f"{path}/drop={drop}"
    prod.select(*PRODUCT_HEADER).write.mode("overwrite").option("header", True).csv(path)
    return path
