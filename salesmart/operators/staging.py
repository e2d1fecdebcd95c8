"""Staging transforms: landing text -> typed contract rows.

Pure ``DataFrame -> DataFrame`` functions over all-string landing frames.
Nothing here acts; rows that cannot be typed are routed to a rejects frame
instead of failing the whole load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.contracts import LOCATION, PRODUCT, TRANSACTIONS
from salesmart.functions.keys import (amount, blank_to_null, canonical_key,
                                      normalize_trans_key, number, parse_trans_dt)
from salesmart.functions.measures import money_sum
from salesmart.sources.landing import LANDING_NAME, SOURCE_FILE

REJECT_REASON = "reject_reason"
# A key printed in E-notation keeps about 10 significant digits; one ending
# in this many zeros has most likely lost digits and may collide with others.
LOSSY_KEY_PATTERN = r"0{12}$"
BAD_TRANS_DT = "unparseable trans_dt"


def stage_locations(raw: DataFrame) -> DataFrame:
    """Store dimension: keys canonical, other columns kept as text."""
    return LOCATION.conform(raw.select(
        canonical_key("store_location_key").alias("store_location_key"),
        blank_to_null("region").alias("region"),
        blank_to_null("province").alias("province"),
        blank_to_null("city").alias("city"),
        blank_to_null("postal_code").alias("postal_code"),
        blank_to_null("banner").alias("banner"),
        canonical_key("store_num").alias("store_num")))


def stage_products(raw: DataFrame) -> DataFrame:
    """Product dimension: numeric codes canonical, other columns as text."""
    return PRODUCT.conform(raw.select(
        canonical_key("product_key").alias("product_key"),
        canonical_key("sku").alias("sku"),
        canonical_key("upc").alias("upc"),
        blank_to_null("item_name").alias("item_name"),
        blank_to_null("item_description").alias("item_description"),
        blank_to_null("department").alias("department"),
        blank_to_null("category").alias("category")))


def merge_by_key(current: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The rows of ``current`` whose key ``new`` does not bring (a NULL key is a
    key like any other); with the rows of ``new`` they are the merged table."""
    keys = new.select(F.col(key).alias("_new_key")).distinct()
    return current.join(keys, current[key].eqNullSafe(keys["_new_key"]), "left_anti")


def clean_transactions(raw: DataFrame, lenient_dates: bool = False) -> DataFrame:
    """Typed transaction rows with audit columns.

    Output: the staging contract columns, then ``sales_was_missing``,
    ``units_was_missing``, ``reject_reason`` (NULL for a good row) and the
    source file columns when present. Missing or bad ``sales``/``units``
    become 0, flagged by the audit columns.
    """
    # Parsed once per row; each step only refers to the results of the one before.
    raw = (raw.withColumns({"trans_dt": parse_trans_dt("trans_dt", lenient=lenient_dates),
                            "sales": number("sales"), "units": number("units")})
           .withColumns({"sales": amount("sales"), "units": amount("units").try_cast("int")}))
    trans_dt, sales, units = F.col("trans_dt"), F.col("sales"), F.col("units")
    extra = [c for c in (SOURCE_FILE, LANDING_NAME) if c in raw.columns]
    typed = raw.select(
        canonical_key("store_location_key").alias("store_location_key"),
        canonical_key("product_key").alias("product_key"),
        canonical_key("collector_key").alias("collector_key"),
        trans_dt.alias("trans_dt"),
        F.coalesce(sales, F.lit(0.0)).alias("sales"),
        F.coalesce(units, F.lit(0)).alias("units"),
        normalize_trans_key("trans_key").alias("trans_key"),
        F.year(trans_dt).alias("trans_year"),
        F.month(trans_dt).alias("trans_month"),
        sales.isNull().alias("sales_was_missing"),
        units.isNull().alias("units_was_missing"),
        F.when(trans_dt.isNull(), F.lit(BAD_TRANS_DT)).alias(REJECT_REASON),
        *extra)
    return typed


def accepted(clean: DataFrame) -> DataFrame:
    """Good rows in staging contract form."""
    return TRANSACTIONS.conform(clean.where(F.col(REJECT_REASON).isNull()))


def rejects(raw: DataFrame, lenient_dates: bool = False) -> DataFrame:
    """Raw text of rows that cannot be staged, with the reason."""
    reason = F.when(parse_trans_dt("trans_dt", lenient=lenient_dates).isNull(),
                    F.lit(BAD_TRANS_DT))
    return raw.select("*", reason.alias(REJECT_REASON)).where(F.col(REJECT_REASON).isNotNull())


def measure_audit(clean: DataFrame, by: str = LANDING_NAME) -> DataFrame:
    """Per landing file: rows, zero-filled sales/units, their sums, and keys
    that probably lost digits in E-notation."""
    return clean.groupBy(by).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("sales_was_missing")).alias("sales_filled"),
        F.count_if(F.col("units_was_missing")).alias("units_filled"),
        money_sum("sales").alias("total_sales"),
        F.sum("units").cast("bigint").alias("total_units"),
        F.count_if(F.col("trans_key").rlike(LOSSY_KEY_PATTERN)).alias("lossy_trans_keys"))
