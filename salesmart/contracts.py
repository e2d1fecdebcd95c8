"""Table contracts: column names, types, order and partition layout.

A contract is applied explicitly on read and on write, so no table depends on
schema inference (hex-like codes read as doubles, leading zeros dropped,
partition values re-typed — see the README).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DoubleType, IntegerType, StringType,
                               StructField, StructType)


@dataclass(frozen=True)
class TableContract:
    name: str
    schema: StructType
    partition_by: tuple[str, ...]
    # Default mode of a load: "overwrite" replaces the table, "merge" replaces
    # the rows of the keys it brings, "append" and "dynamic" as in sinks.
    mode: str
    key: str | None = None  # of a merge
    # Keys that rows are looked up by; files get bloom filters for them.
    lookup: tuple[str, ...] = ()

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    def columns(self) -> list[Column]:
        """Contract columns, cast to contract types, in contract order."""
        return [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]

    def conform(self, df: DataFrame) -> DataFrame:
        return df.select(*self.columns())


def _strings(*names: str) -> list[StructField]:
    return [StructField(n, StringType(), True) for n in names]


LOCATION = TableContract(
    name="location",
    schema=StructType(_strings("store_location_key", "region", "province", "city",
                               "postal_code", "banner", "store_num")),
    partition_by=("province",),
    mode="overwrite",
)

PRODUCT = TableContract(
    name="product",
    schema=StructType(_strings("product_key", "sku", "upc", "item_name",
                               "item_description", "department", "category")),
    partition_by=("department",),
    mode="merge",
    key="product_key",
    lookup=("product_key",),
)

TRANSACTIONS = TableContract(
    name="transactions",
    schema=StructType(
        _strings("store_location_key", "product_key", "collector_key")
        + [StructField("trans_dt", DateType(), True),
           StructField("sales", DoubleType(), True),
           StructField("units", IntegerType(), True),
           StructField("trans_key", StringType(), True),
           StructField("trans_year", IntegerType(), True),
           StructField("trans_month", IntegerType(), True)]),
    partition_by=("trans_year", "trans_month"),
    mode="append",
    lookup=("product_key", "trans_key"),
)

ENRICHED = TableContract(
    name="enriched_transactions",
    schema=StructType(
        _strings("collector_key")
        + [StructField("trans_dt", DateType(), True),
           StructField("sales", DoubleType(), True),
           StructField("units", IntegerType(), True),
           StructField("trans_key", StringType(), True),
           StructField("trans_year", IntegerType(), True),
           StructField("trans_month", IntegerType(), True)]
        + _strings("product_key", "sku", "upc", "item_name", "item_description",
                   "department", "category", "store_location_key", "region",
                   "province", "city", "postal_code", "banner", "store_num")),
    partition_by=("province", "trans_year", "trans_month"),
    mode="dynamic",
)

# Landing transaction files: every layout carries these columns under these
# names (``trans_id`` is renamed to ``trans_key`` on read).
LANDING_TRANSACTION_COLUMNS = ("collector_key", "trans_dt", "store_location_key",
                               "product_key", "sales", "units", "trans_key")

CONTRACTS = {c.name: c for c in (LOCATION, PRODUCT, TRANSACTIONS, ENRICHED)}
