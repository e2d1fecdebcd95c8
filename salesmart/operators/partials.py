"""Monthly partial results that the reports are folded from.

Four small tables, each partitioned by (trans_year, trans_month), hold what one
month of sales adds to every report:

* ``store_sums``    decimal sums by province, store and loyalty;
* ``product_sums``  decimal sums by department and category;
* ``baskets``       sums and units by transaction and collector, from which
                    exact distinct counts are taken;
* ``sketches``      HyperLogLog sketches of transactions and collectors by
                    loyalty, which fold into approximate distinct counts.

Sums of decimals and unions of sketches do not depend on how months are put
together, so a change of one month rewrites that month's folders only, and the
folded reports equal those of a scan over all sales (sketches: within the error
below). Each table's aggregate combines inside the map tasks; its rows are
bounded by dimensions, transactions or months, never by sales.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, DecimalType, IntegerType, LongType,
                               StringType, StructField, StructType)

from salesmart.contracts import TableContract
from salesmart.functions.measures import money_partial
from salesmart.operators import reports as rep

MONTH = ("trans_year", "trans_month")
#: Sketches of 2^14 registers. The relative standard error of a union of such
#: sketches is 1.04 / sqrt(2^14), 0.8 percent; a count is off by more than
#: three of them in about one of 400 cases.
SKETCH_LOG2 = 14
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_LOG2 / 2)

_SUM, _UNITS = ("sales_sum", DecimalType(32, 4)), ("units_sum", LongType())


def _contract(name: str, *columns) -> TableContract:
    """Columns are names of strings, or (name, type)."""
    columns = [(c, StringType()) if isinstance(c, str) else c for c in columns]
    fields = [StructField(n, t, True) for n, t in (*columns, *((m, IntegerType()) for m in MONTH))]
    return TableContract(name=name, schema=StructType(fields), partition_by=MONTH, mode="dynamic")


STORE_SUMS = _contract("store_sums", *rep.STORE_BASE, _SUM)
PRODUCT_SUMS = _contract("product_sums", *rep.PRODUCT_BASE, _SUM)
BASKETS = _contract("baskets", "trans_key", "collector_key", _SUM, _UNITS)
SKETCHES = _contract("sketches", "is_member", ("trans_sketch", BinaryType()), ("collector_sketch", BinaryType()), _SUM, _UNITS)
TABLES = (STORE_SUMS, PRODUCT_SUMS, BASKETS, SKETCHES)


def partials(sales: DataFrame) -> dict[str, DataFrame]:
    """The rows of each table for the months in ``sales``."""
    member = rep.with_membership(sales)
    total, units = money_partial("sales").alias("sales_sum"), F.sum("units").cast("bigint").alias("units_sum")
    return {
        "store_sums": member.groupBy(*rep.STORE_BASE, *MONTH).agg(total),
        "product_sums": sales.groupBy(*rep.PRODUCT_BASE, *MONTH).agg(total),
        "baskets": sales.groupBy("trans_key", "collector_key", *MONTH).agg(total, units),
        "sketches": member.groupBy("is_member", *MONTH).agg(
            F.hll_sketch_agg("trans_key", F.lit(SKETCH_LOG2)).alias("trans_sketch"),
            F.hll_sketch_agg("collector_key", F.lit(SKETCH_LOG2)).alias("collector_sketch"), total, units),
    }


def bundle(store_sums: DataFrame, product_sums: DataFrame) -> DataFrame:
    """``report_bundle`` folded from the two tables of sums."""
    keys = rep.STORE_BASE + rep.PRODUCT_BASE
    stores = store_sums.select(*rep.STORE_BASE, *[F.lit(None).cast("string").alias(k) for k in rep.PRODUCT_BASE],
                               F.col("sales_sum").alias("_sales"), F.lit(rep.base_id(rep.STORE_BASE)).alias("_base"))
    products = product_sums.select(*[F.lit(None).cast("string").alias(k) for k in rep.STORE_BASE], *rep.PRODUCT_BASE,
                                   F.col("sales_sum").alias("_sales"), F.lit(rep.base_id(rep.PRODUCT_BASE)).alias("_base"))
    return rep.rolled_up(stores.unionByName(products).select(*keys, "_sales", "_base"))


def metrics(baskets: DataFrame) -> DataFrame:
    """``metrics_bundle`` with exact counts, folded from the baskets."""
    return rep.metrics_of(rep.with_membership(metric_rows(baskets)))


def metric_rows(baskets: DataFrame) -> DataFrame:
    """The baskets as ``reports.metric_rows`` has the sales."""
    return baskets.withColumnsRenamed({"sales_sum": "_sales", "units_sum": "_units"})


def estimate(sketch: str) -> Column:
    """Distinct count of the union of a group's sketches."""
    return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(sketch)), F.lit(0)).cast("bigint")


def sketched_counts(sketches: DataFrame, *keys: str) -> DataFrame:
    """Approximate distinct transactions and collectors by any of the sketch
    table's keys (months, years, loyalty)."""
    return sketches.groupBy(*keys).agg(estimate("trans_sketch").alias("count_distinct_trans_key"),
                                       estimate("collector_sketch").alias("count_distinct_collector_key"))


def sketched_metrics(sketches: DataFrame) -> DataFrame:
    """``metrics_bundle`` whose counts come from the sketches; sums are exact."""
    out = None
    for name, key in (("metrics_by_year", "trans_year"), ("metrics_by_loyalty", "is_member")):
        sums = [F.sum("sales_sum").cast("decimal(28,3)").alias(rep.TOTAL_SALES), F.sum("units_sum").cast("bigint").alias("total_units")]
        rows = sketches.groupBy(key).agg(*sums, estimate("trans_sketch").alias("count_distinct_trans_key"),
                                         estimate("collector_sketch").alias("count_distinct_collector_key"))
        part = rows.select(F.lit(name).alias("report"),
                           *[F.col(k) if k == key else F.lit(None).cast(t).alias(k) for k, t in (("trans_year", "int"), ("is_member", "string"))],
                           rep.TOTAL_SALES, "total_units", "count_distinct_trans_key", "count_distinct_collector_key")
        out = part if out is None else out.unionByName(part)
    return out
