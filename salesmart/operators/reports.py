"""Sales reports over the enriched sales table.

Every report is a ``DataFrame -> DataFrame`` function. Aggregates are hash
aggregates with a map-side partial step, so a dominant group (for example the
NULL category of unmatched products) is combined inside each task before the
shuffle and never lands whole in one task. Report outputs are small: one row
per province, store, category, loyalty flag or year.

``report_bundle`` computes the additive reports together: one scan builds two
base aggregates, at (province, store, loyalty) and (department, category)
grain — bounded by the dimension sizes, not by the sales — and ``GROUPING
SETS`` over those small results yield all seven additive reports. The two metric reports
hold distinct counts, which cannot be re-aggregated, so they share one second
scan with their own grouping sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.keys import is_member
from salesmart.functions.measures import (money_partial, money_sum, to_money,
                                          units_sum)

# Published output column names (the rank spelling is kept as
# published), default report sizes, and the output folder of each report.
TOTAL_SALES = "total_sales"
STORE_RANK = "store_rank_in_provice"
CATEGORY_RANK = "category_rank_in_department"
AVG_STORE_SALES = "avg_store_total_sales_in_province"
DEFAULT_TOP_STORES = 5
DEFAULT_TOP_CATEGORIES = 10
PREVIEW_ROWS = 20
REPORT_FOLDERS = {
    "sales_by_province": "salesByProvince",
    "sales_by_store": "salesByStore",
    "sales_by_category": "salesByCategory",
    "top_stores_by_province": "topNPerformingStoresByProvince",
    "top_categories_by_department": "topNProductCategoriesByDepartment",
    "sales_by_loyalty_province": "salesMadeByLoyaltyVsNonLoyaltyByProvince",
    "sales_by_loyalty": "salesMadeByLoyaltyVsNonLoyalty",
    "metrics_by_year": "salesByYear",
    "metrics_by_loyalty": "salesAndUnitsByLoyalty",
}


_METRIC_NAMES = ("total_sales", "total_units", "count_distinct_trans_key",
                 "count_distinct_collector_key")
# Report name -> published CSV columns, in order.
REPORT_COLUMNS = {
    "sales_by_province": ("province", "total_sales"),
    "sales_by_store": ("store_num", "total_sales"),
    "sales_by_category": ("category", "total_sales"),
    "top_stores_by_province": (STORE_RANK, "province", "store_num", "total_sales", AVG_STORE_SALES),
    "top_categories_by_department": (CATEGORY_RANK, "department", "category", "total_sales"),
    "sales_by_loyalty_province": ("province", "is_member", "total_sales"),
    "sales_by_loyalty": ("is_member", "total_sales"),
    "metrics_by_year": ("trans_year",) + _METRIC_NAMES,
    "metrics_by_loyalty": ("is_member",) + _METRIC_NAMES,
}


def with_membership(df: DataFrame) -> DataFrame:
    return df.withColumn("is_member", is_member("collector_key"))


def _needs_membership(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    if "is_member" in keys and "is_member" not in df.columns:
        return with_membership(df)
    return df


# ---------------------------------------------------------------- additive

def sales_by(df: DataFrame, *keys: str) -> DataFrame:
    """``keys..., total_sales``; a NULL key is a group of its own."""
    df = _needs_membership(df, keys)
    return df.groupBy(*keys).agg(money_sum("sales").alias(TOTAL_SALES))


def sales_by_province(df: DataFrame) -> DataFrame:
    return sales_by(df, "province")


def sales_by_store(df: DataFrame) -> DataFrame:
    return sales_by(df, "store_num")


def sales_by_category(df: DataFrame) -> DataFrame:
    return sales_by(df, "category")


def sales_by_loyalty_province(df: DataFrame) -> DataFrame:
    return sales_by(df, "province", "is_member")


def sales_by_loyalty(df: DataFrame) -> DataFrame:
    return sales_by(df, "is_member")


def top_sales(report: DataFrame, key: str, n: int = PREVIEW_ROWS) -> DataFrame:
    """First ``n`` rows of a report by descending sales (ties by key).

    Planned as a take-ordered (per-task top-n, then a merge of n rows per
    task), not a full sort.
    """
    return report.orderBy(F.col(TOTAL_SALES).desc_nulls_last(),
                          F.col(key).asc_nulls_first()).limit(n)


def sales_by_store_top20(df: DataFrame) -> DataFrame:
    return top_sales(sales_by_store(df), "store_num", PREVIEW_ROWS)


# ----------------------------------------------------------------- top-n

def top_stores_by_province(df: DataFrame, n: int = DEFAULT_TOP_STORES) -> DataFrame:
    """Top ``n`` stores of each province with the province's average store.

    Ties share a rank (``rank``), so a province may show more than ``n``
    stores. The average is taken over all stores of the province, before the
    top-n filter.
    """
    totals = sales_by(df, "province", "store_num")
    return _rank_stores(totals, n)


def _rank_stores(totals: DataFrame, n: int) -> DataFrame:
    by_province = Window.partitionBy("province")
    ranked = totals.select(
        F.rank().over(by_province.orderBy(F.col(TOTAL_SALES).desc())).alias(STORE_RANK),
        "province", "store_num", TOTAL_SALES,
        to_money(F.avg(TOTAL_SALES).over(by_province)).alias(AVG_STORE_SALES))
    return ranked.where(F.col(STORE_RANK) <= n)


def top_categories_by_department(df: DataFrame, n: int = DEFAULT_TOP_CATEGORIES) -> DataFrame:
    """Top ``n`` categories of each department (ties share a rank)."""
    totals = sales_by(df, "department", "category")
    return _rank_categories(totals, n)


def _rank_categories(totals: DataFrame, n: int) -> DataFrame:
    w = Window.partitionBy("department").orderBy(F.col(TOTAL_SALES).desc())
    return (totals.select(F.rank().over(w).alias(CATEGORY_RANK), "department",
                          "category", TOTAL_SALES)
            .where(F.col(CATEGORY_RANK) <= n))


# ---------------------------------------------------------------- metrics

def _distinct(column: str, approx_rsd: float | None) -> Column:
    if approx_rsd is None:
        return F.countDistinct(column)
    return F.approx_count_distinct(column, rsd=approx_rsd)


def _metric_columns(approx_rsd: float | None = None) -> list[Column]:
    return [money_sum("sales").alias(TOTAL_SALES),
            units_sum("units").alias("total_units"),
            _distinct("trans_key", approx_rsd).alias("count_distinct_trans_key"),
            _distinct("collector_key", approx_rsd).alias("count_distinct_collector_key")]


def metrics_by(df: DataFrame, key: str, approx_rsd: float | None = None) -> DataFrame:
    """Sales, units and distinct transaction / collector counts.

    Exact by default: the plan shuffles one row per distinct (group, value).
    ``approx_rsd`` (e.g. 0.01) switches the two counts to HyperLogLog++
    sketches, which shuffle a fixed-size sketch per group and task instead —
    the opt-in for very large inputs. Distinct counts are not additive: never
    sum them across groups (one transaction may span two years).
    """
    df = _needs_membership(df, (key,))
    return df.groupBy(key).agg(*_metric_columns(approx_rsd))


def metrics_by_year(df: DataFrame) -> DataFrame:
    return metrics_by(df, "trans_year")


def metrics_by_loyalty(df: DataFrame) -> DataFrame:
    return metrics_by(df, "is_member")


# ----------------------------------------------------------------- bundle

BASE_KEYS = ("province", "store_num", "department", "category", "is_member")

# report name -> grouping set of the additive bundle (fixed list).
ADDITIVE_SETS = {
    "sales_by_province": ("province",),
    "sales_by_store": ("store_num",),
    "sales_by_category": ("category",),
    "top_categories_by_department": ("department", "category"),
    "top_stores_by_province": ("province", "store_num"),
    "sales_by_loyalty_province": ("province", "is_member"),
    "sales_by_loyalty": ("is_member",),
}


def _grouping_id_of(keys: tuple[str, ...], grouped: tuple[str, ...]) -> int:
    """``grouping_id`` value of a set: bit set for each key rolled up."""
    gid = 0
    for k in keys:
        gid = (gid << 1) | (0 if k in grouped else 1)
    return gid


# The additive reports group by store-side keys or product-side keys, never
# both, so two narrow base aggregates serve all of them (fixed split).
STORE_BASE = ("province", "store_num", "is_member")
PRODUCT_BASE = ("department", "category")


def _base_of(keys: tuple[str, ...]) -> tuple[str, ...]:
    return STORE_BASE if set(keys) <= set(STORE_BASE) else PRODUCT_BASE


def report_bundle(df: DataFrame) -> DataFrame:
    """All additive report rows from one scan, tagged by report name.

    Columns: ``report, province, store_num, department, category, is_member,
    total_sales``; keys a report does not group by are NULL. A real NULL key
    is told apart from a rolled-up one by the grouping id.

    The scan feeds two exact partial sums at once — per (province, store,
    loyalty) and per (department, category) — each bounded by a dimension's
    size, so map-side combining shrinks the sales to a few rows per task
    before anything is shuffled. The seven report groupings are rolled up
    from that small result in a second aggregate keyed by the base it comes
    from; rows pairing a grouping with the other base are dropped only after
    that aggregate, so the filter cannot be pushed down into two scans.
    """
    src = with_membership(df.select("province", "store_num", "department", "category",
                                    "collector_key", "sales"))
    base_keys = STORE_BASE + PRODUCT_BASE
    base_cols = [F.col(k) for k in base_keys]
    base = (src.groupingSets([[F.col(k) for k in STORE_BASE], [F.col(k) for k in PRODUCT_BASE]],
                             *base_cols)
            .agg(money_partial("sales").alias("_sales"), F.grouping_id(*base_cols).alias("_base")))
    return rolled_up(base)


def base_id(base: tuple[str, ...]) -> int:
    """``_base`` of the rows that ``base`` groups by."""
    return _grouping_id_of(STORE_BASE + PRODUCT_BASE, base)


def rolled_up(base: DataFrame) -> DataFrame:
    """The additive reports from partial sums (``_sales``) at the two base
    grains, told apart by ``_base``."""
    roll_keys = ("_base",) + BASE_KEYS
    roll_cols = [F.col(k) for k in roll_keys]
    sets = [[F.col("_base")] + [F.col(k) for k in ks] for ks in ADDITIVE_SETS.values()]
    grouped = (base.groupingSets(sets, *roll_cols)
               .agg(to_money(F.sum("_sales")).alias(TOTAL_SALES),
                    F.grouping_id(*roll_cols).alias("_gid")))
    report = F.lit(None).cast("string")
    for name, ks in ADDITIVE_SETS.items():
        match = ((F.col("_gid") == _grouping_id_of(roll_keys, ("_base",) + ks))
                 & (F.col("_base") == base_id(_base_of(ks))))
        report = F.when(match, F.lit(name)).otherwise(report)
    return (grouped.select(report.alias("report"), *BASE_KEYS, TOTAL_SALES)
            .where(F.col("report").isNotNull()))


def metrics_bundle(df: DataFrame, approx_rsd: float | None = None) -> DataFrame:
    """Both metric reports from one scan: ``report, trans_year, is_member, ...``
    (``approx_rsd`` as in ``metrics_by``).

    Exact counts first aggregate the sales to one row per (year, transaction,
    collector), whose partial sums and values both reports then use: the
    expansion that distinct counts need works on that smaller set.
    """
    src = df.select("trans_year", "collector_key", "trans_key", "sales", "units")
    if approx_rsd is not None:
        return _by_year_and_loyalty(with_membership(src), _metric_columns(approx_rsd))
    return metrics_of(with_membership(metric_rows(src)))


def metric_rows(df: DataFrame) -> DataFrame:
    """Partial sums (``_sales``, ``_units``) of the sales by year, transaction and
    collector."""
    sums = [money_partial("sales").alias("_sales"), F.sum("units").alias("_units")]
    return df.groupBy("trans_year", "trans_key", "collector_key").agg(*sums)


METRIC_KEYS = ("trans_year", "is_member")


def metrics_of(rows: DataFrame, by: tuple[str, ...] = METRIC_KEYS) -> DataFrame:
    """Both metric reports, or one, from partial sums (``_sales``, ``_units``) by
    transaction and collector."""
    return _by_year_and_loyalty(rows, [
        to_money(F.sum("_sales")).alias(TOTAL_SALES), F.sum("_units").cast("bigint").alias("total_units"),
        _distinct("trans_key", None).alias("count_distinct_trans_key"),
        _distinct("collector_key", None).alias("count_distinct_collector_key")], by)


def _by_year_and_loyalty(src: DataFrame, metrics: list[Column], by: tuple[str, ...] = METRIC_KEYS) -> DataFrame:
    keys = [F.col(k) for k in METRIC_KEYS]
    grouped = (src.groupingSets([[F.col(k)] for k in by], *keys)
               .agg(*metrics, F.grouping_id(*keys).alias("_gid")))
    report = F.when(F.col("_gid") == 1, F.lit("metrics_by_year")).otherwise(F.lit("metrics_by_loyalty"))
    return grouped.select(report.alias("report"), "trans_year", "is_member", TOTAL_SALES,
                          "total_units", "count_distinct_trans_key",
                          "count_distinct_collector_key")


def split_bundle(bundle: DataFrame, metrics: DataFrame,
                 top_stores: int = DEFAULT_TOP_STORES,
                 top_categories: int = DEFAULT_TOP_CATEGORIES) -> dict[str, DataFrame]:
    """The nine published reports, each read off the (small) bundles."""
    def part(name: str, *cols: str) -> DataFrame:
        return bundle.where(F.col("report") == name).select(*cols, TOTAL_SALES)

    def metric(name: str, key: str) -> DataFrame:
        return metrics.where(F.col("report") == name).select(
            key, TOTAL_SALES, "total_units", "count_distinct_trans_key",
            "count_distinct_collector_key")

    return {
        "sales_by_province": part("sales_by_province", "province"),
        "sales_by_store": part("sales_by_store", "store_num"),
        "sales_by_category": part("sales_by_category", "category"),
        "top_stores_by_province": _rank_stores(
            part("top_stores_by_province", "province", "store_num"), top_stores),
        "top_categories_by_department": _rank_categories(
            part("top_categories_by_department", "department", "category"), top_categories),
        "sales_by_loyalty_province": part("sales_by_loyalty_province", "province", "is_member"),
        "sales_by_loyalty": part("sales_by_loyalty", "is_member"),
        "metrics_by_year": metric("metrics_by_year", "trans_year"),
        "metrics_by_loyalty": metric("metrics_by_loyalty", "is_member"),
    }


# Published row order of each report (applied by the CSV sink only):
# (column, descending) pairs; ascending keys sort NULL first.
REPORT_ORDER = {
    "sales_by_province": [],
    "sales_by_store": [(TOTAL_SALES, True), ("store_num", False)],
    "sales_by_category": [(TOTAL_SALES, True), ("category", False)],
    "top_stores_by_province": [("province", False), (STORE_RANK, False), ("store_num", False)],
    "top_categories_by_department": [("department", False), (CATEGORY_RANK, False),
                                     ("category", False)],
    "sales_by_loyalty_province": [("province", False), ("is_member", False)],
    "sales_by_loyalty": [("is_member", False)],
    "metrics_by_year": [("trans_year", False)],
    "metrics_by_loyalty": [("is_member", False)],
}


def report_order(name: str) -> list[Column]:
    return [F.col(c).desc_nulls_last() if desc else F.col(c).asc_nulls_first()
            for c, desc in REPORT_ORDER.get(name, [])]


REPORTS = {
    "sales_by_province": sales_by_province,
    "sales_by_store": sales_by_store,
    "sales_by_category": sales_by_category,
    "top_stores_by_province": top_stores_by_province,
    "top_categories_by_department": top_categories_by_department,
    "sales_by_loyalty_province": sales_by_loyalty_province,
    "sales_by_loyalty": sales_by_loyalty,
    "metrics_by_year": metrics_by_year,
    "metrics_by_loyalty": metrics_by_loyalty,
}
