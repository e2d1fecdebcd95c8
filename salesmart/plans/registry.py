"""Registered queries: name -> ``(spark, sf_dir) -> DataFrame``.

Each query builds the staging frames from the test tables (see
``salesmart.plans.adapter``), enriches them and applies one operator. The
matching SQL is in ``salesmart.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from salesmart.contracts import ENRICHED
from salesmart.operators import enrich as enr
from salesmart.operators import reports as rep
from salesmart.plans import adapter
from salesmart.sources import sinks
from salesmart.sources.tables import test_table

Query = Callable[[SparkSession, str], DataFrame]


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    txn, prod, loc = adapter.staging_frames(spark, sf_dir)
    return enr.enrich(txn, prod, loc, counted=adapter.sale_keys(spark, sf_dir))


def write_enriched(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The enriched sales as a table, joined and written in parts of whole
    months where there are many."""
    txn, prod, loc = adapter.staging_frames(spark, sf_dir)
    joined = enr.enrichment(txn, prod, loc, counted=adapter.sale_keys(spark, sf_dir))
    rows = test_table(spark, sf_dir, "lineitem").count()
    with sinks.sliced(txn, sinks.slices(rows)) as parts:
        for i, part in enumerate(parts):
            sinks.write_table(joined(part), path, ENRICHED, mode="append" if i else "overwrite")


def _report(fn: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(enriched(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def enriched_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrichment with broadcasts disabled and a tiny per-key row budget, so
    every join takes the salted shuffle path used for large dimensions."""
    txn, prod, loc = adapter.staging_frames(spark, sf_dir)
    return enr.enrich(txn, prod, loc, broadcast_rows=0, row_budget=SALTED_TEST_BUDGET,
                      counted=adapter.sale_keys(spark, sf_dir))


# Per-key row budget of the salted variant: small enough that most product
# and store keys of the test tables are split.
SALTED_TEST_BUDGET = 4


def enrich_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enr.enrich_counts(*adapter.staging_frames(spark, sf_dir), counted=adapter.sale_keys(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "sales_by_province": _report(rep.sales_by_province),
    "sales_by_store": _report(rep.sales_by_store),
    "sales_by_store_top20": _report(rep.sales_by_store_top20),
    "sales_by_category": _report(rep.sales_by_category),
    "top_stores_by_province": _report(rep.top_stores_by_province),
    "top_categories_by_department": _report(rep.top_categories_by_department),
    "sales_by_loyalty_province": _report(rep.sales_by_loyalty_province),
    "sales_by_loyalty": _report(rep.sales_by_loyalty),
    "metrics_by_year": _report(rep.metrics_by_year),
    "metrics_by_loyalty": _report(rep.metrics_by_loyalty),
    "report_bundle": _report(rep.report_bundle),
    "enrich_transactions": enriched,
    "enrich_transactions_salted": enriched_salted,
    "enrich_counts": enrich_counts,
}


def all_queries() -> dict[str, Query]:
    """Report queries plus the file-based ones (landing, sinks, quality)."""
    from salesmart.plans.io_queries import IO_QUERIES
    return {**QUERIES, **IO_QUERIES}
