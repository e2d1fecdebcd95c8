"""Enrichment: transactions left-joined with products and store locations.

All joins are left joins so no sale is lost; unmatched sales carry NULL
product or location attributes (and later form the NULL report groups).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from salesmart.contracts import ENRICHED
from salesmart.operators.joins import (DEFAULT_BROADCAST_ROWS, DEFAULT_KEY_ROW_BUDGET,
                                       assert_unique_key, dimensions_join)

HAS_PRODUCT = "_has_product"
HAS_LOCATION = "_has_location"


def enrich_flagged(txn: DataFrame, prod: DataFrame, loc: DataFrame,
                   broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                   row_budget: int = DEFAULT_KEY_ROW_BUDGET,
                   counted: DataFrame | None = None) -> DataFrame:
    """Enriched rows plus two match flags (``_has_product``, ``_has_location``).

    Each dimension is broadcast only when a bounded count proves it small.
    Otherwise the join shuffles on (key, salt), where keys with more than
    ``row_budget`` sales are split over several salts — a dominant product
    key (or the NULL key of unmatched sales) never lands in one task.
    ``counted`` has the sales' two keys at a lower cost than ``txn``, for
    finding the keys to split.
    """
    return enrichment(txn, prod, loc, broadcast_rows, row_budget, counted)(txn)


def enrichment(txn: DataFrame, prod: DataFrame, loc: DataFrame,
               broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
               row_budget: int = DEFAULT_KEY_ROW_BUDGET,
               counted: DataFrame | None = None) -> Callable[[DataFrame], DataFrame]:
    """``enrich_flagged`` for several parts of the sales, its joins decided
    once, on all of ``txn``."""
    prod = prod.withColumn(HAS_PRODUCT, F.lit(True))
    loc = loc.withColumn(HAS_LOCATION, F.lit(True))
    joined = dimensions_join(txn, [(prod, "product_key"), (loc, "store_location_key")],
                             "left", broadcast_rows, row_budget, counted)
    return lambda part: joined(part).select(*ENRICHED.columns(),
                                            F.coalesce(F.col(HAS_PRODUCT), F.lit(False)).alias(HAS_PRODUCT),
                                            F.coalesce(F.col(HAS_LOCATION), F.lit(False)).alias(HAS_LOCATION))


def enrich(txn: DataFrame, prod: DataFrame, loc: DataFrame,
           broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
           allow_fanout: bool = True,
           row_budget: int = DEFAULT_KEY_ROW_BUDGET,
           counted: DataFrame | None = None) -> DataFrame:
    """The wide sales table in contract order (21 columns).

    With ``allow_fanout=False`` the dimension keys are checked for
    duplicates first (one aggregate over each dimension), because a repeated
    key would multiply sales.
    """
    if not allow_fanout:
        assert_unique_key(prod, "product_key", "products")
        assert_unique_key(loc, "store_location_key", "locations")
    return ENRICHED.conform(enrich_flagged(txn, prod, loc, broadcast_rows, row_budget, counted))


def enrich_counts(txn: DataFrame, prod: DataFrame, loc: DataFrame,
                  broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                  counted: DataFrame | None = None) -> DataFrame:
    """Row counts before and after enrichment, one row per measure.

    Replaces repeated ``count()`` actions: one aggregate per input, of which
    the enriched one's three counts are unpivoted from a single pass.
    """
    flagged = enrich_flagged(txn, prod, loc, broadcast_rows, counted=counted)
    out = flagged.agg(
        F.count(F.lit(1)).alias("enriched"),
        F.count_if(F.col(HAS_PRODUCT)).alias("enriched_with_product"),
        F.count_if(F.col(HAS_LOCATION)).alias("enriched_with_location"),
    )
    measures = [("transactions", txn.agg(F.count(F.lit(1)).alias("n"))),
                ("products", prod.agg(F.count(F.lit(1)).alias("n"))),
                ("locations", loc.agg(F.count(F.lit(1)).alias("n")))]
    frames = [df.select(F.lit(name).alias("measure"), F.col("n").alias("row_count"))
              for name, df in measures]
    frames.append(out.unpivot([], out.columns, "measure", "row_count"))
    result = frames[0]
    for f in frames[1:]:
        result = result.unionByName(f)
    return result


def observed_enrich(txn: DataFrame, joined: Callable[[DataFrame], DataFrame]
                    ) -> tuple[DataFrame, Observation, Observation]:
    """Sales enriched by ``joined`` (see ``enrichment``), with two observations
    filled by the job that writes them.

    ``rows_in`` counts transactions as they are scanned, ``rows_out`` counts
    written rows and the matched ones — no extra pass over the data.
    """
    obs_in = Observation("enrich_in")
    obs_out = Observation("enrich_out")
    txn = txn.observe(obs_in, F.count(F.lit(1)).alias("rows_in"))
    flagged = joined(txn).observe(
        obs_out,
        F.count(F.lit(1)).alias("rows_out"),
        F.count_if(F.col(HAS_PRODUCT)).alias("rows_with_product"),
        F.count_if(F.col(HAS_LOCATION)).alias("rows_with_location"))
    return ENRICHED.conform(flagged), obs_in, obs_out
