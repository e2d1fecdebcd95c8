"""Registered queries that go through files: landing, staging, sinks, ledger.

Each query renders landing text or tables from the test tables into a fresh
folder under the shared checkpoint folder, runs the load, and returns the
loaded result read back from storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesmart.contracts import ENRICHED, LOCATION, PRODUCT, TRANSACTIONS
from salesmart.functions.keys import (canonical_key, is_member, normalize_trans_key as ntk,
                                      parse_trans_dt)
from salesmart.operators import gates, partials
from salesmart.operators import quality as dq
from salesmart.operators import reports as rep
from salesmart.operators import staging as stg
from salesmart.plans import adapter, fixtures
from salesmart.plans.registry import enriched, write_enriched
from salesmart.session import scratch_path
from salesmart.sources import commits
from salesmart.sources import landing as ld
from salesmart.sources import sinks
from salesmart.sources.tables import read_table


def _landing(spark: SparkSession, sf_dir: str, layouts=None) -> str:
    root = scratch_path(spark, "landing")
    fixtures.write_landing(spark, sf_dir, root, layouts)
    return root


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _landing(spark, sf_dir)
    return ld.read_transactions(spark, ld.landing_paths(ld.list_files(spark, root)))


def clean_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four landing layouts -> one typed transaction frame."""
    return stg.accepted(stg.clean_transactions(raw_transactions(spark, sf_dir)))


def union_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per landing file: lines and non-empty values after the by-name union."""
    raw = raw_transactions(spark, sf_dir)
    return raw.groupBy(ld.LANDING_NAME).agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count(c).alias(f"{c}_values") for c in
          ("collector_key", "trans_dt", "store_location_key", "product_key", "sales",
           "units", "trans_key")])


def normalize_trans_dt(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_transactions(spark, sf_dir)
    return raw.select(ld.LANDING_NAME, F.col("trans_dt").alias("trans_dt_text"),
                      parse_trans_dt("trans_dt").alias("trans_dt")).distinct()


def normalize_trans_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_transactions(spark, sf_dir)
    return raw.select(ld.LANDING_NAME, F.col("trans_key").alias("trans_key_text"),
                      ntk("trans_key").alias("trans_key"))


def canonical_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_transactions(spark, sf_dir)
    return raw.select(ld.LANDING_NAME,
                      F.col("product_key").alias("product_key_text"),
                      canonical_key("product_key").alias("product_key"),
                      F.col("store_location_key").alias("store_location_key_text"),
                      canonical_key("store_location_key").alias("store_location_key"))


def fill_missing_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stg.measure_audit(stg.clean_transactions(raw_transactions(spark, sf_dir)))


def membership_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = stg.accepted(stg.clean_transactions(raw_transactions(spark, sf_dir)))
    return clean.groupBy(is_member("collector_key").alias("is_member")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("collector_key").alias("rows_with_collector"),
        F.countDistinct("collector_key").alias("distinct_collectors"))


def stage_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """location.csv (shuffled columns, padded keys) -> staging/location."""
    from salesmart.plans import jobs
    root = scratch_path(spark, "zones")
    fixtures.write_location_landing(spark, sf_dir, f"{root}/landing")
    jobs.run(spark, root, "stage-locations")
    return read_table(spark, jobs.Zones(root).location, LOCATION)


def stage_locations_partial_redrop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One of location.csv's part files is dropped again: the table still has
    every store."""
    from salesmart.plans import jobs
    root = scratch_path(spark, "zones")
    for part in (0, 1):
        fixtures.write_location_landing(spark, sf_dir, f"{root}/landing", part=part)
    jobs.run(spark, root, "stage-locations")
    fixtures.write_location_landing(spark, sf_dir, f"{root}/landing", part=1)
    jobs.run(spark, root, "stage-locations")
    return commits.snapshot(spark, jobs.Zones(root).location, LOCATION)


def stage_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """product.csv (shuffled columns, padded keys) -> staging/product."""
    from salesmart.plans import jobs
    root = scratch_path(spark, "zones")
    fixtures.write_product_landing(spark, sf_dir, f"{root}/landing")
    jobs.run(spark, root, "stage-products")
    return read_table(spark, jobs.Zones(root).product, PRODUCT)


def header_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files whose headers are spelled in upper and mixed case load
    like the others; one without a sales column stays pending."""
    from salesmart.plans import jobs
    root = scratch_path(spark, "zones")
    landing = jobs.Zones(root).landing
    fixtures.write_landing(spark, sf_dir, landing, ("trans_fact_5", "trans_fact_4"), spell=str.upper)
    fixtures.write_landing(spark, sf_dir, landing, ("trans_fact_6", "trans_fact_8"), spell=str.title)
    spark.createDataFrame([("1", "1/2/2016")], "trans_key string, trans_dt string").write.option(
        "header", True).csv(f"{landing}/trans_fact_9")
    jobs.run(spark, root, "stage-transactions")
    return read_table(spark, jobs.Zones(root).transactions, TRANSACTIONS)


def recovered_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that stopped before its ledger entry, whose files were dropped
    again meanwhile: the next two runs hold every line once."""
    from salesmart.plans import jobs
    root = scratch_path(spark, "zones")
    z = jobs.Zones(root)
    fixtures.write_landing(spark, sf_dir, z.landing, ("trans_fact_5", "trans_fact_4"))
    files = ld.freeze(ld.list_files(spark, z.landing))
    load_id = ld.new_load_id()
    ledger = f"{z.ledger}/{TRANSACTIONS.name}"
    ld.record_intent(files, ledger, load_id)
    raw = ld.read_transactions(spark, ld.landing_paths(files))
    sinks.write_table(stg.accepted(stg.clean_transactions(raw)), z.transactions, TRANSACTIONS, load_id=load_id)
    fixtures.write_landing(spark, sf_dir, z.landing)
    jobs.run(spark, root, "stage-transactions")
    jobs.run(spark, root, "stage-transactions")
    return commits.snapshot(spark, z.transactions, TRANSACTIONS)


def product_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping product drops; the second moves its products to another
    department and renames them: one row per product, its latest version."""
    from salesmart.plans import jobs
    root = scratch_path(spark, "zones")
    landing, key = f"{root}/landing", F.col("product_key").cast("int")

    def moved(products: DataFrame) -> DataFrame:
        return products.where(key % 3 == 0).withColumns({
            "department": F.concat(F.lit("NEW "), "department"), "item_name": F.upper("item_name")})

    fixtures.write_product_landing(spark, sf_dir, landing, lambda p: p.where(key % 5 != 4), drop=1)
    jobs.run(spark, root, "stage-products")
    fixtures.write_product_landing(spark, sf_dir, landing, moved, drop=2)
    jobs.run(spark, root, "stage-products")
    return commits.snapshot(spark, jobs.Zones(root).product, PRODUCT)


def gated_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One load per landing layout behind a gate on missing measures: what was
    published or quarantined, why, and the rows that readers see."""
    from salesmart.plans import jobs
    root = scratch_path(spark, "zones")
    z = jobs.Zones(root)
    for layout in fixtures.LAYOUTS:
        fixtures.write_landing(spark, sf_dir, z.landing, (layout,))
        jobs.run(spark, root, "stage-transactions", gate=gates.Gate(rejected=0.0, sales_filled=0.5, units_filled=0.5))
    names = ld.read_ledger(spark, f"{z.ledger}/{TRANSACTIONS.name}").select(
        sinks.LOAD_COLUMN, ld.landing_name(F.col("path")).alias(ld.LANDING_NAME)).distinct()
    every = (commits.PUBLISHED, commits.QUARANTINED)
    staged = commits.snapshot(spark, z.transactions, TRANSACTIONS, states=every, keep_load=True)
    staged = staged.groupBy(sinks.LOAD_COLUMN).agg(F.count("*").alias("staged_rows"))
    seen = commits.snapshot(spark, z.transactions, TRANSACTIONS, keep_load=True)
    seen = seen.groupBy(sinks.LOAD_COLUMN).agg(F.count("*").alias("seen_rows"))
    loads = commits.manifest(spark, z.transactions).join(names, sinks.LOAD_COLUMN).join(staged, sinks.LOAD_COLUMN)
    return loads.join(seen, sinks.LOAD_COLUMN, "left").select(
        ld.LANDING_NAME, "state", "reason", "staged_rows", F.coalesce("seen_rows", F.lit(0).cast("bigint")).alias("seen_rows"))


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing lines whose date cannot be, as the rejects table has them: their
    text, the reason and the landing file they came from."""
    from salesmart.plans import jobs
    root = scratch_path(spark, "zones")
    z = jobs.Zones(root)
    fixtures.write_landing(spark, sf_dir, z.landing, spoiled=True)
    jobs.run(spark, root, "stage-transactions")
    return spark.read.parquet(z.rejects).select(
        *ld.LANDING_TRANSACTION_COLUMNS, stg.REJECT_REASON, ld.landing_name(F.col(ld.SOURCE_FILE)).alias(ld.LANDING_NAME))


def lenient_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines under a lenient calendar: months and days past their ends
    roll over; only impossible ISO dates are still rejected."""
    from salesmart.plans import jobs
    root = scratch_path(spark, "zones")
    z = jobs.Zones(root)
    fixtures.write_landing(spark, sf_dir, z.landing, spoiled=True)
    jobs.run(spark, root, "stage-transactions", lenient_dates=True)
    return commits.snapshot(spark, z.transactions, TRANSACTIONS)


def distinct_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct transactions and collectors by year and by loyalty, exact and
    from one table of monthly sketches: whether each estimate is within three
    standard errors."""
    sales = enriched(spark, sf_dir)
    path = scratch_path(spark, "sketches")
    sinks.write_table(partials.partials(sales)["sketches"], path, partials.SKETCHES)
    sketches = read_table(spark, path, partials.SKETCHES)
    out = None
    for key in ("trans_year", "is_member"):
        near = partials.sketched_counts(sketches, key).withColumnsRenamed(
            {"count_distinct_trans_key": "near_trans", "count_distinct_collector_key": "near_collectors"})
        rows = rep.metrics_by(sales, key).join(near, key)
        fits = [(F.abs(F.col(n) - F.col(c)) <= 3 * partials.SKETCH_ERROR * F.col(c)).alias(a) for n, c, a in (
            ("near_trans", "count_distinct_trans_key", "trans_within"),
            ("near_collectors", "count_distinct_collector_key", "collectors_within"))]
        part = rows.select(F.lit(key).alias("grouping"), F.col(key).cast("string").alias("value"),
                           "count_distinct_trans_key", "count_distinct_collector_key", *fits)
        out = part if out is None else out.unionByName(part)
    return out


def enrich_after_dimension_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched with half of the stores, then with all, in full and again for
    its months: every sale is there once, under its present attributes."""
    from salesmart.plans import jobs
    root = scratch_path(spark, "zones")
    z = jobs.Zones(root)
    fixtures.write_product_landing(spark, sf_dir, z.landing)
    fixtures.write_landing(spark, sf_dir, z.landing, ("trans_fact_5",))
    fixtures.write_location_landing(spark, sf_dir, z.landing, part=0)
    for action in ("stage-locations", "stage-products"):
        jobs.run(spark, root, action)
    months = jobs.run(spark, root, "stage-transactions")["months"]
    jobs.run(spark, root, "enrich")
    fixtures.write_location_landing(spark, sf_dir, z.landing, part=1)
    jobs.run(spark, root, "stage-locations")
    half = len(months) // 2
    jobs.run(spark, root, "enrich", months=months[:half])
    jobs.run(spark, root, "enrich", months=months[half:])
    by_months = read_table(spark, z.enriched, ENRICHED).groupBy("province").agg(F.count("*").alias("by_months"))
    by_months = by_months.checkpoint(eager=True)
    jobs.run(spark, root, "enrich")
    full = read_table(spark, z.enriched, ENRICHED).groupBy("province").agg(F.count("*").alias("row_count"))
    return full.join(by_months, full.province.eqNullSafe(by_months.province), "full").select(full.province, "row_count", "by_months")


def _positions(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """A report's rows with their place in its published order."""
        report = rep.REPORTS[name](enriched(spark, sf_dir))
        place = F.row_number().over(Window.orderBy(*rep.report_order(name)))
        return report.withColumn("position", place)
    run.__name__ = f"{name}_ordered"
    return run


def empty_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files of which one has only a header and one not a byte: the
    rows of the others."""
    from salesmart.plans import jobs
    root = scratch_path(spark, "zones")
    z = jobs.Zones(root)
    fixtures.write_landing(spark, sf_dir, z.landing, ("trans_fact_5", "trans_fact_4"))
    fixtures.write_landing(spark, sf_dir, z.landing, ("trans_fact_6",), where=F.lit(False))
    spark.createDataFrame([], "value string").coalesce(1).write.text(f"{z.landing}/trans_fact_8")
    jobs.run(spark, root, "stage-transactions")
    return commits.snapshot(spark, z.transactions, TRANSACTIONS)


def schema_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written enriched table, column by column: its place, the type that
    the files themselves hold (partition columns: the contract's, folders have
    none) and how many values it has."""
    path = scratch_path(spark, "enrichment") + "/transactions"
    write_enriched(spark, sf_dir, path)
    files = dict(spark.read.parquet(path).dtypes)
    types = {f.name: f.dataType.simpleString() if f.name in ENRICHED.partition_by else files[f.name] for f in ENRICHED.schema}
    counts = read_table(spark, path, ENRICHED).agg(*[F.count(c).alias(c) for c in ENRICHED.names])
    known = F.create_map(*[x for i, (c, t) in enumerate(types.items()) for x in (F.lit(c), F.struct(F.lit(i).alias("place"), F.lit(t).alias("type")))])
    return counts.unpivot([], ENRICHED.names, "column_name", "value_count").select(
        known[F.col("column_name")]["place"].alias("place"), "column_name",
        known[F.col("column_name")]["type"].alias("column_type"), "value_count")


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales by category written as a one-file CSV report and read back."""
    path = scratch_path(spark, "report") + "/salesByCategory"
    sinks.write_csv(rep.sales_by_category(enriched(spark, sf_dir)), path,
                    rep.report_order("sales_by_category"))
    back = ld.spark_read_strings(spark, path, ["category", "total_sales"])
    return back.select("category", F.col("total_sales").cast("decimal(28,3)").alias("total_sales"))


def partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched table written by province/year/month and read back."""
    path = scratch_path(spark, "enrichment") + "/transactions"
    write_enriched(spark, sf_dir, path)
    return read_table(spark, path, ENRICHED)


def append_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load transactions by append, then rerun the same load as a dynamic
    partition overwrite: the table holds every row once."""
    path = scratch_path(spark, "staging") + "/transactions"
    txn = adapter.transactions(spark, sf_dir)
    sinks.write_table(txn, path, TRANSACTIONS, mode="append")
    sinks.write_table(txn, path, TRANSACTIONS, mode="dynamic")
    return read_table(spark, path, TRANSACTIONS)


def archive_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing text archived as all-string CSV under a load id, read back."""
    raw = raw_transactions(spark, sf_dir).drop(ld.SOURCE_FILE)
    path = f"{scratch_path(spark, 'archive')}/landing/transactions/{ld.new_load_id()}"
    sinks.write_text_csv(raw, path)
    return ld.spark_read_strings(spark, path, raw.columns)


def landing_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger: after a first intake, a second one picks up only the new file."""
    root = _landing(spark, sf_dir, ("trans_fact_5", "trans_fact_4", "trans_fact_6"))
    ledger = scratch_path(spark, "ledger")
    first = ld.freeze(ld.new_files(ld.list_files(spark, root), ld.read_ledger(spark, ledger)))
    ld.record_loaded(first, ledger, ld.new_load_id())
    fixtures.write_landing(spark, sf_dir, root, ("trans_fact_8",))
    second = ld.freeze(ld.new_files(ld.list_files(spark, root), ld.read_ledger(spark, ledger)))
    raw = ld.read_transactions(spark, ld.landing_paths(second))
    return stg.accepted(stg.clean_transactions(raw))


def intake_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed intake run twice around a new landing file, then once more
    with nothing new: the staging table holds every line exactly once."""
    from salesmart.streaming.intake import intake_stream as run_intake
    root = _landing(spark, sf_dir, ("trans_fact_5", "trans_fact_4", "trans_fact_6"))
    zone = scratch_path(spark, "stream")
    table, checkpoint = f"{zone}/staging/transactions", f"{zone}/_checkpoint"
    run_intake(spark, root, table, checkpoint)
    fixtures.write_landing(spark, sf_dir, root, ("trans_fact_8",))
    run_intake(spark, root, table, checkpoint)
    run_intake(spark, root, table, checkpoint)
    return read_table(spark, table, TRANSACTIONS)


def _zone_with_landing(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_path(spark, "zones")
    fixtures.write_landing(spark, sf_dir, f"{root}/landing")
    fixtures.write_location_landing(spark, sf_dir, f"{root}/landing")
    fixtures.write_product_landing(spark, sf_dir, f"{root}/landing")
    return root


def stage_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stage-transactions job end to end (listing, ledger, layouts,
    clean-up, append, archive), run twice: the rerun finds no new file."""
    from salesmart.plans import jobs
    root = scratch_path(spark, "zones")
    fixtures.write_landing(spark, sf_dir, jobs.Zones(root).landing)
    jobs.run(spark, root, "stage-transactions")
    jobs.run(spark, root, "stage-transactions")
    return read_table(spark, jobs.Zones(root).transactions, TRANSACTIONS)


# Long form of the nine CSV reports: one row per report line.
REPORT_LINE_TYPES = {
    "province": "string", "store_num": "string", "department": "string",
    "category": "string", "is_member": "string", "trans_year": "int", "report_rank": "int",
    "total_sales": "decimal(28,3)", "avg_store_total_sales_in_province": "decimal(28,3)",
    "total_units": "bigint", "count_distinct_trans_key": "bigint",
    "count_distinct_collector_key": "bigint",
}
RANK_COLUMNS = (rep.STORE_RANK, rep.CATEGORY_RANK)


def report_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five jobs from landing files, then the nine CSV
    reports read back into one long frame (``report`` names the source)."""
    from salesmart.plans import jobs
    root = _zone_with_landing(spark, sf_dir)
    for action in jobs.ACTIONS:
        jobs.run(spark, root, action)
    return _report_lines(spark, jobs.Zones(root).reporting)


def report_run_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same reports, folded from monthly partial results after new files:
    first all sales but those of one quarter, then that quarter's, for whose
    months alone sales are enriched and partial results rewritten."""
    from salesmart.plans import jobs
    root = scratch_path(spark, "zones")
    z = jobs.Zones(root)
    fixtures.write_location_landing(spark, sf_dir, z.landing)
    fixtures.write_product_landing(spark, sf_dir, z.landing)
    late = F.trunc(F.col("l_shipdate").cast("date"), "quarter") == F.lit(LATE_QUARTER).cast("date")
    fixtures.write_landing(spark, sf_dir, z.landing, where=~late)
    for action in jobs.ACTIONS[:4]:
        jobs.run(spark, root, action)
    jobs.run(spark, root, "reporting", months=["all"])
    fixtures.write_landing(spark, sf_dir, z.landing, where=late, suffix="_late")
    months = jobs.run(spark, root, "stage-transactions")["months"]
    jobs.run(spark, root, "enrich", months=months)
    jobs.run(spark, root, "reporting", months=months)
    return _report_lines(spark, z.reporting)


# First day of the quarter whose sales come late.
LATE_QUARTER = "1995-04-01"


def _report_lines(spark: SparkSession, reporting: str) -> DataFrame:
    out = None
    for name, columns in rep.REPORT_COLUMNS.items():
        csv = ld.spark_read_strings(spark, f"{reporting}/{rep.REPORT_FOLDERS[name]}", columns)
        cols = [F.lit(name).alias("report")]
        for target, kind in REPORT_LINE_TYPES.items():
            source = next((c for c in columns if c in RANK_COLUMNS), None) \
                if target == "report_rank" else (target if target in columns else None)
            value = F.col(source) if source else F.lit(None)
            cols.append(value.cast(kind).alias(target))
        part = csv.select(*cols)
        out = part if out is None else out.unionByName(part)
    return out


# --------------------------------------------------------------- quality

def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.null_profile(enriched(spark, sf_dir))


def null_profile_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = stg.clean_transactions(raw_transactions(spark, sf_dir))
    return dq.null_profile_by(clean.select(ld.LANDING_NAME, *TRANSACTIONS.names),
                              ld.LANDING_NAME)


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    txn, prod, loc = adapter.staging_frames(spark, sf_dir)
    checks = [dq.duplicate_keys(prod, "product_key", "product"),
              dq.duplicate_keys(prod, "upc", "product"),
              dq.duplicate_keys(prod, "category", "product"),
              dq.duplicate_keys(loc, "store_num", "location"),
              dq.duplicate_keys(loc, "store_location_key", "location"),
              dq.duplicate_keys(txn, "trans_key", "transactions")]
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.date_range(adapter.transactions(spark, sf_dir))


def daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.daily_counts(adapter.transactions(spark, sf_dir))


def group_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.group_counts(enriched(spark, sf_dir), "province")


def key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every enriched sale of one product: the equality reaches the scans of
    sales and products before they are joined."""
    return dq.key_lookup(enriched(spark, sf_dir), "product_key", LOOKUP_KEY)


def staged_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged lines of one product and of one transaction: row groups whose
    bloom filters rule the key out stay unread."""
    from salesmart.plans import jobs
    root = scratch_path(spark, "zones")
    z = jobs.Zones(root)
    fixtures.write_landing(spark, sf_dir, z.landing)
    jobs.run(spark, root, "stage-transactions")
    staged = commits.snapshot(spark, z.transactions, TRANSACTIONS)
    return dq.key_lookup(staged, "product_key", LOOKUP_KEY).unionByName(dq.key_lookup(staged, "trans_key", LOOKUP_KEY))


# Fixed key of the lookups (a product and an order at every scale factor).
LOOKUP_KEY = "7"

IO_QUERIES = {
    "clean_transactions": clean_transactions,
    "union_layouts": union_layouts,
    "normalize_trans_dt": normalize_trans_dt,
    "normalize_trans_key": normalize_trans_key,
    "canonical_keys": canonical_keys,
    "fill_missing_measures": fill_missing_measures,
    "membership_flag": membership_flag,
    "stage_locations": stage_locations,
    "stage_products": stage_products,
    "stage_locations_partial_redrop": stage_locations_partial_redrop,
    "header_variants": header_variants,
    "recovered_load": recovered_load,
    "product_versions": product_versions,
    "gated_loads": gated_loads,
    "rejected_rows": rejected_rows,
    "lenient_dates": lenient_dates,
    "distinct_sketches": distinct_sketches,
    "report_run_incremental": report_run_incremental,
    "enrich_after_dimension_change": enrich_after_dimension_change,
    **{f"{n}_ordered": _positions(n) for n in ("sales_by_store", "sales_by_category", "sales_by_loyalty_province", "sales_by_loyalty")},
    "empty_landing": empty_landing,
    "schema_contract": schema_contract,
    "csv_roundtrip": csv_roundtrip,
    "partitioned_roundtrip": partitioned_roundtrip,
    "append_load": append_load,
    "archive_roundtrip": archive_roundtrip,
    "landing_new_files": landing_new_files,
    "intake_stream": intake_stream,
    "stage_transactions": stage_transactions,
    "report_run": report_run,
    "null_profile": null_profile,
    "null_profile_by_file": null_profile_by_file,
    "duplicate_keys": duplicate_keys,
    "date_range": date_range,
    "daily_counts": daily_counts,
    "group_counts": group_counts,
    "key_lookup": key_lookup,
    "staged_lookup": staged_lookup,
}
