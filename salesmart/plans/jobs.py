"""The batch jobs: one action per run, state passed through zone folders.

Zones under ``root``::

    landing/      location.csv, product.csv, trans_fact_*   (input)
    staging/      location, product, transactions            (contract tables
                  with one load_id=<id> level per load and a manifest of loads)
    enrichment/   transactions                               (wide sales table)
    reporting/    one CSV folder per report
    archive/      landing/<table>/<load id>/                 (all-string copies)
    _ledger/      <table>, <table>_intents                   (loaded / started)

Every load is rerun-safe and crash-safe: a landing file already in the ledger
is skipped; a load records its intent before writing and its ledger entry
after, and a load found with an intent but no ledger entry is re-run with the
same files and id, after what it had written is deleted. A load's rows are seen
by readers from the moment the table's manifest publishes it (``sources/
commits.py``), which is the last thing it does; a gate may quarantine it
instead. A full enrichment replaces the wide table.
"""

from __future__ import annotations

from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from salesmart.contracts import ENRICHED, LOCATION, PRODUCT, TRANSACTIONS, TableContract
from salesmart.operators import enrich as enr
from salesmart.operators import gates, partials
from salesmart.operators import reports as rep
from salesmart.operators import staging as stg
from salesmart.session import shuffles_freed
from salesmart.sources import commits
from salesmart.sources import landing as ld
from salesmart.sources import sinks
from salesmart.sources.tables import path_exists, read_table

ACTIONS = ("stage-locations", "stage-products", "stage-transactions", "enrich", "reporting")
REPORT_WRITERS = 4  # report CSV jobs in flight at once
LOAD_FILES = 20_000  # landing files of one load, whose paths the driver holds


class Zones:
    def __init__(self, root: str):
        r = root.rstrip("/")
        self.root = r
        self.landing = f"{r}/landing"
        self.location = f"{r}/staging/location"
        self.product = f"{r}/staging/product"
        self.transactions = f"{r}/staging/transactions"
        self.rejects = f"{r}/staging/transactions_rejects"
        self.enriched = f"{r}/enrichment/transactions"
        self.reporting = f"{r}/reporting"
        self.partials = f"{r}/enrichment/partials"
        self.archive = f"{r}/archive/landing"
        self.ledger = f"{r}/_ledger"


class Load(NamedTuple):
    load_id: str
    files: DataFrame        # frozen listing of the files to read
    gone: DataFrame | None  # a recovered load's files that are no longer there
    recovering: bool
    also: tuple[str, ...] = ()  # older unfinished loads that this one replaces


def _loads(spark: SparkSession, z: Zones, glob: str, table: str, whole: bool = False) -> list[Load]:
    """Loads to run now: first any load that recorded its intent but not its
    ledger entry (same files, same id), then one new load over the files the
    ledger does not hold. ``whole``: the table is replaced by each load, so
    one load, unfinished or new, reads the whole listing as soon as any file
    of it is new. Otherwise new files load in batches, each a load of its own."""
    ledger = f"{z.ledger}/{table}"
    listing = ld.freeze(ld.list_files(spark, z.landing, glob))
    loads = [Load(*found, True) for found in ld.unfinished_loads(spark, ledger, listing)]
    new = ld.new_files(listing, ld.read_ledger(spark, ledger))
    if whole and loads:
        return [loads[-1]._replace(files=listing, also=tuple(load.load_id for load in loads[:-1]))]
    for load in loads:
        new = new.join(load.files.select("path"), "path", "left_anti")
    new = ld.freeze(new)
    if whole:
        return [] if new.isEmpty() else [Load(ld.new_load_id(), listing, None, False)]
    # The driver opens the files of one load at a time, so loads are bounded.
    return loads + [Load(ld.new_load_id(), files, None, False) for files in ld.in_batches(new, LOAD_FILES)]


def _open_load(spark: SparkSession, z: Zones, table: str, load: Load, columns
               ) -> tuple[DataFrame | None, DataFrame, dict[str, str]]:
    """Raw rows of a load (None when no file can be read), the files it loads,
    and why each other file with text is refused (never recorded, so it stays
    pending). The intent is recorded before anything is written."""
    layouts, refused = ld.header_layouts(spark, ld.landing_paths(load.files), columns)
    if not layouts:
        return None, load.files, refused
    loaded = ld.without_paths(load.files, refused)
    if not load.recovering:
        ld.record_intent(loaded, f"{z.ledger}/{table}", load.load_id)
    return ld.read_layouts(spark, layouts, columns), loaded, refused


def _undo(spark: SparkSession, z: Zones, contract: TableContract, table_dir: str, load_ids) -> None:
    """Deletes what loads that never became visible had written."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    for load_id in load_ids:
        commits.drop_load(spark, table_dir, load_id, len(contract.partition_by))
        commits.drop_load(spark, f"{table_dir}_rejects", load_id, 0)
        archived = path(f"{z.archive}/{contract.name}/{load_id}")
        archived.getFileSystem(spark._jsc.hadoopConfiguration()).delete(archived, True)


def _close_load(spark: SparkSession, z: Zones, table: str, table_dir: str, load: Load, files: DataFrame, retire: bool,
                state: str = commits.PUBLISHED, reason: str | None = None) -> None:
    """The ledger entry, then the commit. A recovered load's lost files are part
    of the entry, so that it counts as finished. Decisions that show no rows
    come before the entry: what is in the ledger without a decision is published
    by the next run. Then landing files may be retired."""
    done = files if load.gone is None else files.unionByName(load.gone)
    for load_id in load.also:
        commits.decide(spark, table_dir, load_id, commits.ROLLED_BACK, f"replaced by {load.load_id}")
    if state != commits.PUBLISHED:
        commits.decide(spark, table_dir, load.load_id, state, reason)
    for load_id in (*load.also, load.load_id):
        ld.record_loaded(done, f"{z.ledger}/{table}", load_id)
    if state == commits.PUBLISHED:
        commits.decide(spark, table_dir, load.load_id, state)
    if retire and state == commits.PUBLISHED:
        ld.retire(spark, ld.landing_paths(files))


def _started(spark: SparkSession, z: Zones, contract: TableContract, table_dir: str, glob: str) -> list[Load]:
    """The loads to run, with their table's manifest in order and nothing left
    of what unfinished ones had written."""
    commits.begin(spark, table_dir, ld.read_ledger(spark, f"{z.ledger}/{contract.name}"))
    loads = _loads(spark, z, glob, contract.name, whole=contract.mode == "overwrite")
    for load in loads:
        if load.recovering:
            _undo(spark, z, contract, table_dir, (*load.also, load.load_id))
    return loads


def _combine(results: list[dict], refused: dict[str, str], loads: list[Load]) -> dict:
    """One summary over the loads of a run."""
    out: dict = {"files": 0}
    if results:
        out |= {"load_ids": [r["load_id"] for r in results], "load_id": results[-1]["load_id"]}
    for r in results:
        for k, v in r.items():
            if k == "months":
                out["months"] = sorted(set(out.get("months", [])) | set(v))
            elif k == "quarantined":
                out["quarantined"] = out.get("quarantined", {}) | v
            elif isinstance(v, (int, float)):
                out[k] = out.get(k, 0) + v
    gone = [p for load in loads if load.gone is not None for p in ld.landing_paths(load.gone)]
    if results or refused:
        out["unrecognized_files"] = sorted(refused)
        out["refused"] = refused
    if gone:
        out["gone_files"] = gone
    return out


def _stage_dimension(spark: SparkSession, z: Zones, contract: TableContract, glob: str,
                     transform, table_dir: str, retire: bool) -> dict:
    if retire and contract.mode == "overwrite":
        raise ValueError(f"{contract.name} is rebuilt from its landing files; they cannot be retired")
    results, refused_all = [], {}
    loads = _started(spark, z, contract, table_dir, glob)
    for load in loads:
        raw, files, refused = _open_load(spark, z, contract.name, load, contract.names)
        refused_all |= refused
        if raw is None:
            if load.recovering:
                _close_load(spark, z, contract.name, table_dir, load, files.limit(0), False, commits.ROLLED_BACK, "no file left")
            continue
        obs = Observation(f"{contract.name}_{load.load_id}")
        staged = transform(raw)
        new = staged.observe(obs, F.count(F.lit(1)).alias("rows"))
        if contract.mode == "merge":
            new = stg.merge_by_key(commits.snapshot(spark, table_dir, contract), staged, contract.key).unionByName(new)
        sinks.write_table(new, table_dir, contract, load_id=load.load_id)
        sinks.write_text_csv(raw.drop(ld.SOURCE_FILE), f"{z.archive}/{contract.name}/{load.load_id}")
        _close_load(spark, z, contract.name, table_dir, load, files, retire)
        commits.vacuum(spark, table_dir, contract)
        results.append({"load_id": load.load_id, "files": len(ld.landing_paths(files)), **obs.get})
    return _combine(results, refused_all, loads)


def stage_locations(spark: SparkSession, root: str) -> dict:
    """The store table, replaced as a whole: as soon as one landing file is
    new or changed, all of them are read."""
    z = Zones(root)
    return _stage_dimension(spark, z, LOCATION, ld.LOCATION_NAME, stg.stage_locations, z.location, False)


def stage_products(spark: SparkSession, root: str, retire: bool = False) -> dict:
    """New product files, merged into the product table by key: a product that
    is dropped again has its latest attributes only, whatever its department
    was. Rows of one drop that share a key all stay (enrichment refuses them)."""
    z = Zones(root)
    return _stage_dimension(spark, z, PRODUCT, ld.PRODUCT_NAME, stg.stage_products, z.product, retire)


def stage_transactions(spark: SparkSession, root: str, glob: str = ld.TRANSACTION_GLOB,
                       lenient_dates: bool = False, on_bad: str = "reject", retire: bool = False,
                       gate: gates.Gate | None = None) -> dict:
    """New landing transaction files -> staging/transactions (append).

    Each load records its intent (files and load id) first, then writes the
    staging rows under ``load_id=<id>``, the rejects, the archive, its ledger
    entry, and is published last. A run first finishes any load that stopped
    before its ledger entry: what it had written is deleted, and the same files
    as they are now load under the same id, so each file version is loaded once
    after a crash at any point; files lost meanwhile are listed under
    ``gone_files``, and a load without a file left is rolled back.

    ``gate``: a load whose measures are beyond its bounds is quarantined, with
    the reasons, instead of published (``release`` and ``discard`` decide on it
    later); its files count as loaded. A file whose header lacks a column is not loaded and not
    recorded: it stays pending and is listed under ``refused`` with the
    reason. ``retire`` deletes a load's landing files after its ledger entry.
    Rejected rows are counted while the good rows are written; their table is
    only written when there are any (``on_bad='fail'`` raises instead).
    """
    z = Zones(root)
    results, refused_all = [], {}
    loads = _started(spark, z, TRANSACTIONS, z.transactions, glob)
    for load in loads:
        raw, files, refused = _open_load(spark, z, TRANSACTIONS.name, load, ld.LANDING_TRANSACTION_COLUMNS)
        refused_all |= refused
        if raw is None:
            if load.recovering:
                _close_load(spark, z, TRANSACTIONS.name, z.transactions, load, files.limit(0), False, commits.ROLLED_BACK, "no file left")
            continue
        result = _load_transactions(spark, z, raw, load.load_id, lenient_dates, on_bad)
        reasons = gate.reasons(result) if gate else []
        _close_load(spark, z, TRANSACTIONS.name, z.transactions, load, files, retire,
                    commits.QUARANTINED if reasons else commits.PUBLISHED, "; ".join(reasons) or None)
        if reasons:
            result |= {"months": [], "quarantined": {load.load_id: reasons}}
        results.append({"load_id": load.load_id, "files": len(ld.landing_paths(files)), **result})
    return _combine(results, refused_all, loads)


def _months_of(df: DataFrame) -> list[str]:
    rows = df.select("trans_year", "trans_month").distinct().collect()  # years x 12 at most
    return sorted(f"{r['trans_year']:04d}-{r['trans_month']:02d}" for r in rows)


def release(spark: SparkSession, root: str, load_id: str) -> dict:
    """Publishes a quarantined load; reports the months it touches."""
    z = Zones(root)
    _quarantined(spark, z, load_id)
    rows = commits.snapshot(spark, z.transactions, TRANSACTIONS, states=(commits.QUARANTINED,), keep_load=True)
    months = _months_of(rows.where(F.col(sinks.LOAD_COLUMN) == load_id))
    commits.decide(spark, z.transactions, load_id, commits.PUBLISHED, "released")
    return {"load_id": load_id, "months": months}


def discard(spark: SparkSession, root: str, load_id: str) -> dict:
    """Deletes the rows of a quarantined load; its files stay loaded."""
    z = Zones(root)
    _quarantined(spark, z, load_id)
    commits.decide(spark, z.transactions, load_id, commits.ROLLED_BACK, "discarded")
    commits.drop_load(spark, z.transactions, load_id, len(TRANSACTIONS.partition_by))
    return {"load_id": load_id}


def _quarantined(spark: SparkSession, z: Zones, load_id: str) -> None:
    state = commits.state_of(spark, z.transactions, load_id)
    if state != commits.QUARANTINED:
        raise ValueError(f"load {load_id} is {state or 'unknown'}, not quarantined")


def stream_transactions(spark: SparkSession, root: str, **options) -> None:
    """The landing files not loaded yet, by the streaming intake. It shares
    the ledger of stage-transactions, so either may load a file, once."""
    from salesmart.streaming.intake import intake_stream

    z = Zones(root)
    intake_stream(spark, z.landing, z.transactions, f"{z.ledger}/stream_checkpoint",
                  ledger_dir=f"{z.ledger}/{TRANSACTIONS.name}", rejects_dir=z.rejects, **options)


def _load_transactions(spark: SparkSession, z: Zones, raw: DataFrame, load_id: str,
                       lenient_dates: bool, on_bad: str) -> dict:
    clean = stg.clean_transactions(raw, lenient_dates=lenient_dates)
    obs = Observation(f"transactions_{load_id}")
    good = F.col(stg.REJECT_REASON).isNull()
    month = F.col("trans_year") * 12 + F.col("trans_month") - 1
    clean = clean.observe(obs, *gates.measures(),
                          # year-months the load touched (bounded: years x 12),
                          # for an incremental enrich of just those partitions
                          F.sort_array(F.collect_set(F.when(good, month))).alias("months"))
    if on_bad == "fail":
        bad = stg.rejects(raw, lenient_dates).limit(1).count()
        if bad:
            raise ValueError("landing transactions hold rows with an unparseable trans_dt")
    sinks.write_table(stg.accepted(clean), z.transactions, TRANSACTIONS, load_id=load_id)
    metrics = dict(obs.get)
    metrics["months"] = [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in metrics["months"]]
    if metrics.get("rejected"):
        (stg.rejects(raw, lenient_dates).withColumn(sinks.LOAD_COLUMN, F.lit(load_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(sinks.LOAD_COLUMN).parquet(z.rejects))
    sinks.write_text_csv(raw.drop(ld.SOURCE_FILE), f"{z.archive}/transactions/{load_id}")
    return metrics


def _month_filter(months: list[str]):
    """``(year, month) in months`` on the partition columns (prunes folders)."""
    cond = F.lit(False)
    for ym in months:
        year, month = (int(x) for x in ym.split("-"))
        cond = cond | ((F.col("trans_year") == year) & (F.col("trans_month") == month))
    return cond


def _drop_stale_months(spark: SparkSession, path: str, months: list[str], written: set[tuple], above: tuple[str, ...] = ("province",)) -> None:
    """Removes the folders of ``months`` that a rebuild of those months no
    longer has rows for (their rows moved to another partition, or went).
    ``written``: the partitions that have rows, as values of ``above``, year, month."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    base = fs_path(path)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    outer = "".join(f"/{c}=*" for c in above)
    for ym in months:
        year, month = (int(x) for x in ym.split("-"))
        for status in fs.globStatus(fs_path(f"{path}{outer}/trans_year={year}/trans_month={month}")) or []:
            folder, values = status.getPath(), []
            parent = folder.getParent().getParent()
            for _ in above:
                name = parent.getName().partition("=")[2]
                values.insert(0, None if name == "__HIVE_DEFAULT_PARTITION__" else unquote(name))
                parent = parent.getParent()
            if (*values, year, month) not in written:
                fs.delete(folder, True)


def enrich(spark: SparkSession, root: str, mode: str | None = None,
           allow_fanout: bool = False, broadcast_rows: int = enr.DEFAULT_BROADCAST_ROWS,
           row_budget: int = enr.DEFAULT_KEY_ROW_BUDGET,
           months: list[str] | None = None) -> dict:
    """Staging tables -> enrichment/transactions, in one write job or, with many
    sales, in one for each part of the months.

    A full run replaces the whole table, so a sale whose store or product
    became known is found under its new attributes only. ``months``
    (``YYYY-MM``, as reported by stage-transactions) re-enriches only those
    year-months: staging partitions outside them are never read, the months'
    partitions are overwritten, and those that no row falls into any more are
    removed. After a change of a dimension run it in full: other months keep
    the attributes they were enriched with.

    Rows in and out are observed by the write job; a difference means a
    dimension key repeats, which the up-front key check rejects unless
    allowed.
    """
    z = Zones(root)
    mode = mode or ("overwrite" if months is None else "dynamic")
    if (months is not None) != (mode == "dynamic"):
        raise ValueError("a full enrich overwrites the table; mode='dynamic' goes with months=...")
    txn = commits.snapshot(spark, z.transactions, TRANSACTIONS)
    if months is not None:
        txn = txn.where(_month_filter(months))
    prod = commits.snapshot(spark, z.product, PRODUCT)
    loc = commits.snapshot(spark, z.location, LOCATION)
    if not allow_fanout:
        enr.assert_unique_key(prod, "product_key", "products")
        enr.assert_unique_key(loc, "store_location_key", "locations")
    joined = enr.enrichment(txn, prod, loc, broadcast_rows, row_budget)
    metrics, written = Counter(), set()
    n = sinks.slices(txn.count())
    for i in range(n):
        part = txn if n == 1 else txn.where(sinks.slice_of(n) == i)
        out, obs_in, obs_out = enr.observed_enrich(part, joined)
        if months is not None:
            parts = Observation("enrich_partitions")  # provinces x months
            out = out.observe(parts, F.collect_set(F.struct("province", "trans_year", "trans_month")).alias("parts"))
        # Parts are whole months, so each writes partitions of its own.
        sinks.write_table(out, z.enriched, ENRICHED, mode="append" if i and mode == "overwrite" else mode)
        if months is not None:
            written |= {tuple(p) for p in parts.get["parts"]}
        metrics.update({**obs_in.get, **obs_out.get})
    if months is not None:
        _drop_stale_months(spark, z.enriched, months, written)
    metrics = dict(metrics)
    if not allow_fanout and metrics.get("rows_in") != metrics.get("rows_out"):
        raise RuntimeError(f"enrichment changed the row count: {metrics}")
    return metrics


PARTIALS_LOG_SCHEMA = "run_id string, month string, phase string"


def _partials_log(spark: SparkSession, z: Zones) -> DataFrame:
    if not path_exists(spark, f"{z.partials}/log"):
        return spark.createDataFrame([], PARTIALS_LOG_SCHEMA)
    return spark.read.schema(PARTIALS_LOG_SCHEMA).parquet(f"{z.partials}/log")


def refresh_partials(spark: SparkSession, root: str, months: list[str] | None = None) -> dict:
    """Rewrites the monthly partial tables (``operators/partials.py``) for
    ``months`` (default: all months that there are or were). Only the folders of
    those months are scanned and written. Months of a refresh that stopped
    half-way are refreshed again; the first refresh takes all."""
    z = Zones(root)
    sales = read_table(spark, z.enriched, ENRICHED)
    log = _partials_log(spark, z)
    begun, done = (log.where(F.col("phase") == p) for p in ("begun", "done"))
    open_months = [r["month"] for r in begun.join(done, ["run_id", "month"], "left_anti").select("month").distinct().collect()]
    known = [r["month"] for r in done.select("month").distinct().collect()]  # years x 12 at most
    if months is None or not known:
        months = sorted({*_months_of(sales), *known})
    months = sorted({*months, *open_months})
    run_id = ld.new_load_id()

    def note(phase: str) -> None:
        (spark.createDataFrame([(run_id, m, phase) for m in months], PARTIALS_LOG_SCHEMA).coalesce(1)
         .write.mode("append").parquet(f"{z.partials}/log"))

    note("begun")
    touched = sales.where(_month_filter(months))
    n = sinks.slices(touched.count())
    for contract in partials.TABLES:
        path, written = f"{z.partials}/{contract.name}", set()
        for i in range(n):
            seen = Observation(f"{contract.name}_{run_id}_{i}")
            part = touched if n == 1 else touched.where(sinks.slice_of(n) == i)
            rows = partials.partials(part)[contract.name].observe(seen, F.collect_set(F.struct(*partials.MONTH)).alias("parts"))
            sinks.write_table(rows, path, contract)
            written |= {tuple(p) for p in seen.get["parts"]}
        _drop_stale_months(spark, path, months, written, ())
    closing = [(r["run_id"], r["month"]) for r in begun.join(done, ["run_id", "month"], "left_anti").collect()]
    note("done")
    if closing:
        (spark.createDataFrame([(i, m, "done") for i, m in closing], PARTIALS_LOG_SCHEMA).coalesce(1)
         .write.mode("append").parquet(f"{z.partials}/log"))
    return {"months": months}


def _exact_metrics(rows: DataFrame) -> DataFrame:
    """Both metric reports from partial sums (see ``reports.metric_rows``), one
    after the other: what one report's distinct counts have shuffled is gone
    before the other's."""
    by_year, by_loyalty = (rep.metrics_of(rep.with_membership(rows), (key,)).checkpoint(eager=True) for key in rep.METRIC_KEYS)
    return by_year.unionByName(by_loyalty)


def reporting(spark: SparkSession, root: str, top_stores: int = rep.DEFAULT_TOP_STORES,
              top_categories: int = rep.DEFAULT_TOP_CATEGORIES, province: str | None = None,
              year: int | None = None, month: int | None = None,
              preview: bool = False, approx_distinct: float | None = None,
              only: list[str] | None = None, months: list[str] | None = None, sketched: bool = False) -> dict:
    """All nine reports, or those named in ``only``, from two scans of the enriched table.

    The exact distinct counts expand what the second scan was aggregated to,
    kept meanwhile; both bundles are small (bounded by the dimensions) and are
    checkpointed to the shared checkpoint folder, so the nine report writes
    read them instead of re-running the scans. ``province``, ``year`` and
    ``month`` restrict the reports to matching partitions; the filters prune
    partition folders before any file is opened. ``approx_distinct`` (a
    relative standard deviation such as 0.01) opts the two distinct counts
    into HyperLogLog++ sketches; exact counts are the default.

    ``months`` (``YYYY-MM``, as reported by stage-transactions) makes the run
    incremental: partial results are rewritten for those months only, and the
    reports over all months are folded from them (``["all"]`` rewrites all, as
    after a full enrichment). ``sketched`` takes the
    distinct counts from the months' sketches instead of their baskets.
    """
    z = Zones(root)
    names = list(rep.REPORT_FOLDERS) if only is None else list(only)
    unknown = sorted(set(names) - set(rep.REPORT_FOLDERS))
    if unknown:
        raise ValueError(f"unknown reports {unknown}; expected some of {sorted(rep.REPORT_FOLDERS)}")
    filters = (("province", province), ("trans_year", year), ("trans_month", month))
    if sketched and months is None:
        raise ValueError("sketched counts go with months=...")
    if months is not None:
        if any(v is not None for _, v in filters) or approx_distinct is not None:
            raise ValueError("an incremental run reports on all sales; its approximate counts are 'sketched'")
        refresh_partials(spark, root, None if months == ["all"] else months)
        tables = {c.name: read_table(spark, f"{z.partials}/{c.name}", c) for c in partials.TABLES}
        bundle = partials.bundle(tables["store_sums"], tables["product_sums"])
        metrics = partials.sketched_metrics(tables["sketches"]) if sketched else partials.metrics(tables["baskets"])
    else:
        sales = read_table(spark, z.enriched, ENRICHED)
        for column, value in filters:
            if value is not None:
                sales = sales.where(F.col(column) == F.lit(value))
        bundle, metrics = rep.report_bundle(sales), rep.metrics_bundle(sales, approx_distinct)
    # A bundle that no wanted report reads is not computed.
    with shuffles_freed(spark):
        if set(names) & set(rep.ADDITIVE_SETS):
            bundle = bundle.checkpoint(eager=True)
        if set(names) - set(rep.ADDITIVE_SETS):
            if sketched or approx_distinct is not None:
                metrics = metrics.checkpoint(eager=True)
            elif months is not None:
                metrics = _exact_metrics(partials.metric_rows(tables["baskets"]))
            else:
                with sinks.held(rep.metric_rows(sales), "metric-rows") as rows:
                    metrics = _exact_metrics(rows)
    reports = {k: v for k, v in rep.split_bundle(bundle, metrics, top_stores, top_categories).items() if k in names}

    def write(item):
        name, df = item
        sinks.write_csv(df, f"{z.reporting}/{rep.REPORT_FOLDERS[name]}", rep.report_order(name))

    # Small independent jobs over the checkpointed bundles: submitted
    # together so they share the cluster instead of queueing one by one.
    with ThreadPoolExecutor(max_workers=REPORT_WRITERS) as pool:
        for done in [pool.submit(write, item) for item in reports.items()]:
            done.result()
    if preview:  # console view of the three headline reports
        for name in ("sales_by_province", "sales_by_store", "sales_by_category"):
            if name in reports:
                reports[name].orderBy(*rep.report_order(name)).show(rep.PREVIEW_ROWS, truncate=False)
    return {"reports": sorted(reports)}


def run(spark: SparkSession, root: str, action: str, **options) -> dict:
    """Run one pipeline action; an unknown action raises ``ValueError``."""
    handlers = {
        "stage-locations": stage_locations,
        "stage-products": stage_products,
        "stage-transactions": stage_transactions,
        "enrich": enrich,
        "reporting": reporting,
    }
    if action not in handlers:
        raise ValueError(f"unknown action {action!r}; expected one of {ACTIONS}")
    return handlers[action](spark, root, **options)


def main(argv: list[str] | None = None) -> None:
    import argparse
    import json

    from salesmart.session import get_session

    p = argparse.ArgumentParser(description="Run one action of the sales pipeline.")
    p.add_argument("root", help="folder holding the zones (landing/, staging/, ...)")
    p.add_argument("action", choices=ACTIONS)
    p.add_argument("--province", help="reporting: only this province")
    p.add_argument("--year", type=int, help="reporting: only this year")
    p.add_argument("--month", type=int, help="reporting: only this month")
    p.add_argument("--approx-distinct", type=float,
                   help="reporting: approximate distinct counts with this relative error")
    p.add_argument("--months", help="enrich: only these year-months, e.g. 2015-10,2015-11; reporting: "
                                    "fold the reports from partial results rewritten for these months")
    p.add_argument("--only", help="reporting: only these reports, e.g. sales_by_store,metrics_by_year")
    p.add_argument("--sketched", action="store_true", help="reporting --months: distinct counts from the months' sketches")
    p.add_argument("--lenient-dates", action="store_true",
                   help="stage-transactions: roll impossible dates over instead of rejecting")
    p.add_argument("--on-bad", choices=("reject", "fail"),
                   help="stage-transactions: reject bad rows (default) or fail the load")
    p.add_argument("--gate", help="stage-transactions: bounds of a published load, e.g. rejected=0.05,min_rows=1")
    p.add_argument("--release", help="stage-transactions: publish this quarantined load instead of loading")
    p.add_argument("--discard", help="stage-transactions: delete this quarantined load instead of loading")
    p.add_argument("--retire", action="store_true",
                   help="stage-products/-transactions: delete landing files once recorded as loaded")
    p.add_argument("--allow-fanout", action="store_true",
                   help="enrich: accept repeated dimension keys")
    p.add_argument("--broadcast-rows", type=int, help="enrich: largest dimension to broadcast")
    p.add_argument("--row-budget", type=int, help="enrich: rows of one key per join task")
    p.add_argument("--preview", action="store_true", help="reporting: print three reports")
    p.add_argument("--shuffle-partitions", type=int,
                   help="initial shuffle partitions (2-3 per cluster core); AQE coalesces")
    args = p.parse_args(argv)
    allowed = {
        "reporting": ("province", "year", "month", "approx_distinct", "preview", "only", "months", "sketched"),
        "enrich": ("months", "allow_fanout", "broadcast_rows", "row_budget"),
        "stage-transactions": ("lenient_dates", "on_bad", "retire", "gate", "release", "discard"),
        "stage-products": ("retire",),
    }
    given = {k: v for k, v in vars(args).items()
             if k not in ("root", "action", "shuffle_partitions") and v is not None and v is not False}
    other = sorted(set(given) - set(allowed.get(args.action, ())))
    if other:
        p.error(f"{args.action} does not take " + ", ".join("--" + k.replace("_", "-") for k in other))
    options = dict(given)
    for name in ("months", "only"):
        if name in options:
            options[name] = [m.strip() for m in options[name].split(",") if m.strip()]
    if "gate" in options:
        options["gate"] = gates.parse(args.gate)
    spark = get_session(shuffle_partitions=args.shuffle_partitions)
    for decide in (release, discard):
        if decide.__name__ in options:
            print(json.dumps(decide(spark, args.root, options[decide.__name__]), default=str))
            return
    print(json.dumps(run(spark, args.root, args.action, **options), default=str))


if __name__ == "__main__":
    main()
