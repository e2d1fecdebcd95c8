"""Manifest of a staging table's loads: what readers may see.

Every load of a staging table writes its rows under ``load_id=<id>`` folders.
The manifest, a small table in ``<table>/_commits`` (a folder Spark's readers
skip), says what became of each: ``published``, ``quarantined`` (the rows are
there, but failed the load's gate) or ``rolled_back`` (the rows are gone). One
append of one row is the commit, so a reader that joins the manifest sees all of
a load or nothing of it, whatever a running or crashed load has in the
folders. ``seq`` counts the decisions; the latest one on a load holds, and
``as_of`` reads the table as it was after an earlier decision.

Tables that a load replaces as a whole (``overwrite``) or rewrites with its
changes merged in (``merge``) show their latest published load; appended tables
show all published ones. One writer per table at a time is assumed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.contracts import TableContract
from salesmart.sources.sinks import LOAD_COLUMN
from salesmart.sources.tables import path_exists

PUBLISHED, QUARANTINED, ROLLED_BACK = "published", "quarantined", "rolled_back"
MANIFEST_SCHEMA = "load_id string, seq bigint, state string, reason string"
#: Contract modes whose latest published load is the whole table.
WHOLE_MODES = ("overwrite", "merge")
#: Published loads of such a table whose folders stay: the present one, and the
#: one before for readers that began earlier.
KEPT_LOADS = 2


def _log(table_dir: str) -> str:
    return f"{table_dir.rstrip('/')}/_commits/log"


def _append(spark: SparkSession, table_dir: str, rows: list[tuple]) -> None:
    (spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1)
     .write.mode("append").parquet(_log(table_dir)))


def _read(spark: SparkSession, table_dir: str) -> DataFrame | None:
    if not path_exists(spark, _log(table_dir)):  # no load ever began
        return None
    return spark.read.schema(MANIFEST_SCHEMA).parquet(_log(table_dir))


def manifest(spark: SparkSession, table_dir: str, as_of: int | None = None) -> DataFrame | None:
    """``load_id, seq, state, reason``: the decision that holds on each load,
    at present or after decision ``as_of``; None without a manifest."""
    log = _read(spark, table_dir)
    if log is None:
        return None
    if as_of is not None:
        log = log.where(F.col("seq") <= as_of)
    latest = log.groupBy(LOAD_COLUMN).agg(F.max_by(F.struct("seq", "state", "reason"), "seq").alias("d"))
    return latest.select(LOAD_COLUMN, "d.*")


def begin(spark: SparkSession, table_dir: str, finished: DataFrame) -> None:
    """Before a load writes: the manifest exists, and each load of ``finished``
    (load_id, those of the ledger) that it lacks counts as published — one that
    stopped between its ledger entry and its commit, or from before manifests."""
    known = manifest(spark, table_dir)
    loads = finished.select(LOAD_COLUMN).distinct()
    if known is not None:
        loads = loads.join(known, LOAD_COLUMN, "left_anti")
    missing = sorted(r[0] for r in loads.collect())  # loads since the last run
    if missing or known is None:
        first = _next_seq(spark, table_dir)
        _append(spark, table_dir, [(i, first + n, PUBLISHED, None) for n, i in enumerate(missing)])


def _next_seq(spark: SparkSession, table_dir: str) -> int:
    log = _read(spark, table_dir)
    last = None if log is None else log.agg(F.max("seq")).first()[0]
    return 1 if last is None else last + 1


def decide(spark: SparkSession, table_dir: str, load_id: str, state: str, reason: str | None = None) -> int:
    """Commits a decision on a load; returns its ``seq``."""
    seq = _next_seq(spark, table_dir)
    _append(spark, table_dir, [(load_id, seq, state, reason)])
    return seq


def state_of(spark: SparkSession, table_dir: str, load_id: str) -> str | None:
    known = manifest(spark, table_dir)
    row = None if known is None else known.where(F.col(LOAD_COLUMN) == load_id).first()
    return row["state"] if row else None


def snapshot(spark: SparkSession, table_dir: str, contract: TableContract, as_of: int | None = None,
             states: tuple[str, ...] = (PUBLISHED,), keep_load: bool = False) -> DataFrame:
    """The rows of the loads that the manifest lets readers see, in contract
    columns (and ``load_id`` if wanted). The manifest is joined on the partition
    column, so folders of other loads are pruned, not read. A table without a
    manifest is read as it is."""
    names = [*contract.names, *([LOAD_COLUMN] if keep_load else [])]
    known = manifest(spark, table_dir, as_of)
    table = spark.read.schema(contract.schema).parquet(table_dir)
    if LOAD_COLUMN not in table.columns:  # no rows yet, or no loads
        table = table.withColumn(LOAD_COLUMN, F.lit(None).cast("string"))
    if known is None:
        return table.select(*names)
    loads = known.where(F.col("state").isin(*states))
    if contract.mode in WHOLE_MODES:
        loads = loads.orderBy(F.desc("seq")).limit(1)
    # Broadcast (one short row per load), whatever the session's thresholds: a
    # shuffle by load would send all rows of a load to one task.
    return table.join(F.broadcast(loads.select(LOAD_COLUMN)), LOAD_COLUMN, "left_semi").select(*names)


def drop_load(spark: SparkSession, table_dir: str, load_id: str, levels: int) -> int:
    """Deletes a load's folders, ``levels`` partition levels below the table;
    returns how many there were."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    pattern = "/".join([table_dir.rstrip("/"), *["*=*"] * levels, f"{LOAD_COLUMN}={load_id}"])
    fs = hadoop_path(table_dir).getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(hadoop_path(pattern)) or []
    for status in found:
        fs.delete(status.getPath(), True)
    return len(found)


def vacuum(spark: SparkSession, table_dir: str, contract: TableContract, keep: int = KEPT_LOADS) -> list[str]:
    """Deletes the folders of superseded loads of a table that shows only its
    latest one; returns their ids."""
    if contract.mode not in WHOLE_MODES:
        return []
    known = manifest(spark, table_dir)
    old = known.where(F.col("state") == PUBLISHED).orderBy(F.desc("seq")).offset(keep)
    gone = [r[LOAD_COLUMN] for r in old.collect()]
    return [i for i in gone if drop_load(spark, table_dir, i, len(contract.partition_by))]
