"""Incremental landing intake with Structured Streaming.

A file-source stream over the landing glob discovers new files; each
micro-batch loads exactly the files it discovered:

1. the stream is a ``binaryFile`` source with only file metadata selected, so
   discovering files never reads their content;
2. ``foreachBatch`` groups the batch's files by header layout, reads each
   layout as strings, cleans, and appends accepted rows to the staging table
   (rejected rows, as landing text, go to a rejects table next to it);
3. the batch's files are written to the ledger under ``stream-<batch id>``, and
   the table's manifest publishes that load, so readers see whole batches.

The stream checkpoint records which files were offered in which batch, so a
rerun over the same landing folder loads nothing twice. A batch replayed
after a crash keeps its batch id: its rows are written under
``load_id=stream-<batch id>``; the replay first deletes them, and if its ledger
entry exists the batch was fully written and is skipped altogether. Files
that are gone by the time of a replay are left out. ``trigger(availableNow=True)`` processes what
is there and stops, which suits scheduled runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, LongType, StringType, StructField,
                               StructType, TimestampType)

from salesmart.contracts import TRANSACTIONS
from salesmart.operators import staging as stg
from salesmart.sources import commits
from salesmart.sources import landing as ld
from salesmart.sources import sinks
from salesmart.sources.tables import path_exists

BINARY_FILE_SCHEMA = StructType([
    StructField("path", StringType(), False),
    StructField("modificationTime", TimestampType(), False),
    StructField("length", LongType(), False),
    StructField("content", BinaryType(), True),
])


def _loader(spark: SparkSession, table_dir: str, ledger_dir: str, rejects_dir: str,
            lenient_dates: bool):
    """``load(files, load_id, refuse)``: reads the listed files that the
    ledger does not hold into the table, scoped to the load id; ``refuse``
    gets the files that cannot be read, with the reason, before the ledger
    entry is written."""
    def load(files: DataFrame, load_id: str, refuse) -> None:
        ledger = ld.read_ledger(spark, ledger_dir)
        commits.begin(spark, table_dir, ledger)
        if not ledger.where(F.col("load_id") == load_id).isEmpty():
            return  # replay of a load that was fully written
        # What a run of this load that stopped had written, whether or not the
        # files it came from are still there.
        commits.drop_load(spark, table_dir, load_id, len(TRANSACTIONS.partition_by))
        commits.drop_load(spark, rejects_dir, load_id, 0)
        files = ld.freeze(ld.new_files(files, ledger))
        layouts, refused = ld.header_layouts(spark, ld.landing_paths(files), ld.LANDING_TRANSACTION_COLUMNS)
        if refused:
            refuse(refused)
        if not layouts:
            return
        obs = Observation(f"intake_{load_id}")
        raw = ld.read_layouts(spark, layouts, ld.LANDING_TRANSACTION_COLUMNS)
        clean = stg.clean_transactions(raw, lenient_dates=lenient_dates).observe(
            obs, F.count_if(F.col(stg.REJECT_REASON).isNotNull()).alias("rejected"))
        sinks.write_table(stg.accepted(clean), table_dir, TRANSACTIONS, load_id=load_id)
        if obs.get["rejected"]:  # only then pay a second pass for the rejects
            (stg.rejects(raw, lenient_dates).withColumn(sinks.LOAD_COLUMN, F.lit(load_id))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(sinks.LOAD_COLUMN).parquet(rejects_dir))
        ld.record_loaded(ld.without_paths(files, refused), ledger_dir, load_id)
        commits.decide(spark, table_dir, load_id, commits.PUBLISHED)
    return load


PENDING_SCHEMA = "path string, reason string, load_id string"


def _load_batch(spark: SparkSession, load, pending_dir: str):
    def run(files: DataFrame, batch_id: int) -> None:
        load_id = f"stream-{batch_id:010d}"

        def refuse(refused: dict[str, str]) -> None:
            # The checkpoint marks them offered: keep them pending here.
            (spark.createDataFrame([(p, r, load_id) for p, r in refused.items()], PENDING_SCHEMA)
             .write.mode("append").parquet(pending_dir))

        load(_listed(files), load_id, refuse)
    return run


def _listed(files: DataFrame) -> DataFrame:
    return files.select("path", F.col("modificationTime").cast("string").alias("modification_time"),
                        F.col("length").cast("string").alias("length"))


def _retry_pending(spark: SparkSession, load, pending_dir: str, landing_dir: str, glob: str) -> None:
    """Files refused by an earlier batch, as they are now: those that can be
    read meanwhile are loaded, under an id that follows from their listing."""
    if not path_exists(spark, pending_dir):  # nothing was ever refused
        return
    paths = spark.read.schema(PENDING_SCHEMA).parquet(pending_dir).select("path").distinct()
    files = ld.freeze(ld.list_files(spark, landing_dir, glob).join(paths, "path", "left_semi"))
    mark = files.agg(F.sum(F.xxhash64("path", "modification_time", "length").cast("decimal(20,0)"))).first()[0]
    if mark is not None:
        load(files, f"retry-{mark}", lambda refused: None)


def intake_stream(spark: SparkSession, landing_dir: str, table_dir: str, checkpoint_dir: str,
                  ledger_dir: str | None = None, rejects_dir: str | None = None,
                  glob: str = ld.TRANSACTION_GLOB, max_files_per_trigger: int = 1000,
                  lenient_dates: bool = False, source_archive_dir: str | None = None) -> None:
    """Load every landing file not loaded before, then stop.

    ``source_archive_dir`` lets the file source move processed landing files
    there (Spark's ``cleanSource=archive``), so the landing listing does not
    grow without bound; exactly-once never relies on it (a file is moved only
    after a later batch commits)."""
    ledger_dir = ledger_dir or f"{table_dir.rstrip('/')}_ledger"
    rejects_dir = rejects_dir or f"{table_dir.rstrip('/')}_rejects"
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("maxFilesPerTrigger", max_files_per_trigger))
    if source_archive_dir:
        reader = (reader.option("cleanSource", "archive")
                  .option("sourceArchiveDir", source_archive_dir))
    files = (reader.load(f"{landing_dir.rstrip('/')}/{glob}")
             .select("path", "modificationTime", "length"))
    pending_dir = f"{table_dir.rstrip('/')}_unrecognized"
    load = _loader(spark, table_dir, ledger_dir, rejects_dir, lenient_dates)
    query = (files.writeStream
             .foreachBatch(_load_batch(spark, load, pending_dir))
             .option("checkpointLocation", checkpoint_dir)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    if query.exception():
        raise RuntimeError(f"landing intake failed: {query.exception()}")
    _retry_pending(spark, load, pending_dir, landing_dir, glob)
