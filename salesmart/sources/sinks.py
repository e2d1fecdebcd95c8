"""Sinks: partitioned parquet tables and single-file CSV reports.

Write modes of a table load:

* ``overwrite`` — replace the whole table (static overwrite);
* ``append``    — add files; a rerun of the same input adds the rows again;
* ``dynamic``   — overwrite only the partitions present in the new data, so a
  rerun of the same input replaces instead of duplicating;
* ``append`` with a ``load_id`` — an append that a rerun of the same load
  replaces (the load id is an extra partition level).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.contracts import TableContract
from salesmart.session import scratch_path, shuffles_freed

MODES = ("overwrite", "append", "dynamic")
# Extra partition level of a load-scoped append (dropped by contract reads).
LOAD_COLUMN = "load_id"
# Bound on rows per output file; keeps files a few hundred MB at most.
MAX_RECORDS_PER_FILE = 5_000_000
# Sales that are joined and written together, in parts of whole months: the
# shuffle files of one part are gone before the next begins. Each part shuffles
# the dimensions again, so there are few. (A number that shares no factor with
# twelve deals the same month of all years to different parts.)
SLICE_ROWS = 20_000_000
MAX_SLICES = 5
SLICE = "_slice"


def write_table(df: DataFrame, path: str, contract: TableContract, mode: str | None = None,
                max_records_per_file: int = MAX_RECORDS_PER_FILE,
                load_id: str | None = None) -> None:
    """Write ``df`` in contract order, partitioned by the contract.

    Rows are rebalanced on the partition columns first, so each task writes
    few partition folders (no small-file explosion). ``REBALANCE`` lets AQE
    split a partition value that holds a large share of the rows over
    several tasks instead of sending it to one.
    """
    mode = mode or ("append" if load_id is not None else contract.mode)
    if mode not in MODES:
        raise ValueError(f"unknown write mode {mode!r}; expected one of {MODES}")
    out = contract.conform(df)
    partition_by = list(contract.partition_by)
    if load_id is not None:
        # An append scoped to one load: rows go under load_id=<id> inside
        # their partitions and the write replaces only that load's folders,
        # so re-running the same load (after a crash) cannot add rows twice.
        if mode != "append":
            raise ValueError("a load-scoped write is an append")
        out = out.withColumn(LOAD_COLUMN, F.lit(load_id))
        partition_by.append(LOAD_COLUMN)
        mode = "dynamic"
    if contract.partition_by:
        out = out.hint("rebalance", *contract.partition_by)
    writer = out.write.option("maxRecordsPerFile", max_records_per_file)
    # Bloom filters, sized by what they hold: a lookup skips the row groups that
    # cannot have its key.
    for key in contract.lookup:
        writer = (writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
                  .option("parquet.bloom.filter.adaptive.enabled", "true"))
    if mode == "dynamic":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    elif mode == "overwrite":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "static")
    else:
        writer = writer.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffles_freed(df.sparkSession):
        writer.parquet(path)


def slices(rows: int) -> int:
    """Parts in which so many sales are written."""
    return max(1, min(MAX_SLICES, -(-rows // SLICE_ROWS)))


def slice_of(n: int) -> Column:
    """The part, of ``n``, of a sale's month; sales without a date are in the first."""
    return F.coalesce(F.pmod(F.col("trans_year") * 12 + F.col("trans_month"), F.lit(n)), F.lit(0))


@contextmanager
def sliced(df: DataFrame, n: int) -> Iterator[list[DataFrame]]:
    """The ``n`` parts of sales that are themselves the result of a join, which
    is made once."""
    if n == 1:
        yield [df]
        return
    with held(df.withColumn(SLICE, slice_of(n)), "slices", SLICE) as kept:
        yield [kept.where(F.col(SLICE) == i).drop(SLICE) for i in range(n)]


@contextmanager
def held(df: DataFrame, name: str, *partition_by: str) -> Iterator[DataFrame]:
    """The rows computed once and read from the shared scratch folder, as long
    as the block lasts; the shuffles behind them are gone before it begins."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_freed(spark):
        df.write.partitionBy(*partition_by).parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_csv(df: DataFrame, path: str, order: list[Column] | None = None,
              mode: str = "overwrite") -> None:
    """One CSV file with a header (reports are small: one row per group).

    ``repartition(1)`` moves the finished small result into the one task that
    writes the file, so the aggregate before it keeps its full parallelism;
    that task also sorts it (no range-sampling job for a one-file output).
    """
    out = df.repartition(1)
    if order:
        out = out.sortWithinPartitions(*order)
    out.write.mode(mode).option("header", True).csv(path)


def write_text_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """All-string frame as CSV with a header (archive copies of landing text)."""
    df.write.mode(mode).option("header", True).csv(path)
