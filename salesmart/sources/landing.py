"""Landing intake: list new files, group them by header layout, read as text.

Landing transaction files do not share one layout: columns come in other
orders and the key column is called ``trans_key`` or ``trans_id``. Reading
them all with one glob would shift values between columns, so files are
grouped by their header line and each group is read with its own all-string
schema, then the groups are unioned by column name.

Every landing column is read as a string; typing happens in the staging
transforms, never by inference.
"""

from __future__ import annotations

import datetime as _dt
import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from salesmart.contracts import LANDING_TRANSACTION_COLUMNS  # noqa: F401 (re-exported)
from salesmart.session import scratch_path
from salesmart.sources.tables import path_exists

# Fixed names of the landing zone.
TRANSACTION_GLOB = "trans_fact_*"
LOCATION_NAME = "location.csv"
PRODUCT_NAME = "product.csv"
KEY_ALIASES = {"trans_id": "trans_key"}
SOURCE_FILE = "source_file"
LANDING_NAME = "landing_name"

LEDGER_SCHEMA = StructType([
    StructField("path", StringType(), False),
    StructField("modification_time", StringType(), True),
    StructField("length", StringType(), True),
    StructField("load_id", StringType(), False),
])


def new_load_id() -> str:
    """Compact, sortable load id usable in a path (no ``:``)."""
    now = _dt.datetime.now(_dt.timezone.utc)
    return now.strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:6]


def all_strings(names) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


def list_files(spark: SparkSession, landing_dir: str, glob: str = TRANSACTION_GLOB) -> DataFrame:
    """Files under ``landing_dir`` whose name (or parent folder) matches ``glob``.

    A ``binaryFile`` read with only metadata columns selected: the file
    content is pruned, so this is a distributed listing, not a read.
    """
    pattern = f"{landing_dir.rstrip('/')}/{glob}"
    try:
        listing = spark.read.format("binaryFile").load(pattern)
    except Exception as e:  # no file matches the glob
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], FILES_SCHEMA)
        raise
    return listing.select(
        F.col("path"),
        F.col("modificationTime").cast("string").alias("modification_time"),
        F.col("length").cast("string").alias("length"))


FILES_SCHEMA = "path string, modification_time string, length string"


def freeze(files: DataFrame) -> DataFrame:
    """Fix a file listing at this moment.

    A listing is lazy: evaluated again later it would include files that
    arrived in the meantime, and the ledger would record files that were
    never read. The listing (one small row per file) is written once to the
    shared scratch folder, and the same rows serve the read and the ledger
    entry; none of them passes through the driver.
    """
    spark = files.sparkSession
    path = scratch_path(spark, "listing")
    files.select("path", "modification_time", "length").write.parquet(path)
    return spark.read.schema(FILES_SCHEMA).parquet(path)


def without_paths(files: DataFrame, paths) -> DataFrame:
    """The listing less some paths (those of one batch at most)."""
    if not paths:
        return files
    gone = files.sparkSession.createDataFrame([(p,) for p in sorted(paths)], "path string")
    return files.join(gone, "path", "left_anti")


def in_batches(files: DataFrame, most: int) -> list[DataFrame]:
    """A listing in parts of about ``most`` files, by the hash of their paths."""
    n = math.ceil(files.count() / most)
    if n <= 1:
        return [files] * n
    batch = F.pmod(F.xxhash64("path"), F.lit(n))
    return [files.where(batch == k) for k in range(n)]


def read_ledger(spark: SparkSession, ledger_dir: str) -> DataFrame:
    if not path_exists(spark, ledger_dir):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger_dir)


def new_files(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Listed files not yet in the ledger (a changed file counts as new)."""
    keys = ["path", "modification_time", "length"]
    return listing.join(ledger.select(*keys), on=keys, how="left_anti")


def record_loaded(files: DataFrame, ledger_dir: str, load_id: str) -> None:
    """Append the loaded files to the ledger (after the table write)."""
    (files.select("path", "modification_time", "length", F.lit(load_id).alias("load_id"))
     .repartition(1).write.mode("append").parquet(ledger_dir))


# Bytes of a file read at once until its header line is complete.
PROBE_CHUNK_BYTES = 1 << 16


def _first_line(uri: str) -> tuple[str | None, bool]:
    """First non-empty line of a file, however long; nothing after it is read.

    Returns ``(line, True)``, with no line for a file without text or one that
    is gone, or ``(None, False)`` when this filesystem cannot be opened from
    Python (the caller then falls back to a Spark text scan).
    """
    from pyarrow import fs as pafs
    try:
        if uri.startswith("file:"):
            filesystem, path = pafs.LocalFileSystem(), uri.split(":", 1)[1]
            while path.startswith("//"):
                path = path[1:]
        else:
            filesystem, path = pafs.FileSystem.from_uri(uri)
        with filesystem.open_input_stream(path, compression="detect") as stream:
            rest = b""
            while True:
                chunk = stream.read(PROBE_CHUNK_BYTES)
                *lines, rest = (rest + chunk).split(b"\n")
                for raw in lines if chunk else [*lines, rest]:
                    line = raw.rstrip(b"\r").decode("utf-8-sig", errors="replace")
                    if line.strip():
                        return line, True
                if not chunk:
                    return None, True
    except FileNotFoundError:  # listed, but gone since: nothing to read
        return None, True
    except Exception:  # noqa: BLE001 - unsupported scheme, credentials, ...
        return None, False


def _probe_batches(batches):
    import pyarrow as pa
    for batch in batches:
        paths = batch.column(0).to_pylist()
        found = [_first_line(p) for p in paths]
        yield pa.RecordBatch.from_arrays(
            [pa.array(paths, pa.string()), pa.array([f[0] for f in found], pa.string()),
             pa.array([f[1] for f in found], pa.bool_())],
            names=["path", "value", "opened"])


def _parallelism(spark: SparkSession) -> int:
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - sessions without a local context
        return int(spark.conf.get("spark.sql.shuffle.partitions", "8"))


def intents_dir(ledger_dir: str) -> str:
    return f"{ledger_dir.rstrip('/')}_intents"


def record_intent(files: DataFrame, ledger_dir: str, load_id: str) -> None:
    """Before a load writes anything: which files it reads, under which id."""
    (files.select("path", "modification_time", "length", F.lit(load_id).alias("load_id"))
     .repartition(1).write.mode("append").parquet(intents_dir(ledger_dir)))


def unfinished_loads(spark: SparkSession, ledger_dir: str, listing: DataFrame
                     ) -> list[tuple[str, DataFrame, DataFrame]]:
    """Loads whose intent was written but whose ledger entry was not (the job
    stopped half-way): ``(load_id, frozen files, gone files)`` each, oldest
    first. The files are those of the intent as ``listing`` shows them now, so
    the ledger gets what a re-run really reads; ``gone`` are the intent's rows
    of files no longer there. Re-running a load with the same id replaces
    whatever it had written."""
    intents = read_ledger(spark, intents_dir(ledger_dir))
    done = read_ledger(spark, ledger_dir).select("load_id").distinct()
    rows = intents.join(done, on="load_id", how="left_anti").distinct()
    now = listing.select("path", F.col("modification_time").alias("now_time"), F.col("length").alias("now_length"))
    rows = rows.join(now, "path", "left")
    out = []
    for load_id in sorted(r[0] for r in rows.select("load_id").distinct().collect()):  # loads that stopped
        mine = rows.where(F.col("load_id") == load_id)
        there = mine.where("now_length is not null").select(
            "path", F.col("now_time").alias("modification_time"), F.col("now_length").alias("length"))
        gone = mine.where("now_length is null").select("path", "modification_time", "length")
        out.append((load_id, freeze(there.distinct()), freeze(gone.distinct())))
    return out


def header_names(line: str) -> tuple[str, ...]:
    return tuple(c.strip().strip('"').strip() for c in line.split(","))


def resolved_header(header: tuple[str, ...], columns) -> tuple[dict[str, str], str | None]:
    """Which header name gives each wanted column, or why the file cannot be
    read: names match without case and through ``KEY_ALIASES``, every wanted
    column must be there, and only once."""
    found: dict[str, str] = {}
    wanted = {c.lower(): c for c in columns}
    for name in header:
        low = name.lower()
        target = wanted.get(KEY_ALIASES.get(low, low))
        if target is None:
            continue
        if target in found:
            return {}, f"{target} given twice ({found[target]}, {name})"
        found[target] = name
    missing = [c for c in columns if c not in found]
    return (found, None) if not missing else ({}, "no column " + ", ".join(missing))


def header_layouts(spark: SparkSession, paths: list[str], columns=LANDING_TRANSACTION_COLUMNS
                   ) -> tuple[list[tuple[tuple[str, ...], list[str]]], dict[str, str]]:
    """``(layouts, refused)``: the distinct readable headers with the files
    that carry each, and for every other file with text why it is refused.

    Each file's first non-blank line is read by a task that opens the file and
    stops there, so discovery costs grow with the number of files and not with
    their size. A file whose filesystem Python cannot open goes through a Spark
    text scan instead. The driver receives one (path, line) row per file.
    """
    if not paths:
        return [], {}
    slices = max(1, min(len(paths) // 64 + 1, _parallelism(spark) * 4))
    rows = (spark.createDataFrame([(p,) for p in paths], "path string")
            .repartition(slices)
            .mapInArrow(_probe_batches, "path string, value string, opened boolean")
            .collect())
    lines = {r["path"]: r["value"] for r in rows if r["opened"]}
    pending = [r["path"] for r in rows if not r["opened"]]
    if pending:
        # Rows of the split starting at offset 0, in read order (the id grows
        # with the row order of a task).
        first = (spark.read.text(pending)
                 .where((F.col("_metadata.file_block_start") == 0) & (F.trim(F.col("value")) != ""))
                 .select(F.col("value"), F.col("_metadata.file_path").alias("path"),
                         F.monotonically_increasing_id().alias("_order"))
                 .groupBy("path").agg(F.min_by("value", "_order").alias("value")))
        lines.update({r["path"]: r["value"] for r in first.collect()})
    merged: dict[tuple[str, ...], list[str]] = {}
    refused: dict[str, str] = {}
    for path in sorted(lines):
        if lines[path] is None:
            continue  # no text in the file
        header = header_names(lines[path])
        reason = resolved_header(header, columns)[1]
        if reason:
            refused[path] = reason
        else:
            merged.setdefault(header, []).append(path)
    return sorted(merged.items()), refused


def read_layout(spark: SparkSession, header: tuple[str, ...], paths: list[str], columns) -> DataFrame:
    """All-string read of files sharing one header, in landing column names."""
    names, _ = resolved_header(header, columns)
    # Columns not wanted may repeat a name; they are read under their place.
    fields = [n if n in names.values() else f"_unused_{i}" for i, n in enumerate(header)]
    df = (spark.read.schema(all_strings(fields)).option("header", True)
          .option("mode", "PERMISSIVE").csv(paths))
    source = F.col("_metadata.file_path")
    return df.select(*(F.col(names[c]).alias(c) for c in columns), source.alias(SOURCE_FILE),
                     landing_name(source).alias(LANDING_NAME))


def landing_name(path):
    """Name a landing file goes by: its own name, or its folder's name when it
    is a part file of a folder written by a distributed writer. Plain
    string splitting (no regex): it is evaluated for every row."""
    file_name = F.substring_index(path, "/", -1)
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    return F.when(file_name.startswith("part-"), folder).otherwise(file_name)


def read_transactions(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Union of all landing layouts, each read by its own header.

    Output: the landing transaction columns as strings, plus the source file
    and its landing name. Files whose header lacks a column are left out (the
    jobs keep them pending and report them).
    """
    return read_by_headers(spark, paths, LANDING_TRANSACTION_COLUMNS)


def read_by_headers(spark: SparkSession, paths: list[str], columns) -> DataFrame:
    """Read headed CSV files by column name, whatever their column order."""
    return read_layouts(spark, header_layouts(spark, paths, columns)[0], columns)


def read_layouts(spark: SparkSession, layouts, columns) -> DataFrame:
    """Union of the layouts' by-name reads in ``columns`` order."""
    if not layouts:
        return spark.createDataFrame([], all_strings([*columns, SOURCE_FILE, LANDING_NAME]))
    frames = [read_layout(spark, header, files, columns) for header, files in layouts]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def landing_paths(files: DataFrame) -> list[str]:
    """File paths of a listing, in order (file metadata only, one row per
    file; sorted on the driver, so no shuffle is planned for it)."""
    return sorted(r["path"] for r in files.select("path").collect())


def retire(spark: SparkSession, paths: list[str]) -> None:
    """Deletes landing files of a load whose ledger entry is written."""
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, False)


def spark_read_strings(spark: SparkSession, path: str, names) -> DataFrame:
    """Read CSV files written with a header; the header must name exactly
    ``names`` in this order (checked by the reader), all read as strings."""
    return (spark.read.schema(all_strings(names)).option("header", True)
            .option("enforceSchema", False).csv(path))
