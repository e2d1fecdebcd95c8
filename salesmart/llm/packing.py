"""Best-fit packing of tokenised documents in bulk-synchronous rounds.

A document's ids (with the end id) are one piece, or pieces of ``capacity``
where they are more, the first one shorter. Full pieces are sequences of their
own. The others are placed by classes of falling size: class k holds the
lengths in (capacity / 2^(k+1), capacity / 2^k].

A round of a class takes the waiting pieces and the sequences with room (gaps;
one with room for several of the class counts as several equal brackets, but
stays one row), orders both by size, and sweeps from large to small: a gap opens
its brackets, a piece closes the one opened last, which is of the smallest gap
that holds it. Pieces and gaps of one size are told apart by rank, a running sum
of brackets. The sweep runs as a distributed bracket matching: sums by (size,
kind, bucket) give each row its depth, so a gap is an interval of levels and a
piece is one level; blocks of neighbouring levels are swept apart, each by one
task, and a piece takes the gap that opened its level last. At one level there are
at most two rows for each size, which bounds a block. Then room is updated, and
rounds repeat until no gap holds a waiting piece; what still waits opens new
sequences, equal parts of the capacity together. Class 0 fits no two together,
so it opens its sequences at once.

Every round is written to the shared scratch folder; a lost executor repeats
at most one round. Only counts reach the driver.

Defined cases: null text is an empty document (the end id alone); rows with
equal or null doc_id are documents of their own; an empty table gives an empty
result; only ``doc_id`` and ``text`` are used, so other columns cannot clash.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesmart.llm.scratch import kept, removed
from salesmart.llm.textkit import workers_ready
from salesmart.llm.tokens import encoder, tokenizer_json

CAPACITY = 1024
END_ID = 2
#: Rows of one size are ranked in so many buckets at least, of so many rows at most.
BUCKETS, BUCKET_ROWS = 256, 200_000
#: Levels that one task sweeps together.
BLOCK_LEVELS = 256

_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def tokenized_pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID,
                     tokenizer: str | None = None, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, on
    demand, ids (little-endian uint32)."""
    spark = docs.sparkSession
    workers_ready(spark)
    held = spark.sparkContext.broadcast(tokenizer_json(tokenizer))
    end = np.array([end_id], "<u4").tobytes()
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = _PIECES.replace("bigint", id_type, 1) + (", ids binary" if keep_ids else "")

    def cut(batches):
        tokens = encoder(held)
        for batch in batches:
            rows, columns = [], [[] for _ in range(5)]
            for row, text in enumerate(batch.column("text").to_pylist()):
                data = tokens.encode(text) + end
                for piece, (start, length) in enumerate(piece_bounds(len(data) // 4, capacity)):
                    ids = data[4 * start:4 * (start + length)]
                    rows.append(row)
                    for column, value in zip(columns, (piece, start, length, zlib.crc32(ids), ids), strict=True):
                        column.append(value)
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][:5 if keep_ids else 4]
            names = ["piece", "start", "length", "ids_crc32", "ids"][:len(types)]
            made = [pa.array(c, t) for c, t in zip(columns, types, strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(rows, pa.int32())), *made], names=["doc_id", *names])

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def _ranked(rows: DataFrame, keys: list[str], by, n_buckets: int) -> DataFrame:
    """Adds ``before``: the sum of ``weight`` over the rows before a row among
    those of its ``keys``, which may be any share of all: sums run inside hashed
    buckets, to which the sums of the buckets before are added."""
    rows = rows.withColumn("bucket", F.pmod(by, F.lit(n_buckets)))
    sums = rows.groupBy(*keys, "bucket").agg(F.sum("weight").alias("n"))
    earlier = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    own = F.sum("weight").over(Window.partitionBy(*keys, "bucket").orderBy(by, "id").rowsBetween(Window.unboundedPreceding, -1))
    return (rows.withColumn("own", F.coalesce(own, F.lit(0))).join(sums, [*keys, "bucket"])
            .withColumn("before", F.col("own") + F.col("earlier")).drop("bucket", "own", "earlier"))


def _sweep(levels: int):
    """The pieces (kind 1) of one block of levels with the gap each takes."""
    def run(block: pa.Table) -> pa.Table:
        block = block.sort_by([("size", "descending"), ("kind", "ascending"), ("before", "ascending")])
        kinds, ids, sizes, lows, highs = (block.column(c).to_numpy() for c in ("kind", "id", "size", "low", "high"))
        if not (kinds == 0).any():
            return pa.table({"uid": ids, "size": sizes, "seq": pa.nulls(len(ids), pa.int64())})
        first = int(block.column("block")[0].as_py()) * levels
        opened = [-1] * levels
        taken = np.full(len(ids), -1, np.int64)
        for row, (kind, low, high) in enumerate(zip(kinds.tolist(), (lows - first).tolist(), (highs - first).tolist(), strict=True)):
            if kind:
                taken[row], opened[low] = opened[low], -1
            else:
                low, high = max(low, 0), min(high, levels - 1)
                opened[low:high + 1] = [row] * (high + 1 - low)
        pieces = np.flatnonzero(kinds == 1)
        partner = taken[pieces]
        return pa.table({"uid": ids[pieces], "size": sizes[pieces], "seq": pa.array(ids[partner], mask=partner < 0)})

    return run


def _leveled(waiting: DataFrame, gaps: DataFrame, largest: int, n_buckets: int) -> DataFrame:
    """The rows of a sweep by block of levels: a piece is one row, a gap one for
    each block it reaches into. Depths, at most two for each size, are broadcast."""
    several = F.greatest(F.lit(1), F.floor(F.col("room") / F.lit(largest))).cast("bigint")
    gaps = gaps.select(F.lit(0).alias("kind"), F.floor(F.col("room") / several).cast("bigint").alias("size"), F.col("seq").alias("id"), several.alias("weight"))
    rows = waiting.select(F.lit(1).alias("kind"), "size", F.col("uid").alias("id"), F.lit(1).cast("bigint").alias("weight")).unionByName(gaps)
    # The row's own hash orders it inside its bucket, so ranks are the same
    # whenever a task is run again.
    ranked = _ranked(rows, ["kind", "size"], F.xxhash64("id", "kind"), n_buckets)
    totals = rows.groupBy("size", "kind").agg(F.sum("weight").alias("n"))
    earlier = Window.orderBy(F.desc("size"), "kind").rowsBetween(Window.unboundedPreceding, -1)
    step = F.when(F.col("kind") == 0, F.col("n")).otherwise(-F.col("n"))
    depths = totals.select("size", "kind", F.coalesce(F.sum(step).over(earlier), F.lit(0)).alias("depth"))
    low = F.when(F.col("kind") == 0, F.col("depth") + F.col("before") + 1).otherwise(F.col("depth") - F.col("before"))
    leveled = ranked.join(F.broadcast(depths), ["size", "kind"]).withColumn("low", low)
    leveled = leveled.withColumn("high", F.col("low") + F.col("weight") - 1)
    in_block = lambda c: F.floor(F.col(c) / F.lit(BLOCK_LEVELS))
    # A gap has at most `capacity` brackets, so it reaches into few blocks.
    rows = leveled.withColumn("block", F.explode(F.sequence(in_block("low"), in_block("high"))))
    return rows.select("block", "kind", "size", "id", "before", "low", "high")


def _matched(waiting: DataFrame, gaps: DataFrame, largest: int, n_buckets: int) -> DataFrame:
    """One round: the waiting pieces (uid, size) with seq, null for those
    without a gap."""
    rows = _leveled(waiting, gaps, largest, n_buckets)
    return rows.groupBy("block").applyInArrow(_sweep(BLOCK_LEVELS), "uid bigint, size bigint, seq bigint")


def _opened(waiting: DataFrame, capacity: int, n_buckets: int) -> DataFrame:
    """New sequences: pieces of which ``parts`` fit together, in order of size,
    so many to a sequence, which is named by its first piece."""
    parts = F.floor(F.lit(capacity) / F.col("size")).cast("int")
    rows = waiting.select(F.col("uid").alias("id"), "size", parts.alias("parts"), F.lit(1).cast("bigint").alias("weight"))
    ranked = _ranked(rows, ["parts", "size"], F.xxhash64("id"), n_buckets)
    totals = rows.groupBy("parts", "size").agg(F.count("*").alias("n"))  # one row a size
    earlier = Window.partitionBy("parts").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("parts", "size", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("larger"))
    place = F.col("before") + F.col("larger")
    rows = (ranked.join(F.broadcast(totals), ["parts", "size"])
            .select(F.col("id").alias("uid"), "size", "parts", F.floor(place / F.col("parts")).alias("bin"), place.alias("place")))
    first = F.first("uid").over(Window.partitionBy("parts", "bin").orderBy("place"))
    return rows.select("uid", "size", first.alias("seq"))


def best_fit(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """uid, sequence_id, offset for pieces (uid unique, length 1..capacity)."""
    spark = pieces.sparkSession
    workers_ready(spark)
    sizes = pieces.select("uid", F.col("length").alias("size"))
    counts = {r["size"]: r["count"] for r in sizes.groupBy("size").count().collect()}  # at most `capacity` rows
    n_buckets = max(BUCKETS, max(counts.values(), default=0) // BUCKET_ROWS)
    full = sizes.filter(F.col("size") == capacity).select("uid", F.col("uid").alias("seq"), "size", F.lit(0).alias("round"))
    least = min(counts, default=capacity)
    high, rounds, placed, spent, rooms, held = capacity, 0, [], [], None, None
    while high:
        low = high // 2
        some = [s for s in counts if low < s <= high and s < capacity]
        if some:
            waiting = sizes.filter((F.col("size") > low) & (F.col("size") <= high) & (F.col("size") < capacity))
            n_waiting, smallest = sum(counts[s] for s in some), min(some)
            while n_waiting and rooms is not None and high <= capacity // 2:
                rounds += 1
                found = kept(_matched(waiting, rooms.filter(F.col("room") >= smallest), max(some), n_buckets), f"pack-{rounds}")
                n, left, smallest_left = found.agg(F.count("seq"), F.count("*") - F.count("seq"), F.min(F.when(F.col("seq").isNull(), F.col("size")))).first()
                if not n:
                    spent.append(found)
                    break
                new = found.filter("seq is not null")
                placed.append(new.select("uid", "seq", "size", F.lit(rounds).alias("round")))
                used = new.groupBy("seq").agg(F.sum("size").alias("used"))
                if held is not None:
                    spent.append(held)
                room = F.col("room") - F.coalesce("used", F.lit(0))
                rooms = rooms.join(used, "seq", "left").select("seq", room.alias("room")).filter(F.col("room") >= least)
                rooms = held = kept(rooms, f"pack-rooms-{rounds}")
                waiting, n_waiting, smallest = found.filter("seq is null").select("uid", "size"), left, smallest_left
            if n_waiting:
                rounds += 1
                new = (_opened(waiting, capacity, n_buckets) if high <= capacity // 2
                       else waiting.select("uid", "size", F.col("uid").alias("seq")))
                new = kept(new.select("uid", "seq", "size", F.lit(rounds).alias("round")), f"pack-{rounds}")
                placed.append(new)
                more = new.groupBy("seq").agg((F.lit(capacity) - F.sum("size")).alias("room")).filter(F.col("room") >= least)
                rooms = more if rooms is None else rooms.unionByName(more)
        high = low
    taken = functools.reduce(DataFrame.unionByName, placed, full.limit(0))
    order = Window.partitionBy("seq").orderBy("round", "uid").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("size").over(order), F.lit(0)).cast("bigint")
    result = (taken.select("uid", F.col("seq").alias("sequence_id"), offset.alias("offset"))
              .unionByName(full.select("uid", F.col("seq").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))))
    removed(spark, *spent)
    return result


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID,
         tokenizer: str | None = None, keep_ids: bool = False) -> DataFrame:
    """The pieces of ``docs`` with sequence_id and offset."""
    pieces = tokenized_pieces(docs, capacity, end_id, tokenizer, keep_ids)
    pieces = kept(pieces.withColumn("uid", F.monotonically_increasing_id()), "pack-pieces")
    return pieces.join(best_fit(pieces, capacity), "uid").drop("uid")


def sequences(packed: DataFrame) -> DataFrame:
    """Training rows: each sequence's ids (little-endian uint32) and the place
    where each of its pieces begins. A sequence's pieces are at most its
    capacity, so a group is bounded."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
        F.transform("parts", lambda p: p["offset"]).alias("starts"))
