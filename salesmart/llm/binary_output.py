"""Token-id output: best-fit-decreasing packing into binary id matrices.

A task tokenises its documents and packs them in shards of about
``SHARD_TOKENS`` tokens. Documents longer than a row are split, losing nothing,
into pieces of a row's capacity, the first one shorter. Pieces go, by falling
length, into the row with the least room that holds them; a segment tree over
the capacities 0..capacity finds it in log2(capacity) steps. There is no
shuffle: a shard costs at most its last few rows of padding.

A row of the output is one matrix row: ``ids`` (little-endian unsigned 16-bit
ids, 32-bit for larger vocabularies, padded to the capacity), ``n_tokens``,
``cu_seqlens`` (cumulative segment lengths from 0 to n_tokens) and
``position_resets`` (the places where position ids begin at 0 again), with the
doc_id, piece number and start of each segment. ``row_id`` is the task's
partition number and the row's number in it: the same whenever a task is run
again.

Defined cases: null text is an empty document (the end id alone); rows with
equal or null doc_id are documents of their own; an empty table gives no rows;
only ``doc_id`` and ``text`` are used, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.packing import piece_bounds
from salesmart.llm.textkit import workers_ready
from salesmart.llm.tokens import encoder, tokenizer_json

CAPACITY, END_ID, PAD_ID = 2048, 50256, 50256
SHARD_TOKENS = 4_000_000


class RoomTree:
    """Rows by room. A segment tree over the rooms 0..capacity counts the rows
    of each span, to find the least room of at least a length."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _step(self, room: int, by: int) -> None:
        node = room + self.size
        while node:
            self.count[node] += by
            node >>= 1

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._step(room, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """(room, row) of the least room of at least ``length``, taken out."""
        node = length + self.size
        if not self.count[node]:
            # Up to the first span to the right that has a row, then down.
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.size
        self._step(room, -1)
        return room, self.rows[room].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Numbers of the pieces in each row, in order of their place."""
    tree, rows = RoomTree(capacity), []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = tree.take(lengths[i])
        if found is None:
            found = capacity, len(rows)
            rows.append([])
        rows[found[1]].append(i)
        tree.add(found[0] - lengths[i], found[1])
    return rows


def _packed(pieces: list[tuple], capacity: int, pad: bytes, width: int, first_row: int) -> dict[str, list]:
    rows = best_fit_decreasing([len(p[3]) // width for p in pieces], capacity)
    out: dict[str, list] = {k: [] for k in ("row_id", "ids", "n_tokens", "cu_seqlens", "position_resets", "doc_ids", "pieces", "starts")}
    for k, row in enumerate(rows):
        mine = [pieces[i] for i in row]
        ends = np.cumsum([len(p[3]) // width for p in mine]).tolist()
        out["row_id"].append((TaskContext.get().partitionId() << 33) + first_row + k)
        out["ids"].append(b"".join(p[3] for p in mine) + pad * (capacity - ends[-1]))
        out["n_tokens"].append(ends[-1])
        out["cu_seqlens"].append([0, *ends])
        out["position_resets"].append([0, *ends[:-1]])
        for name, at in (("doc_ids", 0), ("pieces", 1), ("starts", 2)):
            out[name].append([p[at] for p in mine])
    return out


def binary_rows(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, pad_id: int = PAD_ID,
                tokenizer: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """The matrix rows of all documents."""
    spark = docs.sparkSession
    workers_ready(spark)
    held = spark.sparkContext.broadcast(tokenizer_json(tokenizer))
    id_type = docs.schema["doc_id"].dataType
    arrow_id = pa.string() if id_type.simpleString() == "string" else pa.int64()

    def run(batches) -> Iterator[pa.RecordBatch]:
        tokens = encoder(held)
        dtype = "<u2" if max(tokens.n_ids, end_id + 1, pad_id + 1) <= 1 << 16 else "<u4"
        width = np.dtype(dtype).itemsize
        end, pad = np.array([end_id], "<u4").tobytes(), np.array([pad_id], dtype).tobytes()
        types = {"row_id": pa.int64(), "ids": pa.binary(), "n_tokens": pa.int64(), "cu_seqlens": pa.list_(pa.int32()),
                 "position_resets": pa.list_(pa.int32()), "doc_ids": pa.list_(arrow_id), "pieces": pa.list_(pa.int32()), "starts": pa.list_(pa.int64())}
        pieces, held_tokens, n_rows = [], 0, 0

        def flush():
            columns = _packed(pieces, capacity, pad, width, n_rows)
            return pa.RecordBatch.from_arrays([pa.array(v, types[k]) for k, v in columns.items()], names=list(types))

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                data = np.frombuffer(tokens.encode(text) + end, "<u4").astype(dtype).tobytes()
                n = len(data) // width
                for piece, (start, length) in enumerate(piece_bounds(n, capacity)):
                    pieces.append((doc_id, piece, start, data[width * start:width * (start + length)]))
                held_tokens += n
                if held_tokens >= shard_tokens:
                    out = flush()
                    yield out
                    n_rows += out.num_rows
                    pieces, held_tokens = [], 0
        if pieces:
            yield flush()

    id_name = id_type.simpleString() if arrow_id == pa.string() else "bigint"
    return docs.select(F.col("doc_id").cast(id_name).alias("doc_id"), "text").mapInArrow(
        run, "row_id bigint, ids binary, n_tokens bigint, cu_seqlens array<int>, position_resets array<int>, "
        f"doc_ids array<{id_name}>, pieces array<int>, starts array<bigint>")


def unpacked(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The way back: doc_id, piece, start and the segment's ids (binary)."""
    width = F.length("ids") / F.lit(capacity)
    segment = F.explode(F.arrays_zip("doc_ids", "pieces", "starts", F.slice("cu_seqlens", 1, F.size("doc_ids")).alias("low"),
                                     F.slice("cu_seqlens", 2, F.size("doc_ids")).alias("high")))
    out = rows.select("ids", width.cast("int").alias("width"), segment.alias("s"))
    ids = F.substring("ids", F.col("s.low") * F.col("width") + 1, (F.col("s.high") - F.col("s.low")) * F.col("width"))
    return out.select(F.col("s.doc_ids").alias("doc_id"), F.col("s.pieces").alias("piece"), F.col("s.starts").alias("start"), ids.alias("ids"))
