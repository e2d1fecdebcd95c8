"""Vectorised text helpers shared by the operators (numpy on UTF-8 bytes).

Words follow one rule everywhere: A-Z become a-z, and a word is a maximal run
of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` (digits, a-z, every non-ASCII
character), which on UTF-8 bytes is a run of the bytes below.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())
_IS_WORD = np.zeros(256, bool)
_IS_WORD[0x30:0x3A] = _IS_WORD[0x61:0x7B] = _IS_WORD[0x80:] = True

_P = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_P_INVERSE = pow(_P, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: Texts are worked on in groups of about this many bytes.
GROUP_BYTES = 2_000_000
#: Size of an Arrow batch sent to a Python worker.
BATCH_BYTES = 4_000_000


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) on uint64 arrays."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the hash base and of its inverse, kept for later calls."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((_P, _P_INVERSE)):
            steps = np.full(size, np.uint64(base))
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def words_of(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes) of the words of UTF-8 bytes, in order."""
    raw = np.frombuffer(data.translate(_LOWER_BYTES), np.uint8)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = _IS_WORD[raw]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return starts, ends, np.empty(0, np.uint64)
    up, down = _power_tables(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts]
    return starts, ends, mix64(hashes + (ends - starts).astype(np.uint64))


def grouped(texts: list[str | None], limit: int = GROUP_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first text, encoded texts) of groups up to ``limit`` bytes;
    a longer text is a group of its own. Null counts as empty."""
    first, group, size = 0, [], 0
    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8", "replace")
        if group and size + len(data) > limit:
            yield first, group
            first, group, size = i, [], 0
        group.append(data)
        size += len(data) + 1
    if group:
        yield first, group


def slices(batch: pa.RecordBatch, other: str = "doc_id", text: str = "text",
           limit: int = GROUP_BYTES) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """(values of ``other``, texts as UTF-8 bytes) of runs of rows up to
    ``limit`` bytes; a longer text is a run of its own. Null counts as empty."""
    texts = batch.column(text).cast(pa.binary())
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(sizes):
        before = int(sizes[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, before + limit, "right")))
        yield batch.column(other).slice(at, end - at), [t or b"" for t in texts.slice(at, end - at).to_pylist()]
        at = end


def joined_words(group: list[bytes]):
    """Words of a group of texts: (starts, ends, hashes, text offsets, word
    bounds): text i holds the words ``bounds[i]:bounds[i + 1]``."""
    offsets = np.zeros(len(group) + 1, np.int64)
    np.cumsum([len(x) + 1 for x in group], out=offsets[1:])
    starts, ends, hashes = words_of(b"\n".join(group) + b"\n")
    return starts, ends, hashes, offsets, np.searchsorted(starts, offsets)


def lowered(col: Column) -> Column:
    """A-Z to a-z only, as the word rule says."""
    return F.translate(col, UPPER, LOWER)


def workers_ready(spark: SparkSession) -> None:
    """Bounds by bytes what one Arrow batch holds in a Python worker, at one
    value for all operators, and lets the workers of a local session import
    this package from here (a cluster gets it with --py-files)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def crc_mod(col: Column, n: int) -> Column:
    """crc32 of the value as text, modulo n."""
    return F.pmod(F.crc32(col.cast("string").cast("binary")), F.lit(n))


def batch_of(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [v if isinstance(v, pa.Array) else pa.array(v, schema.field(k).type)
         for k, v in columns.items()], schema=schema)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
