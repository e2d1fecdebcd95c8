"""Hashed character n-grams of whole texts, vectorised over groups of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of one group; a longer text is cut into windows of this size
#: that overlap by the longest n-gram less one, so each n-gram counts once.
GROUP_CHARS = 400_000


def _windows(texts: list[str], longest: int) -> Iterator[tuple[list[int], list[str]]]:
    numbers, group, size = [], [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(len(text), 1), GROUP_CHARS):
            # A later window repeats the characters before it, see `hashed`.
            part = text[max(0, at - longest + 1):at + GROUP_CHARS]
            if group and size + len(part) > GROUP_CHARS:
                yield numbers, group
                numbers, group, size = [], [], 0
            numbers.append(i if at == 0 else ~i)
            group.append(part)
            size += len(part)
    if group:
        yield numbers, group


def hashed(texts: list[str], orders: tuple[int, ...], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text numbers, offsets, buckets) by group: the n-grams of the group's
    j-th entry are ``buckets[offsets[j]:offsets[j + 1]]``. Buckets are below
    2**bits; n-grams over an entry's edge are left out. A text beyond the group
    size has several entries."""
    shift = np.uint64(64 - bits)
    longest = max(orders)
    for numbers, group in _windows(texts, longest):
        chars = np.frombuffer("".join(group).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        sizes = np.array([len(x) for x in group], np.int64)
        ends = np.cumsum(sizes)
        begins = ends - sizes
        entry_end = np.repeat(ends, sizes)
        # The first new character of each entry: n-grams ending before it
        # belong to the window before.
        fresh = np.where(np.array(numbers) < 0, np.minimum(longest - 1, sizes), 0) + begins
        fresh_at = np.repeat(fresh, sizes)
        place = np.arange(len(chars))
        value = np.zeros(len(chars), np.uint64)
        buckets, owners = [], []
        entry = np.repeat(np.arange(len(group)), sizes)
        for n in range(1, longest + 1):
            value = value[:len(chars) - n + 1] * np.uint64(0x100000001B3) + chars[n - 1:] + np.uint64(1)
            if n in orders:
                mixed = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9 + 2 * n)
                last = place[:len(value)] + n
                good = (last <= entry_end[:len(value)]) & (last > fresh_at[:len(value)])
                buckets.append((mixed >> shift)[good].astype(np.int32))
                owners.append(entry[:len(value)][good])
        if len(orders) == 1:
            owner, bucket = owners[0], buckets[0]
            counts = np.bincount(owner, minlength=len(group))
        else:
            # Put the orders of one entry side by side.
            per = [np.bincount(o, minlength=len(group)) for o in owners]
            counts = np.sum(per, 0)
            base = np.concatenate([[0], np.cumsum(counts)[:-1]])
            bucket = np.empty(counts.sum(), np.int32)
            for k, (o, b) in enumerate(zip(owners, buckets, strict=True)):
                before = np.concatenate([[0], np.cumsum(per[k])[:-1]])
                bucket[(base + np.sum(per[:k], 0, dtype=np.int64) - before)[o] + np.arange(len(o))] = b
        offsets = np.concatenate([[0], np.cumsum(counts)])
        yield np.array([i if i >= 0 else ~i for i in numbers]), offsets, bucket


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values[offsets[j]:offsets[j + 1]]``, zero where empty."""
    out = np.zeros(len(offsets) - 1, np.float64)
    some = np.flatnonzero(np.diff(offsets) > 0)
    if len(some):
        out[some] = np.add.reduceat(values, offsets[some], dtype=np.float64)
    return out


#: Counts that are summed together; tasks whose sums are combined first.
BLOCK, SPREAD = 4096, 64
BLOCK_SCHEMA = "key string, block int, counts array<bigint>"


def block_batches(counts: dict, size: int) -> Iterator[pa.RecordBatch]:
    """A task's count vectors by key, cut into blocks."""
    for key, total in counts.items():
        for block in range(0, size, BLOCK):
            yield pa.RecordBatch.from_arrays([
                pa.array([str(key)]), pa.array([block // BLOCK], pa.int32()),
                pa.array([total[block:block + BLOCK].tolist()], pa.list_(pa.int64()))], names=["key", "block", "counts"])


def _added(group: pd.DataFrame) -> pd.DataFrame:
    out = group.iloc[:1][["key", "block"]].copy()
    out["counts"] = [np.sum(np.stack(group["counts"].to_numpy()), 0)]
    return out


def summed_blocks(parts: DataFrame, size: int) -> dict[str, np.ndarray]:
    """Count vectors of ``size`` by key, summed over tasks in two steps, so
    that no task holds what all tasks counted. The caller bounds the keys."""
    parts = parts.groupBy("key", "block", F.pmod(F.spark_partition_id(), F.lit(SPREAD))).applyInPandas(_added, BLOCK_SCHEMA)
    total = parts.groupBy("key", "block").applyInPandas(_added, BLOCK_SCHEMA)
    out: dict[str, np.ndarray] = {}
    for r in total.toLocalIterator():
        at = r["block"] * BLOCK
        out.setdefault(r["key"], np.zeros(size, np.int64))[at:at + BLOCK] = r["counts"]
    return out
