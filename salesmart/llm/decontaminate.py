"""Benchmark decontamination with an FM-index per shard of training text.

A task takes its documents in shards of bounded size. A shard's words become
symbols of the benchmark's vocabulary; every other word is a separator, and a
run between separators that is shorter than the shortest window is left out,
as no window fits in it. Over the remaining runs the shard builds a suffix
array, its Burrows-Wheeler transform, a wavelet matrix for rank queries and a
sample of suffix positions. All windows are then searched backwards at once,
their occurrences located through the sampled positions and merged into spans.

A window is ``WINDOW`` consecutive words of an item; an item with fewer words,
but not none, is one window. The benchmark is used in blocks of at most
``BLOCK_BYTES`` of text, so a driver or broadcast never holds more of it.

Defined cases: null or wordless text has no words and no hits; a null item
text has no windows; an item without id still marks words but is not listed;
rows with equal doc_id are judged one by one; an empty table gives an empty
result; an empty benchmark gives zero hits. Only ``doc_id``/``text`` and
``item_id``/``text`` are used, so further columns cannot clash.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.scratch import kept
from salesmart.llm.textkit import grouped, joined_words, workers_ready, words_of

WINDOW = 10
#: Benchmark text in one block (one broadcast).
BLOCK_BYTES = 32_000_000
#: Words in one FM-index.
SHARD_WORDS = 500_000
#: Every so many positions of the indexed text keep their suffix position.
SAMPLE_STEP = 16


@dataclass
class Windows:
    """A block of the benchmark: vocabulary (sorted hashes; symbol = rank + 1),
    and by window length the distinct windows with the items that hold them."""

    vocabulary: np.ndarray
    by_length: dict[int, tuple[np.ndarray, list[frozenset]]]

    @property
    def shortest(self) -> int:
        return min(self.by_length, default=0)


def windows_of(items: list[tuple], window: int = WINDOW) -> Windows:
    """``items``: (item_id, text) pairs."""
    hashed = [(i, words_of((t or "").encode("utf-8", "replace"))[2]) for i, t in items]
    hashed = [(i, h) for i, h in hashed if len(h)]
    vocabulary = np.unique(np.concatenate([h for _, h in hashed])) if hashed else np.empty(0, np.uint64)
    found: dict[int, dict[tuple, set]] = {}
    for item, hashes in hashed:
        symbols = np.searchsorted(vocabulary, hashes) + 1
        size = min(window, len(symbols))
        for row in np.lib.stride_tricks.sliding_window_view(symbols, size).tolist():
            found.setdefault(size, {}).setdefault(tuple(row), set()).add(item)
    return Windows(vocabulary, {
        size: (np.array(list(rows), np.int64), [frozenset(x) for x in rows.values()])
        for size, rows in found.items()})


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; each separator (0) is smaller than any
    word and than every later separator, so no comparison passes one."""
    n = len(symbols)
    stops = symbols == 0
    rank = symbols + int(stops.sum())
    rank[stops] = np.arange(stops.sum())
    order = np.argsort(rank, kind="stable")
    width = 1
    while True:
        second = np.zeros(n, np.int64)
        second[:-width or n] = rank[width:] + 1
        key = rank * np.int64(n + len(symbols) + 2) + second if width > 1 else rank * np.int64(rank.max() + 2) + second
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
        if rank[order[-1]] == n - 1:
            return order
        width *= 2


class FMIndex:
    """Backward search and locate over an array of symbols (0 separates)."""

    def __init__(self, symbols: np.ndarray, sigma: int, step: int = SAMPLE_STEP):
        symbols = symbols.astype(np.int64)
        order = suffix_array(symbols)
        self.n = len(symbols)
        bwt = symbols[order - 1]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=sigma + 1))])
        # Wavelet matrix: per bit, high to low, zeros before each place.
        self.zeros = []
        level = bwt
        self.bits = max(1, int(sigma).bit_length())
        for bit in range(self.bits - 1, -1, -1):
            one = (level >> bit) & 1
            before = np.zeros(self.n + 1, np.int32)
            np.cumsum(1 - one, out=before[1:])
            self.zeros.append(before)
            level = np.concatenate([level[one == 0], level[one == 1]])
        # Sampled positions: every step-th, and each run's first, where the
        # walk to the left would meet a separator.
        self.bwt = bwt.astype(np.int32)
        kept = (order % step == 0) | (bwt == 0)
        self.sampled = np.where(kept, order, -1)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Times the symbol stands before place ``at`` of the transform."""
        low, high = np.zeros_like(at), at.copy()
        for level, before in enumerate(self.zeros):
            one = ((symbol >> (self.bits - 1 - level)) & 1).astype(bool)
            total = before[-1]
            low = np.where(one, total + low - before[low], before[low])
            high = np.where(one, total + high - before[high], before[high])
        return high - low

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pattern number, low, high) of the patterns that occur."""
        which = np.arange(len(patterns))
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        for j in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[which, j]
            low = self.before[symbol] + self.rank(symbol, low)
            high = self.before[symbol] + self.rank(symbol, high)
            alive = high > low
            which, low, high = which[alive], low[alive], high[alive]
        return which, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows of the suffix array."""
        out = np.empty(len(rows), np.int64)
        todo, at, steps = np.arange(len(rows)), rows.copy(), 0
        while len(todo):
            found = self.sampled[at]
            done = found >= 0
            out[todo[done]] = found[done] + steps
            todo, at = todo[~done], at[~done]
            symbol = self.bwt[at].astype(np.int64)
            at = self.before[symbol] + self.rank(symbol, at)
            steps += 1
        return out


def occurrences(hashes: np.ndarray, bounds: np.ndarray, windows: Windows) -> Iterator[tuple[int, list[frozenset], np.ndarray, np.ndarray]]:
    """(window length, item sets, window numbers, first words) found in a
    shard: ``hashes`` of its words, text i having ``bounds[i]:bounds[i + 1]``."""
    if not windows.by_length or not len(hashes):
        return
    vocabulary = windows.vocabulary
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    symbols = np.where(vocabulary[at] == hashes, at + 1, 0)
    # Runs of vocabulary words inside one text.
    edge = np.zeros(len(symbols) + 1, bool)
    edge[bounds] = True
    inside = symbols > 0
    begins = inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]]))
    ends = inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    long = last - first >= windows.shortest
    first, last = first[long], last[long]
    if not len(first):
        return
    sizes = last - first
    place = np.concatenate([[0], np.cumsum(sizes + 1)])  # run starts in the indexed text
    text = np.zeros(place[-1], np.int64)
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    text[np.repeat(place[:-1], sizes) + within] = symbols[np.repeat(first, sizes) + within]
    index = FMIndex(text, len(vocabulary))
    for size, (patterns, items) in windows.by_length.items():
        which, low, high = index.search(patterns)
        if not len(which):
            continue
        counts = high - low
        rows = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts)
        found = index.locate(rows)
        run = np.searchsorted(place, found, side="right") - 1
        yield size, items, np.repeat(which, counts), first[run] + found - place[run]


def scan_shard(group: list[bytes], windows: Windows) -> list[tuple[int, list[tuple[int, int]], set, list[tuple[int, int]]]]:
    """Per text: (words, merged spans in words, item ids, the spans in bytes)."""
    starts, ends, hashes, offsets, bounds = joined_words(group)
    cover = np.zeros(len(hashes) + 1, np.int64)
    items: dict[int, set] = {}
    for size, held, which, first in occurrences(hashes, bounds, windows):
        np.add.at(cover, first, 1)
        np.add.at(cover, first + size, -1)
        text = np.searchsorted(bounds, first, side="right") - 1
        for t, w in np.unique(np.stack([text, which], 1), axis=0).tolist():
            items.setdefault(t, set()).update(held[w])
    hit = np.zeros(len(hashes) + 2, np.int8)
    hit[1:-1] = np.cumsum(cover[:-1]) > 0
    edge = np.zeros(len(hashes) + 1, bool)
    edge[bounds] = True
    begins = np.flatnonzero((hit[1:-1] == 1) & ((hit[:-2] == 0) | edge[:-1]))
    stops = np.flatnonzero((hit[1:-1] == 1) & ((hit[2:] == 0) | edge[1:])) + 1
    spans: dict[int, list] = {}
    for t, a, b in zip((np.searchsorted(bounds, begins, side="right") - 1).tolist(), begins.tolist(), stops.tolist(), strict=True):
        spans.setdefault(t, []).append((a, b))
    out = []
    for t in range(len(group)):
        mine = spans.get(t, [])
        out.append((int(bounds[t + 1] - bounds[t]), [(a - int(bounds[t]), b - int(bounds[t])) for a, b in mine],
                    items.get(t, set()), [(int(starts[a] - offsets[t]), int(ends[b - 1] - offsets[t])) for a, b in mine]))
    return out


def merged(*lists: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open spans; spans that only touch are merged too."""
    out: list[list[int]] = []
    for a, b in sorted(x for spans in lists for x in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def without(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text less the byte spans."""
    out, at = [], 0
    for a, b in spans:
        out.append(data[at:a])
        at = b
    return b"".join([*out, data[at:]])


def benchmark_blocks(benchmark: DataFrame, limit: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """The benchmark's (item_id, text) rows in blocks of about ``limit`` bytes."""
    rows = benchmark.select("item_id", "text").filter(F.col("text").isNotNull())
    total = rows.agg(F.sum(F.octet_length("text") + 32)).first()[0] or 0
    n = math.ceil(total / limit)
    for k in range(n):
        block = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else rows
        yield [tuple(r) for r in block.collect()]


SPAN = "array<struct<start:bigint,end:bigint>>"
_SPAN_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _as_structs(spans):
    return [{"start": a, "end": b} for a, b in spans]


def find_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, spans (in words), byte_spans (in UTF-8 bytes) and
    items (distinct item ids as strings, sorted) of every row of ``docs``."""
    spark = docs.sparkSession
    workers_ready(spark)
    helds = [spark.sparkContext.broadcast(windows_of(b, window)) for b in benchmark_blocks(benchmark)]
    helds = helds or [spark.sparkContext.broadcast(windows_of([], window))]
    return _scanned(docs.select("doc_id", "text"), helds).drop("text")


def _scanned(rows: DataFrame, helds: list) -> DataFrame:
    """``rows`` (with a text) and the spans of all blocks in it."""
    out = rows.select(
        "*", F.lit(0).cast("bigint").alias("n_words"), F.expr(f"cast(array() as {SPAN})").alias("spans"),
        F.expr(f"cast(array() as {SPAN})").alias("byte_spans"), F.expr("cast(array() as array<string>)").alias("items"))
    schema = out.schema
    for held in helds:
        out = out.mapInArrow(_scanner(held), schema)
    return out


def _shards(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    # An English word takes about six bytes; what matters is that it is bounded.
    yield from grouped(texts, SHARD_WORDS * 6)


def _scanner(held):
    def scan(batches):
        for batch in _gathered(batches):
            texts = batch.column("text").to_pylist()
            found = [x for _, group in _shards(texts) for x in scan_shard(group, held.value)]
            old = {k: batch.column(k).to_pylist() for k in ("spans", "byte_spans", "items")}
            pairs = {k: [[(s["start"], s["end"]) for s in x] for x in old[k]] for k in ("spans", "byte_spans")}
            own = batch.schema.names[:-4]
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in own),
                pa.array([x[0] for x in found], pa.int64()),
                pa.array([_as_structs(merged(a, x[1])) for a, x in zip(pairs["spans"], found, strict=True)], _SPAN_ARROW),
                pa.array([_as_structs(merged(a, x[3])) for a, x in zip(pairs["byte_spans"], found, strict=True)], _SPAN_ARROW),
                pa.array([sorted({*a, *(str(i) for i in x[2] if i is not None)}) for a, x in zip(old["items"], found, strict=True)], pa.list_(pa.string())),
            ], names=[*own, "n_words", "spans", "byte_spans", "items"])

    return scan


def _gathered(batches, limit: int = SHARD_WORDS * 6):
    """Joins small Arrow batches up to about a shard's bytes."""
    kept, size = [], 0
    for batch in batches:
        kept.append(batch)
        size += batch.nbytes
        if size >= limit:
            yield from pa.Table.from_batches(kept).combine_chunks().to_batches()
            kept, size = [], 0
    if kept:
        yield from pa.Table.from_batches(kept).combine_chunks().to_batches()


def digest(spans: DataFrame) -> DataFrame:
    """The report of ``find_spans``: one row per document row."""
    hits = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    return spans.select(
        "doc_id", "n_words", hits.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (hits > 0).alias("contaminated"))


def cleaned(texts: list[str | None], windows: Windows) -> list[tuple[str | None, bool, bool]]:
    """(text less every benchmark span, was hit, has words left) per text. A
    cut can bring words together, so changed texts are scanned again."""
    out: list = [(t, False, True) for t in texts]
    todo = [i for i, t in enumerate(texts) if t]
    while todo:
        changed = []
        for first, group in _shards([out[i][0] for i in todo]):
            for k, (n_words, spans, _, places) in enumerate(scan_shard(group, windows)):
                i = todo[first + k]
                if spans:
                    left = n_words - sum(b - a for a, b in spans)
                    out[i] = (without(group[k], places).decode("utf-8"), True, left > 0)
                    changed.append(i)
        todo = changed
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with its own columns: benchmark spans cut out of ``text``
    (``n_chars`` follows where there is such a column); a document of which
    no word is left goes. Documents without a hit stay as they are."""
    spark: SparkSession = docs.sparkSession
    workers_ready(spark)
    helds = [spark.sparkContext.broadcast(windows_of(b, window)) for b in benchmark_blocks(benchmark)]
    if len(helds) > 1:
        return _cut_in_rounds(docs, helds)
    for held in helds:
        docs = docs.mapInArrow(_cutter(held), docs.schema)
    return docs


def _cut_in_rounds(docs: DataFrame, helds: list) -> DataFrame:
    """``decontaminate`` by several blocks: the spans of all are found on the
    same text and cut together; texts that changed go through all blocks again."""
    others = [c for c in docs.schema.fields if c.name != "text"]
    row = F.struct(F.lit(0).alias("llm_none"), *(docs[f"`{c.name}`"].alias(f"c{k}") for k, c in enumerate(others)))
    rows = docs.select(row.alias("row"), "text", F.lit(False).alias("hit"))
    done = []
    while True:
        found = kept(_scanned(rows, helds).mapInArrow(
            _span_cutter, f"row {rows.schema['row'].dataType.simpleString()}, text string, hit boolean, changed boolean, has_words boolean"), "decontaminate-round")
        done.append(found.filter("not changed"))
        rows = found.filter("changed and has_words").select("row", "text", "hit")
        if rows.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    columns = {c.name: F.col(f"row.c{k}") for k, c in enumerate(others)} | {"text": F.col("text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("hit"), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(columns["n_chars"])
    return out.select(*(columns[c].alias(c) for c in docs.columns))


def _span_cutter(batches):
    """Rows with the byte spans of all blocks to rows less those spans."""
    for batch in batches:
        texts, spans, hit = (batch.column(c).to_pylist() for c in ("text", "byte_spans", "hit"))
        left = [n - sum(s["end"] - s["start"] for s in x) for n, x in zip(*(batch.column(c).to_pylist() for c in ("n_words", "spans")), strict=True)]
        out = [without(t.encode("utf-8", "replace"), [(s["start"], s["end"]) for s in x]).decode("utf-8") if x else t
               for t, x in zip(texts, spans, strict=True)]
        changed = [bool(x) for x in spans]
        yield pa.RecordBatch.from_arrays([
            batch.column("row"), pa.array(out, pa.string()), pa.array([a or b for a, b in zip(hit, changed, strict=True)], pa.bool_()),
            pa.array(changed, pa.bool_()), pa.array([n > 0 for n in left], pa.bool_())], names=["row", "text", "hit", "changed", "has_words"])


def _cutter(held):
    def cut(batches):
        for batch in _gathered(batches):
            found = cleaned(batch.column("text").to_pylist(), held.value)
            columns = {name: batch.column(name) for name in batch.schema.names}
            columns["text"] = pa.array([x[0] for x in found], batch.schema.field("text").type)
            if "n_chars" in columns:
                sizes = columns["n_chars"].to_pylist()
                columns["n_chars"] = pa.array([len(x[0]) if x[1] else n for x, n in zip(found, sizes, strict=True)], batch.schema.field("n_chars").type)
            keep = pa.array([x[2] for x in found], pa.bool_())
            yield pa.RecordBatch.from_arrays(list(columns.values()), schema=batch.schema).filter(keep)

    return cut


def items_digest(items: set) -> str:
    """The digest of item ids, for tests."""
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
