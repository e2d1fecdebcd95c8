"""Near-duplicate documents by consistent weighted sampling.

A document is the weighted set of its five-word shingles (a text of fewer words
is one shingle), a shingle's weight being its count in the text times an
inverse document frequency. The factor runs from 1 (in every document) to 2 (in
one), so that a passage which thousands share still counts.

Frequencies are exact at every size. Documents are dealt to parts by a hash;
each part sends its distinct shingle hashes, with its own counts, to buckets by
hash; a bucket sums them and sends each part the frequencies of two or more of
the hashes it asked for (all others are 1). Parts and buckets grow in number
with the text, so neither outgrows a task, and no table of frequencies is held
in one place.

Improved consistent weighted sampling draws, for each of ``BANDS * ROWS``
seeds, one (shingle, level) of a document; two documents draw the same with the
probability of their weighted Jaccard similarity. The draws of a band hash to
a key. Texts of equal words are one class; classes that share a key are
candidates, and weighted Jaccard similarity of their whole shingle sets decides.

Candidates are not expanded to all pairs: each class of a key is first verified
against the key's class with the least doc_id, and verified links are united.
Classes of keys whose members then are in different components are compared by
an exact similarity join: their rarest shingles, up to a fifth of the weight,
are joined, and a pair of different components is verified unless its total
weights or what they can still have in common after the first common shingle
rule it out. No link that could join two groups is lost.

Defined cases: null or wordless text, or a null doc_id, is alike to nothing;
rows with equal doc_id and text are one document, with equal doc_id and other
text several; ties go to the least doc_id; an empty table gives an empty
result; operators here use ``doc_id`` and ``text`` only, and ``deduplicated``
returns the input's own columns, so other columns cannot clash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from salesmart.llm.components import components
from salesmart.llm.scratch import kept, removed, shuffles_freed
from salesmart.llm.textkit import grouped, joined_words, mix64, workers_ready

SHINGLE, THRESHOLD = 5, 0.8
#: A pair at the threshold shares a key with probability 1 - (1 - 0.8^4)^18 = 0.9999.
BANDS, ROWS = 18, 4
#: Bytes of text in a part and, as shingles, in a bucket; least numbers of them.
PART_BYTES, BUCKET_BYTES = 16_000_000, 32_000_000
PARTS, BUCKETS = 1024, 512

_SEEDS = mix64(np.arange(1, 1 + BANDS * ROWS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


#: Bytes of text whose draws are made together: their arrays stay in cache.
DRAW_BYTES = 250_000


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Quantiles of Gamma(2, 1), as they are and as logarithms, for 16 bits."""
    x = np.concatenate([[0], np.geomspace(1e-6, 40, 200_000)])
    at = (np.arange(1 << 16) + 0.5) / (1 << 16)
    gamma = np.interp(at, 1 - np.exp(-x) * (1 + x), x)
    return gamma.astype(np.float32), np.log(gamma).astype(np.float32)


_GAMMA, _LOG_GAMMA = _tables()


@dataclass
class Shingles:
    """Distinct shingles of a group of texts: text i has those from
    ``bounds[i]`` to ``bounds[i + 1]``, in order of their hash, with counts;
    ``keys`` are two hashes of each text's words, ``sizes`` the word counts."""

    bounds: np.ndarray
    hashes: np.ndarray
    counts: np.ndarray
    keys: np.ndarray
    sizes: np.ndarray


def shingles(group: list[bytes], width: int = SHINGLE) -> Shingles:
    _, _, words, _, bounds = joined_words(group)
    sizes = np.diff(bounds)
    n = np.where(sizes >= width, sizes - width + 1, np.minimum(sizes, 1))
    owner = np.repeat(np.arange(len(group)), n)
    first = bounds[:-1][owner] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    span = np.minimum(sizes, width)[owner]
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    value = span.astype(np.uint64)
    for k in range(width):
        value = mix64(value * np.uint64(0x100000001B3) + np.where(k < span, padded[first + k], np.uint64(0)))
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    # Keys of the word sequences: sums of words mixed with their places.
    place = np.arange(len(words)) - np.repeat(bounds[:-1], sizes)
    keys = np.zeros((2, len(group)), np.uint64)
    some = np.flatnonzero(sizes > 0)
    for k in range(2):
        if len(some):
            mixed = mix64(words + mix64(place.astype(np.uint64) * np.uint64(2) + np.uint64(k + 1)))
            keys[k, some] = np.add.reduceat(mixed, bounds[:-1][some])
    return Shingles(np.searchsorted(owner[at], np.arange(len(group) + 1)), value[at],
                    np.diff(np.append(at, len(value))), keys, sizes)


@dataclass
class Weights:
    """Inverse document frequency factors, among ``n`` documents: ``found`` are
    shingle hashes in order, ``frequencies`` theirs; all other shingles are in
    one document."""

    found: np.ndarray
    frequencies: np.ndarray
    n: int

    def factors(self, hashes: np.ndarray) -> np.ndarray:
        frequency = np.ones(len(hashes))
        if len(self.found):
            at = np.minimum(np.searchsorted(self.found, hashes), len(self.found) - 1)
            frequency = np.where(self.found[at] == hashes, self.frequencies[at], frequency)
        return 1 + np.log1p(self.n / frequency) / np.log1p(self.n)

    def of(self, hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.factors(hashes) * counts


def _wordy(docs: DataFrame) -> DataFrame:
    """The rows whose text has a word."""
    return docs.filter(F.col("text").isNotNull() & F.col("text").rlike(r"[0-9A-Za-z]|[^\x00-\x7F]"))


def _lists(arrays: list[np.ndarray], kind) -> pa.ListArray:
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate([*arrays, np.empty(0, kind)]).astype(kind)))


def _flat(column: pa.ChunkedArray, kind) -> tuple[np.ndarray, np.ndarray]:
    """(values, lengths) of a column of lists."""
    lengths = column.combine_chunks().value_lengths().to_numpy() if len(column) else np.empty(0, np.int64)
    values = [c.flatten().to_numpy() for c in column.chunks]
    return np.concatenate([*values, np.empty(0, kind)]).astype(kind), lengths


def _asker(buckets: int):
    """A part's texts to its distinct shingles, by bucket."""
    def run(table: pa.Table) -> pa.Table:
        hashes = [shingles(group).hashes for _, group in grouped(table.column("text").to_pylist())]
        hashes, counts = np.unique(np.concatenate(hashes), return_counts=True)
        # Unsigned products of the high half: buckets are runs of sorted hashes.
        bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        at = np.flatnonzero(np.diff(bucket.astype(np.int64), prepend=-1))
        part = table.column("part")[0].as_py()
        return pa.table({
            "bucket": pa.array(bucket[at].astype(np.int32)), "part": pa.array(np.full(len(at), part), pa.int32()),
            "hashes": _lists(np.split(hashes.view(np.int64), at[1:]), np.int64), "counts": _lists(np.split(counts, at[1:]), np.int32)})

    return run


def _answered(table: pa.Table) -> pa.Table:
    """A bucket's rows to, by part, its shingles that are in several documents."""
    hashes, lengths = _flat(table.column("hashes"), np.int64)
    counts, _ = _flat(table.column("counts"), np.int64)
    _, at = np.unique(hashes, return_inverse=True)
    frequency = np.bincount(at, weights=counts).astype(np.int64)[at]
    several = frequency > 1
    owner = np.repeat(np.arange(len(lengths)), lengths)[several]
    cuts = np.searchsorted(owner, np.arange(1, len(lengths)))
    answer = pa.table({
        "part": table.column("part").combine_chunks(), "hashes": _lists(np.split(hashes[several], cuts), np.int64),
        "frequencies": _lists(np.split(frequency[several], cuts), np.int64)})
    return answer.filter(pa.array(np.bincount(owner, minlength=len(lengths)) > 0))


def _weights(answers: pa.Table, n: int) -> Weights:
    found = _flat(answers.column("hashes"), np.int64)[0].view(np.uint64)
    order = np.argsort(found)
    return Weights(found[order], _flat(answers.column("frequencies"), np.int64)[0][order], n)


@dataclass
class Frequencies:
    """Document frequencies of the shingles of ``docs``: ``answers`` holds, by
    part, those of two or more; ``n`` is the number of documents."""

    answers: DataFrame
    n: int
    parts: int

    def part(self, docs: DataFrame) -> DataFrame:
        return docs.withColumn("part", F.pmod(F.xxhash64("doc_id", "text"), F.lit(self.parts)).cast("int"))

    def weighted(self, docs: DataFrame, fn, schema: str) -> DataFrame:
        """``fn(rows, weights)`` of each part of ``docs`` (rows with doc_id and
        text that were counted), as record batches."""
        n = self.n

        def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
            if not len(rows):
                return empty
            return pa.Table.from_batches(list(fn(rows.combine_chunks(), _weights(answers, n))), empty.schema)

        empty = to_arrow_schema(docs.sparkSession.createDataFrame([], schema).schema).empty_table()
        return self.part(docs).groupBy("part").cogroup(self.answers.groupBy("part")).applyInArrow(run, schema)


def frequencies(docs: DataFrame) -> Frequencies:
    """Exact document frequencies over all rows of ``docs``."""
    docs = _wordy(docs.select("doc_id", "text"))
    n, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts, buckets = max(PARTS, math.ceil(size / PART_BYTES)), max(BUCKETS, math.ceil(size / BUCKET_BYTES))
    out = Frequencies(None, n, parts)
    asked = out.part(docs).groupBy("part").applyInArrow(_asker(buckets), "bucket int, part int, hashes array<bigint>, counts array<int>")
    answers = asked.groupBy("bucket").applyInArrow(_answered, "part int, hashes array<bigint>, frequencies array<bigint>")
    out.answers = kept(answers, "neardup-frequencies")
    return out


def fitted_weights(docs: DataFrame) -> Weights:
    """The factors of all shingles of ``docs``, on the driver: for tables whose
    shared shingles fit there. ``classes`` never collects them."""
    found = frequencies(docs)
    rows = found.answers.select(F.explode(F.arrays_zip("hashes", "frequencies")).alias("e")).select("e.*").distinct().toArrow()
    hashes = rows.column("hashes").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return Weights(hashes[order], rows.column("frequencies").to_numpy()[order], found.n)


def draws(s: Shingles, weights: np.ndarray) -> np.ndarray:
    """The band keys (texts x BANDS) of texts that have shingles, in order."""
    some = np.flatnonzero(np.diff(s.bounds) > 0)
    begins = s.bounds[:-1][some]
    owner = np.repeat(np.arange(len(some)), np.diff(s.bounds)[some])
    log_weight = np.log(weights).astype(np.float32)
    out = np.zeros((len(some), BANDS), np.uint64)
    for k, seed in enumerate(_SEEDS):
        u = (s.hashes ^ seed) * np.uint64(0x9E3779B97F4A7C15)
        u ^= u >> np.uint64(29)
        u *= np.uint64(0xBF58476D1CE4E5B9)
        parts = u.view(np.uint16).reshape(-1, 4)  # two draws and a shift
        r = _GAMMA[parts[:, 3]]
        shift = parts[:, 2].astype(np.float32) * np.float32(1 / 65536)
        level = np.floor(log_weight / r + shift)
        rank = _LOG_GAMMA[parts[:, 1]] - r * (level - shift + 1)
        least = np.minimum.reduceat(rank, begins)
        at = np.flatnonzero(rank == least[owner])
        chosen = np.empty(len(some), np.int64)
        chosen[owner[at][::-1]] = at[::-1]  # the first of equal ranks
        drawn = mix64(s.hashes[chosen] + level[chosen].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        out[:, k // ROWS] = mix64(out[:, k // ROWS] * np.uint64(0x100000001B3) + drawn)
    return out


def _signed(rows: pa.Table, weighting: Weights):
    ids, text_keys = (rows.column(c).combine_chunks() for c in ("doc_id", "text_key"))
    for first, group in grouped(rows.column("text").to_pylist(), DRAW_BYTES):
        s = shingles(group)
        some = np.flatnonzero(s.sizes > 0)
        if not len(some):
            continue
        weights = weighting.of(s.hashes, s.counts)
        bands = draws(s, weights)
        total = np.add.reduceat(weights, s.bounds[:-1][some])
        flat = pa.array(bands.view(np.int64).ravel())
        yield pa.RecordBatch.from_arrays([
            ids.take(pa.array(first + some)), text_keys.take(pa.array(first + some)),
            pa.array(s.keys[0, some].view(np.int64)), pa.array(s.keys[1, some].view(np.int64)),
            pa.array(total), pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, BANDS, dtype=np.int32)), flat)],
            names=["doc_id", "text_key", "key", "key2", "total", "bands"])


def _sets(rows: pa.Table, weighting: Weights):
    """The shingle sets of the rows (node, text) whose text has the node's key."""
    nodes = rows.column("node").combine_chunks().to_numpy()
    for first, group in grouped(rows.column("text").to_pylist()):
        s = shingles(group)
        right = np.flatnonzero(s.keys[0].view(np.int64) == nodes[first:first + len(group)])
        if not len(right):
            continue
        spans = [slice(s.bounds[i], s.bounds[i + 1]) for i in right]
        factors = weighting.factors(s.hashes)
        yield pa.RecordBatch.from_arrays([
            pa.array(nodes[first + right]), _lists([s.hashes[x].view(np.int64) for x in spans], np.int64),
            _lists([s.counts[x] for x in spans], np.int32), _lists([factors[x] for x in spans], np.float64)],
            names=["node", "hashes", "counts", "factors"])


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of (sorted hashes, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = np.minimum(a[1][i], b[1][j]).sum()
    return common / (a[1].sum() + b[1].sum() - common)


def _set_of(batch: pa.RecordBatch, i: int, side: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, counts, factors) of a row."""
    hashes, counts, factors = (batch.column(c + side)[i].values.to_numpy() for c in ("hashes", "counts", "factors"))
    return hashes.view(np.uint64), counts, factors


def _verified(batches):
    """Pairs with their shingle sets to pairs with their similarity."""
    for batch in batches:
        found = []
        for i in range(len(batch)):
            sides = [_set_of(batch, i, side) for side in ("_a", "_b")]
            found.append(similarity(*((hashes, factors * counts) for hashes, counts, factors in sides)))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(found, pa.float64())], names=["a", "b", "similar"])


def _prefixes(threshold: float):
    """A node's shingle set to (node, total, tokens, befores): its shingles in
    order of rarity, then hash, until they outweigh what similar texts may
    differ in, and the weight before each."""
    def run(batches):
        for batch in batches:
            rows: list[list] = [[], [], []]
            for i in range(len(batch)):
                hashes, counts, factor = _set_of(batch, i)
                order = np.lexsort((hashes, -factor))
                weight = (factor * counts)[order]
                before = np.cumsum(weight) - weight
                total = float(weight.sum())
                n = int(np.searchsorted(before, (1 - threshold) * total + 1e-6, side="right"))
                for column, value in zip(rows, (total, hashes[order][:n].view(np.int64), before[:n]), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([
                batch.column("node"), pa.array(rows[0], pa.float64()), pa.array(rows[1], pa.list_(pa.int64())),
                pa.array(rows[2], pa.list_(pa.float64()))], names=["node", "total", "tokens", "befores"])

    return run


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, text_key, key, class_id, n_copies of every row with words:
    class_id is the least doc_id of the documents linked directly or over
    others, n_copies the number of documents with the same words, text_key a
    hash of the text, which tells texts of one doc_id apart."""
    with shuffles_freed(docs.sparkSession):
        return _classes(docs, threshold)


def _classes(docs: DataFrame, threshold: float) -> DataFrame:
    spark = docs.sparkSession
    workers_ready(spark)
    docs = docs.select("doc_id", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    counted = frequencies(docs)
    signed = kept(counted.weighted(
        _wordy(docs).withColumn("text_key", F.xxhash64("text")), _signed, f"doc_id {id_type}, text_key bigint, key bigint, key2 bigint, total double, bands array<bigint>"), "neardup-signed")
    nodes = kept(signed.filter("doc_id is not null").groupBy("key").agg(
        F.min("doc_id").alias("rep"), F.countDistinct("doc_id").alias("n_copies"),
        F.first("total").alias("total"), F.first("bands").alias("bands")), "neardup-nodes")
    members = nodes.select(F.posexplode("bands").alias("band", "value"), F.col("key").alias("node"), "rep")
    # A key's first class is its leader; a key with one class has no pairs.
    leaders = members.groupBy("band", "value").agg(F.min(F.struct("rep", "node"))["node"].alias("leader"), F.count("*").alias("n")).filter("n > 1")
    shared = kept(members.join(leaders, ["band", "value"]).select("band", "value", "node", "leader"), "neardup-shared")
    pairs = shared.filter("node != leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    needed = shared.select("node").distinct().join(nodes.select(F.col("key").alias("node"), "rep"), "node")
    texts = _wordy(docs).join(needed.withColumnRenamed("rep", "doc_id"), "doc_id").select("doc_id", "text", "node")
    sets = kept(counted.weighted(texts, _sets, "node bigint, hashes array<bigint>, counts array<int>, factors array<double>")
                .dropDuplicates(["node"]), "neardup-sets")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        sides = [sets.select(F.col("node").alias(c), *(F.col(x).alias(f"{x}_{c}") for x in ("hashes", "counts", "factors"))) for c in ("a", "b")]
        rows = pairs.join(sides[0], "a").join(sides[1], "b")
        return kept(rows.mapInArrow(_verified, "a bigint, b bigint, similar double"), name)

    first = verified(pairs, "neardup-led")
    groups = components(first.filter(F.col("similar") >= threshold).select("a", "b"), "neardup-components")
    # What a leader did not unite: classes of a key in different components.
    label = F.coalesce("component", "node").alias("group")
    labelled = shared.join(groups, "node", "left").select("band", "value", "node", label)
    apart = labelled.groupBy("band", "value").agg(F.min("group").alias("low"), F.max("group").alias("high")).filter("low < high")
    rest = kept(labelled.join(apart.select("band", "value"), ["band", "value"]).select("node", "group").distinct(), "neardup-rest")
    prefixes = (sets.join(rest.select("node"), "node")
                .mapInArrow(_prefixes(threshold), "node bigint, total double, tokens array<bigint>, befores array<double>"))
    entries = (prefixes.join(rest, "node").select("node", "group", "total", F.explode(F.arrays_zip("tokens", "befores")).alias("e"))
               .select("node", "group", "total", F.col("e.tokens").alias("token"), F.col("e.befores").alias("before")))
    entries = kept(entries, "neardup-prefixes")
    left, right = (entries.select("token", *(F.col(c).alias(f"{c}_{side}") for c in ("node", "group", "total", "before"))) for side in "ab")
    slack = 1 - 1e-9
    ratio = F.least("total_a", "total_b") >= F.greatest("total_a", "total_b") * threshold * slack
    common = (F.least(F.col("total_a") - F.col("before_a"), F.col("total_b") - F.col("before_b"))
              >= (F.col("total_a") + F.col("total_b")) * (threshold / (1 + threshold) * slack))
    same = left["token"] == right["token"]
    more = (left.join(right, same & (F.col("node_a") < F.col("node_b")) & (F.col("group_a") != F.col("group_b")) & ratio & common)
            .select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct())
    second = verified(more, "neardup-more").filter(F.col("similar") >= threshold).select("a", "b")
    links = groups.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(second)
    groups = components(links, "neardup-components")
    known = nodes.select("key", "rep", "n_copies").join(groups.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    least = known.groupBy("component").agg(F.min("rep").alias("class_id"))
    known = known.join(least, "component").select("key", "class_id", "n_copies")
    found = signed.filter("doc_id is not null").select("doc_id", "text_key", "key").join(known, "key").select("doc_id", "text_key", "key", "class_id", "n_copies")
    removed(spark, sets, counted.answers)
    return found


def report(docs: DataFrame, found: DataFrame) -> DataFrame:
    """One row per row of ``docs``: those without words are their own class."""
    wordless = docs.select("doc_id", "text").filter(
        F.col("doc_id").isNull() | F.col("text").isNull() | ~F.col("text").rlike(r"[0-9A-Za-z]|[^\x00-\x7F]"))
    return found.select("doc_id", "class_id", "n_copies", (F.col("doc_id") == F.col("class_id")).alias("kept")).unionByName(
        wordless.select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("bigint").alias("n_copies"), F.lit(True).alias("kept")))


def deduplicated(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, unchanged, less all but one document of each class."""
    gone = classes(docs, threshold).filter("doc_id != class_id").select(
        F.col("doc_id").alias("llm_gone_id"), F.col("text_key").alias("llm_gone_key")).distinct()
    # By id and text: of two texts with one id, only the copy goes.
    return docs.join(gone, (F.col("doc_id") == F.col("llm_gone_id")) & (F.xxhash64("text") == F.col("llm_gone_key")), "left_anti")
