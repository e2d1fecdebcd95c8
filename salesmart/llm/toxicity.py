"""Toxicity: a linear classifier over naive-Bayes-scaled character n-grams.

A text's features are the distinct hashed character n-grams of its words. Each
feature is scaled by its naive Bayes log-count ratio between toxic and other
training texts, and a logistic regression weighs the scaled features. Training
uses labelled rows only: at most about ``MAX_DOCS`` documents of a class, taken
by their hash. The ratios are summed over all of that sample in a
distributed pass; regressions are then fitted on disjoint parts of at most
about ``PART_DOCS`` documents, one task each, and their weights averaged, so no
task holds more than a part. The model is 2^BITS weights, whatever the input.

A text's score is that of its most toxic window: a text is taken whole, in
windows of about ``WINDOW_CHARS`` characters, so harmless length hides nothing.
A regression runs until its training texts are told apart with room to spare, so
that the windows of a long harmless text, of which there are many to be
suspected in, stay below the threshold.

Defined cases: null or wordless text has no features and scores the bias
alone; labels that are null or neither 0 nor 1 teach nothing; a document with
both labels counts as toxic; without rows of both classes every score is 0;
rows with equal doc_id are judged alike, each on its own; only the named
columns are used, so other columns cannot clash.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.ngrams import BLOCK_SCHEMA, block_batches, hashed, summed_blocks, sums
from salesmart.llm.scratch import kept, removed
from salesmart.llm.textkit import workers_ready

ORDERS, BITS = (3, 4, 5), 18
#: The fit's bounded sample: documents by label.
MAX_DOCS = {1: 4_000, 0: 8_000}
PART_DOCS = 1_500
WINDOW_CHARS = 3_000
#: Smoothing of the ratios; L2 penalty and steps of the regressions.
ALPHA, PENALTY, STEPS, RATE = 1.0, 1e-5, 300, 0.05
#: Characters of windows whose features are held at once.
HELD_CHARS = 300_000
#: Features of a part's documents that a step of its regression works on at once.
HELD_FEATURES = 1_000_000
#: Divides the scaled features, about the root of their number in a window.
SCALE = 30.0

_OTHER = re.compile(r"[\W\d_]+")


def normalised(text: str | None) -> str:
    inner = _OTHER.sub(" ", (text or "").lower()).strip()
    return f" {inner} " if inner else ""


def windows(text: str) -> list[str]:
    """The text in windows that break at words and repeat none."""
    if len(text) <= WINDOW_CHARS:
        return [text]
    out, at = [], 0
    while len(text) - at > WINDOW_CHARS:
        cut = text.rfind(" ", at + 1, at + WINDOW_CHARS)
        cut = cut if cut > at else at + WINDOW_CHARS
        out.append(text[at:cut + 1])
        at = cut
    return [*out, text[at:]]


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, buckets): the distinct buckets of each text."""
    last = np.zeros(1 << BITS, np.int32)
    parts: list = [[] for _ in texts]
    for numbers, offsets, buckets in hashed(texts, ORDERS, BITS):
        for j, i in enumerate(numbers.tolist()):
            parts[i].append(_distinct(buckets[offsets[j]:offsets[j + 1]], last))
    distinct = [p[0] if len(p) == 1 else _distinct(np.concatenate(p), last) if p else np.empty(0, np.int32) for p in parts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in distinct])]).astype(np.int64)
    return offsets, np.concatenate(distinct) if distinct else np.empty(0, np.int32)


def _distinct(buckets: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Each value once; ``last`` is working space for the place seen last."""
    place = np.arange(len(buckets), dtype=np.int32)
    last[buckets] = place
    return buckets[last[buckets] == place]


@dataclass
class Model:
    """Weights by bucket (ratio times coefficient) and the bias."""

    weights: np.ndarray
    bias: float


def labelled_sample(docs: DataFrame, labels: DataFrame, most: dict[int, int]) -> DataFrame:
    """text, label, place: at most about ``most[label]`` documents of a label,
    the same ones on every run; ``place`` spreads them evenly over 0..1."""
    rows = labels.filter("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    place = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    counts = rows.groupBy("label").agg(F.count("*").alias("n_label"))  # two rows
    bound = F.when(F.col("label") == 1, F.lit(most[1])).otherwise(F.lit(most[0]))
    rows = rows.join(F.broadcast(counts), "label").withColumn("place", place * F.col("n_label") / F.least("n_label", bound))
    rows = rows.filter("place < 1").select("doc_id", "label", "place")
    # The sample is bounded, so its ids may be broadcast.
    return docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id").select("text", "label", "place")


def _feature_rows(batches):
    for batch in batches:
        offsets, buckets = features([normalised(t) for t in batch.column("text").to_pylist()])
        yield pa.RecordBatch.from_arrays([
            batch.column("label"), batch.column("place"),
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(buckets, pa.int32()))], names=["label", "place", "buckets"])


def _class_counts(batches):
    counts: dict[int, np.ndarray] = {}
    for batch in batches:
        labels = batch.column("label").to_numpy()
        lists = batch.column("buckets")
        owner = np.repeat(labels, np.diff(lists.offsets.to_numpy()))
        flat = lists.flatten().to_numpy()
        for label in np.unique(labels).tolist():
            total = counts.setdefault(label, np.zeros((1 << BITS) + 1, np.int64))
            total[:-1] += np.bincount(flat[owner == label], minlength=1 << BITS)
            total[-1] += int((labels == label).sum())
    yield from block_batches(counts, (1 << BITS) + 1)


def _blocks(sizes: np.ndarray) -> list[tuple[int, int]]:
    """Runs of documents of about ``HELD_FEATURES`` features, one document at least."""
    run = (np.cumsum(sizes) - 1) // HELD_FEATURES
    ends = [*(np.flatnonzero(np.diff(run)) + 1).tolist(), len(sizes)]
    return [(a, b) for a, b in zip([0, *ends], ends) if b > a]


def _fit_part(held):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        ratios = held.value
        sizes = group["buckets"].map(len).to_numpy()
        y = group["label"].to_numpy(float)
        # Work on the buckets that occur; the others keep a weight of zero.
        seen = np.zeros(1 << BITS, bool)
        for x in group["buckets"]:
            seen[x] = True
        used, number = np.flatnonzero(seen), np.cumsum(seen) - 1
        blocks = [(a, b, np.concatenate([number[x] for x in group["buckets"].iloc[a:b]])) for a, b in _blocks(sizes)]
        scales = ratios[used] / SCALE
        share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
        w, bias = np.zeros(len(used)), 0.0
        mean, square, mean_b, square_b = np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
        for step in range(1, STEPS + 1):
            scaled, slope, slope_b = w * scales, np.zeros(len(used)), 0.0
            for a, b, local in blocks:
                z = sums(scaled[local], np.concatenate([[0], np.cumsum(sizes[a:b])])) + bias
                error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[a:b]) * share[a:b]
                slope += np.bincount(local, weights=np.repeat(error, sizes[a:b]), minlength=len(used))
                slope_b += error.sum()
            slope = slope * scales + PENALTY * w
            mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
            mean_b, square_b = 0.9 * mean_b + 0.1 * slope_b, 0.99 * square_b + 0.01 * slope_b**2
            a, b = 1 - 0.9**step, 1 - 0.99**step
            w -= RATE * (mean / a) / (np.sqrt(square / b) + 1e-8)
            bias -= RATE * (mean_b / a) / (np.sqrt(square_b / b) + 1e-8)
        weights = np.zeros(1 << BITS, np.float32)
        weights[used] = w * ratios[used] / SCALE
        return pd.DataFrame({"weights": [weights.tolist()], "bias": [float(bias)]})

    return run


def fit(docs: DataFrame, labels: DataFrame, most: dict[int, int] | None = None) -> Model:
    """The model from documents (doc_id, text) and labels (doc_id, toxic)."""
    spark = docs.sparkSession
    workers_ready(spark)
    sample = labelled_sample(docs, labels, most or MAX_DOCS)
    rows = kept(sample.mapInArrow(_feature_rows, "label int, place double, buckets array<int>"), "toxicity-features")
    counts = summed_blocks(rows.select("label", "buckets").mapInArrow(_class_counts, BLOCK_SCHEMA), (1 << BITS) + 1)
    found = {int(k): v for k, v in counts.items()}
    if set(found) != {0, 1}:
        return Model(np.zeros(1 << BITS, np.float32), -30.0)
    rate = {k: (v[:-1] + ALPHA) / (v[-1] + 2 * ALPHA) for k, v in found.items()}
    held = spark.sparkContext.broadcast(np.log(rate[1] / rate[0]))
    parts = int(np.ceil(sum(v[-1] for v in found.values()) / PART_DOCS))
    numbered = rows.withColumn("part", F.least(F.floor(F.col("place") * parts), F.lit(parts - 1)))
    fitted = numbered.groupBy("part").applyInPandas(_fit_part(held), "weights array<float>, bias double").toArrow()
    removed(spark, rows)
    weights = np.mean([w.values.to_numpy() for w in fitted.column("weights")], 0)
    return Model(weights.astype(np.float32), float(np.mean(fitted.column("bias").to_numpy())))


def margins(texts: list[str], model: Model) -> np.ndarray:
    """The margin of each normalised text's most toxic window. Features are held
    for a group of windows at a time."""
    best = np.full(len(texts), -np.inf)
    owners: list[int] = []
    group: list[str] = []
    size = 0

    def judge() -> None:
        offsets, buckets = features(group)
        np.maximum.at(best, owners, sums(model.weights[buckets], offsets) + model.bias)

    for i, text in enumerate(texts):
        for window in windows(text):
            if group and size + len(window) > HELD_CHARS:
                judge()
                owners, group, size = [], [], 0
            owners.append(i)
            group.append(window)
            size += len(window)
    if group:
        judge()
    return best


def score_texts(texts: list[str | None], model: Model) -> np.ndarray:
    """Probability of the label 1 for each text: that of its most toxic window."""
    best = margins([normalised(t) for t in texts], model)
    return 1 / (1 + np.exp(-np.clip(best, -700, 700)))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row, from its text alone."""
    spark = docs.sparkSession
    workers_ready(spark)
    held = spark.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            scores = score_texts(batch.column("text").to_pylist(), held.value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, score double")


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, unchanged, that score below the threshold."""
    workers_ready(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            scores = score_texts(batch.column("text").to_pylist(), held.value)
            yield batch.filter(pa.array(scores < threshold, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
