"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of labelled texts by language in a distributed pass
(whole texts; at most ``MAX_DOCS_PER_LANG`` documents of a language, taken by
their hash) and sums the counts by blocks of buckets. The log-probability
matrix (languages x 2^BITS float32, at most ``MAX_LANGS`` languages) is
broadcast; scoring adds the matrix entries of a text's n-grams in numpy.

Texts are lower-cased and every run of other characters than letters becomes
one space, so digits, markup and punctuation say nothing.

Defined cases: null text, or one without a letter, is ``und`` with score 0;
rows with a null or empty lang, or null text, teach nothing; ties go to the
language first in order; without any training row every text is ``und``; rows
with equal doc_id are judged alike, each on its own; only the named columns
are used, so other columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.ngrams import BLOCK_SCHEMA, block_batches, hashed, summed_blocks, sums
from salesmart.llm.textkit import workers_ready

ORDERS, BITS = (1, 2, 3, 4), 16
#: The fit's bounded sample, and the most languages a matrix holds.
MAX_DOCS_PER_LANG = 20_000
MAX_LANGS = 200
#: Added to each count.
SMOOTHING = 0.5

#: Whatever is no letter: numerals such as a half or a square are none.
_OTHER = regex.compile(r"\P{L}+")


def normalised(text: str | None) -> str:
    """Letters in lower case between single spaces; '' without a letter."""
    inner = _OTHER.sub(" ", (text or "").lower()).strip()
    return f" {inner} " if inner else ""


def sampled(rows: DataFrame, key: str, most: int) -> DataFrame:
    """About ``most`` rows of each value of ``key`` at most, the same ones on
    every run: rows whose hash falls under the value's share."""
    share = rows.groupBy(key).agg(F.count("*").alias("n_rows"))
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rows.join(F.broadcast(share), key).filter(place * F.col("n_rows") < most).drop("n_rows")


def _counter(batches):
    """Per task: counts of every language's n-grams, by blocks of buckets."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        texts = [normalised(t) for t in batch.column("text").to_pylist()]
        for lang in set(langs):
            mine = [t for t, x in zip(texts, langs, strict=True) if x == lang]
            total = counts.setdefault(lang, np.zeros(1 << BITS, np.int64))
            for _, _, buckets in hashed(mine, ORDERS, BITS):
                total += np.bincount(buckets, minlength=1 << BITS)
    yield from block_batches(counts, 1 << BITS)


def fit(labelled: DataFrame, max_docs: int = MAX_DOCS_PER_LANG) -> tuple[list[str], np.ndarray]:
    """(languages in order, log-probabilities by language and bucket) from the
    rows' text and lang."""
    workers_ready(labelled.sparkSession)
    rows = labelled.select("doc_id", "text", "lang").filter("text is not null and lang is not null and lang != ''")
    parts = sampled(rows, "lang", max_docs).select("text", "lang").mapInArrow(_counter, BLOCK_SCHEMA)
    found = summed_blocks(parts, 1 << BITS)
    langs = sorted(found)
    if len(langs) > MAX_LANGS:
        raise ValueError(f"{len(langs)} languages; the matrix holds {MAX_LANGS}")
    counts = np.array([found[x] for x in langs], float).reshape(len(langs), 1 << BITS)
    counts += SMOOTHING
    return langs, np.log(counts / counts.sum(1, keepdims=True)).astype(np.float32)


def score_texts(texts: list[str | None], langs: list[str], matrix: np.ndarray) -> tuple[list[str], np.ndarray]:
    """(language, posterior probability) of each text, under equal priors."""
    clean = [normalised(t) for t in texts]
    total = np.zeros((len(texts), len(langs)))
    for numbers, offsets, buckets in hashed(clean, ORDERS, BITS):
        for k in range(len(langs)):
            np.add.at(total[:, k], numbers, sums(matrix[k][buckets], offsets))
    if not langs:
        return ["und"] * len(texts), np.zeros(len(texts))
    best = total.argmax(1)
    posterior = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
    known = np.array([bool(t) for t in clean], bool)
    return [langs[b] if k else "und" for b, k in zip(best.tolist(), known.tolist(), strict=True)], np.where(known, posterior, 0.0)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """doc_id, lang_pred, score of every row, from its text alone."""
    spark = docs.sparkSession
    workers_ready(spark)
    held = spark.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            langs, scores = score_texts(batch.column("text").to_pylist(), *held.value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double")
