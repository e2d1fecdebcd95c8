"""Corpus pipeline: documents to packed training sequences.

Five stages, each an operator of ``salesmart.llm`` over all rows that the stage
before kept: toxic documents go; lines that match an earlier line go; one
document of each group of near duplicates stays; passages of the benchmark are
cut out; the rest is packed. Every stage's result is written as Parquet in the
shared scratch folder and read again. All stages but the last return the
columns of ``documents``.

Defined cases: rows with null or empty text, or null ids, pass the first four
stages (a fit without labelled rows of both classes rejects nothing) and are
packed as empty documents; of repeated rows and of equal texts under several
ids one stays; of two texts under one id only a copy goes; empty tables give an
empty result; further columns of ``documents`` come along unchanged up to the
last stage, whatever their names, and those of the other tables are not read.

No single SQL statement expresses the stages (a fitted classifier, a
tokenizer), so ``ORACLE_SQL`` is None and the tests compare with a plain
brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from salesmart.llm import decontaminate, linededup, neardup, packing, toxicity
from salesmart.llm.scratch import kept
from salesmart.llm.textkit import read


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier fitted on the labelled ones rejects go."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that match an earlier line of the corpus go."""
    return linededup.deduplicated(docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return neardup.deduplicated(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out of the texts."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in a training sequence."""
    return packing.pack(docs).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("minhash_near_dedup", without_near_duplicates),
    ("benchmark_decontamination", without_benchmark),
    ("best_fit_packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
