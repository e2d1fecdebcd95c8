"""The corpus pipeline on its defined cases, and operators with columns that clash."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm_cases import EDGE_ROWS, SF, edge_docs, no_docs, small_docs  # noqa: F401
from salesmart.llm import decontaminate, toxicity, vectors
from salesmart.llm.scratch import kept

LABELS = "doc_id bigint, toxic int, label int, place double, text string, score int"
ITEMS = "item_id bigint, text string, doc_id bigint, spans int"


def tables(spark, folder, docs, labels=(), items=()):
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(labels), LABELS).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(items), ITEMS).write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def stages(spark, folder):
    seen = [spark.read.parquet(f"{folder}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(kept(stage(spark, seen[-1], folder), f"test-{name}"))
    return seen


def test_defined_cases(spark, edge_docs, tmp_path):
    items = [(1, "another text with one id more than once", 1, 1), (2, None, 2, 2), (None, "", None, 3)]
    folder = tables(spark, tmp_path, edge_docs, items=items)
    seen = stages(spark, folder)
    assert all(d.columns == edge_docs.columns for d in seen[:-1])
    assert seen[1].count() == len(EDGE_ROWS)  # without labels nothing is rejected
    left = [(r["doc_id"], r["text"]) for r in seen[4].collect()]
    assert {i for i, _ in left} == {1, 2, 3, None, 4, 6, 7, 8, 9}
    assert (7, "short") in left and not any("another text" in (t or "") for _, t in left)
    packed = corpus_pipeline.run(spark, folder).collect()
    assert sorted(str(r["doc_id"]) for r in packed if not r["piece"]) == sorted(str(i) for i, _ in left)
    assert sum(r["length"] == 1 for r in packed) == sum(not t for _, t in left)


def test_empty_tables(spark, no_docs, tmp_path):
    folder = tables(spark, tmp_path, no_docs)
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_other_tables_with_clashing_columns(spark, small_docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    clash = labels.withColumns({"label": F.lit(3), "place": F.lit("x"), "text": F.lit("t"), "n_label": F.lit(0)})
    a, b = toxicity.fit(small_docs, labels), toxicity.fit(small_docs, clash)
    assert a.bias == b.bias and np.array_equal(a.weights, b.weights)
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    clash = items.withColumns({"doc_id": F.lit(1), "n_words": F.lit(1), "spans": F.lit("x")})
    digests = [sorted(map(tuple, decontaminate.digest(decontaminate.find_spans(small_docs, x)).collect()), key=str) for x in (items, clash)]
    assert digests[0] == digests[1]
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    clash = table.withColumns({c: F.lit(1) for c in ("rep", "size", "of", "at", "good", "n", "component")})
    found = [sorted(map(tuple, vectors.near_duplicates(x).collect())) for x in (table, clash)]
    assert found[0] == found[1]


def test_long_clean_documents_are_not_suspected_for_their_length(spark):
    """Scores of clean texts do not rise with the number of their windows."""
    import random
    rng = random.Random(4)
    parts = ["er", "th", "an", "ing", "ou", "re", "al", "on", "st"]
    text = lambda n: " ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(n))
    rows, labels = [], []
    for i in range(400):
        t = text(rng.choice([30, 200, 3000]))
        if i % 3 == 0:
            words = t.split(" ")
            for _ in range(max(1, len(words) // 40)):
                words[rng.randrange(len(words))] = rng.choice(["zorkface", "blithwit", "grumfoul"])
            t = " ".join(words)
        rows.append((i, t))
        labels.append((i, int(i % 3 == 0)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = toxicity.fit(docs, spark.createDataFrame([x for x in labels if x[0] % 2], "doc_id bigint, toxic int"))
    wrong = {r["doc_id"] for r in toxicity.predict(docs, model).collect() if (r["score"] >= 0.5) != bool(dict(labels)[r["doc_id"]])}
    assert len(wrong) <= 4


def test_recall_over_several_shards_with_rare_links(spark):
    """Three shards of over 512 nodes, links between them few and far apart."""
    rng = np.random.default_rng(12)
    rows = [(i, 1, v.tolist()) for i, v in enumerate(rng.normal(size=(2400, 24)).astype(np.float32))]
    for k in range(40):
        base = np.array(rows[17 * k][2])
        rows.append((len(rows), 1, (base + rng.normal(size=24) * 0.05).astype(np.float32).tolist()))
    table = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>")
    x = np.array([r[2] for r in rows])
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    want = (x @ x.T >= vectors.THRESHOLD).sum() - len(rows)
    got = vectors.near_duplicates(table, shard_nodes=850).agg(F.sum("n_links")).first()[0]
    assert want >= 80 and got >= 0.95 * want


@pytest.mark.parametrize("scale", [1e-200, 1e200])
def test_vectors_with_extreme_components(spark, scale):
    rows = [(1, 1, [3 * scale, 4 * scale]), (2, 1, [3.0, 4.0]), (3, 1, [4 * scale, -3 * scale])]
    table = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.near_duplicates(table).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (0, 3)}
