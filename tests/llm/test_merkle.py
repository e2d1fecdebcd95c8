"""Merkle manifest against a plain tree, and its parts."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_cases import EDGE_ROWS, SF, edge_docs, no_docs, small_docs  # noqa: F401
from salesmart.llm import merkle
from salesmart.llm.queries import QUERIES


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        below = out[-1]
        out.append([sha("".join(below[i:i + 3])) for i in range(0, len(below), 3)])
    return out


def plain_path(levels, place):
    out = []
    for level in levels[:-1]:
        first = place - place % 3
        out.append((place - first, [level[p] for p in range(first, min(first + 3, len(level))) if p != place]))
        place //= 3
    return out


def leaf_of(row, text):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_rows(rows):
    """doc_id, leaf, subroot, root, proof hash, folded root, verified by lists."""
    by_source = {}
    for r in rows:
        by_source.setdefault(r["source"], []).append(r)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by_source[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"])))
        trees[s] = plain_levels([leaf_of(r, r["text"]) for r in by_source[s]])
    top = plain_levels([trees[s][-1][0] for s in names])
    out = []
    for rank, s in enumerate(names):
        for place, r in enumerate(by_source[s]):
            path = plain_path(trees[s], place) + plain_path(top, rank)
            text = r["text"]
            if r["doc_id"] is not None and text is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            digest = leaf_of(r, text)
            for at, others in path:
                digest = sha("".join([*others[:at], digest, *others[at:]]))
            proof = sha("".join(x for _, others in path for x in others))
            out.append((r["doc_id"], trees[s][0][place], trees[s][-1][0], top[-1][0], proof, digest, digest == top[-1][0]))
    return out


def query_rows(docs, tmp):
    docs.write.parquet(f"{tmp}/documents.parquet")
    rows = QUERIES["op12_merkle_manifest"](docs.sparkSession, tmp).collect()
    return sorted((tuple(r) for r in rows), key=repr)


def test_missing_is_what_proofs_need_and_leaves_do_not_give():
    rng = random.Random(2)
    for _ in range(60):
        n = rng.randint(1, 120)
        wanted = sorted(rng.sample(range(n), rng.randint(1, n)))
        levels = plain_levels([sha(str(i)) for i in range(n)])
        given = {(0, p): levels[0][p] for p in wanted}
        far = merkle.missing(np.array(wanted), n)
        assert len(set(far)) == len(far)
        held = given | {c: levels[c[0]][c[1]] for c in far}
        count, level, known = n, 0, set(wanted)
        while count > 1:
            for run in {p // 3 for p in known}:
                members = [held[level, p] for p in range(3 * run, min(3 * run + 3, count))]
                assert (level + 1, run) not in far
                held[level + 1, run] = sha("".join(members))
            known, count, level = {p // 3 for p in known}, -(-count // 3), level + 1
        assert held[level, 0] == levels[-1][0]
        for place in wanted:
            proof = [held[lv, p] for lv, others in merkle.siblings(place, n) for p in others]
            assert proof == [x for _, others in plain_path(levels, place) for x in others]
            assert merkle.fold(levels[0][place], place, n, [*proof, "rest"]) == (levels[-1][0], ["rest"])


@pytest.mark.parametrize("levels,heat", [(1, 1), (2, 3)])
def test_small_blocks_with_a_hot_source(spark, small_docs, workdir, monkeypatch, levels, heat):
    """Blocks of 3 and 9 leaves make trees of many steps and salted levels."""
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 3**levels)
    monkeypatch.setattr(merkle, "HEAT", heat)
    docs = small_docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").when(F.col("doc_id") % 7 != 0, F.col("source")))
    rows = [r.asDict() for r in docs.collect()]
    assert query_rows(docs.repartition(5), workdir) == sorted(plain_rows(rows), key=repr)


def test_edges(edge_docs, no_docs, workdir):
    docs = edge_docs.withColumn("source", F.when(F.col("doc_id") > 3, F.lit("é")).when(F.col("doc_id") > 1, F.lit("")))
    docs = docs.withColumn("digest", F.lit(1)).withColumn("key", F.lit("k")).withColumn("place", F.lit(0))
    rows = [r.asDict() for r in docs.collect()]
    assert len(rows) == len(EDGE_ROWS)
    assert query_rows(docs, f"{workdir}/a") == sorted(plain_rows(rows), key=repr)
    assert query_rows(no_docs, f"{workdir}/b") == []
    one = docs.filter("doc_id = 3")
    assert query_rows(one, f"{workdir}/c") == plain_rows([r.asDict() for r in one.collect()])


def test_tampering_is_found(spark):
    rows = QUERIES["op12_merkle_manifest"](spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in rows:
        changed = zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and "\n" in texts[r["doc_id"]]
        assert r["verified"] == (not changed)
