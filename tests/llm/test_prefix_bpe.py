"""Prefix dynamic programming against the tiktoken library."""

import base64
import functools
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm_cases import EDGE_ROWS, SF, edge_docs, no_docs, small_docs  # noqa: F401
from salesmart.llm import prefix_bpe as pb
from salesmart.llm.queries import QUERIES

FILES = ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"]
LETTERS = "aabbcdesé漢日本дом \n\t'.,1239ltmrvLL　\x85\x1c  😀"
TEXTS = st.text(alphabet=st.sampled_from(LETTERS), max_size=60)


@functools.cache
def library(name=FILES[0]):
    with open(public_tokenizers.path(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.cache
def vocabulary(name=FILES[0]):
    return pb.Vocabulary(pb.ranks_of(public_tokenizers.path(name)))


def ids_of(encoder, text):
    return np.frombuffer(encoder.encode(text), np.uint32).tolist()


@pytest.mark.parametrize("name", FILES)
def test_ids_are_the_library_s(name):
    encoder, rng = pb.Encoder(vocabulary(name)), random.Random(4)
    tokens = list(vocabulary(name).ranks)
    texts = [t or "" for _, t in EDGE_ROWS] + ["<|endoftext|>", "a" * 3000, " " * 500 + "x", "ab\r\n\r\n  c "]
    texts += ["".join(rng.choice(tokens).decode("utf-8", "replace") for _ in range(rng.randint(1, 6))) for _ in range(3000)]
    for text in texts:
        assert ids_of(encoder, text) == library(name).encode_ordinary(text), repr(text[:60])


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_ids_of_any_text(text):
    assert ids_of(pb.Encoder(vocabulary()), text) == library().encode_ordinary(text)


def test_last_token_of_every_prefix():
    """The table's entry is the last token of the prefix encoded alone, by
    plain merging."""
    v, rng = vocabulary(), random.Random(6)
    for _ in range(150):
        data = "".join(rng.choice("aeinorst éдо") for _ in range(rng.randint(1, 14))).encode()
        last = pb.Prefixes(v, data).last
        assert [v.token[t] for t in last] == [pb.merged(data[:i + 1], v.ranks)[-1] for i in range(len(data))]


def test_a_token_that_merging_never_makes():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"xbc": 258, b"abc": 259, b"cd": 260, b"abcd": 261}
    v = pb.Vocabulary(ranks)
    for word in (b"abc", b"xabc", b"abcd", b"xbcd", b"abcabcd"):
        want = [ranks[word]] if word in ranks else [ranks[p] for p in pb.merged(word, ranks)]
        assert pb.Prefixes(v, word).ids() == want


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.lists(st.tuples(st.integers(0, 70), st.integers(0, 4), st.text(alphabet=st.sampled_from(LETTERS), max_size=5)), max_size=4))
def test_edits_and_appends(text, edits):
    table = pb.EditedText(vocabulary(), text)
    for start, n, new in edits:
        table.replace(start, start + n, new)
        text = text[:start] + new + text[start + n:] if start < len(text) else text + new
        assert table.text == text and table.ids() == library().encode_ordinary(text)
    table.append(" more")
    assert table.ids() == library().encode_ordinary(text + " more")


def test_edits_work_near_their_place():
    text = " ".join(f"word{i}" for i in range(5000)) + " " + "ab" * 5000
    table = pb.EditedText(vocabulary(), text)
    assert table.replace(20_000, 20_003, "xyz") < 200
    assert table.replace(len(text) - 5000, len(text) - 4999, "q") < 200
    assert table.append("ab") < 50
    assert table.ids() == library().encode_ordinary(table.text)


def test_reencoded_table(spark, small_docs):
    rng = random.Random(8)
    rows = [(i % 90, k, rng.randint(0, 400), None if k == 1 else rng.randint(0, 500), rng.choice(["", " x", "ü", None])) for i in range(60) for k in (0, 1)]
    edits = spark.createDataFrame([*rows, (None, 0, 1, 1, "z")], "doc_id bigint, seq int, start int, stop int, new string")
    texts = {r["doc_id"]: r["text"] for r in small_docs.collect()}
    by_doc = {}
    for doc_id, seq, start, stop, new in rows:
        by_doc.setdefault(doc_id, []).append((seq, start, start if stop is None else stop, new or ""))
    got = {r["doc_id"]: (r["text"], r["ids"]) for r in pb.reencoded(small_docs, edits).collect()}
    want = {}
    for doc_id, todo in by_doc.items():
        if doc_id in texts:
            text = texts[doc_id]
            for _, start, stop, new in sorted(todo):
                text = text[:start] + new + text[max(start, stop):]
            want[doc_id] = (text, library().encode_ordinary(text))
    assert got == want


def test_query_against_the_library(spark, small_docs):
    rows = QUERIES["op13_prefix_bpe"](spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in small_docs.collect()}
    assert len(rows) == len(texts)
    for r in rows:
        ids = library().encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_edges(edge_docs, no_docs):
    docs = edge_docs.withColumn("ids", F.lit(1)).withColumn("decoded", F.lit("x"))
    tokens = pb.encoded(docs)
    got = sorted((repr(r["doc_id"]), r["ids"]) for r in tokens.collect())
    assert got == sorted((repr(i), library().encode_ordinary(t or "")) for i, t in EDGE_ROWS)
    back = sorted((repr(r["doc_id"]), bytes(r["decoded"])) for r in pb.decoded(tokens).collect())
    assert back == sorted((repr(i), (t or "").encode()) for i, t in EDGE_ROWS)
    assert pb.decoded(pb.encoded(no_docs)).count() == 0
