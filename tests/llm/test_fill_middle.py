"""Piece tables: arrangement, restoration and the query's digests."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm_cases import EDGE_ROWS, edge_docs, no_docs, small_docs  # noqa: F401
from salesmart.llm import fill_middle as fm


def plain_arrangement(doc_id, text):
    """The rule on Python strings, by slices."""
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    if not text or h3 % 100 >= 90 or any(m in text for m in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


@settings(max_examples=400, deadline=None)
@given(st.integers(0, 500), st.text(alphabet=st.sampled_from("ab<>PSM é漢😀\n\x00"), max_size=60))
def test_any_text(doc_id, text):
    n, form, prefix, middle, table = fm.arrangement(doc_id, text.encode())
    assert (n, form, prefix, middle, table.joined().decode()) == plain_arrangement(doc_id, text)
    back = fm.restoration(table.joined(), form)
    assert back.joined().decode() == text and back.sha256() == hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=40), st.lists(st.integers(0, 40), max_size=5), st.lists(st.integers(0, 40), max_size=4))
def test_cuts_split_descriptors_and_lose_no_byte(data, first, second):
    table = fm.PieceTable(data)
    for places in (first, second):
        places = sorted(min(p, len(data)) for p in places)
        runs = table.cut(places)
        assert len(runs) == len(places) + 1
        ends = [0, *places, len(data)]
        for run, a, b in zip(runs, ends, ends[1:], strict=False):
            part = fm.PieceTable(data)
            part.pieces = run
            assert part.joined() == data[a:b]
        table.pieces = [x for run in runs for x in run]


def test_byte_places_beyond_one_block():
    text = "é" * 50_000 + "x" * 50_000 + "漢" * 50_000
    data = text.encode()
    for k in (0, 1, 49_999, 50_000, 99_999, 100_001, 149_999, 150_000):
        assert fm.byte_place(data, len(text), k) == len(text[:k].encode())


def test_whole_table_against_slices(small_docs):
    rows = fm.restored(fm.arranged(small_docs), keep_text=True).collect()
    texts = {r["doc_id"]: r["text"] for r in small_docs.collect()}
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]]
        want = plain_arrangement(r["doc_id"], text)
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == want
        assert r["output_sha256"] == hashlib.sha256(want[-1].encode()).hexdigest()
        assert r["restored"] == text and r["restored_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        if r["form"] != "plain":
            assert [p["buffer"] for p in r["pieces"] if p["buffer"] == fm.MARK] == [fm.MARK] * 3
            assert sum(p["length"] for p in r["pieces"] if p["buffer"] == fm.TEXT) == len(text.encode())


def test_edges(edge_docs, no_docs):
    extra = edge_docs.withColumn("output", F.lit(1)).withColumn("form", F.lit("x"))
    rows = fm.restored(fm.arranged(extra), keep_text=True).collect()
    got = sorted((repr(r["doc_id"]), r["form"], r["output"], r["restored"]) for r in rows)
    assert got == sorted((repr(i), plain_arrangement(i, t)[1], plain_arrangement(i, t)[4], t or "") for i, t in EDGE_ROWS)
    assert fm.restored(fm.arranged(no_docs)).count() == 0
