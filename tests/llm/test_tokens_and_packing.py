"""Token ids, best-fit packing and binary rows."""

import functools
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm_cases import EDGE_ROWS, SF, edge_docs, no_docs, small_docs  # noqa: F401
from salesmart.llm import binary_output as bo
from salesmart.llm import packing
from salesmart.llm.tokens import Encoder, tokenizer_json


@functools.cache
def the_encoder():
    return Encoder(tokenizer_json())


@pytest.fixture(scope="module")
def encoder():
    return the_encoder()


def reference_ids(encoder, text):
    return np.array(encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


ODD = ["a  b", " x", "x \n y", "\n\n a", "<|endoftext|> hi", "don't we're\nI'll", "tab\there", "é b 12 3!! ??",
       "a　b", "x​y z", "﻿ab cd", "a\x1cb c", "", "٣ ४ Ⅳ ² x²y", "end ", "a\r\nb", "x y  z"]


def test_ids_are_the_tokenizer_library_s(encoder):
    for text in [*ODD, *(t or "" for _, t in EDGE_ROWS)]:
        assert encoder.encode(text) == reference_ids(encoder, text), repr(text[:50])


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("aBé漢1 2\n\t'.,s ll !") , max_size=60))
def test_ids_of_any_text(text):
    encoder = the_encoder()
    assert encoder.encode(text) == reference_ids(encoder, text)


def test_piece_bounds_cut_only_longer_documents():
    assert packing.piece_bounds(1024, 1024) == [(0, 1024)]
    assert packing.piece_bounds(1025, 1024) == [(0, 1), (1, 1024)]
    assert packing.piece_bounds(2048, 1024) == [(0, 1024), (1024, 1024)]


def check_packing(rows, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def best_fit_decreasing_bins(sizes, capacity):
    rooms = []
    for s in sorted(sizes, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= s]
        if fits:
            i = min(fits, key=lambda i: rooms[i])
            rooms[i] -= s
        else:
            rooms.append(capacity - s)
    return len(rooms)


def test_pieces_and_sequences(spark, small_docs, encoder):
    packed = packing.pack(small_docs, keep_ids=True).cache()
    rows = packed.collect()
    texts = {r["doc_id"]: r["text"] for r in small_docs.collect()}
    for r in rows:
        ids = encoder.encode(texts[r["doc_id"]]) + np.array([2], "<u4").tobytes()
        mine = ids[4 * r["start"]:4 * (r["start"] + r["length"])]
        assert bytes(r["ids"]) == mine and zlib.crc32(mine) == r["ids_crc32"]
    used = check_packing(rows, 1024)
    assert used <= 1.02 * best_fit_decreasing_bins([r["length"] for r in rows], 1024) + 1
    joined = packing.sequences(packed)
    assert joined.count() == used
    assert joined.agg(F.sum(F.length("ids"))).first()[0] == 4 * sum(r["length"] for r in rows)
    packed.unpersist()


def test_one_length_may_hold_most_pieces(spark):
    rng = random.Random(3)
    sizes = [300] * 500 + [rng.randint(1, 1024) for _ in range(300)] + [5] * 200
    pieces = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "uid bigint, length bigint").repartition(3)
    out = packing.best_fit(pieces).join(pieces, "uid").collect()
    assert len(out) == len(sizes)
    assert check_packing(out, 1024) <= best_fit_decreasing_bins(sizes, 1024) * 1.02 + 1


def test_thousands_of_tiny_pieces_make_few_rows(spark, monkeypatch):
    """A gap with room for hundreds of pieces stays one row, or one for each
    block of levels it reaches into."""
    rng = random.Random(9)
    sizes = [rng.randint(2, 12) for _ in range(4000)] + [rng.randint(300, 700) for _ in range(500)]
    pieces = spark.createDataFrame(list(enumerate(sizes)), "uid bigint, length bigint").repartition(3)
    swept, leveled = [], packing._leveled

    def counting(waiting, gaps, *rest):
        rows = leveled(waiting, gaps, *rest)
        swept.append((waiting.count() + 4 * gaps.count(), rows.count()))
        return rows
    monkeypatch.setattr(packing, "_leveled", counting)
    out = packing.best_fit(pieces).join(pieces, "uid").collect()
    assert len(out) == len(sizes)
    assert check_packing(out, 1024) <= best_fit_decreasing_bins(sizes, 1024) * 1.02 + 1
    assert swept and all(rows <= given for given, rows in swept)


@pytest.mark.parametrize("levels", [1, 4, 256])
def test_blocks_of_levels_match_as_one_sweep(spark, monkeypatch, levels):
    monkeypatch.setattr(packing, "BLOCK_LEVELS", levels)
    rng = random.Random(levels)
    waiting = [(i, rng.randint(20, 40)) for i in range(120)]
    gaps = [(1000 + i, rng.randint(20, 300)) for i in range(40)]
    rows = packing._matched(spark.createDataFrame(waiting, "uid bigint, size bigint"),
                            spark.createDataFrame(gaps, "seq bigint, room bigint"), 40, 8).collect()
    assert sorted(r["uid"] for r in rows) == [i for i, _ in waiting]
    used, room = {}, dict(gaps)
    for r in rows:
        if r["seq"] is not None:
            used.setdefault(r["seq"], []).append(r["size"])
    for seq, sizes in used.items():
        several = max(1, room[seq] // 40)
        assert len(sizes) <= several and max(sizes) <= room[seq] // several
    # As a plain sweep: from large to small, a piece takes the bracket opened last.
    brackets, taken = [], 0
    events = [(room // max(1, room // 40), 0, max(1, room // 40)) for _, room in gaps] + [(s, 1, 1) for _, s in waiting]
    for _, kind, n in sorted(events, key=lambda e: (-e[0], e[1])):
        if kind == 0:
            brackets += [1] * n
        elif brackets:
            brackets.pop()
            taken += 1
    assert sum(map(len, used.values())) == taken


def test_packing_edges(edge_docs, no_docs):
    rows = packing.pack(edge_docs).collect()
    assert {r["doc_id"] for r in rows} == {i for i, _ in EDGE_ROWS}
    assert sum(r["length"] == 1 for r in rows) == sum(not t for _, t in EDGE_ROWS)
    check_packing(rows, 1024)
    assert packing.pack(no_docs).count() == 0


def test_room_tree_finds_the_least_room():
    rng = random.Random(5)
    tree, rooms = bo.RoomTree(100), {}
    for row in range(400):
        room = rng.randint(0, 100)
        tree.add(room, row)
        rooms[row] = room
        if rng.random() < 0.6:
            want = rng.randint(0, 100)
            least = min((r for r in rooms.values() if r >= want), default=None)
            found = tree.take(want)
            assert (found[0] if found else None) == least
            if found:
                assert rooms.pop(found[1]) == least


def test_binary_rows_give_back_every_document(small_docs, encoder):
    rows = bo.binary_rows(small_docs, capacity=256, shard_tokens=20_000)
    collected = rows.collect()
    assert len({r["row_id"] for r in collected}) == len(collected)
    for r in collected:
        assert len(r["ids"]) == 512 and r["cu_seqlens"][-1] == r["n_tokens"] <= 256
        assert r["position_resets"] == r["cu_seqlens"][:-1] and len(r["doc_ids"]) == len(r["position_resets"])
    parts = {}
    for r in bo.unpacked(rows, 256).collect():
        parts.setdefault(r["doc_id"], []).append((r["start"], bytes(r["ids"])))
    for d in small_docs.collect():
        data = b"".join(x for _, x in sorted(parts[d["doc_id"]]))
        ids = np.frombuffer(data, "<u2").astype("<u4")
        assert ids[-1] == bo.END_ID and ids[:-1].tobytes() == encoder.encode(d["text"])


def test_binary_rows_edges(edge_docs, no_docs):
    rows = bo.binary_rows(edge_docs).collect()
    assert sum(len(r["doc_ids"]) for r in rows) >= len(EDGE_ROWS)
    assert bo.binary_rows(no_docs).count() == 0
