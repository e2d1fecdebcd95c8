"""Secret scans, decontamination, language ID and toxicity."""

import random
import re
import zlib

import numpy as np
import pytest

from llm_cases import EDGE_ROWS, SF, edge_docs, no_docs, small_docs  # noqa: F401
from salesmart.llm import decontaminate as dc
from salesmart.llm import langid, secret_scan, toxicity
from salesmart.llm.ngrams import hashed
from salesmart.llm.textkit import LOWER, UPPER, WORD_PATTERN, joined_words, words_of

WORD = re.compile(WORD_PATTERN)


def words(text):
    return WORD.findall((text or "").translate(str.maketrans(UPPER, LOWER)))


# --- words ---------------------------------------------------------------

def test_words_follow_the_pattern():
    texts = ["", "a", "A-b_c 1xéß漢!", "x\x7fy\x80z", *[t or "" for _, t in EDGE_ROWS]]
    for text in texts:
        data = text.encode()
        starts, ends, hashes = words_of(data)
        found = [data[a:b].decode().translate(str.maketrans(UPPER, LOWER)) for a, b in zip(starts, ends)]
        assert found == words(text)
        assert len(set(hashes.tolist())) == len(set(found))
    bounds = joined_words([t.encode() for t in texts])[4]
    assert np.diff(bounds).tolist() == [len(words(t)) for t in texts]


# --- secrets -------------------------------------------------------------

def plain_base(text):
    out = []
    for k, (kind, (pattern, group, least)) in enumerate(secret_scan.BASE_RULES.items()):
        out += [(m.start(), k, m.end()) for m in re.finditer(pattern, text) if m.end(group) - m.start(group) >= least]
    return sorted(out)


@pytest.fixture(scope="module")
def scanner():
    return secret_scan.Scanner(*secret_scan.build())


def test_base_spans_are_those_of_the_rules(scanner):
    rng = random.Random(1)
    pieces = ["token", "secret", "=", ":", " ", '"', "abc", "AKIA", "ABCD1234EFGH5678IJ", "deadbeef01", "'", "api_key",
              "ApiKey", "PASSWORD", "é", "-", "12345678", "\n", "passwd", "0" * 9, "ſecret", "K"]
    for _ in range(4000):
        text = "".join(rng.choices(pieces, k=rng.randint(1, 30)))
        base, spans = scanner.spans(text)
        assert base == plain_base(text), repr(text)
        assert set(base) <= set(spans)


def test_the_method_adds_what_a_failed_match_hides(scanner):
    base, spans = scanner.spans("secret=token:abcdefgh")
    assert base == [] and spans == [(7, 0, 21)]


def test_added_rules(scanner):
    text = "x -----BEGIN RSA PRIVATE KEY----- ghp_" + "Zq" * 20
    kinds = [scanner.kinds[k] for _, k, _ in scanner.spans(text)[1]]
    assert kinds == ["pem", "github"]


def test_minimal_automaton_agrees_with_re():
    pattern = "a(b|c)*d{2,3}[x-z]?"
    automaton = secret_scan.compiled([secret_scan._Parser(pattern).parse()], False)
    rng = random.Random(2)
    for _ in range(2000):
        text = "".join(rng.choices("abcdxy", k=rng.randint(0, 8)))
        state = 0
        for c in text.encode():
            state = automaton.table[state][c]
        assert bool(automaton.masks[state]) == bool(re.fullmatch(pattern, text))


def test_secret_query_edges(edge_docs, no_docs):
    rows = secret_scan.digest(secret_scan.scan(edge_docs)).collect()
    assert len(rows) == len(EDGE_ROWS)
    assert all(r["base_sha256"] == secret_scan.base_digest([]) and r["spans"] == "" for r in rows)
    assert secret_scan.digest(secret_scan.scan(no_docs)).count() == 0


# --- decontamination -----------------------------------------------------

def plain_hits(text, items, window=10):
    found = words(text)
    hit, held = [False] * len(found), set()
    for item, t in items:
        w = words(t)
        size = min(window, len(w))
        windows = {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if size else set()
        for k in range(len(found) - size + 1 if size else 0):
            if tuple(found[k:k + size]) in windows:
                held.add(item)
                hit[k:k + size] = [True] * size
    return len(found), sum(hit), held


def test_fm_index_finds_every_occurrence():
    rng = np.random.default_rng(4)
    for _ in range(20):
        text = rng.integers(0, 5, 300)
        text[-1] = 0
        index = dc.FMIndex(text, 4, 8)
        patterns = rng.integers(1, 5, (30, 3))
        which, low, high = index.search(patterns)
        for p in range(30):
            there = [i for i in range(298) if (text[i:i + 3] == patterns[p]).all()]
            rows = np.flatnonzero(which == p)
            got = sorted(index.locate(np.arange(low[rows[0]], high[rows[0]])).tolist()) if len(rows) else []
            assert got == there


def test_spans_are_those_of_brute_force(spark):
    rng = random.Random(6)
    vocabulary = ["alpha", "beta", "gamma", "δ", "x1"]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, text(rng.choice([0, 3, 9, 10, 14]))) for i in range(12)] + [(12, None), (None, text(11)), (3, text(12))]
    docs = [(i, text(rng.randint(0, 60)) + ("." if i % 2 else "")) for i in range(60)] + [(61, None)]
    docs.append((62, f"Start {items[5][1]}! BETA. {items[4][1]}"))
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id bigint, text string")
    got = {r["doc_id"]: r for r in dc.digest(dc.find_spans(d, b)).collect()}
    for i, t in docs:
        n, hit, held = plain_hits(t, items)
        r = got[i]
        assert (r["n_words"], r["n_hit"]) == (n, hit)
        held.discard(None)
        assert r["items_sha256"] == dc.items_digest(held) and r["n_items"] == len(held)
        assert r["contaminated"] == (hit > 0)


def test_benchmark_in_blocks_gives_the_same(spark, monkeypatch, small_docs):
    b = spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = sorted(map(tuple, dc.digest(dc.find_spans(small_docs, b)).collect()))
    monkeypatch.setattr(dc.benchmark_blocks, "__defaults__", (2000,))
    assert len(list(dc.benchmark_blocks(b))) > 2
    assert sorted(map(tuple, dc.digest(dc.find_spans(small_docs, b)).collect())) == whole


def test_cutting_in_blocks_gives_the_same(spark, monkeypatch):
    w = [f"w{i}" for i in range(40)]
    items = [(k, " ".join(w[at:at + 12])) for k, at in enumerate((0, 7, 14, 21))]
    docs = [(i, " ".join(["own", *w[:n], "end", "x", *w[n - 5:n]]), 7) for i, n in enumerate(range(12, 40))]
    docs += [(90, " ".join(w[:5] + w[14:26] + w[5:12])), (91, " ".join(w[:26])), (92, None), (93, "clean text. ")]
    d = spark.createDataFrame([(*r[:2], 7) for r in docs], "doc_id bigint, text string, n_chars int").repartition(3)
    b = spark.createDataFrame(items, "item_id bigint, text string")
    rows = lambda: sorted(map(tuple, dc.decontaminate(d, b).collect()))
    whole = rows()
    monkeypatch.setattr(dc.benchmark_blocks, "__defaults__", (60,))
    assert sum(len(x) > 0 for x in dc.benchmark_blocks(b)) > 1
    assert rows() == whole
    assert (92, None, 7) in whole and (93, "clean text. ", 7) in whole and not any(r[0] == 91 for r in whole)
    assert all(plain_hits(t, items)[1] == 0 for _, t, _ in whole)


def test_cut_documents_hold_no_window_and_others_stay(spark, small_docs):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    out = {r["doc_id"]: r for r in dc.decontaminate(small_docs, spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    for r in small_docs.collect():
        if plain_hits(r["text"], items)[1] == 0:
            assert out[r["doc_id"]] == r
        elif r["doc_id"] in out:
            assert plain_hits(out[r["doc_id"]]["text"], items)[1] == 0
            assert out[r["doc_id"]]["n_chars"] == len(out[r["doc_id"]]["text"])


def test_decontamination_edges(spark, edge_docs, no_docs):
    b = spark.createDataFrame([(1, "three four five"), (2, None), (3, "")], "item_id bigint, text string")
    got = dc.digest(dc.find_spans(edge_docs, b)).collect()
    assert sum(r["n_hit"] for r in got) == 9 and len(got) == len(EDGE_ROWS)
    assert dc.find_spans(no_docs, b).count() == 0
    assert dc.digest(dc.find_spans(edge_docs, b.limit(0))).filter("contaminated").count() == 0
    out = dc.decontaminate(edge_docs, b)
    assert out.columns == edge_docs.columns and out.count() == len(EDGE_ROWS)


# --- character n-grams ---------------------------------------------------

def test_windows_of_a_long_text_count_each_ngram_once(monkeypatch):
    text = "".join(random.Random(7).choices("abcdé ", k=1000))
    whole = np.sort(np.concatenate([b for _, _, b in hashed([text], (1, 3, 4), 16)]))
    monkeypatch.setattr("salesmart.llm.ngrams.GROUP_CHARS", 64)
    cut = np.sort(np.concatenate([b for _, _, b in hashed(["x", text, "", "yy"], (1, 3, 4), 16)]))
    alone = [np.concatenate([b for _, _, b in hashed([t], (1, 3, 4), 16)]) for t in ("x", "yy")]
    assert len(cut) == len(whole) + sum(map(len, alone)) == 1000 + 998 + 997 + 3


def test_language_of_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    from salesmart.llm.queries import QUERIES

    rows = QUERIES["op4_language_id"](spark, "/root/testdata/sf0.01").collect()
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.98


def test_language_edges(spark, edge_docs, no_docs, small_docs):
    model = langid.fit(small_docs)
    got = langid.predict(edge_docs, model).collect()
    assert len(got) == len(EDGE_ROWS) and all(0 <= r["score"] <= 1 for r in got)
    assert sum(r["lang_pred"] == "und" for r in got) == sum(not any(map(str.isalpha, t or "")) for _, t in EDGE_ROWS)
    assert any(r["doc_id"] == 9 and r["lang_pred"] == "und" for r in got)
    assert langid.predict(no_docs, model).count() == 0
    assert {r["lang_pred"] for r in langid.predict(edge_docs, langid.fit(no_docs)).collect()} == {"und"}


def test_toxicity_finds_planted_words(spark):
    rng = random.Random(8)
    text = lambda n: " ".join("".join(rng.choices(["er", "th", "an", "ing", "ou", "re"], k=rng.randint(1, 4))) for _ in range(n))
    rows, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        t = text(rng.choice([20, 80, 900]))
        if toxic:
            at = rng.randint(0, len(t))
            t = t[:at] + rng.choice([" zorkface ", " Blithwit ", " zorkfaces "]) + t[at:]
        rows.append((i, t))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    train = spark.createDataFrame([x for x in labels if x[0] % 3], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, train)
    scores = {r["doc_id"]: r["score"] for r in toxicity.predict(docs, model).collect()}
    held = [x for x in labels if x[0] % 3 == 0]
    assert np.mean([(scores[i] >= 0.5) == bool(y) for i, y in held]) > 0.97
    left = toxicity.without_toxic(docs, model)
    assert {r["doc_id"] for r in left.collect()} == {i for i, s in scores.items() if s < 0.5}


def test_toxicity_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, 0), (7, None), (None, 1), (8, 5)], "doc_id bigint, toxic int")
    model = toxicity.fit(edge_docs, labels)
    got = toxicity.predict(edge_docs, model).collect()
    assert len(got) == len(EDGE_ROWS) and all(0 <= r["score"] <= 1 for r in got)
    one_class = toxicity.fit(edge_docs, labels.filter("toxic = 0 and doc_id = 4"))
    assert toxicity.without_toxic(edge_docs, one_class).count() == len(EDGE_ROWS)
    assert toxicity.predict(no_docs, model).count() == 0
    assert toxicity.without_toxic(edge_docs, model).columns == edge_docs.columns
