"""Line dedup, near-dedup, embeddings, quotations, components and the pipeline."""

import os
import random
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from conftest import plan_text
from llm_cases import EDGE_ROWS, SF, edge_docs, no_docs, small_docs  # noqa: F401
from salesmart.llm import components, linededup, neardup, quotes, vectors
from test_scans import plain_hits, words


def roots(nodes, links):
    label = {n: n for n in nodes}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(5, 5), (200, 201), (201, 200)]
    links += [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(60)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert got == roots(nodes, links)
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# --- lines ---------------------------------------------------------------

def plain_line_dedup(rows):
    """Removed (doc_id, line_no), for rows with distinct ids."""
    earlier, first, gone = [], {}, set()
    for i, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        for n, line in enumerate((text or "").split("\n")):
            w = words(line)
            if not w:
                continue
            tokens = frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4)))
            if any(5 * len(tokens & t) >= 4 * len(tokens | t) for t in earlier) and (i, n) != first.get(tuple(w)):
                gone.add((i, n))
            first.setdefault(tuple(w), (i, n))
            earlier.append(tokens)
    return gone


def line_rows(seed, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [rng.choices(vocabulary, k=rng.choice([3, 5, 12, 55, 80])) for _ in range(25)]
    rows = []
    for i in range(n):
        lines = []
        for _ in range(rng.randint(0, 6)):
            w = list(rng.choice(base)) if rng.random() < 0.7 else rng.choices(vocabulary, k=30)
            for _ in range(rng.choice([0, 0, 1, 2])):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            lines.append(rng.choice(["", "  "]) + rng.choice([" ", " , "]).join(w).title())
        rows.append((i, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("broadcast", [0, 500_000])
def test_lines_removed_are_those_of_brute_force(spark, monkeypatch, broadcast):
    monkeypatch.setattr(linededup, "BROADCAST_ROWS", broadcast)
    rows = line_rows(11)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {(r["doc_id"], n) for r in linededup.cleaned(docs).collect() for n in r["llm_gone"]}
    want = plain_line_dedup(rows)
    assert want and got == want
    left = {r["doc_id"]: r["text"] for r in linededup.deduplicated(docs).collect()}
    for i, text in rows:
        lines = [x for n, x in enumerate(text.split("\n")) if (i, n) not in want]
        if any(x.strip() for x in lines) or (i, 0) not in want:
            assert left[i] == "\n".join(lines)
        else:
            assert i not in left


def test_a_passage_of_over_fifty_words_goes_although_a_word_differs(spark):
    passage = [f"p{i}" for i in range(52)]
    other = list(passage)
    other[25] = "changed"
    docs = spark.createDataFrame([(1, " ".join(passage) + "\nown line of one"), (2, "my line of two\n" + " ".join(other))], "doc_id bigint, text string")
    assert {r["doc_id"]: r["text"] for r in linededup.deduplicated(docs).collect()}[2] == "my line of two"


def test_lines_match_whatever_tokens_are_crowded(spark, monkeypatch):
    # Prefixes are made again in several rounds; non-ASCII capitals stay as they are.
    monkeypatch.setattr(linededup, "CROWDED", 2)
    rows = line_rows(12)
    rows += [(1000 + i, "É " + text + "\n\nsame words, ÉÀ same\nsame words, éà same") for i, text in rows[:20]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {(r["doc_id"], n) for r in linededup.cleaned(docs).collect() for n in r["llm_gone"]}
    assert got == plain_line_dedup(rows)


def test_line_dedup_runs_no_python_on_the_executors(spark, monkeypatch):
    plans = []
    kept = linededup.kept
    monkeypatch.setattr(linededup, "kept", lambda df, name: plans.append(plan_text(df)) or kept(df, name))
    docs = spark.createDataFrame(line_rows(13, 10), "doc_id bigint, text string")
    plans.append(plan_text(linededup.deduplicated(docs)))
    assert len(plans) > 5 and not any(x in plan for plan in plans for x in ("InArrow", "InPandas", "EvalPython"))


def test_line_dedup_deletes_its_tables_as_it_goes(spark, monkeypatch):
    monkeypatch.setattr(linededup, "CROWDED", 2)
    docs = spark.createDataFrame(line_rows(14, 12), "doc_id bigint, text string")
    folder, there, kept = f"{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/salesmart", {}, linededup.kept
    kept(docs, "documents")
    before = set(os.listdir(folder))

    def seen(df, name):
        there[name] = {x.rpartition("-")[0] for x in set(os.listdir(folder)) - before}
        return kept(df, name)

    monkeypatch.setattr(linededup, "kept", seen)
    linededup.cleaned(docs).collect()
    assert not there["lines-pairs"] & {"lines", "lines-firsts", "lines-tokens", "lines-held"}
    assert not there["lines-gone"] & {"lines-firsts", "lines-tokens", "lines-shared", "lines-pairs", "lines-rest", "lines-classes", "lines-led-sets", "lines-open-sets"}


def test_line_edges(edge_docs, no_docs):
    out = linededup.deduplicated(edge_docs)
    assert out.columns == edge_docs.columns
    left = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    # 5 repeats 4 in full; equal rows are one document; a null id takes no part.
    assert left == sorted((r for r in EDGE_ROWS if r[0] != 5), key=str)
    assert linededup.deduplicated(no_docs).count() == 0
    assert linededup.cleaned(edge_docs).count() == len(EDGE_ROWS)


# --- near duplicates -----------------------------------------------------

def near_rows(seed):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(2000)]
    rows = []
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.choice([4, 30, 200]))
        for _ in range(rng.randint(1, 6)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 3, 8])):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(w).upper() if rng.random() < 0.3 else " ".join(w)))
    return rows


def plain_classes(rows, weights, threshold=0.8):
    sets = []
    for _, t in rows:
        s = neardup.shingles([t.encode()])
        sets.append((s.hashes, weights.of(s.hashes, s.counts)))
    links = [(a, b) for a in range(len(rows)) for b in range(a) if len(sets[a][0]) and len(sets[b][0]) and neardup.similarity(sets[a], sets[b]) >= threshold]
    return roots(range(len(rows)), links), links


def test_classes_are_those_of_brute_force(spark):
    rows = near_rows(21)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    want, links = plain_classes(rows, neardup.fitted_weights(docs))
    assert len(links) > 20
    got = {r["doc_id"]: r["class_id"] for r in neardup.report(docs, neardup.classes(docs)).collect()}
    assert got == want


def test_a_large_group_with_members_far_from_its_leader(spark):
    rng = random.Random(5)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(80):
        w = list(base)
        for _ in range(rng.choice([1, 2, 4, 9])):
            w[rng.randrange(150)] = f"n{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want, _ = plain_classes(rows, neardup.fitted_weights(docs))
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs).collect()}
    assert got == want and len(set(got.values())) > 1


def test_draws_agree_with_probability_of_the_similarity():
    rng = random.Random(9)
    w = [f"z{i}" for i in range(400)]
    other = list(w)
    for k in range(0, 400, 60):
        other[k] = "q" + str(rng.random())
    s = neardup.shingles([" ".join(w).encode(), " ".join(other).encode()])
    sets = [(s.hashes[s.bounds[i]:s.bounds[i + 1]], np.ones(s.bounds[i + 1] - s.bounds[i])) for i in (0, 1)]
    exact = neardup.similarity(*sets)
    bands = neardup.draws(s, np.ones(len(s.hashes)))
    agreed = (bands[0] == bands[1]).mean()
    assert abs(agreed - exact ** neardup.ROWS) < 0.35 and exact > 0.8 and agreed > 0


def test_weights_are_those_of_exact_frequencies(spark):
    # 720,000 shingles of one document each: nearly three to a counter of a sketch of 2^18.
    docs = spark.range(60_000).selectExpr(
        "id AS doc_id", "concat_ws(' ', transform(sequence(0, 11), i -> concat('r', id, 'x', i)), 'one two three four', concat('five', id % 100)) AS text")
    weights = neardup.fitted_weights(docs)
    assert weights.n == 60_000
    exact = lambda df: 1 + np.log1p(60_000 / df) / np.log1p(60_000)
    for i in range(0, 60_000, 977):
        s = neardup.shingles([f"{' '.join(f'r{i}x{k}' for k in range(12))} one two three four five{i % 100}".encode()])
        want = [exact(1)] * 12 + [exact(600)]
        assert sorted(weights.of(s.hashes, s.counts)) == pytest.approx(sorted(want), abs=1e-12)
    assert neardup.fitted_weights(docs.limit(0)).n == 0


def test_near_dedup_edges(edge_docs, no_docs):
    rows = neardup.report(edge_docs, neardup.classes(edge_docs)).collect()
    assert len(rows) == len(EDGE_ROWS)
    by_id = {r["doc_id"]: r["class_id"] for r in rows}
    assert by_id[5] == 4 and by_id[2] == 2 and by_id[6] == 6 and by_id[None] is None
    out = neardup.deduplicated(edge_docs)
    assert out.columns == edge_docs.columns and out.count() == len(EDGE_ROWS) - 1
    assert neardup.deduplicated(no_docs).count() == 0


def test_of_two_texts_with_one_id_only_the_copy_goes(spark):
    copied, own = "a text that two documents hold word for word", "another text that only the second id holds"
    rows = [(4, copied), (7, copied), (7, own), (9, own.upper())]
    left = neardup.deduplicated(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(map(tuple, left)) == [(4, copied), (7, own)]


# --- embeddings ----------------------------------------------------------

def plain_links(rows, threshold=vectors.THRESHOLD):
    good = [(i, x, np.array(v, float)) for i, x, v in rows
            if i is not None and x is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    return [(a[0], b[0]) for a in good for b in good if a[0] > b[0] and a[1] == b[1] and len(a[2]) == len(b[2])
            and a[2] @ b[2] / np.sqrt((a[2] @ a[2]) * (b[2] @ b[2])) >= threshold]


@pytest.mark.parametrize("shard", [40, 20_000])
def test_links_of_vectors_are_those_of_brute_force(spark, shard):
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(25):
        centre = rng.normal(size=16)
        label = int(rng.integers(0, 3))
        for _ in range(int(rng.integers(1, 14))):
            rows.append((len(rows), label, (centre + rng.normal(size=16) * rng.choice([0, 0.05, 0.3])).astype(np.float32).tolist()))
    nan = float("nan")
    n = len(rows)
    rows += [(n, 1, None), (n + 1, 1, [0.0] * 16), (n + 2, 1, [nan] * 16), (n + 3, None, rows[0][2]), (n + 4, 1, [None] * 16),
             (n + 5, 1, []), (n + 6, 1, [1.0, 2.0]), (n + 7, 1, [float("inf")] * 16), (None, 1, rows[0][2])]
    table = spark.createDataFrame([*rows, rows[3]], "vec_id bigint, label int, embedding array<float>")
    got = vectors.near_duplicates(table, shard_nodes=shard).collect()
    links = plain_links(rows)
    degree = defaultdict(int)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    want = roots([r[0] for r in rows if r[0] is not None], links)
    assert len(got) == len(rows)
    assert {r["vec_id"]: r["n_links"] for r in got} == {r[0]: degree[r[0]] for r in rows}
    assert {r["vec_id"]: r["component_id"] for r in got if r["vec_id"] is not None} == want
    assert vectors.near_duplicates(table.limit(0)).count() == 0


def test_graph_search_recall_and_widening():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(60, 24))
    x = np.concatenate([centres[rng.integers(0, 60, 1500)] + rng.normal(size=(1500, 24)) * 0.05, rng.normal(size=(1500, 24)),
                        centres[:1] + rng.normal(size=(300, 24)) * 0.01])
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    graph = vectors.Graph(x)
    beam = vectors.audited_beam(graph, x, x, 0.93)
    found = sum(len(a) for a, _ in vectors.linked(graph, x, x, 0.93, beam))
    assert found >= 0.99 * int((x @ x.T >= 0.93).sum())
    ids, _ = graph.nearest(x[:200], 32)
    best = np.argsort(-(x[:200] @ x.T), axis=1)[:, :1]
    assert np.mean([b in row for b, row in zip(best[:, 0], ids)]) > 0.95


# --- quotations ----------------------------------------------------------

def test_quotes_lead_to_their_messages(spark):
    rows = [
        (1, 0, "user", "Hello there my friend\nhow are   you today"),
        (1, 1, "a", "On Monday X wrote:\n> hello there my friend\n> how are you today\nFine thanks"),
        (1, 2, "user", "> > Hello there my friend\n> > how are you today\n> Fine thanks\n\nGood."),
        (1, 3, "user", "no quote"), (2, 0, "u", "> how are you today\nagain"), (2, 1, "u", None),
        (None, 1, "u", "> no quote\nx"), (3, 0, "u", ""), (3, 1, None, "> unknown line\nok"), (3, 1, None, "> unknown line\nok"),
    ]
    table = spark.createDataFrame([(*r, 0) for r in rows], "conv_id bigint, turn bigint, role string, text string, parent_turn int")
    got = [tuple(r) for r in quotes.conversations(table).select("conv_id", "turn", "text", "n_passages", "n_linked", "parent_conv", "parent_turn", "thread_conv", "thread_turn").collect()]
    assert sorted(got, key=str) == sorted([
        (1, 0, "Hello there my friend\nhow are   you today", 0, 0, None, None, 1, 0),
        (1, 1, "Fine thanks", 1, 1, 1, 0, 1, 0), (1, 2, "Good.", 2, 2, 1, 1, 1, 0),
        (1, 3, "no quote", 0, 0, None, None, 1, 3), (2, 0, "again", 1, 1, 1, 0, 1, 0), (2, 1, None, 0, 0, None, None, 2, 1),
        (None, 1, "x", 0, 0, None, None, None, 1), (3, 0, "", 0, 0, None, None, 3, 0),
        (3, 1, "ok", 1, 0, None, None, 3, 1), (3, 1, "ok", 1, 0, None, None, 3, 1)], key=str)
    order = [(r[7], r[8], r[1]) for r in got if r[7] is not None]
    assert order == sorted(order)
    assert quotes.conversations(table.limit(0)).count() == 0


def test_long_chains_of_answers_have_one_root(spark):
    rows = [(7, 0, "u", "start of it all")] + [(7, t, "u", f"> {'start of it all' if t == 1 else f'answer number {t - 1}'}\nanswer number {t}") for t in range(1, 30)]
    got = quotes.threads(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()
    assert {(r["thread_conv"], r["thread_turn"]) for r in got} == {(7, 0)}
    assert all(r["parent_turn"] == r["turn"] - 1 for r in got if r["turn"])


def test_a_passage_belongs_to_the_message_with_most_of_its_lines(spark):
    first = "A shared greeting\nfirst own line, the longest line of all in this conversation\nsecond own line"
    later = "A shared greeting\n\nthird own line\nfourth own line that is rather long"
    rows = [(1, 0, first), (1, 1, later),
            # the longest line is cut, the others are as they were
            (1, 2, "> first own line, the longest\n> second own line\nyes"),
            # the longer line is of the later message, one is of both
            (1, 3, "> a shared greeting\n> fourth own line that is rather long\nno"),
            # wrapped anew over three lines, below a paragraph of its own
            (2, 0, "> fourth own line\n>   that is\n> rather long\n>\n> unknown\nwrapped"),
            (2, 1, "> third own line fourth own line\n> that is rather long\nparagraph")]
    table = spark.createDataFrame([(c, t, "u", x) for c, t, x in rows], "conv_id bigint, turn bigint, role string, text string")
    got = {(r["conv_id"], r["turn"]): (r["parent_conv"], r["parent_turn"]) for r in quotes.threads(table).collect()}
    assert got[1, 2] == (1, 0) and got[1, 3] == (1, 1) and got[2, 1] == (1, 1)
    assert got[2, 0] == (None, None)  # its line is part of a paragraph of two lines


def quoting(messages):
    """Replies that quote the given messages: whole, nested, in part, wrapped
    anew, with an edited line, and one message that very many quote."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    quoted = lambda c, marks="> ": F.regexp_replace(c, "(?m)^", marks)
    by_conv = Window.partitionBy("conv_id").orderBy("turn", "text")
    rows = messages.where("conv_id is not null and turn is not null and text is not null").withColumns({
        "before": F.lag("text").over(by_conv), "n": F.pmod(F.xxhash64("conv_id", "turn"), F.lit(6))})
    half = F.element_at(F.split("before", r"(?<=[.!?]) "), 1)
    text = (F.when(F.col("before").isNull(), F.col("text"))
            .when(F.col("n") == 0, F.concat(F.lit("X wrote:\n"), quoted(F.col("before")), F.lit("\n"), "text"))
            .when(F.col("n") == 1, F.concat(quoted(F.col("before"), "> > "), F.lit("\n> said before\n"), "text"))
            .when(F.col("n") == 2, F.concat(F.lit("> "), half, F.lit("\n"), "text"))
            .when(F.col("n") == 3, F.concat(quoted(F.regexp_replace("before", "(.{40,60}) ", "$1\n")), F.lit("\n>\n> an added line\n"), "text"))
            .when(F.col("n") == 4, F.concat(F.lit("> HOT   line of all\n"), "text")).otherwise(F.col("text")))
    hot = messages.limit(1).select(F.lit(-1).cast("bigint").alias("conv_id"), F.lit(0).cast("bigint").alias("turn"), F.lit("user").alias("role"),
                                   F.lit("Hot line of all\nanother line").alias("text"))
    lines = F.regexp_replace("text", r"(?<=[.!?]) ", "\n")
    return rows.select("conv_id", "turn", "role", text.alias("text")).withColumn("text", F.when(F.col("turn") % 2 == 0, F.col("text")).otherwise(lines)).unionByName(hot)


def test_quoting_replies_link_as_sql_says(spark, tmp_path):
    import duckdb

    from salesmart.llm.queries import ORACLE_SQL, QUERIES

    messages = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    quoting(messages).write.parquet(f"{tmp_path}/conversations.parquet")
    rows = QUERIES["op2_quotation_linking"](spark, str(tmp_path))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    result = duck.execute(ORACLE_SQL["op2_quotation_linking"])
    names = [c[0] for c in result.description]
    got = [tuple(r) for r in rows.select(*names).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, result.fetchall()))
    linked = [r for r in got if r[names.index("n_linked")]]
    hot = [r for r in linked if r[names.index("parent_conv")] == -1]
    assert len(linked) > 200 and len(hot) > 30


# --- pipeline ------------------------------------------------------------

def test_pipeline_stages_on_their_own_input(spark):
    from salesmart.llm.scratch import kept
    from salesmart.llm.textkit import read

    docs = read(spark, SF, "documents")
    labels = {r["doc_id"]: r["toxic"] for r in read(spark, SF, "labels").collect()}
    items = [tuple(r) for r in read(spark, SF, "benchmark").select("item_id", "text").collect()]
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(kept(stage(spark, seen[-1], SF), f"test-{name}"))
    rows = [{r["doc_id"]: r for r in d.collect()} for d in seen[:-1]]
    assert all(d.columns == docs.columns for d in seen[:-1])
    toxic = [i for i in rows[0] if labels.get(i) == 1]
    clean = [i for i in rows[0] if labels.get(i) == 0]
    assert sum(i in rows[1] for i in toxic) <= 0.1 * len(toxic) and sum(i not in rows[1] for i in clean) == 0
    gone = plain_line_dedup([(i, r["text"]) for i, r in rows[1].items()])
    for i, r in rows[1].items():
        lines = [x for n, x in enumerate(r["text"].split("\n")) if (i, n) not in gone]
        assert (rows[2][i]["text"] == "\n".join(lines)) if i in rows[2] else not any(x.strip() for x in lines)
    left = sorted((i, r["text"]) for i, r in rows[2].items())
    want, _ = plain_classes(left, neardup.fitted_weights(seen[2]))
    assert set(rows[3]) == {left[k][0] for k, root in want.items() if k == root}
    assert all(plain_hits(r["text"], items)[1] == 0 for r in rows[4].values())
    assert all(rows[4][i] == r for i, r in rows[3].items() if plain_hits(r["text"], items)[1] == 0)
    packed = seen[5].collect()
    assert {r["doc_id"] for r in packed} == set(rows[4])
    assert corpus_pipeline.run(spark, SF).count() == len(packed)
