"""Embedding near-duplicates with HNSW graphs.

Equal vectors of one label are one node with a weight. The nodes of a label are
split by their hash into shards of about ``SHARD_NODES``; each shard gets a
hierarchical navigable small-world graph. Every node then queries every shard
of its label, a task for each pair of shards, so neither a common label nor the
whole table meets in one task. A search with a beam that holds nothing but
links is repeated with a beam four times as wide; sampled queries of each task are
audited against all nodes of the shard, and all beams are widened until the
audit's recall passes. A beam that reaches a sixteenth of the shard becomes the
whole shard, in blocks. All links are verified by cosine in double precision.

A task returns per node the weight it links, and of the links a spanning
forest only, so a group of near copies yields rows in proportion to its size.
Components are united by distributed star steps.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows with a null label or vec_id, link with nothing; vectors
of different length link with nothing; repeated rows (vec_id, label and vector
equal) count and are returned once; an empty table gives an empty result; only
the named columns are used, so other columns cannot clash.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.components import components
from salesmart.llm.scratch import kept
from salesmart.llm.textkit import workers_ready

THRESHOLD = 0.93
SHARD_NODES = 20_000
#: Links of a node on the upper layers and on the ground layer; the beams of
#: building and of the first search; queries worked on together.
DEGREE, GROUND_DEGREE, BUILD_BEAM, FIRST_BEAM, BATCH = 12, 24, 48, 32, 256
AUDIT, RECALL = 48, 0.99
#: Nearest nodes that a sampled query must have in its beam, and the share found.
AUDIT_NEAREST, NEAREST_RECALL = 2, 0.9


class Graph:
    """A hierarchical navigable small-world graph over unit vectors."""

    def __init__(self, vectors: np.ndarray):
        self.x = vectors.astype(np.float32)
        n = len(vectors)
        rng = np.random.default_rng(n)
        heights = np.floor(-np.log(rng.random(n) + 1e-12) / math.log(DEGREE)).astype(int)
        order = np.argsort(-heights, kind="stable")  # high nodes first: they are the entries
        heights = heights[order]
        self.order, self.x = order, self.x[order]
        self.layers: list[np.ndarray] = []
        for layer in range(int(heights[0]) + 1 if n else 0):
            size = int(np.searchsorted(-heights, -layer, side="right"))
            self.layers.append(np.full((size, GROUND_DEGREE if layer == 0 else DEGREE), -1, np.int32))
        at = 1
        while at < n:
            # A batch at most doubles the graph; its members see each other too.
            batch = np.arange(at, min(n, at + min(BATCH, max(8, at))))
            self._insert(batch, heights[batch], at)
            at = int(batch[-1]) + 1

    def _insert(self, batch: np.ndarray, heights: np.ndarray, before: int) -> None:
        entry = np.zeros((len(batch), 1), np.int32)
        among = self.x[batch] @ self.x[batch].T
        np.fill_diagonal(among, -2)
        for layer in range(len(self.layers) - 1, -1, -1):
            links = self.layers[layer]
            ids, sims = self.search(self.x[batch], entry, layer, BUILD_BEAM if layer == 0 else DEGREE * 2, before)
            entry = ids[:, :4].copy()
            here = heights >= layer
            if not here.any():
                continue
            rows = np.flatnonzero(here)
            close = np.argsort(-among[np.ix_(rows, rows)], axis=1)[:, :DEGREE]
            mates, mate_sims = batch[rows][close], np.take_along_axis(among[np.ix_(rows, rows)], close, 1)
            ids = np.concatenate([ids[rows], mates.astype(np.int32)], 1)
            sims = np.concatenate([sims[rows], np.where(mate_sims > -2, mate_sims, -9)], 1)
            ids = np.where(sims > -3, ids, -1)
            self._link(links, batch[rows], ids, sims)

    def _diverse(self, ids: np.ndarray, sims: np.ndarray, degree: int) -> np.ndarray:
        """Up to ``degree`` neighbours of each row, the near ones first, that are
        nearer to the node than to a neighbour taken before; then the nearest
        of the others, so that places stay in use."""
        order = np.argsort(-sims, axis=1)
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        vectors = self.x[np.maximum(ids, 0)]
        cross = np.einsum("bid,bjd->bij", vectors, vectors)
        b, k = ids.shape
        taken = np.zeros((b, k), bool)
        for j in range(k):
            near = np.where(taken, cross[:, j, :], -2).max(1)
            taken[:, j] = (ids[:, j] >= 0) & (sims[:, j] > near) & (taken.sum(1) < degree * 3 // 4)
        rank = np.where(ids < 0, 3, np.where(taken, 0, 1)) * 10.0 - sims
        first = np.argsort(rank, axis=1)[:, :degree]
        return np.take_along_axis(ids, first, 1)

    def _link(self, links: np.ndarray, nodes: np.ndarray, ids: np.ndarray, sims: np.ndarray) -> None:
        degree = links.shape[1]
        chosen = self._diverse(ids, sims, degree // 2)
        links[nodes, :chosen.shape[1]] = chosen
        # Back links, grouped by target; targets with too many keep a diverse part.
        source = np.repeat(nodes, chosen.shape[1])
        target = chosen.ravel()
        good = target >= 0
        source, target = source[good], target[good]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        heads, first, counts = np.unique(target, return_index=True, return_counts=True)
        if not len(heads):
            return
        wide = int(counts.max())
        extra = np.full((len(heads), wide), -1, np.int32)
        extra[np.repeat(np.arange(len(heads)), counts), np.arange(len(target)) - np.repeat(first, counts)] = source
        both = np.concatenate([links[heads], extra], 1)
        both.sort(axis=1)
        both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
        full = (both >= 0).sum(1) > degree
        if full.any():
            some = both[full]
            near = np.einsum("bd,bkd->bk", self.x[heads[full]], self.x[np.maximum(some, 0)])
            kept_ids = self._diverse(some, np.where(some >= 0, near, -9), degree)
            links[heads[full]] = kept_ids
        rest = -np.sort(-both[~full], axis=1)[:, :degree]
        links[heads[~full], :rest.shape[1]] = rest

    def search(self, queries: np.ndarray, entry: np.ndarray, layer: int, beam: int, size: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, similarities), best first, of a beam search on one layer;
        places not filled have similarity -9."""
        links = self.layers[layer]
        b = len(queries)
        size = len(links) if size is None else min(size, len(links))
        seen = np.zeros((b, len(links) + 1), bool)  # the last column takes the empty places
        rows = np.arange(b)[:, None]
        ids = np.full((b, beam), -1, np.int32)
        sims = np.full((b, beam), -9, np.float32)
        done = np.zeros((b, beam), bool)
        start = np.where((entry >= 0) & (entry < size), entry, 0)
        start.sort(axis=1)
        start[:, 1:][start[:, 1:] == start[:, :-1]] = -1
        w = min(start.shape[1], beam)
        start = -np.sort(-start, axis=1)[:, :w]
        ids[:, :w] = start
        sims[:, :w] = np.where(start >= 0, np.einsum("bd,bkd->bk", queries, self.x[np.maximum(start, 0)]), -9)
        seen[rows, start] = True
        live = np.arange(b)
        while len(live):
            s = np.where(done[live] | (sims[live] < -3), -9, sims[live])
            best = s.argmax(1)
            open_rows = s[np.arange(len(live)), best] > -3
            live, best = live[open_rows], best[open_rows]
            if not len(live):
                break
            done[live, best] = True
            near = links[ids[live, best]]
            fresh = (near >= 0) & (near < size) & ~seen[live[:, None], near]
            seen[live[:, None], np.where(near >= 0, near, len(links))] = True
            new = np.where(fresh, np.einsum("bd,bkd->bk", queries[live], self.x[np.maximum(near, 0)]), -9)
            all_sims = np.concatenate([sims[live], new], 1)
            top = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            sims[live] = np.take_along_axis(all_sims, top, 1)
            ids[live] = np.take_along_axis(np.concatenate([ids[live], near], 1), top, 1)
            done[live] = np.take_along_axis(np.concatenate([done[live], np.zeros_like(fresh)], 1), top, 1)
        order = np.argsort(-sims, axis=1)
        return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)

    def nearest(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Beam search from the top layer down; ids are those of the caller."""
        q = queries.astype(np.float32)
        entry = np.zeros((len(q), 1), np.int32)
        for layer in range(len(self.layers) - 1, 0, -1):
            entry = self.search(q, entry, layer, DEGREE)[0][:, :4]
        ids, sims = self.search(q, entry, 0, beam)
        return np.where(sims > -3, self.order[np.maximum(ids, 0)], -1), sims


def linked(graph: Graph, vectors: np.ndarray, queries: np.ndarray, threshold: float, beam: int):
    """Per batch of queries: (query numbers, node numbers) of verified links.
    Beams are widened query by query while they hold nothing but links."""
    n = len(vectors)
    for at in range(0, len(queries), BATCH):
        todo, wide = np.arange(at, min(at + BATCH, len(queries))), beam
        pairs = []
        while len(todo):
            if wide * 16 >= n:
                sims = queries[todo] @ vectors.T
                q, node = np.nonzero(sims >= threshold)
                pairs.append((todo[q], node))
                break
            ids, sims = graph.nearest(queries[todo], wide)
            more = sims[:, -1] >= threshold - 1e-4
            q, k = np.nonzero((sims >= threshold - 1e-4) & ~more[:, None])
            node = ids[q, k]
            sure = np.einsum("kd,kd->k", queries[todo[q]], vectors[node]) >= threshold
            pairs.append((todo[q][sure], node[sure]))
            todo, wide = todo[more], wide * 4
        yield np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])


def audited_beam(graph: Graph, vectors: np.ndarray, queries: np.ndarray, threshold: float) -> int:
    """The first beam with which sampled queries find enough of their links and
    of their nearest nodes. A query itself counts as neither, so a sample whose
    links are few is judged by neighbours that all of it has."""
    sample = queries[np.linspace(0, len(queries) - 1, min(AUDIT, len(queries))).astype(int)]
    sims = sample @ vectors.T
    sims[sims >= 1 - 1e-12] = -2  # the query itself, or a copy
    there = int((sims >= threshold).sum())
    nearest = np.argsort(-sims, axis=1)[:, :AUDIT_NEAREST]
    beam = FIRST_BEAM
    while beam * 16 < len(vectors):
        found = sum(int((sims[q, node] >= threshold).sum()) for q, node in linked(graph, vectors, sample, threshold, beam))
        ids, _ = graph.nearest(sample, beam)
        met = np.mean([np.isin(a, b).mean() for a, b in zip(nearest, ids, strict=True)]) if len(sample) else 1.0
        if found >= RECALL * there and met >= NEAREST_RECALL:
            break
        beam *= 2
    return beam


def _unit(column: pd.Series) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in column])
    x /= np.abs(x).max(1, keepdims=True)  # squares of extreme components would over- or underflow
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _forest(a: np.ndarray, b: np.ndarray, labels: np.ndarray) -> None:
    """Joins the labels of linked nodes, in place, under the least label."""
    while True:
        least = np.minimum(labels[a], labels[b])
        before = labels.copy()
        np.minimum.at(labels, labels[a], least)
        np.minimum.at(labels, labels[b], least)
        labels[:] = labels[labels]
        if (before == labels).all():
            return


def _pair_task(threshold: float):
    def run(queries: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(nodes):
            q, x = _unit(queries["embedding"]), _unit(nodes["embedding"])
            q_id, x_id, weight = queries["rep"].to_numpy(), nodes["rep"].to_numpy(), nodes["weight"].to_numpy()
            graph = Graph(x)
            every = np.unique(np.concatenate([q_id, x_id]))
            labels, counts = np.arange(len(every)), np.zeros(len(q_id), np.int64)
            for a, b in linked(graph, x, q, threshold, audited_beam(graph, x, q, threshold)):
                other = q_id[a] != x_id[b]
                a, b = a[other], b[other]
                np.add.at(counts, a, weight[b])
                _forest(np.searchsorted(every, q_id[a]), np.searchsorted(every, x_id[b]), labels)
            moved = labels != np.arange(len(every))
            out = [pd.DataFrame({"a": q_id, "b": q_id, "n": counts}),
                   pd.DataFrame({"a": every[moved], "b": every[labels[moved]], "n": 0})]
        return pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "n": []}, dtype="int64")

    return run


def near_duplicates(rows: DataFrame, threshold: float = THRESHOLD, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """vec_id, n_links, component_id, kept for rows (vec_id, label, embedding)."""
    workers_ready(rows.sparkSession)
    rows = rows.select("vec_id", "label", "embedding").distinct()
    # NaN counts as the largest value, so it shows in the maximum.
    largest = F.array_max(F.transform("embedding", lambda x: F.abs(x.cast("double"))))
    good = F.exists("embedding", lambda x: x.isNull()) | F.isnan(largest) | (largest == float("inf")) | (largest == 0)
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~F.coalesce(good, F.lit(True))
    rows = kept(rows.withColumn("good", F.coalesce(good, F.lit(False))), "vectors")
    nodes = kept(rows.filter("good").groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.countDistinct("vec_id").alias("weight")), "vector-nodes")
    # Lengths join the label: vectors of different length are never compared.
    nodes = nodes.withColumn("size", F.size("embedding"))
    shards = nodes.groupBy("label", "size").agg(F.ceil(F.count("*") / shard_nodes).cast("int").alias("n_shards"))
    placed = nodes.join(shards, ["label", "size"]).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("n_shards")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("n_shards") - 1))
    keys = ["label", "size", "of", "at"]
    columns = [*keys, "rep", "embedding"]
    queries = placed.withColumn("of", F.col("own")).withColumn("at", other).select(columns)
    targets = placed.withColumn("at", F.col("own")).withColumn("of", other).select(*columns, "weight")
    targets = targets.select(*(F.col(c).alias(f"{c}_of_target") for c in keys), *(F.col(c).alias(c) for c in columns[4:]), "weight")
    found = (queries.groupBy(keys).cogroup(targets.groupBy([f"{c}_of_target" for c in keys]))
             .applyInPandas(_pair_task(threshold), "a bigint, b bigint, n bigint"))
    found = kept(found, "vector-links")
    counts = found.filter("a = b").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("linked"))
    groups = components(found.filter("a != b").select("a", "b"), "vector-components")
    known = (nodes.select("label", "embedding", "rep", "weight").join(counts, "rep", "left")
             .join(groups.withColumnRenamed("node", "rep"), "rep", "left")
             .select("label", "embedding", (F.coalesce("linked", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                     F.coalesce("component", "rep").alias("component_id")))
    out = rows.filter("good").join(known, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter("not good").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
