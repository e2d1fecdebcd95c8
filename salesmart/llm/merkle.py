"""Merkle manifest of a dataset: ternary hash trees, one for each source and
one over their roots, with an inclusion proof for every row.

Leaves of a source ascend by ``doc_id``; every three consecutive nodes (the last
run may hold fewer, even one) hash to a node of the next level until one node
remains, the source's subroot. The subroots, ordered by source (null first,
then by UTF-8 bytes), are the leaves of a tree of the same kind.

Places come from one range sort: a row's place is its row number in its
partition plus the counts of the partitions before, so a source with a third
of all rows is sorted by many tasks. Trees are folded in blocks of 3^7
consecutive nodes, seven levels at a time, so no task holds more than
a block and a tree of any size takes a few steps.

Proofs are made by an octopus multiproof. Each leaf partition (a block) has its
leaves' coordinates; level by level, the members of their runs that it neither
has nor derives are the minimal union of missing coordinates. These are
fetched once, by one join of coordinates with stored nodes; the block derives the
interior nodes that its leaves share and expands every leaf's own proof from both.
A node high up is missed by many blocks, so levels are salted by the number
of blocks that can ask for them; nothing is broadcast on purpose.

``folded`` recomputes a root from a leaf and its proof alone.

Defined cases: a null column hashes as ``-``, null sources are a source of their
own; null ids come first and have no digits, so they are never tampered with;
rows with equal ids stand in the order of their digests, and equal rows are leaves
of their own; an empty table gives an empty result; only the five named columns
are used, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesmart.llm.scratch import kept
from salesmart.llm.textkit import workers_ready

ARITY = 3
#: Levels that one task folds: a block has 3^7 = 2,187 nodes.
BLOCK_LEVELS = 7
BLOCK = ARITY**BLOCK_LEVELS
#: Blocks that may ask for one copy of a stored node.
HEAT = 5_000

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


# ------------------------------------------------------------------ leaves


def _framed(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(text: Column | None = None) -> Column:
    """Digest of a row's five columns, with ``text`` in place of its text."""
    values = [F.col(c) for c in COLUMNS[:-1]] + [F.col("text") if text is None else text]
    return F.sha2(F.concat(*map(_framed, values)), 256)


def leaves(docs: DataFrame, tampered: Column | None = None, tampered_text: Column | None = None) -> DataFrame:
    """key (the source's), doc_id, digest and, where ``tampered`` holds, the
    digest of the row with ``tampered_text`` as changed."""
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    changed = F.when(F.coalesce(tampered, F.lit(False)), leaf_digest(tampered_text)) if tampered is not None else F.lit(None).cast("string")
    return docs.select(key.alias("key"), "doc_id", leaf_digest().alias("digest"), changed.alias("changed"))


# -------------------------------------------------------------- pure helpers


def node_digest(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def level_above(digests: list[str]) -> list[str]:
    return [node_digest(digests[i:i + ARITY]) for i in range(0, len(digests), ARITY)]


def levels_over(digests: list[str], count: int, most: int) -> list[list[str]]:
    """The levels over consecutive nodes that begin a run, ``most`` at most, in
    a tree with ``count`` nodes on their level."""
    out: list[list[str]] = []
    while count > 1 and len(out) < most:
        digests, count = level_above(digests), -(-count // ARITY)
        out.append(digests)
    return out


def missing(places: np.ndarray, count: int) -> list[tuple[int, int]]:
    """The minimal union of (level, place) of the nodes that the proofs of some
    leaves need and that those leaves do not give, in a tree of ``count``."""
    out, known, level = [], np.unique(places), 0
    while count > 1:
        runs = np.unique(known // ARITY)
        family = (runs[:, None] * ARITY + np.arange(ARITY)).ravel()
        out += [(level, int(p)) for p in np.setdiff1d(family[family < count], known)]
        known, count, level = runs, -(-count // ARITY), level + 1
    return out


def siblings(place: int, count: int) -> list[tuple[int, list[int]]]:
    """(level, places of a run's others) from a leaf up to the root."""
    out, level = [], 0
    while count > 1:
        first = place - place % ARITY
        out.append((level, [p for p in range(first, min(first + ARITY, count)) if p != place]))
        place, count, level = place // ARITY, -(-count // ARITY), level + 1
    return out


def fold(digest: str, place: int, count: int, proof: list[str]) -> tuple[str, list[str]]:
    """(root, rest of the proof) from a leaf's digest and its siblings."""
    while count > 1:
        at = place % ARITY
        n = min(ARITY, count - (place - at)) - 1
        digest, proof = node_digest([*proof[:at], digest, *proof[at:n]]), proof[n:]
        place, count = place // ARITY, -(-count // ARITY)
    return digest, proof


# --------------------------------------------------------------------- trees


@dataclass
class Trees:
    """Trees by key: leaves (key, place, n, digest and what came along), stored
    nodes of levels 7 and up (key, level, place, digest), and tops (key, n, digest)."""

    leaves: DataFrame
    nodes: DataFrame
    tops: DataFrame


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds place (from 0, by ``order`` within key) and n (rows of the key)."""
    # The scan's row number parts equal rows, so a group of them can be split.
    rows = rows.withColumn("scan", F.monotonically_increasing_id())
    ranged = rows.repartitionByRange("key", *order, "scan").sortWithinPartitions("key", *order, "scan").drop("scan")
    ranged = kept(ranged.withColumn("at", F.monotonically_increasing_id()), "merkle-sorted").withColumn("part", F.shiftrightunsigned("at", 33))
    counts = ranged.groupBy("key", "part").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("key", "part", "first", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"),
                           F.sum("rows").over(Window.partitionBy("key")).alias("n"))
    place = F.col("at") - F.col("first") + F.col("before")
    return ranged.join(counts, ["key", "part"]).withColumn("place", place).drop("at", "part", "first", "before")


_NODES = "key string, level int, place bigint, digest string, n bigint"


def _folded_blocks(base: int):
    """The stored levels over one block of nodes of level ``base``."""
    def run(key: tuple, block: pa.Table) -> pa.Table:
        block = block.sort_by("place")
        count, first = block.column("n")[0].as_py(), block.column("place")[0].as_py()
        made = levels_over(block.column("digest").to_pylist(), count, BLOCK_LEVELS)
        rows = []
        for up, digests in enumerate(made, 1):
            count = -(-count // ARITY)
            if base or up == BLOCK_LEVELS or count == 1:
                rows += [(base + up, first // ARITY**up + i, d, count) for i, d in enumerate(digests)]
        columns = list(zip(*rows, strict=True)) or [()] * 4
        return pa.table([pa.array([key[0].as_py()] * len(rows), pa.string()), *(pa.array(c, t) for c, t in zip(
            columns, (pa.int32(), pa.int64(), pa.string(), pa.int64()), strict=True))], names=["key", "level", "place", "digest", "n"])

    return run


def built(rows: DataFrame, order: list[str]) -> Trees:
    """The trees over ``rows`` (key, digest, columns of ``order``, others)."""
    spark = rows.sparkSession
    workers_ready(spark)
    placed = kept(_placed(rows, order), "merkle-leaves")
    most = placed.agg(F.max("n")).first()[0] or 0
    tops = placed.filter("n = 1").select("key", "digest")
    below, base, steps = placed.filter("n > 1").select("key", "place", "digest", "n"), 0, []
    while most > 1:
        blocks = below.withColumn("block", F.floor(F.col("place") / BLOCK)).groupBy("key", "block")
        step = kept(blocks.applyInArrow(_folded_blocks(base), _NODES), f"merkle-nodes-{base}")
        steps.append(step)
        base, most = base + BLOCK_LEVELS, -(-most // BLOCK)
        below = step.filter((F.col("level") == base) & (F.col("n") > 1)).select("key", "place", "digest", "n")
    nodes = placed.select("key", F.lit(0).alias("level"), "place", "digest", "n").limit(0)
    for step in steps:
        nodes = nodes.unionByName(step)
        tops = tops.unionByName(step.filter("n = 1").select("key", "digest"))
    sizes = placed.groupBy("key").agg(F.max("n").alias("n"))
    return Trees(placed, nodes.drop("n"), kept(tops.join(sizes, "key"), "merkle-tops"))


# -------------------------------------------------------------------- proofs


def _coordinates(batches):
    """Missing coordinates of leaf partitions (key, block, low, high, n)."""
    for batch in batches:
        keys, blocks, levels, places = [], [], [], []
        for key, block, low, high, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for level, place in missing(np.arange(low, high + 1), n):
                keys.append(key), blocks.append(block), levels.append(level), places.append(place)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(blocks, pa.int64()), pa.array(levels, pa.int32()), pa.array(places, pa.int64())],
                                         names=["key", "block", "level", "place"])


def fetched(trees: Trees, blocks: DataFrame) -> DataFrame:
    """The nodes that each of ``blocks`` (key, block, low, high, n) misses."""
    asked = blocks.select("key", "block", "low", "high", "n").mapInArrow(_coordinates, "key string, block bigint, level int, place bigint")
    copies = F.greatest(F.lit(1), F.ceil(F.pow(F.lit(float(ARITY)), F.col("level") + 1 - BLOCK_LEVELS) / HEAT)).cast("bigint")
    asked = asked.withColumn("salt", F.pmod("block", copies))
    nodes = trees.nodes.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), copies - 1)))
    return asked.join(nodes, ["key", "level", "place", "salt"]).drop("salt")


def _expanded(names: list[str], headed: bool):
    """Own proofs of a block's leaves from its leaves and the fetched nodes; a
    row with a rank heads them with what is common to the block's tree."""
    def run(key: tuple, block: pa.Table, far: pa.Table) -> pa.Table:
        block = block.sort_by("place")
        count, first = block.column("n")[0].as_py(), block.column("place")[0].as_py()
        here = [block.column("digest").to_pylist()]
        here += levels_over(here[0], count, BLOCK_LEVELS)
        node = {(level, first // ARITY**level + i): d for level, digests in enumerate(here) for i, d in enumerate(digests)}
        heads = far.filter(pc.is_valid(far.column("rank"))).to_pylist() if headed else []
        node.update(((x["level"], x["place"]), x["digest"]) for x in far.select(["level", "place", "digest"]).to_pylist() if x["level"] is not None)
        # The levels over the block's top node are the same for all its leaves.
        above = [node[level, p] for level, others in siblings(first, count)[BLOCK_LEVELS:] for p in others]
        above += [x for head in heads for x in head["path"]]
        proofs = [[node[level, p] for level, others in siblings(place, count)[:BLOCK_LEVELS] for p in others] + above
                  for place in block.column("place").to_pylist()]
        more = [pa.array([head[c]] * block.num_rows, t) for head in heads for c, t in (("rank", pa.int64()), ("n_sources", pa.int64()), ("subroot", pa.string()))]
        return pa.table([*(block.column(n) for n in names), pa.array(proofs, pa.list_(pa.string())), *more],
                        names=[*names, "proof", "rank", "n_sources", "subroot"][:len(names) + 1 + len(more)])

    return run


def proofs(trees: Trees, sources: DataFrame | None = None) -> DataFrame:
    """The leaves with proof: their siblings, level by level up to the top of
    their own tree, each level from left to right. With ``sources`` (key and the
    columns of a manifest's) the proof goes on to the root, and rank, n_sources
    and subroot follow."""
    leaves = trees.leaves.withColumn("block", F.floor(F.col("place") / BLOCK))
    blocks = leaves.groupBy("key", "block").agg(F.min("place").alias("low"), F.max("place").alias("high"), F.first("n").alias("n"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in trees.leaves.schema) + ", proof array<string>"
    far = fetched(trees, blocks)
    if sources is not None:
        schema += ", rank bigint, n_sources bigint, subroot string"
        heads = blocks.select("key", "block").join(sources.select("key", "rank", "n_sources", "subroot", "path"), "key")
        far = far.unionByName(heads, allowMissingColumns=True)
    both = leaves.groupBy("key", "block").cogroup(far.groupBy("key", "block"))
    return both.applyInArrow(_expanded(trees.leaves.columns, sources is not None), schema)


@dataclass
class Manifest:
    """sources: key, rank, n_sources, subroot, path (the subroot's proof);
    trees: those of the sources; root: the digest over all, None without rows."""

    sources: DataFrame
    trees: Trees
    root: str | None


def manifest(rows: DataFrame) -> Manifest:
    """The manifest over ``leaves`` (or rows of their kind)."""
    trees = built(rows, ["doc_id", "digest"])
    over = built(trees.tops.select(F.lit("").alias("key"), F.col("key").alias("name"), "digest"), ["name"])
    root = over.tops.first()  # one row at most
    sources = proofs(over).select(F.col("name").alias("key"), F.col("place").alias("rank"), F.col("n").alias("n_sources"),
                                  F.col("digest").alias("subroot"), F.col("proof").alias("path"))
    return Manifest(kept(sources, "merkle-sources"), trees, root["digest"] if root else None)


def proven(made: Manifest) -> DataFrame:
    """Every leaf with place, n, rank, n_sources, subroot, root and the whole
    proof, from its siblings up to those of the root's last run."""
    return proofs(made.trees, made.sources).withColumn("root", F.lit(made.root).cast("string"))


def folded(rows: DataFrame, leaf: str = "digest") -> DataFrame:
    """Adds folded_root, recomputed from the digest in column ``leaf`` and the proof alone."""
    workers_ready(rows.sparkSession)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", folded_root string"

    def run(batches):
        for batch in batches:
            out = []
            for digest, place, n, rank, n_sources, proof in zip(
                    *(batch.column(c).to_pylist() for c in (leaf, "place", "n", "rank", "n_sources", "proof")), strict=True):
                top, rest = fold(digest, place, n, proof)
                out.append(fold(top, rank, n_sources, rest)[0])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*batch.schema.names, "folded_root"])

    return rows.mapInArrow(run, schema)
