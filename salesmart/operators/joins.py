"""Join helpers: size-checked broadcast and a fan-out guard."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Broadcast bounds: a side is broadcast only when a bounded job proves it
# has at most this many rows AND at most this many bytes of values (each
# executor holds one copy; Spark's own hard limit is 8 GB). Larger sides are
# joined by shuffle; AQE may still convert the join to a broadcast when
# runtime statistics prove the side small.
DEFAULT_BROADCAST_ROWS = 250_000
DEFAULT_BROADCAST_BYTES = 64 << 20
FIXED_WIDTH_BYTES = 8  # per non-string value


def _value_bytes(df: DataFrame):
    sizes = []
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if kind in ("string", "binary"):
            sizes.append(F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)))
        else:
            sizes.append(F.lit(FIXED_WIDTH_BYTES))
    return sum(sizes[1:], sizes[0]) if sizes else F.lit(0)


def size_within(df: DataFrame, max_rows: int, max_bytes: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes
    of values.

    One aggregate whose tasks send a single row each; no rows of ``df`` are
    shuffled. It scans the whole side once, in parallel.
    """
    row = df.agg(F.count(F.lit(1)).alias("n"),
                 F.coalesce(F.sum(_value_bytes(df)), F.lit(0)).alias("b")).first()
    return row["n"] <= max_rows and row["b"] <= max_bytes


def duplicate_key_count(df: DataFrame, key: str) -> DataFrame:
    """One row: number of key values that occur more than once (NULL keys
    never join, so they are not counted)."""
    return (df.where(F.col(key).isNotNull()).groupBy(key).count()
            .where(F.col("count") > 1).agg(F.count(F.lit(1)).alias("duplicate_keys")))


def assert_unique_key(df: DataFrame, key: str, what: str) -> None:
    """Raise if a dimension key repeats: a left join on it would add rows."""
    dups = duplicate_key_count(df, key).first()["duplicate_keys"]
    if dups:
        raise ValueError(f"{what}: {dups} value(s) of {key} occur more than once; "
                         f"joining would duplicate fact rows (pass allow_fanout=True to accept)")


# Rows of one key that one join task should take at most. A key with more
# fact rows is split over ceil(rows / budget) salted partitions.
DEFAULT_KEY_ROW_BUDGET = 2_000_000
# Bound on the hot keys that are salted (their table is broadcast): those with
# the most rows; AQE splits what the others leave uneven.
MAX_HOT_KEYS = 100_000
# Key hashes counted first, to find out whether any key can be hot at all.
KEY_BUCKETS = 1 << 16
SALT = "_salt"
SALTS = "_salts"
HOT_KEY = "_hot_key"
ROW_ID = "_row_id"


def _bucket(key) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS))


def hot_key_tables(fact: DataFrame, keys: list[str],
                   row_budget: int = DEFAULT_KEY_ROW_BUDGET) -> dict[str, DataFrame]:
    """Hot keys of several join keys: ``_hot_key`` (NULL included) and how many
    salted partitions each needs, for keys with more than ``row_budget`` rows.

    A first pass counts rows by key hash (at most ``KEY_BUCKETS`` rows per key
    column and task). Only keys of buckets over the budget can be hot, so the
    exact second pass, one aggregate per key column that has such buckets,
    reads just those; usually there are none. Count on the input of a chain of
    joins: salting changes only where rows go.
    """
    found = _hot_keys(fact, keys, row_budget)
    # Without hot keys a relation that the planner knows to be empty.
    return {k: t if t is not None else fact.sparkSession.sql(
        f"select cast(null as {fact.schema[k].dataType.simpleString()}) {HOT_KEY}, cast(null as int) {SALTS} where false")
        for k, t in found.items()}


def _hot_keys(fact: DataFrame, keys: list[str], row_budget: int) -> dict[str, DataFrame | None]:
    """``hot_key_tables``, with None for a key column without hot keys."""
    buckets = [_bucket(F.col(k)).alias(k) for k in keys]
    cols = [F.col(k) for k in keys]
    counted = (fact.select(*buckets).groupingSets([[c] for c in cols], *cols)
               .agg(F.count(F.lit(1)).alias("_rows"), F.grouping_id(*cols).alias("_gid"))
               .where(F.col("_rows") > row_budget).collect())  # at most KEY_BUCKETS rows a key
    tables: dict[str, DataFrame | None] = {}
    for i, k in enumerate(keys):
        gid = (1 << len(keys)) - 1 - (1 << (len(keys) - 1 - i))
        full = [r[k] for r in counted if r["_gid"] == gid]
        if not full:
            tables[k] = None
            continue
        some = fact.select(F.col(k).alias(HOT_KEY))
        if len(full) < KEY_BUCKETS // 8:  # else nearly every bucket: count all keys
            some = some.where(_bucket(F.col(HOT_KEY)).isin(full))
        tables[k] = (some.groupBy(HOT_KEY).agg(F.count(F.lit(1)).alias("_rows"))
                     .where(F.col("_rows") > row_budget)
                     .orderBy(F.desc("_rows"), HOT_KEY).limit(MAX_HOT_KEYS)
                     .select(HOT_KEY, F.ceil(F.col("_rows") / F.lit(row_budget)).cast("int").alias(SALTS))
                     .checkpoint(eager=True))
    return tables


def salted_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "left",
                row_budget: int = DEFAULT_KEY_ROW_BUDGET,
                hot: DataFrame | None = None) -> DataFrame:
    """Left or inner join of a large fact with a large dimension, robust to
    hot keys.

    Rows of a hot key get the salt ``xxhash64(row id) mod salts`` and the
    dimension row of that key is repeated once per salt. The row id numbers
    the rows of the fact's scan (or is the column ``_row_id``, where a chain
    of joins numbered them before its first shuffle): a retried scan task
    numbers them alike, equal rows get different ids, and no column is read
    for it. The join then shuffles on (key, salt): a key holding a third of
    all rows is spread over many tasks. Cold keys keep salt 0 and join as
    usual. NULL keys never match and are spread the same way. ``hot`` may
    pass a hot-key table computed earlier (``hot_key_tables``). Where no key is
    hot there is nothing to salt: a plain join on the key.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"salted join supports left and inner joins, not {how!r}")
    if hot is None:
        hot = _hot_keys(fact, [key], row_budget)[key]
        if hot is None:
            return fact.join(dim, on=key, how=how)
    hot = F.broadcast(hot)  # at most MAX_HOT_KEYS rows
    salts = F.coalesce(F.col(SALTS), F.lit(1))
    fact_cols = fact.columns
    numbered = fact if ROW_ID in fact_cols else fact.withColumn(ROW_ID, F.monotonically_increasing_id())
    salted_fact = (numbered.join(hot, F.col(key).eqNullSafe(F.col(HOT_KEY)), "left")
                   .select(*fact_cols,
                           F.pmod(F.xxhash64(ROW_ID), salts).cast("int").alias(SALT)))
    salted_dim = (dim.join(hot, F.col(key) == F.col(HOT_KEY), "left")
                  .select(*dim.columns, F.explode(F.sequence(F.lit(0), salts - 1)).alias(SALT)))
    return salted_fact.join(salted_dim, on=[key, SALT], how=how).drop(SALT)


def broadcastable(dim: DataFrame, broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> bool:
    return bool(broadcast_rows and broadcast_rows > 0
                and size_within(dim, broadcast_rows, DEFAULT_BROADCAST_BYTES))


def join_dimension(fact: DataFrame, dim: DataFrame, key: str, how: str = "left",
                   broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                   row_budget: int = DEFAULT_KEY_ROW_BUDGET) -> DataFrame:
    """Fact x dimension (left or inner): broadcast when the dimension is
    proven small, else a salted shuffle join that splits hot keys."""
    return dimension_join(fact, dim, key, how, broadcast_rows, row_budget)(fact)


def dimension_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "left",
                   broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                   row_budget: int = DEFAULT_KEY_ROW_BUDGET) -> Callable[[DataFrame], DataFrame]:
    """``join_dimension`` for several parts of a fact: the dimension's size and
    the hot keys are found once, on ``fact``, and serve the join of each part."""
    if broadcastable(dim, broadcast_rows):
        return lambda part: part.join(F.broadcast(dim), on=key, how=how)
    hot = _hot_keys(fact, [key], row_budget)[key]
    if hot is None:
        return lambda part: part.join(dim, on=key, how=how)
    return lambda part: salted_join(part, dim, key, how, row_budget, hot=hot)


def join_dimensions(fact: DataFrame, dims: list[tuple[DataFrame, str]], how: str = "left",
                    broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                    row_budget: int = DEFAULT_KEY_ROW_BUDGET,
                    counted: DataFrame | None = None) -> DataFrame:
    """A chain of fact x dimension joins, each broadcast when proven small;
    the hot keys of all the others are counted in one pass over the fact, or
    over ``counted``, a cheaper frame of the same keys where the fact itself is
    the result of a join. Only keys found hot are salted."""
    return dimensions_join(fact, dims, how, broadcast_rows, row_budget, counted)(fact)


def dimensions_join(fact: DataFrame, dims: list[tuple[DataFrame, str]], how: str = "left",
                    broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                    row_budget: int = DEFAULT_KEY_ROW_BUDGET,
                    counted: DataFrame | None = None) -> Callable[[DataFrame], DataFrame]:
    """``join_dimensions`` for several parts of a fact: the dimensions' sizes and
    the hot keys are found once, on ``fact``, and serve the joins of each part."""
    # The size checks are independent small jobs: submit them together.
    with ThreadPoolExecutor(max_workers=max(1, len(dims))) as pool:
        small = list(pool.map(lambda d: broadcastable(d[0], broadcast_rows), dims))
    plan = [(dim, key, is_small) for (dim, key), is_small in zip(dims, small)]
    keys = [key for _, key, small in plan if not small]
    hot = _hot_keys(fact if counted is None else counted, keys, row_budget) if keys else {}
    salted = any(t is not None for t in hot.values())

    def joined(part: DataFrame) -> DataFrame:
        # Rows are numbered once, on the scan, before any join shuffles them.
        out = part.withColumn(ROW_ID, F.monotonically_increasing_id()) if salted else part
        for dim, key, small in plan:
            if small:
                out = out.join(F.broadcast(dim), on=key, how=how)
            elif hot[key] is None:
                out = out.join(dim, on=key, how=how)
            else:
                out = salted_join(out, dim, key, how, row_budget, hot=hot[key])
        return out.drop(ROW_ID)

    return joined
