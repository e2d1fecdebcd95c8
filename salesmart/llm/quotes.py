"""Quotation linking: reply-ordered conversations without quotes, in DataFrame
operations only.

A line's quote level is the number of ``>`` marks before its text. Neighbouring
lines of one level above 0 are a quoted passage; the lines of level 0 are the
message's own text, of which a line ending in ``wrote:`` just before a quoted
line is not part. Passages and own texts are normalised (lower case, single
spaces) and hashed, as wholes and by all their parts: every line, and every
paragraph (the lines between blank ones, joined, so it does not matter where a
mail client has wrapped them). A passage belongs to the earliest message of its
conversation, before the quoting one, that has the whole passage as its text.
Else each part names the earliest message of the conversation, before the
quoting one, that has it, and the message with the most characters in parts
that name it wins (then most parts, then the earlier one). Else the same holds
for the messages of all conversations that come before the quoting one by
(conv_id, turn): the whole passage first, then the parts.

A message answers the source of its linked passage of the least level (the
later message, where several are linked on it). Answers lead back to a root;
they are followed by pointer doubling, in log2(longest chain) rounds. The
order of a conversation is (thread_conv, thread_turn, turn, conv_id): a root,
then everything that answers it, directly or not, after what it answers.

Sources are found as minima by key before any join, so a first turn or line
that very many messages share costs one row each, not pairs.

Defined cases: null text has no lines, no quotes, and a null own text; a null
conv_id or turn links to nothing and is its own thread; rows equal in conv_id,
turn, role and text get the same answer; rows equal in conv_id and turn only
are one node, with the least answer; an empty table gives an empty result;
only the named columns are used, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesmart.llm.scratch import kept, removed

_MARKS = r"^((?:[ \t]*>)+)"
_QUOTES = r"(?m)^[ \t]*>"
_MESSAGE = ["conv_id", "turn", "role", "text"]


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def _lines(text: Column) -> Column:
    """Lines as (level, body)."""
    return F.transform(F.split(text, "\n"), lambda x: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(x, _MARKS, 1), "[^>]", "")).alias("level"),
        F.regexp_replace(x, _MARKS + "[ \t]?", "").alias("body")))


def _key(text: Column) -> Column:
    """Two hashes of a normalised text; null where it is empty."""
    return F.when(text != "", F.struct(F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")))


def own_text(text: Column) -> Column:
    """The text without quoted lines and the lines that announce them."""
    announced = F.regexp_replace(text, r"(?m)^(?![ \t]*>)[^\n]*wrote:[ \t]*\n(?=[ \t]*>)", "")
    kept_lines = F.filter(F.split(announced, "\n"), lambda x: ~x.rlike(r"^[ \t]*>"))
    plain = F.regexp_replace(F.array_join(kept_lines, "\n"), r"^\s+|\s+$", "")
    return F.when(text.rlike(_QUOTES), F.regexp_replace(plain, "\n{3,}", "\n\n")).otherwise(text)


def _parts(text: Column) -> Column:
    """Distinct normalised lines and paragraphs of a text that are not blank."""
    parts = F.transform(F.concat(F.split(text, "\n"), F.split(text, r"\n\s*\n")), _normal)
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def passages(messages: DataFrame) -> DataFrame:
    """The quoted passages: the message's columns, passage (its number), level,
    whole (key of the passage) and parts (normalised lines and paragraphs)."""
    quoting = messages.filter(F.col("text").rlike(_QUOTES) & F.col("conv_id").isNotNull() & F.col("turn").isNotNull()).distinct()
    lines = quoting.select(*_MESSAGE, F.xxhash64(*_MESSAGE).alias("m"), F.posexplode(_lines(F.col("text"))).alias("at", "line"))
    order = Window.partitionBy("m", *_MESSAGE).orderBy("at")
    new = (F.col("line.level") != F.lag("line.level", 1, -1).over(order)).cast("int")
    lines = lines.withColumn("new", new).withColumn("passage", F.sum("new").over(order)).filter("line.level > 0")
    body = F.transform(F.sort_array(F.collect_list(F.struct("at", "line.body"))), lambda x: x["body"])
    out = lines.groupBy("m", *_MESSAGE, "passage").agg(F.first("line.level").alias("level"), F.array_join(body, "\n").alias("body"))
    return out.select(*_MESSAGE, "passage", "level", _key(_normal(F.col("body"))).alias("whole"), _parts(F.col("body")).alias("parts"))


def _sources(messages: DataFrame) -> DataFrame:
    """kind, key, conv_id, turn: the texts and parts that can be quoted."""
    own = messages.filter("conv_id is not null and turn is not null").select("conv_id", "turn", own_text(F.col("text")).alias("own"))
    whole = own.select(F.lit("whole").alias("kind"), _key(_normal(F.col("own"))).alias("key"), "conv_id", "turn")
    parts = own.select("conv_id", "turn", F.explode(_parts(F.col("own"))).alias("part"))
    parts = parts.select(F.lit("part").alias("kind"), _key(F.col("part")).alias("key"), "conv_id", "turn")
    return whole.unionByName(parts).filter("key is not null")


def answers(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, n_passages, n_linked, parent_conv,
    parent_turn of each distinct message that quotes."""
    found = kept(passages(messages), "quotes-passages")
    keys = ["kind", "key"]
    whole = F.array(F.struct(F.lit("whole").alias("kind"), F.col("whole").alias("key"), F.lit(0).alias("chars")))
    parts = F.transform("parts", lambda x: F.struct(F.lit("part").alias("kind"), _key(x).alias("key"), F.length(x).alias("chars")))
    asked = found.select(*_MESSAGE, "passage", "level", F.explode(F.concat(whole, parts)).alias("q")).select(*_MESSAGE, "passage", "level", "q.*")
    wanted = asked.select(*keys).distinct()
    sources = kept(_sources(messages).join(wanted, keys, "left_semi"), "quotes-sources")
    inside = sources.groupBy(*keys, "conv_id").agg(F.min("turn").alias("in_turn"))
    anywhere = sources.groupBy(*keys).agg(F.min(F.struct("conv_id", "turn")).alias("of"))
    place = F.struct("conv_id", "turn")
    linked = asked.join(inside, [*keys, "conv_id"], "left").join(anywhere, keys, "left").select(
        *_MESSAGE, "passage", "level", "chars",
        # The better kind of link has the lower rank.
        F.when(F.col("in_turn") < F.col("turn"), F.struct(
            F.when(F.col("kind") == "whole", 0).otherwise(1).alias("rank"), F.col("conv_id").alias("conv"), F.col("in_turn").alias("turn")))
        .when(F.col("of") < place, F.struct(
            F.when(F.col("kind") == "whole", 2).otherwise(3).alias("rank"), F.col("of.conv_id").alias("conv"), F.col("of.turn").alias("turn"))).alias("link"))
    votes = linked.groupBy(*_MESSAGE, "passage", "level", "link").agg(F.sum("chars").alias("chars"), F.count("*").alias("n"))
    winner = F.min(F.when(F.col("link").isNotNull(), F.struct(
        F.col("link.rank").alias("rank"), (-F.col("chars")).alias("chars"), (-F.col("n")).alias("n"), F.col("link.conv").alias("conv"), F.col("link.turn").alias("turn"))))
    per_passage = votes.groupBy(*_MESSAGE, "passage", "level").agg(winner.alias("link"))
    best = F.min(F.when(F.col("link").isNotNull(), F.struct("level", (-F.col("link.turn")).alias("later"), F.col("link.conv").alias("conv"))))
    return per_passage.groupBy(*_MESSAGE).agg(
        F.count("*").alias("n_passages"), F.count("link").alias("n_linked"), best.alias("best")).select(
        *_MESSAGE, "n_passages", "n_linked", F.col("best.conv").alias("parent_conv"), (-F.col("best.later")).alias("parent_turn"))


def _roots(links: DataFrame) -> DataFrame:
    """node, root (structs of conv and turn) of every node with a parent."""
    spark = links.sparkSession
    state = kept(links, "quotes-roots")
    while True:
        above = state.select(F.col("node").alias("root"), F.col("root").alias("above"))
        following = kept(state.join(above, "root", "left").select("node", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")), "quotes-roots")
        removed(spark, state)
        moving = following.filter("moved").limit(1).count()
        state = following.select("node", "root")
        if not moving:
            return state


def threads(messages: DataFrame) -> DataFrame:
    """Every message without its quotes: conv_id, turn, role, text, n_passages,
    n_linked, parent_conv, parent_turn, thread_conv, thread_turn, and the turn
    in chat form."""
    messages = messages.select(*_MESSAGE)
    found = kept(answers(messages), "quotes-answers")
    node = F.struct(F.col("conv_id").alias("conv"), F.col("turn").alias("turn"))
    links = (found.filter("parent_turn is not null").groupBy(node.alias("node"))
             .agg(F.min(F.struct(F.col("parent_conv").alias("conv"), F.col("parent_turn").alias("turn"))).alias("root")))
    roots = _roots(links).select(F.col("node.conv").alias("node_conv"), F.col("node.turn").alias("node_turn"), "root")
    # Only quoting messages can have an answer, so the others skip the join keys.
    found = found.select(*(F.col(c).alias(f"found_{c}") for c in _MESSAGE), "n_passages", "n_linked", "parent_conv", "parent_turn")
    same = [F.col(c).eqNullSafe(F.col(f"found_{c}")) for c in ("role",)] + [F.col(c) == F.col(f"found_{c}") for c in ("conv_id", "turn", "text")]
    at = [F.col("conv_id") == F.col("node_conv"), F.col("turn") == F.col("node_turn")]
    out = messages.join(found, same, "left").join(roots, at, "left")
    own = own_text(F.col("text"))
    return out.select(
        "conv_id", "turn", "role", own.alias("text"), F.coalesce("n_passages", F.lit(0)).cast("bigint").alias("n_passages"),
        F.coalesce("n_linked", F.lit(0)).cast("bigint").alias("n_linked"), "parent_conv", "parent_turn",
        F.coalesce("root.conv", "conv_id").alias("thread_conv"), F.coalesce("root.turn", "turn").alias("thread_turn"),
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.coalesce(own, F.lit("")), F.lit("\n")).alias("chat"))


def conversations(messages: DataFrame) -> DataFrame:
    """``threads`` in the order of the conversations, sorted by range."""
    return threads(messages).orderBy("thread_conv", "thread_turn", "turn", "conv_id")
