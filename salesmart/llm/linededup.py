"""Line dedup by an exact set-similarity join.

A line's tokens are its distinct five-word shingles; a line of fewer words is
one shingle of all its words, so it matches lines of the same words only, and a
line without a word matches nothing. Lines match at a Jaccard similarity of 0.8 or more.
A line goes if it matches any earlier line; lines are ordered by document id,
then by place in the text.

Lines of equal words are one class, of which the first line stands for all.
Its tokens are ordered by their hash, those that crowd the prefixes of many
lines after all others (counted in a fixed number of counters; lines that held
one get a new prefix, until no further token is found crowded). Two lines that
match share a token among the first ``n - ceil(0.8 n) + 1`` of each, whatever
the order; such prefixes are joined on the token, pairs pass the length and the
positional filter, and whole token sets decide.

Of the lines that share a prefix token, each is first verified against the
earliest; a match settles it. Only lines still not settled are compared with
the other earlier lines of the token, so a large group of alike lines costs
rows in proportion to its size, and no match is missed.

Every step is a DataFrame operation; no Python runs on the executors.

Defined cases: a null or empty text, and a row with null doc_id, stays as it
is and takes no part; rows with equal doc_id and text count as one document
and lose the same lines; equal doc_id and other text are two documents; a
document that loses all lines that hold a character goes in ``deduplicated``;
an empty table gives an empty result; added columns are dropped again and
named with a prefix of their own, so the input's other columns cannot clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesmart.llm.scratch import kept, removed, shuffles_freed
from salesmart.llm.textkit import lowered

SHINGLE = 5
#: The threshold as a fraction, so that bounds are exact integers.
SIMILAR, OF = 4, 5
#: Counters of the prefix tokens (2^18). One with so many entries more than twice
#: the mean has crowded tokens.
COUNTER_BITS = 18
CROWDED = 256
#: Times that crowded tokens are looked for; the order is one and the same for
#: all lines after each, so no match depends on it.
ROUNDS = 4
#: Rows (line numbers by document) that may be broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 500_000

#: Parts of the prefix tokens that are grouped one after the other, so that the
#: shuffle of one only is on the disks at a time.
TOKEN_PARTS = 4

_ID = ["doc_id", "line_no", "text_key"]
_LINE = ["number", *_ID, "n"]
# What is between words, once A-Z are lower case (see textkit).
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_A_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"


def _documents(docs: DataFrame) -> DataFrame:
    return docs.filter("doc_id is not null and text is not null").select("doc_id", F.xxhash64("text").alias("text_key"), "text")


def _split_lines() -> Column:
    """The lines of ``text``, A-Z in lower case."""
    ascii_only = F.octet_length("text") == F.length("text")  # where lower() changes A-Z only
    return F.split(F.when(ascii_only, F.lower("text")).otherwise(lowered(F.col("text"))), "\n")


def _with_tokens(lines: DataFrame) -> DataFrame:
    """The rows whose ``line`` has a word, with the hashes of their ``words``
    and their ``tokens`` (distinct hashes of the shingles)."""
    rows = lines.filter(F.col("line").rlike(_A_WORD))
    words = F.array_remove(F.split("line", _BETWEEN), "")
    rows = rows.withColumn("words", F.transform(words, lambda w: F.xxhash64(w))).drop("line")
    places = F.sequence(F.lit(0), F.greatest(F.size("words") - SHINGLE, F.lit(0)))
    # Beyond the last word is null, which adds nothing to a hash.
    shingles = F.transform(places, lambda i: F.xxhash64(*(F.get("words", i + k) for k in range(SHINGLE))))
    return rows.withColumn("tokens", F.array_distinct(shingles))


def _chosen_lines(docs: DataFrame, chosen: DataFrame, *columns: str) -> DataFrame:
    """``line`` of the lines ``chosen`` by ``_ID``, with those further columns of
    theirs; rows of one document that repeat give their lines again."""
    wanted = chosen.groupBy(F.col("doc_id").alias("of_doc"), F.col("text_key").alias("of_key")).agg(
        F.collect_set(F.struct("line_no", *columns)).alias("wanted"))
    rows = _documents(docs)
    same = (rows["doc_id"] == F.col("of_doc")) & (rows["text_key"] == F.col("of_key"))
    rows = rows.join(_bounded(wanted), same).select("doc_id", "text_key", _split_lines().alias("lines"), "wanted")
    rows = rows.select("doc_id", "text_key", "lines", F.explode("wanted").alias("one"))
    return rows.select("doc_id", "text_key", "one.*", F.get("lines", F.col("one.line_no")).alias("line"))


def _counter(token: Column) -> Column:
    # The low bits: the high ones decide the order, so prefixes have few values of them.
    return token.bitwiseAND(F.lit((1 << COUNTER_BITS) - 1)).cast("int")


def _first_of(ordered: Column) -> Column:
    """The prefix of ``tokens`` in order."""
    n = F.size("tokens")
    return F.slice(ordered, 1, n - ((n * SIMILAR + (OF - 1)) / OF).cast("int") + 1)


def _lines(docs: DataFrame) -> DataFrame:
    """Each line with a word: its id, two hashes of its words, the number of
    its tokens and the first of them by hash."""
    rows = _documents(docs).select("doc_id", "text_key", F.posexplode_outer(_split_lines()).alias("line_no", "line"))
    return _with_tokens(rows).select(*_ID, F.xxhash64("words").alias("k1"), F.xxhash64(F.lit(1), "words").alias("k2"),
                                     F.size("tokens").alias("n"), _first_of(F.sort_array("tokens")).alias("prefix"))


def _uncrowded(firsts: DataFrame, docs: DataFrame) -> DataFrame:
    """The first lines of the classes with prefixes in an order that has
    crowded tokens after all others."""
    places = None
    for _ in range(ROUNDS):
        found = _crowded(firsts, places)
        if found.isEmpty():
            break
        places = found if places is None else kept(places.unionByName(found), "lines-places")
        # Lines that hold a newly crowded token get their prefix in the new order.
        held = firsts.select(*_LINE, F.explode("prefix").alias("token"))
        held = held.join(F.broadcast(found), _counter(held["token"]) == found["counter"]).select(*_LINE).distinct()
        held = kept(held, "lines-held")
        # Kept first: the filter that an explode implies would be pushed below the
        # words, which the lambda of the tokens would then cut again for each shingle.
        cut = kept(_with_tokens(_chosen_lines(docs, held, "number", "n")).select(*_LINE, "tokens"), "lines-tokens")
        again = cut.select(*_LINE, F.explode("tokens").alias("token"))
        again = again.join(F.broadcast(places), _counter(again["token"]) == places["counter"], "left")
        # A set: a document that repeats gives its lines again.
        again = again.groupBy(*_LINE).agg(F.sort_array(F.collect_set(F.struct(F.coalesce("place", F.lit(0)).alias("place"), "token"))).alias("tokens"))
        again = again.select(*_LINE, F.transform(_first_of(F.col("tokens")), lambda s: s["token"]).alias("prefix"))
        others = firsts.join(_bounded(held.select("number")), "number", "left_anti").select(*_LINE, "prefix")
        following = kept(others.unionByName(again), "lines-firsts")
        removed(docs.sparkSession, firsts, held, cut)
        firsts = following
    return firsts


def _crowded(firsts: DataFrame, places: DataFrame | None) -> DataFrame:
    """The counters that many entries share, unless they have a ``place``
    already, with one: the more entries, the later."""
    entries = firsts.select(F.explode("prefix").alias("token")).groupBy(_counter(F.col("token")).alias("counter"))
    counts = kept(entries.agg(F.count("*").alias("entries")), "lines-counts")
    mean = (counts.agg(F.sum("entries")).first()[0] or 0) / (1 << COUNTER_BITS)
    found = counts.filter(F.col("entries") >= CROWDED + 2 * mean)
    if places is not None:
        found = found.join(F.broadcast(places.select("counter")), "counter", "left_anti")
    return kept(found.select("counter", F.log2("entries").cast("int").alias("place")), "lines-crowded")


def _bounded(rows: DataFrame) -> DataFrame:
    """The rows, to be broadcast if they are few enough."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _needed_overlap(a: Column, b: Column) -> Column:
    """Least common tokens of matching lines of a and b tokens."""
    return F.ceil(F.lit(SIMILAR) * (a + b) / F.lit(SIMILAR + OF) - F.lit(1e-9))


def _may_match(n: Column, at: Column, m: Column, to: Column) -> Column:
    """Length filter, and positional filter for the first common token."""
    length = F.least(n, m) * OF >= F.greatest(n, m) * SIMILAR
    return length & (1 + F.least(n - at, m - to) >= _needed_overlap(n, m))


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, name: str) -> DataFrame:
    """The pairs (line, earlier) of class numbers whose whole token sets are
    similar enough."""
    ids = pairs.select(F.col("line").alias("number")).union(pairs.select("earlier")).distinct()
    ids = kept(ids.join(classes.select("number", "first.*"), "number"), f"{name}-lines")
    sets = _with_tokens(_chosen_lines(docs, ids, "number")).select("number", "tokens")
    sets = kept(sets.dropDuplicates(["number"]), f"{name}-sets")
    both = (pairs.join(sets.select(F.col("number").alias("line"), F.col("tokens").alias("mine")), "line")
            .join(sets.select(F.col("number").alias("earlier"), F.col("tokens").alias("other")), "earlier"))
    common = F.size(F.array_intersect("mine", "other"))
    union = F.size("mine") + F.size("other") - common
    matches = kept(both.filter(common * OF >= union * SIMILAR).select("line", "earlier"), f"{name}-matches")
    removed(docs.sparkSession, ids, sets)
    return matches


def _shared(entries: DataFrame) -> DataFrame:
    """The entries of tokens that several lines have, with the ``lead``, the
    first of them."""
    group = Window.partitionBy("token")
    tables = []
    for part in range(TOKEN_PARTS):
        rows = entries.filter(F.pmod("token", F.lit(TOKEN_PARTS)) == part)
        rows = (rows.withColumn("lead", F.min(F.struct("number", "n", "at")).over(group))
                .withColumn("last", F.max("number").over(group)).filter(F.col("last") != F.col("lead.number")).drop("last"))
        tables.append(kept(rows, "lines-shared"))
    return reduce(DataFrame.unionByName, tables)


def removed_lines(docs: DataFrame) -> DataFrame:
    """doc_id, line_no, text_key of each line that matches an earlier one.
    Tables go as soon as no later step reads them."""
    spark = docs.sparkSession
    lines = kept(_lines(docs), "lines")
    # Classes get numbers in the order of their first lines, so that the rows
    # that are joined on tokens are small.
    classes = lines.groupBy("k1", "k2").agg(F.min(F.struct(*_ID)).alias("first"), F.count("*").alias("copies"))
    classes = kept(classes.orderBy("first").withColumn("number", F.monotonically_increasing_id()), "lines-classes")
    firsts = classes.select("number", *(F.col(f"first.{c}").alias(f"first_{c}") for c in _ID))
    firsts = lines.join(firsts, [lines[c] == firsts[f"first_{c}"] for c in _ID]).select(*_LINE, "prefix")
    firsts = kept(firsts, "lines-firsts")
    keys = kept(lines.select(*_ID, "k1", "k2"), "lines-keys")
    removed(spark, lines)
    firsts = _uncrowded(firsts, docs)
    shared = _shared(firsts.select("number", "n", F.posexplode("prefix").alias("at", "token")).withColumn("at", F.col("at") + 1))
    removed(spark, firsts)
    lead = F.col("lead")
    followers = shared.filter(F.col("number") != lead["number"])
    pairs = followers.filter(_may_match(F.col("n"), F.col("at"), lead["n"], lead["at"]))
    pairs = kept(pairs.select(F.col("number").alias("line"), lead["number"].alias("earlier")).distinct(), "lines-pairs")
    settled = _verified(pairs, classes, docs, "lines-led").select("line").distinct()
    # The lines not settled, against the other earlier lines of their tokens.
    later = (followers.join(settled.select(F.col("line").alias("number")), "number", "left_anti")
             .select("token", F.col("number").alias("line"), F.col("n").alias("line_n"), F.col("at").alias("line_at"), lead["number"].alias("led_by")))
    others = shared.select("token", F.col("number").alias("earlier"), "n", "at")
    rest = later.join(others, (later["token"] == others["token"]) & (F.col("earlier") < F.col("line")) & (F.col("earlier") != F.col("led_by"))
                      & _may_match(F.col("line_n"), F.col("line_at"), F.col("n"), F.col("at")))
    rest = kept(rest.select("line", "earlier").distinct().join(pairs, ["line", "earlier"], "left_anti"), "lines-rest")
    removed(spark, shared, pairs)
    gone = settled.union(_verified(rest, classes, docs, "lines-open").select("line")).distinct()
    # From classes back to lines: a later copy goes, and the first if it matched.
    affected = (classes.join(gone.select(F.col("line").alias("number"), F.lit(True).alias("matched")), "number", "left")
                .filter("copies > 1 or matched").select("k1", "k2", "first", F.coalesce("matched", F.lit(False)).alias("matched")))
    affected = kept(affected, "lines-affected")
    removed(spark, classes, rest)
    return (keys.join(affected, ["k1", "k2"])
            .filter(F.col("matched") | (F.struct(*_ID) != F.col("first"))).select(*_ID))


def cleaned(docs: DataFrame) -> DataFrame:
    """``docs`` with ``llm_lines`` (count of all lines), ``llm_gone`` (removed
    line numbers, in order) and ``llm_left`` (the text of the other lines)."""
    with shuffles_freed(docs.sparkSession):
        gone = kept(removed_lines(docs).groupBy(F.col("doc_id").alias("llm_doc"), F.col("text_key").alias("llm_key")).agg(
            F.sort_array(F.collect_set("line_no")).alias("llm_gone")), "lines-gone")
    same = (F.col("doc_id") == F.col("llm_doc")) & (F.xxhash64("text") == F.col("llm_key"))
    out = docs.join(_bounded(gone), same, "left").drop("llm_doc", "llm_key")
    # The text is split once: a lambda's body is evaluated for each element.
    left = F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains("llm_gone", i))
    text = F.array_join(left, "\n")
    return out.select(
        *(c for c in out.columns if c != "llm_gone"),
        F.coalesce(F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1, F.lit(0)).cast("bigint").alias("llm_lines"),
        F.coalesce("llm_gone", F.array().cast("array<int>")).alias("llm_gone"),
        F.when(F.col("llm_gone").isNull(), F.col("text")).otherwise(text).alias("llm_left"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with its own columns, later matching lines cut out of ``text``
    (``n_chars`` follows where there is such a column); a document of which
    only blank lines are left goes."""
    out = cleaned(docs)
    changed = F.size("llm_gone") > 0
    out = out.filter(~changed | (F.trim("llm_left") != ""))
    columns = {"text": F.col("llm_left")}
    if "n_chars" in docs.columns:
        size = F.length("llm_left").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(changed, size).otherwise(F.col("n_chars"))
    return out.select(*(columns[c].alias(c) if c in columns else F.col(c) for c in docs.columns))
