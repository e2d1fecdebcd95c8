"""Registered queries of the operators, with DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import (
    binary_output,
    decontaminate,
    fill_middle,
    langid,
    linededup,
    merkle,
    neardup,
    packing,
    prefix_bpe,
    quotes,
    secret_scan,
    toxicity,
    vectors,
)
from salesmart.llm.textkit import crc_mod, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_best_fit_packing(spark, sf_dir):
    packed = packing.pack(read(spark, sf_dir, "documents"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op2_quotation_linking(spark, sf_dir):
    return quotes.conversations(read(spark, sf_dir, "conversations"))


@query
def op3_embedding_near_dedup(spark, sf_dir):
    return vectors.near_duplicates(read(spark, sf_dir, "embeddings"))


@query
def op4_language_id(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    model = langid.fit(docs.filter(~held_out))
    return langid.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op5_minhash_near_dedup(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return neardup.report(docs, neardup.classes(docs))


@query
def op6_secret_scan(spark, sf_dir):
    return secret_scan.digest(secret_scan.scan(read(spark, sf_dir, "documents")))


@query
def op7_token_output(spark, sf_dir):
    return binary_output.binary_rows(read(spark, sf_dir, "documents"))


@query
def op8_toxicity(spark, sf_dir):
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    held_out = crc_mod(F.col("doc_id"), 5) == 0
    model = toxicity.fit(docs, labels.filter(~held_out))
    return toxicity.predict(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op9_line_dedup(spark, sf_dir):
    docs = linededup.cleaned(read(spark, sf_dir, "documents"))
    return docs.select("doc_id", F.col("llm_lines").alias("n_lines"), F.size("llm_gone").cast("bigint").alias("n_removed"),
                       F.array_join("llm_gone", ",").alias("removed_lines"), F.col("llm_left").alias("text"))


@query
def op10_benchmark_decontamination(spark, sf_dir):
    spans = decontaminate.find_spans(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return decontaminate.digest(spans)


@query
def op11_fill_middle(spark, sf_dir):
    made = fill_middle.restored(fill_middle.arranged(read(spark, sf_dir, "documents")))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


@query
def op12_merkle_manifest(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    leaves = merkle.leaves(docs, crc_mod(F.col("doc_id"), 2) == 0, F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    proven = merkle.proven(merkle.manifest(leaves)).withColumn("shown", F.coalesce("changed", "digest"))
    return merkle.folded(proven, "shown").select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", F.sha2(F.array_join("proof", ""), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


@query
def op13_prefix_bpe(spark, sf_dir):
    tokens = prefix_bpe.encoded(read(spark, sf_dir, "documents"))
    tokens = tokens.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                           F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), "ids")
    return prefix_bpe.decoded(tokens).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


# ------------------------------------------------------------------- SQL

_WORDS = ("regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")

ORACLE_SQL["op10_benchmark_decontamination"] = f"""
WITH d AS (SELECT ROW_NUMBER() OVER () AS r, doc_id, {_WORDS.format("COALESCE(text, '')")} AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format("text")} AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
  FROM (SELECT item_id, w, LEAST(10, len(w)) AS n, UNNEST(range(1, len(w) - LEAST(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
places AS (SELECT r, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
  FROM (SELECT r, w, n, UNNEST(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
hits AS (SELECT r, i, n, item_id FROM places JOIN windows USING (n, win)),
covered AS (SELECT r, COUNT(DISTINCT p) AS n_hit FROM (SELECT r, UNNEST(range(i, i + n)) AS p FROM hits) GROUP BY r),
items AS (SELECT r, COUNT(DISTINCT item_id) AS n_items,
                 string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hits GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(COALESCE(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(COALESCE(n_items, 0) AS BIGINT) AS n_items, sha256(COALESCE(ids, '')) AS items_sha256,
       COALESCE(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)"""

ORACLE_SQL["op3_embedding_near_dedup"] = """
WITH RECURSIVE v AS (SELECT DISTINCT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
good AS (SELECT vec_id, label, x, sqrt(list_dot_product(x, x)) AS size FROM v
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(x) > 0
    AND len(list_filter(x, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0 AND list_dot_product(x, x) > 0),
links AS (SELECT DISTINCT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_dot_product(a.x, b.x) / (a.size * b.size) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, MIN(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a, COUNT(*) AS n FROM links GROUP BY a)
SELECT vec_id, COALESCE(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN least ON vec_id = least.a LEFT JOIN degree ON vec_id = degree.a"""

ORACLE_SQL["op9_line_dedup"] = f"""
WITH docs AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, i - 1 AS line_no, {_WORDS.format("ls[i]")} AS w
  FROM (SELECT doc_id, ls, UNNEST(range(1, len(ls) + 1)) AS i FROM docs WHERE text IS NOT NULL AND doc_id IS NOT NULL)),
numbered AS (SELECT doc_id, line_no, w, ROW_NUMBER() OVER (ORDER BY doc_id, line_no) AS place FROM lines WHERE len(w) > 0),
classes AS (SELECT w, MIN(place) AS first FROM numbered GROUP BY w),
tokens AS (SELECT DISTINCT first, array_to_string(list_slice(w, i, i + 4), ' ') AS token
  FROM (SELECT first, w, UNNEST(range(1, GREATEST(len(w) - 3, 2))) AS i FROM classes)),
sizes AS (SELECT first, COUNT(*) AS n FROM tokens GROUP BY first),
common AS (SELECT a.first AS later, b.first AS earlier, COUNT(*) AS n
  FROM tokens a JOIN tokens b ON a.token = b.token AND a.first > b.first GROUP BY ALL),
matched AS (SELECT DISTINCT later FROM common JOIN sizes a ON a.first = later JOIN sizes b ON b.first = earlier
  WHERE common.n * 5 >= (a.n + b.n - common.n) * 4),
gone AS (SELECT doc_id, list_sort(list(line_no)) AS nos
  FROM numbered JOIN classes USING (w) WHERE place <> first OR first IN (SELECT later FROM matched) GROUP BY doc_id)
SELECT doc_id, CAST(COALESCE(len(ls), 0) AS BIGINT) AS n_lines, CAST(COALESCE(len(nos), 0) AS BIGINT) AS n_removed,
       COALESCE(array_to_string(nos, ','), '') AS removed_lines,
       CASE WHEN nos IS NULL THEN text ELSE array_to_string(
         list_transform(list_filter(range(0, len(ls)), lambda i: NOT list_contains(nos, i)), lambda i: ls[i + 1]), chr(10)) END AS text
FROM docs LEFT JOIN gone USING (doc_id)"""

ORACLE_SQL["op2_quotation_linking"] = r"""
WITH RECURSIVE m AS (SELECT ROW_NUMBER() OVER () AS r, conv_id, turn, role, text FROM conversations),
cut AS (SELECT r, UNNEST(range(1, len(ls) + 1)) AS i, ls
  FROM (SELECT r, string_split(text, chr(10)) AS ls FROM m WHERE text IS NOT NULL)),
lines AS (SELECT r, i, length(regexp_replace(regexp_extract(ls[i], '^((?:[ \t]*>)+)', 1), '[^>]', '', 'g')) AS level,
    regexp_replace(ls[i], '^(?:[ \t]*>)+[ \t]?', '') AS body, ls[i] AS line FROM cut),
marked AS (SELECT *, LEAD(level) OVER w AS after, LAG(level, 1, -1) OVER w AS before FROM lines WINDOW w AS (PARTITION BY r ORDER BY i)),
own AS (SELECT r, regexp_replace(regexp_replace(string_agg(line, chr(10) ORDER BY i), '^\s+|\s+$', '', 'g'), '\n{3,}', chr(10) || chr(10), 'g') AS own
  FROM marked WHERE level = 0 AND NOT (regexp_matches(line, 'wrote:[ \t]*$') AND COALESCE(after, 0) > 0) GROUP BY r),
quoting AS (SELECT DISTINCT r FROM lines WHERE level > 0),
said AS (SELECT m.*, CASE WHEN text IS NULL THEN NULL WHEN quoting.r IS NULL THEN text ELSE COALESCE(own, '') END AS own,
    quoting.r IS NOT NULL AS quotes FROM m LEFT JOIN quoting USING (r) LEFT JOIN own USING (r)),
runs AS (SELECT *, SUM(CASE WHEN level <> before THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS run FROM marked),
bodies AS (SELECT r, run, MIN(level) AS level, string_agg(body, chr(10) ORDER BY i) AS body FROM runs WHERE level > 0 GROUP BY r, run),
passages AS (SELECT r, run, level, trim(regexp_replace(lower(body), '\s+', ' ', 'g')) AS whole,
    list_distinct(list_filter(list_transform(list_concat(string_split(body, chr(10)), string_split_regex(body, '\n\s*\n')),
      lambda x: trim(regexp_replace(lower(x), '\s+', ' ', 'g'))), lambda x: x <> '')) AS parts FROM bodies),
placed AS (SELECT * FROM said WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
sources AS (SELECT 'whole' AS kind, trim(regexp_replace(lower(own), '\s+', ' ', 'g')) AS key, conv_id, turn FROM placed WHERE own IS NOT NULL
  UNION ALL SELECT 'part', trim(regexp_replace(lower(part), '\s+', ' ', 'g')), conv_id, turn
  FROM (SELECT conv_id, turn, UNNEST(list_concat(string_split(own, chr(10)), string_split_regex(own, '\n\s*\n'))) AS part FROM placed WHERE own IS NOT NULL)),
inside AS (SELECT kind, key, conv_id, MIN(turn) AS turn FROM sources WHERE key <> '' GROUP BY ALL),
anywhere AS (SELECT kind, key, MIN({'conv': conv_id, 'turn': turn}) AS source FROM sources WHERE key <> '' GROUP BY kind, key),
asked AS (SELECT q.r, run, level, kind, key, chars, conv_id, turn FROM
  (SELECT r, run, level, 'whole' AS kind, whole AS key, 0 AS chars FROM passages
   UNION ALL SELECT r, run, level, 'part', part, length(part) FROM (SELECT r, run, level, UNNEST(parts) AS part FROM passages)) q
  JOIN placed ON placed.r = q.r),
linked AS (SELECT a.r, a.run, a.level, a.chars, CASE
    WHEN i.turn < a.turn THEN {'rank': CASE a.kind WHEN 'whole' THEN 0 ELSE 1 END, 'conv': a.conv_id, 'turn': i.turn}
    WHEN s.source < {'conv': a.conv_id, 'turn': a.turn}
      THEN {'rank': CASE a.kind WHEN 'whole' THEN 2 ELSE 3 END, 'conv': s.source.conv, 'turn': s.source.turn} END AS link
  FROM asked a LEFT JOIN inside i ON i.kind = a.kind AND i.key = a.key AND i.conv_id = a.conv_id
               LEFT JOIN anywhere s ON s.kind = a.kind AND s.key = a.key),
votes AS (SELECT r, run, level, link, SUM(chars) AS chars, COUNT(*) AS n FROM linked GROUP BY r, run, level, link),
best AS (SELECT r, run, level, MIN(CASE WHEN link IS NOT NULL
    THEN {'rank': link.rank, 'chars': -chars, 'n': -n, 'conv': link.conv, 'turn': link.turn} END) AS link FROM votes GROUP BY r, run, level),
answers AS (SELECT r, COUNT(*) AS n_passages, COUNT(link) AS n_linked,
    MIN(CASE WHEN link IS NOT NULL THEN {'level': level, 'later': -link.turn, 'conv': link.conv} END) AS source FROM best GROUP BY r),
up AS (SELECT conv_id, turn, MIN({'conv': source.conv, 'turn': -source.later}) AS parent
  FROM answers JOIN placed USING (r) WHERE source IS NOT NULL GROUP BY conv_id, turn),
climb AS (SELECT conv_id, turn, parent AS root FROM up
  UNION ALL SELECT climb.conv_id, climb.turn, up.parent FROM climb JOIN up ON up.conv_id = climb.root.conv AND up.turn = climb.root.turn),
roots AS (SELECT climb.conv_id, climb.turn, root FROM climb LEFT JOIN up ON up.conv_id = root.conv AND up.turn = root.turn WHERE up.conv_id IS NULL)
SELECT said.conv_id, said.turn, role, own AS text, COALESCE(n_passages, 0) AS n_passages, COALESCE(n_linked, 0) AS n_linked,
       source.conv AS parent_conv, -source.later AS parent_turn, COALESCE(root.conv, said.conv_id) AS thread_conv,
       COALESCE(root.turn, said.turn) AS thread_turn,
       '<|' || COALESCE(role, 'unknown') || '|>' || chr(10) || COALESCE(own, '') || chr(10) AS chat
FROM said LEFT JOIN answers USING (r) LEFT JOIN roots ON roots.conv_id = said.conv_id AND roots.turn = said.turn"""

ORACLE_SQL["op11_fill_middle"] = """
WITH d AS (SELECT ROW_NUMBER() OVER () AS r, doc_id, COALESCE(text, '') AS t, length(COALESCE(text, '')) AS n,
    sha256('1:' || COALESCE(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS p, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS q,
    CAST('0x' || h[17:24] AS BIGINT) % 100 AS h3, CAST('0x' || h[25:32] AS BIGINT) % 100 AS h4 FROM d),
formed AS (SELECT *, LEAST(p, q) AS a, GREATEST(p, q) AS b, CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>')
    OR contains(t, '<M>') OR h3 >= 90 THEN 'plain' WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
made AS (SELECT *, CASE form WHEN 'plain' THEN t
    WHEN 'psm' THEN '<P>' || substr(t, 1, a) || '<S>' || substr(t, b + 1) || '<M>' || substr(t, a + 1, b - a)
    ELSE '<S>' || substr(t, b + 1) || '<P>' || substr(t, 1, a) || '<M>' || substr(t, a + 1, b - a) END AS output FROM formed),
found AS (SELECT *, strpos(output, '<P>') AS at_p, strpos(output, '<S>') AS at_s, strpos(output, '<M>') AS at_m FROM made),
back AS (SELECT *, CASE form WHEN 'plain' THEN output
    WHEN 'psm' THEN substr(output, 4, at_s - 4) || substr(output, at_m + 3) || substr(output, at_s + 3, at_m - at_s - 3)
    ELSE substr(output, at_p + 3, at_m - at_p - 3) || substr(output, at_m + 3) || substr(output, 4, at_p - 4) END AS restored FROM found)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(output) AS output_sha256, sha256(restored) AS restored_sha256 FROM back"""


def _framed_sql(column: str) -> str:
    return f"COALESCE(strlen(CAST({column} AS VARCHAR)) || ':' || {column}, '-')"


_LEAF_SQL = "sha256(" + " || ".join(_framed_sql(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || {0})"
_UP_SQL = "list_transform(range(0, (len({0}) + 2) // 3), lambda i: sha256(array_to_string({0}[i * 3 + 1:i * 3 + 3], '')))"

# Each tree is a list of digests per level; a leaf's place in a level is place // 3^level.
# crc32 is not in DuckDB: it is a fold over bits, as the polynomial defines it.
ORACLE_SQL["op12_merkle_manifest"] = f"""
WITH RECURSIVE crc_table AS (SELECT list(v ORDER BY b) AS t FROM (SELECT b, list_reduce(list_concat([b], range(0, 8)), lambda x, k:
    CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS v FROM (SELECT UNNEST(range(0, 256)) AS b))),
d AS (SELECT ROW_NUMBER() OVER () AS r, *, CASE WHEN doc_id IS NOT NULL THEN xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
      list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda x, c: xor(x >> 8, t[1 + (xor(x, c) & 255)])), 4294967295) % 2 = 0 ELSE FALSE END AS tampered FROM documents, crc_table),
leaves AS (SELECT r, doc_id, source, {_LEAF_SQL.format(_framed_sql("text"))} AS leaf,
    CASE WHEN tampered THEN {_LEAF_SQL.format(_framed_sql("replace(text, chr(10), '')"))} END AS changed FROM d),
placed AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS place FROM leaves),
trees AS (SELECT source, 0 AS level, list(leaf ORDER BY place) AS nodes FROM placed GROUP BY source
  UNION ALL SELECT source, level + 1, {_UP_SQL.format("nodes")} FROM trees WHERE len(nodes) > 1),
subroots AS (SELECT source, nodes[1] AS subroot, ROW_NUMBER() OVER (ORDER BY source IS NOT NULL, encode(source)) - 1 AS rank FROM trees WHERE len(nodes) = 1),
over_all AS (SELECT 0 AS level, list(subroot ORDER BY rank) AS nodes FROM subroots
  UNION ALL SELECT level + 1, {_UP_SQL.format("nodes")} FROM over_all WHERE len(nodes) > 1),
steps AS (SELECT r, 0 AS part, level, nodes, place // CAST(pow(3, level) AS BIGINT) AS spot FROM placed JOIN trees ON trees.source IS NOT DISTINCT FROM placed.source
    WHERE len(nodes) > 1
  UNION ALL SELECT r, 1, level, nodes, rank // CAST(pow(3, level) AS BIGINT) AS spot FROM placed JOIN subroots ON subroots.source IS NOT DISTINCT FROM placed.source, over_all
    WHERE len(nodes) > 1),
runs AS (SELECT r, ROW_NUMBER() OVER (PARTITION BY r ORDER BY part, level) AS step, nodes[spot - spot % 3 + 1:spot] AS before, nodes[spot + 2:spot - spot % 3 + 3] AS after FROM steps),
proofs AS (SELECT r, sha256(string_agg(array_to_string(list_concat(before, after), ''), '' ORDER BY step)) AS proof_sha256 FROM runs GROUP BY r),
climbs AS (SELECT r, 0 AS step, COALESCE(changed, leaf) AS digest FROM placed
  UNION ALL SELECT climbs.r, runs.step, sha256(array_to_string(list_concat(before, [digest], after), ''))
  FROM climbs JOIN runs ON runs.r = climbs.r AND runs.step = climbs.step + 1),
ends AS (SELECT r, arg_max(digest, step) AS folded_root FROM climbs GROUP BY r)
SELECT doc_id, leaf, subroot, root, COALESCE(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed JOIN ends USING (r) LEFT JOIN proofs USING (r) JOIN subroots ON subroots.source IS NOT DISTINCT FROM placed.source,
     (SELECT nodes[1] AS root FROM over_all WHERE len(nodes) = 1)"""
