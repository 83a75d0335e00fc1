"""The registered queries: one for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart.llm import (
    chat, decontaminate, exact_dedup, language_model, mixing, nearest, ngram_join, periodic, pii, sharding, substring_dedup, toxicity, variants,
)
from jobmart.llm.common import remainder
from jobmart.llm.registry import ORACLES, QUERIES, query, table

__all__ = ["ORACLES", "QUERIES"]

SHARDS = 16


def qualities(spark: SparkSession, folder: str) -> DataFrame:
    """One quality weight per labelled document: 2 for good, 0.5 for bad."""
    return table(spark, folder, "labels").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 2.0).when(F.col("quality") == 0, 0.5)).alias("quality"))


# The table is filled step by step as the operator's description says: `pref` has every shard's order.
_SHARDS_SQL = f"""
WITH RECURSIVE p AS (SELECT {sharding.prime_from(sharding.SLOTS_PER_SHARD * SHARDS)} AS m, {SHARDS} AS n),
s AS (SELECT i, 'shard-' || lpad(i::VARCHAR, 5, '0') AS name FROM range({SHARDS}) t(i)),
o AS (SELECT list(('0x' || substr(md5('start ' || name), 1, 13))::BIGINT % m ORDER BY i) AS start,
        list(('0x' || substr(md5('step ' || name), 1, 13))::BIGINT % (m - 1) + 1 ORDER BY i) AS step FROM s, p),
fill AS (
  SELECT 0 AS turn, list_transform(range(m), lambda x: -1) AS owner, NULL::BIGINT AS slot FROM p
  UNION ALL
  SELECT turn + 1, list_transform(owner, lambda x, k: CASE WHEN k - 1 = c THEN turn % n ELSE x END), c
  FROM (SELECT turn, owner, n,
          list_filter(list_transform(range(m), lambda k: (start[turn % n + 1] + k * step[turn % n + 1]) % m), lambda c: owner[c + 1] < 0)[1] AS c
        FROM fill, p, o WHERE turn < m)
),
lookup AS (SELECT slot, (turn - 1) % n AS shard FROM fill, p WHERE turn > 0),
placed AS (SELECT doc_id, ('0x' || substr(md5(doc_id::VARCHAR), 1, 13))::BIGINT % m AS slot FROM documents, p)
SELECT doc_id, slot, shard::INTEGER AS shard, 'shard-' || lpad(shard::VARCHAR, 5, '0') AS shard_name
FROM placed JOIN lookup USING (slot)
"""


@query("op3_sharding", _SHARDS_SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return sharding.assign_shards(docs, sharding.shard_names(SHARDS)).drop("text")


@query("op4_chat_formatting", """
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
c AS (SELECT conv_id, count(*) AS n_turns,
    string_agg('<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10), ''
               ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS text,
    list({'r': role, 't': text} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS turns
  FROM t GROUP BY conv_id),
d AS (SELECT min(conv_id) AS conv_id, n_turns, text, turns, count(*) AS n_equal FROM c GROUP BY n_turns, text, turns),
x AS (SELECT DISTINCT turns[1:k] AS turns FROM (SELECT turns, unnest(range(1, n_turns)) AS k FROM d))
SELECT conv_id, n_turns::INTEGER AS n_turns, n_equal, text FROM d ANTI JOIN x USING (turns)
""")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return chat.format_chats(table(spark, folder, "conversations"))


@query("op8_exact_dedup", """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
""")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


# Documents of a source in key order, each taken if it still fits: `state` has what is left and the ids taken.
_MIX_SQL = f"""
WITH q AS (SELECT doc_id, max(CASE quality WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 END)::DOUBLE AS w FROM labels GROUP BY doc_id),
k AS (SELECT d.doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
    -ln((('0x' || substr(md5('mix' || d.doc_id::VARCHAR), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE) / coalesce(w, 1) AS key
  FROM documents d LEFT JOIN q ON d.doc_id = q.doc_id),
s AS (SELECT source, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight FROM k GROUP BY source),
r AS (SELECT *, {mixing.MOST} * source_size / weight AS ratio FROM s),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum({mixing.MOST} * source_size) OVER b, 0))
      / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
  FROM r WINDOW b AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
m AS (SELECT arg_min(level, ratio) AS level FROM l WHERE level <= ratio),
t0 AS (SELECT source, source_size, least(({mixing.MOST} * source_size)::DOUBLE, m.level * weight) AS target FROM l, m),
t AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs, target - epochs * source_size AS gap FROM t0),
o AS (SELECT source, list({{'left': size::DOUBLE, 'ids': [doc_id]}} ORDER BY key, doc_id) AS docs FROM k WHERE size > 0 GROUP BY source),
f AS (SELECT unnest(list_reduce(list_prepend({{'left': gap, 'ids': []::BIGINT[]}}, docs),
    lambda state, d: CASE WHEN d.left <= state.left THEN {{'left': state.left - d.left, 'ids': list_concat(state.ids, d.ids)}} ELSE state END).ids) AS doc_id
  FROM o JOIN t ON o.source IS NOT DISTINCT FROM t.source)
SELECT k.doc_id, size, source_size, target, epochs, f.doc_id IS NOT NULL AS picked,
  size * (epochs + CASE WHEN f.doc_id IS NULL THEN 0 ELSE 1 END) AS taken
FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source LEFT JOIN f ON f.doc_id = k.doc_id
"""


@query("op9_mixing", _MIX_SQL)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"), qualities(spark, folder), whole_rows=False)


@query("op6_decontaminate", """
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
t AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS x
  FROM (SELECT item_id, w, least(13, len(w)) AS k, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
o AS (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS x
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM t))),
h AS (SELECT doc_id, i, k, item_id FROM o JOIN t USING (k, x)),
p AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM (SELECT DISTINCT doc_id, i, k FROM h)) GROUP BY doc_id),
g AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN g USING (doc_id)
""")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    marked = decontaminate.mark_items(docs, table(spark, folder, "benchmark"))
    return marked.select(
        "doc_id", F.col("_n").alias("n_words"), decontaminate.n_hit().alias("n_hit"), F.size("_items").cast("long").alias("n_items"),
        decontaminate.digest().alias("items_sha256"), decontaminate.contaminated().alias("contaminated"))


@query("op5_substring_dedup", """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
o AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + 34], ' ')) AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
h AS (SELECT doc_id, i FROM o WHERE x IN (SELECT x FROM o GROUP BY x HAVING count(*) > 1)),
p AS (SELECT doc_id, list(DISTINCT j) AS gone FROM (SELECT doc_id, unnest(range(i, i + 35)) AS j FROM h) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
  sha256(CASE WHEN gone IS NULL THEN array_to_string(w, ' ')
    ELSE coalesce(array_to_string(list_filter(w, lambda x, j: NOT list_contains(gone, j)), ' '), '') END) AS kept_sha256
FROM d LEFT JOIN p USING (doc_id)
""")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op2_ngram_join", """
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b USING (x) WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
reach AS (SELECT a AS doc_id, b AS other FROM e UNION SELECT r.doc_id, e.b FROM reach r JOIN e ON r.other = e.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, least(d.doc_id, coalesce(min(other), d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN reach USING (doc_id) GROUP BY d.doc_id
""")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, folder, "documents"), shingle=3, percent=90)


def toxicity_model(spark: SparkSession, folder: str) -> toxicity.Model:
    """Learned from the labels of all documents but those held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").filter(remainder(F.col("doc_id"), 5) != 0)
    return toxicity.train(docs, labels)


@query("op1_toxicity")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxicity.score(table(spark, folder, "documents"), toxicity_model(spark, folder))
    return scored.select(
        "doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "strongest", "total")


@query("op7_language_model")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = (remainder(F.col("doc_id"), 7) == 2).alias("held_out")
    scored = language_model.score(docs, language_model.train(docs.filter(~held_out)))
    return scored.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


@query("op10_pii")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_pii(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(F.array_join("base", ","), 256).alias("base_sha256"),
        F.array_join("spans", ",").alias("spans"), F.size("spans").cast("long").alias("n_spans"))


# Exact search; the index finds the same wherever its first round holds all vectors.
@query("op11_nearest_neighbours", """
WITH e AS (SELECT DISTINCT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM s) WHERE rank <= 20
""")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


# CRC-32 byte by byte; letters beyond ASCII are two bytes, C3 and the code point less 64.
@query("op12_spelling_variants", """
WITH RECURSIVE c AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS t),
r AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents) GROUP BY ALL),
h AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
    flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda ch: CASE WHEN unicode(ch) < 128 THEN [unicode(ch)] ELSE [195, unicode(ch) - 64] END)),
    lambda x: x::BIGINT)), lambda s, b: xor(s >> 8, t[(xor(s, b) & 255) + 1]))) AS h FROM r, c),
w AS (SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % len(run))::BIGINT) || substr(run, (h % len(run))::BIGINT + 2) ELSE run END AS word, n FROM h)
  WHERE len(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
k AS (SELECT word, n, i, left(word, i) AS a, substr(word, i + 2) AS b FROM (SELECT word, n, unnest(range(len(word))) AS i FROM w)),
p AS (SELECT x.word, y.word AS near, y.n FROM k x JOIN k y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT k.word, w.word, w.n FROM k JOIN w ON w.word = k.a || k.b
  UNION SELECT w.word, k.word, k.n FROM k JOIN w ON w.word = k.a || k.b),
f AS (SELECT word, count(*) AS n_near, max(n) AS top FROM p GROUP BY word),
g AS (SELECT f.word, n_near, min(near) AS form, any_value(top) AS form_n FROM f JOIN p ON p.word = f.word AND p.n = f.top GROUP BY f.word, n_near),
o AS (SELECT w.word, CASE WHEN form_n >= 2 * w.n THEN form END AS form, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * w.n THEN form_n END AS form_n
  FROM w LEFT JOIN g USING (word)),
u AS (SELECT word, word AS root FROM o UNION ALL SELECT u.word, o.form FROM u JOIN o ON o.word = u.root WHERE o.form IS NOT NULL)
SELECT o.word, o.form, u.root, o.n, o.n_near, o.form_n FROM o JOIN u USING (word) JOIN o e ON e.word = u.root WHERE e.form IS NULL
""")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return variants.forms(variants.vocabulary(table(spark, folder, "documents"), drop=97))


@query("op13_periodic_runs")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.periodic_runs(periodic.with_planted_runs(table(spark, folder, "documents")))
    best = periodic.strongest(F.col("runs"))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        periodic.digest_of_runs(F.col("runs")).alias("runs_sha256"), F.sha2("kept", 256).alias("collapsed_sha256"))
