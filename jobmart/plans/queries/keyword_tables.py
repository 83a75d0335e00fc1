"""Keyword lists and labels that come from tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobmart.operators import keywords
from jobmart.plans.queries.base import query, table


def goods_texts(spark, folder) -> DataFrame:
    """Document texts that name a part between two other words."""
    part = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    joined = docs.join(part, F.col("doc_id") % 97 == F.col("p_partkey"), "left")
    named = F.concat(F.col("p_name"), F.lit(" x"), F.col("p_brand"), F.lit("; "), F.upper("p_brand"), F.lit("0,"), F.initcap("p_name"), F.lit(" "), F.lower("p_brand"))
    return joined.select("doc_id", F.concat_ws(" ", "text", named).alias("text"))


GOODS_SQL = """goods AS (SELECT doc_id, concat_ws(' ', text, p_name || ' x' || p_brand || '; ' || upper(p_brand) || '0,' ||
  array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ') || ' ' || lower(p_brand)) AS text
 FROM documents LEFT JOIN part ON doc_id % 97 = p_partkey)"""


def goods_rules(spark, folder) -> DataFrame:
    """Part names, brands and types as keywords; the part that has them first gives place and label."""
    part = table(spark, folder, "part")
    kinds = [part.select(F.lit(c).alias("kind"), F.col(c).alias("keyword"), "p_partkey") for c in ("p_name", "p_brand", "p_type")]
    rows = kinds[0].unionByName(kinds[1]).unionByName(kinds[2]).groupBy("kind", "keyword").agg(F.min("p_partkey").alias("place"))
    return rows.select("place", F.concat_ws(":", "kind", "keyword").alias("label"), "keyword")


RULES_SQL = """rules AS (SELECT min(p_partkey) AS place, kind || ':' || keyword AS label, lower(keyword) AS keyword FROM (
  SELECT 'p_name' AS kind, p_name AS keyword, p_partkey FROM part UNION ALL SELECT 'p_brand', p_brand, p_partkey FROM part
  UNION ALL SELECT 'p_type', p_type, p_partkey FROM part) GROUP BY kind, keyword)"""


# Each piece between two occurrences tells what stands after the one and before the other.
@query("keywords_from_table", rf"""WITH {GOODS_SQL}, {RULES_SQL},
 hits AS (SELECT doc_id, keyword, string_split(lower(text), keyword) AS pieces FROM goods JOIN (SELECT DISTINCT keyword FROM rules) ON contains(lower(text), keyword)),
 sides AS (SELECT doc_id, keyword, pieces, unnest(range(1, len(pieces))) AS i FROM hits),
 spots AS (SELECT doc_id, keyword, list_sum(list_transform(pieces[1:i], lambda x: length(x))) + (i - 1) * length(keyword) AS spot,
   CASE WHEN i = 1 OR pieces[i] <> '' THEN right(pieces[i], 1) ELSE right(keyword, 1) END AS ahead,
   CASE WHEN i + 1 = len(pieces) OR pieces[i + 1] <> '' THEN left(pieces[i + 1], 1) ELSE left(keyword, 1) END AS behind FROM sides)
 SELECT doc_id, keyword, count(*) AS n, min(spot)::BIGINT AS first FROM spots
 WHERE NOT regexp_matches(ahead || ' ' || behind, '[\p{{L}}\p{{M}}\p{{N}}_]') GROUP BY doc_id, keyword""")
def keywords_from_table(spark, folder):
    """Which of the parts' names, brands and types stand in which text as whole words, how often, and where first."""
    return keywords.find_keywords(goods_texts(spark, folder), goods_rules(spark, folder), "doc_id", "text")


@query("rules_from_table", f"""WITH {GOODS_SQL}, {RULES_SQL},
 hits AS (SELECT doc_id, arg_min(label, (place, label)) AS label FROM goods JOIN rules ON contains(lower(text), keyword) GROUP BY doc_id)
 SELECT doc_id, coalesce(label, 'none') AS label FROM goods LEFT JOIN hits USING (doc_id)""")
def rules_from_table(spark, folder):
    """The label of the first rule whose keyword a text contains."""
    return keywords.label_by_table(goods_texts(spark, folder), goods_rules(spark, folder), "doc_id", "text", "none")
