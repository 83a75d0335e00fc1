"""Duplicate removal queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobmart import schemas
from jobmart.operators import dedup, shape
from jobmart.plans.queries.base import ADVERTS_SQL, POSTINGS_SQL, adverts, postings, query, table

_DATE = "strftime(posted_date, '%Y-%m-%d')"


def _key(c: str) -> str:
    return f"lower(trim(regexp_replace({c}, '\\s+', ' ', 'g')))"


@query(
    "dedup_latest",
    f"""WITH {ADVERTS_SQL} SELECT advert_id, company, title, location_raw, {_DATE} AS posted_date FROM adverts
 QUALIFY row_number() OVER (PARTITION BY {_key('company')}, {_key('title')}, {_key('location_raw')}
  ORDER BY posted_date DESC NULLS LAST, advert_id) = 1""",
)
def dedup_latest(spark, folder):
    rows = adverts(spark, folder).select("advert_id", "company", "title", "location_raw", "posted_date")
    kept = dedup.keep_latest(rows, tie_break=["advert_id"])
    return kept.withColumn("posted_date", F.date_format("posted_date", "yyyy-MM-dd"))


@query(
    "dedup_key_hash",
    f"""WITH {ADVERTS_SQL} SELECT advert_id, coalesce(url, sha256(CASE WHEN company IS NULL OR title IS NULL OR location_raw IS NULL THEN CAST(to_json([company, title, location_raw]) AS VARCHAR) ELSE concat_ws('||', company, title, location_raw) END)) AS row_key
 FROM adverts QUALIFY row_number() OVER (PARTITION BY row_key ORDER BY advert_id) = 1""",
)
def dedup_key_hash(spark, folder):
    keyed = dedup.with_row_key(adverts(spark, folder)).select("advert_id", "row_key")
    return dedup.drop_duplicate_keys(keyed, [F.col("advert_id").asc()])


@query(
    "dedup_exact",
    f"""WITH {POSTINGS_SQL} SELECT url, max(advert_id) AS advert_id FROM postings WHERE url IS NOT NULL GROUP BY url
 UNION ALL SELECT DISTINCT url, advert_id FROM postings WHERE url IS NULL""",
)
def dedup_exact(spark, folder):
    rows = postings(spark, folder).select("url", "advert_id")
    return dedup.drop_duplicate_urls(rows, newest="advert_id")


@query(
    "dedup_documents",
    "SELECT min(doc_id) AS doc_id, sha256(text) AS text_hash, count(*) AS n_copies FROM documents GROUP BY text",
)
def dedup_documents(spark, folder):
    """Copies are grouped by digest, so the texts themselves are not shuffled."""
    rows = table(spark, folder, "documents").select("doc_id", F.sha2("text", 256).alias("text_hash"))
    return rows.groupBy("text_hash").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n_copies"))


@query(
    "company_dim_distinct",
    f"""WITH {ADVERTS_SQL}, d AS (SELECT DISTINCT c_name AS company,
  CASE WHEN advert_id % 2 = 0 THEN c_mktsegment END AS company_type,
  CASE WHEN advert_id % 3 = 0 THEN '10-50' WHEN advert_id % 3 = 1 THEN '51-150' END AS company_size,
  CAST(c_nationkey AS VARCHAR) AS country FROM adverts)
 SELECT company, company_type, company_size, country FROM d QUALIFY row_number() OVER (PARTITION BY company
 ORDER BY (CASE WHEN company_type IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN company_size IS NOT NULL THEN 1 ELSE 0 END) DESC,
  company_type ASC NULLS LAST, company_size ASC NULLS LAST, country) = 1""",
)
def company_dim_distinct(spark, folder):
    key = F.col("advert_id")
    details = adverts(spark, folder).select(
        F.struct(
            F.col("c_name").alias("company_name"),
            F.when(key % 2 == 0, F.col("c_mktsegment")).alias("Company type"),
            F.when(key % 3 == 0, "10-50").when(key % 3 == 1, "51-150").alias("Company size"),
            F.col("c_nationkey").cast("string").alias("Country"),
        ).alias("company_detail")
    )
    columns = shape.map_fields(details, "company_detail", schemas.COMPANY_FIELDS).distinct()
    return dedup.one_row_per_key(columns, "company").select("company", "company_type", "company_size", "country")
