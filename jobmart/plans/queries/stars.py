"""Canonical adverts from raw board records, and the star schema built on them."""

from __future__ import annotations

import unicodedata

from pyspark.sql import functions as F

from jobmart import rules
from jobmart.functions.text import text_key
from jobmart.plans import adverts as plans
from jobmart.plans import warehouse
from jobmart.plans.queries.base import (
    ADVERTS_SQL, PHRASES, PLACES, TITLES, adverts, pick, query, sql_labels, sql_pick, table,
)
from jobmart.scratch import materialise

_FIXED = [(label, [word]) for word, label in rules.with_trap_rules_first(rules.PROVINCES)]


def raw_board_a(spark, folder):
    """Board A records from adverts."""
    a = adverts(spark, folder)
    key = F.col("advert_id")
    pay = F.concat((key % 40 + 1).cast("string"), F.lit(" - "), (key % 40 + 9).cast("string"), F.lit(" tr"))
    return a.select(
        "url",
        F.when(key % 4 == 0, "N/A").otherwise(F.col("c_name")).alias("ten_cong_ty"),
        F.col("title").alias("tieu_de"),
        F.col("posted_raw").alias("ngay_dang_tuyen"),
        F.when(key % 3 == 1, pay).otherwise("N/A").alias("luong"),
        F.lit("N/A").alias("cap_bac"),
        F.array(F.lit(" A "), F.lit("")).alias("phuc_loi"),
        F.concat(F.lit("Tại "), F.translate("c_name", "#", " "), F.lit(", Hà Nội")).alias("mo_ta_cong_viec"),
        pick(PHRASES, key).alias("yeu_cau_cong_viec"),
        F.struct(F.col("location_raw").alias("thanh_pho"), F.lit(None).cast("string").alias("dia_chi_day_du")).alias("dia_diem_lam_viec"),
        F.map_filter(F.create_map(F.lit("lương"), F.when(key % 3 == 0, pay)), lambda k, v: v.isNotNull()).alias("thong_tin_khac"),
    )


# One date form carries only the last digit of the year, see ``posted_text``.
_POSTED = (
    "CASE advert_id % 5 WHEN 4 THEN NULL WHEN 2 THEN CAST(try_strptime('202' || right(strftime(posted_date, '%y'), 1) || "
    "strftime(posted_date, '-%m-%d'), '%Y-%m-%d') AS DATE) ELSE posted_date END"
)
_CANONICAL_SQL = f"""{ADVERTS_SQL}, canonical AS (SELECT url, title,
 CASE WHEN advert_id % 4 = 0 THEN replace(c_name, '#', ' ') ELSE c_name END AS company,
 CASE WHEN location_raw IN ('Hồ Chí Minh', 'TP.HCM', 'HCM') THEN 'Thành Phố Hồ Chí Minh' ELSE location_raw END AS location_raw,
 CASE WHEN advert_id % 3 < 2 THEN (advert_id % 40 + 1) * 1000000 END AS salary_min,
 CASE WHEN advert_id % 3 < 2 THEN (advert_id % 40 + 9) * 1000000 END AS salary_max,
 {sql_labels("lower(coalesce(title, ''))", rules.LEVELS, "'Mid-level'")} AS level, {_POSTED} AS posted_date,
 posted_raw, {sql_pick(PHRASES, 'advert_id')} AS requirements, advert_id FROM adverts)"""


@query(
    "normalise_adverts",
    f"""WITH {_CANONICAL_SQL} SELECT url, title, company, location_raw, salary_min, salary_max, level,
 {sql_labels("lower(coalesce(location_raw, ''))", _FIXED, "'Khác'")} AS city,
 strftime(posted_date, '%Y-%m-%d') AS posted_date, 'Giờ hành chính' AS working_hours, 'A' AS benefits FROM canonical""",
)
def normalise_adverts(spark, folder):
    rows = plans.normalise(raw_board_a(spark, folder), "a")
    return rows.select(
        "url", "title", "company", "location_raw", "salary_min", "salary_max", "level", "city",
        F.date_format("posted_date", "yyyy-MM-dd").alias("posted_date"), "working_hours",
        F.array_join("benefits", "|").alias("benefits"),
    )


@query(
    "clean_adverts",
    f"""WITH {_CANONICAL_SQL} SELECT lower(trim(regexp_replace(company, '\\s+', ' ', 'g'))) AS company_key,
  lower(trim(regexp_replace(title, '\\s+', ' ', 'g'))) AS title_key, lower(trim(regexp_replace(location_raw, '\\s+', ' ', 'g'))) AS place_key,
  strftime(max(posted_date), '%Y-%m-%d') AS posted_date, {sql_labels("lower(any_value(location_raw))", _FIXED, "'Khác'")} AS city,
  {sql_labels("lower(any_value(title))", rules.LEVELS, "'Mid-level'")} AS level, 'Giờ hành chính' AS working_hours, 'A' AS benefits, 'board_a' AS source
 FROM canonical WHERE location_raw IS NOT NULL AND title IS NOT NULL AND posted_raw <> 'N/A' GROUP BY 1, 2, 3""",
)
def clean_adverts(spark, folder):
    rows = plans.clean(plans.normalise(raw_board_a(spark, folder), "a"))
    return rows.select(
        text_key(F.col("company")).alias("company_key"), text_key(F.col("title")).alias("title_key"),
        text_key(F.col("location_raw")).alias("place_key"),
        F.date_format("posted_date", "yyyy-MM-dd").alias("posted_date"), "city", "level", "working_hours",
        F.array_join("benefits", "|").alias("benefits"), "source",
    )


@query(
    "normalise_nfc",
    f"""WITH {_CANONICAL_SQL} SELECT url, title, level, {sql_labels("lower(coalesce(location_raw, ''))", _FIXED, "'Khác'")} AS city, location_raw FROM canonical""",
)
def normalise_nfc(spark, folder):
    """Titles and places that arrive decomposed: all rules see them composed."""
    decomposed = lambda texts: [unicodedata.normalize("NFD", t) for t in texts]
    place = F.col("dia_diem_lam_viec.thanh_pho")
    rows = raw_board_a(spark, folder)
    in_parts = lambda c, texts: F.element_at(
        F.create_map(*[F.lit(x) for t, d in zip(texts, decomposed(texts)) for x in (t, d)]), c)
    rows = rows.withColumn("tieu_de", in_parts(F.col("tieu_de"), TITLES)).withColumn(
        "dia_diem_lam_viec", F.col("dia_diem_lam_viec").withField("thanh_pho", in_parts(place, PLACES)))
    return plans.normalise(rows, "a").select("url", "title", "level", "city", "location_raw")


def _canonical(spark, folder):
    """Adverts as the warehouse takes them; skills are the words of the requirements."""
    rows = plans.normalise(raw_board_a(spark, folder), "a")
    return rows.withColumn("skills", F.array_sort(F.split("requirements", " ")))


_SKILLS = "array_to_string(list_sort(string_split(requirements, ' ')), ', ')"
_CITY = sql_labels("lower(coalesce(location_raw, ''))", _FIXED, "'Khác'")


@query(
    "star_fact",
    f"""WITH {_CANONICAL_SQL} SELECT title AS job_title, {_SKILLS} AS required_skills, company AS company_name, {_CITY} AS city,
 CAST(strftime(posted_date, '%Y%m%d') AS INTEGER) AS date_id, salary_min / 1000000.0 AS min_salary, salary_max / 1000000.0 AS max_salary
 FROM canonical WHERE title IS NOT NULL""",
)
def star_fact(spark, folder):
    """Facts with every key resolved against its dimension."""
    # Written once, with the columns that the star needs: the fact and its dimensions read these, not the raw records.
    rows = materialise(_canonical(spark, folder).select(
        "url", "title", "company", "source", "city", "level", "skills", "posted_date", "salary_min", "salary_max"))
    fact = warehouse.fact_job_postings(rows)
    job = warehouse.dim_job(rows).select("job_id", "job_title", "required_skills")
    firm = warehouse.dim_company(rows, "company", "source", "source").select("company_id", "company_name")
    place = warehouse.dim_location(rows).select("location_id", "city")
    return fact.join(job, "job_id").join(firm, "company_id").join(place, "location_id").select(
        "job_title", "required_skills", "company_name", "city", "date_id", "min_salary", "max_salary"
    )


@query(
    "dim_job",
    f"""WITH {_CANONICAL_SQL} SELECT DISTINCT title AS job_title, level AS job_category, {_SKILLS} AS required_skills
 FROM canonical WHERE title IS NOT NULL""",
)
def dim_job(spark, folder):
    return warehouse.dim_job(_canonical(spark, folder)).drop("job_id")


@query(
    "dim_company",
    "SELECT DISTINCT c_name AS company_name, c_mktsegment AS company_size, CAST(c_nationkey AS VARCHAR) AS industry FROM customer",
)
def dim_company(spark, folder):
    firms = table(spark, folder, "customer").withColumn("c_nationkey", F.col("c_nationkey").cast("string"))
    return warehouse.dim_company(firms, "c_name", "c_mktsegment", "c_nationkey").drop("company_id")


@query("dim_industry", "SELECT DISTINCT c_mktsegment AS industry FROM customer")
def dim_industry(spark, folder):
    firms = warehouse.dim_company(table(spark, folder, "customer"), "c_name", "c_nationkey", "c_mktsegment")
    return warehouse.dim_industry(firms).drop("industry_id")


@query(
    "dim_location",
    f"""WITH {_CANONICAL_SQL}, c AS (SELECT DISTINCT {_CITY} AS city FROM canonical)
 SELECT city, CASE WHEN city IN ({', '.join(f"'{c}'" for c in rules.REGION_NORTH)}) THEN 'North'
  WHEN city IN ({', '.join(f"'{c}'" for c in rules.REGION_CENTRAL)}) THEN 'Central' WHEN city <> 'Khác' THEN 'South' END AS region FROM c""",
)
def dim_location(spark, folder):
    return warehouse.dim_location(_canonical(spark, folder)).drop("location_id")


@query(
    "dim_date",
    """WITH s AS (SELECT min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders), d AS (SELECT unnest(generate_series(a, b, INTERVAL 1 DAY)) AS x FROM s)
 SELECT CAST(strftime(x, '%Y%m%d') AS INTEGER) AS date_id, strftime(x, '%Y-%m-%d') AS date, day(x) AS day, month(x) AS month,
  year(x) AS year, 'Q' || quarter(x) AS quarter FROM d""",
)
def dim_date(spark, folder):
    days = warehouse.dim_date(table(spark, folder, "orders"), "o_orderdate")
    return days.withColumn("date", F.date_format("date", "yyyy-MM-dd"))
