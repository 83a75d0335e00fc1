"""Reports: salaries, counts, top-k, trends, quality, governance."""

from __future__ import annotations

from contextlib import nullcontext

from pyspark.sql import functions as F

from jobmart import rules
from jobmart.functions import level, location, salary, workmode
from jobmart.functions.text import text_key
from jobmart.operators import analytics, dedup, governance, joins, quality, shape
from jobmart.plans.queries.base import (
    ADVERTS_SQL, DESCRIPTIONS_SQL, JOB_SKILLS_SQL, POSTINGS_SQL, RESUME_SKILLS_SQL, adverts,
    descriptions, job_skills, postings, query, resume_skills, sql_labels, table,
)
from jobmart.scratch import counting_reads, persisted

_MEAN = "CAST(sum(CAST({0} AS DECIMAL(18,2))) AS DOUBLE) / count({0})"
_LEVEL = sql_labels("lower(coalesce(title, ''))", rules.LEVELS, f"'{rules.LEVEL_OTHER}'")
_PROVINCE_RULES = [(label, [word]) for word, label in rules.with_trap_rules_first(rules.PROVINCES)]
_PROVINCE = sql_labels("lower(coalesce(location_raw, ''))", _PROVINCE_RULES, f"'{rules.PROVINCE_OTHER}'")


def city_salaries(spark, folder):
    nation = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("city"))
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, folder, "orders").select("o_custkey", F.col("o_totalprice").alias("salary_mid"))
    places = joins.join_small(customer, nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return analytics.salary_by_dimension(orders, "o_custkey", places, "c_custkey", F.col("city"), "city")


_CITY_SQL = f"""SELECT n_name AS city, {_MEAN.format('o_totalprice')} AS avg_salary, count(*) AS n_jobs
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_totalprice > 0 GROUP BY 1"""


@query("salary_by_city", _CITY_SQL)
def salary_by_city(spark, folder):
    return city_salaries(spark, folder)


@query(
    "salary_by_priority",
    f"SELECT o_orderpriority AS level, {_MEAN.format('o_totalprice')} AS avg_salary, count(*) AS n_jobs "
    "FROM orders WHERE o_totalprice > 0 GROUP BY 1",
)
def salary_by_priority(spark, folder):
    orders = table(spark, folder, "orders")
    return analytics.salary_by(
        orders.select(F.col("o_orderpriority").alias("level"), F.col("o_totalprice").alias("salary_mid")), ["level"]
    )


@query("top_cities_avg", _CITY_SQL + " ORDER BY avg_salary DESC, city LIMIT 3")
def top_cities_avg(spark, folder):
    return analytics.top_cities(city_salaries(spark, folder))


@query("count_by_level", f"WITH {POSTINGS_SQL} SELECT {_LEVEL} AS level, count(*) AS n_jobs FROM postings GROUP BY 1")
def count_by_level(spark, folder):
    return analytics.count_by(postings(spark, folder).select(level.level(F.col("title")).alias("level")), "level")


@query("count_by_city", f"WITH {ADVERTS_SQL} SELECT {_PROVINCE} AS city, count(*) AS n_jobs FROM adverts GROUP BY 1")
def count_by_city(spark, folder):
    rows = adverts(spark, folder).select(location.province(F.col("location_raw")).alias("city"))
    return analytics.count_by(rows, "city")


@query(
    "count_by_work_mode",
    f"WITH {DESCRIPTIONS_SQL} SELECT "
    + sql_labels("lower(description || ' ' || source)", rules.WORK_MODES, f"'{rules.WORK_MODE_OTHER}'")
    + " AS work_mode, count(*) AS n_jobs FROM descriptions GROUP BY 1",
)
def count_by_work_mode(spark, folder):
    mode = workmode.work_mode(F.col("description"), F.col("source"))
    return analytics.count_by(descriptions(spark, folder).select(mode.alias("work_mode")), "work_mode")


@query(
    "top_companies",
    "SELECT c_name AS company, count(*) AS n_jobs FROM orders JOIN customer ON o_custkey = c_custkey "
    "GROUP BY 1 ORDER BY n_jobs DESC, company LIMIT 5",
)
def top_companies(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", F.col("c_name").alias("company"))
    jobs = table(spark, folder, "orders").select("o_custkey")
    return analytics.top_companies(jobs.join(customer, F.col("o_custkey") == F.col("c_custkey")), 5)


@query(
    "salary_by_skill",
    f"""SELECT skill, {_MEAN.format('salary')} AS avg_salary, count(*) AS n_jobs FROM (
 SELECT l_extendedprice AS salary, unnest(list_distinct([p_type, p_brand])) AS skill
 FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_extendedprice > 0) GROUP BY 1""",
)
def salary_by_skill(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", F.array("p_type", "p_brand").alias("skills"))
    lines = table(spark, folder, "lineitem").select("l_partkey", F.col("l_extendedprice").alias("salary_mid"))
    return analytics.salary_by_skill(lines.join(part, F.col("l_partkey") == F.col("p_partkey")))


@query(
    "skill_demand_supply",
    f"""WITH {JOB_SKILLS_SQL}, {RESUME_SKILLS_SQL},
 d AS (SELECT skill, count(*) AS n_jobs FROM job_skills GROUP BY 1),
 s AS (SELECT skill, count(*) AS n_resumes FROM resume_skills GROUP BY 1)
 SELECT skill, n_jobs, n_resumes, CAST(n_jobs AS DOUBLE) / n_resumes AS jobs_per_resume FROM d JOIN s USING (skill)""",
)
def skill_demand_supply(spark, folder):
    return analytics.skill_demand_supply(job_skills(spark, folder), resume_skills(spark, folder))


@query(
    "hiring_trend_monthly",
    f"""WITH {POSTINGS_SQL} SELECT strftime(date_trunc('month', posted_date), '%Y-%m-%d') AS month, count(*) AS n_jobs
 FROM postings WHERE posted_date >= DATE '2001-02-01' AND posted_date < DATE '2001-08-01'
 AND regexp_matches(lower(title), 'data|engineer') GROUP BY 1""",
)
def hiring_trend_monthly(spark, folder):
    trend = analytics.hiring_trend(
        postings(spark, folder), "data|engineer", months=6, until=F.lit("2001-07-15").cast("date")
    )
    return trend.withColumn("month", F.date_format("month", "yyyy-MM-dd"))


@query(
    "null_profile",
    f"""WITH {ADVERTS_SQL}, n AS (SELECT count(*) AS n_rows, count(*) - count(url) AS url, count(*) - count(title) AS title,
 count(*) - count(salary_raw) AS salary_raw, count(*) - count(location_raw) AS location_raw FROM adverts)
 SELECT column_name, n_rows, n_null, n_null / n_rows AS null_share FROM n UNPIVOT INCLUDE NULLS
 (n_null FOR column_name IN (url, title, salary_raw, location_raw))""",
)
def null_profile(spark, folder):
    return quality.null_profile(adverts(spark, folder), ["url", "title", "salary_raw", "location_raw"])


@query(
    "salary_coverage",
    """SELECT count(*) AS n_rows, count(*) FILTER (o_orderkey % 3 = 2) AS n_negotiable, count(*) FILTER (o_orderkey % 3 = 0) AS n_stated FROM orders""",
)
def salary_coverage(spark, folder):
    """A third of the adverts has both bounds, a third only the upper one, a third none."""
    key = F.col("advert_id")
    pay = F.when(key % 3 == 0, "10 - 20 tr").when(key % 3 == 1, "9 tr").otherwise("Thỏa thuận")
    rows = postings(spark, folder).select(key, salary.salary_range(pay).alias("s")).select(
        F.when(key % 3 == 0, F.col("s.salary_min")).alias("salary_min"), F.col("s.salary_max").alias("salary_max"))
    return quality.salary_coverage(rows)


@query(
    "classifier_disagreement",
    f"""WITH {POSTINGS_SQL} SELECT count(*) AS n_rows, count(*) FILTER (a <> b) AS n_different FROM (SELECT {_LEVEL} AS a, """
    + sql_labels("lower(coalesce(title, ''))", rules.LEVELS_STREAM, f"'{rules.LEVEL_OTHER}'")
    + " AS b FROM postings)",
)
def classifier_disagreement(spark, folder):
    title = F.col("title")
    return quality.disagreement(postings(spark, folder), level.level(title), level.level_stream(title))


@query(
    "level_cross_check",
    "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM orders",
)
def level_cross_check(spark, folder):
    """The two forms of the level classifier agree on every row."""
    title = F.col("title")
    return quality.disagreement(postings(spark, folder), level.level(title), level.level_by_pattern(title))


@query("row_count", "SELECT count(*) AS n_rows FROM lineitem")
def row_count(spark, folder):
    return quality.row_count(table(spark, folder, "lineitem"))


@query(
    "dedup_audit",
    f"""WITH {ADVERTS_SQL} SELECT count(*) AS rows_before, count(DISTINCT (c_name, title)) AS rows_after,
 count(*) - count(DISTINCT (c_name, title)) AS rows_removed FROM
 (SELECT lower(trim(regexp_replace(company, '\\s+', ' ', 'g'))) AS c_name,
  lower(trim(regexp_replace(title, '\\s+', ' ', 'g'))) AS title FROM adverts)""",
)
def dedup_audit(spark, folder):
    return dedup.dedup_audit(adverts(spark, folder), [text_key(F.col("company")), text_key(F.col("title"))])


_POLICIES = [
    governance.RolePolicy(
        tables=["adverts"],
        filters={"adverts": "salary_raw <> 'Thỏa thuận' AND salary_raw IS NOT NULL"},
        columns={"adverts": ["advert_id", "title", "salary_raw"]},
    )
]


@query(
    "row_policy_view",
    f"WITH {POSTINGS_SQL} SELECT advert_id, title, salary_raw FROM postings WHERE salary_raw <> 'Thỏa thuận' AND salary_raw IS NOT NULL",
)
def row_policy_view(spark, folder):
    return governance.apply_row_policy(postings(spark, folder), "adverts", _POLICIES)


@query(
    "row_cap",
    f"""WITH {POSTINGS_SQL} SELECT advert_id, title, salary_raw FROM postings WHERE salary_raw <> 'Thỏa thuận' AND salary_raw IS NOT NULL
 ORDER BY encode(salary_raw), advert_id LIMIT 5000""",
)
def row_cap(spark, folder):
    """What a report of at most 5000 rows shows."""
    view = governance.secured_view(postings(spark, folder), "secured_adverts", "adverts", _POLICIES)
    return governance.capped_result(view, 5000, ["salary_raw", "advert_id"])


@query(
    "secured_aggregate",
    f"""WITH {POSTINGS_SQL} SELECT salary_raw, count(*) AS n_rows, sum(advert_id)::BIGINT AS id_sum FROM postings
 WHERE salary_raw <> 'Thỏa thuận' AND salary_raw IS NOT NULL GROUP BY 1""",
)
def secured_aggregate(spark, folder):
    """An aggregate over a secured view sees every permitted row."""
    governance.secured_view(postings(spark, folder), "secured_postings", "adverts", _POLICIES)
    return spark.sql("SELECT salary_raw, count(*) AS n_rows, sum(advert_id) AS id_sum FROM secured_postings GROUP BY salary_raw")


@query(
    "row_policy_two_roles",
    f"""WITH {POSTINGS_SQL} SELECT advert_id, CASE WHEN advert_id % 2 = 0 THEN title END AS title,
 CASE WHEN o_custkey % 3 = 0 THEN salary_raw END AS salary_raw FROM postings
 WHERE (advert_id % 2 = 0 OR o_custkey % 3 = 0) AND title IS NOT NULL""",
)
def row_policy_two_roles(spark, folder):
    """Two roles with rows and columns of their own, and a restriction for both."""
    roles = [
        governance.RolePolicy(tables=["adverts"], filters={"adverts": "advert_id % 2 = 0"}, columns={"adverts": ["advert_id", "title"]}),
        governance.RolePolicy(tables=["adverts"], filters={"adverts": "o_custkey % 3 = 0"}, columns={"adverts": ["advert_id", "salary_raw"]}),
    ]
    return governance.apply_row_policy(postings(spark, folder), "adverts", roles, ["title IS NOT NULL"])


@query(
    "union_sources",
    """SELECT c_name AS company, c_acctbal AS balance, c_mktsegment AS segment, NULL AS s_suppkey FROM customer
 UNION ALL SELECT s_name, s_acctbal, NULL, s_suppkey FROM supplier""",
)
def union_sources(spark, folder):
    customer = table(spark, folder, "customer").select(
        F.col("c_name").alias("company"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    supplier = table(spark, folder, "supplier").select(
        "s_suppkey", F.col("s_acctbal").alias("balance"), F.col("s_name").alias("company")
    )
    return shape.union_sources([customer, supplier])


@query(
    "harmonise_columns",
    "SELECT c_name AS company, c_mktsegment AS city, CAST(c_nationkey AS VARCHAR) AS level, "
    "(CAST(c_acctbal AS DOUBLE) + c_custkey) / 2 AS salary_mid FROM customer",
)
def harmonise_columns(spark, folder):
    raw = table(spark, folder, "customer").select(
        F.col("c_name").alias("company_name"), F.col("c_mktsegment").alias("Địa chỉ"),
        F.col("c_nationkey").cast("string").alias("cap_bac"),
        F.col("c_acctbal").alias("luong_min"), F.col("c_custkey").alias("luong_max"),
    )
    same = shape.harmonise_columns(
        raw, derive={"salary_mid": shape.salary_midpoint("luong_min", "luong_max")}
    )
    return same.select("company", "city", "level", "salary_mid")


@query(
    "fill_defaults",
    f"""WITH {ADVERTS_SQL} SELECT advert_id, coalesce(title, 'Không rõ') AS title, coalesce(url, '') AS url FROM adverts
 WHERE location_raw IS NOT NULL AND posted_raw IS NOT NULL""",
)
def fill_defaults(spark, folder):
    rows = shape.require(adverts(spark, folder), ["location_raw", "posted_raw"])
    return shape.with_text_defaults(rows.select("advert_id", "title", "url"), {**rules.FILL_DEFAULTS, "url": ""})


@query(
    "training_rows",
    """SELECT o_orderkey AS advert_id, ((o_orderkey % 40 + 1) * 1000000 + (o_orderkey % 40 + 9) * 1000000) / 2.0::DOUBLE AS salary_label
 FROM orders WHERE o_orderkey % 3 > 0""",
)
def training_rows(spark, folder):
    key = F.col("advert_id")
    pay = F.when(key % 3 > 0, F.concat((key % 40 + 1).cast("string"), F.lit(" - "), (key % 40 + 9).cast("string"), F.lit(" tr")))
    rows = postings(spark, folder).select("advert_id", salary.salary_range(pay).alias("s")).select("advert_id", "s.*")
    return shape.with_salary_label(rows).select("advert_id", "salary_label")


@query("cache_reuse", "SELECT plan, times * count(*) AS rows_read FROM orders, (VALUES ('uncached', 2), ('cached', 1)) v(plan, times) GROUP BY plan, times")
def cache_reuse(spark, folder):
    """Rows read by two reports of the same table: twice without a cache, once with it."""
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    read = {}
    for plan in ("uncached", "cached"):
        counted, counter = counting_reads(rows)
        with persisted(counted) if plan == "cached" else nullcontext(counted) as source:
            for column in ("o_orderpriority", "o_orderstatus"):
                analytics.count_by(source, column).collect()
        read[plan] = counter.value
    return spark.createDataFrame(list(read.items()), "plan string, rows_read long")
