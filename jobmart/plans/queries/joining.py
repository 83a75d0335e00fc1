"""Join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobmart.operators import joins, pages
from jobmart.plans.queries.base import (
    JOB_SKILLS_SQL, RESUME_SKILLS_SQL, job_skills, query, resume_skills, table,
)
from jobmart.scratch import materialise
from jobmart.session import CBO_CONF


@query(
    "join_broadcast",
    "SELECT o_orderkey, c_name AS company, c_mktsegment AS segment FROM orders JOIN customer ON o_custkey = c_custkey",
)
def join_broadcast(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    company = table(spark, folder, "customer").select(
        "c_custkey", F.col("c_name").alias("company"), F.col("c_mktsegment").alias("segment")
    )
    joined = joins.join_small(orders, company, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select("o_orderkey", "company", "segment")


@query(
    "join_auto",
    "SELECT c_custkey, n_name AS city FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def join_auto(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("city"))
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "city")


@query(
    "join_sort_merge",
    "SELECT l_orderkey, l_linenumber, o_orderpriority FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
)
def join_sort_merge(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    joined = joins.join_large(lines, orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select("l_orderkey", "l_linenumber", "o_orderpriority")


_THREE_SQL = """SELECT l_orderkey, l_linenumber, p_name AS role, s_name AS company
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey"""


@query("join_three_way", _THREE_SQL)
def join_three_way(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    company = table(spark, folder, "supplier").select("s_suppkey", F.col("s_name").alias("company"))
    role = table(spark, folder, "part").select("p_partkey", F.col("p_name").alias("role"))
    joined = joins.join_three(
        lines, company, role, F.col("l_suppkey") == F.col("s_suppkey"), F.col("l_partkey") == F.col("p_partkey")
    )
    return joined.select("l_orderkey", "l_linenumber", "role", "company")


@query("join_three_way_sql", _THREE_SQL)
def join_three_way_sql(spark, folder):
    for view, name in (("job", "lineitem"), ("company", "supplier"), ("role", "part")):
        table(spark, folder, name).createOrReplaceTempView(f"jobmart_{view}")
    return joins.three_way_sql(
        spark,
        columns="f.l_orderkey, f.l_linenumber, b.p_name AS role, a.s_name AS company",
        fact="jobmart_job", first="jobmart_company", fact_first="l_suppkey", first_key="s_suppkey",
        second="jobmart_role", second_owner="f", owner_second="l_partkey", second_key="p_partkey",
    )


CBO_SQL = """SELECT l_orderkey, l_linenumber, p_name AS role, s_name AS company
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey JOIN {supplier} ON l_suppkey = s_suppkey WHERE s_acctbal > 5000"""


@query("join_three_way_cbo", CBO_SQL.format(lineitem="lineitem", part="part", supplier="supplier"))
def join_three_way_cbo(spark, folder):
    """The written order joins all roles first; the statistics say that few companies are left, so they go first."""
    given = {name: table(spark, folder, name) for name in ("lineitem", "part", "supplier")}
    with joins.analysed_tables(spark, **given) as names, joins.settings(spark, CBO_CONF):
        return materialise(spark.sql(CBO_SQL.format(**names)))  # planned and run while tables and settings are there


@query(
    "skill_explode_join",
    f"""WITH {JOB_SKILLS_SQL}, {RESUME_SKILLS_SQL}
 SELECT l_orderkey, skill, n_resumes FROM job_skills JOIN
 (SELECT skill, count(*) AS n_resumes FROM resume_skills GROUP BY 1) USING (skill)""",
)
def skill_explode_join(spark, folder):
    return joins.skill_supply_join(job_skills(spark, folder), resume_skills(spark, folder)).select(
        "l_orderkey", "skill", "n_resumes"
    )


@query(
    "skill_overlap",
    f"""WITH {JOB_SKILLS_SQL}, {RESUME_SKILLS_SQL}
 SELECT skill, count(DISTINCT l_orderkey) AS n_jobs, count(DISTINCT l_suppkey) AS n_resumes, count(*) AS n_pairs
 FROM job_skills JOIN resume_skills USING (skill) GROUP BY 1""",
)
def skill_overlap(spark, folder):
    pairs = joins.skill_overlap(job_skills(spark, folder), resume_skills(spark, folder))
    return pairs.withColumn("n_pairs", F.col("n_pairs").cast("bigint"))


def _order_parts(spark, folder):
    """Advert = order, skill = part it asks for."""
    return table(spark, folder, "lineitem").select("l_orderkey", F.col("l_partkey").alias("skill")).distinct()


def _customer_parts(spark, folder):
    """Résumé = customer and year, skill = part of an order of that year."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.concat_ws("-", "o_custkey", F.year("o_orderdate")).alias("resume_id")
    )
    lines = table(spark, folder, "lineitem").select("l_orderkey", F.col("l_partkey").alias("skill"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("resume_id", "skill").distinct()


@query(
    "job_resume_match",
    """WITH j AS (SELECT DISTINCT l_orderkey AS id, l_partkey AS skill FROM lineitem),
 r AS (SELECT DISTINCT o_custkey || '-' || year(o_orderdate) AS id, l_partkey AS skill
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
 js AS (SELECT id, list_sort(list(skill)) AS skills FROM j GROUP BY 1),
 rs AS (SELECT id, list_sort(list(skill)) AS skills FROM r GROUP BY 1),
 jset AS (SELECT skills, count(*) AS n_jobs, min(id) AS id FROM js GROUP BY 1),
 rset AS (SELECT skills, count(*) AS n_resumes, min(id) AS id FROM rs GROUP BY 1),
 shared AS (SELECT a.id AS jid, b.id AS rid, count(*) AS n FROM
  (SELECT id, unnest(skills) AS skill FROM jset) a JOIN (SELECT id, unnest(skills) AS skill FROM rset) b USING (skill)
  GROUP BY 1, 2)
 SELECT array_to_string(jset.skills, ',') AS job_skills, array_to_string(rset.skills, ',') AS resume_skills,
  n_jobs, n_resumes, n AS n_shared, CAST(n AS DOUBLE) / (len(jset.skills) + len(rset.skills) - n) AS score
 FROM shared JOIN jset ON jid = jset.id JOIN rset ON rid = rset.id WHERE 2 * n >= len(jset.skills) + len(rset.skills) - n""",
)
def job_resume_match(spark, folder):
    matches = joins.skillset_matches(
        _order_parts(spark, folder), _customer_parts(spark, folder), "l_orderkey", "resume_id", 0.5
    )
    shown = lambda c: F.array_join(F.array_sort(c), ",").alias(c)
    return matches.select(
        shown("job_skills"), shown("resume_skills"), "n_jobs", "n_resumes",
        F.col("n_shared").cast("bigint").alias("n_shared"), "score",
    )


@query(
    "certificates_by_role",
    """WITH jobs AS (SELECT p_name AS job_title, count(*) AS n_jobs FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1),
 roles AS (SELECT DISTINCT p_name AS job_title, unnest([p_brand, p_type]) AS certificate FROM part)
 SELECT job_title, certificate, n_jobs FROM jobs JOIN roles USING (job_title)""",
)
def certificates_by_role(spark, folder):
    part = table(spark, folder, "part")
    roles = part.select(F.col("p_name").alias("job_title"), F.array("p_brand", "p_type").alias("certificates"))
    titles = part.select("p_partkey", F.col("p_name").alias("job_title"))
    jobs = table(spark, folder, "lineitem").select("l_partkey").join(titles, F.col("l_partkey") == F.col("p_partkey"))
    return joins.certificates_by_role(jobs, roles)


@query(
    "new_urls",
    r"""WITH l AS (SELECT DISTINCT regexp_extract(url, '^(https?://[^/]+)', 1) || href AS url FROM
  (SELECT url, unnest(regexp_extract_all(html, '<a [^>]*href="([^"]+)"', 1)) AS href FROM pages) WHERE href LIKE '/%')
 SELECT url FROM l ANTI JOIN pages USING (url)""",
)
def new_urls(spark, folder):
    stored = table(spark, folder, "pages")
    parsed = pages.with_nodes(stored, keep=["url"])
    links = pages.harvested_links(parsed).select(F.col("link").alias("url")).distinct()
    return joins.unseen(links, stored)
