"""Registry of queries over the given tables, and the advert tables derived from them.

The tables hold no job adverts, so orders play the postings: their keys, prices and dates pick and
fill the advert texts.  Each derived column has a Spark form and the same rule as SQL text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart.sources.readers import read_table_file

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table_file(spark, folder, name)


# ---- texts that rows pick from ---------------------------------------------------------

TITLES = [
    "Senior Backend Engineer", "Trưởng phòng IT", "Thực tập sinh", "Project Coordinator",
    "Photoshop Designer", "Internal Auditor", "Director of Data", "Data Engineer",
    "Fresher  Java  Developer", "Chuyên viên chính Phân tích", "Sr. QA Tester", "Mới Data Analyst",
    "HEAD OF MARKETING", "Phó Giám đốc kỹ thuật", "",
]
PLACES = [
    "Quận 1, Hồ Chí Minh", "Cầu Giấy, HÀ NỘI", "Hải Châu, Đà Nẵng", "Ninh Kiều, Cần Thơ",
    "Cty A, TPHCM", "Company C in London", "TP. Vinh, Nghệ An", "Trà Vinh", "Huế", "Remote",
    "Bà Rịa-Vũng Tàu", "Biên Hòa", "Nha Trang", "Buôn Ma Thuột", "tp.hcm", "HCM", "Hanoi",
    "TP.HCM", "Hồ Chí Minh", "Bắc Ninh", "Quảng Ngãi", "Lâm Đồng", "Long An", "thủ đô o'neil-park",
    "",
]
PHRASES = [
    "C++ and C# on .NET", "asp.net core, c++11", "google go; AI/ML", "Java, JavaScript", "Node.js remote",
    "SQL Server big data warehouse", "làm việc từ xa, hybrid", "Bán thời gian tại văn phòng", "linh hoạt",
    "machine learning with Spark, Kafka", "no skill here", "Power BI/Tableau",
]


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def pick(values: list[str], index: Column) -> Column:
    """Element chosen by a row's key."""
    return F.get(F.array(*map(F.lit, values)), F.pmod(index, F.lit(len(values))).cast("int"))


def sql_pick(values: list[str], index: str) -> str:
    return f"{sql_list(values)}[({index}) % {len(values)} + 1]"


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def salary_text() -> Column:
    """Salary text in thirteen forms, amounts from the order's price."""
    key = F.col("o_orderkey")
    low = F.floor(F.col("o_totalprice") / 10_000)
    high = low + key % 7 + 1
    whole = F.floor("o_totalprice") * 100
    form = key % 13
    return (
        F.when(form == 0, _text(low, " - ", high, " tr"))
        .when(form == 1, _text(low * 20, " - ", high, ",000 USD"))
        .when(form == 2, _text("Up to ", high, "tr"))
        .when(form == 3, "Thỏa thuận")
        .when(form == 4, _text(whole))
        .when(form == 5, _text("Tới ", high, ".000 USD"))
        .when(form == 6, _text(low, ".5 triệu"))
        .when(form == 7, _text((low + 1) * 100, "k"))
        .when(form == 8, _text("Lương: ", low, " Tr - ", high, " Tr VND"))
        .when(form == 9, "Cạnh tranh")
        .when(form == 10, _text("1,", low + 100, " USD/năm"))
        .when(form == 11, _text("Negotiable"))
    )


_LOW = "CAST(floor(o_totalprice / 10000) AS BIGINT)"
_HIGH = f"({_LOW} + o_orderkey % 7 + 1)"
SALARY_SQL = f"""CASE o_orderkey % 13
 WHEN 0 THEN {_LOW} || ' - ' || {_HIGH} || ' tr'
 WHEN 1 THEN ({_LOW} * 20) || ' - ' || {_HIGH} || ',000 USD'
 WHEN 2 THEN 'Up to ' || {_HIGH} || 'tr'
 WHEN 3 THEN 'Thỏa thuận'
 WHEN 4 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) * 100 AS VARCHAR)
 WHEN 5 THEN 'Tới ' || {_HIGH} || '.000 USD'
 WHEN 6 THEN {_LOW} || '.5 triệu'
 WHEN 7 THEN (({_LOW} + 1) * 100) || 'k'
 WHEN 8 THEN 'Lương: ' || {_LOW} || ' Tr - ' || {_HIGH} || ' Tr VND'
 WHEN 9 THEN 'Cạnh tranh'
 WHEN 10 THEN '1,' || ({_LOW} + 100) || ' USD/năm'
 WHEN 11 THEN 'Negotiable' END"""


def posted_text() -> Column:
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    form = key % 5
    return (
        F.when(form == 0, F.date_format(day, "dd/MM/yyyy"))
        .when(form == 1, F.date_format(day, "yyyy-MM-dd"))
        .when(form == 2, F.concat(F.date_format(day, "dd-MM-"), F.lit("2"), F.substring(F.date_format(day, "yy"), 2, 1)))
        .when(form == 3, F.concat(F.lit("Ngày "), F.date_format(day, "dd/MM/yyyy")))
        .otherwise("N/A")
    )


POSTED_SQL = """CASE o_orderkey % 5
 WHEN 0 THEN strftime(o_orderdate, '%d/%m/%Y')
 WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
 WHEN 2 THEN strftime(o_orderdate, '%d-%m-') || '2' || right(strftime(o_orderdate, '%y'), 1)
 WHEN 3 THEN 'Ngày ' || strftime(o_orderdate, '%d/%m/%Y')
 ELSE 'N/A' END"""


def postings(spark: SparkSession, folder: str) -> DataFrame:
    """Adverts from orders alone."""
    key = F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        key.alias("advert_id"),
        F.when(key % 11 != 0, _text("https://jobs.example.com/", F.col("o_custkey"))).alias("url"),
        F.when(key % 17 != 0, pick(TITLES, key)).alias("title"),
        salary_text().alias("salary_raw"),
        posted_text().alias("posted_raw"),
        F.col("o_orderdate").cast("date").alias("posted_date"),
        F.col("o_totalprice").alias("salary_mid"),
        "o_custkey",
    )


POSTINGS_SQL = f"""postings AS (
 SELECT o_orderkey AS advert_id,
  CASE WHEN o_orderkey % 11 <> 0 THEN 'https://jobs.example.com/' || o_custkey END AS url,
  CASE WHEN o_orderkey % 17 <> 0 THEN {sql_pick(TITLES, 'o_orderkey')} END AS title,
  {SALARY_SQL} AS salary_raw,
  {POSTED_SQL} AS posted_raw,
  CAST(o_orderdate AS DATE) AS posted_date, o_totalprice AS salary_mid, o_custkey
 FROM orders)"""


def company_name() -> Column:
    """Company name in varying case and spacing."""
    return F.when(F.col("advert_id") % 3 == 0, F.upper("c_name")).when(
        F.col("advert_id") % 3 == 1, F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))
    ).otherwise(F.col("c_name"))


def adverts(spark: SparkSession, folder: str) -> DataFrame:
    """Adverts with company and place."""
    customer = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    joined = postings(spark, folder).join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.withColumns({
        "company": company_name(),
        "location_raw": F.when(F.col("c_custkey") % 19 != 0, pick(PLACES, F.col("c_custkey"))),
    })


ADVERTS_SQL = f"""{POSTINGS_SQL}, adverts AS (
 SELECT p.*, c_custkey, c_name, c_nationkey, c_mktsegment,
  CASE advert_id % 3 WHEN 0 THEN upper(c_name) WHEN 1 THEN '  ' || c_name || ' ' ELSE c_name END AS company,
  CASE WHEN c_custkey % 19 <> 0 THEN {sql_pick(PLACES, 'c_custkey')} END AS location_raw
 FROM postings p JOIN customer ON o_custkey = c_custkey)"""


def descriptions(spark: SparkSession, folder: str) -> DataFrame:
    """Whole document texts with a skill or work-mode phrase in front."""
    return table(spark, folder, "documents").select(
        "doc_id", F.concat(pick(PHRASES, F.col("doc_id")), F.lit("\n"), F.col("text")).alias("description"),
        "lang", "source",
    )


DESCRIPTIONS_SQL = f"""descriptions AS (
 SELECT doc_id, {sql_pick(PHRASES, 'doc_id')} || chr(10) || text AS description, lang, source FROM documents)"""


def job_skills(spark: SparkSession, folder: str) -> DataFrame:
    """(order, brand) rows: the skills an advert asks for."""
    part = table(spark, folder, "part").select("p_partkey", F.col("p_brand").alias("skill"))
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "skill").distinct()


JOB_SKILLS_SQL = """job_skills AS (
 SELECT DISTINCT l_orderkey, p_brand AS skill FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def resume_skills(spark: SparkSession, folder: str) -> DataFrame:
    """(supplier, brand) rows: the skills a résumé offers."""
    part = table(spark, folder, "part").select("p_partkey", F.col("p_brand").alias("skill"))
    lines = table(spark, folder, "lineitem").select("l_suppkey", "l_partkey")
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select("l_suppkey", "skill").distinct()


RESUME_SKILLS_SQL = """resume_skills AS (
 SELECT DISTINCT l_suppkey, p_brand AS skill FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def sql_contains(text: str, words: list[str]) -> str:
    return "(" + " OR ".join("contains(" + text + ", '" + w.replace("'", "''") + "')" for w in words) + ")"


def sql_labels(text: str, rules: list[tuple[str, list[str]]], otherwise: str) -> str:
    whens = " ".join(f"WHEN {sql_contains(text, words)} THEN '{label}'" for label, words in rules)
    return f"CASE {whens} ELSE {otherwise} END"
