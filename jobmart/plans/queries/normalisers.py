"""Normaliser queries: every row of the derived advert texts."""

from __future__ import annotations

import unicodedata

from pyspark.sql import functions as F

from jobmart import rules
from jobmart.functions import company, dates, items, level, location, salary, skills, text, workmode
from jobmart.plans.queries.base import (
    ADVERTS_SQL, DESCRIPTIONS_SQL, PLACES, POSTINGS_SQL, adverts, descriptions, pick, postings, query,
    sql_labels, sql_pick, table,
)

# ---- places ----------------------------------------------------------------------------

_PLACE_SQL = f"places AS (SELECT c_custkey, {sql_pick(PLACES, 'c_custkey')} AS place FROM customer)"
_IN_ORDER = [(label, [word]) for word, label in rules.PROVINCES]
_FIXED = [(label, [word]) for word, label in rules.with_trap_rules_first(rules.PROVINCES)]


def _places(spark, folder):
    return table(spark, folder, "customer").select("c_custkey", pick(PLACES, F.col("c_custkey")).alias("place"))


def _names(values: list[str]) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


@query(
    "province_map",
    f"""WITH {_PLACE_SQL}, p AS (SELECT c_custkey, {sql_labels('lower(place)', _FIXED, "'Khác'")} AS province,
  {sql_labels('lower(place)', _IN_ORDER, "'Khác'")} AS province_legacy FROM places)
 SELECT *, CASE WHEN province IN {_names(rules.REGION_NORTH)} THEN 'North'
  WHEN province IN {_names(rules.REGION_CENTRAL)} THEN 'Central' WHEN province <> 'Khác' THEN 'South' END AS region FROM p""",
)
def province_map(spark, folder):
    place = F.col("place")
    return _places(spark, folder).select(
        "c_custkey",
        location.province(place).alias("province"),
        location.province(place, legacy=True).alias("province_legacy"),
    ).withColumn("region", location.region(F.col("province")))


@query(
    "city_map_five",
    f"""WITH {ADVERTS_SQL} SELECT advert_id, CASE WHEN location_raw IS NULL THEN 'Không xác định' ELSE
 {sql_labels('lower(location_raw)', rules.CITIES_FIVE, "'Tỉnh thành khác'")} END AS city FROM adverts""",
)
def city_map_five(spark, folder):
    return adverts(spark, folder).select("advert_id", location.city_five(F.col("location_raw")).alias("city"))


@query(
    "city_map_pattern",
    f"""WITH {_PLACE_SQL}, t AS (SELECT *, trim(translate(lower(place), '.,', '  ')) AS s FROM places)
 SELECT c_custkey, CASE WHEN regexp_matches(s, '{rules.CITY_PATTERNS[0][1]}') THEN 'Thành Phố Hồ Chí Minh'
  WHEN regexp_matches(s, '{rules.CITY_PATTERNS[1][1]}') THEN 'Hà Nội' ELSE place END AS city FROM t""",
)
def city_map_pattern(spark, folder):
    return _places(spark, folder).select("c_custkey", location.city_by_pattern(F.col("place")).alias("city"))


# Title case in SQL: the first letter of every run of letters in upper case.
_TITLE_CASE = r"""array_to_string(list_transform(regexp_extract_all(lower({0}), '\p{{L}}+|[^\p{{L}}]+'),
 lambda w: upper(left(w, 1)) || substr(w, 2)), '')"""


@query(
    "city_map_stream",
    f"""WITH {ADVERTS_SQL} SELECT advert_id, CASE WHEN location_raw IS NULL OR location_raw = '' THEN 'Khác' ELSE
 {sql_labels('lower(location_raw)', rules.CITIES_STREAM, _TITLE_CASE.format('location_raw'))} END AS city FROM adverts""",
)
def city_map_stream(spark, folder):
    return adverts(spark, folder).select("advert_id", location.city_stream(F.col("location_raw")).alias("city"))


@query(
    "city_map_english",
    f"""WITH {ADVERTS_SQL} SELECT advert_id, CASE WHEN location_raw IS NULL THEN 'Unknown' ELSE
 {sql_labels('lower(location_raw)', rules.CITIES_ENGLISH, _TITLE_CASE.format('trim(location_raw)'))} END AS city FROM adverts""",
)
def city_map_english(spark, folder):
    return adverts(spark, folder).select("advert_id", location.city_english(F.col("location_raw")).alias("city"))


@query(
    "city_alias_collapse",
    f"""WITH {_PLACE_SQL} SELECT c_custkey, CASE WHEN place IN ('Hồ Chí Minh', 'TP.HCM', 'HCM')
 THEN 'Thành Phố Hồ Chí Minh' ELSE place END AS city, regexp_replace(place, '[^a-zA-Z0-9\\s.-]', '', 'g') AS folder_name FROM places""",
)
def city_alias_collapse(spark, folder):
    place = F.col("place")
    return _places(spark, folder).select(
        "c_custkey", location.collapse_city_aliases(place).alias("city"), location.partition_safe(place).alias("folder_name")
    )


@query(
    "city_address_split",
    f"""WITH {_PLACE_SQL}, t AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN place ELSE '- ' || place || ': Số ' || c_custkey || ': x ' END AS a FROM places)
 SELECT c_custkey, CASE WHEN contains(a, ':') THEN trim(replace(split_part(a, ':', 1), '-', '')) END AS city,
 CASE WHEN contains(a, ':') THEN trim(substr(a, strpos(a, ':') + 1)) ELSE a END AS address FROM t""",
)
def city_address_split(spark, folder):
    line = F.when(F.col("c_custkey") % 3 == 0, F.col("place")).otherwise(
        F.concat(F.lit("- "), "place", F.lit(": Số "), F.col("c_custkey").cast("string"), F.lit(": x "))
    )
    rows = _places(spark, folder).select("c_custkey", location.split_city_address(line).alias("s"))
    return rows.select("c_custkey", "s.city", "s.address")


# ---- levels and work modes -------------------------------------------------------------

_T = "lower(coalesce(title, ''))"


def _word_pattern(words: list[str]) -> str:
    escaped = "|".join(w.replace(".", r"\.") for w in words)
    return rf"(^|[^\p{{L}}\p{{M}}\p{{N}}_])({escaped})([^\p{{L}}\p{{M}}\p{{N}}_]|$)"


@query(
    "level_maps",
    f"""WITH {POSTINGS_SQL} SELECT advert_id, {sql_labels(_T, rules.LEVELS, "'Mid-level'")} AS level,
 CASE {' '.join(f"WHEN regexp_matches({_T}, '{_word_pattern(words)}') THEN '{label}'" for label, words in rules.LEVELS)}
  ELSE 'Mid-level' END AS level_words,
 CASE WHEN title IS NULL THEN 'Không xác định' ELSE {sql_labels(_T, rules.LEVELS_SIX, "'Mid-level'")} END AS level_six,
 {sql_labels(_T, rules.LEVELS_STREAM, "'Mid-level'")} AS level_stream FROM postings""",
)
def level_maps(spark, folder):
    title = F.col("title")
    return postings(spark, folder).select(
        "advert_id",
        level.level(title).alias("level"),
        level.level(title, whole_words=True).alias("level_words"),
        level.level_six(title).alias("level_six"),
        level.level_stream(title).alias("level_stream"),
    )


@query(
    "level_pattern",
    f"""WITH {POSTINGS_SQL} SELECT advert_id, CASE {' '.join(
        f"WHEN regexp_matches({_T}, '{'|'.join(words)}') THEN '{label}'" for label, words in rules.LEVELS)}
  ELSE 'Mid-level' END AS level FROM postings""",
)
def level_pattern(spark, folder):
    return postings(spark, folder).select("advert_id", level.level_by_pattern(F.col("title")).alias("level"))


_D = "lower(description || ' ' || source)"


@query(
    "work_mode_maps",
    f"""WITH {DESCRIPTIONS_SQL} SELECT doc_id, {sql_labels(_D, rules.WORK_MODES, "'Trực tiếp'")} AS work_mode,
 {sql_labels(_D, rules.WORK_MODES_ENGLISH, "'Office'")} AS work_mode_english FROM descriptions""",
)
def work_mode_maps(spark, folder):
    parts = F.col("description"), F.col("source")
    return descriptions(spark, folder).select(
        "doc_id", workmode.work_mode(*parts).alias("work_mode"), workmode.work_mode_english(*parts).alias("work_mode_english")
    )


# ---- salaries --------------------------------------------------------------------------

_INTEGER_PART = r"""CASE WHEN regexp_matches({0}, '^[0-9]+(\.[0-9]*)?$') THEN TRY_CAST(regexp_extract({0}, '^([0-9]+)', 1) AS BIGINT) END"""


def _salary(name: str, sql: str):
    return query(name, f"WITH {POSTINGS_SQL}, s AS (SELECT advert_id, salary_raw, lower(trim(salary_raw)) AS t FROM postings) {sql}")


@_salary(
    "salary_parse_range",
    r""", p AS (SELECT *, regexp_split_to_array(salary_raw, '\s*-\s*') AS parts FROM s),
 n AS (SELECT *, TRY_CAST(regexp_replace(parts[1], '[^0-9.]', '', 'g') AS DECIMAL(18,4)) AS a,
  TRY_CAST(regexp_replace(parts[2], '[^0-9.]', '', 'g') AS DECIMAL(18,4)) AS b FROM p)
 SELECT advert_id, CASE WHEN contains(t, 'cạnh tranh') THEN NULL
  WHEN contains(t, 'usd') THEN concat_ws(' - ', CAST(trunc(a * 25000) AS BIGINT), CAST(trunc(b * 25000) AS BIGINT))
  WHEN contains(t, 'tr') THEN concat_ws(' - ', CAST(trunc(a * 1000000) AS BIGINT), CAST(trunc(b * 1000000) AS BIGINT)) END AS salary FROM n""",
)
def salary_parse_range(spark, folder):
    return postings(spark, folder).select("advert_id", salary.salary_range_text(F.col("salary_raw")).alias("salary"))


@_salary(
    "salary_parse_free",
    rf""", p AS (SELECT *, string_split(regexp_replace(t, '[^0-9.-]+', '', 'g'), '-') AS parts,
  CASE WHEN regexp_matches(t, 'triệu|tr') THEN 1000000 WHEN regexp_matches(t, 'nghìn|k') THEN 1000 ELSE 1 END AS f FROM s
  WHERE NOT regexp_matches(coalesce(t, ''), '{rules.NEGOTIABLE}')),
 n AS (SELECT advert_id, {_INTEGER_PART.format('parts[1]')} * f AS lo, {_INTEGER_PART.format('parts[2]')} * f AS hi FROM p)
 SELECT s.advert_id, lo AS salary_min, coalesce(hi, lo) AS salary_max FROM s LEFT JOIN n USING (advert_id)""",
)
def salary_parse_free(spark, folder):
    return postings(spark, folder).select("advert_id", salary.salary_bounds(F.col("salary_raw")).alias("s")).select(
        "advert_id", "s.salary_min", "s.salary_max"
    )


@_salary(
    "salary_parse_units",
    r""", p AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(t, '([0-9])[.,]([0-9]{3})([^0-9]|$)', '\1\2\3', 'g'),
   '([0-9])[.,]([0-9]{3})([^0-9]|$)', '\1\2\3', 'g'), '([0-9])[.,]([0-9]{3})([^0-9]|$)', '\1\2\3', 'g') AS q FROM s),
 m AS (SELECT *, regexp_extract_all(q, '([0-9]+(?:[.,][0-9]+)?)\s*(triệu|tr|k)?', 1) AS nums,
  regexp_extract_all(q, '([0-9]+(?:[.,][0-9]+)?)\s*(triệu|tr|k)?', 2) AS units, regexp_matches(q, 'usd|\$') AS usd FROM p
  WHERE t IS NOT NULL AND NOT regexp_matches(t, 'thỏa thuận|thoả thuận|cạnh tranh|negotiable')),
 z AS (SELECT *, list_filter(units, lambda u: u <> '')[-1] AS shared FROM m),
 a AS (SELECT advert_id, t, list_transform(list_zip(nums, units), lambda x: CAST(trunc(
   CAST(replace(x[1], ',', '.') AS DECIMAL(18,4)) * (CASE WHEN usd THEN 25000 ELSE 1 END) *
   CASE coalesce(nullif(x[2], ''), shared) WHEN 'triệu' THEN 1000000 WHEN 'tr' THEN 1000000 WHEN 'k' THEN 1000
    ELSE CASE WHEN NOT usd AND CAST(replace(x[1], ',', '.') AS DECIMAL(18,4)) < 1000 THEN 1000000 ELSE 1 END END) AS BIGINT)) AS v FROM z)
 SELECT s.advert_id, CASE WHEN regexp_matches(a.t, '^(up to|tới) ') THEN 0 ELSE list_min(v) END AS salary_min,
  list_max(v) AS salary_max FROM s LEFT JOIN a USING (advert_id)""",
)
def salary_parse_units(spark, folder):
    """The shared parser of the batch and stream jobs."""
    return postings(spark, folder).select("advert_id", salary.salary_range(F.col("salary_raw")).alias("s")).select(
        "advert_id", "s.salary_min", "s.salary_max"
    )


@_salary(
    "salary_parse_display",
    r""", p AS (SELECT *, trim(replace(t, ',', '')) AS q FROM s),
 c AS (SELECT *, regexp_replace(q, '/tháng|tháng|/month|per month|/yr|/năm|năm|year|/year', ' ', 'g') AS w FROM p),
 m AS (SELECT *, regexp_extract_all(w, '([0-9]+(?:[.,][0-9]+)?)\s*(tr|m|k)?', 1) AS nums,
  regexp_extract_all(w, '([0-9]+(?:[.,][0-9]+)?)\s*(tr|m|k)?', 2) AS units FROM c),
 a AS (SELECT *, list_transform(list_zip(nums, units), lambda x: CAST(trunc(CAST(x[1] AS DOUBLE) *
   CASE x[2] WHEN 'tr' THEN 1e6 WHEN 'm' THEN 1e6 WHEN 'k' THEN 1e3 ELSE 1.0 END *
   CASE WHEN regexp_matches(q, '\$|usd') THEN 23500.0 ELSE 1.0 END) AS BIGINT)) AS v FROM m),
 d AS (SELECT advert_id, CASE WHEN regexp_matches(q, 'thương lượng|negotiable') THEN 'Thương lượng' WHEN len(v) = 0 THEN NULL
  WHEN regexp_matches(w, 'tới|to') THEN 'Tới ' || v[1] || ' VND/' || CASE WHEN regexp_matches(q, 'năm|yr') THEN 'năm' ELSE 'tháng' END
  WHEN len(v) >= 2 THEN list_min(v) || ' - ' || list_max(v) || ' VND' ELSE v[1] || ' VND' END AS salary FROM a)
 SELECT advert_id, salary, TRY_CAST(nullif(regexp_extract(salary, '([0-9]+)', 1), '') AS BIGINT) AS amount FROM d""",
)
def salary_parse_display(spark, folder):
    shown = postings(spark, folder).select("advert_id", salary.salary_display(F.col("salary_raw")).alias("salary"))
    return shown.withColumn("amount", salary.display_amount(F.col("salary")))


@_salary(
    "salary_parse_standard",
    r""", p AS (SELECT *, regexp_replace(t, '([0-9])[.,]([0-9]{3})', '\1\2', 'g') AS q FROM s),
 m AS (SELECT *, regexp_extract_all(q, '([0-9]+)\s*(tr|usd)?', 1) AS nums, regexp_extract_all(q, '([0-9]+)\s*(tr|usd)?', 2) AS units FROM p),
 a AS (SELECT *, list_filter(list_transform(list_zip(nums, units), lambda x: CASE x[2] WHEN 'tr' THEN CAST(x[1] AS BIGINT) * 1000000
   WHEN 'usd' THEN CAST(x[1] AS BIGINT) * 26000 ELSE CASE WHEN CAST(x[1] AS BIGINT) < 1000 THEN CAST(x[1] AS BIGINT) * 1000000
   ELSE CAST(x[1] AS BIGINT) END END), lambda y: y > 0) AS v FROM m)
 SELECT advert_id, CASE WHEN t IS NULL OR len(v) = 0 THEN 'unknown' WHEN regexp_matches(q, 'up\s+to|lên\s+đến') THEN '0 - ' || list_max(v)
  WHEN list_min(v) = list_max(v) THEN CAST(list_min(v) AS VARCHAR) ELSE list_min(v) || ' - ' || list_max(v) END AS salary FROM a""",
)
def salary_parse_standard(spark, folder):
    return postings(spark, folder).select("advert_id", salary.salary_standard(F.col("salary_raw")).alias("salary"))


@_salary(
    "salary_parse_stream",
    r""", p AS (SELECT *, replace(replace(t, ',', ''), '.', '') AS q FROM s),
 m AS (SELECT *, regexp_extract_all(q, '[0-9]+') AS n FROM p)
 SELECT advert_id, CAST(n[1] AS BIGINT) * CASE WHEN contains(q, 'usd') THEN 25000 WHEN contains(q, 'tr') THEN 1000000
   WHEN contains(q, 'nghìn') OR contains(q, 'k') THEN 1000 ELSE 1 END AS salary_min,
  CAST(CASE WHEN len(n) >= 2 THEN n[2] WHEN len(n) = 1 AND (contains(q, 'up to') OR contains(q, 'tới')) THEN n[1] END AS BIGINT)
   * CASE WHEN contains(q, 'usd') THEN 25000 WHEN contains(q, 'tr') THEN 1000000 ELSE 1 END AS salary_max,
  TRY_CAST(nullif(regexp_extract(salary_raw, '([0-9]+)', 1), '') AS BIGINT) * 1000000 AS first_number FROM m""",
)
def salary_parse_stream(spark, folder):
    pay = F.col("salary_raw")
    return postings(spark, folder).select(
        "advert_id",
        salary.stream_salary(pay)["salary_min"].alias("salary_min"),
        salary.stream_salary(pay)["salary_max"].alias("salary_max"),
        salary.first_number_millions(pay).alias("first_number"),
    )


# ---- skills ----------------------------------------------------------------------------

_EDGE = r"[^\p{L}\p{M}\p{N}_]"


def _escaped(word: str) -> str:
    return "".join("\\" + ch if ch in ".+*?()[]{}|^$\\" else ch for ch in word.lower())


def _skills_sql(keywords: list[str], legacy: bool = False) -> str:
    def pattern(k: str) -> str:
        word = r"[\p{L}\p{M}\p{N}_]"
        before = word if legacy and not k[0].isalnum() else rf"(?:^|{_EDGE})"
        after = word if legacy and not k[-1].isalnum() else rf"(?:$|{_EDGE})"
        return before + _escaped(k) + after

    checks = ", ".join(f"CASE WHEN regexp_matches(d, '{pattern(k)}') THEN '{k}' END" for k in keywords)
    return (
        f"WITH {DESCRIPTIONS_SQL}, t AS (SELECT doc_id, lower(description) AS d FROM descriptions) "
        f"SELECT doc_id, array_to_string(list_filter([{checks}], lambda x: x IS NOT NULL), '|') AS skills FROM t"
    )


@query("skills_extract", _skills_sql(rules.SKILLS))
def skills_extract(spark, folder):
    found = skills.extract_skills(F.col("description"))
    return descriptions(spark, folder).select("doc_id", F.array_join(found, "|").alias("skills"))


@query("skills_extract_legacy", _skills_sql(rules.SKILLS, legacy=True))
def skills_extract_legacy(spark, folder):
    found = skills.extract_skills(F.col("description"), legacy=True)
    return descriptions(spark, folder).select("doc_id", F.array_join(found, "|").alias("skills"))


@query("skills_extract_stream", _skills_sql(rules.SKILLS_STREAM))
def skills_extract_stream(spark, folder):
    found = skills.extract_skills(F.col("description"), keywords=rules.SKILLS_STREAM)
    return descriptions(spark, folder).select("doc_id", F.array_join(found, "|").alias("skills"))


# ---- company, dates, lists, links ------------------------------------------------------

_N = r"[\p{L}\p{M}\p{N}_\s.&*()-]+?"


@query(
    "company_recover",
    rf"""WITH t AS (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN c_name WHEN c_custkey % 5 = 1 THEN 'N/A' END AS given,
  CASE c_custkey % 4 WHEN 0 THEN 'Về Công ty TNHH ABC ' || c_custkey || '; tuyển' WHEN 1 THEN 'FPT Số ' || c_custkey || ' tuyển dụng DE'
   WHEN 2 THEN 'Làm việc. Tại Viettel ' || c_custkey || ', Hà Nội' ELSE 'không rõ' END AS d FROM customer)
 SELECT c_custkey, coalesce(CASE WHEN given <> 'N/A' THEN given END,
  nullif(trim(regexp_extract(d, '(?:Công ty TNHH|Công ty Cổ phần|Tập đoàn)[\s\p{{L}}\p{{M}}\p{{N}}_&.,()-]+', 0)), ''),
  nullif(trim(regexp_extract(d, '^({_N})\s+(?:tuyển dụng|tuyển|tìm kiếm)', 1)), ''),
  nullif(trim(regexp_extract(d, 'Tại ({_N}),', 1)), ''), 'Chưa xác định') AS company FROM t""",
)
def company_recover(spark, folder):
    key, number = F.col("c_custkey"), F.col("c_custkey").cast("string")
    given = F.when(key % 5 == 0, F.col("c_name")).when(key % 5 == 1, "N/A")
    told = (
        F.when(key % 4 == 0, F.concat(F.lit("Về Công ty TNHH ABC "), number, F.lit("; tuyển")))
        .when(key % 4 == 1, F.concat(F.lit("FPT Số "), number, F.lit(" tuyển dụng DE")))
        .when(key % 4 == 2, F.concat(F.lit("Làm việc. Tại Viettel "), number, F.lit(", Hà Nội")))
        .otherwise("không rõ")
    )
    return table(spark, folder, "customer").select("c_custkey", company.recover_company(given, told).alias("company"))


@query(
    "date_normalise",
    rf"""WITH {POSTINGS_SQL}, t AS (SELECT advert_id, posted_raw AS s,
  regexp_extract(posted_raw, '(?:^|[^0-9])([0-9]{{4}})[/-]([0-9]{{1,2}})[/-]([0-9]{{1,2}})(?:[^0-9]|$)', ['y', 'm', 'd']) AS i,
  regexp_extract(posted_raw, '(?:^|[^0-9])([0-9]{{1,2}})[/-]([0-9]{{1,2}})[/-]([0-9]{{4}}|[0-9]{{2}})(?:[^0-9]|$)', ['d', 'm', 'y']) AS e,
  regexp_extract(posted_raw, '([0-9]{{1,2}})[/-]([0-9]{{1,2}})[/-]([0-9]{{2,4}})', ['d', 'm', 'y']) AS l FROM postings),
 p AS (SELECT *, CASE WHEN i.y <> '' THEN try_strptime(i.y || '-' || i.m || '-' || i.d, '%Y-%m-%d')
  WHEN e.y <> '' THEN try_strptime((CASE WHEN length(e.y) = 2 THEN '20' ELSE '' END) || e.y || '-' || e.m || '-' || e.d, '%Y-%m-%d') END AS dt FROM t)
 SELECT advert_id, strftime(dt, '%Y-%m-%d') AS posted_date, strftime(dt, '%d/%m/%y') AS posted_text,
  CASE WHEN l.y <> '' THEN lpad(l.d, 2, '0') || '/' || lpad(l.m, 2, '0') || '/' || right(l.y, 2) END AS posted_legacy FROM p""",
)
def date_normalise(spark, folder):
    raw = F.col("posted_raw")
    return postings(spark, folder).select(
        "advert_id",
        F.date_format(dates.parse_date(raw), "yyyy-MM-dd").alias("posted_date"),
        dates.date_text(raw).alias("posted_text"),
        dates.date_text(raw, legacy=True).alias("posted_legacy"),
    )


@query(
    "relative_date",
    """SELECT event_id, strftime(CASE event_id % 5 WHEN 0 THEN date_trunc('second', ts) - (event_id % 90) * INTERVAL 1 MINUTE
 WHEN 1 THEN date_trunc('second', ts) - (event_id % 50) * INTERVAL 1 HOUR WHEN 2 THEN date_trunc('second', ts) - (event_id % 40) * INTERVAL 1 DAY
 WHEN 3 THEN ts END, '%Y-%m-%d') AS posted_date FROM events""",
)
def relative_date(spark, folder):
    key = F.col("event_id")
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    page = F.when(key % 5 != 4, F.concat(F.lit('<!-- Last updated: "'), stamp, F.lit(' +0700" -->'))).otherwise("<p>")
    ago = (
        F.when(key % 5 == 0, F.concat(F.lit("Posted "), (key % 90).cast("string"), F.lit(" minutes ago")))
        .when(key % 5 == 1, F.concat(F.lit("posted "), (key % 50).cast("string"), F.lit(" hours ago")))
        .when(key % 5 == 2, F.concat((key % 40).cast("string"), F.lit("  day ago")))
        .otherwise("long ago")
    )
    return table(spark, folder, "events").select(
        "event_id", F.date_format(dates.relative_date(page, ago), "yyyy-MM-dd").alias("posted_date")
    )


@query(
    "timestamp_parse",
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS shown, event_id % 3 <> 2 AS parsed FROM events",
)
def timestamp_parse(spark, folder):
    """ISO and dd/MM/yyyy timestamps parse, other text gives NULL."""
    key = F.col("event_id")
    raw = (
        F.when(key % 3 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .when(key % 3 == 1, F.date_format("ts", "dd/MM/yyyy HH:mm:ss"))
        .otherwise("hôm qua")
    )
    parsed = dates.parse_timestamp(raw, "dd/MM/yyyy HH:mm:ss")
    shown = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return table(spark, folder, "events").select(
        "event_id", F.coalesce(F.date_format(parsed, "yyyy-MM-dd HH:mm:ss"), shown).alias("shown"),
        parsed.isNotNull().alias("parsed"),
    )


@query(
    "benefits_list",
    """WITH t AS (SELECT p_partkey, list_filter([trim(' ' || p_brand || ' '), CASE WHEN p_size > 25 THEN '' ELSE p_type END, p_name],
  lambda x: x <> '') AS b FROM part)
 SELECT p_partkey, array_to_string(b, '|') AS benefits, array_to_string(b, ', ') AS benefits_text FROM t""",
)
def benefits_list(spark, folder):
    def benefit(title):
        return F.struct(title.alias("tieu_de"), F.lit("x").alias("mo_ta"))

    raw = F.array(
        benefit(F.concat(F.lit(" "), "p_brand", F.lit(" "))),
        benefit(F.when(F.col("p_size") > 25, "  ").otherwise(F.col("p_type"))),
        benefit(F.col("p_name")), benefit(F.lit(None).cast("string")),
    )
    found = items.benefit_titles(raw)
    return table(spark, folder, "part").select(
        "p_partkey", F.array_join(found, "|").alias("benefits"), items.items_text(found).alias("benefits_text")
    )


@query(
    "describe_short",
    """WITH t AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN text ELSE 'Head ' || doc_id || chr(10) || text || chr(10) || ' • a' || chr(10) || '•b' ||
  chr(10) || '• c' || chr(10) || '- no' || chr(10) || '•d' || chr(10) || '• e' || chr(10) || '• f' END AS d FROM documents),
 l AS (SELECT doc_id, d, string_split(d, chr(10)) AS s FROM t)
 SELECT doc_id, CASE WHEN d <> '' THEN regexp_replace(s[1] || chr(10) ||
  array_to_string(list_filter(s, lambda x: regexp_matches(x, '^\\s*•'))[1:5], chr(10)), '^\\s+|\\s+$', '', 'g') END AS short FROM l""",
)
def describe_short(spark, folder):
    bullets = F.lit("\n • a\n•b\n• c\n- no\n•d\n• e\n• f")
    told = F.when(F.col("doc_id") % 4 == 0, F.col("text")).otherwise(
        F.concat(F.lit("Head "), F.col("doc_id").cast("string"), F.lit("\n"), "text", bullets)
    )
    return table(spark, folder, "documents").select("doc_id", items.shorten_description(told).alias("short"))


@query(
    "kv_map",
    """SELECT p_partkey, p_brand AS brand, CAST(p_size AS VARCHAR) || ': cm' AS item_size, p_type AS repeated, CAST(3 AS BIGINT) AS n_keys FROM part""",
)
def kv_map(spark, folder):
    raw = F.array(
        F.concat(F.lit("Brand : "), "p_brand"),
        F.concat(F.lit(" Item Size: "), F.col("p_size").cast("string"), F.lit(": cm ")),
        F.lit("no separator"), F.lit("Again: first"), F.concat(F.lit("again: "), "p_type"),
    )
    rows = table(spark, folder, "part").select("p_partkey", items.key_value_map(raw).alias("m"))
    return rows.select(
        "p_partkey", F.col("m")["brand"].alias("brand"), F.col("m")["item_size"].alias("item_size"),
        F.col("m")["again"].alias("repeated"), F.size("m").cast("bigint").alias("n_keys"),
    )


@query(
    "label_fields",
    """SELECT p_partkey, p_brand AS level_raw, p_type AS posted_raw, CASE WHEN p_size > 10 THEN p_name END AS skills_raw,
 array_to_string([p_brand, p_type], '|') AS skill_items FROM part""",
)
def label_fields(spark, folder):
    labels = F.array(F.lit("CẤP BẬC"), F.lit("NGÀY ĐĂNG"), F.when(F.col("p_size") > 10, "KỸ NĂNG").otherwise("KHÁC"))
    values = F.array("p_brand", "p_type", "p_name")
    wanted = {name: label for label, name in rules.DETAIL_LABELS}
    return table(spark, folder, "part").select(
        "p_partkey",
        *[items.label_value(labels, values, wanted[n]).alias(n) for n in ("level_raw", "posted_raw", "skills_raw")],
        F.array_join(items.split_items(F.concat_ws(" , ", "p_brand", "p_type")), "|").alias("skill_items"),
    )


@query(
    "url_normalise",
    r"""WITH t AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN url ELSE regexp_replace(url, '^https?://[^/]+', '') || '/content/x' END AS href,
  CASE page_id % 3 WHEN 0 THEN 'Mới ' WHEN 1 THEN 'New  ' ELSE '' END || 'Job ' || page_id AS title FROM pages)
 SELECT page_id, CASE WHEN starts_with(split_part(href, '/content', 1), '/') THEN 'https://jobs.example.com' ELSE '' END
  || split_part(href, '/content', 1) AS link, regexp_replace(title, '^(Mới|New)\s+', '') AS title FROM t""",
)
def url_normalise(spark, folder):
    key = F.col("page_id")
    href = F.when(key % 2 == 0, F.col("url")).otherwise(
        F.concat(F.regexp_replace("url", r"^https?://[^/]+", ""), F.lit("/content/x"))
    )
    badge = F.when(key % 3 == 0, "Mới ").when(key % 3 == 1, "New  ").otherwise("")
    return table(spark, folder, "pages").select(
        "page_id",
        items.absolute_url(href, "https://jobs.example.com", "/content").alias("link"),
        items.strip_new_marker(F.concat(badge, F.lit("Job "), key.cast("string"))).alias("title"),
    )


@query(
    "row_json",
    """SELECT c_custkey, '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}' AS value,
 sha256(c_custkey || '||' || c_name) AS row_hash FROM customer""",
)
def row_json(spark, folder):
    rows = table(spark, folder, "customer").select("c_custkey", "c_name")
    return rows.select(
        "c_custkey", items.row_json().alias("value"), items.row_hash(F.col("c_custkey"), F.col("c_name")).alias("row_hash")
    )


@query(
    "text_nfc",
    "SELECT doc_id, sha256(text) AS text_hash FROM documents",
)
def text_nfc(spark, folder):
    """Texts taken apart into base letters and marks come back composed."""
    taken_apart = F.col("text")
    for base, mark in (("e", "\u0301"), ("e", "\u0300"), ("n", "\u0303"), ("u", "\u0308"), ("c", "\u0327")):
        whole, parts = unicodedata.normalize("NFC", base + mark), base + mark
        taken_apart = F.replace(taken_apart, F.lit(whole), F.lit(parts))
    return table(spark, folder, "documents").select("doc_id", F.sha2(text.nfc(taken_apart), 256).alias("text_hash"))


@query(
    "text_keys",
    f"""WITH {ADVERTS_SQL} SELECT advert_id, lower(trim(regexp_replace(company, '\\s+', ' ', 'g'))) AS company_key,
 lower(trim(regexp_replace(title, '\\s+', ' ', 'g'))) AS title_key FROM adverts""",
)
def text_keys(spark, folder):
    return adverts(spark, folder).select(
        "advert_id", text.text_key(F.col("company")).alias("company_key"), text.text_key(F.col("title")).alias("title_key")
    )


@query(
    "predicted_rounding",
    "SELECT o_orderkey, CAST(floor(o_totalprice / 10000 + 0.5) * 10000 AS BIGINT) AS rounded FROM orders",
)
def predicted_rounding(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", items.round_to_ten_thousand(F.col("o_totalprice")).cast("bigint").alias("rounded")
    )
