"""Star schema of job postings.

Surrogate keys are SHA-256 digests of the natural key: the same in every run and table, computed
without a shuffle, so facts get their keys without joining the dimensions, and too long to collide.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmart.functions.location import region
from jobmart.operators.dedup import keep_first


def surrogate_key(*natural: Column | str) -> Column:
    """NULL when the whole natural key is NULL; NULL and "" are told apart."""
    columns = [F.col(n) if isinstance(n, str) else n for n in natural]
    texts = [c.cast("string") for c in columns]
    return F.when(F.coalesce(*texts).isNotNull(), F.sha2(F.to_json(F.array(*texts)), 256))


def date_key(date: Column | str) -> Column:
    return F.date_format(date, "yyyyMMdd").cast("int")


def dim_job(adverts: DataFrame, title: str = "title", category: str = "level", skills: str = "skills") -> DataFrame:
    rows = adverts.filter(F.col(title).isNotNull()).select(
        F.col(title).alias("job_title"),
        F.col(category).alias("job_category"),
        F.array_join(F.array_sort(skills), ", ").alias("required_skills"),
    ).distinct()
    return rows.select(surrogate_key("job_title", "job_category", "required_skills").alias("job_id"), "*")


def job_key(title: str = "title", category: str = "level", skills: str = "skills") -> Column:
    return surrogate_key(
        F.col(title), F.col(category), F.array_join(F.array_sort(skills), ", ")
    )


def dim_company(
    companies: DataFrame, name: str = "company", size: str = "company_size", industry: str = "company_industry"
) -> DataFrame:
    """One row per company name."""
    rows = companies.filter(F.col(name).isNotNull()).select(
        F.col(name).alias("company_name"),
        F.col(size).alias("company_size"),
        F.col(industry).alias("industry"),
    )
    order = [F.col("company_size").asc_nulls_last(), F.col("industry").asc_nulls_last()]
    return keep_first(rows, ["company_name"], order).select(surrogate_key("company_name").alias("company_id"), "*")


def dim_industry(dim_company_rows: DataFrame) -> DataFrame:
    """Snowflake extension: industries on their own."""
    rows = dim_company_rows.select("industry").filter(F.col("industry").isNotNull()).distinct()
    return rows.select(surrogate_key("industry").alias("industry_id"), "industry")


def dim_location(adverts: DataFrame, city: str = "city") -> DataFrame:
    rows = adverts.select(F.col(city).alias("city")).filter(F.col("city").isNotNull()).distinct()
    return rows.select(surrogate_key("city").alias("location_id"), "city", region(F.col("city")).alias("region"))


def dim_date(facts: DataFrame, date: str = "posted_date") -> DataFrame:
    """Every day between the first and the last posting."""
    span = facts.agg(F.min(F.to_date(date)).alias("first"), F.max(F.to_date(date)).alias("last"))
    days = span.filter(F.col("first").isNotNull()).select(
        F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("date")
    )
    return days.select(
        date_key("date").alias("date_id"),
        "date",
        F.dayofmonth("date").alias("day"),
        F.month("date").alias("month"),
        F.year("date").alias("year"),
        F.concat(F.lit("Q"), F.quarter("date")).alias("quarter"),
    )


def fact_job_postings(
    adverts: DataFrame, posting_id: Sequence[str] = ("url",), applicants: str | None = None
) -> DataFrame:
    """One row per advert; salaries in million VND."""
    million = lambda c: F.col(c).cast("double") / 1_000_000
    return adverts.select(
        surrogate_key(*posting_id).alias("job_posting_id"),
        job_key().alias("job_id"),
        surrogate_key("company").alias("company_id"),
        surrogate_key("city").alias("location_id"),
        date_key("posted_date").alias("date_id"),
        million("salary_min").alias("min_salary"),
        million("salary_max").alias("max_salary"),
        (F.col(applicants).cast("int") if applicants else F.lit(None).cast("int")).alias("num_applicants"),
    )
