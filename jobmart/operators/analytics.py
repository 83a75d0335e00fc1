"""Aggregations, top-k reports and trends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def mean_of(c: Column | str) -> Column:
    """Mean from an exact decimal sum, so the result does not depend on task order."""
    value = F.col(c) if isinstance(c, str) else c
    return F.sum(value.cast(MONEY)).cast("double") / F.count(value)


def salary_by(df: DataFrame, keys: Sequence[str], salary: str = "salary_mid") -> DataFrame:
    """Mean positive salary and number of adverts per group, highest mean first."""
    return (
        df.filter(F.col(salary) > 0)
        .groupBy(*keys)
        .agg(mean_of(salary).alias("avg_salary"), F.count("*").alias("n_jobs"))
        .orderBy(F.desc("avg_salary"), *keys)
    )


def salary_by_dimension(
    facts: DataFrame, fact_key: str, dimension: DataFrame, dimension_key: str, key: Column,
    name: str, salary: str = "salary_mid",
) -> DataFrame:
    """As ``salary_by`` for a group that a joined table gives (``key`` may explode an array).

    Facts are summed per join key first.  The join then moves one row per key, so neither the
    number of facts nor a key with a large share of them matters.
    """
    sums = facts.filter(F.col(salary) > 0).groupBy(fact_key).agg(
        F.sum(F.col(salary).cast(MONEY)).alias("_sum"), F.count("*").alias("_n")
    )
    grouped = dimension.select(F.col(dimension_key).alias("_key"), key.alias(name))
    return (
        sums.join(grouped, F.col(fact_key) == F.col("_key"))
        .groupBy(name)
        .agg((F.sum("_sum").cast("double") / F.sum("_n")).alias("avg_salary"), F.sum("_n").alias("n_jobs"))
        .orderBy(F.desc("avg_salary"), name)
    )


def count_by(df: DataFrame, *keys: str, name: str = "n_jobs") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name)).orderBy(F.desc(name), *keys)


def top(df: DataFrame, k: int, by: str, *tie_break: str) -> DataFrame:
    """First ``k`` rows by a descending column; every task keeps only its own ``k`` best."""
    return df.orderBy(F.desc(by), *tie_break).limit(k)


def top_companies(df: DataFrame, k: int = 5, company: str = "company") -> DataFrame:
    return top(df.groupBy(company).agg(F.count("*").alias("n_jobs")), k, "n_jobs", company)


def top_cities(salaries: DataFrame, k: int = 3, city: str = "city") -> DataFrame:
    """First ``k`` cities of a salary report."""
    return top(salaries, k, "avg_salary", city)


def salary_by_skill(df: DataFrame, skills: str = "skills", salary: str = "salary_mid") -> DataFrame:
    exploded = df.filter(F.col(salary) > 0).select(
        salary, F.explode(F.array_distinct(skills)).alias("skill")
    )
    return salary_by(exploded, ["skill"], salary)


def skill_demand_supply(job_skills: DataFrame, resume_skills: DataFrame) -> DataFrame:
    """Adverts per résumé for each skill; both sides are counted before they meet."""
    demand = job_skills.groupBy("skill").agg(F.count("*").alias("n_jobs"))
    supply = resume_skills.groupBy("skill").agg(F.count("*").alias("n_resumes"))
    ratio = F.col("n_jobs") / F.col("n_resumes")
    return demand.join(supply, "skill", "inner").withColumn("jobs_per_resume", ratio)


def hiring_trend(
    df: DataFrame, title_pattern: str, posted: str = "posted_date", title: str = "title",
    months: int = 6, until: Column | None = None,
) -> DataFrame:
    """Postings per month for titles that match, over the last ``months`` months up to ``until``.

    The period is a plain comparison on the date column, so it reaches the file scan.
    """
    end = until if until is not None else F.current_date()
    first = F.add_months(F.trunc(end, "month"), 1 - months)
    return (
        df.filter((F.col(posted) >= first) & (F.col(posted) < F.add_months(first, months)))
        .filter(F.lower(title).rlike(title_pattern))
        .groupBy(F.trunc(posted, "month").alias("month"))
        .agg(F.count("*").alias("n_jobs"))
        .orderBy("month")
    )
