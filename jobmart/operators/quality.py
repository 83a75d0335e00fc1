"""Quality counts, each from a single pass over the data."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from jobmart import rules


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number and share of NULLs per column, one row per column."""
    counts = df.agg(F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    entries = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in columns
    ])
    return counts.select("n", F.explode(entries).alias("e")).select(
        "e.column_name", F.col("n").alias("n_rows"), "e.n_null",
        (F.col("e.n_null") / F.nullif(F.col("n"), F.lit(0))).alias("null_share"),
    )


def salary_coverage(df: DataFrame, low: str = "salary_min", high: str = "salary_max") -> DataFrame:
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col(low).isNull() & F.col(high).isNull()).alias("n_negotiable"),
        F.count_if(F.col(low).isNotNull()).alias("n_stated"),
    )


def disagreement(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """How often two classifiers differ (NULL against a value counts as different)."""
    return df.agg(F.count("*").alias("n_rows"), F.count_if(~a.eqNullSafe(b)).alias("n_different"))


def counts(seen: Observation) -> dict:
    """What was observed; zero rows when nothing was left to observe."""
    try:
        return seen.get
    except (AssertionError, Py4JJavaError) as problem:  # the plan of an empty result has no such node
        if "assertion failed" not in str(problem) and isinstance(problem, Py4JJavaError):
            raise
        return {"n_rows": 0}


def observe(df: DataFrame, name: str, columns: Sequence[str] = tuple(rules.REQUIRED)) -> tuple[DataFrame, Observation]:
    """``df`` with row and NULL counts collected while it is written; read ``counts``
    after the write.  No extra job."""
    seen = Observation(name)
    metrics = [F.count(F.lit(1)).alias("n_rows")]
    metrics += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns if c in df.columns]
    return df.observe(seen, *metrics), seen
