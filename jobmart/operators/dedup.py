"""Duplicate removal.  Every "keep one" has a total order, so results do not depend on layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobmart.functions.items import row_hash
from jobmart.functions.text import text_key

_RANK = "_rank"


def keep_first(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``.

    Spark turns ``row_number() = 1`` into a group limit that each map task applies before the
    shuffle, so a key with a large share of all rows sends one row per task.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(first)).filter(F.col(_RANK) == 1).drop(_RANK)


def content_hash(df: DataFrame, skip: Sequence[str] = ()) -> Column:
    """Hash of a row; columns of a type that cannot be hashed count through their JSON form."""
    columns = [f for f in df.schema if f.name not in skip]
    plain = [F.col(f.name) for f in columns if "map<" not in f.dataType.simpleString()]
    maps = [F.to_json(F.struct(f.name)) for f in columns if "map<" in f.dataType.simpleString()]
    return F.xxhash64(*plain, *maps)


def drop_duplicate_urls(df: DataFrame, url: str = "url", newest: str | None = None) -> DataFrame:
    """One row per url: the newest, ties broken by the row's content.

    Rows without a url are told apart by their content: only full repetitions of such a row go.
    """
    content = content_hash(df)
    order = [F.col(newest).desc_nulls_last(), content.asc()] if newest else [content.asc()]
    whole = F.when(F.col(url).isNull(), F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])), 256))
    return keep_first(df, [F.col(url), whole], order)


def with_row_key(
    df: DataFrame, url: str = "url", parts: Sequence[str] = ("company", "title", "location_raw")
) -> DataFrame:
    """``row_key``: the url, else SHA-256 of company, title and location."""
    return df.withColumn("row_key", F.coalesce(F.col(url), row_hash(*map(F.col, parts))))


def drop_duplicate_keys(df: DataFrame, tie_break: Sequence[Column], key: str = "row_key") -> DataFrame:
    return keep_first(df, [key], tie_break)


def keep_latest(
    df: DataFrame,
    parts: Sequence[str] = ("company", "title", "location_raw"),
    date: str = "posted_date",
    tie_break: Sequence[str] = ("url",),
) -> DataFrame:
    """Newest advert per normalised company, title and address."""
    order = [F.col(date).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie_break]]
    return keep_first(df, [text_key(F.col(c)) for c in parts], order)


def one_row_per_key(df: DataFrame, key: str) -> DataFrame:
    """Distinct rows, then per key the one with most filled columns.

    Makes a table safe to use as a join dimension: a key that occurs twice multiplies rows.
    """
    others = [c for c in df.columns if c != key]
    filled = sum((F.col(c).isNotNull().cast("int") for c in others), F.lit(0))
    order = [filled.desc(), *[F.col(c).asc_nulls_last() for c in others]]
    return keep_first(df.filter(F.col(key).isNotNull()), [key], order)


def dedup_audit(df: DataFrame, keys: Sequence[Column]) -> DataFrame:
    """Rows before, after and removed, from one aggregation by key."""
    named = [k.alias(f"k{i}") for i, k in enumerate(keys)]
    per_key = df.groupBy(*named).agg(F.count("*").alias("n"))
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows_before"),
        F.count("*").alias("rows_after"),
    )
    return totals.withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))
