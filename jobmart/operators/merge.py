"""Keyed merge into a table kept in hash buckets of its key: only buckets with changes are read whole and rewritten.

The table is Parquet in one folder per bucket (``bucket_of_<n>=<i>``); the folder's name carries the number of buckets, so
a table cannot be merged by another number by mistake.  A merge compares keys and versions of the touched buckets
(two columns), then rewrites those buckets where a key is new or newer, by dynamic partition overwrite.  The merged
rows are written to the shared folder first, so a lost executor recomputes nothing that was overwritten, and as newest-wins
is idempotent, a merge that was broken off is simply run again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from jobmart.operators.dedup import drop_duplicate_urls
from jobmart.scratch import materialise

BUCKETS = 256


def _folder(buckets: int) -> str:
    return f"bucket_of_{buckets}"


def identity(df: DataFrame, key: str) -> Column:
    """The key as text; a row without one is told apart by its content."""
    return F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])), 256))


def _with_bucket(df: DataFrame, key: str, buckets: int) -> DataFrame:
    return df.withColumn(_folder(buckets), F.pmod(F.xxhash64(identity(df, key)), F.lit(buckets)).cast("int"))


def _write(rows: DataFrame, path: str, buckets: int, mode: str) -> None:
    writer = rows.hint("rebalance", _folder(buckets)).write.mode("overwrite").option("partitionOverwriteMode", mode)
    writer.partitionBy(_folder(buckets)).parquet(path)


def read_buckets(spark: SparkSession, path: str, buckets: int = BUCKETS) -> DataFrame:
    """The table with its bucket column, or an error if it was written with another number of buckets."""
    found = spark.read.option("mergeSchema", "true").parquet(path)  # later merges may have added columns
    if _folder(buckets) not in found.columns:
        raise ValueError(f"{path} is not kept in {buckets} buckets")
    return found


def merge_newest(
    spark: SparkSession, rows: DataFrame, path: str, key: str = "url", newest: str = "crawled_ts", buckets: int = BUCKETS,
) -> list[int]:
    """Merge ``rows`` into the table at ``path``, newest row per key; returns the buckets that were rewritten.

    The table is made if it is not there.  Ties in ``newest`` go by the rows' content; rows without a key are
    kept unless they repeat a row.  A key that is there with the same or a newer version changes nothing.  New
    columns are added with nulls in older rows; an empty table of rows changes nothing.
    """
    rows = drop_duplicate_urls(rows, url=key, newest=newest)
    fresh = materialise(_with_bucket(rows, key, buckets))
    column = _folder(buckets)
    try:
        before = read_buckets(spark, path, buckets)
    except AnalysisException:  # no table yet
        _write(fresh, path, buckets, "static")
        return sorted(r[0] for r in fresh.select(column).distinct().collect())
    touched = [r[0] for r in fresh.select(column).distinct().collect()]  # at most `buckets`
    before = before.filter(F.col(column).isin(touched))
    held = before.filter(F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.col(newest).alias("_newest"), F.col(column).alias("_bucket"))
    newer = fresh.join(held, (F.col(key) == F.col("_key")) & (F.col(column) == F.col("_bucket")), "left").filter(
        F.col("_key").isNull() | F.col("_newest").isNull() & F.col(newest).isNotNull() | (F.col(newest) > F.col("_newest")))
    newer = materialise(newer.select(*fresh.columns))
    changed = sorted(r[0] for r in newer.select(column).distinct().collect())
    if changed:
        both = newer.unionByName(before.filter(F.col(column).isin(changed)), allowMissingColumns=True)
        merged = materialise(_with_bucket(drop_duplicate_urls(both.drop(column), url=key, newest=newest), key, buckets))
        _write(merged, path, buckets, "dynamic")
    return changed
