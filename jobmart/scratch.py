"""Shared folder for intermediate tables, and lineage cuts that survive lost executors."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import Accumulator, StorageLevel
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, or one below the session's warehouse.

    Both are shared by the driver and all executors; machine-local temporary folders are never used.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet and read it back: the result has no lineage but the files."""
    spark = df.sparkSession
    target = path or fresh_path(spark, "table")
    df.write.mode("overwrite").parquet(target)
    return spark.read.schema(df.schema).parquet(target)


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Cache ``df`` while the block runs.  Lost blocks are recomputed from the lineage."""
    cached = df.persist(level)
    try:
        yield cached
    finally:
        cached.unpersist()


def counting_reads(df: DataFrame) -> tuple[DataFrame, Accumulator]:
    """``df``, and a counter of the rows that actions have read from it: cached rows count once, recomputed ones again.

    Rows pass through in Arrow batches.  A retried task counts its rows again, so the counter is for reports.
    """
    counter = df.sparkSession.sparkContext.accumulator(0)

    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counter.add(batch.num_rows)
            yield batch

    return df.mapInArrow(through, df.schema), counter
