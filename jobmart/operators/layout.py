"""Size of inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate: file sizes scaled to the columns read; joins multiply, so the
    estimate of anything but a plain scan errs on the large side."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by a hash of ``keys`` over all shuffle partitions, for costly work on narrow rows.

    A small file is read by few tasks, and AQE merges partitions by their bytes; neither says what a row will cost.
    """
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), *keys)
