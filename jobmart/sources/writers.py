"""Batch sinks.  Credentials are options given by the caller or the environment."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEARCH_FORMAT = "org.elasticsearch.spark.sql"


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    compression: str | None = None,
    rows_per_file: int | None = None,
) -> None:
    """Parquet; ``rows_per_file`` bounds file size without pulling data into one task."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if compression:
        writer = writer.option("compression", compression)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)


def write_partitioned(
    df: DataFrame, path: str, city: str = "city", date: str = "posted_date", mode: str = "overwrite"
) -> None:
    """Parquet by city and posting date.

    The rebalance hint brings rows of a folder together and lets AQE split a folder with a large
    share of all rows over several tasks, each of about the advisory partition size.
    """
    df.hint("rebalance", city, date).write.mode(mode).partitionBy(city, date).parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None) -> None:
    writer = df.write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    writer.json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", separator: str = "; ") -> None:
    """CSV with header in UTF-8; arrays are joined, because CSV has none."""
    flat = df.select(*[
        F.array_join(f.name, separator).alias(f.name)
        if isinstance(f.dataType, T.ArrayType)
        else F.col(f.name)
        for f in df.schema
    ])
    flat.write.mode(mode).option("header", True).option("encoding", "UTF-8").csv(path)


def jdbc_options(
    url: str,
    table: str,
    driver: str | None = None,
    user_variable: str = "JOBMART_JDBC_USER",
    password_variable: str = "JOBMART_JDBC_PASSWORD",
    batch_size: int = 10_000,
    connections: int | None = None,
) -> dict[str, str]:
    """JDBC options; user and password come from environment variables when set.

    ``connections`` limits the number of partitions that write at the same time.
    """
    options = {"url": url, "dbtable": table, "batchsize": str(batch_size)}
    if driver:
        options["driver"] = driver
    if connections:
        options["numPartitions"] = str(connections)
    for key, variable in (("user", user_variable), ("password", password_variable)):
        if variable in os.environ:
            options[key] = os.environ[variable]
    return options


def append_jdbc(df: DataFrame, options: Mapping[str, str]) -> None:
    """Append to a warehouse table.  A failing write fails the job."""
    df.write.format("jdbc").options(**options).mode("append").save()


def search_options(
    index: str, nodes: str, port: int = 9200, id_column: str = "url", wan_only: bool = True
) -> dict[str, str]:
    """Search-index connector options; the key column is the document id, so a repeated write
    replaces the document."""
    return {
        "es.resource": index,
        "es.nodes": nodes,
        "es.port": str(port),
        "es.mapping.id": id_column,
        "es.nodes.wan.only": str(wan_only).lower(),
    }


def overwrite_search_index(df: DataFrame, options: Mapping[str, str]) -> None:
    df.write.format(SEARCH_FORMAT).options(**options).mode("overwrite").save()


def kafka_sink_options(
    servers: str, topic: str, acks: str = "all", retries: int = 3, batch_bytes: int = 16_384,
    linger_ms: int = 5, timeout_ms: int = 10_000,
) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": acks,
        "kafka.retries": str(retries),
        "kafka.batch.size": str(batch_bytes),
        "kafka.linger.ms": str(linger_ms),
        "kafka.request.timeout.ms": str(timeout_ms),
    }


def as_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as JSON text in ``value``; an optional key column keeps one key in one partition."""
    value = F.to_json(F.struct("*")).alias("value")
    return df.select(value) if key is None else df.select(F.col(key).cast("string").alias("key"), value)


def publish(df: DataFrame, options: Mapping[str, str], key: str | None = None) -> None:
    as_messages(df, key).write.format("kafka").options(**options).save()


def land_bronze(df: DataFrame, path: str, source: str = "source", landed: str = "crawled_ts") -> None:
    """Append raw records as JSON below ``source=…/y=…/m=…/d=…``."""
    day = F.to_date(landed)
    (
        df.withColumns({
            source: F.coalesce(F.col(source), F.lit("unknown")),
            "y": F.date_format(day, "yyyy"),
            "m": F.date_format(day, "MM"),
            "d": F.date_format(day, "dd"),
        })
        .write.mode("append")
        .partitionBy(source, "y", "m", "d")
        .json(path)
    )


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)
