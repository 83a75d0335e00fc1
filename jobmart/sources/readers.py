"""Batch and stream readers.  Schemas are explicit; inference is an option."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_json(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    multi_line: bool = False,
    recursive: bool = False,
    keep_corrupt: bool = False,
) -> DataFrame:
    """JSON lines; ``multi_line`` for one JSON array per file, ``recursive`` for folder trees.

    A multi-line file cannot be split: convert such input to Parquet once and read that.
    Without ``schema`` the union of all record schemas is inferred in an extra pass.
    """
    reader = (
        spark.read.option("mode", "PERMISSIVE")
        .option("multiLine", multi_line)
        .option("recursiveFileLookup", recursive)
    )
    if schema is not None:
        if keep_corrupt:
            schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
            reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
        reader = reader.schema(schema)
    return reader.json(path)


def read_parquet(spark: SparkSession, *paths: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", merge_schema).parquet(*paths)


def read_table_file(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_word_list(spark: SparkSession, *paths: str) -> DataFrame:
    """Text lines, trimmed, blank lines removed, each word once over all files."""
    lines = spark.read.text(list(paths)).select(F.regexp_replace("value", r"^\s+|\s+$", "").alias("word"))
    return lines.filter(F.col("word") != "").distinct()


def import_dataset(
    spark: SparkSession, path: str, schema: T.StructType, renames: Mapping[str, str] | None = None
) -> DataFrame:
    """A landed external data set (JSON lines or Parquet) as a typed table."""
    raw = spark.read.parquet(path) if path.rstrip("/").endswith("parquet") else spark.read.json(path)
    raw = raw.withColumnsRenamed(dict(renames or {}))
    return raw.select(*[
        (F.col(f.name) if f.name in raw.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ])


def read_json_variant(spark: SparkSession, path: str | Sequence[str], payload: str = "payload") -> DataFrame:
    """JSON lines as one VARIANT column, without a schema or a pass to infer one; lines that are not JSON give NULL."""
    return spark.read.text(path).select(F.try_parse_json("value").alias(payload))


def variant_schema(rows: DataFrame, payload: str = "payload") -> T.StructType:
    """Schema that all records of a VARIANT column share: one aggregation, with the partial schemas merged before the shuffle.

    Fields that are NULL in every record become text.
    """
    found = rows.agg(F.schema_of_variant_agg(payload)).first()[0]
    ddl = re.sub(r"\bOBJECT<", "STRUCT<", found or "VOID")
    kind = T.DataType.fromDDL(re.sub(r"\bVOID\b", "STRING", ddl))
    return kind if isinstance(kind, T.StructType) else T.StructType()


def variant_columns(rows: DataFrame, schema: T.StructType | None = None, payload: str = "payload") -> DataFrame:
    """The fields of a VARIANT column as columns, missing ones NULL.  Without ``schema`` it is read off the records."""
    schema = variant_schema(rows, payload) if schema is None else schema
    quote = lambda name: '"' if "'" in name else "'"
    field = lambda name: f"$[{quote(name)}{name}{quote(name)}]"
    return rows.filter(F.col(payload).isNotNull()).select(*[
        F.try_variant_get(payload, field(f.name), f.dataType.simpleString()).alias(f.name) for f in schema])


def kafka_options(
    servers: str, topic: str, starting_offsets: str = "latest", extra: Mapping[str, str] | None = None
) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        **(extra or {}),
    }


def kafka_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Kafka source; needs the ``spark-sql-kafka`` package on the class path."""
    return spark.readStream.format("kafka").options(**options).load()


def json_file_stream(
    spark: SparkSession, folder: str, schema: T.StructType, max_files: int | None = None, archive: str | None = None
) -> DataFrame:
    """Folder of landed JSON-lines micro-batches as a stream.

    With ``archive`` (a folder outside ``folder``) files move there once the batches after theirs begin, so the
    folder to list stays small.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.json(folder)


def parquet_file_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def decode_messages(
    df: DataFrame, schema: T.StructType, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Bytes → text → struct → columns, plus ``payload`` for messages that are not JSON objects."""
    schema_with_bad = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    text = F.col(value).cast("string")
    parsed = F.from_json(
        text, schema_with_bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    rows = df.select(*keep, parsed.alias("data"))
    return rows.select(
        *keep,
        *[F.col(f"data.{f.name}").alias(f.name) for f in schema],
        F.col(f"data.{CORRUPT}").alias("payload"),
    )


def good_messages(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("payload").isNull()).drop("payload")


def bad_messages(decoded: DataFrame) -> DataFrame:
    """Payloads for the quarantine output."""
    return decoded.filter(F.col("payload").isNotNull()).select("payload")
