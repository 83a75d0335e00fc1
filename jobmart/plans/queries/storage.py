"""Write-and-read-back queries: what comes back equals the source."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobmart.functions.items import round_to_ten_thousand
from jobmart.operators import shape
from jobmart.plans.queries.base import POSTINGS_SQL, postings, query, table
from jobmart.scratch import fresh_path, materialise
from jobmart.sources import readers, writers

_ORDERS = "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders"


def _orders(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")


@query("sink_roundtrip_parquet", _ORDERS)
def sink_roundtrip_parquet(spark, folder):
    path = fresh_path(spark, "parquet")
    writers.write_parquet(_orders(spark, folder), path, compression="none", rows_per_file=1_000_000)
    return readers.read_parquet(spark, path)


@query("sink_roundtrip_json", _ORDERS)
def sink_roundtrip_json(spark, folder):
    path, rows = fresh_path(spark, "json"), _orders(spark, folder)
    writers.write_json(rows, path)
    return readers.read_json(spark, path, rows.schema)


@query("sink_roundtrip_csv", "SELECT p_partkey, p_brand || '; ' || p_type AS labels FROM part")
def sink_roundtrip_csv(spark, folder):
    path = fresh_path(spark, "csv")
    writers.write_csv(table(spark, folder, "part").select("p_partkey", F.array("p_brand", "p_type").alias("labels")), path)
    return spark.read.schema("p_partkey bigint, labels string").option("header", True).csv(path)


@query(
    "sink_roundtrip_partitioned",
    "SELECT o_orderkey, o_orderstatus AS city, strftime(o_orderdate, '%Y-%m-%d') AS posted_date FROM orders",
)
def sink_roundtrip_partitioned(spark, folder):
    path = fresh_path(spark, "partitioned")
    rows = table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("city"), F.trunc("o_orderdate", "year").alias("posted_date"),
        F.col("o_orderdate").cast("date").alias("day"),
    )
    writers.write_partitioned(rows, path)
    back = spark.read.schema(rows.schema).parquet(path)
    return back.select("o_orderkey", "city", F.date_format("day", "yyyy-MM-dd").alias("posted_date"))


@query(
    "sink_roundtrip_bronze",
    "SELECT event_id, coalesce(nullif(event_type, 'view'), 'unknown') AS source, strftime(ts, '%Y-%m-%d') AS landed FROM events",
)
def sink_roundtrip_bronze(spark, folder):
    path = fresh_path(spark, "bronze")
    rows = table(spark, folder, "events").select(
        "event_id", F.nullif("event_type", F.lit("view")).alias("source"), F.col("ts").alias("crawled_ts")
    )
    writers.land_bronze(rows, path)
    back = spark.read.schema("event_id bigint, source string, y string, m string, d string").json(path)
    return back.select("event_id", "source", F.concat_ws("-", "y", "m", "d").alias("landed"))


@query("sink_messages", "SELECT CAST(c_custkey AS VARCHAR) AS key, '{\"c_custkey\":' || c_custkey || '}' AS value FROM customer")
def sink_messages(spark, folder):
    """The rows a topic would get."""
    return writers.as_messages(table(spark, folder, "customer").select("c_custkey"), "c_custkey")


@query("materialise", _ORDERS)
def materialised(spark, folder):
    return materialise(_orders(spark, folder))


@query(
    "word_list",
    "SELECT DISTINCT w AS word FROM (SELECT unnest(regexp_split_to_array(text, '\\s+')) AS w FROM benchmark) WHERE w <> ''",
)
def word_list(spark, folder):
    """Words written one per line, read back trimmed and without blanks."""
    path = fresh_path(spark, "words")
    words = table(spark, folder, "benchmark").select(F.explode(F.split("text", r"\s+")).alias("w"))
    words.select(F.concat(F.lit("  "), "w", F.lit(" "))).write.text(path)
    return readers.read_word_list(spark, path)


_CUSTOMERS = "SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS c_mktsegment FROM customer"


def _customers(spark, folder):
    segment = F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("c_mktsegment")
    return table(spark, folder, "customer").select("c_custkey", "c_name", segment)


@query("source_json_merged", _CUSTOMERS)
def source_json_merged(spark, folder):
    """Records of different shapes; the schema is the union of all."""
    path, rows = fresh_path(spark, "merged"), _customers(spark, folder)
    writers.write_json(rows.filter("c_custkey % 2 = 0"), f"{path}/a")
    writers.write_json(rows.filter("c_custkey % 2 = 1").drop("c_mktsegment"), f"{path}/b")
    return readers.read_json(spark, [f"{path}/a", f"{path}/b"]).select("c_custkey", "c_name", "c_mktsegment")


@query("source_json_multi_line", _CUSTOMERS)
def source_json_multi_line(spark, folder):
    """One JSON array of at most 100 records per file, read through a tree of folders."""
    path, rows = fresh_path(spark, "arrays"), _customers(spark, folder)
    files = rows.groupBy(F.floor(F.col("c_custkey") / 100).alias("file")).agg(
        F.to_json(F.collect_list(F.struct("*"))).alias("value"))
    files.repartition("file").write.partitionBy("file").text(path)
    return readers.read_json(spark, path, rows.schema, multi_line=True, recursive=True)


@query("source_json_recursive", _CUSTOMERS)
def source_json_recursive(spark, folder):
    path, rows = fresh_path(spark, "tree"), _customers(spark, folder)
    for i in range(3):
        writers.write_json(rows.filter(F.col("c_custkey") % 3 == i), f"{path}/{'deep/' * i}part{i}")
    return readers.read_json(spark, path, rows.schema, recursive=True)


@query("external_import", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(c_acctbal AS DOUBLE) AS balance, CAST(NULL AS VARCHAR) AS missing FROM customer")
def external_import(spark, folder):
    """A landed data set with names and types of its own as a typed table."""
    path = fresh_path(spark, "external")
    writers.write_json(table(spark, folder, "customer").select("c_custkey", F.col("c_name").alias("Full Name"), "c_acctbal"), path)
    schema = T.StructType().add("id", "string").add("name", "string").add("balance", "double").add("missing", "string")
    return readers.import_dataset(spark, path, schema, {"c_custkey": "id", "Full Name": "name", "c_acctbal": "balance"})


@query(
    "stop_word_union",
    "SELECT DISTINCT w AS word FROM (SELECT unnest([c_mktsegment, 'the']) AS w FROM customer UNION ALL SELECT unnest([p_type, 'the']) FROM part)",
)
def stop_word_union(spark, folder):
    """Several word files, each word once over all."""
    path = fresh_path(spark, "lists")
    for name, column in (("customer", "c_mktsegment"), ("part", "p_type")):
        words = table(spark, folder, name).select(F.explode(F.array(F.concat(F.lit(" "), column), F.lit("the "))).alias("w"))
        words.write.text(f"{path}/{name}")
    return readers.read_word_list(spark, f"{path}/customer", f"{path}/part")


@query(
    "display_names",
    f"""WITH {POSTINGS_SQL} SELECT url AS "Đường dẫn", coalesce(title, 'Không rõ') AS "Vị trí công việc", CASE WHEN advert_id % 2 = 0 THEN 'x' ELSE '' END AS "Phúc lợi" FROM postings""",
)
def display_names(spark, folder):
    """Defaults, empty arrays for NULL and display names."""
    rows = postings(spark, folder).select("url", "title", F.when(F.col("advert_id") % 2 == 0, F.array(F.lit("x"))).alias("benefits"))
    filled = shape.with_empty_arrays(shape.with_text_defaults(rows, {"title": "Không rõ"}), ["benefits"])
    shown = shape.to_display(filled)
    return shown.withColumn("Phúc lợi", F.array_join("Phúc lợi", "|"))


@query(
    "predictions_json",
    "SELECT o_orderkey, o_totalprice AS stated_salary, round(o_totalprice * 1.1 / 10000) * 10000 AS predicted_salary FROM orders",
)
def predictions_json(spark, folder):
    """Stated and predicted amounts, written as JSON and read back."""
    path = fresh_path(spark, "predictions")
    rows = table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("stated_salary"), round_to_ten_thousand(F.col("o_totalprice") * 1.1).alias("predicted_salary"))
    writers.write_json(rows, path)
    return readers.read_json(spark, path, rows.schema)


@query(
    "source_variant",
    """SELECT c_custkey, CASE WHEN c_custkey % 3 <> 2 THEN c_name END AS c_name, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal END AS c_acctbal,
 CASE WHEN c_custkey % 3 = 2 THEN c_mktsegment END AS segment, CASE WHEN c_custkey % 3 = 2 THEN c_nationkey END AS nation FROM customer""",
)
def source_variant(spark, folder):
    """Records of three shapes, one of them nested, read without a schema; the columns come from one aggregation."""
    rows, path = table(spark, folder, "customer"), fresh_path(spark, "variant")
    nested = F.struct(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"))
    shapes = [["c_custkey", "c_name", "c_acctbal"], ["c_custkey", "c_name"], ["c_custkey", nested.alias("more")]]
    for i, columns in enumerate(shapes):
        writers.write_json(rows.filter(F.col("c_custkey") % 3 == i).select(*columns), f"{path}/{i}")
    found = readers.variant_columns(readers.read_json_variant(spark, f"{path}/*"))
    return found.select("c_custkey", "c_name", F.col("c_acctbal").cast("double").alias("c_acctbal"), "more.segment", "more.nation")
