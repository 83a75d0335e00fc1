"""Stream queries that stop and go on: increments land one after the other and each run continues at the checkpoint."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobmart.plans.queries.base import query, table
from jobmart.scratch import fresh_path
from jobmart.sources import readers, writers
from jobmart.streaming import recovery, sinks, transforms

EVENT = T.StructType().add("url", "string").add("source", "string").add("crawled_ts", "timestamp").add("event_id", "long")


def event_rows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("url"), F.col("event_type").alias("source"),
        F.col("ts").cast("timestamp").alias(transforms.EVENT_TIME), "event_id")


def in_runs(rows: DataFrame, base: str, increments: Sequence[str], change: Callable[[DataFrame], DataFrame], write, mode: str = "append") -> None:
    """Land each increment as a Parquet folder and run the stream until it is used up, from one checkpoint on."""
    spark = rows.sparkSession
    for i, test in enumerate(increments):
        rows.filter(test).write.parquet(f"{base}/in/part-{i}")
        stream = change(readers.parquet_file_stream(spark, f"{base}/in/part-*", rows.schema))
        sinks.for_each_batch(stream, write, f"{base}/checkpoint", mode, every=None).awaitTermination()


def _with_batch(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])


def _event_key(rows: DataFrame) -> DataFrame:
    return rows.withColumn("url", F.col("event_id").cast("string"))


_HALVES = ["day(crawled_ts) <= 15", "true"]  # the second run gets the first half again


@query("stream_restart", "SELECT event_id, event_type AS source, CASE WHEN day(ts) <= 15 THEN 0 ELSE 1 END AS run FROM events")
def stream_restart(spark, folder):
    """Two runs from one checkpoint: what the first has written, the state keeps the second from writing again."""
    base = fresh_path(spark, "restart")
    in_runs(_event_key(event_rows(spark, folder)), base, _HALVES, lambda s: transforms.dedup_exact(s, "60 days"), sinks.append_batch(f"{base}/out"))
    return spark.read.schema(_with_batch(EVENT)).parquet(f"{base}/out").select("event_id", "source", F.least("batch_id", F.lit(1)).cast("int").alias("run"))


@query("stream_state", "SELECT CAST(event_id AS VARCHAR) AS url FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 10 DAY")
def stream_state(spark, folder):
    """The keys that de-duplication still holds after two runs, read from the checkpoint as a table."""
    base = fresh_path(spark, "state")
    in_runs(_event_key(event_rows(spark, folder)), base, _HALVES, lambda s: transforms.dedup_exact(s, "10 days"), sinks.append_batch(f"{base}/out"))
    return recovery.state_rows(spark, f"{base}/checkpoint").select("key.url")


@query("stream_keep_newest", "SELECT CAST(user_id AS VARCHAR) AS url, max(ts) AS crawled_ts FROM events GROUP BY user_id")
def stream_keep_newest(spark, folder):
    """Newest row per url over three runs; a timer forgets urls a day after their newest row."""
    base = fresh_path(spark, "newest")
    increments = ["day(crawled_ts) <= 10", "day(crawled_ts) BETWEEN 11 AND 20", "day(crawled_ts) > 20"]
    in_runs(event_rows(spark, folder), base, increments, recovery.keep_newest, sinks.append_batch(f"{base}/out"), "update")
    out = spark.read.schema(_with_batch(EVENT)).parquet(f"{base}/out")
    return sinks.latest_by_key(out, ["url"]).select("url", "crawled_ts")


_LATE_SQL = """WITH m AS (SELECT max(ts) FILTER (event_id % 3 = 0) AS m0, max(ts) FILTER (event_id % 3 <= 1) AS m1 FROM events)
 SELECT event_id, event_id % 3 AS run, ts < CASE event_id % 3 WHEN 1 THEN m0 WHEN 2 THEN m1 END - INTERVAL 5 DAY IS TRUE AS late FROM events, m"""


@query("stream_late", _LATE_SQL)
def stream_late(spark, folder):
    """Rows more than five days behind the newest of earlier runs go to an output of their own, none is dropped."""
    base = fresh_path(spark, "late")
    write = recovery.split_late(sinks.append_batch(f"{base}/on_time"), sinks.append_batch(f"{base}/late"), f"{base}/marks", "5 days")
    in_runs(event_rows(spark, folder), base, [f"event_id % 3 = {i}" for i in range(3)], lambda s: s, write)
    parts = [spark.read.schema(_with_batch(EVENT)).parquet(f"{base}/{name}").withColumn("late", F.lit(name == "late")) for name in ("on_time", "late")]
    return parts[0].unionByName(parts[1]).select("event_id", F.col("batch_id").alias("run"), "late")


@query("stream_supervised", "SELECT name, 'stopped' AS state, count(*) AS rows FROM events, (VALUES ('by_day'), ('by_type')) v(name) GROUP BY name")
def stream_supervised(spark, folder):
    """Two queries with processing-time triggers under one listener, stopped when all is used up."""
    base = fresh_path(spark, "supervised")
    event_rows(spark, folder).write.parquet(f"{base}/in")

    def start(name: str):
        rows = readers.parquet_file_stream(spark, f"{base}/in", EVENT, max_files=1)
        return lambda: sinks.for_each_batch(rows, sinks.append_batch(f"{base}/{name}"), f"{base}/checkpoint-{name}", every="0 seconds")

    report = recovery.supervise(spark, {name: start(name) for name in ("by_day", "by_type")}, drained=True)
    return recovery.report_rows(spark, report).select("name", "state", "rows")


@query("stream_landed", "SELECT event_id, event_type AS source, 1::BIGINT AS times FROM events")
def stream_landed(spark, folder):
    """Landed JSON batches, two files at a time; used-up files move to an archive."""
    base = fresh_path(spark, "landed")
    rows = event_rows(spark, folder).select("event_id", "source", (F.col("event_id") % 2).alias("half"))
    for half in (0, 1):
        writers.write_json(rows.filter(F.col("half") == half).repartition(4).drop("half"), f"{base}/in/half={half}")
        stream = readers.json_file_stream(spark, f"{base}/in/*", T.StructType.fromDDL("event_id long, source string"), 2, archive=f"{base}/archive")
        sinks.for_each_batch(stream, sinks.append_batch(f"{base}/out"), f"{base}/checkpoint", every=None).awaitTermination()
    out = spark.read.schema("event_id long, source string, batch_id long").parquet(f"{base}/out")
    return out.groupBy("event_id", "source").agg(F.count("*").alias("times"))
