"""Stream queries: the events table read as a file stream until it is used up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobmart import rules, schemas
from jobmart.operators import dedup, merge
from jobmart.plans import jobs as plan_jobs
from jobmart.plans.queries.base import PHRASES, PLACES, TITLES, pick, query, sql_labels, sql_pick, table
from jobmart.scratch import fresh_path
from jobmart.sources import readers
from jobmart.streaming import jobs, sinks, transforms


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The table is one file or a folder of files; only a pattern lets the file source take both."""
    schema = table(spark, folder, "events").schema
    return readers.parquet_file_stream(spark, f"{folder}/events.parque[t]", schema)


def messages(events: DataFrame) -> DataFrame:
    """Events as JSON message bytes, the way a topic would deliver adverts."""
    key = F.col("event_id")
    pay = F.concat((key % 40 + 1).cast("string"), F.lit(" - "), (key % 40 + 9).cast("string"), F.lit(" tr"))
    fields = {
        "url": F.concat(F.lit("https://jobs.example.com/"), key.cast("string")),
        "job_title": pick(TITLES, key),
        "company_name": F.col("event_type"),
        "salary": pay,
        "company_location": pick(PLACES, key),
        "job_description": pick(PHRASES, key),
        "job_requirements": F.lit(None).cast("string"),
        "post_time": F.date_format("ts", "dd/MM/yyyy"),
        "source": F.col("event_type"),
        "crawled_at": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
    }
    body = F.to_json(F.struct(*[v.alias(n) for n, v in fields.items()]))
    return events.select(body.cast("binary").alias("value"))


def _run(rows: DataFrame, mode: str = "append") -> DataFrame:
    """Write the stream batch by batch and read everything back, with the batch number."""
    spark = rows.sparkSession
    base = fresh_path(spark, "stream")
    run = sinks.for_each_batch(rows, sinks.append_batch(f"{base}/out"), f"{base}/checkpoint", mode, every=None)
    run.awaitTermination()
    schema = rows.schema.add("batch_id", T.LongType())
    return spark.read.schema(schema).parquet(f"{base}/out")


def twice(events: DataFrame, minutes: int = 0) -> DataFrame:
    """Every event two times, the second one ``minutes`` later."""
    return events.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn(
        "ts", F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("copy") * minutes)
    )


@query("stream_dedup", "SELECT 'https://jobs.example.com/' || event_id AS url, event_type AS source FROM events")
def stream_dedup(spark, folder):
    """One row per url and event time."""
    rows = jobs.adverts_from_messages(messages(twice(event_stream(spark, folder))))
    return _run(rows.select("url", "source"))[["url", "source"]]


@query("stream_dedup_within_watermark", "SELECT 'https://jobs.example.com/' || event_id AS url FROM events")
def stream_dedup_within_watermark(spark, folder):
    """One row per url although its copies carry different event times."""
    rows = jobs.adverts_from_messages(messages(twice(event_stream(spark, folder), 5)), exact=False)
    return _run(rows.select("url"))[["url"]]


@query(
    "stream_sliding_count",
    """SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS start_time, strftime(w + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S') AS end_time, location, count(*) AS n_jobs
 FROM (SELECT event_type AS location, unnest([time_bucket(INTERVAL 10 MINUTE, ts), time_bucket(INTERVAL 10 MINUTE, ts) - INTERVAL 10 MINUTE,
  time_bucket(INTERVAL 10 MINUTE, ts) - INTERVAL 20 MINUTE]) AS w FROM events) GROUP BY 1, 2, 3""",
)
def stream_sliding_count(spark, folder):
    """Counts per 30-minute window every 10 minutes; the last update of each window counts."""
    events = event_stream(spark, folder).select(
        F.col("event_id").alias("url"), F.col("event_type").alias("location"),
        F.col("ts").cast("timestamp").alias(transforms.EVENT_TIME),
    )
    counts = transforms.sliding_counts(transforms.dedup_exact(events))
    final = sinks.latest_by_key(_run(counts, "update"), ["start_time", "end_time", "location"])
    shown = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return final.select(shown("start_time"), shown("end_time"), "location", "n_jobs")


def _title_case(c: str) -> str:
    return (
        rf"array_to_string(list_transform(regexp_extract_all(lower({c}), '\p{{L}}+|[^\p{{L}}]+'), "
        "lambda w: upper(left(w, 1)) || substr(w, 2)), '')"
    )


_ENRICHED_SQL = f"""WITH t AS (SELECT event_id, {sql_pick(TITLES, 'event_id')} AS title, {sql_pick(PLACES, 'event_id')} AS place FROM events)
 SELECT 'https://jobs.example.com/' || event_id AS url, CASE WHEN place = '' THEN 'Khác' ELSE
  {sql_labels('lower(place)', rules.CITIES_STREAM, _title_case('place'))} END AS location,
  (event_id % 40 + 1) * 1000000 AS salary_min, (event_id % 40 + 9) * 1000000 AS salary_max,
  {sql_labels('lower(title)', rules.LEVELS_STREAM, "'Mid-level'")} AS level FROM t"""


@query("stream_enrich", _ENRICHED_SQL)
def stream_enrich(spark, folder):
    rows = jobs.adverts_from_messages(messages(event_stream(spark, folder)))
    columns = ["url", "location", "salary_min", "salary_max", "level"]
    return _run(rows.select(*columns)).select(*columns)


@query("enrich_messages", _ENRICHED_SQL)
def enrich_messages(spark, folder):
    """The stream's decode and enrich steps on the same data as a batch."""
    decoded = readers.decode_messages(messages(table(spark, folder, "events")), schemas.STREAM_MESSAGE)
    rows = transforms.enrich(readers.good_messages(decoded))
    return rows.select("url", "location", "salary_min", "salary_max", "level")


@query(
    "enrich_listed_messages",
    """SELECT event_id AS url, event_type AS working_model, (event_id % 40 + 1) * 1000000 AS salary_min,
 strftime(ts, '%Y-%m-%d %H:%M:%S') AS crawled, strftime(ts, '%Y-%m-%d') AS posted FROM events""",
)
def enrich_listed_messages(spark, folder):
    """Messages that use the other spelling of two fields."""
    key = F.col("event_id")
    raw = table(spark, folder, "events").select(F.to_json(F.struct(
        key.alias("url"), F.col("event_type").alias("woring_model"),
        F.concat((key % 40 + 1).cast("string"), F.lit(" tr")).alias("salary"),
        F.date_format("ts", "dd/MM/yy").alias("post_time"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("crawled_at"),
    )).cast("binary").alias("value"))
    decoded = readers.good_messages(readers.decode_messages(raw, schemas.STREAM_MESSAGE_SKILLS))
    rows = transforms.enrich_listed(decoded)
    return rows.select(
        F.col("url").cast("bigint").alias("url"), "working_model", "salary_min",
        F.date_format("crawled_ts", "yyyy-MM-dd HH:mm:ss").alias("crawled"),
        F.date_format("post_ts", "yyyy-MM-dd").alias("posted"),
    )


@query(
    "bad_messages",
    "SELECT '{\"event_id\": ' || event_id AS payload FROM events WHERE event_id % 7 = 0",
)
def bad_messages(spark, folder):
    """Messages that are not complete JSON go to the quarantine output, as they came."""
    text = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"))).otherwise(
        F.to_json(F.struct(F.col("event_type").alias("source")))
    )
    raw = table(spark, folder, "events").select(text.cast("binary").alias("value"))
    return readers.bad_messages(readers.decode_messages(raw, schemas.STREAM_MESSAGE))


@query(
    "stream_multi_sink",
    """SELECT sink, count(*) AS n_rows, CAST(sum(event_id) AS BIGINT) AS id_sum FROM events, (VALUES ('lake'), ('index')) v(sink) GROUP BY 1""",
)
def stream_multi_sink(spark, folder):
    """One query writes each batch to a lake by day and city and to a keyed log."""
    base = fresh_path(spark, "fanout")
    rows = jobs.adverts_from_messages(messages(event_stream(spark, folder))).select("url", "location", transforms.EVENT_TIME)
    write = sinks.fan_out(sinks.lake_batch(f"{base}/lake"), sinks.append_batch(f"{base}/index"))
    sinks.for_each_batch(rows, write, f"{base}/checkpoint", every=None).awaitTermination()
    schema = rows.schema.add("batch_id", T.LongType()).add("event_date", T.DateType()).add("city_label", T.StringType())
    parts = [
        spark.read.schema(schema).parquet(f"{base}/{sink}").select(F.lit(sink).alias("sink"), "url")
        for sink in ("lake", "index")
    ]
    key = F.substring_index("url", "/", -1).cast("bigint")
    return parts[0].unionByName(parts[1]).groupBy("sink").agg(
        F.count("*").alias("n_rows"), F.sum(key).alias("id_sum")
    )


@query(
    "stream_lake",
    f"""WITH t AS (SELECT event_id, {sql_pick(PLACES, 'event_id')} AS place FROM events)
 SELECT CASE WHEN place = '' THEN 'Khác' ELSE {sql_labels('lower(place)', rules.CITIES_STREAM, _title_case('place'))} END AS location,
  count(*) AS n_rows FROM t GROUP BY 1""",
)
def stream_lake(spark, folder):
    """Parquet lake by day and city label, written by the file sink."""
    base = fresh_path(spark, "lake")
    rows = jobs.adverts_from_messages(messages(event_stream(spark, folder)))
    sinks.to_lake(rows, f"{base}/lake", f"{base}/checkpoint", every=None).awaitTermination()
    schema = rows.schema.add("event_date", T.DateType()).add("city_label", T.StringType())
    return spark.read.schema(schema).parquet(f"{base}/lake").groupBy("location").agg(F.count("*").alias("n_rows"))


@query(
    "lake_rebuild_merge",
    "SELECT user_id AS url, max(event_id) AS event_id FROM events GROUP BY 1",
)
def lake_rebuild_merge(spark, folder):
    """Newer days merged into the result of the earlier ones."""
    rows = table(spark, folder, "events").select(F.col("user_id").alias("url"), "event_id", F.to_date("ts").alias("day"))
    early, late = (rows.filter(test).drop("day") for test in (F.dayofmonth("day") <= 15, F.dayofmonth("day") > 15))
    return plan_jobs.merge_newest(late, plan_jobs.merge_newest(early, newest="event_id"), newest="event_id")


@query(
    "lake_rebuild",
    "SELECT user_id AS url, max(event_id) AS event_id FROM events GROUP BY 1",
)
def lake_rebuild(spark, folder):
    """Batch layer: newest row per key over the whole history."""
    rows = table(spark, folder, "events").select(F.col("user_id").alias("url"), "event_id")
    return dedup.drop_duplicate_urls(rows, newest="event_id")


# Three increments: the history, all newer days of some users, and one user only.
_INCREMENTS = ("day <= 15", "day > 15 AND user_id % 3 = 0", "user_id = 7")


@query(
    "lake_merge_buckets",
    "SELECT user_id AS url, max(event_id) AS event_id FROM (SELECT *, day(ts) AS day FROM events) WHERE " + " OR ".join(_INCREMENTS).replace("day > 15 AND user_id % 3 = 0", "(day > 15 AND user_id % 3 = 0)") + " GROUP BY 1",
)
def lake_merge_buckets(spark, folder):
    """Increments merged into a table kept in buckets of the key; a bucket without news is neither read whole nor written."""
    path = fresh_path(spark, "buckets")
    rows = table(spark, folder, "events").withColumn("day", F.dayofmonth("ts"))
    for test in _INCREMENTS:
        new = rows.filter(test).select(F.col("user_id").alias("url"), "event_id")
        merge.merge_newest(spark, new, path, newest="event_id", buckets=16)
    return merge.read_buckets(spark, path, 16).select("url", "event_id")
