import json
import os

from pyspark.sql import functions as F

from jobmart import schemas
from jobmart.operators.dedup import drop_duplicate_urls
from jobmart.sources import readers
from jobmart.streaming import jobs, sinks, transforms


def message(url, at, **more):
    return {"url": url, "job_title": "Senior Dev", "company_location": "hcm", "salary": "15 - 20 tr",
            "job_description": "Python", "source": "s", "crawled_at": at, **more}


class Topic:
    """Landed micro-batches of messages, read as a stream of ``value`` bytes."""

    def __init__(self, spark, path):
        self.spark, self.path, self.files = spark, path, 0
        (path / "in").mkdir()

    def send(self, *messages):
        self.files += 1
        lines = [m if isinstance(m, str) else json.dumps(m) for m in messages]
        file = self.path / "in" / f"batch_{self.files}.txt"
        file.write_text("\n".join(lines) + "\n")
        # The file source takes files by time, and several may be written in the same instant.
        os.utime(file, (self.files, self.files))

    def stream(self):
        return self.spark.readStream.option("maxFilesPerTrigger", 1).text(f"{self.path}/in").select(
            F.col("value").cast("binary").alias("value")
        )

    def run(self, rows, mode="append", name="q"):
        query = sinks.for_each_batch(rows, sinks.append_batch(f"{self.path}/{name}"), f"{self.path}/c_{name}", mode, every=None)
        query.awaitTermination()
        return query

    def output(self, name="q"):
        return self.spark.read.option("basePath", f"{self.path}/{name}").parquet(f"{self.path}/{name}/batch_id=*")


def test_enriched_message_and_quarantine(spark, tmp_path):
    topic = Topic(spark, tmp_path)
    topic.send(message("u1", "2025-01-01T10:00:00"), "{broken")
    topic.run(jobs.adverts_from_messages(topic.stream()))
    row = topic.output().first()
    assert (row["location"], row["salary_min"], row["level"], row["skills"]) == ("TP.HCM", 15_000_000, "Senior", ["Python"])
    bad = readers.bad_messages(readers.decode_messages(topic.stream(), schemas.STREAM_MESSAGE))
    topic.run(bad, name="bad")
    assert [r["payload"] for r in topic.output("bad").collect()] == ["{broken"]


def test_exact_dedup_keeps_other_times_and_delay_dedup_does_not(spark, tmp_path):
    topic = Topic(spark, tmp_path)
    topic.send(message("u1", "2025-01-01T10:00:00"), message("u1", "2025-01-01T10:00:00"), message("u1", "2025-01-01T10:20:00"))
    topic.run(jobs.adverts_from_messages(topic.stream()), name="exact")
    topic.run(jobs.adverts_from_messages(topic.stream(), exact=False), name="delay")
    assert topic.output("exact").count() == 2
    assert topic.output("delay").count() == 1


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    topic = Topic(spark, tmp_path)
    topic.send(message("u1", "2025-01-01T10:00:00"))
    topic.send(message("u2", "2025-01-01T14:00:00"))
    topic.send(message("u3", "2025-01-01T09:00:00"))
    query = topic.run(jobs.adverts_from_messages(topic.stream()))
    assert sorted(r["url"] for r in topic.output().collect()) == ["u1", "u2"]
    assert jobs.rows_dropped_as_late(query) == 1


def test_restart_keeps_state_and_offsets(spark, tmp_path):
    topic = Topic(spark, tmp_path)
    topic.send(message("u1", "2025-01-01T10:00:00"))
    topic.run(jobs.adverts_from_messages(topic.stream()))
    topic.send(message("u1", "2025-01-01T10:00:00"), message("u2", "2025-01-01T10:01:00"))
    topic.run(jobs.adverts_from_messages(topic.stream()))
    assert sorted(r["url"] for r in topic.output().collect()) == ["u1", "u2"]


def test_sliding_counts_equal_the_batch_result(spark, tmp_path):
    topic = Topic(spark, tmp_path)
    sent = [message(f"u{i}", f"2025-01-01T10:{i * 7 % 60:02d}:00") for i in range(40)]
    topic.send(*sent[:20])
    topic.send(*sent[20:])
    rows = jobs.adverts_from_messages(topic.stream())
    topic.run(transforms.sliding_counts(rows), "update")
    streamed = sinks.latest_by_key(topic.output(), ["start_time", "end_time", "location"])
    raw = spark.createDataFrame([(json.dumps(m).encode(),) for m in sent], "value binary")
    batch = transforms.sliding_counts(transforms.enrich(readers.decode_messages(raw, schemas.STREAM_MESSAGE)))
    key = lambda df: sorted(map(tuple, df.select("start_time", "end_time", "location", "n_jobs").collect()))
    assert key(streamed) == key(batch)


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    write = sinks.append_batch(str(tmp_path / "log"))
    for rows in (3, 3, 5):
        write(spark.range(rows), 7)
    assert spark.read.parquet(str(tmp_path / "log")).count() == 5


def test_upsert_on_read(spark):
    log = spark.createDataFrame([("u", "old", 0), ("u", "new", 1), ("v", "x", 0)], "url string, t string, batch_id bigint")
    assert sorted(map(tuple, sinks.latest_by_key(log, ["url"]).collect())) == [("u", "new"), ("v", "x")]


def test_sinks_of_one_job(spark, tmp_path):
    topic = Topic(spark, tmp_path)
    topic.send(message("u1", "2025-01-01T10:00:00"), message("u2", "2025-01-01T10:05:00", company_location="Hà Nội"))
    started = jobs.start(
        jobs.adverts_from_messages(topic.stream()), f"{tmp_path}/check", lake=f"{tmp_path}/lake", console=True,
        counts=f"{tmp_path}/counts", every=None,
    )
    assert len(started) == 1  # one query feeds all sinks
    for query in started:
        query.awaitTermination()
    folders = {p.parent.name + "/" + p.name for p in (tmp_path / "lake").glob("batch_id=*/*/*") if p.is_dir()}
    assert folders == {"event_date=2025-01-01/city_label=TP.HCM", "event_date=2025-01-01/city_label=Hà Nội"}
    assert spark.read.parquet(f"{tmp_path}/lake").count() == 2
    assert spark.read.parquet(f"{tmp_path}/counts").agg(F.sum("n_jobs")).first()[0] == 6


def test_batch_layer_keeps_the_newest_row(spark):
    rows = spark.createDataFrame([("u", 1, "a"), ("u", 2, "b"), ("v", 1, "c")], "url string, crawled_ts int, t string")
    assert sorted(r["t"] for r in drop_duplicate_urls(rows, newest="crawled_ts").collect()) == ["b", "c"]


def test_json_file_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "batch_1.jsonl").write_text('{"url":"u"}\n')
    rows = readers.json_file_stream(spark, f"{tmp_path}/in", schemas.STREAM_MESSAGE, max_files=1).select("url")
    sinks.for_each_batch(rows, sinks.append_batch(f"{tmp_path}/out"), f"{tmp_path}/c", every=None).awaitTermination()
    assert [r["url"] for r in spark.read.parquet(f"{tmp_path}/out").collect()] == ["u"]
