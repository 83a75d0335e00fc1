"""Restart, late rows, newest per key, supervision and landed files."""

from datetime import datetime, timedelta
from pathlib import Path

from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobmart.plans.queries.stream_recovery import EVENT, in_runs
from jobmart.sources import readers
from jobmart.streaming import jobs, recovery, sinks, transforms

START = datetime(2024, 5, 1)


def rows(spark, *triples):
    """(url, hours after the start, id)"""
    return spark.createDataFrame([(u, "s", None if h is None else START + timedelta(hours=h), i) for u, h, i in triples], EVENT)


def land(spark, base, number, *triples):
    rows(spark, *triples).write.parquet(f"{base}/in/part-{number}")
    return readers.parquet_file_stream(spark, f"{base}/in/part-*", EVENT)


def back(spark, path):
    schema = T.StructType([*EVENT.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(schema).parquet(str(path))


def test_second_run_writes_only_what_is_new(spark, tmp_path):
    base = str(tmp_path)
    for i, triples in enumerate([[("a", 0, 1), ("b", 1, 2)], [("a", 0, 1), ("c", 2, 3)], [("c", 2, 3)]]):
        stream = transforms.dedup_exact(land(spark, base, i, *triples), "10 days")
        sinks.for_each_batch(stream, sinks.append_batch(f"{base}/out"), f"{base}/checkpoint", every=None).awaitTermination()
    got = back(spark, f"{base}/out").orderBy("event_id").collect()
    assert [r["event_id"] for r in got] == [1, 2, 3] and got[0]["batch_id"] == got[1]["batch_id"] < got[2]["batch_id"]
    held = {r[0] for r in recovery.state_rows(spark, f"{base}/checkpoint").select("key.url").collect()}
    assert held == {"a", "b", "c"}


def test_late_rows_are_kept_apart_and_a_replay_splits_alike(spark, tmp_path):
    base = str(tmp_path)
    write = recovery.split_late(sinks.append_batch(f"{base}/on_time"), sinks.append_batch(f"{base}/late"), f"{base}/marks", "2 hours")
    batches = [[("a", 0, 1), ("b", 10, 2)], [("c", 7, 3), ("d", 8, 4), ("e", None, 5)], [("f", 20, 6), ("g", 17, 7)], [("h", 17.9, 8), ("i", 18, 9)]]
    for i, triples in enumerate(batches):
        write(rows(spark, *triples), i)
    split = lambda: tuple({r["event_id"] for r in back(spark, f"{base}/{name}").collect()} for name in ("on_time", "late"))
    assert split() == ({1, 2, 4, 5, 6, 7, 9}, {3, 8})
    for i in (2, 1):  # replayed after later batches are there
        write(rows(spark, *batches[i]), i)
    assert split() == ({1, 2, 4, 5, 6, 7, 9}, {3, 8})


def test_newest_row_per_url(spark, tmp_path):
    base = str(tmp_path)
    runs = [[("a", 0, 1), ("a", 2, 2), ("b", 1, 3), (None, 1, 4)], [("a", 1.5, 5), ("b", 1, 6), ("b", 2, 7), ("z", None, 8)], [("a", 60, 9), ("c", 61, 10)], [("b", 90, 11), ("c", 60.5, 12)]]
    for i, triples in enumerate(runs):
        newest = recovery.keep_newest(land(spark, base, i, *triples))
        sinks.for_each_batch(newest, sinks.append_batch(f"{base}/out"), f"{base}/checkpoint", "update", every=None).awaitTermination()
    got = {r["url"]: r["event_id"] for r in sinks.latest_by_key(back(spark, f"{base}/out"), ["url"]).collect()}
    assert got == {"a": 9, "b": 11, "c": 10, None: 4}
    assert 5 not in {r["event_id"] for r in back(spark, f"{base}/out").collect()}


def test_the_others_end_when_a_query_fails(spark, tmp_path):
    base = str(tmp_path)
    stream = land(spark, base, 0, ("a", 0, 1), ("b", 1, 2))

    def broken(batch, batch_id):
        raise RuntimeError("sink is gone")

    starts = {
        "good": lambda: sinks.for_each_batch(stream, sinks.append_batch(f"{base}/good"), f"{base}/c1", every="1 second"),
        "bad": lambda: sinks.for_each_batch(stream, broken, f"{base}/c2", every="1 second"),
    }
    report = {r["name"]: r for r in recovery.supervise(spark, starts)}
    assert report["bad"]["state"] == "failed" and "sink is gone" in report["bad"]["error"]
    assert report["good"]["state"] == "stopped" and spark.streams.active == []
    assert spark.streams.active == []


def test_a_query_that_cannot_start_and_one_that_ends(spark, tmp_path):
    base = str(tmp_path)
    stream = land(spark, base, 0, ("a", 0, 1))

    def impossible():
        raise ValueError("no such sink")

    once = lambda: sinks.for_each_batch(stream, sinks.append_batch(f"{base}/x"), f"{base}/c", every=None)
    report = recovery.supervise(spark, {"once": once})
    assert [(r["state"], r["rows"], r["error"]) for r in report] == [("ended", 1, None)]
    report = recovery.supervise(spark, {"no": impossible, "never": once})
    assert [(r["name"], r["state"]) for r in report] == [("no", "failed"), ("never", "stopped")]
    assert [tuple(r)[:2] for r in recovery.report_rows(spark, report).collect()] == [("no", "failed"), ("never", "stopped")]


def test_adverts_under_supervision(spark, tmp_path):
    raw = spark.createDataFrame([(bytearray(b'{"url": "u1", "job_title": "Dev", "crawled_at": "2024-05-01T00:00:00.000000"}'),)], "value binary")
    raw.write.parquet(f"{tmp_path}/topic")
    stream = readers.parquet_file_stream(spark, f"{tmp_path}/topic", raw.schema)
    report = jobs.run_until_one_stops(spark, stream, f"{tmp_path}/c", lake=f"{tmp_path}/lake", console=False, every=None)
    assert [(r["name"], r["state"], r["rows"]) for r in report] == [("adverts", "ended", 1)]
    assert spark.read.parquet(f"{tmp_path}/lake").count() == 1


def test_landed_files_move_to_the_archive(spark, tmp_path):
    base, schema = str(tmp_path), T.StructType().add("event_id", "long")
    for half in (0, 1):
        spark.range(half * 100, half * 100 + 100).select(F.col("id").alias("event_id")).repartition(4).write.json(f"{base}/in/half={half}")
        stream = readers.json_file_stream(spark, f"{base}/in/*", schema, 2, archive=f"{base}/archive")
        sinks.for_each_batch(stream, sinks.append_batch(f"{base}/out"), f"{base}/checkpoint", every=None).awaitTermination()
    got = spark.read.parquet(f"{base}/out")
    assert sorted(r[0] for r in got.select("event_id").collect()) == list(range(200))
    assert got.select("batch_id").distinct().count() >= 4
    archived, left = (len(list(Path(base, d).rglob("part-*.json"))) for d in ("archive", "in"))
    assert archived >= 4 and archived + left == 8


def test_increments_of_queries_are_disjoint_or_repeat(spark, tmp_path):
    given = rows(spark, ("a", 0, 0), ("b", 1, 1))
    in_runs(given, str(tmp_path), ["event_id = 0", "event_id = 1"], lambda s: s, sinks.append_batch(f"{tmp_path}/out"))
    assert sorted((r["event_id"], r["batch_id"]) for r in back(spark, f"{tmp_path}/out").collect()) == [(0, 0), (1, 1)]
