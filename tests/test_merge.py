"""Keyed merge into a bucketed table."""

import os
import random

import pytest

from jobmart.operators import merge


def files(path):
    return {(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def rows_of(spark, path, buckets=8):
    return sorted(tuple(r) for r in merge.read_buckets(spark, path, buckets).select("url", "crawled_ts", "title").collect())


def test_merges_against_a_dictionary(spark, tmp_path):
    rng, path, held = random.Random(1), str(tmp_path / "t"), {}
    for step in range(4):
        rows = [(f"u{rng.randrange(60)}", rng.randrange(40), f"s{step}") for _ in range(30)]
        merge.merge_newest(spark, spark.createDataFrame(rows, "url string, crawled_ts int, title string").repartition(3), path, buckets=8)
        for url in {r[0] for r in rows}:
            version = max(r[1] for r in rows if r[0] == url)
            held[url] = max(held.get(url, -1), version)
        got = rows_of(spark, path)
        assert {r[0]: r[1] for r in got} == held and len(got) == len(held)


def test_only_buckets_with_news_are_rewritten(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "url string, crawled_ts int, title string"
    first = [(f"u{i}", 5, "old") for i in range(80)] + [(None, 1, "nameless"), (None, 1, "nameless")]
    made = merge.merge_newest(spark, spark.createDataFrame(first, schema), path, buckets=8)
    assert made == list(range(8))
    before = files(path)
    changed = merge.merge_newest(spark, spark.createDataFrame([("u3", 6, "new"), ("u4", 4, "older"), (None, 1, "nameless")], schema), path, buckets=8)
    after = files(path)
    moved = {d.rpartition("=")[2] for d, f in before.keys() ^ after.keys()}
    assert len(changed) <= 2 and moved == set(map(str, changed))
    got = {r["url"]: (r["crawled_ts"], r["title"]) for r in merge.read_buckets(spark, path, 8).collect()}
    assert got["u3"] == (6, "new") and got["u4"] == (5, "old") and got[None] == (1, "nameless") and len(got) == 81
    assert merge.merge_newest(spark, spark.createDataFrame([("u3", 6, "again")], schema), path, buckets=8) == []
    assert merge.merge_newest(spark, spark.createDataFrame([], schema), path, buckets=8) == []
    assert files(path) == after


def test_another_number_of_buckets_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1, "x")], "url string, crawled_ts int, title string")
    merge.merge_newest(spark, rows, path, buckets=4)
    with pytest.raises(ValueError):
        merge.merge_newest(spark, rows, path, buckets=8)


def test_new_columns_are_added(spark, tmp_path):
    path = str(tmp_path / "t")
    merge.merge_newest(spark, spark.createDataFrame([(f"u{i}", 1) for i in range(20)], "url string, crawled_ts int"), path, buckets=8)
    assert len(merge.merge_newest(spark, spark.createDataFrame([("u3", 2, "x")], "url string, crawled_ts int, title string"), path, buckets=8)) == 1
    assert rows_of(spark, path) == sorted([("u3", 2, "x"), *[(f"u{i}", 1, None) for i in range(20) if i != 3]])
