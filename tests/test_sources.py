import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from jobmart import schemas, scratch, session
from jobmart.sources import readers, writers


@pytest.fixture
def folder_of(tmp_path):
    def write(**files):
        for name, text in files.items():
            path = tmp_path / name.replace("__", "/")
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text(text, encoding="utf-8")
        return str(tmp_path)

    return write


def test_json_lines_with_and_without_schema(spark, folder_of):
    path = folder_of(a='{"url":"u1","tieu_de":"t"}\n{"url":"u2","thong_tin_khac":{"lương":"5 tr"}}\n')
    typed = readers.read_json(spark, path, schemas.BOARD_A)
    assert typed.schema == schemas.BOARD_A
    assert typed.filter("url = 'u2'").first()["thong_tin_khac"] == {"lương": "5 tr"}
    assert set(readers.read_json(spark, path).columns) == {"url", "tieu_de", "thong_tin_khac"}


def test_corrupt_lines_are_kept(spark, folder_of):
    path = folder_of(a='{"url":"u1"}\n{"url": oops\n')
    rows = readers.read_json(spark, path, schemas.STREAM_MESSAGE, keep_corrupt=True).cache()
    assert [r[readers.CORRUPT] for r in rows.filter(F.col(readers.CORRUPT).isNotNull()).collect()] == ['{"url": oops']


def test_multi_line_and_recursive_json(spark, folder_of):
    path = folder_of(x__one=json.dumps([{"url": "u1"}, {"url": "u2"}], indent=1), y__z__two=json.dumps([{"url": "u3"}]))
    rows = readers.read_json(spark, path, schemas.BOARD_C, multi_line=True, recursive=True)
    assert sorted(r["url"] for r in rows.collect()) == ["u1", "u2", "u3"]


def test_word_lists_are_joined(spark, folder_of):
    base = folder_of(vi=" và \n\ncủa\n", en="the\nvà\n")
    words = readers.read_word_list(spark, f"{base}/vi", f"{base}/en")
    assert sorted(r["word"] for r in words.collect()) == ["của", "the", "và"]


def test_imported_data_set_is_typed(spark, tmp_path):
    path = str(tmp_path / "roles.parquet")
    spark.createDataFrame([("DE", ["AWS"])], "`Job Title` string, certificates array<string>").write.parquet(path)
    roles = readers.import_dataset(spark, path, schemas.ROLE, {"Job Title": "job_title"})
    assert roles.schema == schemas.ROLE
    assert tuple(roles.first()) == ("DE", None, ["AWS"])


def test_parquet_with_merged_schemas(spark, tmp_path):
    spark.range(1).write.parquet(f"{tmp_path}/t/p=1")
    spark.range(1).withColumn("extra", F.lit("x")).write.parquet(f"{tmp_path}/t/p=2")
    assert set(readers.read_parquet(spark, f"{tmp_path}/t", merge_schema=True).columns) == {"id", "extra", "p"}


def test_decoded_messages(spark):
    rows = spark.createDataFrame([(b'{"url":"u","salary":"5 tr"}',), (b"not json",), (None,)], "value binary")
    decoded = readers.decode_messages(rows, schemas.STREAM_MESSAGE)
    assert [r["url"] for r in readers.good_messages(decoded).collect()] == ["u", None]
    assert [r["payload"] for r in readers.bad_messages(decoded).collect()] == ["not json"]


def test_bronze_layout(spark, tmp_path):
    df = spark.createDataFrame([("u", "a", "2025-01-02 03:04:05"), ("v", None, "2025-11-12 00:00:00")], "url string, source string, t string")
    df = df.select("url", "source", F.to_timestamp("t").alias("crawled_ts"))
    for _ in range(2):
        writers.land_bronze(df, str(tmp_path))
    assert (tmp_path / "source=a/y=2025/m=01/d=02").is_dir()
    assert (tmp_path / "source=unknown/y=2025/m=11/d=12").is_dir()
    assert spark.read.json(str(tmp_path)).count() == 4


def test_csv_text(spark, tmp_path):
    one_row = spark.createDataFrame([("Hà, Nội", ["a", "b"])], "c string, s array<string>").coalesce(1)
    writers.write_csv(one_row, str(tmp_path / "c"))
    text = next(Path(tmp_path / "c").glob("*.csv")).read_text(encoding="utf-8")
    assert text == 'c,s\n"Hà, Nội",a; b\n'


def test_partitioned_write_rebalances(spark, tmp_path):
    df = spark.range(1000).select(
        "id", F.when(F.col("id") % 3 == 0, "HN").otherwise("HCM").alias("city"), F.lit("2025-01-01").cast("date").alias("posted_date")
    ).repartition(20)
    writers.write_partitioned(df, str(tmp_path / "p"))
    files = list((tmp_path / "p").glob("city=HN/posted_date=2025-01-01/*.parquet"))
    assert len(files) == 1
    assert spark.read.parquet(str(tmp_path / "p")).count() == 1000


def test_connector_options(monkeypatch):
    monkeypatch.setenv("JOBMART_JDBC_USER", "writer")
    monkeypatch.delenv("JOBMART_JDBC_PASSWORD", raising=False)
    jdbc = writers.jdbc_options("jdbc:postgresql://db/w", "recruitment_fact", "org.postgresql.Driver", connections=8)
    assert jdbc == {
        "url": "jdbc:postgresql://db/w", "dbtable": "recruitment_fact", "batchsize": "10000",
        "driver": "org.postgresql.Driver", "numPartitions": "8", "user": "writer",
    }
    assert writers.search_options("jobs", "node")["es.mapping.id"] == "url"
    assert writers.kafka_sink_options("b:9092", "it-jobs")["kafka.acks"] == "all"
    assert readers.kafka_options("b:9092", "it-jobs") == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "it-jobs", "startingOffsets": "latest",
    }


def test_storage_settings():
    assert "spark.hadoop.fs.s3a.endpoint" in session.object_store_conf("http://store:9000")
    assert not any("key" in k for k in session.object_store_conf("http://store:9000"))
    assert session.hdfs_conf("hdfs://n:8020")["spark.hadoop.fs.defaultFS"] == "hdfs://n:8020"


def test_scratch_folder_comes_from_the_session(spark):
    assert scratch.fresh_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch.fresh_path(spark, "x") != scratch.fresh_path(spark, "x")


def test_materialised_and_persisted(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    stored = scratch.materialise(df)
    assert stored.dtypes == df.dtypes and stored.count() == 10
    assert "parquet" in stored._jdf.queryExecution().executedPlan().toString()
    with scratch.persisted(df) as cached:
        assert cached.is_cached and cached.count() == 10
    assert not cached.is_cached


def test_scratch_tables_go_to_shared_folders_only():
    class Session:
        def __init__(self, **conf):
            self.conf = conf | {"spark.sql.warehouse.dir": "file:/shared/warehouse/"}

    assert scratch.shared_dir(Session(**{"spark.checkpoint.dir": "hdfs:///x/"})) == "hdfs:///x"
    assert scratch.shared_dir(Session()) == "file:/shared/warehouse/_scratch"
