import json

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from jobmart import cli, schemas
from jobmart.plans import jobs, models, warehouse
from jobmart.plans.queries import learning
from jobmart.sources import writers
from tests import page_samples

RAW_A = [
    {"url": "u1", "ten_cong_ty": "ACME", "tieu_de": "Senior Dev", "ngay_dang_tuyen": "03/11/2025", "luong": "N/A",
     "mo_ta_cong_viec": "Python", "dia_diem_lam_viec": {"thanh_pho": "HCM"}, "thong_tin_khac": {"lương": "15 Tr - 20 Tr VND"}},
    {"url": "u1", "ten_cong_ty": "ACME", "tieu_de": "Senior Dev", "ngay_dang_tuyen": "03/11/2025", "luong": "N/A",
     "mo_ta_cong_viec": "Python", "dia_diem_lam_viec": {"thanh_pho": "HCM"}, "thong_tin_khac": {"lương": "15 Tr - 20 Tr VND"}},
    {"url": "u2", "ten_cong_ty": "acme ", "tieu_de": "senior  dev", "ngay_dang_tuyen": "05/11/2025",
     "dia_diem_lam_viec": {"thanh_pho": "HCM"}},
    {"url": "u3", "ten_cong_ty": "ACME", "tieu_de": "Intern", "ngay_dang_tuyen": "N/A", "dia_diem_lam_viec": {"thanh_pho": "Huế"}},
]
RAW_D = [{"job_title": "Data Engineer", "company_name": "E", "salary": "1,000 - 2,000 USD", "company_location": "Ha Noi",
          "post_time": "2025-11-02", "skills_list": ["Spark"], "benefit": "a\nb", "company_detail": {"Country": "VN"}, "url": "d1"}]


def test_from_raw_files_to_the_star_schema(spark, tmp_path):
    for name, rows in (("a", RAW_A), ("d", RAW_D)):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in rows), encoding="utf-8")
    path = lambda name: f"{tmp_path}/{name}"
    counts = jobs.normalise_job(spark, {"a": path("a.jsonl"), "d": path("d.jsonl")}, path("canonical"))
    assert counts == {"n_rows": 4, "null_location_raw": 0, "null_title": 0, "null_posted_raw": 1}
    counts = jobs.clean_job(spark, path("canonical"), path("clean"))
    assert counts["n_rows"] == 2  # no posting date: dropped; same company, title and place: the newer one
    clean = spark.read.parquet(path("clean"))
    assert {(r["url"], r["city"], r["level"]) for r in clean.collect()} == {("u2", "TP.HCM", "Senior"), ("d1", "Khác", "Mid-level")}
    jobs.warehouse_job(spark, path("clean"), path("star"))
    fact = spark.read.parquet(path("star/fact_job_postings"))
    for name, key in (("dim_job", "job_id"), ("dim_company", "company_id"), ("dim_location", "location_id"), ("dim_date", "date_id")):
        dimension = spark.read.parquet(path(f"star/{name}"))
        assert dimension.select(key).distinct().count() == dimension.count()
        assert fact.join(dimension, key, "left_anti").count() == 0
    assert spark.read.parquet(path("star/dim_date")).count() == 4


def test_lake_rebuild(spark, tmp_path):
    rows = spark.createDataFrame([("u", 1), ("u", 2)], "url string, crawled_ts int")
    rows.write.parquet(f"{tmp_path}/lake")
    jobs.rebuild_job(spark, f"{tmp_path}/lake", f"{tmp_path}/out")
    row = spark.read.parquet(f"{tmp_path}/out").collect()
    assert len(row) == 1 and row[0]["crawled_ts"] == 2 and row[0]["batch_processed_at"] is not None


def test_new_days_are_merged(spark, tmp_path):
    old = spark.createDataFrame([("u", 1), ("v", 1), (None, 1)], "url string, crawled_ts int").withColumn("event_date", F.lit("2025-01-01").cast("date"))
    new = spark.createDataFrame([("u", 5), (None, 2)], "url string, crawled_ts int").withColumn("event_date", F.lit("2025-01-02").cast("date"))
    old.unionByName(new).write.partitionBy("event_date").parquet(f"{tmp_path}/lake")
    old.write.parquet(f"{tmp_path}/first")
    jobs.rebuild_job(spark, f"{tmp_path}/lake", f"{tmp_path}/second", before=f"{tmp_path}/first", since="2025-01-02")
    rows = spark.read.parquet(f"{tmp_path}/second").collect()
    assert sorted(((r["url"] or "", r["crawled_ts"]) for r in rows)) == [("", 1), ("", 2), ("u", 5), ("v", 1)]


def test_jobs_on_nothing(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text(json.dumps({"url": "x"}), encoding="utf-8")
    jobs.normalise_job(spark, {"a": f"{tmp_path}/a.jsonl"}, f"{tmp_path}/canonical")
    assert jobs.clean_job(spark, f"{tmp_path}/canonical", f"{tmp_path}/clean")["n_rows"] == 0


def test_surrogate_keys_tell_missing_from_empty(spark):
    df = spark.createDataFrame([(None, None), ("", None), (None, ""), ("", "")], "a string, b string")
    keys = [r[0] for r in df.select(warehouse.surrogate_key("a", "b")).collect()]
    assert keys[0] is None and len(set(keys)) == 4


def test_salary_model_beats_the_mean(spark, tmp_path):
    """Salaries follow level and city here; the given tables have random prices."""
    key = F.col("advert_id")
    level = F.when(key % 3 == 0, "Senior").otherwise("Junior")
    low = F.when(key % 3 == 0, 30_000_000).otherwise(10_000_000) + F.when(key % 2 == 0, 5_000_000).otherwise(0) + key % 7 * 100_000
    rows = models.training_rows(spark.range(1500).withColumnRenamed("id", "advert_id").select(
        "advert_id", F.lit("c").alias("company"), F.concat(level, F.lit(" Kỹ sư")).alias("title"), level.alias("level"),
        F.when(key % 2 == 0, "HN").when(key % 5 != 0, "HCM").alias("city"),
        F.when(key % 4 != 0, F.array(F.lit("BH"))).alias("benefits"),
        low.alias("salary_min"), (low + 2_000_000).alias("salary_max"),
    )).cache()
    train, held_out = models.hash_split(rows, F.col("advert_id"))
    assert train.count() + held_out.count() == rows.count()
    # The split depends on the key alone.
    assert models.hash_split(rows.repartition(9), F.col("advert_id"))[1].count() == held_out.count()
    model = models.salary_regression(trees=20).fit(train)
    writers.save_model(model, f"{tmp_path}/m")
    predictions = writers.load_model(f"{tmp_path}/m").transform(held_out)
    mean = train.agg(F.avg(models.LABEL)).first()[0]
    assert models.rmse(predictions) < models.rmse(held_out.withColumn("prediction", F.lit(mean)))
    report = models.salary_report(model, held_out)
    assert report.columns == ["company", "title", "address", "stated_salary", "predicted_salary"]
    assert report.filter(F.col("predicted_salary") % 10_000 != 0).count() == 0
    assert isinstance(model, PipelineModel)


def test_classifier_beats_the_majority(spark, folder):
    rows = learning.documents_by_language(spark, folder).cache()
    train, held_out = models.hash_split(rows, F.col("doc_id"), seed=1234)
    predictions = models.advert_classifier(learning.STOP_WORDS, reg=0.01).fit(train).transform(held_out)
    majority = held_out.groupBy("category").count().agg(F.max("count") / F.sum("count")).first()[0]
    assert models.accuracy(predictions) > majority


def test_stop_phrases(column):
    clean = lambda c: models.without_phrases(c, ["a b", "x", "c.d e"])
    assert column(clean, ["A b c", "xa b", "c.d e!", "x"]) == ["  c", "xa b", " !", "x"]


def test_extract_job(spark, tmp_path):
    rows = [("u1", page_samples.BOARD_D), ("u2", "<p>no title</p>"), ("u3", None)]
    spark.createDataFrame(rows, "url string, html string").write.parquet(f"{tmp_path}/pages")
    jobs.extract_job(spark, f"{tmp_path}/pages", "d", f"{tmp_path}/raw", f"{tmp_path}/bad")
    raw = spark.read.schema(schemas.BOARD_D).json(f"{tmp_path}/raw")
    assert [(r["url"], r["company_detail"]["Country"]) for r in raw.collect()] == [("u1", "VN")]
    assert [r["url"] for r in spark.read.parquet(f"{tmp_path}/bad").collect()] == ["u3"]


def test_train_and_predict_jobs(spark, folder, tmp_path):
    rows = learning.salary_rows(spark, folder).withColumn("url", F.col("advert_id").cast("string"))
    rows.drop(models.LABEL).write.parquet(f"{tmp_path}/clean")
    result = jobs.train_job(spark, f"{tmp_path}/clean", f"{tmp_path}/model")
    assert result["n_train"] > result["n_held_out"] > 0 and result["rmse"] > 0
    jobs.predict_job(spark, f"{tmp_path}/clean", f"{tmp_path}/model", f"{tmp_path}/report")
    assert spark.read.json(f"{tmp_path}/report").count() == result["n_train"] + result["n_held_out"]


def test_command_line(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text(json.dumps(RAW_A[0], ensure_ascii=False), encoding="utf-8")
    cli.main(["normalise", f"{tmp_path}/out", "--input", f"a={tmp_path}/a.jsonl"])
    assert spark.read.parquet(f"{tmp_path}/out").count() == 1
    assert cli.parser().parse_args(["clean", "s", "o", "--jdbc-url", "jdbc:x"]).jdbc_table == "recruitment_fact"
