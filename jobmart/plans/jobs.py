"""Job entry points: read, transform, write.  Quality counts ride along with the write."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart import schemas
from jobmart.operators import dedup, merge, pages, quality, shape
from jobmart.plans import adverts, models, warehouse
from jobmart.scratch import materialise
from jobmart.sources import readers, writers


def normalise_job(spark: SparkSession, inputs: Mapping[str, str], output: str, multi_line: bool = False) -> dict:
    """Raw JSON of several boards → canonical adverts as Parquet; returns row and NULL counts."""
    boards = shape.union_sources(
        adverts.normalise(readers.read_json(spark, path, schemas.BOARDS[board], multi_line), board)
        for board, path in inputs.items()
    )
    keyed = dedup.with_row_key(boards)
    unique = dedup.drop_duplicate_keys(keyed, [dedup.content_hash(keyed).asc()]).drop("row_key")
    rows, seen = quality.observe(unique, "normalise")
    writers.write_parquet(rows, output)
    return quality.counts(seen)


def clean_job(
    spark: SparkSession, source: str, output: str, deduplicate: bool = True, jdbc: Mapping[str, str] | None = None
) -> dict:
    """Canonical adverts → cleaned Parquet, and a warehouse table when JDBC options are given."""
    rows, seen = quality.observe(adverts.clean(spark.read.parquet(source), deduplicate), "clean")
    writers.write_partitioned(rows, output)
    if jdbc:
        # CSV-like targets have no arrays; the written files are re-read, so the plan runs once.
        written = spark.read.parquet(output)
        flat = written.withColumns({c: F.array_join(c, ", ") for c in ("skills", "benefits")})
        writers.append_jdbc(flat, jdbc)
    return quality.counts(seen)


def warehouse_job(spark: SparkSession, source: str, output: str, companies: DataFrame | None = None) -> None:
    rows = spark.read.parquet(source)
    firms = companies if companies is not None else rows.select(
        "company", F.lit(None).cast("string").alias("company_size"),
        F.lit(None).cast("string").alias("company_industry"),
    )
    tables = {
        "dim_job": warehouse.dim_job(rows),
        "dim_company": warehouse.dim_company(firms),
        "dim_location": warehouse.dim_location(rows),
        "dim_date": warehouse.dim_date(rows),
        "fact_job_postings": warehouse.fact_job_postings(rows),
    }
    for name, table in tables.items():
        writers.write_parquet(table, f"{output}/{name}")


def extract_job(spark: SparkSession, stored: str, board: str, output: str, quarantine: str) -> None:
    """Stored pages → raw records of one board as JSON; unreadable pages go to ``quarantine``.

    Board "c" stores list and detail pages together: its cards get the details of their own page.
    """
    # Written once, so pages are parsed once for the two outputs.
    parsed = materialise(pages.with_nodes(spark.read.parquet(stored)))
    if board == "c":
        records = pages.board_c(pages.board_c_list(parsed), pages.board_c_detail(parsed))
    else:
        extract = {"a": pages.board_a, "b": pages.board_b, "d": pages.board_d}[board]
        records = pages.titled(extract(parsed), "job_title" if board == "d" else "tieu_de")
    writers.write_json(records, output)
    writers.write_parquet(pages.quarantined(parsed), quarantine)


def train_job(spark: SparkSession, clean: str, model_path: str) -> dict:
    """Cleaned adverts → salary model; returns row counts and the error on held-out rows."""
    rows = materialise(models.training_rows(spark.read.parquet(clean)))
    train, held_out = models.hash_split(rows, F.col("url"))
    model = models.salary_regression().fit(train)
    writers.save_model(model, model_path)
    return {"n_train": train.count(), "n_held_out": held_out.count(), "rmse": models.rmse(model.transform(held_out))}


def predict_job(spark: SparkSession, clean: str, model_path: str, output: str) -> None:
    """Stated against predicted salaries as JSON."""
    rows = models.training_rows(spark.read.parquet(clean))
    writers.write_json(models.salary_report(writers.load_model(model_path), rows), output)


def merge_newest(rows: DataFrame, before: DataFrame | None = None, newest: str = "crawled_ts") -> DataFrame:
    """Newest row per url of ``rows`` and an earlier result."""
    if before is not None:
        rows = rows.unionByName(before, allowMissingColumns=True)
    return dedup.drop_duplicate_urls(rows, newest=newest)


def rebuild_job(
    spark: SparkSession, lake: str, output: str, newest: str = "crawled_ts", before: str | None = None, since: str | None = None,
) -> None:
    """Batch layer: newest row per url, stamped with the processing time.

    Without ``before`` the whole lake history is read.  With it (the output of an earlier run, in another
    folder) only lake folders from the day ``since`` on are read and merged into that result.
    """
    rows, earlier = spark.read.parquet(lake), None
    if before is not None:
        earlier = spark.read.parquet(before).drop("batch_processed_at")
        rows = rows.filter(F.col("event_date") >= F.lit(since).cast("date")) if since else rows
    rows = merge_newest(rows, earlier, newest)
    writers.write_parquet(rows.withColumn("batch_processed_at", F.current_timestamp()), output)


def merge_job(
    spark: SparkSession, lake: str, output: str, newest: str = "crawled_ts", since: str | None = None, buckets: int = merge.BUCKETS,
) -> list[int]:
    """Batch layer in increments: lake folders from the day ``since`` on, merged into a table kept in buckets of the url.

    Unlike ``rebuild_job`` it does not rewrite the history: only buckets with new or newer urls are, and they are returned.
    """
    rows = spark.read.parquet(lake)
    rows = rows.filter(F.col("event_date") >= F.lit(since).cast("date")) if since else rows
    return merge.merge_newest(spark, rows.withColumn("batch_processed_at", F.current_timestamp()), output, newest=newest, buckets=buckets)
