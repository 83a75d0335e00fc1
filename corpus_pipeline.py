"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart.llm import decontaminate, mixing, ngram_join, sharding, toxicity
from jobmart.llm.common import remainder
from jobmart.llm.queries import SHARDS, qualities
from jobmart.llm.registry import table
from jobmart.scratch import fresh_path


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half; labels of held-out documents are not used."""
    labels = table(spark, sf_dir, "labels").filter(remainder(F.col("doc_id"), 5) != 0)
    return toxicity.reject(docs, toxicity.train(docs.select("doc_id", "text"), labels))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a similarity of 0.8."""
    return ngram_join.keep_one(docs, shingle=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is in windows of the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by source weights: every document as often as it is taken."""
    return mixing.mixed(docs, qualities(spark, sf_dir))


def place(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard."""
    return sharding.assign_shards(docs, sharding.shard_names(SHARDS))


STAGES = [
    ("toxicity", reject_toxic),
    ("ngram_join", keep_one_of_near_copies),
    ("decontaminate", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", place),
]

#: A trained score has no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
