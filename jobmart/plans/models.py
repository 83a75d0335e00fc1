"""Salary regression and advert classification with MLlib."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import (
    IDF, CountVectorizer, HashingTF, OneHotEncoder, RegexTokenizer, StopWordsRemover,
    StringIndexer, Tokenizer, VectorAssembler,
)
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmart.functions.items import round_to_ten_thousand
from jobmart.functions.text import alternation
from jobmart.operators import shape

LABEL = "salary_label"


def training_rows(adverts: DataFrame) -> DataFrame:
    """Adverts with a positive salary range and a title, gaps in the features filled."""
    rows = shape.with_salary_label(adverts.filter(F.col("title").isNotNull()), label=LABEL)
    rows = rows.fillna({"city": "Unknown", "level": "Unknown", "title": ""})
    return shape.with_empty_arrays(rows, ["benefits"])


def hash_split(df: DataFrame, key: Column, train_share: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Split by a digest of the key: the same rows whatever the number of partitions."""
    digest = F.md5(F.concat(F.lit(f"{seed}-"), F.coalesce(key.cast("string"), F.lit(""))))
    part = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 10_000
    limit = F.lit(int(train_share * 10_000))
    return df.filter(part < limit), df.filter(part >= limit)


def salary_regression(
    trees: int = 50, seed: int = 42, title_words: int = 1000, benefit_items: int = 500, min_rows: float = 2.0,
) -> Pipeline:
    """City, level, title words and benefits → random forest.

    Titles are split at characters that are not letters or digits of any script.  The vocabularies hold the
    ``title_words`` and ``benefit_items`` most frequent terms of at least ``min_rows`` rows (or that share of
    the rows, below 1): they set the width of the feature vector, so raise them with the data.
    """
    return Pipeline(stages=[
        label_index("city"),
        label_index("level"),
        OneHotEncoder(inputCols=["city_index", "level_index"], outputCols=["city_vector", "level_vector"]),
        title_tokenizer(),
        term_counts("title_words", title_words, min_rows),
        term_counts("benefits", benefit_items, min_rows),
        VectorAssembler(
            inputCols=["city_vector", "level_vector", "title_words_vector", "benefits_vector"], outputCol="features"
        ),
        RandomForestRegressor(featuresCol="features", labelCol=LABEL, numTrees=trees, seed=seed),
    ])


def label_index(column: str) -> StringIndexer:
    """Labels numbered by falling frequency, ties by the label."""
    return StringIndexer(inputCol=column, outputCol=f"{column}_index", handleInvalid="keep")


def title_tokenizer() -> RegexTokenizer:
    return RegexTokenizer(inputCol="title", outputCol="title_words", pattern=r"(?U)\W")


def term_counts(column: str, terms: int, min_rows: float) -> CountVectorizer:
    return CountVectorizer(inputCol=column, outputCol=f"{column}_vector", vocabSize=terms, minDF=min_rows)


def rmse(predictions: DataFrame, label: str = LABEL) -> float:
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse").evaluate(predictions)


def salary_report(model: PipelineModel, adverts: DataFrame) -> DataFrame:
    """Stated against predicted salary, predictions rounded to 10,000 VND."""
    return model.transform(adverts).select(
        "company", "title", F.col("city").alias("address"),
        F.col(LABEL).alias("stated_salary"),
        round_to_ten_thousand(F.col("prediction")).alias("predicted_salary"),
    )


def without_phrases(c: Column, stop_words: Sequence[str]) -> Column:
    """Remove stop phrases of several words, which a per-token remover can never match."""
    phrases = sorted({w.lower() for w in stop_words if " " in w}, key=lambda w: (-len(w), w))
    lowered = F.lower(c)
    if not phrases:
        return lowered
    pattern = rf"(?<![\p{{L}}\p{{N}}])(?:{alternation(phrases)})(?![\p{{L}}\p{{N}}])"
    return F.regexp_replace(lowered, pattern, " ")


def stop_word_remover(stop_words: Sequence[str]) -> StopWordsRemover:
    remover = StopWordsRemover(inputCol="words", outputCol="filtered")
    return remover.setStopWords([w for w in stop_words if " " not in w])


def advert_classifier(
    stop_words: Sequence[str], features: int = 10_000, max_iter: int = 10, reg: float = 0.3, elastic: float = 0.8,
) -> Pipeline:
    """Words without stop words → TF-IDF → logistic regression on ``category``."""
    return Pipeline(stages=[
        Tokenizer(inputCol="description", outputCol="words"),
        stop_word_remover(stop_words),
        HashingTF(inputCol="filtered", outputCol="term_counts", numFeatures=features),
        IDF(inputCol="term_counts", outputCol="features"),
        StringIndexer(inputCol="category", outputCol="label", handleInvalid="skip"),
        LogisticRegression(maxIter=max_iter, regParam=reg, elasticNetParam=elastic),
    ])


def accuracy(predictions: DataFrame) -> float:
    return MulticlassClassificationEvaluator(metricName="accuracy").evaluate(predictions)
