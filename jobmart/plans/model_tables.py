"""Fitted models as tables, scored by joins: what a model does can be read, stored and checked without MLlib.

A forest is a row per node, a logistic regression a row per class and feature with a weight.  Both are as large as the
model, not as the data, so they are broadcast after a look at their rows.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart.scratch import fresh_path, materialise

#: Rows of a model table that may be copied to every executor (some hundred bytes each at most).
MOST_BROADCAST = 1_000_000
INTERCEPT = -1


def _small(model: DataFrame) -> DataFrame:
    return F.broadcast(model) if model.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST else model


def entries(vector: Column) -> Column:
    """array(struct(feature, value)) of a vector's values other than 0."""
    raw = F.unwrap_udt(vector)
    at = F.when(raw["type"] == 0, raw["indices"]).otherwise(F.sequence(F.lit(0), F.size(raw["values"]) - 1))
    return F.filter(F.zip_with(at, raw["values"], lambda i, v: F.struct(i.alias("feature"), v.alias("value"))), lambda e: e["value"] != 0)


# ---- forests ---------------------------------------------------------------------------


def forest_nodes(spark: SparkSession, model: RandomForestRegressionModel) -> DataFrame:
    """``tree, node, prediction, left, right, feature, threshold, categories``; leaves have null children.

    Values of at most ``threshold`` go left; of a categorical feature, those among ``categories`` do.
    """
    path = fresh_path(spark, "forest")
    model.write().overwrite().save(path)
    node = F.col("nodeData")
    inner, continuous = node["leftChild"] >= 0, node["split"]["numCategories"] == -1
    values = node["split"]["leftCategoriesOrThreshold"]
    return materialise(spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("node"), node["prediction"].alias("prediction"),
        F.when(inner, node["leftChild"]).alias("left"), F.when(inner, node["rightChild"]).alias("right"),
        F.when(inner, node["split"]["featureIndex"]).alias("feature"),
        F.when(inner & continuous, F.get(values, F.lit(0))).alias("threshold"), F.when(inner & ~continuous, values).alias("categories")))


def score_forest(rows: DataFrame, nodes: DataFrame, key: str, features: str = "features") -> DataFrame:
    """``key, prediction``: the mean of the leaves that a row reaches, a step down all trees at a time.

    A row for each row of ``rows``, whose ``key`` should tell them apart.
    """
    table = _small(nodes.select(*[F.col(c).alias(f"_{c}") for c in nodes.columns]))
    trees = [r[0] for r in nodes.select("tree").distinct().orderBy("tree").collect()]  # as many as the model has
    given = rows.select(key, F.map_from_entries(entries(F.col(features))).alias("_values"))
    state = given.withColumn("_at", F.explode(F.array(*[F.struct(F.lit(t).cast("int").alias("tree"), F.lit(0).alias("node")) for t in trees])))
    state = state.select(key, "_values", F.col("_at.tree").alias("tree"), F.col("_at.node").alias("node"))
    for _ in range(_depth(nodes)):
        held = state.join(table, (F.col("tree") == F.col("_tree")) & (F.col("node") == F.col("_node")))
        value = F.coalesce(F.try_element_at("_values", F.col("_feature")), F.lit(0.0))
        goes_left = F.when(F.col("_categories").isNull(), value <= F.col("_threshold")).otherwise(F.array_contains("_categories", value))
        onward = F.when(F.col("_left").isNull(), F.col("node")).when(goes_left, F.col("_left")).otherwise(F.col("_right"))
        state = held.select(key, "_values", "tree", onward.alias("node"))
    leaves = state.join(table, (F.col("tree") == F.col("_tree")) & (F.col("node") == F.col("_node")))
    return leaves.groupBy(key).agg(F.avg("_prediction").alias("prediction"))


def _depth(nodes: DataFrame) -> int:
    """Longest way from a root to a leaf."""
    level, depth = nodes.filter("node = 0"), 0
    while True:
        children = level.filter("left IS NOT NULL").select("tree", F.explode(F.array("left", "right")).alias("node"))
        if children.isEmpty():
            return depth
        level, depth = children.join(nodes, ["tree", "node"]), depth + 1


# ---- logistic regression ---------------------------------------------------------------


def logistic_weights(spark: SparkSession, model: LogisticRegressionModel) -> DataFrame:
    """``label, feature, weight`` for each weight other than 0; feature ``INTERCEPT`` is the constant of each class."""
    weights, constants = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    if model.numClasses == 2 and len(weights) == 1:  # one row speaks for the second class
        weights, constants = [[0.0] * len(weights[0]), weights[0]], [0.0, constants[0]]
    rows = [(k, i, float(w)) for k, own in enumerate(weights) for i, w in enumerate(own) if w]
    rows += [(k, INTERCEPT, float(c)) for k, c in enumerate(constants)]
    return spark.createDataFrame(rows, "label int, feature int, weight double")


def score_logistic(rows: DataFrame, weights: DataFrame, key: str, features: str = "features") -> DataFrame:
    """``key, prediction``: the class of the largest sum of weights, the first of equals."""
    table = _small(weights)
    constant = F.array(F.struct(F.lit(INTERCEPT).alias("feature"), F.lit(1.0).alias("value")))
    pairs = rows.select(key, F.explode(F.concat(constant, entries(F.col(features)))).alias("e")).select(key, "e.feature", "e.value")
    sums = pairs.join(table, "feature").groupBy(key, "label").agg(F.sum(F.col("weight") * F.col("value")).alias("margin"))
    best = sums.groupBy(key).agg(F.min(F.struct((-F.col("margin")).alias("m"), "label")).alias("best"))
    return best.select(key, F.col("best.label").cast("double").alias("prediction"))
