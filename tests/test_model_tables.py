"""Models as tables give what MLlib gives."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from jobmart.plans import model_tables


def test_entries_of_vectors(spark):
    rows = spark.createDataFrame([(Vectors.dense([0.0, 2.0, -1.0]),), (Vectors.sparse(4, [1, 3], [0.0, 5.0]),)], ["v"])
    assert [[tuple(e) for e in r[0]] for r in rows.select(model_tables.entries(F.col("v"))).collect()] == [[(1, 2.0), (2, -1.0)], [(3, 5.0)]]


def test_forest(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(rng.integers(0, 30)), str(rng.choice(list("abcd"))), float(rng.normal())) for i in range(600)]
    df = spark.createDataFrame([(*r, r[1] * (r[2] == "b") + r[3]) for r in rows], "id int, x double, kind string, z double, label double")
    df = StringIndexer(inputCol="kind", outputCol="k").fit(df).transform(df)  # a categorical feature: splits by sets
    data = VectorAssembler(inputCols=["x", "k", "z"], outputCol="features").transform(df)
    model = RandomForestRegressor(numTrees=4, maxDepth=4, seed=3).fit(data)
    nodes = model_tables.forest_nodes(spark, model)
    assert nodes.select("tree").distinct().count() == 4 and nodes.filter("categories IS NOT NULL").count() > 0
    got = {r["id"]: r["prediction"] for r in model_tables.score_forest(data, nodes, "id").collect()}
    want = {r["id"]: r["prediction"] for r in model.transform(data).collect()}
    assert got == {i: pytest.approx(p) for i, p in want.items()}


@pytest.mark.parametrize("classes", [2, 3])
def test_logistic_regression(spark, classes):
    rng = np.random.default_rng(2)
    rows = [(i, Vectors.dense(v) if i % 2 else Vectors.sparse(3, [1], [float(v[1])]), float(abs(int(v.sum() * 2)) % classes))
            for i in range(300) for v in [rng.normal(size=3)]]
    df = spark.createDataFrame(rows, ["id", "features", "label"])
    model = LogisticRegression(maxIter=8).fit(df)
    weights = model_tables.logistic_weights(spark, model)
    assert weights.filter(F.col("feature") == model_tables.INTERCEPT).count() == classes
    got = {r["id"]: r["prediction"] for r in model_tables.score_logistic(df, weights, "id").collect()}
    # Row by row: once a session has observed metrics, Spark cannot send a fitted binary model to tasks.
    assert got == {r["id"]: model.predict(r["features"]) for r in df.collect()}
