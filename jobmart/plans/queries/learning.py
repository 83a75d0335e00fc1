"""Model queries: fit on the tables, return the report on the held-out rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.ml.feature import IDF, OneHotEncoder, Tokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor

from jobmart.functions import level, location, salary
from jobmart.plans import model_tables, models
from jobmart.plans.queries.base import PHRASES, POSTINGS_SQL, adverts, pick, postings, query, table
from jobmart.scratch import materialise

STOP_WORDS = ["the", "of", "and", "de", "la", "der", "die", "que", "el", "et", "in", "to", "the and"]


def salary_rows(spark, folder) -> DataFrame:
    rows = adverts(spark, folder)
    parsed = rows.withColumn("s", salary.salary_range(F.col("salary_raw"))).select(
        "advert_id", F.trim("company").alias("company"), "title",
        location.province(F.col("location_raw")).alias("city"), level.level(F.col("title")).alias("level"),
        F.split(pick(PHRASES, F.col("c_custkey")), " ").alias("benefits"),
        "s.salary_min", "s.salary_max",
    )
    return models.training_rows(parsed)


@query("salary_model_report")
def salary_model_report(spark, folder):
    # Written once: every stage of the fit reads the rows again.
    train, held_out = models.hash_split(materialise(salary_rows(spark, folder)), F.col("advert_id"))
    return models.salary_report(models.salary_regression().fit(train), held_out)


def documents_by_language(spark, folder) -> DataFrame:
    return table(spark, folder, "documents").select(
        "doc_id", models.without_phrases(F.col("text"), STOP_WORDS).alias("description"), F.col("lang").alias("category")
    )


@query("advert_classifier_report")
def advert_classifier_report(spark, folder):
    train, held_out = models.hash_split(materialise(documents_by_language(spark, folder)), F.col("doc_id"), seed=1234)
    predictions = models.advert_classifier(STOP_WORDS).fit(train).transform(held_out)
    return predictions.groupBy("category").agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("prediction") == F.col("label")).alias("n_right")
    )


# ---- the deterministic parts of the models, each held against SQL ------------------------

_TITLES_SQL = f"{POSTINGS_SQL}, t AS (SELECT advert_id, title FROM postings WHERE title <> '')"
_WORDS_SQL = f"""{_TITLES_SQL}, w AS (SELECT advert_id, list_filter(regexp_split_to_array(lower(title), '[^\\p{{L}}\\p{{M}}\\p{{N}}_]'), lambda x: x <> '') AS words FROM t)"""


def _titles(spark, folder) -> DataFrame:
    return postings(spark, folder).select("advert_id", "title").filter(F.col("title") != "")


@query(
    "ml_split",
    """SELECT advert_id, CASE WHEN ('0x' || substr(md5('42-' || advert_id), 1, 8))::BIGINT % 10000 < 8000 THEN 'train' ELSE 'held_out' END AS part
 FROM (SELECT o_orderkey AS advert_id FROM orders)""",
)
def ml_split(spark, folder):
    train, held_out = models.hash_split(postings(spark, folder).select("advert_id"), F.col("advert_id"))
    return train.withColumn("part", F.lit("train")).unionByName(held_out.withColumn("part", F.lit("held_out")))


@query(
    "ml_label_index",
    f"""WITH {_TITLES_SQL}, c AS (SELECT title, count(*) AS n FROM t GROUP BY 1),
 i AS (SELECT title, CAST(row_number() OVER (ORDER BY n DESC, encode(title)) - 1 AS DOUBLE) AS title_index FROM c)
 SELECT advert_id, title_index FROM t JOIN i USING (title)""",
)
def ml_label_index(spark, folder):
    rows = _titles(spark, folder)
    return models.label_index("title").fit(rows).transform(rows).select("advert_id", "title_index")


@query(
    "ml_one_hot",
    f"""WITH {_TITLES_SQL}, c AS (SELECT title, count(*) AS n FROM t GROUP BY 1),
 i AS (SELECT title, row_number() OVER (ORDER BY n DESC, encode(title)) - 1 AS place, count(*) OVER () AS width FROM c)
 SELECT advert_id, place, width, 1.0::DOUBLE AS total FROM t JOIN i USING (title)""",
)
def ml_one_hot(spark, folder):
    rows = _titles(spark, folder)
    indexed = models.label_index("title").fit(rows).transform(rows)
    encoded = OneHotEncoder(inputCol="title_index", outputCol="v").fit(indexed).transform(indexed)
    values = vector_to_array("v")
    return encoded.select(
        "advert_id", (F.array_position(values, 1.0) - 1).alias("place"), F.size(values).cast("bigint").alias("width"),
        F.aggregate(values, F.lit(0.0), lambda total, x: total + x).alias("total"))


@query("ml_title_words", f"WITH {_WORDS_SQL} SELECT advert_id, array_to_string(words, '|') AS words FROM w")
def ml_title_words(spark, folder):
    return models.title_tokenizer().transform(_titles(spark, folder)).select("advert_id", F.array_join("title_words", "|").alias("words"))


@query(
    "ml_vocabulary",
    f"""WITH {_WORDS_SQL} SELECT term, count(*) AS n_rows, CAST(sum(n) AS BIGINT) AS n_terms FROM
 (SELECT advert_id, term, count(*) AS n FROM (SELECT advert_id, unnest(words) AS term FROM w) GROUP BY 1, 2) GROUP BY 1 HAVING count(*) >= 2""",
)
def ml_vocabulary(spark, folder):
    """Rows and occurrences of every term, from the fitted term-count vectors."""
    rows = models.title_tokenizer().transform(_titles(spark, folder))
    model = models.term_counts("title_words", 1000, 2.0).fit(rows)
    terms = spark.createDataFrame(list(enumerate(model.vocabulary)), "at bigint, term string")
    counted = model.transform(rows).select(F.posexplode(vector_to_array("title_words_vector")).alias("at", "n")).filter("n > 0")
    sums = counted.groupBy("at").agg(F.count("*").alias("n_rows"), F.sum("n").cast("bigint").alias("n_terms"))
    return sums.join(terms, "at").select("term", "n_rows", "n_terms")


@query(
    "ml_idf",
    f"""WITH {_WORDS_SQL}, d AS (SELECT term, count(DISTINCT advert_id) AS df FROM (SELECT advert_id, unnest(words) AS term FROM w) GROUP BY 1)
 SELECT term, df, round(ln(((SELECT count(*) FROM w) + 1)::DOUBLE / (df + 1)), 9) AS idf FROM d""",
)
def ml_idf(spark, folder):
    rows = models.title_tokenizer().transform(_titles(spark, folder))
    counts = models.term_counts("title_words", 1000, 1.0).fit(rows)
    model = IDF(inputCol="title_words_vector", outputCol="features").fit(counts.transform(rows))
    weights = [(term, int(df), float(idf)) for term, df, idf in zip(counts.vocabulary, model.docFreq, model.idf.toArray(), strict=True)]
    return spark.createDataFrame(weights, "term string, df bigint, idf double").withColumn("idf", F.round("idf", 9))


@query(
    "ml_stop_words",
    r"""SELECT doc_id, len(w) AS n_words, md5(array_to_string(list_filter(w, lambda x: x NOT IN ('the', 'of', 'and', 'de', 'la', 'der', 'die', 'que', 'el', 'et', 'in', 'to')), ' ')) AS filtered
 FROM (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\s'), lambda x: x <> '') AS w FROM documents)""",
)
def ml_stop_words(spark, folder):
    words = Tokenizer(inputCol="text", outputCol="words").transform(table(spark, folder, "documents").select("doc_id", "text"))
    rows = models.stop_word_remover(STOP_WORDS).transform(words)
    full = lambda c: F.filter(c, lambda x: x != "")
    return rows.select(
        "doc_id", F.size(full("words")).cast("bigint").alias("n_words"), F.md5(F.array_join(full("filtered"), " ")).alias("filtered"))


@query("ml_rmse", "SELECT round(sqrt(avg(power(l_quantity - l_extendedprice / 2000, 2))), 6) AS rmse FROM lineitem")
def ml_rmse(spark, folder):
    """Error of a fixed prediction."""
    rows = table(spark, folder, "lineitem").select(
        F.col("l_quantity").cast("double").alias(models.LABEL), (F.col("l_extendedprice") / 2000).cast("double").alias("prediction"))
    return spark.createDataFrame([(round(models.rmse(rows), 6),)], "rmse double")


@query(
    "ml_accuracy",
    """SELECT round(avg(CASE WHEN l_linenumber % 3 = (CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END) THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS accuracy FROM lineitem""",
)
def ml_accuracy(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        (F.col("l_linenumber") % 3).cast("double").alias("label"), F.when(F.col("l_quantity") > 25, 1.0).otherwise(0.0).alias("prediction"))
    return spark.createDataFrame([(round(models.accuracy(rows), 6),)], "accuracy double")


# ---- fitted models as tables, against what MLlib predicts --------------------------------


def _held_out_sql(key: str, seed: int) -> str:
    return f"('0x' || substr(md5('{seed}-' || {key}), 1, 8))::BIGINT % 10000 >= 8000"


@query("forest_as_rows", f"SELECT o_orderkey, false AS differs FROM orders WHERE {_held_out_sql('o_orderkey', 42)}")
def forest_as_rows(spark, folder):
    """Held-out orders scored by joins with the nodes of a forest; whether MLlib predicts another price."""
    rows = table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("double").alias("price"), F.dayofyear("o_orderdate").alias("day"), F.year("o_orderdate").alias("year"),
        (F.col("o_custkey") % 50).alias("firm"))
    inputs = VectorAssembler(inputCols=["day", "year", "firm"], outputCol="features")
    train, held_out = models.hash_split(materialise(inputs.transform(rows)), F.col("o_orderkey"))
    forest = RandomForestRegressor(labelCol="price", numTrees=5, seed=7).fit(train)
    own = model_tables.score_forest(held_out, model_tables.forest_nodes(spark, forest), "o_orderkey")
    told = forest.transform(held_out).select("o_orderkey", F.col("prediction").alias("told"))
    differs = F.abs(F.col("prediction") - F.col("told")) > 1e-9 * F.abs("told")
    return told.join(own, "o_orderkey", "left").select("o_orderkey", F.coalesce(differs, F.lit(True)).alias("differs"))


@query("logistic_as_rows", f"SELECT doc_id, false AS differs FROM documents WHERE lang IS NOT NULL AND {_held_out_sql('doc_id', 1234)}")
def logistic_as_rows(spark, folder):
    """Held-out documents classified by joins with the weights of the classifier; whether MLlib chooses another class."""
    train, held_out = models.hash_split(materialise(documents_by_language(spark, folder)), F.col("doc_id"), seed=1234)
    fitted = models.advert_classifier(STOP_WORDS).fit(train)
    told = materialise(fitted.transform(held_out).select("doc_id", "features", F.col("prediction").alias("told")))
    own = model_tables.score_logistic(told, model_tables.logistic_weights(spark, fitted.stages[-1]), "doc_id")
    return told.join(own, "doc_id", "left").select("doc_id", F.coalesce(F.col("prediction") != F.col("told"), F.lit(True)).alias("differs"))
