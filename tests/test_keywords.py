"""Keywords from lists and tables against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from jobmart.functions import automaton
from jobmart.functions.skills import extract_skills
from jobmart.operators import keywords

SIDE = re.compile(r"[^\W]|_")


def brute(texts, words, whole):
    out = {}
    for i, t in texts:
        t = (t or "").lower()
        for w in {w.lower() for w in words if w}:
            spots = [k for k in range(len(t) - len(w) + 1) if t.startswith(w, k) and not (whole and (
                k > 0 and automaton.is_word(t[k - 1]) or k + len(w) < len(t) and automaton.is_word(t[k + len(w)])))]
            if spots:
                out[i, w] = (len(spots), spots[0])
    return out


def sample(seed, letters="abé+ x"):
    rng = random.Random(seed)
    words = list({"".join(rng.choice(letters) for _ in range(rng.randrange(1, 5))) for _ in range(14)})
    texts = [(i, "".join(rng.choice(letters + "_Ab́") for _ in range(rng.choice([0, 3, 60, 700])))) for i in range(40)]
    return [*texts, (40, None), (41, ""), (42, words[0] * 300)], words


@pytest.mark.parametrize("seed", range(12))
def test_all_occurrences(seed):
    texts, words = sample(seed)
    own = [t or "" for _, t in texts]
    text, keyword, at = automaton.build(words).find(own)
    assert sorted(zip(text.tolist(), keyword.tolist(), at.tolist())) == sorted(
        (i, j, k) for i, t in enumerate(own) for j, w in enumerate(words) for k in range(len(t)) if t.startswith(w, k))


def test_an_empty_list_and_empty_texts():
    assert [len(x) for x in automaton.build([]).find(["abc", ""])] == [0, 0, 0]
    assert [len(x) for x in automaton.build(["a"]).find([])] == [0, 0, 0]
    with pytest.raises(ValueError):
        automaton.build(["a", ""])


@pytest.mark.parametrize("whole", [True, False])
@pytest.mark.parametrize("most", [automaton.MOST_ENTRIES, 60, 1])  # one block, several, one for each keyword
def test_keywords_of_a_table(spark, whole, most):
    texts, words = sample(3)
    df = spark.createDataFrame(texts, "id int, body string").repartition(3).withColumn("text", F.lit("other"))
    listed = spark.createDataFrame([(w,) for w in [*words, words[0].upper(), "", None]], "keyword string")
    got = keywords.find_keywords(df, listed, "id", "body", whole_words=whole, most=most).collect()
    assert {(r["id"], r["keyword"]): (r["n"], r["first"]) for r in got} == brute(texts, words, whole)
    assert len(got) == len(brute(texts, words, whole))


def test_no_keywords(spark):
    df = spark.createDataFrame([(1, "a")], "id int, body string")
    none = spark.createDataFrame([], "place int, label string, keyword string")
    assert keywords.find_keywords(df, none, "id", "body").collect() == []
    assert [tuple(r) for r in keywords.label_by_table(df, none, "id", "body", "?").collect()] == [(1, "?")]


def test_first_rule_wins(spark):
    rules = spark.createDataFrame([(2, "late", "cat"), (1, "early", "Dog"), (1, "beta", "dog"), (3, "last", "a")], "place int, label string, keyword string")
    texts = [(1, "a CAT and a dog"), (2, "concatenate"), (3, "bat"), (4, "x"), (5, None), (None, "dog")]
    df = spark.createDataFrame(texts, "id int, body string")
    got = {r["id"]: r["label"] for r in keywords.label_by_table(df, rules, "id", "body", "none").collect()}
    assert got == {1: "beta", 2: "late", 3: "last", 4: "none", 5: "none", None: "beta"}
    got = {r["id"]: r["label"] for r in keywords.label_by_table(df, rules, "id", "body", "none", whole_words=True).collect()}
    assert got == {1: "beta", 2: "none", 3: "none", 4: "none", 5: "none", None: "beta"}


def test_skills_of_several_columns(spark):
    df = spark.createDataFrame([("big", "Data warehouse, C#", None), (None, None, None), ("google go;c++11", "", "nodeXjs")], "a string, b string, c string")
    got = [r[0] for r in df.select(extract_skills(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == [["C#", "Data Warehouse", "Big Data"], [], ["Go"]]
    legacy = [r[0] for r in df.select(extract_skills(F.col("a"), F.col("b"), legacy=True)).collect()]
    assert legacy == [["Data Warehouse", "Big Data"], [], ["C++", "Go"]]


def test_memory_of_a_scan_is_bounded_whatever_the_batch():
    """A batch of many texts is scanned in blocks: the same occurrences, and no more memory for eight times the texts."""
    import tracemalloc

    found = automaton.build(["sql", "java", "r"], [automaton.NO_WORD] * 3, [automaton.NO_WORD] * 3)
    texts = [("x" * 997 + f" sql r {i} java ") * 100 for i in range(80)]

    def peak(some):
        tracemalloc.start()
        hits = [len(found.find(some[i:i + 1])[0]) for i in (0, len(some) - 1)]
        tracemalloc.reset_peak()
        text, keyword, at = found.find(some)
        top = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(text) == 300 * len(some) and hits == [300, 300]
        assert all(some[t][a:].startswith(("sql", "java", "r")[k]) for t, k, a in zip(text.tolist(), keyword.tolist(), at.tolist()))
        return top

    assert peak(texts) < 2 * peak(texts[:10])
