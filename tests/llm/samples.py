"""Small tables with the awkward cases: nulls, empty and long texts, repeated rows, clashing columns."""

import random
import re

WORD = r"[^\x20\x09-\x0D]+"
CLASHES = ["row", "chunk", "_row", "size", "digest", "node", "key", "source_size", "_text", "slot", "part", "_n", "most", "label"]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text, pattern=WORD):
    return re.findall(pattern, text or "")


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}é" if rng.random() < 0.1 else f"w{rng.randrange(vocabulary)}" for _ in range(n))


def documents(seed=1, n=60):
    """(doc_id, text, lang, source, n_chars): copies, near copies, shared passages and the awkward rows."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randrange(1, 200)) for _ in range(n)]
    passage = prose(rng, 50)
    for i in range(0, n, 7):
        texts[i] = f"{prose(rng, 5)}\n{passage}\t {prose(rng, 5)}"
    for i in range(1, n, 9):
        own = texts[i].split()
        own[len(own) // 2] = "changed"
        texts.append(" ".join(own))
    texts += [texts[3]] * 5 + ["", None, " \n\t ", "One", "one TWO", "Aa bB cC", prose(rng, 6000)]
    rows = [(i, t, "en", [f"s{i % 3}", None][i % 11 == 0], len(t or "")) for i, t in enumerate(texts)]
    return [*rows, rows[4], rows[4], (None, texts[5], None, None, None), (None, None, None, None, None)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows=None, clashes=False):
    df = spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(5)
    if clashes:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("other") for c in CLASHES})
    return df
