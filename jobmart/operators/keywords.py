"""Keyword lists that are tables: which keywords stand in which texts, and labels by rules of a table.

The keywords are read by the driver in blocks that one automaton can hold (``MOST_ENTRIES``); every task scans
its texts with the block's automaton and emits the keywords found.  A list of usual size is one block and one
pass over the texts.  A longer one is cut by the order of its keywords, so that a block shares
beginnings, and the texts pass once for each block.  No text is shuffled, and no row meets a list of keywords.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobmart.functions import automaton

# Send the Python functions of this module to executors by value: they need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _blocks(keywords: DataFrame, most: int) -> Iterator[list[str]]:
    """The keywords in order, in lists whose automaton has at most ``most`` entries (or one keyword)."""
    block, length, letters = [], 1, set()
    for (word,) in keywords.orderBy("keyword").toLocalIterator():
        wider = letters | set(word)
        if block and (length + len(word)) * (1 + len(wider)) > most:
            yield block
            block, length, wider = [], 1, set(word)
        block.append(word)
        length, letters = length + len(word), wider
    if block:
        yield block


def _pass(rows: DataFrame, words: list[str], whole_words: bool, kind: str) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edge = [automaton.NO_WORD if whole_words else automaton.ANY] * len(words)
        found = automaton.build(words, edge, edge)
        for batch in batches:
            text, keyword, at = found.find(batch.column("text").fill_null("").to_pylist())
            order = np.lexsort((at, keyword, text))
            text, keyword, at = text[order], keyword[order], at[order]
            heads = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (keyword[1:] != keyword[:-1])))) if len(text) else np.empty(0, np.int64)
            counts = np.diff(np.append(heads, len(text)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(text[heads])), pa.array(keyword[heads]), pa.array(counts), pa.array(at[heads])],
                ["key", "number", "n", "first"])

    return rows.mapInArrow(scan, f"key {kind}, number long, n long, first long")


def find_keywords(
    texts: DataFrame, keywords: DataFrame, key: str, text: str, keyword: str = "keyword", whole_words: bool = True,
    most: int = automaton.MOST_ENTRIES,
) -> DataFrame:
    """``key, keyword, n, first``: each keyword that stands in a text, how often, and where first (from 0).

    Upper and lower case are the same.  With ``whole_words`` no letter or digit may stand next to a keyword;
    "C++" and ".NET" are words.  Occurrences inside a longer keyword, and overlapping ones, count.  Null and empty
    keywords match nothing, keywords that differ in case only are one (lower-cased); null texts have none.  ``key``
    should identify the texts; texts with the same key give rows of their own.
    """
    spark = texts.sparkSession
    words = keywords.select(F.lower(F.col(keyword)).alias("keyword")).filter("keyword <> ''").distinct()
    rows = texts.select(F.col(key).alias("key"), F.lower(F.col(text)).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    found = None
    for block in _blocks(words, most):
        names = spark.createDataFrame(list(enumerate(block)), "number long, keyword string")
        hits = _pass(rows, block, whole_words, kind)
        hits = hits.join(F.broadcast(names), "number").select("key", "keyword", "n", "first")  # at most one automaton's keywords
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        found = spark.createDataFrame([], f"key {kind}, keyword string, n long, first long")
    return found.withColumnRenamed("key", key)


def label_by_table(
    texts: DataFrame, rules: DataFrame, key: str, text: str, otherwise: str, whole_words: bool = False, most: int = automaton.MOST_ENTRIES,
) -> DataFrame:
    """``key, label``: for every text the label of the first rule (rows ``place, label, keyword``) whose keyword it has.

    Rules are tried by ``place``, of equal places by label; texts without a keyword get ``otherwise``.  The found
    keywords meet the rules, never the texts: at most a row for each text and keyword is shuffled, pre-aggregated.
    """
    best = rules.select("place", "label", F.lower("keyword").alias("keyword")).groupBy("keyword").agg(F.min(F.struct("place", "label")).alias("rule"))
    hits = find_keywords(texts, rules, key, text, whole_words=whole_words, most=most).join(best, "keyword")
    first = hits.groupBy(F.col(key).alias("_key")).agg(F.min("rule")["label"].alias("label"))
    keys = texts.select(key)
    return keys.join(first, F.col(key).eqNullSafe(F.col("_key")), "left").select(key, F.coalesce("label", F.lit(otherwise)).alias("label"))
