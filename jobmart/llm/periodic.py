"""Periodic runs of words: stretches in which the words repeat with a fixed lag.

A run is a stretch of at least ``least`` words and ``times`` periods whose words are equal ``q`` apart, ``q``
its smallest period, and which no neighbouring word extends.  Seen as a matrix of word against earlier
word, a run is a stretch of matches on the diagonal ``lag = q``; sparse diagonal dynamic programming goes
through the words once, lets the earlier occurrences of each word lengthen the matches on their diagonals,
and emits a run where a diagonal ends that is long enough.

Taking all earlier occurrences costs the square of a frequent word's count.  So an occurrence counts only
with its context: on scale ``k`` (``k`` doubles) the words are windows of ``k`` words, and only the nearest
earlier occurrence of a window, at a lag in ``(k/2, k]``, is active.  Nothing is lost.  A run of period
``q <= k`` has at least ``(times - 1) * q >= k`` matches, so some window of it matches on diagonal ``q``; and a window
of at least ``q`` words cannot also occur nearer, or the run would have a smaller period.  The windows that
match on diagonal ``q`` are exactly those of the run, so the first and the last of them give its ends.  One
diagonal is active for each word and scale, and a document that repeats no window of a scale is left out
of all larger ones, so the work grows with ``n log n`` at most and for most documents with ``n``.

Words are compared by 64-bit hashes within their document.  Documents go through a map task in batches of
about 4 MB; nothing is shuffled, and a long document is whole in its task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmart.functions.text import bind
from jobmart.llm.common import WORD, documents, small_batches
from jobmart.llm.words import rolling, words_of

LEAST = 24
TIMES = 3


def first_scale(least: int, times: int) -> int:
    """The largest power of two that is at most the number of matches in any run."""
    fewest = min(max(least - q, (times - 1) * q) for q in range(1, max(least, 2)))
    return 1 << (fewest.bit_length() - 1)


def _nearest(codes: np.ndarray, doc: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows (positions ``where``) that occurred earlier in their document, and the lag to the nearest."""
    order = np.argsort(codes[where], kind="stable")
    at = where[order]
    same = (codes[at[1:]] == codes[at[:-1]]) & (doc[at[1:]] == doc[at[:-1]])
    again, lag = at[1:][same], (at[1:] - at[:-1])[same]
    by_place = np.argsort(again)
    return again[by_place], lag[by_place]


def find(hashes: np.ndarray, first: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows (document, start, length, period), sorted by document, start and period.

    ``hashes``: of the words of all documents; ``first``: where each document begins, and the end.
    """
    if times < 3:
        raise ValueError("runs need at least three periods")
    lowest, k = 0, first_scale(least, times)
    number, counts = np.arange(len(first) - 1), np.diff(first)
    found = [np.empty((0, 4), dtype=np.int64)]
    while True:
        able = counts >= max(least, times * (lowest + 1))
        keep = np.repeat(able, counts)
        hashes, number, counts = hashes[keep], number[able], counts[able]
        if not len(number):
            break
        ends = np.cumsum(counts)
        begin = ends - counts
        doc = np.repeat(np.arange(len(counts)), counts)
        codes = rolling(hashes, k)
        where = np.flatnonzero(np.arange(len(codes)) + k <= ends[doc[:len(codes)]])
        again, lag = _nearest(codes, doc, where)
        active = (lag > lowest) & (lag <= k)
        at, on = again[active], lag[active]
        if len(at):
            heads = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1] + 1) | (on[1:] != on[:-1]))))
            tails = np.concatenate((heads[1:], [len(at)])) - 1
            period = on[heads]
            start, length = at[heads] - period, at[tails] + k - at[heads] + period
            enough = length >= np.maximum(least, times * period)
            of = doc[at[heads]]
            found.append(np.stack((number[of], start - begin[of], length, period), axis=1)[enough])
        repeats = np.zeros(len(counts), dtype=bool)
        repeats[doc[again]] = True
        hashes, number, counts = hashes[np.repeat(repeats, counts)], number[repeats], counts[repeats]
        lowest, k = k, 2 * k
    runs = np.concatenate(found)
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _scan(batch: pa.RecordBatch, least: int, times: int) -> pa.RecordBatch:
    text = batch.column("text")
    words = words_of(text)
    runs = find(words.hashes(), words.first, least, times)
    upto = np.searchsorted(runs[:, 0], np.arange(words.n_docs + 1))
    kept = []
    for i, t in enumerate(text.to_pylist()):
        own = (t or "").encode().split()
        if upto[i] < upto[i + 1]:
            gone = np.zeros(len(own) + 1, dtype=np.int64)
            for _, start, length, period in runs[upto[i]:upto[i + 1]].tolist():
                gone[start + period] += 1
                gone[start + length] -= 1
            own = [w for w, g in zip(own, np.cumsum(gone[:-1]).tolist(), strict=True) if not g]
        kept.append(b" ".join(own).decode())
    listed = pa.StructArray.from_arrays([pa.array(runs[:, c]) for c in (1, 2, 3)], fields=list(_RUN))
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(words.counts()), pa.ListArray.from_arrays(pa.array(upto, pa.int32()), listed), pa.array(kept, pa.string())],
        ["doc_id", "n_words", "runs", "kept"])


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """For each row of ``docs``: ``doc_id, n_words, runs`` (start, length and period, by start, then period) and ``kept``.

    ``kept`` has the words joined by one space, without those that a run repeats: all of a run but its first
    period goes.  Every row is judged by itself, so repeated rows and ids (null too) give a row each.  A null
    text has no words; it and texts without runs give an empty list.  Other columns are not read.
    """
    rows = documents(docs, key, text)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            yield _scan(batch, least, times)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(scan, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, kept string")


def strongest(runs: Column) -> Column:
    """The run with most repetitions (exact length by period); the first of equals, null without runs."""
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, none, lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))


def digest_of_runs(runs: Column) -> Column:
    line = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return F.sha2(F.concat(F.array_join(line, "\n"), F.when(F.size(runs) > 0, "\n").otherwise("")), 256)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: about every tenth text made periodic from some word on, chosen by the CRC of its id."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = F.pmod(g, n)
        return bind(F.struct(a.alias("a"), (1 + F.floor((n - a) / (3 + g % 8))).alias("p")), lambda v: F.array_join(F.transform(
            words, lambda x, i: F.when(i < v["a"], x).otherwise(F.get(words, (v["a"] + (i - v["a"]) % v["p"]).cast("int")))), " "))

    planted = bind(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), lambda words: F.when(F.size(words) > 0, repeated(words)))
    return docs.select("doc_id", F.when(h % 10 == 0, planted).otherwise(F.col("text")).alias("text"))
