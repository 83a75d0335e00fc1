"""Spelling variants: words that differ by one letter, found through pairs of trie nodes.

The vocabulary makes two tries, one of the words and one of the words read backwards, whose nodes are
numbered.  A word of ``l`` letters is then a path of ``l + 1`` pairs (node of the part before a place, node of the
part after it).  A pair that leaves one letter out is the same for words that differ in that letter only; a
pair that leaves none out is a word with a place to insert a letter, and equals the pair of the longer word that
leaves this letter out.  Joining on the integer pairs gives all words at distance one and no others; no
word is compared with another.  A pair fixes all letters but one, so at most as many words share it as
there are letters: no key is hot, whatever the words.

Numbering needs the words in order, where a word shares with the one before it all nodes up to their common
beginning.  Ranges of the order are numbered side by side.  A node that has words in several ranges is a
beginning of the words that bound them, so the nodes on the paths of the bounds are numbered first and handed to all.

``forms`` gives every word its near word of largest count, if that is large enough, and follows the
forms by doubling: the counts at least double at each step, so there are few rounds.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobmart.functions.text import bind
from jobmart.llm.common import documents, small_batches
from jobmart.llm.words import latin, words_of
from jobmart.scratch import materialise

SHORTEST = 5
FEWEST = 3
TIMES = 2
#: Words in a range of the order, and the least number of ranges; bounds are taken from so many words for each.
RANGE_WORDS = 65_536
LEAST_RANGES = 64
BOUND_SAMPLE = 32
ROOT = 0


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()
_STEPS = 64


def crc_after(state: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of each slice of ``data``, continued from the CRC of what stands before it."""
    out, lengths = ~state.astype(np.uint32), end - start
    for i in range(min(int(lengths.max(initial=0)), _STEPS)):
        on = np.flatnonzero(lengths > i)
        out[on] = (out[on] >> np.uint32(8)) ^ _CRC[(out[on] ^ data[start[on] + i]) & np.uint32(255)]
    out = ~out
    for i in np.flatnonzero(lengths > _STEPS).tolist():
        out[i] = zlib.crc32(data[start[i] + _STEPS:end[i]].tobytes(), int(out[i]))
    return out


def _count(batch: pa.RecordBatch, drop: int | None, shortest: int) -> pa.RecordBatch:
    """The words of a batch and their counts."""
    words = words_of(batch.column("text"), latin, lower=True)
    data, start, end = words.data, words.start, words.end
    upto = np.concatenate(([0], np.cumsum(data != 0xC3, dtype=np.int64))) if len(data) else np.zeros(1, np.int64)
    length = upto[end] - upto[start]  # code points: the first of two bytes does not count
    extra = []
    keep = length >= shortest
    if drop:
        heads = [zlib.crc32(f"{'' if i is None else i}:".encode()) for i in batch.column("doc_id").to_pylist()]
        crc = crc_after(np.array(heads, dtype=np.uint32)[words.doc()], data, start, end)
        changed = crc % np.uint32(drop) == 0
        for i in np.flatnonzero(changed & (length > shortest)).tolist():
            word, at = words.text(i).decode(), int(crc[i]) % int(length[i])
            extra.append(word[:at] + word[at + 1:])
        keep &= ~changed
    start, end = start[keep], end[keep]
    marks = np.zeros(len(data) + 1, dtype=np.int8)
    marks[start] += 1
    marks[end] -= 1
    letters = data[np.cumsum(marks[:-1], dtype=np.int8).view(bool)]
    offsets = np.concatenate(([0], np.cumsum(end - start)))
    found = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(letters))
    counted = pc.value_counts(pa.chunked_array([found, pa.array(extra, pa.large_string())]))
    return pa.RecordBatch.from_arrays([counted.field("values").cast(pa.string()), counted.field("counts")], ["word", "n"])


def vocabulary(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = SHORTEST, fewest: int = FEWEST, drop: int | None = None,
) -> DataFrame:
    """``word, n``: runs of Latin letters in all texts, A-Z lower-cased, with their counts.

    Words of less than ``shortest`` code points or ``fewest`` occurrences are left out.  With ``drop``, a run loses the
    code point at ``h % length`` if ``drop`` divides ``h``, the CRC-32 of ``<id>:<run>`` (a null id is empty): misspellings to
    try the grouping with.  A null text has no words; every repeated row counts.
    """
    rows = documents(docs, key, text)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            yield _count(batch, drop, shortest)

    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= fewest)


def _common(a: str, b: str) -> int:
    """Length of the common beginning."""
    least = min(len(a), len(b))
    if a[:least] == b[:least]:
        return least
    lo, hi = 0, least
    while hi - lo > 1:  # a[:lo] agrees, a[:hi] does not
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid)
    return lo


def number_paths(words: Sequence[str], before: tuple[str, list[int]], after: tuple[str, list[int]], number: int) -> tuple[list[list[int]], int]:
    """The trie nodes from the root to each of ``words``, which are sorted; new nodes are numbered from ``number`` on.

    ``before`` and ``after`` are the words at the bounds with their nodes, which are used where they are shared.
    """
    out = []
    last, path = before
    for word in words:
        shared, beyond = _common(word, last), _common(word, after[0])
        new = path[:shared + 1] if shared >= beyond else after[1][:beyond + 1]
        missing = len(word) + 1 - len(new)
        new = new + list(range(number, number + missing))
        number += missing
        out.append(new)
        last, path = word, new
    return out, number


def _ranges(words: DataFrame, column: str, total: int) -> tuple[list[str], list[list[int]]]:
    """Words that bound ranges of about equal size, and their nodes: ``total / RANGE_WORDS + LEAST_RANGES`` of them."""
    ranges = total // RANGE_WORDS + LEAST_RANGES
    some = words.select(column).orderBy(F.xxhash64(column), column).limit(BOUND_SAMPLE * ranges)
    some = sorted(r[0] for r in some.collect())
    bounds = ["", *sorted({some[i * len(some) // ranges] for i in range(1, ranges)} - {""})] if some else [""]
    paths, _ = number_paths(bounds, ("", [ROOT]), ("", [ROOT]), ROOT + 1)
    return bounds, paths


def trie_paths(words: DataFrame, total: int, column: str = "word") -> DataFrame:
    """``id, path``: the numbers of the trie nodes of each word (rows ``id`` and ``column``), from the root on."""
    bounds, paths = _ranges(words, column, total)
    bounds_end = [*zip(bounds, paths, strict=True), ("", [ROOT])]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [bisect_right(bounds, w) - 1 for w in batch.column("word").to_pylist()]
            yield batch.append_column("part", pa.array(parts, pa.int32()))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, free = -1, ("", [ROOT]), 0
        for batch in batches:  # in the order of part and word
            own = batch.column("part").to_numpy()
            heads = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))).tolist() if len(own) else []
            for lo, hi in zip(heads, [*heads[1:], len(own)], strict=True):
                if own[lo] != part:
                    part, last, free = int(own[lo]), bounds_end[own[lo]], (int(own[lo]) + 1) << 40
                names = batch.column("word").slice(lo, hi - lo).to_pylist()
                found, free = number_paths(names, last, bounds_end[part + 1], free)
                last = (names[-1], found[-1])
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(lo, hi - lo), pa.array(found, pa.list_(pa.int64()))], ["id", "path"])

    placed = words.select("id", F.col(column).alias("word")).mapInArrow(place, "id long, word string, part int")
    return placed.repartition(len(bounds), "part").sortWithinPartitions("part", "word").mapInArrow(number, "id long, path array<long>")


def near_pairs(words: DataFrame) -> DataFrame:
    """``id, near``: all ordered pairs of ``words`` (rows ``id, word``, distinct) that differ by one inserted, deleted or replaced letter.

    The numbered paths are written once; pairs of nodes are grouped, at most one word without and one for each letter
    with a letter left out.
    """
    total = words.count()
    forward = trie_paths(words, total)
    backward = trie_paths(words.select("id", F.reverse("word").alias("word")), total)
    nodes = materialise(forward.withColumnRenamed("path", "heads").join(backward.withColumnRenamed("path", "tails"), "id").join(words, "id"))
    last = F.size("heads") - 1
    places = F.when(last > 0, F.sequence(F.lit(0), last - 1)).otherwise(F.array().cast("array<int>"))
    # Leaving out any letter of a row of equal ones gives the same word: only the first one counts for insertions.
    skips = bind(F.split("word", ""), lambda letters: F.transform(places, lambda i: F.struct(
        F.get("heads", i).alias("p"), F.get("tails", last - 1 - i).alias("s"), F.lit(True).alias("skip"),
        ((i == 0) | (F.get(letters, i) != F.get(letters, i - 1))).alias("first"))))
    whole = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(
        F.get("heads", i).alias("p"), F.get("tails", last - i).alias("s"), F.lit(False).alias("skip"), F.lit(False).alias("first")))
    entries = nodes.select("id", F.explode(F.concat(skips, whole)).alias("e")).select("id", "e.p", "e.s", "e.skip", "e.first")
    groups = entries.groupBy("p", "s").agg(
        F.collect_list(F.when(F.col("skip"), F.struct("id", "first"))).alias("without"),
        F.max(F.when(~F.col("skip"), F.col("id"))).alias("whole"),
    ).filter((F.size("without") > 1) | ((F.size("without") > 0) & F.col("whole").isNotNull()))
    longer = F.filter("without", lambda x: x["first"] & F.col("whole").isNotNull())
    replaced = F.flatten(F.transform("without", lambda a: F.transform(
        F.filter("without", lambda b: b["id"] != a["id"]), lambda b: F.struct(a["id"].alias("id"), b["id"].alias("near")))))
    inserted = F.flatten(F.transform(longer, lambda a: F.array(
        F.struct(a["id"].alias("id"), F.col("whole").alias("near")), F.struct(F.col("whole").alias("id"), a["id"].alias("near")))))
    return groups.select(F.explode(F.concat(replaced, inserted)).alias("e")).select("e.id", "e.near")


def forms(words: DataFrame, times: int = TIMES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each row of ``words`` (``word, n``, distinct words).

    ``form``: the near word of largest count (of equals the first by code point) if it is at least ``times`` the word's own,
    else null; ``root``: the end of the forms; ``n_near``: how many near words there are.
    """
    if times < 2:
        raise ValueError("forms need at least twice the count")
    ranked = materialise(words.orderBy(F.col("n").desc(), "word").withColumn("id", F.monotonically_increasing_id()))  # less: preferred
    best = near_pairs(ranked.select("id", "word")).groupBy("id").agg(F.count("*").alias("n_near"), F.min("near").alias("near"))
    chosen = ranked.select(F.col("id").alias("near"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    known = ranked.join(best, "id", "left").join(chosen, "near", "left")
    enough = F.col("form_n") >= times * F.col("n")
    known = materialise(known.select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        *[F.when(enough, F.col(c)).alias(c) for c in ("near", "form", "form_n")]))
    steps = materialise(known.filter("near IS NOT NULL").select("id", F.col("near").alias("root")))
    while True:
        onward = steps.select(F.col("id").alias("root"), F.col("root").alias("further"))
        new = materialise(steps.join(onward, "root", "left").select("id", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        steps = new.select("id", "root")
        if new.filter("moved").isEmpty():
            break
    ends = steps.join(ranked.select(F.col("id").alias("root"), F.col("word").alias("end")), "root").select("id", "end")
    return known.join(ends, "id", "left").select("word", "form", F.coalesce("end", "word").alias("root"), "n", "n_near", "form_n")
