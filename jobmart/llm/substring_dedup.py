"""Removal of repeated passages by super-k-mer partitioning.

A window is ``width`` consecutive words of one document; its minimiser is the least hash of the
``minimiser``-word pieces in it.  Consecutive windows with the same minimiser make a super-k-mer.

1. Every chunk counts its super-k-mers by minimiser; a shuffle adds the counts up.  A minimiser that occurs
   once holds no repeated window, so only those that occur again are reported back to their chunks.
2. Every chunk settles the windows that repeat inside it.  Of each different window one travels on: the
   windows of a super-k-mer as one packed string, to the bucket of its minimiser.  So a passage that a third
   of all documents share sends one copy for each chunk.  Windows of a frequent minimiser (``HOT`` super-k-mers
   or more; mostly windows that reach over the edge of a shared passage, all different) travel singly, to
   buckets chosen by the window, so they spread out; those of ``AREA`` chunks are settled among themselves
   first, so a window that every chunk has costs a bucket one entry for each area.
3. Every bucket sorts its windows (by 128-bit hash) and counts them; those in several chunks are reported back.
4. Every chunk removes the words that repeated windows cover.

Windows are compared by two independent 64-bit hashes over 64-bit word hashes.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from jobmart.llm.chunks import arrow_table, count_chunks, dealt, in_order, joined, part_of, slices
from jobmart.llm.common import documents
from jobmart.llm.words import Words, mix, rolling, sliding_min, words_of

WIDTH = 35
MINIMISER = 16
HOT = 1024
AREA = 256

_COUNTS = "part int, chunk int, hashes binary, counts binary"
_AGAIN = "chunk int, hashes binary, hot binary"
_PACKED = "bucket int, chunk int, bytes binary, lengths binary, starts binary, known binary, hot boolean"
_FOUND = "chunk int, starts binary"


def _minimisers(w: Words, h: np.ndarray, width: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of all windows, and their minimisers."""
    least = sliding_min(rolling(h, size), width - size + 1)
    ends = np.repeat(w.first[1:], w.counts())[:len(least)]
    at = np.flatnonzero(np.arange(len(least)) + width <= ends)
    return at, least[at]


def _heads(at: np.ndarray, *same: np.ndarray) -> np.ndarray:
    """Where runs of consecutive windows with equal values begin."""
    if not len(at):
        return at
    new = np.concatenate(([True], at[1:] != at[:-1] + 1))
    for values in same:
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _repeats(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window: is it the first with its hashes; does it have others."""
    order = np.lexsort((np.arange(len(one)), one))
    a, b = one[order], two[order]
    same = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    first, more = np.ones(len(one), dtype=bool), np.zeros(len(one), dtype=bool)
    first[order[1:]] = ~same
    more[order[1:][same]] = True
    more[order[:-1][same]] = True
    return first, more


def _count(width: int, size: int, parts: int) -> Callable:
    def run(key: tuple, chunk: pa.Table) -> pa.Table:
        w = words_of(in_order(chunk)["text"])
        at, least = _minimisers(w, w.hashes(), width, size)
        values, counts = np.unique(least[_heads(at, least)], return_counts=True)
        part = part_of(mix(values), parts)  # minimisers are small hashes: only mixed ones spread evenly
        order = np.argsort(part, kind="stable")
        values, counts = values[order], counts[order].astype(np.uint32)
        return arrow_table(_COUNTS, [
            (p, key[0].as_py(), values[a:b].tobytes(), counts[a:b].tobytes()) for p, a, b in slices(part[order])])
    return run


def _again(hot: int) -> Callable:
    def run(_: tuple, rows: pa.Table) -> pa.Table:
        values, lengths = joined(rows["hashes"], "u8")
        counts, _ = joined(rows["counts"], "u4")
        distinct, which = np.unique(values, return_inverse=True)
        total = np.bincount(which, weights=counts, minlength=len(distinct))[which]
        ends, out = np.cumsum(lengths), []
        for chunk, a, b in zip(rows["chunk"].to_pylist(), ends - lengths, ends, strict=True):
            more = total[a:b] >= 2
            if more.any():
                out.append((chunk, values[a:b][more].tobytes(), (total[a:b][more] >= hot).tobytes()))
        return arrow_table(_AGAIN, out)
    return run


def _pack(width: int, size: int, parts: int) -> Callable:
    def run(key: tuple, chunk: pa.Table, again: pa.Table) -> pa.Table:
        if not again.num_rows or not chunk.num_rows:
            return arrow_table(_PACKED, [])
        w = words_of(in_order(chunk)["text"])
        h = w.hashes()
        at, least = _minimisers(w, h, width, size)
        known, hot = joined(again["hashes"], "u8")[0], joined(again["hot"], "?")[0]
        order = np.argsort(known)
        known, hot = known[order], hot[order]
        place = np.minimum(np.searchsorted(known, least), len(known) - 1)
        chosen = known[place] == least
        at, least, hot = at[chosen], least[chosen], hot[place[chosen]]
        one = rolling(h, width)[at]
        first, more = _repeats(one, rolling(w.hashes(1), width, 1)[at])
        at, least, hot, one, more = at[first], least[first], hot[first], one[first], more[first]
        single = np.where(hot, np.arange(1, len(at) + 1), 0)
        heads = _heads(at, least, more, single)
        if not len(heads):
            return arrow_table(_PACKED, [])
        tails = np.concatenate((heads[1:], [len(at)])) - 1
        bucket = part_of(mix(np.where(hot, one, least)[heads]), parts)
        begin, end, start = w.start[at[heads]], w.end[at[tails] + width - 1], at[heads].astype(np.uint32)
        rows, raw = [], w.data
        for single in (False, True):
            order = np.flatnonzero(hot[heads] == single)
            order = order[np.argsort(bucket[order], kind="stable")]
            for p, a, b in slices(bucket[order]):
                own = order[a:b]
                rows.append((
                    p, key[0].as_py(), b"".join(raw[begin[i]:end[i]].tobytes() for i in own),
                    (end[own] - begin[own]).astype(np.uint32).tobytes(), start[own].tobytes(), more[heads[own]].tobytes(), single))
        return arrow_table(_PACKED, rows)
    return run


class _Strings:
    """The packed strings of several rows: windows, the string of each, and what came with the strings."""

    def __init__(self, rows: pa.Table, width: int) -> None:
        self.lengths, per_row = joined(rows["lengths"], "u4")
        self.starts, self.known = joined(rows["starts"], "u4")[0], joined(rows["known"], "?")[0]
        self.offsets = np.concatenate(([0], np.cumsum(self.lengths, dtype=np.int64)))
        self.bytes = b"".join(rows["bytes"].to_pylist())
        self.chunk = np.repeat(np.array(rows["chunk"].to_pylist(), dtype=np.int64), per_row)
        w = words_of(pa.LargeStringArray.from_buffers(len(self.lengths), pa.py_buffer(self.offsets), pa.py_buffer(self.bytes)))
        h, string = w.hashes(), w.doc()
        self.at = np.flatnonzero(np.arange(len(h)) + width <= w.first[1:][string])
        self.string = string[self.at]
        self.first, self.more = _repeats(rolling(h, width)[self.at], rolling(w.hashes(1), width, 1)[self.at])
        self.position = self.starts[self.string] + (self.at - w.first[:-1][self.string]).astype(np.uint32)

    def news(self) -> list[tuple[int, bytes]]:
        """Positions, by chunk, of the windows that turn out to be repeated and were not known to be."""
        found = np.flatnonzero(self.more & ~self.known[self.string])
        order = found[np.argsort(self.chunk[self.string[found]], kind="stable")]
        return [(c, self.position[order[a:b]].tobytes()) for c, a, b in slices(self.chunk[self.string[order]])]


def _gather(width: int) -> Callable:
    """Of the single windows of an area one of each goes on; what is settled stands in rows of bucket -1."""
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        s = _Strings(rows, width)
        out = [(-1, c, None, None, starts, None, False) for c, starts in s.news()]
        own = s.string[s.first]  # every string is one window
        known = s.known[own] | s.more[s.first]
        for c, a, b in slices(s.chunk[own]):
            part = own[a:b]
            out.append((
                key[0].as_py(), c, b"".join(s.bytes[s.offsets[i]:s.offsets[i + 1]] for i in part), s.lengths[part].tobytes(),
                s.starts[part].tobytes(), known[a:b].tobytes(), False))
        return arrow_table(_PACKED, out)
    return run


def _settle(width: int) -> Callable:
    def run(_: tuple, rows: pa.Table) -> pa.Table:
        return arrow_table(_FOUND, _Strings(rows, width).news())
    return run


def _remove(width: int, schema: pa.Schema) -> Callable:
    def run(_: tuple, chunk: pa.Table, found: pa.Table) -> pa.Table:
        rows = in_order(chunk)
        w = words_of(rows["text"])
        h = w.hashes()
        at, one = np.flatnonzero(np.arange(len(h)) + width <= np.repeat(w.first[1:], w.counts())), rolling(h, width)
        _, more = _repeats(one[at], rolling(w.hashes(1), width, 1)[at])
        cover = np.zeros(len(h) + 1, dtype=np.int32)
        starts = np.union1d(at[more], joined(found["starts"], "u4")[0]).astype(np.int64)
        cover[starts] += 1
        cover[starts + width] -= 1
        gone = np.cumsum(cover[:-1]) > 0
        sums = np.concatenate(([0], np.cumsum(gone)))
        removed = sums[w.first[1:]] - sums[w.first[:-1]]
        kept, raw = [], w.data
        for d, text in enumerate(rows["text"].to_pylist()):
            if removed[d]:
                a, b = w.first[d], w.first[d + 1]
                left = np.flatnonzero(~gone[a:b]) + a
                kept.append(b" ".join([raw[s:e].tobytes() for s, e in zip(w.start[left], w.end[left], strict=True)]))
            else:
                kept.append(b" ".join((text or "").encode().split()))
        return pa.Table.from_arrays(
            [rows["doc_id"].cast(schema.field("doc_id").type), pa.array(w.counts()), pa.array(removed.astype(np.int64)), pa.array(kept, pa.binary()).cast(pa.string())],
            ["doc_id", "n_words", "n_removed", "kept"])
    return run


def remove_repeats(
    docs: DataFrame, width: int = WIDTH, minimiser: int = MINIMISER, hot: int = HOT, area: int = AREA, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: each text without the words of windows that occur elsewhere.

    Kept words are joined by one space.  Windows are judged on the input, so all occurrences go.  A null or
    empty text has no words; a text shorter than a window keeps all.  Repeated rows repeat their passages.
    Other columns are ignored, and an empty table gives no rows.
    """
    if not 1 <= minimiser <= width:
        raise ValueError("the minimiser must fit into a window")
    rows = documents(docs, key, text)
    parts = count_chunks(rows)
    chunks = dealt(rows, parts)
    counts = chunks.groupBy("chunk").applyInArrow(_count(width, minimiser, parts), _COUNTS)
    again = counts.groupBy("part").applyInArrow(_again(hot), _AGAIN)
    packed = chunks.groupBy("chunk").cogroup(again.groupBy("chunk")).applyInArrow(_pack(width, minimiser, parts), _PACKED)
    singles = packed.filter("hot").withColumn("area", F.expr(f"chunk div {area}").cast("int"))
    gathered = singles.groupBy("bucket", "area").applyInArrow(_gather(width), _PACKED)
    last = packed.filter("not hot").unionByName(gathered.filter("bucket >= 0"))
    found = last.groupBy("bucket").applyInArrow(_settle(width), _FOUND)
    found = found.unionByName(gathered.filter("bucket < 0").select("chunk", "starts"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])
    return chunks.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(_remove(width, to_arrow_schema(schema)), schema)
