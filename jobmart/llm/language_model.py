"""Interpolated modified Kneser-Ney bigram model, counted in Spark and memory-mapped by the workers.

Tokens are words and one end per text; a start stands before each text and is only ever a context.

1. Every task counts its tokens; a shuffle by hash range adds them up.  Each range is a part of the model: its
   sorted token hashes are a file, and a token's number is its place in the sorted order of all parts.
2. Every task counts its pairs of token numbers; a shuffle by a hash of the pair adds them up, so a context that
   stands before a third of all tokens is spread like any other.  A part's file holds its sorted pairs and counts.
3. Another shuffle adds up, for each token, how many followers it has once, twice and more often, and in how many
   contexts it stands.
4. Scoring tasks map the files into memory and look tokens and pairs up by binary search.

Everything shuffled is packed in sorted arrays, as differences.  The files lie in the shared folder; a store
that cannot be mapped is copied to the worker's own folder part by part, when a part is first needed.
Discounts come from the counts of counts of all parts.  Writing is repeatable: a lost task writes the same
bytes again.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobmart.llm.chunks import arrow_table, slices
from jobmart.llm.common import documents, small_batches
from jobmart.llm.words import SPACED, mix, words_of
from jobmart.scratch import fresh_path, materialise

PART_BYTES = 16 << 20
LEAST_PARTS = 16
FLUSH = 1 << 21
START, END = np.uint64(0x5354415254000001), np.uint64(0x454E440000000001)

_TOKENS = "part int, hashes binary, counts binary"
_VOCABULARY = "part int, n long, tokens long, starts long"
_PAIRS = "part int, pairs binary, counts binary"
_CONTEXTS = "part int, kind string, tokens binary, counts binary"
_STATS = "part int, stats binary"
_ARRAYS = {"hash": "u8", "count": "u8", "follow": "u4", "before": "u4", "pair": "u8", "times": "u1", "large": "u8", "many": "u8"}


def _split(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{os.path.abspath(path)}")


def _write(path: str, part: int, **arrays: np.ndarray) -> None:
    store, folder = _split(path)
    store.create_dir(folder)
    for name, values in arrays.items():
        target = f"{folder}/{part:06d}.{name}"
        draft = f"{target}.{os.getpid()}-{os.urandom(4).hex()}"
        with store.open_output_stream(draft) as out:
            out.write(np.ascontiguousarray(values, dtype=_ARRAYS[name]))
        store.move(draft, target)


class _Files:
    """Arrays of the model, opened when first needed."""

    def __init__(self, path: str) -> None:
        self.store, self.folder = _split(path)
        self.local = isinstance(self.store, fs.LocalFileSystem)
        self.copies = None if self.local else tempfile.mkdtemp(prefix="model-")
        self.open: dict = {}

    def __call__(self, part: int, name: str) -> np.ndarray:
        if (part, name) not in self.open:
            file = f"{self.folder}/{part:06d}.{name}"
            if not self.local:
                copy = f"{self.copies}/{part:06d}.{name}"
                fs.copy_files(file, copy, source_filesystem=self.store, destination_filesystem=fs.LocalFileSystem())
                file = copy
            empty = os.path.getsize(file) == 0
            self.open[part, name] = np.empty(0, _ARRAYS[name]) if empty else np.memmap(file, dtype=_ARRAYS[name], mode="r")
        return self.open[part, name]


def _deltas(values: np.ndarray) -> bytes:
    return np.diff(values, prepend=values.dtype.type(0)).tobytes()


def _sum_sorted(values: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order with the sums of their counts."""
    value, count = np.concatenate(values), np.concatenate(counts)
    order = np.argsort(value, kind="stable")
    value, count = value[order], count[order].astype(np.uint64)
    heads = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1]))) if len(value) else np.empty(0, np.int64)
    return value[heads], np.add.reduceat(count, heads) if len(heads) else count


def _unpack(rows: pa.Table, name: str, dtype: str) -> tuple[list[np.ndarray], list[np.ndarray]]:
    values = [np.cumsum(np.frombuffer(x, dtype), dtype=dtype) for x in rows[name].to_pylist()]
    return values, [np.frombuffer(x, "u4") for x in rows["counts"].to_pylist()]


def _small(counts: np.ndarray) -> bytes:
    return np.minimum(counts, 2**32 - 1).astype(np.uint32).tobytes()


def _sequence(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each from its start to its end, and where each text begins."""
    w = words_of(column, SPACED, lower=True)
    begin = w.first + 2 * np.arange(w.n_docs + 1)
    out = np.empty(begin[-1], np.uint64)
    out[np.arange(len(w.start)) + 2 * w.doc() + 1] = w.hashes()
    out[begin[:-1]], out[begin[1:] - 1] = START, END
    return out, begin


def _part(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _flushes(batches: Iterator[pa.RecordBatch], take: Callable) -> Iterator[np.ndarray]:
    held, size = [], 0
    for batch in small_batches(batches, 0):
        held.append(take(batch.column(0)))
        size += len(held[-1])
        if size >= FLUSH:
            yield np.concatenate(held)
            held, size = [], 0
    if size:
        yield np.concatenate(held)


def _count_tokens(parts: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens in _flushes(batches, lambda c: _sequence(c)[0]):
            values, counts = np.unique(tokens, return_counts=True)
            rows = [(p, _deltas(values[a:b]), _small(counts[a:b])) for p, a, b in slices(_part(values, parts))]
            yield from arrow_table(_TOKENS, rows).to_batches()
    return run


def _store_tokens(path: str) -> Callable:
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        values, counts = _sum_sorted(*_unpack(rows, "hashes", "u8"))
        _write(path, key[0].as_py(), hash=values, count=counts)
        starts = int(counts[values == START].sum())
        return arrow_table(_VOCABULARY, [(key[0].as_py(), len(values), int(counts.sum()) - starts, starts)])
    return run


class _Vocabulary:
    def __init__(self, path: str, bases: list[int]) -> None:
        self.files, self.bases, self.parts = _Files(path), np.array(bases, np.int64), len(bases) - 1

    def find(self, hashes: np.ndarray, *names: str) -> list[np.ndarray]:
        """Numbers of tokens (-1: unknown), and their values in other arrays (0 if unknown)."""
        distinct, which = np.unique(hashes, return_inverse=True)
        width = {"follow": 3}
        number = np.full(len(distinct), -1, np.int64)
        more = [np.zeros((len(distinct), width[n]) if n in width else len(distinct), np.int64) for n in names]
        for p, a, b in slices(_part(distinct, self.parts)):
            if self.bases[p] < self.bases[p + 1]:
                known = self.files(p, "hash")
                place = np.minimum(np.searchsorted(known, distinct[a:b]), len(known) - 1)
                found = known[place] == distinct[a:b]
                number[a:b] = np.where(found, place + self.bases[p], -1)
                for values, name in zip(more, names, strict=True):
                    stored = self.files(p, name)
                    stored = stored.reshape(-1, width[name]) if name in width else stored
                    values[a:b][found] = stored[place[found]]
        return [number[which], *[values[which] for values in more]]

    def times(self, pairs: np.ndarray) -> np.ndarray:
        """Counts of pairs."""
        out, part = np.zeros(len(pairs), np.int64), _part(mix(pairs), self.parts)
        order = np.argsort(part, kind="stable")
        for p, a, b in slices(part[order]):
            known, i = self.files(p, "pair"), order[a:b]
            if not len(known):
                continue
            place = np.minimum(np.searchsorted(known, pairs[i]), len(known) - 1)
            counted = np.where(known[place] == pairs[i], self.files(p, "times")[place], 0).astype(np.int64)
            if len(large := self.files(p, "large")):
                at = np.minimum(np.searchsorted(large, place), len(large) - 1)
                counted = np.where((counted == 255) & (large[at] == place), self.files(p, "many")[at], counted).astype(np.int64)
            out[i] = counted
        return out


def _count_pairs(path: str, bases: list[int]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _Vocabulary(path, bases)

        def pairs(column: pa.Array) -> np.ndarray:
            tokens, begin = _sequence(column)
            number = vocabulary.find(tokens)[0].astype(np.uint64)
            inner = np.ones(len(tokens), dtype=bool)
            inner[begin[:-1]] = False
            at = np.flatnonzero(inner)
            return (number[at - 1] << np.uint64(32)) | number[at]

        for own in _flushes(batches, pairs):
            values, counts = np.unique(own, return_counts=True)
            part = _part(mix(values), vocabulary.parts)
            order = np.argsort(part, kind="stable")  # keeps the pairs of a part sorted
            values, counts = values[order], counts[order]
            rows = [(p, _deltas(values[a:b]), _small(counts[a:b])) for p, a, b in slices(part[order])]
            yield from arrow_table(_PAIRS, rows).to_batches()
    return run


def _store_pairs(path: str, bases: list[int]) -> Callable:
    """Writes a part's pairs; passes on what they say about their contexts and their tokens."""
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        values, counts = _sum_sorted(*_unpack(rows, "pairs", "u8"))
        large = np.flatnonzero(counts >= 255)
        _write(path, key[0].as_py(), pair=values, times=np.minimum(counts, 255), large=large, many=counts[large])
        stats = np.array([(counts == k).sum() for k in (1, 2, 3, 4)], np.uint32)
        out = [(-1, "stats", None, stats.tobytes())]
        context, begin = np.unique((values >> np.uint64(32)).astype(np.uint32), return_index=True)
        kinds = [np.add.reduceat(mask.astype(np.uint32), begin) if len(begin) else begin for mask in (counts == 1, counts == 2, counts > 2)]
        token, contexts = np.unique((values & np.uint64(0xFFFFFFFF)).astype(np.uint32), return_counts=True)
        for kind, ids, numbers in (("follow", context, np.stack(kinds, axis=1)), ("before", token, contexts)):
            part = np.searchsorted(bases, ids.astype(np.int64), "right") - 1
            out += [(p, kind, _deltas(ids[a:b]), _small(numbers[a:b])) for p, a, b in slices(part)]
        return arrow_table(_CONTEXTS, out)
    return run


def _store_contexts(path: str, bases: list[int]) -> Callable:
    """Writes the numbers of followers and of contexts of a part's tokens."""
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        part = key[0].as_py()
        if part < 0:
            sums = sum(np.frombuffer(x, np.uint32).astype(np.int64) for x in rows["counts"].to_pylist())
            return arrow_table(_STATS, [(part, np.concatenate((sums, [0, 0])).tobytes())])
        n = bases[part + 1] - bases[part]
        sums = {"follow": np.zeros((n, 3), np.uint32), "before": np.zeros(n, np.uint32)}
        for kind, ids, numbers in zip(*(rows[c].to_pylist() for c in ("kind", "tokens", "counts")), strict=True):
            if kind in sums:
                at = np.cumsum(np.frombuffer(ids, np.uint32), dtype=np.uint32).astype(np.int64) - bases[part]
                sums[kind][at] += np.frombuffer(numbers, np.uint32).reshape(len(at), *sums[kind].shape[1:])
        _write(path, part, **sums)
        before = sums["before"]
        return arrow_table(_STATS, [(part, np.array([*[(before == k).sum() for k in (1, 2, 3, 4)], before.sum(), (before > 2).sum()], np.int64).tobytes())])
    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Discounts for counts 1, 2 and more from the counts of counts (Chen and Goodman)."""
    if not n1 or not n2:
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    wanted = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 0.9
    return tuple(min(max(d, 0.1), k - 0.1) for k, d in enumerate(wanted, 1))


@dataclass(frozen=True)
class Model:
    path: str
    bases: tuple[int, ...]
    tokens: int
    types: int
    pair_types: int
    pair_discounts: tuple[float, float, float]
    token_kinds: tuple[int, int, int]  # tokens with 1, 2 and more contexts
    token_discounts: tuple[float, float, float]


def train(docs: DataFrame, path: str | None = None) -> Model:
    """Count ``docs`` (column ``text``; null is empty) and write the model's files to ``path``."""
    spark = docs.sparkSession
    path = path or fresh_path(spark, "language-model")
    texts = docs.select("text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = size // PART_BYTES + LEAST_PARTS
    rows = texts.mapInArrow(_count_tokens(parts), _TOKENS).groupBy("part").applyInArrow(_store_tokens(path), _VOCABULARY)
    found = {r["part"]: r for r in rows.collect()}  # one number for each part
    bases = [0]
    for p in range(parts):
        bases.append(bases[-1] + (found[p]["n"] if p in found else 0))
    if bases[-1] >= 2**32:
        raise ValueError("more distinct tokens than 32-bit numbers can tell apart")
    # Every part gets its files, also one whose tokens are no context or stand in none.
    every = spark.range(parts).select(F.col("id").cast("int").alias("part"))
    nothing = every.select("part", *[F.lit(b"").alias(c) for c in ("pairs", "counts")])
    counted = texts.mapInArrow(_count_pairs(path, bases), _PAIRS).unionByName(nothing)
    pairs = counted.groupBy("part").applyInArrow(_store_pairs(path, bases), _CONTEXTS)
    pairs = pairs.unionByName(every, allowMissingColumns=True)
    stats = materialise(pairs.groupBy("part").applyInArrow(_store_contexts(path, bases), _STATS))
    sums = {True: np.zeros(6, np.int64), False: np.zeros(6, np.int64)}
    for r in stats.collect():  # six numbers for each part
        sums[r["part"] < 0] += np.frombuffer(r["stats"], np.int64)
    return Model(
        path, tuple(bases), sum(r["tokens"] for r in found.values()), max(bases[-1] - 1, 0), int(sums[False][4]),
        discounts(*sums[True][:4].tolist()), tuple(sums[False][[0, 1, 5]].tolist()), discounts(*sums[False][:4].tolist()))


def _score(model: Model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _Vocabulary(model.path, list(model.bases))
        d, e = np.array((0, *model.pair_discounts)), np.array((0, *model.token_discounts))
        n, v = model.tokens, model.types
        spare = float(np.dot(e[1:], model.token_kinds))
        for batch in small_batches(batches, 1):
            tokens, begin = _sequence(batch.column(1))
            number, count, before, follow = vocabulary.find(tokens, "count", "before", "follow")
            inner = np.ones(len(tokens), dtype=bool)
            inner[begin[:-1]] = False
            at = np.flatnonzero(inner)
            base = np.log10((count[at] + 1.0) / (n + v + 1.0))
            if model.pair_types:
                p = (np.maximum(before[at] - e[np.minimum(before[at], 3)], 0) + spare / (v + 1)) / model.pair_types
            else:
                p = np.full(len(at), 1 / (v + 1))
            i = np.flatnonzero(number[at - 1] >= 0)  # known contexts
            context, token = at[i] - 1, at[i]
            known = number[token] >= 0
            times = np.zeros(len(i), np.int64)
            times[known] = vocabulary.times((number[context].astype(np.uint64) << np.uint64(32) | number[token].astype(np.uint64))[known])
            p[i] = (np.maximum(times - d[np.minimum(times, 3)], 0) + (follow[context] @ d[1:]) * p[i]) / count[context]
            owner = np.repeat(np.arange(len(begin) - 1), np.diff(begin) - 1)
            sums = [np.bincount(owner, weights=x, minlength=len(begin) - 1) for x in (base, np.log10(p), count[at] > 0)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(begin) - 1), pa.array(sums[2].astype(np.int64)), pa.array(sums[0]), pa.array(sums[1])],
                ["doc_id", "n_tokens", "n_known", "base_score", "score"])
    return run


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity`` for each row of ``docs``.

    ``score`` is the model's log10 probability of the text, ``base_score`` that of an add-one unigram model, and
    ``perplexity`` is 10 to the power ``-score / n_tokens``.  A null text is the empty text: one token, its end.
    Unknown words share the weight that the discounts free.  Repeated rows are scored alike; other columns
    are ignored.  A model of no documents gives every token the same probability.
    """
    rows = documents(docs, key, text)
    kind = dict(rows.dtypes)["doc_id"]
    scored = rows.mapInArrow(_score(model), f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")
    return scored.withColumn("train_tokens", F.lit(model.tokens).cast("long")).withColumn(
        "perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
