"""Approximate nearest neighbours by an inverted multi-index.

Vectors are cut into two halves, each quantised by a codebook of its own; a pair of centroids is a cell.  The inner
product of a query with a cell is the sum of those with its two centroids, so cells come in falling order from
two sorted lists by a heap (the pair after ``(a, b)`` is ``(a + 1, b)`` or ``(a, b + 1)``).

Two rounds find the neighbours, and every vector of a visited cell is reranked by its exact inner product:

1. Each query pops cells until they hold ``FIRST`` vectors.  The worst of its best ``k`` found bounds the answer from below.
2. It visits the cells whose sum is at most ``margin`` below that bound.

``margin`` is measured: ``TRIALS`` sampled vectors pass the first round too, their true neighbours among all rows are
found by one pass over the index, and with the margin the share ``COVER`` of them is found.  So the rows that a query reads follow from the data: few where vectors form
clusters, and a large part where they spread evenly and no index can tell neighbours apart.  With at most
``FIRST`` vectors the result is exact.

Equal vectors are one entry with their least ids, found before anything is compared.  Cells are packed into
buckets of about equal size, and a cell too large for one is spread over several, which its queries all visit.
A task holds the vectors of one bucket and lets its queries pass in batches.  The codebooks are fitted to at most
``SAMPLE`` vectors; every row is indexed.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobmart.scratch import materialise

K = 20
SAMPLE = 20_480
MOST_CENTROIDS = 256
STEPS = 10
FIRST = 1024
TRIALS = 256
COVER = 0.96
#: Vectors in a bucket, and the least number of buckets.
BUCKET = 8192
LEAST_BUCKETS = 64


@dataclass(frozen=True)
class Index:
    """Codebooks of both halves, and where the vectors of each cell are: ``blocks`` buckets from ``bucket`` on."""

    left: np.ndarray
    right: np.ndarray
    counts: np.ndarray
    bucket: np.ndarray
    blocks: np.ndarray

    def products(self, vector: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.left.shape[1]
        return self.left @ vector[:half], self.right @ vector[half:]


def centroids(rows: np.ndarray, k: int, steps: int = STEPS) -> np.ndarray:
    """k-means of the rows, begun with rows at even distances; a centroid without rows takes the worst placed one."""
    out = rows[np.arange(k) * len(rows) // k].copy()
    for _ in range(steps):
        at, off = assign(rows, out)
        counts = np.bincount(at, minlength=k)
        sums = np.zeros_like(out)
        np.add.at(sums, at, rows)
        out = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], out)
        empty = np.flatnonzero(counts == 0)
        out[empty] = rows[np.argsort(-off, kind="stable")[:len(empty)]]
    return out


def assign(rows: np.ndarray, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row, and the squared distance to it."""
    far = (codebook**2).sum(axis=1) - 2 * (rows @ codebook.T)
    at = far.argmin(axis=1)
    return at, far[np.arange(len(rows)), at] + (rows**2).sum(axis=1)


def best_cells(left: np.ndarray, right: np.ndarray, counts: np.ndarray, enough: int) -> list[int]:
    """Cells by falling sum ``left[i] + right[j]`` until they hold ``enough`` vectors.  Empty cells are left out."""
    by_left, by_right = np.argsort(-left, kind="stable").tolist(), np.argsort(-right, kind="stable").tolist()
    a_side, b_side, size = left[by_left].tolist(), right[by_right].tolist(), counts.tolist()
    heap, held, out, width = [(-(a_side[0] + b_side[0]), 0, 0)], 0, [], len(b_side)
    while heap and held < enough:
        _, a, b = heapq.heappop(heap)
        cell = by_left[a] * width + by_right[b]
        if size[cell]:
            out.append(cell)
            held += size[cell]
        if b + 1 < width:
            heapq.heappush(heap, (-(a_side[a] + b_side[b + 1]), a, b + 1))
        if b == 0 and a + 1 < len(a_side):  # each pair is pushed once: along its row, rows from the first column
            heapq.heappush(heap, (-(a_side[a + 1] + b_side[0]), a + 1, 0))
    return out


def exact(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products row by row, summed from the first component to the last whatever stands beside the row."""
    return np.cumsum(left * right, axis=1)[:, -1]


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors stored as bytes."""
    return np.array([np.frombuffer(b, dtype=np.float64) for b in column.to_pylist()])


def usable(vector: Column) -> Column:
    """Whether a vector takes part: no null or non-finite component, and not all zero."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good & F.exists(vector, lambda x: x != 0), F.lit(False))


def _pack(rows: DataFrame) -> DataFrame:
    """Vectors as bytes of doubles: what is shuffled afterwards is no list of boxed values."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vector = batch.column("vector")
            flat, at = vector.values.to_numpy(zero_copy_only=False) + 0.0, vector.offsets.to_numpy()  # -0 becomes 0
            packed = [flat[a:b].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("asks"), pa.array(packed, pa.binary())], ["id", "asks", "vector"])

    return rows.mapInArrow(pack, "id long, asks boolean, vector binary")


def _top(rows: DataFrame, k: int, by: str = "query") -> DataFrame:
    """The best ``k`` of each query; Spark cuts to them before it shuffles."""
    order = Window.partitionBy(by).orderBy(F.col("score").desc(), "least", "entry")
    return rows.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k).drop("_n")


_SCORED = "query long, entry long, least long, score double"
_PROBE = "bucket int, entry long, least long, vector binary, cells binary, asks boolean"


def _best_rows(scores: np.ndarray, least: np.ndarray, k: int) -> list[np.ndarray]:
    """For each row of ``scores`` the columns that can be among its best ``k``: ties with the last one included."""
    if scores.shape[1] <= k:
        return [np.arange(scores.shape[1])] * len(scores)
    bound = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
    slack = 1e-9 * np.maximum(1.0, np.abs(bound))  # fast products may differ from `exact` in the last bits
    return [np.flatnonzero(row >= low) for row, low in zip(scores, bound - slack, strict=True)]


def _answer(queries: np.ndarray, numbers: list[int], vectors: np.ndarray, entries: np.ndarray, least: np.ndarray, may: np.ndarray | None, k: int) -> pa.RecordBatch:
    """The best ``k`` entries for each query; ``may``: which pairs are looked at (all without it)."""
    scores = queries @ vectors.T
    if may is not None:
        scores = np.where(may, scores, -np.inf)
    out: list[list[np.ndarray]] = [[], [], [], []]
    for i, near in enumerate(_best_rows(scores, least, k)):
        near = near[scores[i, near] > -np.inf]
        score = exact(np.broadcast_to(queries[i], (len(near), queries.shape[1])), vectors[near]) if len(near) else np.empty(0)
        best = np.lexsort((entries[near], least[near], -score))[:k]
        for column, values in zip(out, (np.full(len(best), numbers[i]), entries[near][best], least[near][best], score[best]), strict=True):
            column.append(values)
    kinds = (np.int64, np.int64, np.int64, np.float64)
    columns = [pa.array(np.concatenate([np.empty(0, t), *c]).astype(t)) for c, t in zip(out, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, ["query", "entry", "least", "score"])


def _scan(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows in the order of bucket, vectors before queries: a bucket's vectors are kept while its queries pass."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held, ready = None, [], None
        for batch in batches:
            of, asks = batch.column("bucket").to_numpy(), batch.column("asks").to_numpy(zero_copy_only=False)
            heads = np.flatnonzero(np.concatenate(([True], (of[1:] != of[:-1]) | (asks[1:] != asks[:-1])))).tolist() if len(of) else []
            for lo, hi in zip(heads, [*heads[1:], len(of)], strict=True):
                part = batch.slice(lo, hi - lo)
                if of[lo] != bucket:
                    bucket, held, ready = of[lo], [], None
                if not asks[lo]:
                    held.append(part)
                    continue
                if ready is None:
                    rows = pa.Table.from_batches(held) if held else None
                    ready = rows and (
                        _matrix(rows["vector"]), rows["entry"].to_numpy(), rows["least"].to_numpy(),
                        np.frombuffer(b"".join(rows["cells"].to_pylist()), dtype=np.int32))
                if not ready:
                    continue
                vectors, entries, least, cell = ready
                known, local = np.unique(cell, return_inverse=True)
                for lo2 in range(0, part.num_rows, 256):
                    some = part.slice(lo2, 256)
                    visits = np.zeros((some.num_rows, len(known) + 1), dtype=bool)
                    for i, c in enumerate(some.column("cells").to_pylist()):
                        wanted = np.frombuffer(c, dtype=np.int32)
                        at = np.searchsorted(known, wanted)
                        at[known[np.minimum(at, len(known) - 1)] != wanted] = len(known)
                        visits[i, at] = True
                    yield _answer(_matrix(some.column("vector")), some.column("entry").to_pylist(), vectors, entries, least, visits[:, local], k)

    return scan


def _probes(index: Index, choose: Callable[[np.ndarray, np.ndarray, float | None], np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A row for each bucket that a query (rows ``entry, vector, bound``) visits, with the cells it wants there."""
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for number, packed, bound in zip(*(batch.column(c).to_pylist() for c in ("entry", "vector", "bound")), strict=True):
                cells = choose(*index.products(np.frombuffer(packed, dtype=np.float64)), bound)
                blocks = index.blocks[cells]
                ahead = np.repeat(np.cumsum(blocks) - blocks, blocks)
                bucket = np.repeat(index.bucket[cells], blocks) + np.arange(int(blocks.sum())) - ahead
                order = np.argsort(bucket, kind="stable")
                bucket, cell = bucket[order], np.repeat(cells, blocks)[order].astype(np.int32)
                heads = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else np.empty(0, np.int64)
                rows += [(int(bucket[a]), number, 0, packed, cell[a:b].tobytes(), True)
                         for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(bucket)][:len(heads)], strict=True)]
                if len(rows) >= 4096:
                    yield _probe_batch(rows)
                    rows = []
            yield _probe_batch(rows)

    return probe


_PROBE_TYPES = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.bool_())
_PROBE_NAMES = ["bucket", "entry", "least", "vector", "cells", "asks"]


def _probe_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(_PROBE_TYPES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _PROBE_TYPES, strict=True)], _PROBE_NAMES)


def _cells(codebooks: tuple[np.ndarray, np.ndarray], rows: np.ndarray) -> np.ndarray:
    left, right = codebooks
    return assign(rows[:, :left.shape[1]], left)[0] * len(right) + assign(rows[:, left.shape[1]:], right)[0]


def _fit(entries: DataFrame, total: int, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Codebooks from at most ``sample`` entries, the first by a hash of the vector."""
    some = entries.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(sample).toArrow()
    rows = _matrix(some["vector"])
    k = int(min(MOST_CENTROIDS, len(rows), max(4, 2 ** round(np.log2(max(total, 1) / 4) / 2))))
    half = rows.shape[1] // 2
    return centroids(rows[:, :half], k), centroids(rows[:, half:], k)


def _layout(codebooks: tuple[np.ndarray, np.ndarray], placed: DataFrame, total: int) -> Index:
    """Buckets of about equal size: small cells share one in order, large ones have several."""
    cells = len(codebooks[0]) * len(codebooks[1])  # at most MOST_CENTROIDS squared
    counts = np.zeros(cells, dtype=np.int64)
    for r in placed.groupBy("cell").count().toArrow().to_pylist():
        counts[r["cell"]] = r["count"]
    most = -(-total // (total // BUCKET + LEAST_BUCKETS))
    blocks = np.maximum(1, -(-counts // most))
    small = np.where(blocks == 1, counts, 0)
    shared = np.cumsum(small) // most
    large = blocks > 1
    bucket = shared.copy()
    bucket[large] = int(shared.max(initial=0)) + 1 + np.cumsum(blocks[large]) - blocks[large]
    return Index(*codebooks, counts, bucket, blocks)


def _true_neighbours(placed: DataFrame, trials: DataFrame, k: int) -> pa.Table:
    """Exact search for a bounded number of vectors: the best ``k`` entries of all, with their cells as ``least``."""
    some = trials.toArrow()
    queries, numbers = _matrix(some["vector"]), some["entry"].to_pylist()

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cell = batch.column("cell").to_numpy().astype(np.int64)
            new = _answer(queries, numbers, _matrix(batch.column("vector")), batch.column("entry").to_numpy(), cell, None, k)
            rows = pa.Table.from_batches([new] if kept is None else [kept, new]).combine_chunks()
            query, score = rows["query"].to_numpy(), rows["score"].to_numpy()
            order = np.lexsort((-score, query))
            first = np.searchsorted(query[order], query[order], side="left")
            kept = rows.take(order[np.arange(len(order)) - first < k]).combine_chunks().to_batches()[0]
        if kept is not None:
            yield kept

    return _top(placed.mapInArrow(best, _SCORED), k).toArrow()


def _margin(true: pa.Table, begun: pa.Table, trials: pa.Table, index: Index, k: int, cover: float) -> float:
    """How far below its bound a query must go to have the share ``cover`` of its true neighbours.

    ``trials``: rows ``entry, vector, bound``; ``begun``: what their first round found, which needs no second one.
    """
    query, entry, cell, score = (true[c].to_numpy() for c in ("query", "entry", "least", "score"))
    known = set(zip(begun["query"].to_pylist(), begun["entry"].to_pylist(), strict=True))
    short = []
    for number, packed, bound in zip(*(trials[c].to_pylist() for c in ("entry", "vector", "bound")), strict=True):
        left, right = index.products(np.frombuffer(packed, dtype=np.float64))
        own = np.flatnonzero((query == number) & (entry != number))
        own = own[np.argsort(-score[own], kind="stable")][:k]
        at = cell[own]
        missing = np.array([(number, e) not in known for e in entry[own].tolist()], dtype=bool)
        short.append(np.where(missing, -np.inf if bound is None else bound - left[at // len(right)] - right[at % len(right)], -np.inf))
    below = np.concatenate([np.empty(0), *short])
    return float(np.quantile(below, cover, method="higher")) if len(below) else 0.0


def search(
    table: DataFrame, asks: Column, k: int = K, key: str = "vec_id", vector: str = "embedding",
    first: int = FIRST, sample: int = SAMPLE, trials: int = TRIALS, cover: float = COVER,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``table`` where ``asks`` holds, the ``k`` rows of largest inner product found.

    ``key`` is an integer column, ``vector`` an array of numbers; ``score`` is the inner product in double precision, summed
    in the order of the components; of equal scores the smaller id comes first.  A row is never its own neighbour;
    rows that repeat id and vector count once, and of rows that share an id only, each asks and is found by itself,
    but not by the others of its id.  Rows without an id, and null, zero or not wholly finite vectors take no part,
    nor do vectors of another length than most.  Fewer than ``k`` candidates give fewer rows, no queries none.
    """
    spark = table.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = table.select(F.col(key).cast("long").alias("id"), F.coalesce(asks, F.lit(False)).alias("asks"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("vector")))
    length = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.col("count").desc(), F.col("length").desc()).first()
    if length is None:
        return empty
    rows = materialise(_pack(rows.filter(F.size("vector") == length["length"])))
    by = Window.partitionBy("vector").orderBy("id")
    least = rows.select("id", "vector").withColumn("_n", F.dense_rank().over(by)).filter(F.col("_n") <= k + 1)  # k besides the query itself
    entries = least.groupBy("vector").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    entries = materialise(entries.withColumn("entry", F.monotonically_increasing_id()))
    total = entries.count()
    queries = rows.filter("asks").select("id", "vector").distinct()
    queries = materialise(queries.join(entries.select("entry", "vector"), "vector").select("id", "entry", "vector"))

    codebooks = _fit(entries, total, sample)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.append_column("cell", pa.array(_cells(codebooks, _matrix(batch.column("vector"))).astype(np.int32)))

    placed = entries.select("entry", F.get("ids", F.lit(0)).alias("least"), "vector").mapInArrow(place, "entry long, least long, vector binary, cell int")
    placed = materialise(placed)
    index = _layout(codebooks, placed, total)
    tried = materialise(placed.select("entry", "vector").orderBy(F.xxhash64("vector"), "vector").limit(trials))

    def bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, entry = batch.column("cell").to_numpy(), batch.column("entry").to_numpy()
            bucket = index.bucket[cell] + entry % index.blocks[cell]
            packed = [c.tobytes() for c in cell.astype(np.int32)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket.astype(np.int32)), batch.column("entry"), batch.column("least"), batch.column("vector"), pa.array(packed, pa.binary()), pa.array(np.zeros(len(cell), bool))],
                _PROBE_NAMES)

    stored = placed.mapInArrow(bucketed, _PROBE)
    buckets = int((index.bucket + index.blocks).max())
    distinct = queries.groupBy("entry").agg(F.first("vector").alias("vector"))  # a vector that many ask with is looked up once

    def visit(asking: DataFrame, choose: Callable[[np.ndarray, np.ndarray, float | None], np.ndarray]) -> DataFrame:
        probes = asking.mapInArrow(_probes(index, choose), _PROBE)
        both = stored.unionByName(probes).repartition(buckets, "bucket").sortWithinPartitions("bucket", "asks")
        return materialise(_top(both.mapInArrow(_scan(k + 1), _SCORED), k + 1))

    def begin(left: np.ndarray, right: np.ndarray, _: float | None) -> np.ndarray:
        return np.array(best_cells(left, right, index.counts, first), dtype=np.int64)

    def rest(left: np.ndarray, right: np.ndarray, bound: float | None) -> np.ndarray:
        low = -np.inf if bound is None else bound - margin
        return np.flatnonzero(((left[:, None] + right[None, :]).ravel() >= low) & (index.counts > 0))

    asking = distinct.unionByName(tried).dropDuplicates(["entry"]).withColumn("bound", F.lit(None).cast("double"))
    near = visit(asking, begin)
    bounds = near.groupBy("query").agg(F.when(F.count("*") > k, F.min("score")).alias("bound")).withColumnRenamed("query", "entry")  # itself and k others
    begun = near.select("query", "entry").join(tried.select(F.col("entry").alias("query")), "query", "left_semi").toArrow()
    margin = _margin(_true_neighbours(placed, tried, k + 1), begun, tried.join(bounds, "entry", "left").toArrow(), index, k, cover)
    bounds = distinct.join(bounds, "entry", "left")
    near = _top(near.unionByName(visit(bounds, rest)).dropDuplicates(["query", "entry"]), k + 1)
    named = near.join(entries.select("entry", "ids"), "entry").select("query", "score", F.explode("ids").alias("least"), "entry")
    listed = _top(named, k + 1).groupBy("query").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), F.col("least").alias("id")))).alias("found"))
    answers = queries.select("id", F.col("entry").alias("query")).join(listed, "query")
    own = F.slice(F.filter("found", lambda x: x["id"] != F.col("id")), 1, k)
    return answers.select(F.col("id").alias("query_id"), F.posexplode(own).alias("pos", "x")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.minus")).alias("score"))
