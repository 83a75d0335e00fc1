"""Benchmark decontamination by a broadcast set of test n-grams.

Items are normalised (A-Z to lower case, words of letters and digits) and cut into windows of ``width``
words; a shorter item is one window.  The windows are broadcast as sorted hash arrays with their words, in blocks
of at most ``BLOCK`` windows and ``BLOCK_BYTES`` bytes.  One map pass over the documents rolls a hash over the words of each
whole document; hits are verified word by word.  A task holds about ``HELD_BYTES`` of texts and looks the blocks up
one after the other, each loaded and dropped again, so a benchmark of any size takes the same plan and the same memory.
No document is shuffled or written.

A window carries the number of its item set, not the items: a template that a third of all items share is a number
in the broadcast and in the marks.  ``with_items`` joins the items afterwards, once for each combination of sets.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobmart.llm.common import small_batches
from jobmart.llm.words import ALNUM, Words, rolling, words_of
from jobmart.scratch import materialise

WIDTH = 13
BLOCK = 1 << 17
BLOCK_BYTES = 16 << 20
HELD_BYTES = 16 << 20
_FILTER_BITS = 20


def _cut(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w, ids = words_of(batch.column(1), ALNUM, lower=True), batch.column(0).to_pylist()
            h, rows = w.hashes(), []
            for d, n in enumerate(w.counts()):
                k = min(width, int(n))
                if k:
                    words = [w.text(i).decode() for i in range(w.first[d], w.first[d + 1])]
                    hashes = rolling(h[w.first[d]:w.first[d + 1]], k).view(np.int64)
                    rows += [(k, int(x), " ".join(words[i:i + k]), ids[d]) for i, x in enumerate(hashes)]
            yield pa.RecordBatch.from_pylist([dict(zip(("length", "hash", "words", "item"), r, strict=True)) for r in rows], _WINDOW)
    return run


_WINDOW = pa.schema([("length", pa.int32()), ("hash", pa.int64()), ("words", pa.string()), ("item", pa.string())])


def test_windows(benchmark: DataFrame, width: int = WIDTH, key: str = "item_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``length, hash, words, set``, a row per distinct window, and ``set, items`` (sorted), a row per distinct item set.

    Items without words or text have no window; items without an id count under the empty id.
    """
    source = benchmark.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))
    windows = materialise(source.mapInArrow(_cut(width), "length int, hash long, words string, item string").groupBy("length", "hash", "words").agg(
        F.sort_array(F.collect_set("item")).alias("items")))
    sets = materialise(windows.select("items").distinct().withColumn("set", F.monotonically_increasing_id()))
    return materialise(windows.join(sets, "items").select("length", "hash", "words", "set")), sets


def _packed(rows: pa.Table) -> bytes:
    """A block as arrays: for each window length sorted hashes, sets, and the words one after the other."""
    length, hashes = rows["length"].to_numpy(), rows["hash"].to_numpy().view(np.uint64)
    order = np.lexsort((hashes, length))
    words = [x.encode() for x in rows["words"].take(pa.array(order)).to_pylist()]
    out = io.BytesIO()
    np.savez(out, length=length[order], hashes=hashes[order], sets=rows["set"].to_numpy()[order],
             ends=np.cumsum([len(x) for x in words], dtype=np.int64), words=np.frombuffer(b"".join(words), np.uint8))
    return out.getvalue()


class _Block:
    """Lookup of one block."""

    def __init__(self, packed: bytes) -> None:
        own = np.load(io.BytesIO(packed))
        length, self.hashes, self.sets, self.words = own["length"], own["hashes"], own["sets"], own["words"].tobytes()
        self.ends = np.concatenate(([0], own["ends"]))
        self.ranges = {int(n): (int(np.searchsorted(length, n, "left")), int(np.searchsorted(length, n, "right"))) for n in np.unique(length)}

    def hits(self, w: Words, h: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """First word, length and item set of each test window that occurs."""
        ends = np.repeat(w.first[1:], w.counts())
        for length, (a, b) in self.ranges.items():
            hashes, rolled = self.hashes[a:b], rolling(h, length)
            seen = np.zeros(1 << _FILTER_BITS, dtype=bool)
            seen[hashes >> np.uint64(64 - _FILTER_BITS)] = True
            at = np.flatnonzero(seen[rolled >> np.uint64(64 - _FILTER_BITS)])
            at = at[at + length <= ends[at]]
            place = np.searchsorted(hashes, rolled[at])
            found = hashes[np.minimum(place, len(hashes) - 1)] == rolled[at]
            for i, p in zip(at[found].tolist(), place[found].tolist(), strict=True):
                text = b" ".join(w.text(j) for j in range(i, i + length))
                while p < len(hashes) and hashes[p] == rolled[i]:  # equal hashes stand together
                    if self.words[self.ends[a + p]:self.ends[a + p + 1]] == text:
                        yield i, length, int(self.sets[a + p])
                    p += 1


def _loaded(block: Broadcast) -> _Block:
    """The block, whose bytes the worker does not keep."""
    look = _Block(block.value)
    block.__dict__.pop("_value", None)  # read from the executor's copy again when the next texts come
    return look


def _held(batches: Iterator[pa.RecordBatch], place: int) -> Iterator[list[pa.RecordBatch]]:
    """Small batches, several together up to ``HELD_BYTES`` of text."""
    held, size = [], 0
    for batch in small_batches(batches, place):
        held.append(batch)
        size += batch.column(place).nbytes
        if size >= HELD_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _scan(blocks: list[Broadcast], place: int, keep_text: bool):
    """Appends number of words, hit words (one bit each) and item sets to each row; the text is column ``place``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _held(batches, place):
            state = []
            for batch in held:
                w = words_of(batch.column(place), ALNUM, lower=True)
                state.append((w, w.hashes(), np.zeros(len(w.start) + 1, dtype=np.int32), [set() for _ in range(w.n_docs)]))
            for block in blocks:
                look = _loaded(block)
                for w, h, cover, sets in state:
                    for i, length, number in look.hits(w, h):
                        cover[i] += 1
                        cover[i + length] -= 1
                        sets[int(np.searchsorted(w.first, i, "right")) - 1].add(number)
            for batch, (w, _, cover, sets) in zip(held, state, strict=True):
                hit = np.cumsum(cover[:-1]) > 0
                packed = [np.packbits(hit[a:b]).tobytes() if sets[d] else b"" for d, (a, b) in enumerate(zip(w.first, w.first[1:], strict=False))]
                kept = [i for i in range(batch.num_columns) if keep_text or i != place]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i) for i in kept], pa.array(w.counts(), pa.int64()), pa.array(packed, pa.binary()),
                     pa.array([sorted(s) for s in sets], pa.list_(pa.int64()))],
                    [*[batch.schema.names[i] for i in kept], "_n", "_hits", "_sets"])
    return run


_ADDED = ("_n", "_hits", "_sets")


def _mark(docs: DataFrame, windows: DataFrame, block: int, text: str, keep_text: bool) -> DataFrame:
    spark = docs.sparkSession
    names = [c for c in docs.columns if c not in _ADDED]
    source = docs.select(*[F.col(f"`{c}`").alias(f"d_{i}") for i, c in enumerate(names)])
    place = names.index(text)
    schema = T.StructType([f for i, f in enumerate(source.schema.fields) if keep_text or i != place] + [
        T.StructField("_n", T.LongType()), T.StructField("_hits", T.BinaryType()), T.StructField("_sets", T.ArrayType(T.LongType()))])
    total, size = windows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("words")), F.lit(0))).first()
    parts = max(1, -(-total // block), -(-size // BLOCK_BYTES))
    blocks = []
    for b in range(parts):  # the driver holds one block at a time
        rows = windows.filter(F.pmod(F.xxhash64("hash"), F.lit(parts)) == b).toArrow()
        blocks.append(spark.sparkContext.broadcast(_packed(rows)))
    marked = source.mapInArrow(_scan(blocks, place, keep_text), schema)
    return marked.select(*[F.col(f"d_{i}").alias(c) for i, c in enumerate(names) if keep_text or i != place], *_ADDED)


def mark(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block: int = BLOCK, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``_n`` (words), ``_hits`` (a bit per word, empty without a hit) and ``_sets`` (numbers of item sets).

    A null text has no words.  Columns of those three names are replaced.  Rows are kept as they are,
    repeated ones too; an empty benchmark gives no hits.
    """
    return _mark(docs, test_windows(benchmark, width)[0], block, text, keep_text)


def mark_items(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block: int = BLOCK, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``_n``, ``_hits`` and ``_items``: the sorted ids of all items of which a window occurs.

    The items are put together once for each different combination of sets, then joined to the rows, which have no text.
    """
    windows, sets = test_windows(benchmark, width)
    marked = materialise(_mark(docs, windows, block, text, keep_text=False))
    combinations = marked.select(F.col("_sets").alias("_combination")).filter(F.size("_combination") > 0).distinct()
    items = combinations.withColumn("set", F.explode("_combination")).join(sets, "set").groupBy("_combination").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("_items"))
    none = marked.filter(F.size("_sets") == 0).withColumn("_items", F.array().cast("array<string>"))  # most rows: not sent to one key
    joined = marked.join(items, F.col("_sets") == F.col("_combination")).drop("_combination")
    return none.unionByName(joined).drop("_sets")


def n_hit() -> Column:
    """Number of hit words of a row: the bits that are set."""
    bits = F.create_map(*[x for i in range(16) for x in (F.lit(f"{i:X}"), F.lit(i.bit_count()))])
    return F.aggregate(
        F.split(F.hex("_hits"), ""), F.lit(0).cast("long"), lambda total, digit: total + F.coalesce(bits[digit], F.lit(0)))


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, share: int = 20, remove: str = "documents") -> DataFrame:
    """``docs`` without contamination, columns unchanged.

    A document is contaminated if it has hit words and they are at least one in ``share`` of its words.
    ``remove="documents"`` drops contaminated documents and leaves the others alone; ``"spans"`` cuts the
    hit words out of every text.
    """
    names = docs.columns
    place = names.index("text")
    columns = [F.col(f"c_{i}").alias(c) for i, c in enumerate(names)]
    marked = mark(docs.select(*[F.col(f"`{c}`").alias(f"c_{i}") for i, c in enumerate(names)]), benchmark, width, text=f"c_{place}")
    if remove == "spans":
        return marked.mapInArrow(_cut_spans(place, len(names) + 1), marked.schema).select(*columns)
    return marked.filter(~contaminated(share)).select(*columns)


def contaminated(share: int = 20) -> Column:
    return (n_hit() > 0) & (share * n_hit() >= F.col("_n"))


def _cut_spans(at: int, hits: int):
    """Cuts the hit words out of column ``at``; their bits are column ``hits``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, w = batch.column(at).to_pylist(), words_of(batch.column(at), ALNUM)
            base = np.concatenate(([0], np.cumsum([len((t or "").encode()) for t in texts])))
            for d, packed in enumerate(batch.column(hits).to_pylist()):
                if packed:
                    a, b = w.first[d], w.first[d + 1]
                    hit = np.unpackbits(np.frombuffer(packed, np.uint8))[:b - a].astype(bool)
                    raw, pieces, last = texts[d].encode(), [], 0
                    for i in np.flatnonzero(hit):
                        pieces.append(raw[last:w.start[a + i] - base[d]])
                        last = w.end[a + i] - base[d]
                    texts[d] = (b"".join(pieces) + raw[last:]).decode()
            yield batch.set_column(at, batch.schema.names[at], pa.array(texts, batch.schema.field(at).type))
    return run


def digest(items: str = "_items") -> Column:
    """SHA-256 of the comma-joined ids."""
    return F.sha2(F.array_join(items, ","), 256)
