"""Exact duplicates, with the frequent texts split off by a heavy-hitter summary.

1. One pass over the texts writes a table of SHA-256 digests to the shared folder; everything after
   works on that table.
2. Misra-Gries: every task keeps at most ``capacity`` counters.  The summed counters of all tasks are
   at most the true counts and miss at most ``rows / (capacity + 1)``, so every digest with more than
   ``2 * rows / capacity`` rows is among the ``capacity`` at most whose sum is ``rows / capacity`` or more.
3. An exact count of those candidates gives the winners (the row that stays and the group's size).  There
   are at most ``capacity`` of them, so they are broadcast, and the rows of frequent texts leave the
   plan on the map side.
4. Only the other digests are shuffled; none of them has more than ``2 * rows / capacity`` rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobmart.llm.common import documents
from jobmart.scratch import materialise

CAPACITY = 1024
_SUMMARY = "digest binary, n long"


def _summary(batches: Iterator[pa.RecordBatch], capacity: int) -> Iterator[pa.RecordBatch]:
    """Misra-Gries counters of one task: whenever there are too many, all sink by the largest that goes."""
    keys, counts = np.empty(0, dtype="V32"), np.empty(0, dtype=np.int64)
    for batch in batches:
        column = batch.column(0)
        raw = np.frombuffer(b"".join(column.to_pylist()), dtype="V32")
        both = np.concatenate((keys, raw))
        weights = np.concatenate((counts, np.ones(len(raw), dtype=np.int64)))
        lanes = both.view(np.uint64).reshape(-1, 4)
        order = np.lexsort(lanes.T)
        lanes, weights = lanes[order], weights[order]
        new = np.ones(len(both), dtype=bool)
        new[1:] = (lanes[1:] != lanes[:-1]).any(axis=1)
        heads = np.flatnonzero(new)
        keys, counts = both[order][heads], np.add.reduceat(weights, heads) if len(heads) else weights
        if len(keys) > capacity:
            counts = counts - np.partition(counts, -capacity - 1)[-capacity - 1]
            keys, counts = keys[counts > 0], counts[counts > 0]
    yield pa.RecordBatch.from_arrays([pa.array([k.tobytes() for k in keys], pa.binary()), pa.array(counts)], ["digest", "n"])


def frequent(digests: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Digests that may have more than ``2 * rows / capacity`` rows: at most ``capacity``, none missing."""
    rows = digests.count()
    return (
        digests.select("digest").mapInArrow(lambda batches: _summary(batches, capacity), _SUMMARY)
        .groupBy("digest").agg(F.sum("n").alias("n"))
        .filter(F.col("n") * capacity >= rows).select("digest")
    )


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """For each row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their bytes are; a null text is the empty text.  The row with the largest id
    stays (a null id is smaller than any other).  Of rows that repeat both id and text, one stays and
    the others go.  An empty table gives no rows.  Other columns are ignored.
    """
    digests = materialise(
        documents(docs, key, text).select(
            "doc_id", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    best = F.max(F.struct("doc_id", "row")).alias("best")
    candidates = F.broadcast(frequent(digests, capacity))  # at most `capacity` rows
    winners = materialise(
        digests.join(candidates, "digest", "left_semi").groupBy("digest").agg(best, F.count("*").alias("group_size"))
    )
    placed = digests.join(F.broadcast(winners), "digest", "left")
    rest = placed.filter(F.col("best").isNull()).select("digest", "doc_id", "row")
    groups = rest.groupBy("digest").agg(best, F.count("*").alias("group_size"))
    return placed.filter(F.col("best").isNotNull()).unionByName(rest.join(groups, "digest")).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )
