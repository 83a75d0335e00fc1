"""Documents dealt into chunks of a few megabytes, each handled as one set of arrays.

A chunk is chosen by a hash of id and text, so no key, source or group of copies gathers in one, and the
number of chunks follows the size of the table.  Inside a chunk the rows are sorted by id and text: every
pass over the chunk sees the same order, so passes can speak about words by their position in it.  (Rows
that are equal in both are interchangeable.)  All passes of a plan share one shuffle of the texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 4 << 20
LEAST_CHUNKS = 64


def count_chunks(docs: DataFrame) -> int:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return size // CHUNK_BYTES + LEAST_CHUNKS


def chunk_of(chunks: int) -> Column:
    return F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int")


def dealt(docs: DataFrame, chunks: int) -> DataFrame:
    """``doc_id, text, chunk``."""
    return docs.select("doc_id", "text", chunk_of(chunks).alias("chunk"))


def in_order(chunk: pa.Table) -> pa.Table:
    return chunk.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def part_of(values: np.ndarray, parts: int) -> np.ndarray:
    """Which of ``parts`` equal ranges of 64-bit values each value is in (rises with the value)."""
    return ((values >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def slices(sorted_parts: np.ndarray) -> list[tuple[int, int, int]]:
    """(part, from, to) of each run in a sorted array."""
    if not len(sorted_parts):
        return []
    heads = np.flatnonzero(np.concatenate(([True], sorted_parts[1:] != sorted_parts[:-1])))
    return list(zip(sorted_parts[heads].tolist(), heads.tolist(), [*heads[1:].tolist(), len(sorted_parts)], strict=True))


def joined(column: pa.ChunkedArray, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """The binary values of a column as one array, and the length of each."""
    parts = [np.frombuffer(x, dtype=dtype) for x in column.to_pylist()]
    return (np.concatenate(parts) if parts else np.empty(0, dtype)), np.array([len(p) for p in parts], dtype=np.int64)


_TYPES = {"boolean": pa.bool_(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<binary>": pa.list_(pa.binary())}


def arrow_table(schema: str, rows: list[tuple]) -> pa.Table:
    """An Arrow table from rows, with the columns of a Spark schema text."""
    fields = [f.strip().split(" ") for f in schema.split(",")]
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.Table.from_arrays([pa.array(c, _TYPES[t]) for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields])
