"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of a text in the sense of ``[^\x20\x09-\x0D]+``.
WORD = r"[^\x20\x09-\x0D]+"


def documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The two columns an operator works on, under fixed names that nothing else clashes with."""
    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))


def remainder(column: Column, modulus: int) -> Column:
    """``crc32(text of the column) mod modulus``; a null counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % modulus


def unit(key: Column, seed: str) -> Column:
    """A number in (0, 1) that only depends on the key and the seed: 52 bits of MD5."""
    digest = F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit("")))), 1, 13)
    return (F.conv(digest, 16, 10).cast("double") + 0.5) / float(2**52)


def small_batches(batches: Iterator[pa.RecordBatch], text: int | str, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text, so the arrays of a batch stay small.

    A single longer text is a batch of its own; no text is cut.
    """
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0)
        begin = held = 0
        for i, n in enumerate(lengths.to_pylist()):
            if held + n > size and i > begin:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += n
        if begin < batch.num_rows:
            yield batch.slice(begin)
