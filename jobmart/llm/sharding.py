"""Shard placement by a lookup table that the shards fill in turns.

Every shard has its own order of preference over the slots of a prime-sized table: start and step come
from a hash of its name, and a prime size makes every step visit all slots.  The shards take turns; each
claims the first free slot of its order, until no slot is left.  All shards own the same number of slots,
give or take one, and when a shard is added or lost few of the other slots change owner.

The table depends on the shard names only, never on the data: at least 100 slots for each shard.  It is
broadcast, and placing a row is one lookup by the hash of its key.
"""

from __future__ import annotations

from collections.abc import Sequence

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS_PER_SHARD = 100


def prime_from(n: int) -> int:
    """The smallest prime that is at least ``n``."""
    n = max(n, 2)
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:13], 16)


def fill_table(names: Sequence[str], slots: int) -> list[int]:
    """Owner of each slot, as a position in ``names``.  ``slots`` must be prime."""
    start = [_number("start " + name) % slots for name in names]
    step = [_number("step " + name) % (slots - 1) + 1 for name in names]
    owner, seen, left = [-1] * slots, [0] * len(names), slots
    while left:
        for i in range(len(names)):
            if not left:
                break
            while owner[slot := (start[i] + seen[i] * step[i]) % slots] >= 0:
                seen[i] += 1
            owner[slot] = i
            left -= 1
    return owner


def slot_of(key: Column, slots: int) -> Column:
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") % slots


def lookup_table(spark: SparkSession, names: Sequence[str], slots: int | None = None) -> DataFrame:
    if not names or len(set(names)) < len(names):
        raise ValueError("shards need distinct names")
    slots = prime_from(SLOTS_PER_SHARD * len(names)) if slots is None else slots
    rows = [(slot, i, names[i]) for slot, i in enumerate(fill_table(names, slots))]
    return spark.createDataFrame(rows, "_slot long, _shard int, _shard_name string")


def shard_names(n: int) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def assign_shards(
    docs: DataFrame, names: Sequence[str], key: str = "doc_id", text: str = "text",
    columns: tuple[str, str, str] = ("slot", "shard", "shard_name"),
) -> DataFrame:
    """``docs`` with its slot, shard number and shard name; columns of those names are replaced.

    Rows without a key are placed by a hash of their text, so a third of all keys being null does not
    fill one shard; rows without both share a slot.  Repeated rows get the same shard.  No shuffle.
    """
    slots = prime_from(SLOTS_PER_SHARD * len(names))
    table = F.broadcast(lookup_table(docs.sparkSession, names, slots))  # `slots` rows, set by the names alone
    by = F.coalesce(F.col(key).cast("string"), F.sha2(F.col(text), 256), F.lit(""))
    kept = [c for c in docs.columns if c not in columns]
    return (
        docs.select(*[F.col(f"`{c}`") for c in kept], slot_of(by, slots).alias("_slot")).join(table, "_slot")
        .select(*[F.col(f"`{c}`") for c in kept],
                *[F.col(a).alias(b) for a, b in zip(("_slot", "_shard", "_shard_name"), columns, strict=True)])
    )
