"""Stream jobs: source → decode → enrich → de-duplicate → sinks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from jobmart import schemas
from jobmart.sources import readers
from jobmart.streaming import recovery, sinks, transforms


def adverts_from_messages(raw: DataFrame, exact: bool = True, delay: str = "1 hour") -> DataFrame:
    """``value`` bytes → enriched, de-duplicated adverts."""
    messages = readers.good_messages(readers.decode_messages(raw, schemas.STREAM_MESSAGE))
    rows = transforms.enrich(messages)
    return transforms.dedup_exact(rows, delay) if exact else transforms.dedup_within_delay(rows, delay)


def start(
    rows: DataFrame,
    checkpoint: str,
    lake: str | None = None,
    search: Mapping[str, str] | None = None,
    console: bool = False,
    counts: str | None = None,
    every: str | None = "1 minute",
) -> list[StreamingQuery]:
    """Start one query that feeds all wanted sinks; leave out ``lake`` for a local trial run.

    Each batch is decoded, enriched and de-duplicated once.  ``counts`` is a log of sliding-window counts per
    batch: their sums per window are the totals, and a replayed batch replaces its own part.
    """
    writers = []
    if lake:
        writers.append(sinks.lake_batch(lake))
    if search:
        writers.append(sinks.search_batch(search))
    if console:
        writers.append(sinks.each(transforms.sliding_counts, sinks.console_batch()))
    if counts:
        writers.append(sinks.each(transforms.sliding_counts, sinks.append_batch(counts)))
    if not writers:
        return []
    return [sinks.for_each_batch(rows, sinks.fan_out(*writers), f"{checkpoint}/all", every=every)]


def run_until_one_stops(
    spark: SparkSession, raw: DataFrame, checkpoint: str, lake: str | None = None,
    search: Mapping[str, str] | None = None, counts: str | None = None, console: bool = True, every: str = "1 minute",
) -> list[dict]:
    """Adverts from ``raw`` messages (a topic or landed files) to all sinks under supervision; reports how the queries ended."""
    rows = adverts_from_messages(raw)
    return recovery.supervise(spark, {
        "adverts": lambda: start(rows, checkpoint, lake=lake, search=search, console=console, counts=counts, every=every)[0]})


def rows_dropped_as_late(query: StreamingQuery) -> int:
    """Late rows dropped so far, summed over the stateful operators of recent micro-batches."""
    return sum(
        operator.get("numRowsDroppedByWatermark", 0)
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )
