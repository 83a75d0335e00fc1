"""Stream sinks.  Each query has its own checkpoint below one folder."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from jobmart import rules
from jobmart.operators.dedup import content_hash, keep_first
from jobmart.sources.writers import SEARCH_FORMAT
from jobmart.streaming.transforms import EVENT_TIME


def triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """Fixed interval, or everything available once (backfills, tests)."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


LAKE_FOLDERS = ("event_date", "city_label")


def lake_columns(rows: DataFrame) -> DataFrame:
    """Adds the folder columns of the lake: the day of the event and one of a few known cities.

    Free-text places stay in ``location``; they never make a folder of their own.
    """
    known = [label for label, _ in rules.CITIES_STREAM]
    return rows.withColumns({
        "event_date": F.to_date(EVENT_TIME),
        "city_label": F.when(F.col("location").isin(known), F.col("location")).otherwise(rules.PROVINCE_OTHER),
    })


def to_lake(rows: DataFrame, path: str, checkpoint: str, every: str | None = "1 minute") -> StreamingQuery:
    """Parquet by day and city label, written by the file sink."""
    writer = (
        lake_columns(rows).writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .partitionBy(*LAKE_FOLDERS)
    )
    return triggered(writer, every).start()


def lake_batch(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer of the lake: rebalanced, so a folder gets few files, and replay-safe."""
    append = append_batch(path, LAKE_FOLDERS)

    def write(batch: DataFrame, batch_id: int) -> None:
        append(lake_columns(batch).hint("rebalance", *LAKE_FOLDERS), batch_id)

    return write


def search_batch(options: Mapping[str, str]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer of the search index; the document id is the key column, so replays overwrite."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format(SEARCH_FORMAT).mode("append").options(**options).save()

    return write


def console_batch(rows_shown: int = 20) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.show(rows_shown, truncate=False)

    return write


def each(change: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A writer that gets the batch after a change, such as an aggregation."""
    return lambda batch, batch_id: write(change(batch), batch_id)


def to_search_index(
    rows: DataFrame, options: Mapping[str, str], checkpoint: str, every: str | None = "1 minute"
) -> StreamingQuery:
    """Search index; the document id is the key column, so replays overwrite."""
    writer = (
        rows.writeStream.format(SEARCH_FORMAT).outputMode("append")
        .options(**options).option("checkpointLocation", checkpoint)
    )
    return triggered(writer, every).start()


def to_console(rows: DataFrame, checkpoint: str, mode: str = "update", rows_shown: int = 20,
               every: str | None = "1 minute") -> StreamingQuery:
    writer = (
        rows.writeStream.format("console").outputMode(mode)
        .option("truncate", False).option("numRows", rows_shown).option("checkpointLocation", checkpoint)
    )
    return triggered(writer, every).start()


def append_batch(path: str, partition_by: tuple[str, ...] = ()) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer with one folder per batch: a replayed batch replaces itself."""
    def write(batch: DataFrame, batch_id: int) -> None:
        writer = batch.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{path}/batch_id={batch_id}")

    return write


def fan_out(*writers: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Several sinks from one query: the batch is computed and de-duplicated once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        cached = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for one in writers:
                one(cached, batch_id)
        finally:
            cached.unpersist()

    return write


def for_each_batch(
    rows: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append",
    every: str | None = "1 minute",
) -> StreamingQuery:
    writer = rows.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)
    return triggered(writer, every).start()


def latest_by_key(df: DataFrame, keys: list[str], version: str = "batch_id") -> DataFrame:
    """Current rows of a keyed batch log: the newest version per key (upsert on read)."""
    order = [F.col(version).desc(), content_hash(df, skip=[version]).asc()]
    return keep_first(df, keys, order).drop(version)
