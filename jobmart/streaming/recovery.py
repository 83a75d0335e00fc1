"""Streams that go on where they stopped: late rows kept apart, the newest row per key, visible state, supervised queries."""

from __future__ import annotations

import sys
import threading
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.utils import AnalysisException

from jobmart.operators.dedup import content_hash
from jobmart.streaming.transforms import EVENT_TIME

# Send the Python functions of this module to executors by value: they need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Writer = Callable[[DataFrame, int], None]


# ---- late rows -------------------------------------------------------------------------


def _mark_before(spark: SparkSession, marks: str, batch_id: int):
    """Largest event time of all batches before ``batch_id``: kept with the batch before, else sought in all."""
    for path in (f"{marks}/batch_id={batch_id - 1}", marks):
        try:
            rows = spark.read.schema("mark timestamp, batch_id long").parquet(path)
            rows = rows.filter(F.col("batch_id") < batch_id) if path == marks else rows
            return rows.agg(F.max("mark")).first()[0]
        except AnalysisException:
            continue
    return None


def split_late(on_time: Writer, late: Writer, marks: str, delay: str, time: str = EVENT_TIME) -> Writer:
    """``foreachBatch`` writer that gives rows behind the watermark to ``late`` instead of dropping them.

    A row is late if its event time is more than ``delay`` before the newest of all earlier batches, which is the
    rule of Spark's watermark.  The newest time is kept below ``marks`` by batch, so a restart or a replayed
    batch splits in the same way.  Rows without event time are on time.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _mark_before(spark, marks, batch_id)
        border = F.lit(before).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        cached = batch.withColumn("_late", F.coalesce(F.col(time) < border, F.lit(False))).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            on_time(cached.filter(~F.col("_late")).drop("_late"), batch_id)
            late(cached.filter("_late").drop("_late"), batch_id)
            mark = cached.agg(F.greatest(F.max(F.col(time).cast("timestamp")), F.lit(before).cast("timestamp")).alias("mark"))
            mark.write.mode("overwrite").parquet(f"{marks}/batch_id={batch_id}")
        finally:
            cached.unpersist()

    return write


# ---- newest row per key ----------------------------------------------------------------


def keep_newest(rows: DataFrame, key: str = "url", time: str = EVENT_TIME, delay: str = "1 hour", keep: str = "1 day") -> DataFrame:
    """A row per key whenever a newer one than all before arrives (output mode ``update``).

    The state of a key is the time and content hash of its newest row; of equal times the smaller hash counts.  A timer
    forgets a key ``keep`` after its newest row, by the watermark; a later row of it is newer in any case, because
    older ones are behind the watermark by then.  ``sinks.latest_by_key`` on the output has the newest of all.
    """
    schema = rows.schema
    keep_ms = int(pd.Timedelta(keep).total_seconds() * 1000)
    given = rows.withColumns({"_time": F.unix_micros(F.col(time).cast("timestamp")), "_tie": content_hash(rows)}).withWatermark(time, delay)

    def newest(_: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = state.get if state.exists else None
        best = None
        for part in parts:
            part = part[part["_time"].notna()]
            if len(part):
                first = part.sort_values(["_time", "_tie"], ascending=[False, True]).iloc[:1]
                rank = (int(first["_time"].iloc[0]), -int(first["_tie"].iloc[0]))
                if (held is None or rank > (held[0], -held[1])) and (best is None or rank > best[0]):
                    best = (rank, first)
        if best is not None:
            (at, tie), row = best
            state.update((at, -tie))
            state.setTimeoutTimestamp(max(at // 1000, state.getCurrentWatermarkMs()) + keep_ms)
            yield row[[f.name for f in schema]]

    return given.groupBy(key).applyInPandasWithState(newest, schema, "at long, tie long", "update", "EventTimeTimeout")


# ---- visible state ---------------------------------------------------------------------


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """What a query's stateful operator holds after its last batch: ``key``, ``value`` and the partition."""
    return spark.read.format("statestore").option("operatorId", operator).load(checkpoint)


# ---- supervision -----------------------------------------------------------------------


class Progress(StreamingQueryListener):
    """Rows and batches by query id, and how queries ended, as the listener bus tells."""

    def __init__(self) -> None:
        self.rows: dict[str, int] = {}
        self.batches: dict[str, int] = {}
        self.ended: dict[str, str | None] = {}
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self._changed:
            own = str(event.progress.id)
            if event.progress.numInputRows:
                self.rows[own] = self.rows.get(own, 0) + event.progress.numInputRows
                self.batches[own] = self.batches.get(own, 0) + 1

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self.ended[str(event.id)] = event.exception
            self._changed.notify_all()

    def wait_for(self, ids: Iterable[str], seconds: float = 30) -> None:
        wanted = set(ids)
        with self._changed:
            self._changed.wait_for(lambda: wanted <= self.ended.keys(), seconds)


def supervise(
    spark: SparkSession, starts: Mapping[str, Callable[[], StreamingQuery]], drained: bool = False, every: float = 0.5,
) -> list[dict]:
    """Run the queries until one ends, and end the others; a report for each: name, state, rows, batches, error.

    States: ``failed``, ``ended`` (by itself) and ``stopped`` (because another one was over).  ``drained`` stops a query as
    soon as it has used up what is there when it is looked at, in the order given, and goes on with the others.
    A query that cannot be started counts as failed.
    """
    listener, running, errors = Progress(), {}, {}
    spark.streams.addListener(listener)
    try:
        for name, start in starts.items():
            try:
                running[name] = start()
            except Exception as problem:  # noqa: BLE001  the report tells
                errors[name] = str(problem)
                break
        own_end: set[str] = set()
        while running and not errors and not own_end:
            if drained:
                for name, query in running.items():
                    try:
                        query.processAllAvailable()
                    except Exception as problem:  # noqa: BLE001
                        errors[name] = str(problem)
                        break
                break
            own_end = {n for n, q in running.items() if not q.isActive}
            if not own_end:
                next(iter(running.values())).awaitTermination(every)
        for name, query in running.items():
            if not query.isActive and query.exception() is not None:
                errors.setdefault(name, str(query.exception()))
            query.stop()
        listener.wait_for([str(q.id) for q in running.values()])
    finally:
        spark.streams.removeListener(listener)
    report = []
    for name in starts:
        query = running.get(name)
        own = str(query.id) if query else None
        state = "failed" if name in errors else "ended" if name in own_end else "stopped"
        report.append({"name": name, "state": state, "rows": listener.rows.get(own, 0), "batches": listener.batches.get(own, 0), "error": errors.get(name)})
    return report


def report_rows(spark: SparkSession, report: Sequence[Mapping]) -> DataFrame:
    return spark.createDataFrame([tuple(r[c] for c in ("name", "state", "rows", "batches", "error")) for r in report], T.StructType.fromDDL(
        "name string, state string, rows long, batches long, error string"))
