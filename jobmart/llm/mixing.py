"""Mixing sources to target weights by weighted sampling without replacement.

Every source gets a target of words; sources stop at ``MOST`` times their size and what they cannot take
is shared again by weight.  A source takes complete epochs first.  What is left of its target is filled in
the order of Efraimidis-Spirakis keys ``-ln(u) / weight`` (``u`` from a hash of the id, ``weight`` from the
document's quality): every document is taken that still fits when its turn comes.

In that order the gap only shrinks, so a document that was too long stays out, and the fill falls into passes.
A pass takes all documents of at most its gap up to the first that exceeds what is left, where the next pass
begins; the fill ends when a pass meets no such document.  With keys in random order what is left falls by a
factor in each pass, so there are few.  The result of a pass is one row per source (gap, beginning, end): what is
taken is a test on a document's own key and size, and no text moves to be told.

The prefix sums are two-level, so a source with a third of all rows is not sorted in one task: sums by
key range first, then a sort of the one range where the budget ends.  Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobmart.llm.common import WORD, unit
from jobmart.scratch import materialise

MOST = 3
RANGES = 1024
BROADCAST_SOURCES = 20_000
#: Weights of so many documents are broadcast (an id and a number each); more are joined by a shuffle.
BROADCAST_WEIGHTS = 1_000_000
#: Sources are catalogue entries that one task can order; more than these raise an error.
MOST_SOURCES = 1_000_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cycling_weights(sources: DataFrame, cycle: int = 3) -> DataFrame:
    """Weights 1, 2, …, ``cycle``, repeating, over the sources by code point, null last.

    The one window without a partition runs over the sources (catalogue entries), not over rows of data.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    return sources.withColumn("weight", ((F.row_number().over(order) - 1) % cycle + 1).cast("double"))


def targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """Adds ``target`` to rows ``source, source_size, weight``.

    Resharing until none is above its limit ends where all sources that are not at their limit have the
    same target per weight.  Sorted by limit per weight, those at their limit come first, so running
    sums give that level without iterating.
    """
    limit, ratio = F.col("source_size") * most, F.col("source_size") * most / F.col("weight")
    whole = Window.partitionBy()
    before = Window.orderBy("_ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0.0)
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("_limit").over(before), none)) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), none))
    first = F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_level"))).over(whole)
    return (
        sources.withColumns({"_limit": limit, "_ratio": ratio}).withColumn("_level", level)
        .withColumn("_level", first["_level"])
        .withColumn("target", F.least(F.col("_limit").cast("double"), F.col("_level") * F.col("weight")))
        .drop("_limit", "_ratio", "_level")
    )


def _by_source(rows: DataFrame, sources: DataFrame, name: str) -> DataFrame:
    """Join on the source; ``sources`` is broadcast if it has few rows, which is looked up first."""
    if sources.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        sources = F.broadcast(sources)
    return rows.join(sources, F.col("source").eqNullSafe(F.col(name))).drop(name)


def _pass(rows: DataFrame) -> DataFrame:
    """``source, spent, end`` of one pass over open ``rows`` (source, size, spot, range, gap; none longer than its gap).

    ``end`` is the spot of the first document that does not fit, null if all do.
    """
    sums = rows.groupBy("source", "range", "gap").agg(F.sum("size").alias("range_size"))
    upto = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = materialise(sums.withColumn("ahead", F.sum("range_size").over(upto) - F.col("range_size")))
    beyond = F.col("ahead") + F.col("range_size") > F.col("gap")
    ends = sums.filter(beyond & (F.col("ahead") <= F.col("gap"))).select(
        F.col("source").alias("e_source"), F.col("range").alias("e_range"), "ahead")
    within = Window.partitionBy("source", "range").orderBy("spot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = (
        rows.join(ends, F.col("source").eqNullSafe(F.col("e_source")) & (F.col("range") == F.col("e_range")))
        .withColumn("upto", F.col("ahead") + F.sum("size").over(within)).withColumn("out", F.col("upto") > F.col("gap"))
        .groupBy(F.col("source").alias("l_source")).agg(
            F.max(F.when(~F.col("out"), F.col("upto"))).alias("within"), F.min(F.when(F.col("out"), F.col("spot"))).alias("end"))
    )
    whole = sums.groupBy("source").agg(F.sum(F.when(~beyond, F.col("range_size"))).alias("whole"))
    return whole.join(last, F.col("source").eqNullSafe(F.col("l_source")), "left").select(
        "source", F.coalesce("within", "whole", F.lit(0)).alias("spent"), "end")


def _fill(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """``source, passes``: the passes that fill the budgets (source, gap) from ``rows`` (source, size, spot, range).

    A row is taken if its spot lies between ``begin`` and ``end`` of a pass (null: open) and its size is at most the pass's ``gap``.
    """
    state = budgets.withColumn("begin", F.lit(None).cast(rows.schema["spot"].dataType))
    passes = None
    while True:
        given = state.select(F.col("source").alias("b_source"), "gap", "begin")
        rows = materialise(_by_source(rows.select("source", "size", "spot", "range"), given, "b_source").filter(
            (F.col("size") <= F.col("gap")) & (F.col("begin").isNull() | (F.col("spot") > F.col("begin")))).drop("begin"))
        done = _pass(rows).withColumnRenamed("source", "d_source")
        new = materialise(state.join(done, F.col("source").eqNullSafe(F.col("d_source"))).select("source", "gap", "begin", "end", "spent"))
        passes = new if passes is None else passes.unionByName(new)
        state = new.filter(F.col("end").isNotNull()).select("source", (F.col("gap") - F.col("spent")).alias("gap"), F.col("end").alias("begin"))
        if state.isEmpty():
            return passes.groupBy("source").agg(F.collect_list(F.struct("gap", "begin", "end")).alias("passes"))


def _is_taken(passes: Column, size: Column, spot: Column) -> Column:
    return F.coalesce(F.exists(passes, lambda p: (size <= p["gap"]) & (p["begin"].isNull() | (spot > p["begin"])) & (p["end"].isNull() | (spot < p["end"]))), F.lit(False))


def _decided(docs: DataFrame, kept: list[str], quality: DataFrame | None, weights: DataFrame | None, most: int, seed: str) -> DataFrame:
    """The columns ``kept`` as ``d_0, d_1, ...``, and ``id, size, source_size, target, epochs, picked``."""
    rows = docs.select(
        *[F.col(f"`{c}`").alias(f"d_{i}") for i, c in enumerate(kept)], F.col("doc_id").alias("id"), F.col("source").alias("source"),
        word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("digest"))
    weight = F.lit(1.0)
    if quality is not None:
        best = quality.groupBy(F.col("doc_id").alias("q_id")).agg(F.max("quality").cast("double").alias("quality")).filter("quality > 0 AND quality <> 1")
        best = materialise(best)
        if best.limit(BROADCAST_WEIGHTS + 1).count() <= BROADCAST_WEIGHTS:
            best = F.broadcast(best)
        rows = rows.join(best, F.col("id") == F.col("q_id"), "left").drop("q_id")
        weight = F.coalesce("quality", F.lit(1.0))
    whose = F.coalesce(F.col("id").cast("string"), F.hex("digest"))  # rows without an id are told apart by their text
    whole = materialise(rows.withColumns({"key": -F.log(unit(whose, seed)) / weight, "row": F.monotonically_increasing_id()}))
    spot = F.struct("key", "id", "size", "digest", "row")  # a total order, the same in every run but for rows that are equal
    sources = whole.groupBy("source").agg(F.sum("size").alias("source_size"))
    if weights is None:
        sources = cycling_weights(sources)
    else:
        given = weights.select(F.col("source").alias("_s"), F.col("weight").cast("double"))
        sources = sources.join(given, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    sources = materialise(sources)
    if sources.count() > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    plan = materialise(
        targets(sources, most).withColumn(
            "epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("gap", F.col("target") - F.col("epochs") * F.col("source_size"))
    )  # one row per source
    open_rows = whole.filter("size > 0").select("source", "size", spot.alias("spot"), F.floor(RANGES * (1 - F.exp(-F.col("key")))).alias("range"))
    passes = _fill(open_rows, plan.select("source", "gap")).withColumnRenamed("source", "f_source")
    numbers = materialise(plan.join(passes, F.col("source").eqNullSafe(F.col("f_source")), "left").select(
        F.col("source").alias("p_source"), "source_size", "target", "epochs", "passes"))
    return _by_source(whole, numbers, "p_source").withColumn("picked", (F.col("size") > 0) & _is_taken(F.col("passes"), F.col("size"), spot))


def mix(
    docs: DataFrame, quality: DataFrame | None = None, weights: DataFrame | None = None, most: int = MOST,
    seed: str = "mix", whole_rows: bool = True,
) -> DataFrame:
    """``docs`` with ``size, source_size, target, epochs, picked`` (in the fractional part) and ``taken``.

    ``quality``: rows (doc_id, quality), positive weights of documents; the highest counts, and documents
    without one weigh 1.  ``weights``: rows (source, weight); ``cycling_weights`` without it.
    ``whole_rows=False`` returns only ``doc_id`` and the new columns, and writes no texts on the way; else
    columns that have a new column's name are replaced.

    A null source is a source of its own, a null text has no words, and a document without words is
    taken 0 times.  Repeated rows are documents of their own.  The same rows give the same mix whatever
    their partitions.  An empty table gives no rows.
    """
    added = ["size", "source_size", "target", "epochs", "picked", "taken"]
    kept = [c for c in docs.columns if c not in added] if whole_rows else []
    decided = _decided(docs, kept, quality, weights, most, seed).withColumn("taken", F.col("size") * (F.col("epochs") + F.col("picked").cast("long")))
    names = [F.col(f"d_{i}").alias(c) for i, c in enumerate(kept)] if whole_rows else [F.col("id").alias("doc_id")]
    return decided.select(*names, *added)


def mixed(docs: DataFrame, quality: DataFrame | None = None, weights: DataFrame | None = None, most: int = MOST, seed: str = "mix") -> DataFrame:
    """The mix itself: every row of ``docs`` as often as ``mix`` takes it, with all its own columns and no others."""
    decided = _decided(docs, docs.columns, quality, weights, most, seed)
    times = (F.col("epochs") + F.col("picked").cast("long")).cast("int")
    copies = decided.filter((F.col("size") > 0) & (times > 0)).withColumn("copy", F.explode(F.sequence(F.lit(1), times)))
    return copies.select(*[F.col(f"d_{i}").alias(c) for i, c in enumerate(docs.columns)])
