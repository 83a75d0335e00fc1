"""Chat formatting of conversations that were logged as growing snapshots.

Turns are gathered into one row per conversation.  A running hash over role and text of the turns gives a
hash for every prefix; the prefix hash at full length stands for the whole conversation.  A conversation
goes if a longer one has its hash among its proper prefixes (anti join), and of equal conversations the
smallest id stays.  What is left is maximal and is rendered.  Only DataFrame functions are used.

Gathering and hashing happen once: the distinct conversations are written to the shared folder with their prefix
hashes, and the proper prefixes are read from there as a column of digests without any text.  A conversation is one
value, so its turns have to fit in a task's memory; its prefix hashes take 32 bytes a turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmart.scratch import materialise

TURN = "<|{role}|>\n{text}<|end|>\n"


def _turn_hashes(turns: Column) -> Column:
    """Chained digest of each prefix: every digest covers the one before it, the role and the text."""
    step = lambda acc, t: F.concat(
        acc, F.array(F.sha2(F.concat(F.coalesce(F.element_at(acc, -1), F.lit("")), F.to_json(F.struct(t["role"], t["text"]))), 256)))
    return F.filter(F.aggregate(turns, F.array(F.lit("").cast("string")), step), lambda h: h != "")


def gather(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, turns`` in order of turn, role and text (nulls first).

    Turns without a conversation id belong to none: each is a conversation of its own with a null id.
    Repeated rows (same id, turn, role and text) are one turn that was logged twice.
    """
    one = F.struct("turn", "role", "text")
    rows = turns.select("conv_id", one.alias("t"))
    known = rows.filter(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(F.sort_array(F.collect_set("t")).alias("turns"))
    return known.unionByName(rows.filter(F.col("conv_id").isNull()).select("conv_id", F.array("t").alias("turns")))


def maximal(conversations: DataFrame) -> DataFrame:
    """Rows of ``conv_id, turns`` that no longer conversation starts with, one of each set of equal ones."""
    hashes = F.transform(_turn_hashes(F.col("turns")), lambda h: F.unhex(h))
    hashed = conversations.withColumn("prefixes", hashes)
    whole = F.element_at("prefixes", -1)
    # Equal conversations may be a third of all: the smallest is found with partial aggregates.
    distinct = hashed.groupBy(whole.alias("whole")).agg(
        F.min_by(F.struct("conv_id", "turns", "prefixes"), F.struct(F.col("conv_id").isNull(), "conv_id")).alias("c"),
        F.count("*").alias("n_equal"))
    distinct = materialise(distinct.select(
        "whole", "c.conv_id", "c.turns", F.slice("c.prefixes", 1, F.size("c.prefixes") - 1).alias("proper"), "n_equal"))
    proper = distinct.select(F.explode("proper").alias("whole")).distinct()
    return distinct.drop("proper").join(proper, "whole", "left_anti").select("conv_id", "turns", "n_equal")


def render(conversations: DataFrame, template: str = TURN) -> DataFrame:
    """``conv_id, n_turns, n_equal, text``.  A missing role is ``unknown``, a missing text is empty."""
    before, rest = template.split("{role}")
    between, after = rest.split("{text}")
    turn = lambda t: F.concat(
        F.lit(before), F.coalesce(t["role"], F.lit("unknown")), F.lit(between), F.coalesce(t["text"], F.lit("")), F.lit(after))
    return conversations.select(
        "conv_id", F.size("turns").alias("n_turns"), "n_equal", F.array_join(F.transform("turns", turn), "").alias("text"))


def format_chats(turns: DataFrame, template: str = TURN) -> DataFrame:
    """Maximal conversations of a turn log, rendered.  An empty log gives no rows; other columns are ignored."""
    return render(maximal(gather(turns)), template)
