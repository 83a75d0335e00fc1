"""Physical plans as rows, and a guard for those that will not scale."""

from __future__ import annotations

import io
import re
from collections.abc import Sequence
from contextlib import redirect_stdout
from dataclasses import dataclass

from pyspark.sql import DataFrame

#: Operators that pair all rows of their sides.
PAIRING = ("CartesianProduct", "BroadcastNestedLoopJoin")


@dataclass(frozen=True)
class Node:
    """An operator of a plan; the last two are told by scans only."""

    number: int
    operator: str
    pushed: tuple[str, ...] = ()
    columns: tuple[str, ...] = ()


def plan_nodes(df: DataFrame) -> list[Node]:
    """The operators of the plan that ``df`` would run, with what its scans filter and read."""
    shown = io.StringIO()
    with redirect_stdout(shown):
        df.explain("formatted")
    nodes = []
    for block in re.split(r"\n\s*\n", shown.getvalue()):
        head = re.match(r"\s*\((\d+)\) ([^\n\[]+)", block)
        if head:
            pushed = re.search(r"^PushedFilters: \[(.*)\]$", block, re.M)
            read = re.search(r"^ReadSchema: struct<(.*)>$", block, re.M)
            nodes.append(Node(
                int(head[1]), head[2].strip(), tuple(_split(pushed[1])) if pushed else (),
                tuple(x.partition(":")[0] for x in _split(read[1])) if read else ()))
    return nodes


def _split(text: str) -> list[str]:
    """Parts between the commas outside brackets."""
    parts, depth = [""], 0
    for ch in text:
        depth += (ch in "<([") - (ch in ">)]")
        if ch == "," and not depth:
            parts.append("")
        else:
            parts[-1] += ch
    return [p.strip() for p in parts if p.strip()]


def objections(df: DataFrame, columns: Sequence[str] | None = None, filtered: bool = False) -> list[str]:
    """Why a plan should not run on large tables; empty if nothing is against it.

    Pairing joins always count.  ``columns``: those that scans may read at most; ``filtered``: whether every scan must
    have a pushed filter.
    """
    found = []
    for node in plan_nodes(df):
        if node.operator.startswith(PAIRING):
            found.append(f"({node.number}) {node.operator} pairs all rows")
        if node.operator.startswith("Scan"):
            if columns is not None and (more := [c for c in node.columns if c not in columns]):
                found.append(f"({node.number}) {node.operator} reads {', '.join(more)} besides")
            if filtered and not node.pushed:
                found.append(f"({node.number}) {node.operator} has no pushed filter")
    return found


def guard(df: DataFrame, columns: Sequence[str] | None = None, filtered: bool = False) -> DataFrame:
    """``df``, or an error that tells the objections."""
    if against := objections(df, columns, filtered):
        raise ValueError("; ".join(against))
    return df
