"""Row policies, column grants and result caps on views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RolePolicy:
    """What a role may see: SQL predicate and columns per table (all columns when empty)."""

    filters: Mapping[str, str] = field(default_factory=dict)
    columns: Mapping[str, Sequence[str]] = field(default_factory=dict)
    tables: Sequence[str] = ()

    def allows(self, table: str) -> Column:
        """Whether the role sees a row; an unknown predicate does not count as true."""
        return F.coalesce(F.expr(self.filters[table]), F.lit(False)) if table in self.filters else F.lit(True)


def _either(conditions: Sequence[Column]) -> Column:
    out = F.lit(False)
    for condition in conditions:
        out = out | condition
    return out


def apply_row_policy(
    df: DataFrame, table: str, policies: Sequence[RolePolicy], restrictions: Sequence[str] = (),
) -> DataFrame:
    """Rows and columns of ``table`` for a user with these roles.

    Roles are alternatives (the default mode): a row is seen if one of them allows it, and in that row a
    column is seen if a role that allows *this row* grants it; else it is NULL.  Columns that no role grants
    are left out.  ``restrictions`` are predicates for everyone: all of them must hold besides.  No role with
    a grant on the table means no access.
    """
    granted = [p for p in policies if table in p.tables]
    if not granted:
        raise PermissionError(f"no role grants access to {table}")
    rows = _either([p.allows(table) for p in granted])
    for restriction in restrictions:
        rows = rows & F.coalesce(F.expr(restriction), F.lit(False))
    shown = []
    for name in df.columns:
        seers = [p for p in granted if not p.columns.get(table) or name in p.columns[table]]
        if len(seers) == len(granted):
            shown.append(F.col(f"`{name}`"))
        elif seers:
            shown.append(F.when(_either([p.allows(table) for p in seers]), F.col(f"`{name}`")).alias(name))
    return df.filter(rows).select(*shown)


def secured_view(
    df: DataFrame, view: str, table: str, policies: Sequence[RolePolicy], restrictions: Sequence[str] = (),
) -> DataFrame:
    """Register the permitted part of ``df``, all of it, as a view."""
    permitted = apply_row_policy(df, table, policies, restrictions)
    permitted.createOrReplaceTempView(view)
    return permitted


def capped_result(df: DataFrame, rows: int, order: Sequence[Column | str]) -> DataFrame:
    """The first ``rows`` rows of a finished result, in a total order: what a report shows."""
    return df.orderBy(*order).limit(rows)
