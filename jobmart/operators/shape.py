"""Projections, filters, defaults, schema harmonisation and unions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobmart import rules, schemas


def to_display(df: DataFrame, names: Mapping[str, str] = schemas.DISPLAY_NAMES) -> DataFrame:
    """Canonical columns in display order under their display names."""
    return df.select(*[F.col(c).alias(shown) for c, shown in names.items() if c in df.columns])


def with_text_defaults(df: DataFrame, defaults: Mapping[str, object] = rules.FILL_DEFAULTS) -> DataFrame:
    return df.fillna({c: v for c, v in defaults.items() if c in df.columns})


def with_empty_arrays(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({
        c: F.coalesce(F.col(c), F.array().cast(df.schema[c].dataType)) for c in columns
    })


def placeholder_to_null(c: Column, placeholder: str = rules.PLACEHOLDER) -> Column:
    return F.nullif(c, F.lit(placeholder))


def require(df: DataFrame, columns: Sequence[str] = tuple(rules.REQUIRED)) -> DataFrame:
    """Rows in which every column of ``columns`` is present."""
    return df.dropna(subset=list(columns))


def map_fields(df: DataFrame, column: str, fields: Mapping[str, str]) -> DataFrame:
    """Columns from a map or struct column, field name → output name (names may hold blanks)."""
    data_type = df.schema[column].dataType
    if isinstance(data_type, T.MapType):
        pick = lambda name: F.try_element_at(F.col(column), F.lit(name))
    else:
        present = set(data_type.names)
        pick = lambda name: (
            F.col(column).getField(name) if name in present else F.lit(None).cast("string")
        )
    return df.select(*[pick(name).alias(shown) for name, shown in fields.items()])


def harmonise_columns(
    df: DataFrame,
    aliases: Mapping[str, Sequence[str]] = rules.COLUMN_ALIASES,
    derive: Mapping[str, Callable[[set[str]], Column | None]] | None = None,
) -> DataFrame:
    """Bring alternative column names to canonical ones, or derive a column that is missing.

    Decided from the column names alone, so it costs no job.  The first present alias wins.
    """
    present = set(df.columns)
    for canonical, names in aliases.items():
        if canonical in present:
            continue
        derived = (derive or {}).get(canonical)
        value = derived(present) if derived else None
        if value is not None:
            df = df.withColumn(canonical, value)
        else:
            name = next((n for n in names if n in present), None)
            if name is None:
                continue
            df = df.withColumnRenamed(name, canonical)
            present.discard(name)
        present.add(canonical)
    return df


def salary_midpoint(low: str = "salary_min", high: str = "salary_max") -> Callable[[set[str]], Column | None]:
    """Rule for ``harmonise_columns``: mean of the two bounds when both columns exist."""
    def rule(present: set[str]) -> Column | None:
        if {low, high} <= present:
            return (F.col(low).cast("double") + F.col(high).cast("double")) / 2
        return None

    return rule


def with_salary_label(
    df: DataFrame, low: str = "salary_min", high: str = "salary_max", label: str = "salary_label"
) -> DataFrame:
    """Rows with two positive bounds, and their mean as label."""
    known = df.filter((F.col(low) > 0) & (F.col(high) > 0))
    return known.withColumn(label, (F.col(low).cast("double") + F.col(high).cast("double")) / 2)


def union_sources(sources: Iterable[DataFrame]) -> DataFrame:
    """Union by column name; a column a source lacks is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


def preview(df: DataFrame, rows: int = 20) -> DataFrame:
    return df.limit(rows)
