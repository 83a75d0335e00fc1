"""Lists, key/value items, descriptions, titles and links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobmart import rules
from jobmart.functions.text import blank_to_null, strip


def clean_items(items: Column) -> Column:
    """array<string> → stripped, non-empty items; NULL → empty array."""
    kept = F.filter(F.transform(items, strip), lambda x: x != "")
    return F.coalesce(kept, F.array().cast("array<string>"))


def benefit_titles(benefits: Column, title_field: str = "tieu_de") -> Column:
    """array<struct<title, …>> → stripped, non-empty titles; NULL → empty array."""
    return clean_items(F.transform(benefits, lambda b: b.getField(title_field)))


def items_text(items: Column, default: str = rules.NO_INFORMATION) -> Column:
    """Items joined with ", ", or a default text when there are none."""
    return F.coalesce(blank_to_null(F.array_join(items, ", ")), F.lit(default))


def shorten_description(c: Column, bullets: int = 5) -> Column:
    """First line plus the first bullet lines ("•")."""
    lines = F.split(c, "\n")
    listed = F.slice(F.filter(lines, lambda x: F.startswith(strip(x), F.lit("•"))), 1, bullets)
    short = F.concat(F.get(lines, F.lit(0)), F.lit("\n"), F.array_join(listed, "\n"))
    return F.when(c != "", strip(short))


def split_items(c: Column, separator: str = ",") -> Column:
    return F.transform(F.split(c, separator), strip)


def key_value_map(items: Column) -> Column:
    """``["Key name: value", …]`` → map; keys lower case with "_", last value of a key wins."""
    pairs = F.filter(
        F.transform(
            items,
            lambda x: F.struct(
                F.regexp_replace(F.lower(strip(F.get(F.split(x, ":", 2), F.lit(0)))), " ", "_").alias("key"),
                strip(F.get(F.split(x, ":", 2), F.lit(1))).alias("value"),
            ),
        ),
        lambda p: p["value"].isNotNull(),
    )
    last = F.filter(
        pairs,
        lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["key"] == p["key"]),
    )
    return F.map_from_entries(last)


def label_value(
    labels: Column, values: Column, label: str, exclude: Sequence[str] = ()
) -> Column:
    """Value whose label contains ``label``, the last one if several do."""
    pairs = F.arrays_zip(labels.alias("label"), values.alias("value"))
    hits = F.filter(pairs, lambda p: p["label"].contains(label))
    for other in exclude:
        hits = F.filter(hits, lambda p, other=other: ~p["label"].contains(other))
    return F.try_element_at(hits, F.lit(-1))["value"]


def strip_new_marker(title: Column) -> Column:
    """Remove the "Mới"/"New" badge in front of a title."""
    return F.regexp_replace(title, r"^(Mới|New)\s+", "")


def absolute_url(href: Column, base: str, cut: str | None = None) -> Column:
    """Put the site in front of a relative link; ``cut`` drops the suffix that starts there."""
    link = F.substring_index(href, cut, 1) if cut else href
    return F.when(F.startswith(link, F.lit("/")), F.concat(F.lit(base), link)).otherwise(link)


def row_json() -> Column:
    return F.to_json(F.struct("*"))


def row_hash(*columns: Column) -> Column:
    """SHA-256 over the columns joined with "||"; with a NULL among them, over their JSON array, which shows where."""
    texts = [c.cast("string") for c in columns]
    whole = F.forall(F.array(*texts), lambda t: t.isNotNull())
    return F.sha2(F.when(whole, F.concat_ws("||", *texts)).otherwise(F.to_json(F.array(*texts))), 256)


def round_to_ten_thousand(c: Column) -> Column:
    return F.round(c, -4)
