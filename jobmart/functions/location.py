"""Address → province, city or region."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobmart import rules
from jobmart.functions.text import Rules, first_label, strip, title_case


def province(
    c: Column, legacy: bool = False, table: Sequence[tuple[str, str]] = tuple(rules.PROVINCES),
    otherwise: str = rules.PROVINCE_OTHER,
) -> Column:
    """63 province labels by the first keyword contained in the address, else "Khác".

    ``legacy`` keeps the rule order in which "vinh" hides "trà vinh".
    """
    ordered = table if legacy else rules.with_trap_rules_first(list(table))
    return first_label(c, [(label, [word]) for word, label in ordered], otherwise)


def city_five(c: Column, table: Rules = tuple(rules.CITIES_FIVE)) -> Column:
    """Five large cities, "Tỉnh thành khác" for the rest, "Không xác định" for NULL."""
    return F.when(c.isNull(), rules.UNKNOWN_VI).otherwise(
        first_label(c, table, rules.CITIES_FIVE_OTHER)
    )


def city_by_pattern(c: Column) -> Column:
    """Hồ Chí Minh City and Hà Nội by pattern after removing "." and ","; the rest is kept."""
    text = strip(F.translate(F.lower(c), ".,", "  "))
    (hcm, hcm_pattern), (hanoi, hanoi_pattern) = rules.CITY_PATTERNS
    return F.when(text.rlike(hcm_pattern), hcm).when(text.rlike(hanoi_pattern), hanoi).otherwise(c)


def city_stream(c: Column, table: Rules = tuple(rules.CITIES_STREAM)) -> Column:
    """Stream variant with "Remote"; other places in title case, missing ones "Khác"."""
    return F.when(c.isNull() | (c == ""), rules.PROVINCE_OTHER).otherwise(
        first_label(c, table, title_case(c))
    )


def city_english(c: Column, table: Rules = tuple(rules.CITIES_ENGLISH)) -> Column:
    """English labels; other places in title case, NULL gives "Unknown"."""
    return F.when(c.isNull(), "Unknown").otherwise(
        first_label(c, table, title_case(strip(c)))
    )


def collapse_city_aliases(c: Column) -> Column:
    return F.when(c.isin(rules.CITY_ALIASES), rules.CITY_ALIAS_LABEL).otherwise(c)


def region(province_label: Column) -> Column:
    """North / Central / South of a province label; NULL for "Khác" and unknown labels."""
    known = sorted({label for _, label in rules.PROVINCES})
    return (
        F.when(province_label.isin(rules.REGION_NORTH), "North")
        .when(province_label.isin(rules.REGION_CENTRAL), "Central")
        .when(province_label.isin(known), "South")
    )


def partition_safe(c: Column) -> Column:
    """Keep letters a-z, digits, blanks, dots and dashes only."""
    return F.regexp_replace(c, r"[^a-zA-Z0-9\s.-]", "")


def split_city_address(c: Column) -> Column:
    """``"- Hà Nội: Số 1 …"`` → struct(city, address); no colon means address only."""
    parts = F.split(c, ":", 2)
    has_city = F.size(parts) == 2
    return F.struct(
        F.when(has_city, strip(F.regexp_replace(F.get(parts, F.lit(0)), "-", ""))).alias("city"),
        F.when(has_city, strip(F.get(parts, F.lit(1)))).otherwise(c).alias("address"),
    )
