"""Dates in free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MOST_MINUTES = 2_000_000_000  # about 3,800 years
_ISO = r"(?<![0-9])([0-9]{4})[/-]([0-9]{1,2})[/-]([0-9]{1,2})(?![0-9])"
_DMY = r"(?<![0-9])([0-9]{1,2})[/-]([0-9]{1,2})[/-]([0-9]{4}|[0-9]{2})(?![0-9])"
_DMY_ANYWHERE = r"([0-9]{1,2})[/-]([0-9]{1,2})[/-]([0-9]{2,4})"
_ISO_ANYWHERE = r"([0-9]{4})[/-]([0-9]{1,2})[/-]([0-9]{1,2})"


def _date(year: Column, month: Column, day: Column) -> Column:
    return F.try_to_date(F.concat_ws("-", year, month, day), "y-M-d")


def parse_date(c: Column) -> Column:
    """First y-m-d or d/m/y date in the text (two-digit years are 20yy); NULL if invalid."""
    iso = [F.regexp_extract(c, _ISO, i) for i in (1, 2, 3)]
    dmy = [F.regexp_extract(c, _DMY, i) for i in (1, 2, 3)]
    year = F.when(F.length(dmy[2]) == 2, F.concat(F.lit("20"), dmy[2])).otherwise(dmy[2])
    return F.when(iso[0] != "", _date(iso[0], iso[1], iso[2])).when(
        dmy[0] != "", _date(year, dmy[1], dmy[0])
    )


def date_text(c: Column, legacy: bool = False) -> Column:
    """Date in the text as ``dd/MM/yy``.

    ``legacy`` tries d/m/y first and does not look at neighbouring digits or validity, so
    "2025-11-03" reads as 25/11/03.
    """
    if not legacy:
        return F.date_format(parse_date(c), "dd/MM/yy")

    def shown(pattern: str, day: int, month: int, year: int) -> Column:
        part = lambda i: F.lpad(F.substring(F.regexp_extract(c, pattern, i), -2, 2), 2, "0")
        return F.when(
            F.regexp_extract(c, pattern, 0) != "", F.concat_ws("/", part(day), part(month), part(year))
        )

    return F.coalesce(shown(_DMY_ANYWHERE, 1, 2, 3), shown(_ISO_ANYWHERE, 3, 2, 1))


def parse_timestamp(c: Column, *formats: str) -> Column:
    """ISO timestamp, else the first format that fits; NULL otherwise."""
    return F.coalesce(
        F.try_to_timestamp(c), *[F.try_to_timestamp(c, F.lit(f)) for f in formats]
    )


def relative_date(page: Column, text: Column) -> Column:
    """Date of "N minute/hour/day ago" counted from the page's "Last updated" stamp.

    No "ago" text gives the stamp's date; no stamp, or a number that leads out of the calendar, gives NULL.
    """
    base = F.regexp_extract(
        page, r"Last updated:\s*\W([0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2})", 1
    ).try_cast("timestamp_ntz")
    ago = r"(?<![0-9])([0-9]+)\s+(minute|hour|day)s?\s+ago"
    lowered = F.lower(text)
    digits = F.regexp_extract(lowered, ago, 1)
    amount = digits.try_cast("bigint")
    unit = F.regexp_extract(lowered, ago, 2)
    minutes = F.when(unit == "day", F.lit(1440)).when(unit == "hour", F.lit(60)).otherwise(F.lit(1)).cast("bigint")
    back = F.try_multiply(amount, minutes)
    # Year 1 is less than MOST_MINUTES before any date that a page can show.
    moved = F.when(back <= MOST_MINUTES, base - F.make_dt_interval(F.lit(0), F.lit(0), back.cast("int")))
    return F.when(digits == "", base).when(F.year(moved) >= 1, moved).cast("date")
