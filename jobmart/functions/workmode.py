"""Work mode from free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobmart import rules
from jobmart.functions.text import Rules, first_label


def work_mode(description: Column, location: Column, table: Rules = tuple(rules.WORK_MODES)) -> Column:
    """Remote > hybrid > on site, Vietnamese labels."""
    return first_label(
        F.concat_ws(" ", description, location), table, rules.WORK_MODE_OTHER
    )


def work_mode_english(
    description: Column, title: Column, table: Rules = tuple(rules.WORK_MODES_ENGLISH)
) -> Column:
    return first_label(
        F.concat_ws(" ", description, title),
        table,
        rules.WORK_MODE_ENGLISH_OTHER,
    )
