"""Job title → level."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobmart import rules
from jobmart.functions.text import Rules, alternation, first_label


def level(c: Column, whole_words: bool = False, table: Rules = tuple(rules.LEVELS)) -> Column:
    """Leader > Senior > Junior > Mid-level by contained keyword.

    ``whole_words`` stops "cto" from matching "director" and "intern" from matching "internal".
    """
    return first_label(c, table, rules.LEVEL_OTHER, whole_words)


def level_by_pattern(c: Column, table: Rules = tuple(rules.LEVELS)) -> Column:
    """Same classes from one regular expression per class; used to cross-check ``level``."""
    text = F.lower(c)
    chain = F
    for label, words in table:
        chain = chain.when(text.rlike(alternation(words)), label)
    return chain.otherwise(rules.LEVEL_OTHER)


def level_six(c: Column, table: Rules = tuple(rules.LEVELS_SIX)) -> Column:
    return F.when(c.isNull(), rules.UNKNOWN_VI).otherwise(
        first_label(c, table, rules.LEVEL_OTHER)
    )


def level_stream(c: Column, table: Rules = tuple(rules.LEVELS_STREAM)) -> Column:
    return first_label(c, table, rules.LEVEL_OTHER)
