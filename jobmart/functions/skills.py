"""Skill keywords in free text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobmart import rules
from jobmart.functions.automaton import A_WORD, NO_WORD, is_word, keyword_list


def _beside(ch: str, legacy: bool) -> int:
    """What must stand next to a keyword that begins or ends with ``ch``.

    Default: no letter or digit on either side, so "C++" and ".NET" are found as words.
    ``legacy`` is a word boundary on both sides, which *needs* a letter or digit next to a
    symbol: "C++ " is not found, "c++11" is.
    """
    return A_WORD if legacy and not is_word(ch) else NO_WORD


def extract_skills(
    *texts: Column, keywords: Sequence[str] = tuple(rules.SKILLS), legacy: bool = False
) -> Column:
    """Keywords that occur as whole words in the texts, in keyword-list order.

    A keyword inside a longer one ("sql" in "sql server") counts too.  All keywords are found in one pass over
    the text (in Arrow batches), whose cost does not depend on their number.
    """
    words = list(dict.fromkeys(keywords))
    return keyword_list(
        F.lower(F.concat_ws(" ", *texts)), words, [_beside(k[0], legacy) for k in words], [_beside(k[-1], legacy) for k in words])
