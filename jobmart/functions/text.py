"""Text helpers: Unicode form, keys, rule chains, safe casts."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable, Iterable, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Send the Python functions of this module to executors by value: they need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Letters that are already in composed form: Latin incl. precomposed Vietnamese, plus the
# general punctuation block.  Text made of these needs no normalisation.
_COMPOSED_ONLY = r"[^\x{0000}-\x{02FF}\x{1EA0}-\x{1EF9}\x{2010}-\x{2027}\x{2030}-\x{205E}]"


@F.pandas_udf(T.StringType())
def _nfc(values: pd.Series) -> pd.Series:
    return values.map(lambda s: unicodedata.normalize("NFC", s), na_action="ignore")


def nfc(c: Column) -> Column:
    """Unicode NFC.  Only text that can change is sent to Python (in Arrow batches)."""
    return F.coalesce(_nfc(F.when(c.rlike(_COMPOSED_ONLY), c)), c)


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once.

    Spark does not share repeated subexpressions below higher-order functions, so a costly
    ``value`` used in several places of such an expression would run once per place.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


# Every character that counts as white space, among them the no-break space of web pages.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Remove white space of every kind at both ends (``trim`` alone removes blanks only)."""
    return F.trim(c, F.lit(WHITE_SPACE))


def text_key(c: Column) -> Column:
    """Comparison key: lower case, single blanks for white space of every kind, none at the ends."""
    return F.lower(F.trim(F.regexp_replace(c, f"[{WHITE_SPACE}]+", " ")))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def contains_any(c: Column, words: Iterable[str]) -> Column:
    found = None
    for word in words:
        hit = c.contains(word)
        found = hit if found is None else found | hit
    return F.lit(False) if found is None else found


def alternation(words: Sequence[str]) -> str:
    """Regular expression that matches any of ``words`` literally."""
    return "|".join(escape(w) for w in words)


def escape(word: str) -> str:
    return "".join("\\" + ch if ch in r"\.[]{}()*+?^$|#-&~" else ch for ch in word)


# (label, keywords) in order of precedence.
Rules = Sequence[tuple[str, Sequence[str]]]


def first_label(
    c: Column,
    rules: Rules,
    otherwise: Column | str,
    whole_words: bool = False,
) -> Column:
    """Label of the first rule with a keyword in the lower-cased ``c``.

    ``rules`` are ``(label, keywords)``; with ``whole_words`` a keyword inside a longer word
    does not count.
    """
    default = F.lit(otherwise) if isinstance(otherwise, str) else otherwise

    def chain(text: Column) -> Column:
        labels = F
        for label, words in rules:
            hit = text.rlike(whole_word(words)) if whole_words else contains_any(text, words)
            labels = labels.when(hit, F.lit(label))
        return labels.otherwise(default)

    return bind(F.lower(c), chain)  # the lower-cased text is worked out once


# Letters, digits and underscore in any script; spelled out because ``\w`` and ``\b`` differ
# between Java versions.
WORD = r"\p{L}\p{M}\p{N}_"


def whole_word(words: Sequence[str]) -> str:
    return rf"(?<![{WORD}])(?:{alternation(words)})(?![{WORD}])"


def title_case(c: Column) -> Column:
    """Upper case for each letter that follows a non-letter, lower case for the others.

    ``initcap`` starts a word after blanks only; here "bà rịa-vũng tàu" gives
    "Bà Rịa-Vũng Tàu".
    """
    pieces = F.split(F.lower(c), r"(?<=[^\p{L}])(?=\p{L})")
    return F.array_join(
        F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substr(p, F.lit(2)))),
        "",
    )


def whole_number(c: Column) -> Column:
    """Text → bigint: decimals are cut off, anything else gives NULL (never an error)."""
    return F.when(
        c.rlike(r"^[0-9]+(\.[0-9]*)?$"), F.regexp_extract(c, r"^([0-9]+)", 1).try_cast("bigint")
    )


def first_integer(c: Column) -> Column:
    """First run of digits as bigint."""
    return F.regexp_extract(c, r"([0-9]+)", 1).try_cast("bigint")
