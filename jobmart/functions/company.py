"""Company name recovery."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobmart import rules
from jobmart.functions.text import WORD, alternation, blank_to_null, strip

_NAME = rf"[{WORD}\s.&*()-]+?"
_BY_LEGAL_FORM = rf"(?:{alternation(rules.COMPANY_LEGAL_FORMS)})[\s{WORD}&.,()-]+"
_BY_VERB = rf"^({_NAME})\s+(?:{alternation(rules.COMPANY_HIRING_VERBS)})"
_BY_PLACE = rf"{rules.COMPANY_AT} ({_NAME}),"


def recover_company(company: Column, description: Column) -> Column:
    """Given name, else legal form / "X tuyển dụng" / "Tại X," in the description."""
    return F.coalesce(
        F.when(company != rules.PLACEHOLDER, company),
        blank_to_null(strip(F.regexp_extract(description, _BY_LEGAL_FORM, 0))),
        blank_to_null(strip(F.regexp_extract(description, _BY_VERB, 1))),
        blank_to_null(strip(F.regexp_extract(description, _BY_PLACE, 1))),
        F.lit(rules.COMPANY_UNKNOWN),
    )
