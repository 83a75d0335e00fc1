"""All registered queries and their SQL counterparts."""

from jobmart.plans.queries import (  # noqa: F401  (importing a module registers its queries)
    duplicates, joining, keyword_tables, learning, normalisers, reports, site_pages, stars, storage, stream_recovery,
    streams,
)
from jobmart.plans.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
