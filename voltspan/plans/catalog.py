"""All registered queries."""

from voltspan.plans import (  # noqa: F401  (imported for registration)
    column_queries,
    join_queries,
    quality_queries,
    report_queries,
    scan_queries,
    series_queries,
    stream_queries,
)
from voltspan.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
