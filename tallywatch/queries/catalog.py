"""All queries and their SQL."""

from __future__ import annotations

from tallywatch.queries import envelope, extracts, models, reports, streams  # noqa: F401 (they register themselves)
from tallywatch.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
