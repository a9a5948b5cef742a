"""All registered queries of the catalogue library."""

from __future__ import annotations

from courtlake.plans import archives, judgments, listing, operations  # noqa: F401
from courtlake.plans.registry import ORACLES, QUERIES

flagship = listing.flagship_courts
__all__ = ["ORACLES", "QUERIES", "flagship", "judgments", "operations"]
