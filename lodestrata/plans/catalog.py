"""All queries of the core, by name."""

from __future__ import annotations

from lodestrata.plans import analytics, details, exchange, problems

QUERIES = {**analytics.QUERIES, **details.QUERIES, **exchange.QUERIES, **problems.QUERIES}
ORACLES = {**analytics.ORACLES, **details.ORACLES, **exchange.ORACLES, **problems.ORACLES}
