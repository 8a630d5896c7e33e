"""All core queries with their SQL."""

from __future__ import annotations

from talespan.plans import general, reference
from talespan.plans.reference import flagship

__all__ = ["ORACLES", "QUERIES", "flagship"]

QUERIES: dict = {**reference.QUERIES, **general.QUERIES}
ORACLES: dict[str, str] = {**reference.ORACLES, **general.ORACLES}
