"""All queries of the library's own operators; importing the modules registers them."""

from __future__ import annotations

from . import aggregates, exchange, joins, oracles, projections, recipes
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "aggregates", "exchange", "joins", "oracles", "projections", "recipes"]
