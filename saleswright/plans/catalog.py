"""All registered queries: importing the modules registers them."""

from saleswright.plans import (  # noqa: F401
    combining,
    constrained,
    datasets,
    declared,
    expressions,
    layouts,
    loads,
    modifying,
    rows,
    statements,
    summaries,
)
from saleswright.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
