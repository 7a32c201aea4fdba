"""Market screening on Spark: clean, reconcile, pivot, measure, rank and audit entity-period data."""

from siftmark.spec import MarketSpec

__all__ = ["MarketSpec"]
