"""Spark-native medallion warehouse for versioned notices."""

from noticehouse.spec import DimSpec, FactSpec, FeedSpec

__all__ = ["DimSpec", "FactSpec", "FeedSpec"]
