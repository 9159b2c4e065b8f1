"""Daily spend anomaly analytics on Spark DataFrames."""

from spendtide.config import JobConfig

__all__ = ["JobConfig"]
