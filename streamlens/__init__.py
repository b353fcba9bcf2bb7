"""Micro-batch stream analytics on Spark DataFrames.

Text messages are split into ``label,feature`` samples, a penalised line is
fitted per batch, window or group from one mergeable aggregate, and the
predictions drive band lookups over stored tables.
"""

from streamlens.config import JobConfig

__all__ = ["JobConfig"]
