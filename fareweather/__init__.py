"""Spark operators that measure how an hourly condition changes trip demand."""

from fareweather.config import Settings
from fareweather.sources.periods import Period

__all__ = ["Period", "Settings"]
