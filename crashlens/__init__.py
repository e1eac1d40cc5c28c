"""crashlens: vehicle-crash analytics as lazy Spark DataFrame plans."""

from crashlens.sources.catalog import CrashTables

__all__ = ["CrashTables"]
