"""Streaming entry points (incremental landing into bronze)."""

from tripflow.streaming.landing import land_incrementally

__all__ = ["land_incrementally"]
