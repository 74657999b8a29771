"""Continuous replication of landed change files."""

from daybook.streaming.replicate import replicate, selected

__all__ = ["replicate", "selected"]
