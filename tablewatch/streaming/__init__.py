"""Checks on Structured Streaming sources (per micro-batch, or as running counts)."""

from .monitor import check_each_batch, running_check_counts

__all__ = ["check_each_batch", "running_check_counts"]
