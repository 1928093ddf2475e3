"""tablewatch: data quality, cleaning and profiling operators for Spark DataFrames.

Operators are plain functions ``DataFrame -> DataFrame`` (use with ``df.transform``);
checks and profiles return small result DataFrames computed in as few passes as
possible, with native expressions only.
"""

from . import functions, operators, plans, sources, streaming
from .session import build_session, checkpoint_dir

__all__ = ["functions", "operators", "plans", "sources", "streaming", "build_session", "checkpoint_dir"]
