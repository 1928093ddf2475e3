"""Multi-pass plans: fused checks, profiles, distributions and check results."""

from . import checks, distribution, profile, results
from .checks import Check, failing_rows, run_checks, schema_diff, schema_match
from .results import RESULT_SCHEMA, CheckFailed, alerts, append_results, log_rows, raise_on_failure

__all__ = [
    "checks", "distribution", "profile", "results",
    "Check", "failing_rows", "run_checks", "schema_diff", "schema_match",
    "RESULT_SCHEMA", "CheckFailed", "alerts", "append_results", "log_rows", "raise_on_failure",
]
