"""Expression helpers: names, type families, row predicates and statistic expressions."""

from .names import col, label, quote, resolve, unique_names
from .predicates import (comparable_pair, differs, inside, is_missing, not_in, outside,
                         strptime_parse, strptime_regex, timestamp_implausible,
                         timestamp_text_invalid)
from .stats import as_double, sigma_outlier
from .types import columns_of, is_floating, is_numeric, is_string, is_timestamp

__all__ = [
    "col", "label", "quote", "resolve", "unique_names",
    "comparable_pair", "differs", "inside", "is_missing", "not_in", "outside",
    "strptime_parse", "strptime_regex", "timestamp_implausible", "timestamp_text_invalid",
    "as_double", "sigma_outlier",
    "columns_of", "is_floating", "is_numeric", "is_string", "is_timestamp",
]
