"""DataFrame -> DataFrame operators: relational (P, W, J, G1, G7), cleaning (C), features (F)."""

from .cleaning import drop_missing, fill_constant, fill_defaults, handle_missing, impute_mean, remove_outliers
from .features import category_vocabulary, one_hot, timestamp_parts
from .relational import (add_column, add_columns, cast_columns, columns_of_type, filter_rows, group_by_agg,
                         join, remove_duplicates, select_columns)

__all__ = [
    "drop_missing", "fill_constant", "fill_defaults", "handle_missing", "impute_mean", "remove_outliers",
    "category_vocabulary", "one_hot", "timestamp_parts",
    "add_column", "add_columns", "cast_columns", "columns_of_type", "filter_rows", "group_by_agg", "join",
    "remove_duplicates", "select_columns",
]
