"""Column-level helpers: pure expressions, no jobs (except numeric_columns)."""

from .numbers import parse_number, to_double
from .dates import parse_date, tenure_months
from .text import fold_name, join_list, is_open_status
from .columns import (unify_key, resolve_score, find_duration_column,
                      select_present, require_columns, rename_clashes, numeric_columns,
                      numeric_column_counts)
from .labels import bucket3, persona_label

__all__ = [
    "parse_number", "to_double", "parse_date", "tenure_months",
    "fold_name", "join_list", "is_open_status", "unify_key", "resolve_score",
    "find_duration_column", "select_present", "require_columns",
    "rename_clashes", "numeric_columns", "numeric_column_counts", "bucket3", "persona_label",
]
