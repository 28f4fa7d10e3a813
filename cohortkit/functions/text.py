"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import spec


def fold_name(name: str) -> str:
    """Lower-case a column name and fold the accents of ``spec.ACCENT_FROM``."""
    return name.lower().translate(str.maketrans(spec.ACCENT_FROM, spec.ACCENT_TO))


def join_list(arr: Column, sep: str = spec.LIST_SEP) -> Column:
    """Array -> 'a, b, c' (an empty or NULL array gives '')."""
    return F.coalesce(F.concat_ws(sep, arr), F.lit(""))


def is_open_status(col: Column, open_status: str = spec.OPEN_STATUS) -> Column:
    """Case-insensitive status test on the text form; NULL status is not open."""
    return F.coalesce(F.upper(col.cast("string")) == F.lit(open_status.upper()), F.lit(False))
