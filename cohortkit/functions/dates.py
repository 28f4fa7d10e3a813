"""Date parsing and tenure."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

from .. import spec


def parse_date(df: DataFrame, name: str, formats=spec.DATE_FORMATS) -> Column:
    """DATE from a date/timestamp column, or from text tried format by format.

    Each format is explicit (day-first first); text matching none is NULL.
    """
    dtype = df.schema[name].dataType
    if isinstance(dtype, DateType):
        return F.col(name)
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.to_date(F.col(name))
    text = F.trim(F.col(name).cast("string")) if not isinstance(dtype, StringType) else F.trim(F.col(name))
    return F.coalesce(*[F.to_date(F.try_to_timestamp(text, F.lit(fmt))) for fmt in formats])


def tenure_months(date_col: Column, as_of: str | _dt.date,
                  days_per_month: float = spec.DAYS_PER_MONTH) -> Column:
    """Whole days from ``date_col`` to ``as_of`` divided by a month length,
    rounded half-even to one decimal. ``as_of`` is required: no wall clock."""
    as_of_col = F.lit(as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(as_of))
    return F.bround(F.datediff(as_of_col, date_col) / F.lit(days_per_month), 1)
