"""Lenient number parsing (text -> DOUBLE, bad -> NULL, never NaN).

Styles:
  plain  '1234.5'                         (lenient numeric parse)
  comma  decimal comma only: '1234,5'     ('1.234,56' -> NULL)
  br     locale: drop whitespace and '.', then comma -> point ('1.234,56' -> 1234.56)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

# Decimal or scientific notation only. Spark's own cast would also accept
# '1.0d', '1f', 'NaN' and 'Infinity', which a lenient numeric parse rejects.
_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"

STYLES = ("plain", "comma", "br")


def _normalise(text: Column, style: str) -> Column:
    if style == "plain":
        return F.trim(text)
    if style == "comma":
        return F.replace(F.trim(text), F.lit(","), F.lit("."))
    if style == "br":
        no_space = F.regexp_replace(text, r"\s+", "")
        return F.replace(F.replace(no_space, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    raise ValueError(f"unknown number style {style!r}; expected one of {STYLES}")


def parse_number(col: Column | str, style: str = "plain") -> Column:
    """Text column -> DOUBLE; anything that is not a number becomes NULL."""
    c = F.col(col) if isinstance(col, str) else col
    s = _normalise(c.cast("string"), style)
    return F.when(s.rlike(_NUMBER), s.try_cast("double"))


def to_double(df: DataFrame, name: str, style: str = "plain") -> Column:
    """Type switch: text columns go through ``parse_number``; numeric columns
    are cast; NaN becomes NULL either way."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, StringType):
        return parse_number(F.col(name), style)
    if isinstance(dtype, NumericType):
        v = F.col(name).cast("double")
        return F.nanvl(v, F.lit(None).cast("double"))
    return parse_number(F.col(name).cast("string"), style)
