"""Three-level buckets and persona text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import spec


def bucket3(v: Column, q_low: Column, q_high: Column, levels=spec.PERSONA_LEVELS) -> Column:
    """NULL -> middle; <= q_low -> low; >= q_high -> high; else middle.
    The low test comes first, so equal thresholds label everything low."""
    low, mid, high = levels
    return (F.when(v.isNull(), F.lit(mid))
             .when(v <= q_low, F.lit(low))
             .when(v >= q_high, F.lit(high))
             .otherwise(F.lit(mid)))


def persona_label(parts: list[tuple[str, Column]], sep: str = spec.LIST_SEP) -> Column:
    """Join 'Prefix Level' parts (at most three) into one label."""
    pieces = [F.concat(F.lit(prefix + " "), level) for prefix, level in parts[:3]]
    if not pieces:
        return F.lit("")
    return F.concat_ws(sep, *pieces)
