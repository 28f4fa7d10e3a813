"""Categories with many levels: a table of levels, joined, and sparse vectors.

``features.one_hot`` makes a column per level, so its plan grows with the levels and
the driver holds them. Here levels are rows: numbered in sorted order by range
partitions, joined to the data by value (a broadcast where a check of the table's
size allows it), and turned into sparse vectors by Spark ML's transformers, which
know each category's number of levels and nothing else. The plan has
a join per category column, however many levels there are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Interaction, OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .relational import checked_broadcast


def level_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(c, level, n, place): per category column (by its number) and non-NULL level the rows that have it, and
    its place among the column's sorted levels, from 0."""
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(j).alias("c"), F.col(name).cast("string").alias("level"))
                                          for j, name in enumerate(cols)])).alias("p")).select("p.c", "p.level")
    counted = pairs.where(F.col("level").isNotNull()).groupBy("c", "level").agg(F.count(F.lit(1)).alias("n"))
    rows = materialize(counted.repartitionByRange("c", "level").sortWithinPartitions("c", "level")
                       .withColumn("at", F.monotonically_increasing_id()), "levels")
    rows = rows.withColumn("part", F.shiftright("at", 33))
    before = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy("c", "part").agg(F.count(F.lit(1)).alias("m"), F.min("at").alias("first"))  # a row per partition and column
              .select("c", "part", "first", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("above")))
    placed = rows.join(checked_broadcast(starts), ["c", "part"])
    return materialize(placed.select("c", "level", "n", (F.col("above") + F.col("at") - F.col("first")).alias("place")), "level-places")


@dataclass
class WideFeatures:
    frame: DataFrame      # the rows with <col>__place, <col>__weight and the vector
    levels: DataFrame     # the table of levels
    sizes: dict[str, int]  # levels per category column
    width: int            # of the vector


def wide_features(df: DataFrame, categorical: Sequence[str], scaled: Sequence[str] = (), vector: str = "features",
                  standardised: bool = True) -> WideFeatures:
    """Adds a vector of the ``scaled`` columns (numbers as they are) and a place per level but the first of
    each category column, as a sparse vector where that is smaller.

    A level's entry is 1, or with ``standardised`` 1 / its population deviation:
    that is the standardised dummy without its shift, which no distance
    between rows depends on, and which would fill the vector. ``<col>__place`` is
    the level's place in the vector after the numbers and the levels of the columns before,
    NULL for the first level and for NULL; ``<col>__weight`` its entry.
    """
    cats = list(categorical)
    levels = level_table(df, cats)
    counts = {r["c"]: r["k"] for r in levels.groupBy("c").agg(F.count(F.lit(1)).alias("k")).collect()}  # a row per column
    sizes = {name: counts.get(j, 0) for j, name in enumerate(cats)}
    rows = df.count()
    p = F.col("n") / F.lit(float(max(rows, 1)))
    weight = F.when(p < 1, 1 / F.sqrt(p * (1 - p))).otherwise(0.0) if standardised else F.lit(1.0)
    out, used, vectors, base = df, [], [], len(scaled)
    for j, name in enumerate(cats):
        own = levels.where((F.col("c") == j) & (F.col("place") > 0)).select(
            F.col("level").alias(f"{name}__level"), (F.col("place") - 1).alias(f"{name}__index"), weight.alias(f"{name}__weight"))
        out = out.join(checked_broadcast(own), F.col(name).cast("string") == F.col(f"{name}__level"), "left").drop(f"{name}__level")
        size = max(sizes[name], 1)
        # The encoder drops the last index: it stands for the first level, NULL and what has no level.
        index = F.coalesce(F.col(f"{name}__index"), F.lit(size - 1)).cast("double")
        out = out.withColumn(f"{name}__code", index.alias("x", metadata={"ml_attr": {"type": "nominal", "num_vals": size}}))
        out = out.withColumn(f"{name}__place", F.col(f"{name}__index") + base)
        out = out.withColumn(f"{name}__factor", F.coalesce(f"{name}__weight", F.lit(0.0)))
        base += size - 1
        used += [f"{name}__index", f"{name}__code", f"{name}__factor"]
        if size > 1:
            hot, weighed = f"{name}__hot", f"{name}__weighed"
            out = OneHotEncoder(inputCols=[f"{name}__code"], outputCols=[hot], dropLast=True).fit(out).transform(out)
            out = Interaction(inputCols=[f"{name}__factor", hot], outputCol=weighed).transform(out)
            vectors.append(weighed)
            used += [hot, weighed]
    out = VectorAssembler(inputCols=[*scaled, *vectors], outputCol=vector, handleInvalid="error").transform(out).drop(*used)
    return WideFeatures(out, levels, sizes, base)
