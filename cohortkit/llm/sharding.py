"""Sharding by weighted rendezvous hashing.

A record goes to the shard with the highest score ``-weight / ln(u)``, where u
in (0, 1) comes from the hash of the record's key and the shard's number. A
new shard changes no other shard's score, so it takes rows only into itself.
Slots inside shards come from a range partitioning by (shard, key): each
partition counts its own rows, and the counts of the partitions before it are
added. No shard is gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.relational import checked_broadcast
from ..session import materialize
from . import common


def shard_of(keys: Sequence[str], weights: Sequence[float]) -> Column:
    """The shard 0 to n-1 of the key columns; a shard of weight 0 gets no row."""
    if not weights or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("weights: one per shard, none negative, one positive at least")
    scores = []
    for i, weight in enumerate(weights):
        h = F.shiftrightunsigned(F.xxhash64(*[F.col(k) for k in keys], F.lit(i)), 11)  # 53 bits: exact as a double
        u = (h.cast("double") + 0.5) / float(2 ** 53)
        if weight > 0:
            scores.append(F.struct((-F.lit(float(weight)) / F.log(u)).alias("score"), F.lit(i).alias("shard")))
    return F.array_max(F.array(*scores))["shard"] if len(scores) > 1 else scores[0]["shard"]


def _rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the rows of each shard within a partition sorted by shard."""
    from pyspark import TaskContext

    part, seen = TaskContext.get().partitionId(), {}
    for batch in batches:
        shards = batch["shard"].to_numpy()
        rank = np.empty(len(shards), np.int64)
        for s in np.unique(shards):
            mine = shards == s
            rank[mine] = seen.get(s, 0) + np.arange(mine.sum())
            seen[s] = int(seen.get(s, 0) + mine.sum())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(shards), part, np.int32)),
                                          pa.array(rank)], names=[*batch.schema.names, "__part", "__rank"])


def with_slots(sharded: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Adds slot, gapless from 0 in each ``shard`` in the order given."""
    fields = ", ".join(f"`{n}` {t}" for n, t in sharded.dtypes)
    dealt = (sharded.repartitionByRange("shard", *order_by).sortWithinPartitions("shard", *order_by)
             .mapInArrow(_rank, f"{fields}, __part int, __rank long"))
    ranked = materialize(dealt, "shard-slots")
    before = W.partitionBy("shard").orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    starts = (ranked.groupBy("__part", "shard").agg(F.count("*").alias("n"))  # a row per partition and shard in it
              .select("__part", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start")))
    return (ranked.join(checked_broadcast(starts), ["__part", "shard"])
            .withColumn("slot", F.col("__start") + F.col("__rank")).select(*sharded.columns, "slot"))


def shard_records(records: DataFrame, keys: Sequence[str] = ("doc_id",), weights: Sequence[float] = (1.0,) * 8,
                  new_weights: Sequence[float] = (1.0,)) -> DataFrame:
    """``records`` with shard, slot and grown_shard (with ``new_weights`` more shards).

    Null keys hash like a value of their own; rows that repeat a key share its
    shard and take slots of their own; an empty table gives no row; extra
    columns are carried along, but shard, slot and grown_shard are replaced.
    """
    own = [c for c in records.columns if c not in ("shard", "slot", "grown_shard")]
    rows = (records.select(*own).withColumn("shard", shard_of(keys, weights))
            .withColumn("grown_shard", shard_of(keys, [*weights, *new_weights])))
    return with_slots(rows, list(keys))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard."""
    sharded.write.mode("error").partitionBy("shard").parquet(path)


def op5_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of eight equal ones, and of nine; only sizes and checksums of texts are moved."""
    text = common.utf8("text")
    rows = common.table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return shard_records(rows).withColumn("law", F.lit("key"))
