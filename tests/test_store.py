"""Tables that are used again only while their inputs are the same, and published in one step."""

import os

import pytest
from pyspark.sql import functions as F

from cohortkit.plans import jobs
from cohortkit.sources import clear_unpublished, publish, read_published
from cohortkit.sources.fingerprint import input_fingerprint


def test_used_again_only_while_inputs_hold(spark, tmp_path):
    raw, path, calls = str(tmp_path / "raw a%b"), str(tmp_path / "t"), []
    spark.range(5).write.parquet(raw)

    def load(**kw):
        def build():
            calls.append(1)
            return spark.read.parquet(raw).withColumn("v", F.col("id") * 2)
        return jobs.load_or_build(spark, path, build, **({"inputs": [raw], "params": {"as_of": "2002"}} | kw)).count()

    assert load() == load() == 5 and len(calls) == 1
    spark.range(3).write.mode("append").parquet(raw)
    assert load() == load() == 8 and len(calls) == 2                    # a file more
    assert load(params={"as_of": "2003"}) == 8 and len(calls) == 3      # another parameter
    assert load(params={"as_of": "2003"}, reuse=False) == 8 and len(calls) == 4
    part = next(p for p in os.listdir(raw) if p.endswith(".parquet"))
    os.utime(f"{raw}/{part}", (1, 1))
    assert load(params={"as_of": "2003"}) == 8 and len(calls) == 5      # a file written again
    df = spark.read.parquet(raw)
    assert load(inputs=[df]) == load(inputs=[spark.read.parquet(raw)]) == 8 and len(calls) == 6
    assert load(inputs=[df.selectExpr("cast(id as string) id")]) == 8 and len(calls) == 7  # another schema
    os.remove(f"{path}/_fingerprint")
    assert load(inputs=[df]) == 8 and len(calls) == 8                   # a write that did not end


def test_failed_build_leaves_nothing_to_be_used(spark, tmp_path):
    path = str(tmp_path / "t")
    load = lambda df, v: jobs.load_or_build(spark, path, lambda: df, inputs=[], params={"v": v})
    assert load(spark.range(2), 1).count() == 2
    with pytest.raises(Exception):
        load(spark.range(3).select(F.raise_error(F.lit("lost")).alias("id")), 2)
    assert load(spark.range(4), 2).count() == 4


def test_fingerprint_of_absent_paths(spark, tmp_path):
    p = str(tmp_path / "none")
    before = input_fingerprint(spark, [p])
    assert before == input_fingerprint(spark, [p]) != input_fingerprint(spark, [p + "x"])
    spark.range(1).write.parquet(p)
    assert input_fingerprint(spark, [p]) != before


def test_failed_publication_leaves_the_last_one(spark, tmp_path):
    root = str(tmp_path / "pub")
    with pytest.raises(ValueError):
        read_published(spark, root, "a")
    assert publish(spark, {"a": spark.range(3), "b": spark.range(4)}, root) == 1
    held = read_published(spark, root, "a")
    broken = spark.range(9).select(F.raise_error(F.lit("lost")).alias("id"))
    with pytest.raises(Exception):
        publish(spark, {"a": spark.range(7), "b": broken}, root)
    assert read_published(spark, root, "a").count() == 3 and read_published(spark, root, "b").count() == 4
    assert len(clear_unpublished(spark, root)) == 1 and read_published(spark, root, "a").count() == 3
    assert publish(spark, {"a": spark.range(7)}, root) == 2
    assert read_published(spark, root, "a").count() == 7 and held.count() == 3  # a reader of the version before goes on
    with pytest.raises(ValueError):
        read_published(spark, root, "b")
    assert read_published(spark, root, "b", version=1).count() == 4
    assert publish(spark, {"a": spark.range(8)}, root, fmt="csv") == 3
    assert read_published(spark, root, "a").columns == ["id"] and clear_unpublished(spark, root) == []
    with pytest.raises(ValueError):
        read_published(spark, root, "b", version=1)  # two versions stay


def test_a_taken_number_is_not_overwritten(spark, tmp_path):
    from cohortkit.sources import store
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    store.write_text(spark, a, "1")
    store.write_text(spark, b, "2")
    assert not store.move(spark, a, b) and store.read_text(spark, b) == "2"
    assert store.move(spark, a, str(tmp_path / "c")) and store.read_text(spark, a) is None
