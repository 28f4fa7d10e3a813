from cohortkit.operators.relational import (distinct_rows, drop_empty, drop_incomplete,
                                            first_per_key, left_join, union_sources)


def test_drop_empty_and_incomplete(spark):
    df = spark.createDataFrame([(None, None), (1, None), (None, "a")], "k long, v string")
    assert drop_empty(df).count() == 2
    assert drop_incomplete(df, ["k"]).count() == 1


def test_distinct_treats_nulls_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "k long, v string")
    assert distinct_rows(df).count() == 2


def test_first_per_key_by_order_and_null_group(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (None, 5, "x"), (None, 4, "y")],
                               "k long, o long, v string")
    got = {r.k: (r.o, r.v) for r in first_per_key(df, "k", ["o"]).collect()}
    assert got == {1: (1, "a"), None: (4, "y")}


def test_union_sources_by_name_with_origin(spark):
    a = spark.createDataFrame([(1, 2.0)], "k long, x double")
    b = spark.createDataFrame([(3, "t")], "k long, y string")
    u = union_sources({"a": a, "b": b}, "src").orderBy("k").collect()
    assert [(r.k, r.x, r.y, r.src) for r in u] == [(1, 2.0, None, "a"), (3, None, "t", "b")]


def test_left_join_null_keys(spark):
    l = spark.createDataFrame([(None, "l1"), (1, "l2")], "k long, v string")
    r = spark.createDataFrame([(None, "r1"), (1, "r2")], "k long, v string")
    default = {(x.v_x, x.v_y) for x in left_join(l, r, "k").collect()}
    assert default == {("l1", None), ("l2", "r2")}
    safe = {(x.v_x, x.v_y) for x in left_join(l, r, "k", null_safe=True).collect()}
    assert safe == {("l1", "r1"), ("l2", "r2")}
