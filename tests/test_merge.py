"""B1-B7 merge laws."""

import pytest
from pyspark.sql import functions as F

from parcelgrid.operators.merge import (append_reject, append_rows, merge_keep_first, merge_keep_last,
                                        quarantine, rejected_units, update_by_key)

SCHEMA = "k string, v string"


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=str)


def test_keep_first_ignores_existing_and_takes_first_in_batch(spark):
    target = spark.createDataFrame([("a", "old")], SCHEMA)
    batch = spark.createDataFrame([("a", "new", 1), ("b", "b2", 2), ("b", "b1", 1), (None, "n", 0)],
                                  "k string, v string, seq int")
    out = merge_keep_first(target, batch, ["k"], "seq")
    assert rows(out) == [("a", "old"), ("b", "b1")]
    out_all = merge_keep_first(target, batch, ["k"], "seq", null_key="keep_all")
    assert sorted(out_all.select("k", "v").collect(), key=str) == sorted([("a", "old"), ("b", "b1"), (None, "n")], key=str)


def test_keep_last_replaces_and_is_idempotent(spark):
    target = spark.createDataFrame([("a", "old"), ("c", "keep")], SCHEMA)
    batch = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "z", 1)], "k string, v string, seq int")
    once = merge_keep_last(target, batch, ["k"], "seq")
    twice = merge_keep_last(once, batch, ["k"], "seq")
    assert rows(once) == [("a", "y"), ("b", "z"), ("c", "keep")]
    assert rows(twice) == rows(once)


def test_merges_do_not_depend_on_partitioning(spark):
    data = [(f"k{i % 37}", f"v{i}", i) for i in range(500)]
    target = spark.createDataFrame([("k1", "t")], SCHEMA)
    b1 = spark.createDataFrame(data, "k string, v string, seq int")
    b8 = b1.repartition(8)
    assert rows(merge_keep_last(target, b1, ["k"], "seq")) == rows(merge_keep_last(target, b8, ["k"], "seq"))
    assert rows(merge_keep_first(target, b1, ["k"], "seq")) == rows(merge_keep_first(target, b8, ["k"], "seq"))


def test_defaults_for_columns_the_batch_lacks(spark):
    target = spark.createDataFrame([("a", "old", "2020-01-01")], "k string, v string, d string")
    batch = spark.createDataFrame([("a", "new", 1)], "k string, v string, seq int")
    out = merge_keep_last(target, batch, ["k"], "seq", defaults={"d": "2026-01-01"})
    assert rows(out) == [("a", "new", "2026-01-01")]


def test_append_rows_with_dedup(spark):
    target = spark.createDataFrame([("a", "1")], SCHEMA)
    batch = spark.createDataFrame([("a", "1", 1), ("b", "2", 2), ("b", "2", 1)], "k string, v string, seq int")
    assert len(rows(append_rows(target, batch.drop("seq")))) == 4
    assert rows(append_rows(target, batch, dedup_on=["k", "v"], seq="seq")) == [("a", "1"), ("b", "2")]


def test_append_reject_rejects_whole_units(spark):
    target = spark.createDataFrame([("p1", "t")], SCHEMA)
    batch = spark.createDataFrame([
        ("p2", "f1", "f1.csv"), ("p3", "f1", "f1.csv"),      # clean
        ("p1", "f2", "f2.csv"), ("p4", "f2", "f2.csv"),      # clashes with target
        ("p5", "f3", "f3.csv"), ("p5", "f3", "f3.csv"),      # duplicate inside the file
        ("p2", "f4", "f4.csv"), ("p6", "f4", "f4.csv"),      # key seen in an earlier file
    ], "k string, v string, unit string")
    assert rows(rejected_units(target, batch, ["k"], "unit")) == [("f2.csv",), ("f3.csv",), ("f4.csv",)]
    out = append_reject(target, batch, ["k"], "unit")
    assert rows(out) == [("p1", "t"), ("p2", "f1"), ("p3", "f1")]


def test_append_reject_goes_in_file_order(spark):
    target = spark.createDataFrame([("t", "t")], SCHEMA)
    keys = {"f1": "ab", "f2": "bc", "f3": "cd", "f4": "de", "f5": "xt", "f6": "xy", "f7": "z"}
    batch = spark.createDataFrame([(k, f, f) for f, ks in keys.items() for k in ks], "k string, v string, unit string")
    # f2 fails on b, so c is free for f3; f4 fails on d; f5 fails on the target's t, so x is free for f6
    assert rows(rejected_units(target, batch, ["k"], "unit")) == [("f2",), ("f4",), ("f5",)]
    assert rows(append_reject(target, batch, ["k"], "unit"), "k") == [(k,) for k in sorted("abcdxyzt")]


def test_append_rows_needs_an_order_to_dedup(spark):
    df = spark.createDataFrame([("a", "1")], SCHEMA)
    with pytest.raises(ValueError, match="seq"):
        append_rows(df, df, dedup_on=["k"])


def test_update_by_key(spark):
    target = spark.createDataFrame([("a", "1"), ("b", "2")], SCHEMA)
    changes = spark.createDataFrame([("b", None)], SCHEMA)
    assert rows(update_by_key(target, changes, ["k"], ["v"])) == [("a", "1"), ("b", None)]


def test_update_by_key_refuses_two_changes_of_a_key(spark):
    target = spark.createDataFrame([("a", "1"), ("b", "2")], SCHEMA)
    changes = spark.createDataFrame([("b", "x"), ("b", "y")], SCHEMA)
    with pytest.raises(Exception, match="several changes"):
        update_by_key(target, changes, ["k"], ["v"]).collect()


def test_quarantine_splits_with_first_reason(spark):
    df = spark.createDataFrame([("1", "x"), (None, "y"), ("z", None)], "a string, b string")
    good, bad = quarantine(df, {"no_a": F.col("a").isNull(), "bad_a": F.col("a").try_cast("int").isNull(),
                                "no_b": F.col("b").isNull()})
    assert rows(good) == [("1", "x")]
    assert sorted(((r.a, r._reason) for r in bad.collect()), key=str) == sorted([(None, "no_a"), ("z", "bad_a")], key=str)


def test_surrogate_ids_are_dense_and_ordered(spark):
    from parcelgrid.operators.merge import append_numbered, surrogate_ids
    rows = [(i * 7919 % 1000, f"v{i}") for i in range(1000)]
    got = surrogate_ids(spark.createDataFrame(rows, "k int, v string").repartition(7), ["k"], after=40).orderBy("id").collect()
    assert [(r.id, r.k) for r in got] == [(41 + i, i) for i in range(1000)]
    target = spark.createDataFrame([(5, "a"), (9, "b")], "id long, v string")
    out = append_numbered(target, spark.createDataFrame([("y", 2), ("x", 1)], "v string, n int").select("v", "n"), ["n"])
    assert sorted(tuple(r) for r in out.collect()) == [(5, "a"), (9, "b"), (10, "x"), (11, "y")]
    none = append_numbered(target.limit(0), spark.createDataFrame([], "v string, n int"), ["n"])
    assert none.collect() == []


def test_surrogate_ids_shuffle_the_rows_once(spark):
    """The written range partitions are numbered as they lie: no window over the rows deals them out again."""
    from parcelgrid.operators.merge import surrogate_ids
    rows = spark.range(2000).selectExpr("(id * 7919) % 2000 AS k", "id % 3 AS v").repartition(5)
    out = surrogate_ids(rows, ["k"])
    assert "partitionBy" not in out._jdf.queryExecution().analyzed().toString()
    assert out._jdf.queryExecution().executedPlan().toString().count("row_number") == 0
    assert all(r.id == r.k + 1 for r in out.collect()) and out.count() == 2000
    desc = surrogate_ids(rows, ["v", "k"], after=5).orderBy("id").collect()
    assert [(r.v, r.k) for r in desc] == sorted((r.v, r.k) for r in desc) and [r.id for r in desc] == list(range(6, 2006))
