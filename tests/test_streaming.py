"""draining a file stream through foreachBatch equals the batch merge."""

import glob
import os

from parcelgrid.operators.merge import merge_keep_last
from parcelgrid.streaming.merge_stream import file_stream, last_version, stream_merge

SCHEMA = "k string, v string, seq int"


def land(spark, folder, name, data):
    """One parquet file of the landing folder."""
    part = os.path.join(folder + "-parts", name)
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(part)
    os.makedirs(folder, exist_ok=True)
    (file,) = glob.glob(os.path.join(part, "part-*.parquet"))
    with open(file, "rb") as src, open(os.path.join(folder, f"{name}.parquet"), "wb") as dst:
        dst.write(src.read())


def drain(spark, folder, base, root, checkpoint):
    stream = file_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema, max_files=1)
    return stream_merge(stream, base, lambda t, b: merge_keep_last(t, b, ["k"], "seq"), root, checkpoint)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def versions(root):
    return sorted(os.listdir(root))


def test_stream_drain_equals_batch(spark, tmp):
    data = [(f"k{i % 11}", f"v{i}", i) for i in range(90)]
    for part in range(3):
        land(spark, os.path.join(tmp, "in"), f"f{part}", data[part * 30:(part + 1) * 30])
    base = spark.createDataFrame([("k1", "old"), ("zz", "keep")], "k string, v string")
    root = os.path.join(tmp, "table")
    table = drain(spark, os.path.join(tmp, "in"), base, root, os.path.join(tmp, "ckpt"))
    assert rows(table) == rows(merge_keep_last(base, spark.createDataFrame(data, SCHEMA), ["k"], "seq"))
    assert versions(root) == ["batch=1", "batch=2"]     # three micro-batches; the last version and the one before stay
    assert dict(rows(spark.read.parquet(last_version(spark, root, before=2))))["k0"] == "v55"


def test_later_files_second_streams_and_replays(spark, tmp):
    src, root, ckpt = (os.path.join(tmp, x) for x in ("in", "table", "ckpt"))
    empty = spark.createDataFrame([], "k string, v string")
    land(spark, src, "f0", [("a", "1", 1), ("b", "1", 1)])
    drain(spark, src, empty, root, ckpt)
    land(spark, src, "f1", [("b", "2", 2), ("c", "2", 2)])
    first = drain(spark, src, empty, root, ckpt)                    # goes on with the second file
    want = [("a", "1"), ("b", "2"), ("c", "2")]
    assert rows(first) == want and versions(root) == ["batch=0", "batch=1"]
    other = os.path.join(tmp, "in2")
    land(spark, other, "g0", [("d", "3", 3), ("a", "3", 3)])
    second = drain(spark, other, first, os.path.join(tmp, "table2"), os.path.join(tmp, "ckpt2"))
    assert rows(second) == [("a", "3"), ("b", "2"), ("c", "2"), ("d", "3")] and rows(first) == want
    os.remove(os.path.join(ckpt, "commits", "1"))                   # a stop between the merge and Spark's commit
    if os.path.exists(os.path.join(ckpt, "commits", ".1.crc")):
        os.remove(os.path.join(ckpt, "commits", ".1.crc"))
    assert rows(drain(spark, src, empty, root, ckpt)) == want and versions(root) == ["batch=0", "batch=1"]


def test_a_version_that_was_not_finished_does_not_count(spark, tmp):
    src, root = os.path.join(tmp, "in"), os.path.join(tmp, "table")
    os.makedirs(os.path.join(root, "batch=0"))                      # a write that ended before _SUCCESS
    land(spark, src, "f0", [("a", "1", 1)])
    base = spark.createDataFrame([("z", "0")], "k string, v string")
    assert last_version(spark, root) is None
    assert rows(drain(spark, src, base, root, os.path.join(tmp, "ckpt"))) == [("a", "1"), ("z", "0")]


def test_registered_updates_land_as_the_files_of_several_tasks(spark, tmp, monkeypatch):
    """No update goes through one task, and the merged table is that of the batch merge."""
    import __spark_entry__ as entry
    from parcelgrid import session
    from tests.conftest import SF_SMALL
    for name in ("lineitem", "orders", "part", "supplier"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").limit(2000).repartition(3).write.parquet(f"{tmp}/{name}.parquet")
    made, real = {}, session.shared_dir
    monkeypatch.setattr(session, "shared_dir", lambda s, name: made.setdefault(name, real(s, name)))
    got = entry.queries()["stream_merge"](spark, tmp)
    want = entry.queries()["baseline_plus_update"](spark, tmp)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    landing = session.local_path(made["sales-landing"])
    assert [len(glob.glob(f"{landing}/part={k}/part-*")) > 1 for k in range(3)] == [True] * 3
