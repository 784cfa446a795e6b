"""Owners above a company in an ownership edge list.

``ancestors`` gives every owner above every company.  A table of (child, ancestor, depth) pairs is joined to itself: pairs up to d steps
give all pairs up to 2 d steps, so the number of rounds is the logarithm of the longest
chain and there is no depth limit.  Each round keeps one row per pair (the smallest depth), so layered
graphs with many paths do not blow up.  A company is not its own
ancestor: pairs that return to their start are dropped.  The rounds end when no pair is added or shortened.

``ultimate_owners`` needs only the end of each chain and keeps one row per company and round (pointer jumping): a company
points to an owner, and a round moves each pointer to where that owner's pointer stands.  A chain of n companies takes log2 n rounds of n rows.

Every round is written to the session's shared checkpoint folder (lineage cut, survives executor loss), and the round before it is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelgrid.session import discard, shared_dir, written


def ancestors(edges: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """All (child, ancestor, depth); depth is the length of the shortest chain."""
    spark = edges.sparkSession
    root = shared_dir(spark, "ancestors")
    pairs = edges.select(F.col(child).alias("child"), F.col(parent).alias("ancestor"), F.lit(1).alias("depth")).where(
        F.col("child").isNotNull() & F.col("ancestor").isNotNull() & (F.col("child") != F.col("ancestor"))).distinct()
    known, step, before = None, 0, None
    while True:
        path = f"{root}/round={step}"
        pairs.write.parquet(path)
        pairs = spark.read.parquet(path)
        if before is not None:
            discard(before)
        size = tuple(pairs.agg(F.count("*"), F.sum("depth")).first())
        if size == known:
            return pairs
        known, step, before = size, step + 1, pairs
        up = pairs.select(F.col("child").alias("_c"), F.col("ancestor").alias("_a"), F.col("depth").alias("_d"))
        longer = (pairs.join(up, F.col("ancestor") == F.col("_c")).where(F.col("child") != F.col("_a"))
                  .select("child", F.col("_a").alias("ancestor"), (F.col("depth") + F.col("_d")).alias("depth")))
        pairs = pairs.unionByName(longer).groupBy("child", "ancestor").agg(F.min("depth").alias("depth"))


def _climb(follow: DataFrame) -> tuple[DataFrame, int]:
    """(child, at, depth, done) of every company once the pointers stand still, and how many are not done: those never reach a company
    without an owner.  While any open company has an end above it, the nearest such company is done a round later, so a
    round that finishes none leaves only companies below a cycle."""
    state = written(follow.select("child", "at", F.lit(1).alias("depth"), F.lit(False).alias("done")), "owners")
    left = state.count()
    while left:
        up = state.select(F.col("child").alias("_c"), F.col("at").alias("_a"), F.col("depth").alias("_d"), F.col("done").alias("_f"))
        moved = state.where(~F.col("done")).join(up, F.col("at") == F.col("_c"), "left").select(
            "child", F.coalesce("_a", "at").alias("at"), (F.col("depth") + F.coalesce("_d", F.lit(0))).alias("depth"),
            (F.col("_c").isNull() | F.coalesce("_f", F.lit(False))).alias("done"))
        after = written(state.where("done").unionByName(moved), "owners")
        discard(state)
        state, before, left = after, left, after.where(~F.col("done")).count()
        if left == before:
            break
    return state, left


def _cycle_heads(follow: DataFrame, n: int) -> DataFrame:
    """The smallest member (child) of each cycle, given n companies that all end in one.  After n steps or more every pointer
    stands on a cycle, and each member of a cycle has passed all of it."""
    state, steps = written(follow.select("child", "at", F.col("at").alias("least")), "cycles"), 1
    while steps < n:
        up = state.select(F.col("child").alias("_c"), F.col("at").alias("_a"), F.col("least").alias("_l"))
        after = written(state.join(up, F.col("at") == F.col("_c")).select("child", F.col("_a").alias("at"), F.least("least", "_l").alias("least")), "cycles")
        discard(state)
        state, steps = after, 2 * steps
    members = state.select(F.col("at").alias("child")).distinct()
    heads = written(state.join(members, "child").select(F.col("least").alias("child")).distinct(), "heads")
    discard(state)
    return heads


def ultimate_owners(edges: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """(child, ultimate_owner, depth): the end of each company's chain of owners and the steps to it.  Of several owners the
    largest name is followed.  A cycle ends at its smallest member, for its own members and for all below it; that member has
    no row, as a company at the top of a chain has none.  Rows with a null or with a company that owns itself do not count."""
    usable = F.col(child).isNotNull() & F.col(parent).isNotNull() & (F.col(child) != F.col(parent))
    follow = written(edges.where(usable).groupBy(F.col(child).alias("child")).agg(F.max(parent).alias("at")), "follow")
    state, n = _climb(follow)
    ends = state.where("done")
    if n:
        below_cycles = follow.join(state.where(~F.col("done")).select("child"), "child", "left_semi")
        heads = _cycle_heads(below_cycles, n)
        rest, _ = _climb(below_cycles.join(heads, "child", "left_anti"))
        ends = ends.unionByName(rest)
        discard(heads)
    discard(follow)
    return ends.select("child", F.col("at").alias("ultimate_owner"), "depth")
