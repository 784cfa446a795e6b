"""As-of join: each left row with the latest right row at or before it.

Time is cut into buckets.  Within a bucket both sides are ordered together and the last right row is carried on; a bucket begins
with the last right row of the buckets before it.  Only one row per bucket is ordered over all time, so that window grows with the
time span and not with the rows.  Left rows of a bucket are dealt to ``SALTS`` tasks, each with the bucket's right rows, so an
hour with a third of all rows is shared out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_SECONDS = 3600
SALTS = 16


def asof_join(left: DataFrame, right: DataFrame, left_time: str, right_time: str, carry: list[str], bucket_seconds: int = BUCKET_SECONDS,
              salts: int = SALTS) -> DataFrame:
    """All left rows with the ``carry`` columns of the right row with the largest ``right_time`` not after ``left_time``; null when there is none or
    the left time is null.  Of right rows at one instant the one with the largest carried values counts."""
    bucket = lambda c: F.floor(F.unix_micros(c) / F.lit(bucket_seconds * 1_000_000))
    instant = lambda c: F.col(c).cast("timestamp")
    known = (right.where(F.col(right_time).isNotNull()).groupBy(instant(right_time).alias("_t")).agg(F.max(F.struct(*carry)).alias("_r"))
             .withColumn("_b", bucket(F.col("_t"))))
    rows = left.withColumn("_t", instant(left_time)).withColumn("_b", bucket(F.col("_t")))

    last = known.groupBy("_b").agg(F.max_by("_r", "_t").alias("_last"))
    seen = last.unionByName(rows.where(F.col("_b").isNotNull()).select("_b").distinct(), allowMissingColumns=True).groupBy("_b").agg(F.max("_last").alias("_last"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = seen.select("_b", F.last("_last", ignorenulls=True).over(before).alias("_in"))

    salt = lambda c: F.pmod(F.xxhash64(c), F.lit(salts))
    whole = F.struct(*[F.col(c) for c in left.columns])
    both = rows.select("_b", salt(F.col("_t")).alias("_s"), "_t", F.lit(1).alias("_k"), whole.alias("_l")).unionByName(
        known.select("_b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("_s"), "_t", F.lit(0).alias("_k"), "_r"), allowMissingColumns=True)
    upto = Window.partitionBy("_b", "_s").orderBy("_t", "_k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("_m", F.last("_r", ignorenulls=True).over(upto)).where(F.col("_k") == 1).join(carried, "_b", "left")
    match: Column = F.coalesce("_m", "_in")
    return found.select(*[F.col("_l")[c].alias(c) for c in left.columns], *[match[c].alias(c) for c in carry])
