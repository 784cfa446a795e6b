"""Keyed merge rules as DataFrame transformations.

Each rule is ``(target, batch, ...) -> new target``; the caller writes the
result to a new table version (``sources.tables.write_version``).  The
same functions serve batch loads and streaming ``foreachBatch``.

First/last row per key is ``min``/``max`` over a struct that starts with
the sequence column: deterministic even on ties, and an algebraic aggregate
that Spark combines map-side, so a key holding a third of the batch is
reduced inside each task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelgrid.session import dealt, shared_dir, written


def qcol(name: str) -> Column:
    """Column by exact name (dots and spaces are part of the name)."""
    return F.col("`" + name.replace("`", "``") + "`")


def _keys_not_null(key: list[str]) -> Column:
    cond = F.lit(True)
    for k in key:
        cond = cond & F.col(k).isNotNull()
    return cond


def _pick(batch: DataFrame, key: list[str], seq: str, last: bool) -> DataFrame:
    cols = [c for c in batch.columns if c not in key and c != seq]
    agg = F.max if last else F.min
    packed = F.struct(F.col(seq).alias("_seq"), *[F.col(c) for c in cols])
    return (batch.groupBy(*key).agg(agg(packed).alias("_row"))
                 .select(*key, *[F.col(f"_row.{c}").alias(c) for c in cols]))


def _align(df: DataFrame, like: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Project ``df`` onto ``like``'s columns; absent ones get defaults."""
    defaults = defaults or {}
    types = dict(like.dtypes)
    out = []
    for c in like.columns:
        if c in df.columns:
            out.append(F.col(c).cast(types[c]).alias(c))
        else:
            v = defaults.get(c)
            out.append((v if isinstance(v, Column) else F.lit(v)).cast(types[c]).alias(c))
    return df.select(*out)


def dedup_first(batch: DataFrame, key: list[str], seq: str) -> DataFrame:
    """First row per key in ``seq`` order (the batch-level drop_duplicates)."""
    return _pick(batch, key, seq, last=False)


def dedup_last(batch: DataFrame, key: list[str], seq: str) -> DataFrame:
    return _pick(batch, key, seq, last=True)


def merge_keep_first(target: DataFrame, batch: DataFrame, key: list[str], seq: str,
                     null_key: str = "drop", defaults: dict | None = None) -> DataFrame:
    """B1, INSERT OR IGNORE: rows whose key is already in the target are
    ignored; inside the batch the first row per key wins.  NULL keys never
    clash in SQL: ``null_key='keep_all'`` appends them all, ``'drop'``
    drops them."""
    ok = batch.where(_keys_not_null(key))
    new = dedup_first(ok, key, seq).join(target.select(*key), key, "left_anti")
    out = target.unionByName(_align(new, target, defaults))
    if null_key == "keep_all":
        out = out.unionByName(_align(batch.where(~_keys_not_null(key)), target, defaults))
    elif null_key != "drop":
        raise ValueError(null_key)
    return out


def merge_keep_last(target: DataFrame, batch: DataFrame, key: list[str], seq: str,
                    defaults: dict | None = None) -> DataFrame:
    """B2, INSERT OR REPLACE: the last batch row per key replaces the target
    row; target columns the batch does not carry go back to ``defaults``."""
    ok = batch.where(_keys_not_null(key))
    last = dedup_last(ok, key, seq)
    kept = target.join(last.select(*key), key, "left_anti")
    return kept.unionByName(_align(last, target, defaults))


def append_rows(target: DataFrame, batch: DataFrame, dedup_on: list[str] | None = None,
                seq: str | None = None) -> DataFrame:
    """Plain append (surrogate-key table).  With ``dedup_on``, batch rows
    whose dedup key is already present are skipped and the batch keeps its
    first row per key in ``seq`` order, which is then required."""
    b = batch
    if dedup_on:
        if not seq:
            raise ValueError("dedup_on needs seq: without an order the row that stays is arbitrary")
        b = dedup_first(b.where(_keys_not_null(dedup_on)), dedup_on, seq)
        b = b.join(target.select(*dedup_on).distinct(), dedup_on, "left_anti")
    return target.unionByName(_align(b, target))


def surrogate_ids(batch: DataFrame, order: list[str], id_col: str = "id", after: int = 0) -> DataFrame:
    """Rows numbered ``after`` + 1, ... in the given order, without one window over all rows: range partitions are sorted by
    themselves, and each begins where the rows of those before it end.  Rows that tie in the order are numbered in an arbitrary one."""
    spark = batch.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the partition in the upper bits, the place in the sorted partition in the lower 33
    place = F.monotonically_increasing_id()
    placed = written(batch.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_place", place), "numbered")
    placed = placed.withColumn("_part", F.shiftright("_place", 33)).withColumn("_own", F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)) + 1)
    per = placed.groupBy("_part").agg(F.max("_own").alias("_n"))
    # one row a partition
    start = per.withColumn("_start", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    numbered = placed.join(F.broadcast(start.select("_part", "_start")), "_part")
    return numbered.select((F.lit(after) + F.col("_start") + F.col("_own")).cast("long").alias(id_col), *[F.col(c) for c in batch.columns])


def append_numbered(target: DataFrame, batch: DataFrame, order: list[str], id_col: str = "id") -> DataFrame:
    """B3 with its surrogate key: batch rows follow the target's largest id, in the given order."""
    last = target.agg(F.max(id_col)).first()[0]
    return target.unionByName(_align(surrogate_ids(batch, order, id_col, last or 0), target))


def rejected_units(target: DataFrame, batch: DataFrame, key: list[str], unit: str) -> DataFrame:
    """Units (files) of ``batch`` that do not load when units load in name order: a
    key is already in the target, or twice in the unit, or in an earlier unit that did load.

    Units without a key of another unit are settled at once.  Among the others,
    each round takes the units that come first for all their keys, turns away
    those that share a key with them, and goes on with what is left, written to
    the shared folder; the smallest unit left is always settled."""
    spark = batch.sparkSession
    per = batch.select(*key, unit).where(_keys_not_null(key)).groupBy(*key, unit).agg(F.count(F.lit(1)).alias("_n"))
    bad = (per.where("_n > 1").select(unit)
           .unionByName(per.join(target.select(*key).distinct(), key, "left_semi").select(unit)).distinct())

    def kept(df: DataFrame, name: str) -> DataFrame:
        path = shared_dir(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    free = kept(per.drop("_n").join(bad, unit, "left_anti"), "units")
    rivals = free.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*key)
    left = kept(free.join(rivals, key, "left_semi"), "contested")
    rounds = []
    while not left.isEmpty():
        first = left.groupBy(*key).agg(F.min(unit).alias("_first"))
        taken = left.join(first, key).groupBy(unit).agg(F.bool_and(F.col(unit) == F.col("_first")).alias("_ok")).where("_ok")
        taken = kept(taken.select(unit), "loaded")
        keys = left.join(taken, unit, "left_semi").select(*key).distinct()
        rest = left.join(taken, unit, "left_anti")
        lost = kept(rest.join(keys, key, "left_semi").select(unit).distinct(), "rejected")
        rounds.append(lost)
        left = kept(rest.join(lost, unit, "left_anti"), "contested")
    for lost in rounds:
        bad = bad.unionByName(lost)
    return bad


def append_reject(target: DataFrame, batch: DataFrame, key: list[str], unit: str) -> DataFrame:
    """Append in unit order; a unit with any clash contributes no rows, and
    its keys stay free for later units."""
    bad = rejected_units(target, batch, key, unit)
    good = batch.join(bad, unit, "left_anti")
    return target.unionByName(_align(good, target))


def update_by_key(target: DataFrame, changes: DataFrame, key: list[str], cols: list[str]) -> DataFrame:
    """B5, keyed UPDATE: matched rows take ``cols`` from ``changes``; other
    rows are unchanged.  A key twice in ``changes`` fails the job; rows of
    ``changes`` with a null key match nothing."""
    news = F.struct(*[F.col(c).alias(f"_new_{c}") for c in cols])
    grouped = changes.where(_keys_not_null(key)).groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.any_value(news).alias("_row"))
    unique = F.when(F.col("_n") > 1, F.raise_error(F.lit("update_by_key: a key has several changes"))).otherwise(F.lit(True))
    ch = grouped.select(*key, "_row.*", unique.cast("boolean").alias("_hit"))
    j = target.join(dealt(ch), key, "left")
    out = []
    for c in target.columns:
        if c in cols:
            out.append(F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).cast(dict(target.dtypes)[c]).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def conform(df: DataFrame, mapping: dict[str, object], required: list[str] | None = None,
            constants: dict | None = None) -> DataFrame:
    """Select + rename (+ cast via Column values), drop rows with a NULL
    required column, add constant columns."""
    sel = [(qcol(src) if isinstance(src, str) else src).alias(dst) for dst, src in mapping.items()]
    out = df.select(*sel)
    for name, v in (constants or {}).items():
        out = out.withColumn(name, v if isinstance(v, Column) else F.lit(v))
    if required:
        out = out.na.drop(subset=required)
    return out


def quarantine(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Split rows into (good, bad).  ``rules`` maps a reason to a
    predicate that is true for a bad row; the first failing rule names the
    reason.  Both outputs come from one lazily shared input."""
    reason = F.lit(None).cast("string")
    for name, bad in reversed(list(rules.items())):
        reason = F.when(F.coalesce(bad, F.lit(False)), F.lit(name)).otherwise(reason)
    tagged = df.withColumn("_reason", reason)
    return (tagged.where(F.col("_reason").isNull()).drop("_reason"),
            tagged.where(F.col("_reason").isNotNull()))
