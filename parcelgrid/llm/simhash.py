"""SimHash near-duplicates through an inverted index on fingerprint bytes.

A fingerprint is 64 bits, eight positional bytes.  Two fingerprints that differ
in at most ``d`` bits differ in at most ``d`` bytes, so they share at least
``8 - d`` positional bytes: that is the guaranteed minimum of the count filter.

Posting lists of single bytes hold a 256th of the corpus each, so tallying over
them pairs everything with everything.  The lists used here are those of
*triples* of positional bytes: a family of position triples such that any
``8 - d`` positions contain one of them (20 triples for ``d = 4``, the
known smallest number) finds every pair that can reach the minimum, from lists
of a 2^24th.  The tally of shared positional bytes is then taken per pair, pairs
under the minimum are dropped, and the bit distance decides.

Within one list not all pairs are formed.  The list's most frequent fingerprint
is its centre; members within ``d`` bits of it are linked to the centre
alone, and only the others are compared with the list.  Two members of one list
that are both linked to the centre are connected through it, so the components
are those of all links.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, named, written
from .components import components

BYTES = 8
_CHUNK = 1 << 15


def position_sets(shared: int) -> list[tuple[int, ...]]:
    """Position sets such that any ``shared`` of the eight byte positions contain
    one of them.  Four or more shared bytes: the three-class system of
    triples (a triple inside a class, or two of a class and one of the next)."""
    if not 1 <= shared <= BYTES:
        raise ValueError("the bit distance must leave at least one shared byte (0..7 bits)")
    if shared < 4:
        return list(combinations(range(BYTES), shared))
    group = [p % 3 for p in range(BYTES)]
    out = []
    for t in combinations(range(BYTES), 3):
        n = [sum(group[p] == g for p in t) for g in range(3)]
        if 3 in n or any(n[g] == 2 and n[(g + 1) % 3] == 1 for g in range(3)):
            out.append(t)
    return out


def text_fingerprint(text: str | None, shingle: int) -> int:
    """Majority bits of the XXH64 values (seed 42) of all word shingles, as a
    signed 64-bit number; 0 for a text without words."""
    w = (text or "").encode().lower().split()  # bytes.split: space and 0x09-0x0D; bytes.lower: A-Z
    if not w:
        return 0
    line = b" ".join(w)
    ends = np.cumsum([len(x) + 1 for x in w]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(w))
    spans = list(zip(starts[: len(w) - k + 1].tolist(), ends[k - 1:].tolist(), strict=True))
    h64, ones = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for at in range(0, len(spans), _CHUNK):
        h = np.array([h64(line[a:b], 42) for a, b in spans[at:at + _CHUNK]], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(spans), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = 4, out_col: str = "fp") -> DataFrame:
    """``docs`` without its text, with the fingerprint (long) of each row.

    Null and blank texts get 0.  Texts are hashed row by row in Arrow
    batches, whole and in chunks of shingles, so a very long text needs
    memory for itself only.  Rows are neither merged nor dropped."""
    keep = [c for c in docs.columns if c != text_col]
    if out_col in keep:
        raise ValueError(f"the frame has a column {out_col} already")

    @F.pandas_udf(T.LongType())
    def fp(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([text_fingerprint(t, shingle) for t in texts], dtype="int64")

    return docs.select(*[named(docs, c) for c in keep], fp(named(docs, text_col)).alias(out_col))


def _byte(fp: Column, position: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * position).bitwiseAND(F.lit(255))


def _postings(fps: DataFrame, sets: list[tuple[int, ...]]) -> DataFrame:
    """One row per (fingerprint, position set): the set's bytes are the list's key."""
    def mask(s):
        m = sum(255 << (8 * p) for p in s)
        return m - (1 << 64) if m >> 63 else m
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(mask(s)).cast("long")) for s in sets])
    return fps.select("fp", "n", F.posexplode(keys).alias("set", "key"))


def links(fps: DataFrame, max_bits: int) -> DataFrame:
    """(a, b, shared, bits): links between distinct fingerprints at ``max_bits`` or
    fewer bits whose components are those of all such links.  ``fps`` has one
    row per fingerprint: fp (long), n (documents that carry it)."""
    need = BYTES - max_bits
    sets = position_sets(need)
    post = _postings(fps, sets)
    lists = post.groupBy("set", "key").agg(F.count("*").alias("members"), F.max(F.struct("n", "fp")).alias("top"))
    centre = written(lists.where("members > 1").select("set", "key", F.col("top.fp").alias("centre")), "lists")
    placed = post.join(centre, ["set", "key"]).where("fp != centre")

    def tally(x: Column, y: Column) -> Column:
        return reduce(lambda p, q: p + q, [(_byte(x, p) == _byte(y, p)).cast("int") for p in range(BYTES)])

    def near(df: DataFrame, x: str, y: str) -> DataFrame:
        shared = tally(F.col(x), F.col(y))
        bits = F.bit_count(F.col(x).bitwiseXOR(F.col(y)))
        return (df.where(shared >= need).where(bits <= max_bits)
                .select(F.col(x).alias("a"), F.col(y).alias("b"), shared.alias("shared"), bits.alias("bits")))

    apart = placed.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("centre"))) > max_bits)
    others = post.select("set", "key", F.col("fp").alias("other"))
    pairs = apart.select("set", "key", "fp").join(others, ["set", "key"]).where("fp != other")
    return near(placed, "fp", "centre").union(near(pairs, "fp", "other")).distinct()


def classes(fps: DataFrame, id_col: str, max_bits: int, fp_col: str = "fp") -> DataFrame:
    """(fp, root, component_id): the smallest id reachable from each fingerprint by links
    of ``max_bits`` or fewer differing bits.  One row per distinct
    fingerprint; exact copies are one fingerprint.  Null ids are ignored by the
    minimum (a component of null ids alone has a null component_id)."""
    per = written(fps.groupBy(named(fps, fp_col).alias("fp"))
                  .agg(F.count("*").alias("n"), F.min(named(fps, id_col)).alias("first")), "fingerprints")
    comp = written(components(links(per.select("fp", "n"), max_bits), "a", "b"), "components")
    placed = per.join(comp, per.fp == comp.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    ids = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    return written(placed.join(ids, "root").select("fp", "root", "component_id"), "classes")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One row per row of ``docs``: id, fp (long), component_id.

    Rows that repeat (same id or same text) each get their row; texts without
    words have fingerprint 0 and are linked like any other; an empty table
    gives no rows; further columns of ``docs`` are not read."""
    fps = written(fingerprints(docs.select(named(docs, id_col).alias("id"), named(docs, text_col).alias("text")),
                               "text", shingle), "row-fingerprints")
    group = classes(fps, "id", max_bits)
    return fps.join(group, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with one row of each near-duplicate component: the one with the
    smallest id (nulls last), then the smallest text hash; of fully equal rows one
    stays.  Columns are those of ``docs``."""
    hashed, rank = fresh(docs, "__text_hash", "__rank")
    slim = docs.select(named(docs, id_col).alias("id"), named(docs, text_col).alias("text"),
                       F.xxhash64(named(docs, text_col)).alias("th"))
    fps = written(fingerprints(slim, "text", shingle), "row-fingerprints")
    group = classes(fps, "id", max_bits)
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "th")).alias("b")
    keep = written(fps.join(group, "fp").groupBy("root").agg(first).select("b.id", "b.th"), "kept")
    rows = docs.withColumn(hashed, F.xxhash64(named(docs, text_col)))
    hit = rows.join(keep, named(rows, id_col).eqNullSafe(keep["id"]) & (rows[hashed] == keep["th"]), "left_semi")
    equal = Window.partitionBy(named(hit, id_col), hit[hashed]).orderBy(F.lit(1))
    one = hit.withColumn(rank, F.row_number().over(equal)).where(F.col(rank) == 1)
    return one.select(*[named(one, c) for c in docs.columns])
