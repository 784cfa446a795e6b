"""Line dedup with overlapping three-line windows.

The unit is a window of three consecutive lines (lines without a visible
character do not count; spaces and tabs at the ends of a line are ignored).
Window hashes are counted over the whole corpus; of a window that
occurs more than once, every occurrence after the first is removed, and
overlapping occurrences merge into the removed stretch.  "First" is the smallest
(id, position).  Only hashes and positions are shuffled for the search;
texts move once, when the removals are applied.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, named, written

WINDOW = 3
#: ignored at both ends of a line, fixed values: space, tab, vertical tab, form feed, carriage return
MARGIN = " \t\x0b\x0c\r"


def _visible(text: Column) -> Column:
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(MARGIN)))
    return F.array_remove(lines, "")


def windows(docs: DataFrame) -> DataFrame:
    """(id, th, at, h1, h2) for every window of (id, text) rows; ``at`` counts
    visible lines from 0, (h1, h2) is a 128-bit hash of the three lines."""
    lines = docs.select("id", F.xxhash64("text").alias("th"), _visible(F.col("text")).alias("lines")).where(
        F.size("lines") >= WINDOW)

    def window(first: Column, lines: Column) -> Column:
        part = [F.get(lines, first + i) for i in range(WINDOW)]
        return F.struct(first.alias("at"), F.xxhash64(*part).alias("h1"),
                        F.xxhash64(F.lit(1), *part).alias("h2"))

    # the outer one-element transform binds the line array once per row
    each = F.transform(F.array("lines"), lambda a: F.transform(
        F.sequence(F.lit(0), F.size(a) - WINDOW), lambda i: window(i, a)))
    return lines.select("id", "th", F.explode(F.flatten(each)).alias("w")).select("id", "th", "w.at", "w.h1", "w.h2")


def later_windows(wins: DataFrame) -> DataFrame:
    """(id, th, at) of every window whose three lines occur at a smaller (id, th, at)."""
    place = F.struct(F.col("id").isNull().alias("none"), "id", "th", "at")
    seen = wins.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    repeated = written(seen.where("first < last").select("h1", "h2", "first"), "repeated-windows")
    return wins.join(repeated, ["h1", "h2"]).where(place > F.col("first")).select("id", "th", "at")


@F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("n_removed", T.LongType())]))
def _without(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for texts, starts in batches:
        out, removed = [], []
        for text, at in zip(texts, starts, strict=True):
            if at is None:
                out.append(None)
                removed.append(0)
                continue
            covered = {s + i for s in at for i in range(WINDOW)}
            kept, seen = [], 0
            for line in text.split("\n"):
                if line.strip(MARGIN):
                    seen += 1
                    if seen - 1 in covered:
                        continue
                kept.append(line)
            out.append("\n".join(kept))
            removed.append(len(covered))
        yield pd.DataFrame({"text": out, "n_removed": pd.Series(removed, dtype="int64")})


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                removed_col: str | None = None) -> DataFrame:
    """``docs`` with later repeats of three-line windows cut out of the text.

    Same columns and rows; with ``removed_col`` a long column counts the lines
    removed.  A text of fewer than three visible lines, a null and an
    empty text stay as they are.  Lines without a visible character stay.  Rows
    of equal id and text are one document: they are treated alike and do not
    repeat each other.  Null ids come last in the order.  An empty table gives an empty table.
    """
    th, starts, cut = fresh(docs, "__text_hash", "__starts", "__cut")
    slim = docs.select(named(docs, id_col).alias("id"), named(docs, text_col).alias("text"))
    later = later_windows(windows(slim))
    per = (later.groupBy("id", "th").agg(F.sort_array(F.collect_set("at")).alias(starts))
           .select(F.col("id").alias(th + "i"), F.col("th").alias(th + "h"), starts))
    rows = docs.withColumn(th, F.xxhash64(named(docs, text_col)))
    hit = rows.join(per, named(rows, id_col).eqNullSafe(per[th + "i"]) & (rows[th] == per[th + "h"]), "left")
    touched = F.col(starts).isNotNull()
    done = hit.withColumn(cut, _without(F.when(touched, named(hit, text_col)), F.col(starts)))
    cols = [(F.when(touched, F.col(f"{cut}.text")).otherwise(named(done, c)).alias(c) if c == text_col
             else named(done, c)) for c in docs.columns]
    if removed_col:
        cols.append(F.col(f"{cut}.n_removed").alias(removed_col))
    return done.select(*cols)
