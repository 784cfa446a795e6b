"""Substring dedup: remove every word that a repeated window of words covers.

A window is ``width`` consecutive words of one text.  Each window gets a
Rabin-Karp hash (a polynomial over 64-bit word hashes, modulo 2**64 with an odd
base), the hashes are counted over the corpus, and repeated windows merge into
maximal intervals.

Volume is kept down without losing a window by the minimizer of each window: the
smallest hash among its short grams.  Equal windows have equal minimizers, so a
window can only repeat if its minimizer occurs twice; there is about one
minimizer occurrence per ten words, and these are counted first.  Windows
with a unique minimizer are unique and need no counting; all others are counted
by their own hash.  Counting adds up inside each task before the shuffle,
and the join that brings positions back reads a written table of distinct
hashes, so Spark can split a hot hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, named, release_shuffles, slices, written

WIDTH = 35
#: odd multiplier of the rolling hash and its inverse modulo 2**64
BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)


def minimizer_gram(width: int) -> int:
    """Words per minimizer gram: a little over half the window, so that grams are
    seldom shared by chance and a window still has several to choose from."""
    return max(1, (4 * width) // 7)


def _powers(b: int, n: int) -> np.ndarray:
    out = np.full(n, b, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Words(dict):
    """Word -> 64-bit hash, cleared when it has grown to its bound."""

    BOUND = 500_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.BOUND:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def word_hashes(text: str | None, cache: _Words) -> np.ndarray:
    w = (text or "").encode().split()
    return np.fromiter(map(cache.__getitem__, w), dtype=np.uint64, count=len(w))


class Roller:
    """Rolling hashes of all k-grams of a word-hash array."""

    def __init__(self, h: np.ndarray):
        n = len(h)
        self.up = _powers(BASE, n + 1)
        # sum of h[j] * base**-j over a prefix; a gram's hash is its difference times base**start
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * _powers(_INVERSE, n + 1)[:n], dtype=np.uint64)))

    def grams(self, k: int) -> np.ndarray:
        return (self.sums[k:] - self.sums[:-k]) * self.up[: len(self.sums) - k]


def _mixed(x: np.ndarray) -> np.ndarray:
    """Bit mix, so that the order of hashes says nothing about the words."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def window_hashes(h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of every window, minimizer of every window, all gram hashes)."""
    roll, k = Roller(h), minimizer_gram(width)
    grams = _mixed(roll.grams(k))
    low, have, want = grams, 1, width - k + 1
    while have < want:  # sliding minimum by doubling
        step = min(have, want - have)
        low, have = np.minimum(low[:-step], low[step:]), have + step
    return _mixed(roll.grams(width)), low, grams


def _signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def _minimizers(width: int):
    """The distinct minimizers of a text; one that occurs twice or more in it is listed twice."""
    @F.pandas_udf(T.ArrayType(T.LongType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache = _Words()
        for texts in slices(batches):
            out = []
            for text in texts:
                h = word_hashes(text, cache)
                if len(h) < width:
                    out.append(None)
                    continue
                _, low, grams = window_hashes(h, width)
                values, times = np.unique(grams, return_counts=True)
                m = np.unique(low)
                out.append(_signed(np.repeat(m, np.minimum(times[np.searchsorted(values, m)], 2))))
            yield pd.Series(out, dtype=object)
    return run


def _windows(width: int):
    """(h, at) of the windows whose minimizer is in the row's list."""
    @F.pandas_udf(T.StructType([T.StructField("h", T.ArrayType(T.LongType())), T.StructField("at", T.ArrayType(T.IntegerType()))]))
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        cache = _Words()
        for texts, lists in slices(batches):
            wins, starts = [], []
            for text, listed in zip(texts, lists, strict=True):
                win, low, _ = window_hashes(word_hashes(text, cache), width)
                at = np.flatnonzero(np.isin(_signed(low), np.asarray(listed, dtype=np.int64)))
                wins.append(_signed(win[at]))
                starts.append(at.astype(np.int32))
            yield pd.DataFrame({"h": pd.Series(wins, dtype=object), "at": pd.Series(starts, dtype=object)})
    return run


def repeated_windows(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(id, th, starts): per text, the sorted starts of all windows whose hash occurs at two or more places
    in the (id, text) rows of ``docs``; texts without one are not listed.  ``th`` hashes the text; (id, th) names a row."""
    spark = docs.sparkSession
    rows = docs.where(F.col("text").isNotNull()).select("id", F.xxhash64("text").alias("th"), "text")
    mins = written(rows.select("id", "th", F.explode(_minimizers(width)("text")).alias("m")), "minimizers")
    twice = written(mins.groupBy("m").agg(F.count("*").alias("n")).where("n > 1").select("m"), "repeated-minimizers")
    # per text, its repeated minimizers: at most one entry per word of the text
    listed = written(mins.join(twice, "m", "left_semi").groupBy("id", "th").agg(F.collect_set("m").alias("mins")), "listed")
    release_shuffles(spark)
    cand = rows.join(listed.withColumnsRenamed({"id": "lid", "th": "lth"}),
                     F.col("id").eqNullSafe(F.col("lid")) & (F.col("th") == F.col("lth"))).select("id", "th", "text", "mins")
    found = cand.select("id", "th", _windows(width)("text", "mins").alias("w"))
    wins = written(found.select("id", "th", F.explode(F.arrays_zip("w.h", "w.at")).alias("w"))
                   .select("id", "th", "w.h", "w.at"), "windows")
    discard(spark, mins, twice, listed)
    release_shuffles(spark)
    again = written(wins.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "repeated-hashes")
    release_shuffles(spark)
    starts = wins.join(again, "h", "left_semi").groupBy("id", "th").agg(F.sort_array(F.collect_set("at")).alias("starts"))
    starts = written(starts, "starts")
    discard(spark, wins, again)
    release_shuffles(spark)
    return starts


def merged(starts: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Maximal [from, to) intervals covered by windows at sorted distinct ``starts``."""
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > width)
    first = starts[np.concatenate(([0], breaks + 1))]
    last = starts[np.concatenate((breaks, [len(starts) - 1]))] + width
    return list(zip(first.tolist(), last.tolist(), strict=True))


_CUT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                     T.StructField("kept", T.StringType()),
                     T.StructField("spans", T.ArrayType(T.StructType([T.StructField("from", T.IntegerType()),
                                                                      T.StructField("to", T.IntegerType())])))])


def _cutter(width: int):
    @F.pandas_udf(_CUT)
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, starts in slices(batches):
            out = []
            for text, at in zip(texts, starts, strict=True):
                w = (text or "").encode().split()
                spans = merged(np.asarray(at, dtype=np.int64), width) if at is not None else []
                kept, pos = [], 0
                for a, b in spans:
                    kept += w[pos:a]
                    pos = b
                kept += w[pos:]
                out.append((len(w), len(w) - len(kept), b" ".join(kept).decode(), [{"from": a, "to": b} for a, b in spans]))
            yield pd.DataFrame(out, columns=["n_words", "n_removed", "kept", "spans"])
    return cut


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, kept (the words left,
    joined by one space), spans (the removed word intervals).

    A word goes when a window of ``width`` words that covers it also starts
    anywhere else, in the same text or another; all occurrences go, and
    windows are judged on the input.  Null texts have no words; texts shorter than a window
    keep all; rows that repeat (same id and text) repeat each other's windows.  Null
    ids are allowed; an empty table gives no rows; further columns are not read."""
    slim = docs.select(named(docs, id_col).alias("id"), named(docs, text_col).alias("text"))
    per = repeated_windows(slim, width)
    rows = slim.withColumn("th", F.xxhash64("text"))
    j = rows.join(per.withColumnsRenamed({"id": "pid", "th": "pth"}),
                  F.col("id").eqNullSafe(F.col("pid")) & (F.col("th") == F.col("pth")), "left")
    cut = j.select(F.col("id").alias(id_col), _cutter(width)(F.col("text"), F.col("starts")).alias("cut"))
    return cut.select(id_col, "cut.n_words", "cut.n_removed", "cut.kept", "cut.spans")
