"""Language ID by nearest centroids.

A text becomes a vector of its letter n-grams (one to three characters, words padded with a space,
whatever is no letter read as a space): frequency times inverse document frequency, hashed into ``SPACE``
coordinates and scaled to length one.  Each language has up to ``CLUSTERS`` centroids; a text takes the language of
the centroid with the largest cosine.  The distance decides on rejection: each centroid has a least cosine, the
``REJECT`` quantile of the learning texts that chose it rightly, and a text below that of its centroid is marked.

* Document frequencies count every learning text.
* Clusters are fitted (spherical k-means) on a bounded sample: the ``SAMPLE`` different texts of a language with the smallest hash.
  This is the only bounded step; each language is fitted in a task of its own, on sparse vectors.
* Predictions and least cosines take all texts.

The driver holds the centroids: languages x ``CLUSTERS`` x ``SPACE`` floats, 64 KB each.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and counts as rejected.  A text whose n-grams
all are unknown has score 0 and the first language in order.  A null label, or a null ``learn``, takes no part in learning;
with nothing to learn from, every text is ``und``.  Equal cosines go to the first language in order.
Repeated rows each get their row; a repeated text counts once in the sample and each time in the frequencies.  A text of any length
is read whole; its n-grams are counted in pieces of ``PIECE`` characters.  Columns beside those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import named, slices, written

BITS = 14
SPACE = 1 << BITS
CLUSTERS = 4
SAMPLE = 1000
ROUNDS = 12
REJECT = 0.005
PIECE = 1 << 20
NONE = "und"
_GRAMS = 3
_BLANK = 32
# odd multipliers of the hash, one per length
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


@cache
def _letters() -> np.ndarray:
    """Which code points are letters; made once in a worker."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def letters_of(text: str | None) -> np.ndarray:
    """Code points of the lower-cased text, every run of other characters as one blank, a blank at both ends; empty without a letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le"), dtype=np.uint32)
    is_letter = _letters()[codes]
    if not is_letter.any():
        return codes[:0]
    after = np.concatenate(([False], is_letter[:-1]))
    kept = is_letter | after  # a blank only behind a letter
    body = np.where(is_letter, codes, np.uint32(_BLANK))[kept]
    ends = [] if body[-1] == _BLANK else [_BLANK]
    return np.concatenate(([_BLANK], body, ends)).astype(np.uint32)


def gram_counts(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates that the n-grams of the letters take, and how often."""
    total = np.zeros(SPACE, dtype=np.int64)
    for at in range(0, len(codes), PIECE):
        piece = codes[at:at + PIECE + _GRAMS - 1]
        new = min(PIECE, len(codes) - at)  # n-grams that start here; the rest of the piece is only their end
        h = np.zeros(len(piece), dtype=np.uint32)
        for n in range(1, _GRAMS + 1):
            h = (h[:len(piece) - n + 1] + piece[n - 1:]) * _MIX[n - 1]
            mine = h[:new]
            if n == 1:
                mine = mine[piece[:new] != _BLANK]
            total += np.bincount(((mine ^ (mine >> np.uint32(15))) * _MIX[1]) >> np.uint32(32 - BITS), minlength=SPACE)
    at = np.flatnonzero(total)
    return at, total[at]


def unit_vector(codes: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates and values of the normalised vector; all weights zero gives a vector of zeros."""
    at, tf = gram_counts(codes)
    v = tf * idf[at]
    size = np.sqrt(v @ v)
    return at, v / size if size else v


@dataclass
class Model:
    """``centroids`` has a column for each centroid; ``langs`` names the language of each."""

    idf: np.ndarray
    langs: list[str]
    centroids: np.ndarray

    def nearest(self, text: str | None) -> tuple[int, float]:
        """Number of the nearest centroid and the cosine; -1 without a letter or a centroid."""
        codes = letters_of(text)
        if not len(codes) or not self.langs:
            return -1, 0.0
        at, v = unit_vector(codes, self.idf)
        cosines = v @ self.centroids[at]
        best = int(np.argmax(cosines))
        return best, float(min(1.0, max(0.0, cosines[best])))


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Over all rows with a letter: how many hold each coordinate, and their number.  A task sends one row per coordinate."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros(SPACE, dtype=np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                codes = letters_of(text.as_py())
                if len(codes):
                    held[gram_counts(codes)[0]] += 1
                    n += 1
        if n:
            at = np.append(np.flatnonzero(held), -1)  # coordinate -1 stands for the rows
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(held[at[:-1]], n))], names=["at", "n"])

    rows = texts.mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(SPACE + 1, dtype=np.int64)
    out[rows["at"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)  # -1 is the last place
    return out[:-1], int(out[-1])


def cluster(x: np.ndarray, k: int, rounds: int = ROUNDS) -> list[np.ndarray]:
    """Spherical k-means on unit rows: starts at rows spread evenly over the order of their cosine to the mean; empty clusters go."""
    mean = x.sum(axis=0)
    order = np.argsort(-(x @ mean), kind="stable")
    centers = x[order[np.linspace(0, len(x) - 1, min(k, len(x)) * 2 + 1).astype(int)[1::2]]]
    owner = None
    for _ in range(rounds):
        now = np.argmax(x @ centers.T, axis=1)
        if owner is not None and (now == owner).all():
            break
        owner = now
        sums = np.stack([x[owner == j].sum(axis=0) for j in range(len(centers)) if (owner == j).any()])
        centers = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return list(centers)


def _sample(train: DataFrame, size: int) -> DataFrame:
    """(lang, h, text) of the ``size`` different texts of each language with the smallest hash."""
    hashed = train.withColumn("h", F.xxhash64("text"))
    keys = hashed.select("lang", "h").distinct()
    # hashes are spread evenly, so the smallest ``size`` lie below four times their share of the range; only these are ordered
    share = keys.groupBy("lang").agg((F.lit(4.0 * size) / F.count("*")).alias("share"))
    low = keys.join(F.broadcast(share), "lang").where((F.col("h").cast("double") + 2.0**63) / 2.0**64 <= F.col("share")).select("lang", "h")
    few = low.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("k") <= size).drop("k")
    return hashed.join(F.broadcast(few), ["lang", "h"], "left_semi").groupBy("lang", "h").agg(F.first("text").alias("text"))


def learn(train: DataFrame, clusters: int = CLUSTERS, sample: int = SAMPLE) -> Model:
    """Model from (text, lang) rows without nulls."""
    df, n = document_frequencies(train.select("text"))
    idf = np.where(df > 0, np.log((1.0 + n) / (1.0 + df)) + 1.0, 0.0)
    weights = train.sparkSession.sparkContext.broadcast(idf)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, h, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                codes = letters_of(text)
                if len(codes):
                    at, v = unit_vector(codes, weights.value)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang]), pa.array([h]), pa.array([at.astype(np.int32)]), pa.array([v.astype(np.float32)])], names=["lang", "h", "at", "v"])

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("h")
        x = np.zeros((len(group), SPACE), dtype=np.float32)
        for i, (at, v) in enumerate(zip(group["at"], group["v"], strict=True)):
            x[i, at] = v
        found = cluster(x, clusters)
        return pd.DataFrame({"lang": group["lang"].iloc[0], "k": range(len(found)), "centroid": [c.astype(np.float32).tobytes() for c in found]})

    sparse = _sample(train.select("text", "lang"), sample).select("lang", "h", "text").mapInArrow(
        vectors, "lang string, h long, at array<int>, v array<float>")
    rows = sorted(sparse.groupBy("lang").applyInPandas(fit, "lang string, k int, centroid binary").collect(), key=lambda r: (r.lang, r.k))
    centroids = np.array([np.frombuffer(r.centroid, np.float32) for r in rows], dtype=np.float64).reshape(len(rows), SPACE).T
    return Model(idf, [r.lang for r in rows], np.ascontiguousarray(centroids))


def identify(docs: DataFrame, learn_from: Column, text: str = "text", lang: str = "lang", carry: tuple[str, ...] = ("doc_id",),
             clusters: int = CLUSTERS, sample: int = SAMPLE, reject: float = REJECT) -> DataFrame:
    """The ``carry`` columns, ``learned`` (whether the row was learned from), ``lang_pred``, ``score`` (cosine) and ``rejected`` of every row."""
    spark = docs.sparkSession
    rows = docs.select(*[named(docs, c) for c in carry], named(docs, text).alias("_text"), named(docs, lang).cast("string").alias("_lang"),
                       F.coalesce(learn_from, F.lit(False)).alias("_learn"))
    usable = F.col("_learn") & F.col("_lang").isNotNull() & F.col("_text").isNotNull()
    model = learn(rows.where(usable).select(F.col("_text").alias("text"), F.col("_lang").alias("lang")), clusters, sample)
    shipped = spark.sparkContext.broadcast(model)

    @F.pandas_udf(T.StructType([T.StructField("centroid", T.IntegerType()), T.StructField("score", T.DoubleType())]))
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in slices(batches):
            yield pd.DataFrame([shipped.value.nearest(t) for t in texts], columns=["centroid", "score"])

    names = F.create_map(*[x for i, name in enumerate(model.langs) for x in (F.lit(i), F.lit(name))]) if model.langs else None
    found = (rows.withColumn("_p", predict("_text")).withColumn("_centroid", F.col("_p.centroid"))
             .withColumn("_pred", F.lit(NONE) if names is None else F.coalesce(F.try_element_at(names, F.col("_centroid")), F.lit(NONE)))
             .select(*carry, "_learn", "_lang", "_centroid", "_pred", F.col("_p.score").alias("_score")))
    found = written(found, "languages")
    # one row a centroid
    least = (found.where(F.col("_learn") & (F.col("_lang") == F.col("_pred"))).groupBy("_centroid")
             .agg(F.percentile_approx("_score", F.lit(reject), F.lit(10_000)).alias("_least")))
    out = found.join(F.broadcast(least), "_centroid", "left")
    return out.select(*carry, F.col("_learn").alias("learned"), F.col("_pred").alias("lang_pred"), F.col("_score").alias("score"),
                      ((F.col("_centroid") < 0) | (F.col("_score") < F.coalesce("_least", F.lit(0.0)))).alias("rejected"))
