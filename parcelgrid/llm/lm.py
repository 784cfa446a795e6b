"""Language-model scores by stupid backoff, computed with grouped counts and joins.

    S(w | v) = c(vw) / c(v)        if vw is in the table
             = alpha * c(w) / N    otherwise; the first word of a text: c(w) / N

Words and bigrams are n-grams of one kind: each has a key, a 64-bit hash of its words (two n-grams of one key would count as one; no check
follows).  Logarithms add up, so a text's score is a sum over its n-grams: its bigrams' ln c, less ln c of every word but
the last, plus ln c of the first word, less ln N.

``score`` counts and scores the same texts.  Their n-grams are exploded once into (key, text, n) and dealt out by key once.  A partition then holds
all rows of its keys: it counts them, joins the counts back to the rows and adds up per text, and a second, smaller shuffle
brings the parts of each text together.  On the way the rows travel as blocks, arrays of one partition's rows from up to ``BLOCK`` rows of a task, about a third of
the bytes of single rows; what a partition sends back is one block for each that it got.  Every n-gram of the texts is in the table then, so nothing backs off.
``score_against`` scores texts by the counts of another corpus, with plain joins; there bigrams that the corpus lacks back off.

Hot keys: the ``NEAR`` most frequent words and ``HOT`` most frequent bigrams of every ``EVERY``-th text are counted over all texts, shipped with their
counts and added up where the text is read, so they never are keys of the shuffle.  Which ones these are changes no score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import discard, named, release_shuffles, written

ALPHA = 0.4
#: bigrams and words that are shipped, 16 and some 100 bytes each in a task
HOT = 1 << 16
NEAR = 1 << 17
EVERY = 16
#: rows that a task gathers before it sends blocks (and texts, numbered by 16 bits), and about how many rows a partition gets at most
BLOCK = 1 << 21
_TEXTS = 1 << 16
PARTITION = 3_000_000
#: kinds of exploded rows: a bigram, a word (and how often it is the first or last of the text)
_PAIR, _WORD = 0, 1


def word_hashes(found: list[bytes]) -> np.ndarray:
    """64-bit hashes of words."""
    return pd.util.hash_array(np.array([*found, None], dtype=object)[:-1], categorize=False)


def pair_keys(h: np.ndarray) -> np.ndarray:
    """Keys of the bigrams of a text from the hashes of its words."""
    x = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + (h[1:] ^ (h[1:] >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))).view(np.int64)


class Numbers(dict):
    """Word -> number; every other word is number 0."""

    def __missing__(self, word: bytes) -> int:
        return 0


@dataclass
class Shipped:
    """Frequent words (joined by a space, numbered from 1) and hot bigrams (keys in ascending order), with the logarithms of their counts."""

    words: bytes = b""
    word_logs: np.ndarray = field(default_factory=lambda: np.zeros(1))
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    key_logs: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @cached_property
    def numbers(self) -> Numbers:
        """Made once in a worker process; the driver never needs it."""
        return Numbers((w, i + 1) for i, w in enumerate(self.words.split()))

    @cached_property
    def near(self) -> np.ndarray:
        return np.concatenate((np.zeros(1, np.uint64), word_hashes(self.words.split())))

    def read(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Hash and number of each word (0: not shipped)."""
        found = (text or "").encode().split()
        ids = np.array(list(map(self.numbers.__getitem__, found)), dtype=np.int64)
        out = self.near[ids]
        far = np.flatnonzero(ids == 0)
        if len(far):
            out[far] = word_hashes([found[i] for i in far])
        return out, ids

    def hot(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key among the hot ones, -1 for others."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)

    def open_rows(self, h: np.ndarray, ids: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        """Of a text with words: the part of its score that shipped counts give, and the rows of all other n-grams: keys, how often each
        occurs, and its kind: ``_PAIR``, or for a word ``_WORD`` plus one each if it is the first and the last of the text."""
        part = float(self.word_logs[ids[[0, -1]]].sum() - self.word_logs[ids].sum())
        pairs, n = np.unique(pair_keys(h), return_counts=True)
        at = self.hot(pairs)
        part += float((self.key_logs[at[at >= 0]] * n[at >= 0]).sum())
        pairs, n = pairs[at < 0], n[at < 0]
        words, n_words = np.unique(h[ids == 0].view(np.int64), return_counts=True)
        kind = np.full(len(words), _WORD)
        for end in (0, -1):
            if ids[end] == 0:
                kind[np.searchsorted(words, h[end:][:1].view(np.int64))] += 1
        return part, np.concatenate((pairs, words)), np.concatenate((n, n_words)), np.concatenate((np.full(len(pairs), _PAIR), kind))


def weights(n: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """How often ln c of an n-gram counts in the text's score."""
    return np.where(kind == _PAIR, n, kind - _WORD - n)


def _frequent(texts: DataFrame, near: int, hot: int) -> Shipped:
    """Words and bigrams that are most frequent in every ``EVERY``-th text, at most ``near`` and ``hot``; counts to follow."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, words, keys = Shipped(), Counter(), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words.update((text or "").encode().split())
                keys.update(pair_keys(plain.read(text)[0]).tolist())
        for found, kind in ((words.most_common(2 * near), 0), (keys.most_common(2 * hot), 1)):
            if found:
                some, n = zip(*found, strict=True)
                none = [None] * len(some)
                yield pa.RecordBatch.from_arrays([pa.array(none if kind else some, pa.binary()), pa.array(some if kind else none, pa.int64()), pa.array(n, pa.int64())],
                                                 names=["word", "key", "n"])

    found = texts.where(F.monotonically_increasing_id() % EVERY == 0).mapInArrow(run, "word binary, key long, n long").groupBy("word", "key").agg(F.sum("n").alias("n"))
    found = written(found, "frequent")

    def top(c: str, most: int) -> pd.Series:
        """Those with the largest counts, ``most`` or fewer.  The number of rows per count comes to the driver first (there are at most the
        root of twice their sum of different counts), so that no task sends more than is taken."""
        some = found.where(F.col(c).isNotNull())
        per = some.groupBy("n").agg(F.count("*").alias("rows")).toPandas().sort_values("n", ascending=False)
        fits = per["n"][per["rows"].cumsum() <= most]
        return some.where(F.col("n") >= (int(fits.iloc[-1]) if len(fits) else 1 << 62)).select(c).toPandas()[c]

    words, keys = sorted(bytes(w) for w in top("word", near)), np.sort(top("key", hot).to_numpy(np.int64))
    discard(texts.sparkSession, found)
    return Shipped(b" ".join(words), keys=keys)


def _count(texts: DataFrame, shipped: Shipped) -> tuple[Shipped, int]:
    """What is shipped with its counts over all texts, and the number of words; a task sends one row for each."""
    held = texts.sparkSession.sparkContext.broadcast(shipped)
    n_words = len(shipped.words.split()) + 1  # number 0 counts the other words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = held.value
        total = np.zeros(n_words + len(s.keys), dtype=np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                each = [s.read(text) for text in batch.column(0).slice(start, 64).to_pylist()]
                total[:n_words] += np.bincount(np.concatenate([ids for _, ids in each]), minlength=n_words)
                at = s.hot(np.concatenate([pair_keys(h) for h, _ in each]))
                total[n_words:] += np.bincount(at[at >= 0], minlength=len(s.keys))
        at = np.flatnonzero(total)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])

    rows = texts.mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(n_words + len(shipped.keys), dtype=np.int64)
    out[rows["at"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    held.unpersist()
    logs = np.log(np.maximum(out, 1))
    logs[0] = 0.0
    return Shipped(shipped.words, logs[:n_words], shipped.keys, logs[n_words:]), int(out[:n_words].sum())


def _blocks(held, log_total: float, parts: int, schema: pa.Schema):
    """(id, text) -> a row for each text (its number, words and the part of its score that needs no join), and blocks of the n-grams that are left,
    one for each partition that they go to: keys, numbers of the texts (from the ``first`` of the block), occurrences and kinds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = held.value
        first = TaskContext.get().partitionId() << 40
        rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = texts = 0

        def send() -> Iterator[pa.RecordBatch]:
            keys, n, kind = (np.concatenate([r[k] for r in rows]) for k in range(3))
            of = np.repeat(np.arange(len(rows), dtype=np.uint16), [len(r[0]) for r in rows])
            goes = ((keys.view(np.uint64) >> np.uint64(20)) % np.uint64(parts)).astype(np.int32)
            order = np.argsort(goes, kind="stable")
            keys, n, kind, of, goes = keys[order], n[order].astype(np.int32), kind[order].astype(np.uint8), of[order], goes[order]
            cuts = np.append(np.flatnonzero(np.concatenate(([True], goes[1:] != goes[:-1]))), len(goes)) if len(goes) else np.zeros(1, np.int64)
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                yield _batch(schema, part=[int(goes[a])], first=[first], keys=[keys[a:b].tobytes()], texts=[of[a:b].tobytes()], n=[n[a:b].tobytes()], kinds=[kind[a:b].tobytes()])

        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                words, scores = [], []
                for text in batch.column(1).to_pylist():
                    h, ids = s.read(text)
                    part, *row = s.open_rows(h, ids) if len(h) else (log_total, *([np.zeros(0, np.int64)] * 3))
                    words.append(len(h))
                    scores.append(part - log_total)
                    rows.append(tuple(row))
                    size += len(row[0])
                number = np.arange(len(rows) - batch.num_rows, len(rows))
                yield _batch(schema, id=batch.column(0), part=(number % parts).astype(np.int32), first=np.full(len(number), first), number=number.astype(np.int32), words=words, score=scores)
                if size >= BLOCK or len(rows) + 256 > _TEXTS:
                    yield from send()
                    first, rows, size = first + len(rows), [], 0
        if rows:
            yield from send()
    return run


def _batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A batch with the given columns, the others null."""
    size = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([c if isinstance(c := columns.get(f.name), pa.Array) else pa.nulls(size, f.type) if c is None else pa.array(c, f.type) for f in schema], schema=schema)


def _joined(schema: pa.Schema):
    """Of all blocks of a partition: counts of its keys, joined back to the rows and added up per text of each block; rows of texts pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = []
        for batch in batches:
            texts = batch.filter(pc.is_valid(batch.column("words")))
            if texts.num_rows:
                yield _batch(schema, **{c: texts.column(c) for c in schema.names if c != "sums"})
            for r in batch.filter(pc.is_valid(batch.column("keys"))).select(["first", "keys", "texts", "n", "kinds"]).to_pylist():
                blocks.append((r["first"], *(np.frombuffer(r[c], t) for c, t in (("keys", np.int64), ("texts", np.uint16), ("n", np.int32), ("kinds", np.uint8)))))
        if not blocks:
            return
        keys, n = np.concatenate([b[1] for b in blocks]), np.concatenate([b[3] for b in blocks])
        order = np.argsort(keys)
        keys = keys[order]
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        logs = np.empty(len(keys))
        logs[order] = np.repeat(np.log(np.add.reduceat(n[order].astype(np.int64), starts)), np.diff(np.append(starts, len(keys))))
        del keys, order
        at = 0
        for first, own, texts, n, kinds in blocks:
            found = np.bincount(texts, weights=weights(n.astype(np.int64), kinds.astype(np.int64)) * logs[at:at + len(own)])
            at += len(own)
            some = np.flatnonzero(found)  # an n-gram that occurs once adds ln 1
            if len(some):
                yield _batch(schema, first=[first], texts=[some.astype(np.uint16).tobytes()], sums=[found[some].tobytes()])
    return run


def _summed(schema: pa.Schema):
    """The rows of texts, with the parts that the blocks of the same ``first`` have for them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        texts = []
        for batch in batches:
            texts.append(batch.filter(pc.is_valid(batch.column("words"))))
            for r in batch.filter(pc.is_valid(batch.column("sums"))).select(["first", "texts", "sums"]).to_pylist():
                sums.setdefault(r["first"], np.zeros(_TEXTS))[np.frombuffer(r["texts"], np.uint16)] += np.frombuffer(r["sums"])
        for batch in texts:
            if batch.num_rows:
                more = [sums[f][k] if f in sums else 0.0 for f, k in zip(batch.column("first").to_pylist(), batch.column("number").to_pylist(), strict=True)]
                score = pc.add(batch.column("score"), pa.array(more, pa.float64()))
                yield _batch(schema, id=batch.column("id"), n_words=batch.column("words"), log_score=score)
    return run


def _result(summed: DataFrame, id_col: str) -> DataFrame:
    mean = F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words"))
    return summed.select(F.col("id").alias(id_col), "n_words", "log_score", mean.alias("mean_log_score"))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, near: int = NEAR) -> DataFrame:
    """One row per row of ``docs``: id, n_words, log_score (sum of ln S over the words) and mean_log_score, by the counts of all texts.

    Null and blank texts have no words, score 0 and a null mean.  Rows that repeat (same id or text) are
    texts of their own and are counted as such; null ids are allowed; an empty
    table gives no rows; further columns are not read; very long texts are scored whole."""
    spark = docs.sparkSession
    rows = docs.select(named(docs, id_col).alias("id"), named(docs, text_col).alias("text"))
    shipped, total = _count(rows.select("text"), _frequent(rows.select("text"), near, hot))
    held = spark.sparkContext.broadcast(shipped)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PARTITION))
    release_shuffles(spark)

    fields = lambda *cs: [T.StructField(c, t) for c, t in cs]
    blob, long = T.BinaryType(), T.LongType()
    text = [rows.schema["id"], *fields(("first", long), ("number", T.IntegerType()), ("words", long), ("score", T.DoubleType()), ("texts", blob))]
    wide = T.StructType([*text, *fields(("part", T.IntegerType()), ("keys", blob), ("n", blob), ("kinds", blob))])
    back = T.StructType([*text, *fields(("sums", blob))])
    out = T.StructType([rows.schema["id"], *fields(("n_words", long), ("log_score", T.DoubleType()))])
    dealt = rows.mapInArrow(_blocks(held, math.log(max(total, 1)), parts, to_arrow_schema(wide)), wide).repartitionById(parts, F.col("part"))
    home = dealt.mapInArrow(_joined(to_arrow_schema(back)), back).repartition(parts, "first")
    return _result(home.mapInArrow(_summed(to_arrow_schema(out)), out), id_col)


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("v", T.LongType()), T.StructField("w", T.LongType()), T.StructField("n", T.LongType())])))
def _bigrams(texts: pd.Series) -> pd.Series:
    plain, out = Shipped(), []
    for text in texts:
        h = plain.read(text)[0].view(np.int64).tolist()
        out.append([{"v": v, "w": w, "n": n} for (v, w), n in Counter(zip([0, *h], h, strict=False)).items()])
    return pd.Series(out)


def score_against(docs: DataFrame, corpus: DataFrame, id_col: str = "doc_id", text_col: str = "text", alpha: float = ALPHA) -> DataFrame:
    """Scores of ``docs`` as in :func:`score`, by the counts of ``corpus``: a bigram that the corpus lacks backs off to alpha * c(w) / N, and a word that it
    lacks counts as if it occurred once.  The first word of a text is a bigram with nothing before it."""
    pairs = lambda df, *keep: df.select(*keep, F.explode_outer(_bigrams(named(df, text_col))).alias("g")).select(*keep, "g.*")
    known = pairs(corpus).where(F.col("w").isNotNull()).groupBy("v", "w").agg(F.sum("n").alias("c"))
    words = known.groupBy("w").agg(F.sum("c").alias("c"))
    total = words.agg(F.sum("c")).first()[0] or 1
    rows = docs.select(named(docs, id_col).alias("id"), named(docs, text_col).alias(text_col), F.monotonically_increasing_id().alias("row"))
    asked = pairs(rows, "id", "row")
    seen = asked.join(known.where(F.col("v") != 0), ["v", "w"], "left")
    of = lambda name: words.select(F.col("w").alias(name), F.col("c").alias("c" + name))
    full = seen.join(of("v"), "v", "left").join(of("w"), "w", "left")
    single = F.log(F.coalesce("cw", F.lit(1)) / F.lit(float(total)))
    s = F.when(F.col("w").isNull(), F.lit(0.0)).when(F.col("v") == 0, single).when(F.col("c").isNotNull(), F.log(F.col("c") / F.col("cv"))).otherwise(single + math.log(alpha))
    return _result(full.groupBy("row").agg(F.first("id").alias("id"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_words"),
                                           F.sum(F.coalesce("n", F.lit(0)) * s).alias("log_score")), id_col)
