"""Ranked lexical search over hashed max-sketches.

Every document is folded into a sketch: its terms are hashed to ``COORDINATES`` places, and a place holds the
largest impact of the terms that fall there.  For a given document the impact grows with the term's frequency, so the sketch
stores the largest frequency and the document's length, and the impacts follow once the mean length is known.
Adding up a query's weights times the impacts at its terms' places gives an upper bound of the score, for
all queries of a block at once.

Exact scores come in rounds.  A round takes, per query, the next ``window`` documents in descending order of the bound
(equal bounds by id) and scores them on their whole texts; the window grows fourfold from ``k``.  It takes only documents that
could still enter the k best: a bound above the k-th exact score so far, or equal to it with a smaller id.  A
query ends when none is left, so the k best are exact.

Score (integers; ``div`` rounds down): the sum over a query's different terms of
``w * ((10^9 * tf) div (1000 * tf + 20 * m))`` with ``w = floor(1000 * ln((2 N + 2) / (2 df + 1)))`` and
``m = 50 + (50 * n * N) div L``; N documents with a term, L all their terms, n those of the document.

Sizes: queries go through in blocks of about ``BLOCK``; a block's terms, weights and thresholds are all that the driver
holds and ships.  A task sends at most ``window`` rows a query.  A round's candidates are broadcast to the documents only
when they are counted to be ``SHIP`` or fewer, and else joined by a shuffle.

Defined results: a null or empty text (or one of separators) has no term: as a document it counts nowhere, as an item it finds nothing.
A null id is the last of equal scores, and is kept.  Rows that agree in id and text are found as often as they occur; items that agree in id and text count
once.  Documents without any shared term do not appear.  With no documents or items the result is empty.  Columns beside those named are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, named, shared_path, written

COORDINATES = 1 << 20
BLOCK = 1024
#: candidates that are broadcast: id, hash and queries of a document, some tens of bytes each
SHIP = 500_000
_DOCS = 64
# a term is a run of ASCII letters, digits and characters beyond ASCII; of these A-Z become lower case
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Terms of a text in order, in UTF-8."""
    return (text or "").encode().translate(_TERM_BYTES).split()


def place(term: bytes) -> int:
    return zlib.crc32(term) & (COORDINATES - 1)


def sketch(terms: list[bytes]) -> tuple[list[int], list[int]]:
    """Places in ascending order and the largest frequency at each."""
    out: dict[int, int] = {}
    for t, tf in Counter(terms).items():
        p = place(t)
        if out.get(p, 0) < tf:
            out[p] = tf
    at = sorted(out)
    return at, [out[p] for p in at]


class Queries:
    """A block of queries: their terms, and what scoring needs of the corpus."""

    def __init__(self, ids: list, texts: list[str]):
        self.ids = ids
        bags = [sorted(set(terms_of(t))) for t in texts]
        self.terms = sorted({t for b in bags for t in b})
        self.number = {t: i for i, t in enumerate(self.terms)}
        self.of = [[self.number[t] for t in b] for b in bags]
        self.weights = np.zeros(len(self.terms), dtype=np.int64)
        self.docs = self.total = 0
        #: per query the k-th best (score, order of its id) so far, and the last key of the rounds before; None for none
        self.floor: list = [None] * len(ids)
        self.cursor: list = [None] * len(ids)
        self.open = [bool(b) for b in bags]

    def weigh(self, df: np.ndarray, docs: int, total: int) -> None:
        self.docs, self.total = docs, total
        self.weights = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * int(n) + 1))) for n in df], dtype=np.int64)

    def lookup(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each place a number (-1: no term), and per number where its (query, weight) rows lie."""
        rows = sorted((place(self.terms[t]), q, int(self.weights[t])) for q, b in enumerate(self.of) if self.open[q] for t in b)
        slot = np.full(COORDINATES, -1, dtype=np.int32)
        used = sorted({p for p, _, _ in rows})
        slot[used] = np.arange(len(used), dtype=np.int32)
        per = np.bincount(slot[[p for p, _, _ in rows]], minlength=len(used)) if rows else np.zeros(0, np.int64)
        return slot, np.concatenate(([0], np.cumsum(per))), np.array([q for _, q, _ in rows], dtype=np.int64), np.array([w for _, _, w in rows], dtype=np.int64)

    def norm(self, n):
        return 50 + (50 * n * self.docs) // self.total

    def score(self, q: int, tf: Counter, m: int) -> int:
        return sum(int(self.weights[t]) * ((10**9 * f) // (1000 * f + 20 * m)) for t in self.of[q] if (f := tf.get(self.terms[t], 0)))


def index(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, h, n, at, tf) of every document with a term: hash of the text, number of terms and the sketch."""
    rows = docs.select(named(docs, id_col).alias("id"), F.xxhash64(named(docs, text_col)).alias("h"), named(docs, text_col).alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("h", T.LongType()), T.StructField("n", T.LongType()),
                           T.StructField("at", T.ArrayType(T.IntegerType())), T.StructField("tf", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, _DOCS):
                batch = whole.slice(start, _DOCS)
                bags = [terms_of(t) for t in batch.column(2).to_pylist()]
                keep = [i for i, b in enumerate(bags) if b]
                if keep:
                    made = [sketch(bags[i]) for i in keep]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(keep)), batch.column(1).take(pa.array(keep)), pa.array([len(bags[i]) for i in keep], pa.int64()),
                         pa.array([a for a, _ in made], pa.list_(pa.int32())), pa.array([f for _, f in made], pa.list_(pa.int32()))], names=["id", "h", "n", "at", "tf"])

    return written(rows.mapInArrow(run, schema), "sketches")


def document_frequencies(docs: DataFrame, text_col: str, queries: Queries) -> np.ndarray:
    """In how many documents each term of the block occurs; a task sends one row a term."""
    shipped = docs.sparkSession.sparkContext.broadcast(queries.number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shipped.value
        held = np.zeros(len(number), dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                held[[number[t] for t in number.keys() & set(terms_of(text.as_py()))]] += 1
        at = np.flatnonzero(held)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], names=["t", "n"])

    rows = docs.select(named(docs, text_col)).mapInArrow(run, "t long, n long").groupBy("t").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(len(queries.terms), dtype=np.int64)
    out[rows["t"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    shipped.unpersist()
    return out


def _order(doc_id) -> tuple:
    """Sorts ids in ascending order, null last."""
    return (1, 0) if doc_id is None else (0, doc_id)


def bounds(queries: Queries, found: tuple, n: np.ndarray, doc: np.ndarray, at: np.ndarray, tf: np.ndarray) -> np.ndarray:
    """Upper bounds (documents x queries) from sketches laid end to end; all sums are whole numbers below 2^53."""
    slot, start, query, weight = found
    number = slot[at]
    hit = number >= 0
    number, doc, tf = number[hit], doc[hit], tf[hit].astype(np.int64)
    impact = (10**9 * tf) // (1000 * tf + 20 * queries.norm(n)[doc])
    many = start[number + 1] - start[number]
    row = np.repeat(start[number] - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())
    cell = np.repeat(doc * len(queries.ids), many) + query[row]
    return np.bincount(cell, weights=weight[row] * np.repeat(impact, many), minlength=len(n) * len(queries.ids)).reshape(len(n), -1)


def _next(shipped, window: int):
    """Per task and query the next ``window`` documents behind the cursor that could enter the k best."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shipped.value
        found = queries.lookup()
        low = np.array([max(1, f[0]) if f else 1 for f in queries.floor], dtype=np.float64)
        high = np.array([-c[0] if c else np.inf for c in queries.cursor], dtype=np.float64)
        best: list[list] = [[] for _ in queries.ids]
        least = low.copy()  # rises to the window-th bound of this task
        ids = None
        for whole in batches:
            ids = whole.schema.field(0).type
            for start in range(0, whole.num_rows, _DOCS):
                batch = whole.slice(start, _DOCS)
                at, tf = batch.column(3), batch.column(4)
                doc = np.repeat(np.arange(batch.num_rows), np.diff(at.offsets.to_numpy()))
                b = bounds(queries, found, batch.column(2).to_numpy(), doc, at.flatten().to_numpy(), tf.flatten().to_numpy())
                where = np.nonzero((b >= least) & (b <= high))
                if not len(where[0]):
                    continue
                doc_ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                for d, q in zip(*(x.tolist() for x in where), strict=True):
                    key = (-int(b[d, q]), _order(doc_ids[d]), hashes[d])
                    floor, cursor = queries.floor[q], queries.cursor[q]
                    if (cursor and key <= cursor) or (floor and key[:2] >= (-floor[0], floor[1])):
                        continue
                    best[q].append(key)
                    if len(best[q]) >= 4 * window:
                        best[q] = sorted(set(best[q]))[:window]
                        if len(best[q]) == window:
                            least[q] = max(low[q], -best[q][-1][0])
        rows = [(q, key) for q, keys in enumerate(best) for key in sorted(set(keys))[:window]]
        for start in range(0, len(rows), 10_000):
            part = rows[start:start + 10_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([q for q, _ in part], pa.int32()), pa.array([None if k[1][0] else k[1][1] for _, k in part], ids),
                 pa.array([k[2] for _, k in part], pa.int64()), pa.array([-k[0] for _, k in part], pa.int64())], names=["q", "id", "h", "bound"])
    return run


def _exact(shipped):
    """Scores of (id, h, text, queries) rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shipped.value
        for batch in batches:
            rows: list[tuple[int, int, int]] = []
            for i, (text, asked) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                terms = terms_of(text.as_py())
                tf, m = Counter(terms), queries.norm(len(terms))
                rows += [(q, i, queries.score(q, tf, m)) for q in asked.as_py()]
            if rows:
                q, i, score = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), batch.column(0).take(pa.array(i)), pa.array(score, pa.int64())], names=["q", "id", "score"])
    return run


def _best(rows: DataFrame, by: list, order: list, k: int, name: str = "rank") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(name) <= k)


def _rescore(docs: DataFrame, id_col: str, text_col: str, picked: DataFrame, shipped) -> DataFrame:
    """(q, id, score) of the picked (q, id, h) documents, on their whole texts."""
    per_doc = picked.groupBy(F.col("id").alias("_id"), F.col("h").alias("_h")).agg(F.collect_list("q").alias("_asked"))
    if picked.count() <= SHIP:
        per_doc = F.broadcast(per_doc)
    rows = docs.select(named(docs, id_col).alias("id"), named(docs, text_col).alias("text"))
    rows = rows.join(per_doc, F.col("id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_h"))).select("id", "_h", "text", "_asked")
    return rows.mapInArrow(_exact(shipped), T.StructType([T.StructField("q", T.IntegerType()), rows.schema["id"], T.StructField("score", T.LongType())]))


def _search_block(docs: DataFrame, id_col: str, text_col: str, sketches: DataFrame, queries: Queries, k: int) -> list[DataFrame]:
    """Rounds until no query of the block is open; the scored rows, written, with a score above 0."""
    spark = docs.sparkSession
    scored: list[DataFrame] = []
    window = k
    by_id = F.col("id").asc_nulls_last()
    while any(queries.open):
        shipped = spark.sparkContext.broadcast(queries)
        schema = T.StructType([T.StructField("q", T.IntegerType()), sketches.schema["id"], T.StructField("h", T.LongType()), T.StructField("bound", T.LongType())])
        found = sketches.mapInArrow(_next(shipped, window), schema).distinct()  # equal rows are scored together
        picked = written(_best(found, ["q"], [F.col("bound").desc(), by_id, F.col("h").asc()], window), "picked")
        ends = {r.q: r for r in picked.groupBy("q").agg(F.max(F.struct("rank", "bound", "id", "h")).alias("last")).collect()}
        if ends:
            scored.append(written(_rescore(docs, id_col, text_col, picked, shipped).where(F.col("score") > 0), "scored"))
            so_far = reduce(DataFrame.unionByName, scored)
            floors = _best(so_far, ["q"], [F.col("score").desc(), by_id], k).where(F.col("rank") == k).collect()
            for r in floors:
                queries.floor[r.q] = (r.score, _order(r.id))
        for q in range(len(queries.ids)):
            last = ends[q].last if q in ends else None
            queries.open[q] = bool(last) and last.rank == window  # a window that was not filled holds all that was left
            if last:
                queries.cursor[q] = (-last.bound, _order(last.id), last.h)
        discard(spark, picked)
        shipped.unpersist()
        window *= 4
    return scored


def search(docs: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", block: int = BLOCK) -> DataFrame:
    """(item id, rank, doc id, score): the ``k`` best documents of every item, score above 0, equal scores by ascending id."""
    spark = docs.sparkSession
    asked = written(items.select(named(items, item_id).alias("id"), named(items, item_text).alias("text")).distinct(), "items")
    sketches = index(docs, doc_id, text)
    n_docs, total = sketches.agg(F.count("*"), F.sum("n")).first()
    out_type = T.StructType([T.StructField("item", asked.schema["id"].dataType), T.StructField("rank", T.IntegerType()),
                             T.StructField("doc", sketches.schema["id"].dataType), T.StructField("score", T.LongType())])
    n_blocks = -(-asked.count() // block)
    path, made = shared_path(spark, "ranked"), False
    for b in range(n_blocks if n_docs else 0):
        rows = asked.where(F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks)) == b).collect()  # about ``block`` rows
        rows = sorted(rows, key=lambda r: (_order(r.id), r.text or ""))
        queries = Queries([r.id for r in rows], [r.text for r in rows])
        if not queries.terms:
            continue
        queries.weigh(document_frequencies(docs, text, queries), n_docs, total)
        scored = _search_block(docs, doc_id, text, sketches, queries, k)
        if scored:
            best = _best(reduce(DataFrame.unionByName, scored), ["q"], [F.col("score").desc(), F.col("id").asc_nulls_last()], k)
            names = spark.createDataFrame([(q, i) for q, i in enumerate(queries.ids)], T.StructType([T.StructField("q", T.IntegerType()), T.StructField("item", asked.schema["id"].dataType)]))
            out = best.join(F.broadcast(names), "q").select("item", F.col("rank").cast("int").alias("rank"), F.col("id").alias("doc"), "score")
            out.write.mode("append").parquet(path)
            made = True
            discard(spark, *scored)
    discard(spark, sketches, asked)
    found = spark.read.schema(out_type).parquet(path) if made else spark.createDataFrame([], out_type)
    return found.select(F.col("item").alias(item_id), "rank", F.col("doc").alias(doc_id), "score")
