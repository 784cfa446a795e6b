"""Benchmark decontamination: BM25 retrieval of test items for every passage.

The benchmark is the indexed side and the corpus is the query side.  An item's BM25
impacts are divided by the item's score against itself, so a passage that
holds all of an item's terms scores 1 and one threshold serves all items.
Items are ordered by length and grouped into blocks; the index keeps, per term and block, the
largest impact (block maximum).  A passage's sum of block maxima bounds its score for every item
of the block, so only blocks whose bound reaches the threshold are
scored (block-max pruning in bulk: the bound is taken for a whole Arrow batch of passages at
once).  Everything at or above the threshold is retrieved; nothing is cut at a top k.

A retrieved item is then verified on the words: the share of its question's five-word shingles found in the
passage, and the share of its answer's words.

Passages overlap by half and are twice as long as the longest item, so any stretch of
text as long as an item lies whole in one of them.  The index is shipped to the tasks;
its size is bounded by ``PASS_ITEMS`` items a pass, and a larger benchmark takes several passes
over a text within the same task.  Term statistics always come from all items.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import named

K1, B = 1.2, 0.75
RETRIEVE = 0.6
OVERLAP = 0.8
SHINGLE = 5
BLOCK = 16
#: items per shipped index; with texts of a few hundred words this is some tens of MB
PASS_ITEMS = 4096
_ROWS = 200_000
_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def terms(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The last sentence is the answer; a text of one sentence is split after three quarters of its words."""
    parts = [w for w in (terms(s) for s in _SENTENCE.split(text)) if w]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    w = parts[0] if parts else []
    at = max(1, (3 * len(w)) // 4)
    return w[:at], w[at:]


def _shingles(w: list[str]) -> set[tuple[str, ...]]:
    return {tuple(w[i:i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)} if len(w) >= SHINGLE else set()


def overlap(part: list[str], passage: list[str]) -> float:
    """Share of the part's shingles in the passage; a part shorter than a shingle counts as found when its words stand there in sequence."""
    if not part:
        return 1.0
    if len(part) < SHINGLE:
        n = len(part)
        return float(any(passage[i:i + n] == part for i in range(len(passage) - n + 1)))
    mine = _shingles(part)
    return len(mine & _shingles(passage)) / len(mine)


def word_overlap(part: list[str], passage: list[str]) -> float:
    """Share of the part's words in the passage, repeats counted."""
    if not part:
        return 1.0
    return sum((Counter(part) & Counter(passage)).values()) / len(part)


class Index:
    """Block-max index of some items, with the statistics of all."""

    def __init__(self, items: list[tuple[str, list[str], list[str]]], idf: dict[str, float], mean_length: float, longest: int):
        items = sorted(items, key=lambda x: (len(x[1]) + len(x[2]), x[0]))
        self.items = items
        self.step = max(32, longest)
        bags = [Counter(q + a) for _, q, a in items]
        self.term = {t: i for i, t in enumerate(sorted({t for b in bags for t in b}))}
        n_blocks = -(-len(items) // BLOCK)
        self.block_max = np.zeros((len(self.term), n_blocks), dtype=np.float32)
        self.blocks: list[tuple[np.ndarray, np.ndarray]] = []
        for k in range(n_blocks):
            part = bags[k * BLOCK:(k + 1) * BLOCK]
            own = np.array(sorted({self.term[t] for b in part for t in b}), dtype=np.int64)
            impact = np.zeros((len(own) + 1, len(part)), dtype=np.float64)  # the last row stands for foreign terms
            for j, bag in enumerate(part):
                size = sum(bag.values())
                raw = {t: idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size / mean_length)) for t, tf in bag.items()}
                total = sum(raw.values())
                for t, x in raw.items():
                    impact[np.searchsorted(own, self.term[t]), j] = x / total
            self.blocks.append((own, impact))
            # rounded up, so that the bound stays a bound
            self.block_max[own, k] = np.nextafter(impact[:-1].max(axis=1).astype(np.float32), np.float32(2))

    def passages(self, n_words: int) -> int:
        """Passage k covers words [k * step, (k + 2) * step)."""
        return max(1, -(-n_words // self.step) - 1)

    def search(self, texts: list[list[str]], threshold: float) -> Iterator[tuple[int, int, int, float]]:
        """(text, passage, item, score) of everything at or above the threshold."""
        n_terms = len(self.term)
        held: list[np.ndarray] = []
        count, base, owners = 0, 0, []
        for t, w in enumerate(texts):
            if not w:
                continue
            ids = np.fromiter((self.term.get(x, -1) for x in w), dtype=np.int64, count=len(w))
            at = np.flatnonzero(ids >= 0)
            last = self.passages(len(w)) - 1
            own = np.minimum(at // self.step, last)
            before = np.maximum(at // self.step - 1, 0)
            both = np.concatenate((own, before)) + base
            held.append(np.unique(both * n_terms + np.concatenate((ids[at], ids[at]))))
            owners.append((base, t))
            base += last + 1
            count += len(held[-1])
            if count >= _ROWS:
                yield from self._score(np.concatenate(held), owners, threshold)
                held, owners, count, base = [], [], 0, 0
        if held:
            yield from self._score(np.concatenate(held), owners, threshold)

    def _score(self, keys: np.ndarray, owners: list[tuple[int, int]], threshold: float):
        if not len(keys):
            return
        passage, term = np.divmod(keys, len(self.term))
        starts = np.flatnonzero(np.concatenate(([True], np.diff(passage) > 0)))
        names = passage[starts]
        slack = 1e-4
        bound = np.zeros((len(starts), len(self.blocks)), dtype=np.float32)
        for lo in range(0, len(starts), 2048):  # bounds a slice of passages at a time
            hi = min(lo + 2048, len(starts))
            a, b = starts[lo], starts[hi] if hi < len(starts) else len(term)
            bound[lo:hi] = np.add.reduceat(self.block_max[term[a:b]], starts[lo:hi] - a, axis=0)
        bases = np.array([b for b, _ in owners])
        ends = np.append(starts[1:], len(term))
        for k in np.flatnonzero((bound >= threshold - slack).any(axis=0)):
            own, impact = self.blocks[k]
            for p in np.flatnonzero(bound[:, k] >= threshold - slack):
                t = term[starts[p]:ends[p]]
                i = np.searchsorted(own, t)
                i[i == len(own)] = 0
                i = np.where(own[i] == t, i, len(own))
                score = impact[i].sum(axis=0)
                for j in np.flatnonzero(score >= threshold):
                    o = int(np.searchsorted(bases, names[p], side="right")) - 1
                    yield owners[o][1], int(names[p] - bases[o]), int(k) * BLOCK + int(j), float(score[j])

    def verified(self, text: str | None, threshold: float, need: float) -> list[dict]:
        return self.verified_batch([text], threshold, need)[0]

    def verified_batch(self, texts, threshold: float, need: float) -> list[list[dict]]:
        """Per text, the items found in it: the best passage of each."""
        split = [terms(t) for t in texts]
        best: list[dict[int, dict]] = [{} for _ in split]
        for t, p, item, score in self.search(split, threshold):
            words = split[t][p * self.step:(p + 2) * self.step]
            name, q, a = self.items[item]
            oq, oa = overlap(q, words), word_overlap(a, words)
            if oq >= need and oa >= need:
                hit = {"item_id": name, "passage": p, "score": score, "question_overlap": oq, "answer_overlap": oa}
                old = best[t].get(item)
                if old is None or (oq + oa, score, -p) > (old["question_overlap"] + old["answer_overlap"], old["score"], -old["passage"]):
                    best[t][item] = hit
        return [sorted(b.values(), key=lambda h: h["item_id"]) for b in best]


_HITS = T.ArrayType(T.StructType([
    T.StructField("item_id", T.StringType()), T.StructField("passage", T.IntegerType()), T.StructField("score", T.DoubleType()),
    T.StructField("question_overlap", T.DoubleType()), T.StructField("answer_overlap", T.DoubleType())]))


def build_indexes(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> list[Index]:
    """Indexes of ``PASS_ITEMS`` items each over the whole benchmark.  Items without a word are left out (nothing
    can be found of them); rows of equal id and text are one item; a null id is the item ``null``."""
    rows = (items.select(F.coalesce(named(items, id_col).cast("string"), F.lit("null")).alias("i"), named(items, text_col).alias("t"))
            .where(F.col("t").isNotNull()).distinct().orderBy("i", "t"))
    parts: list[list] = []
    df: Counter = Counter()
    total, longest, n = 0, 0, 0
    for r in rows.toLocalIterator():  # a benchmark; its terms are the index that every task needs
        q, a = question_and_answer(r.t)
        if not q:
            continue
        if n % PASS_ITEMS == 0:
            parts.append([])
        parts[-1].append((r.i, q, a))
        df.update(set(q + a))
        n += 1
        total += len(q) + len(a)
        longest = max(longest, len(q) + len(a))
    idf = {t: math.log(1 + (n - c + 0.5) / (c + 0.5)) for t, c in df.items()}
    return [Index(p, idf, total / n, longest) for p in parts]


def hits(text: Column, indexes: list[Index], spark, threshold: float = RETRIEVE, need: float = OVERLAP) -> Column:
    """Array of the items found in a text; empty for null and empty texts."""
    def one(index: Index) -> Column:
        shipped = spark.sparkContext.broadcast(index)

        @F.pandas_udf(_HITS)
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                yield pd.Series(shipped.value.verified_batch(list(texts), threshold, need), dtype=object)
        return run(text)

    if not indexes:
        return F.array().cast(_HITS)
    return reduce(lambda a, b: F.concat(a, b), [one(i) for i in indexes])


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text", threshold: float = RETRIEVE, need: float = OVERLAP) -> DataFrame:
    """One row per (row of ``docs``, item found in it): id, item, passage, score, question_overlap, answer_overlap.

    Map-only over the corpus: copies, hot sources and repeated rows are judged row by
    row; null and empty texts hold nothing; an empty benchmark or corpus gives no rows; further columns
    are not read.  Very long texts are cut into passages, all of which are searched."""
    spark = docs.sparkSession
    found = docs.select(named(docs, id_col).alias("id"), F.explode(
        hits(named(docs, text_col), build_indexes(items, item_col, item_text_col), spark, threshold, need)).alias("h"))
    kind = named(items, item_col)
    return found.select(F.col("id").alias(id_col), F.col("h.item_id").cast(items.select(kind).schema[0].dataType).alias(item_col),
                        "h.passage", "h.score", "h.question_overlap", "h.answer_overlap")


def drop_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
               threshold: float = RETRIEVE, need: float = OVERLAP) -> DataFrame:
    """``docs`` without the rows in which an item is found; same columns."""
    found = hits(named(docs, text_col), build_indexes(items, item_col, item_text_col), docs.sparkSession, threshold, need)
    return docs.where(F.size(found) == 0)
