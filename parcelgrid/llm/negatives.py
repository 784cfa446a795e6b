"""Hard negatives by cover trees.

Candidates are dealt by a hash of their id into shards of about ``SHARD`` rows, and every shard becomes a cover tree.
Vectors get one more component, sqrt(M^2 - |x|^2) with M the largest norm of the shard, so that all have the same length and
nearness orders candidates as the inner product does.  A node of a level stands for its centre and
covers all below it within the level's radius; radii shrink by ``BASE`` from level to level, centres of one parent
lie further apart than the radius, and the parent's centre is its own first child.  Each node keeps the radius it really needs.

With q the anchor, c a centre, D their distance and r the radius, every row y below the node has
``q.c - |q| r <= q.y <= min(q.c + |q| r, (|q|^2 + M^2 - max(0, D - r)^2) / 2)``.  The descent is best-first: a queue of nodes
ordered by the largest bound that an anchor of the block has there.  An anchor goes down into a node only if the node's interval meets one of its
windows at or above the k-th score found in that window so far; the others skip it.  Children are scored exactly
(inner products of whole numbers), so nothing is estimated.

Positives are the ``positives`` best rows of the anchor's label; the window of a positive with score p takes rows of other labels with
``low * p <= 100 * score <= high * p``.

Sizes: anchors go through in blocks of about ``ANCHORS``, all against every tree; only one block is on the driver and shipped at a time.
A task sends k rows per window at most.  A tree is one row, some MB.

Defined results: rows with a null id, label or vector, or with a null or non-finite component, take no part.  Rows that agree in id, label and
vector count once.  Rows that share the anchor's id are never its positives.  Shorter vectors count as padded with zeros.
A negative positive score gives an empty window.  Inner products are exact below 2^53.  With no rows or no anchors the result is empty.
Columns beside those named are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, named, shared_path, written

SHARD = 4096
ANCHORS = 1024
BASE = 1.5
LEAF = 24
_CHILDREN = 512
#: floating-point slack of distances and bounds, relative
_SLACK = 1e-9
_TREE = "shard long, n int, m double, ids binary, labels binary, vectors binary, start binary, end binary, center binary, radius binary, first binary, last binary"


@dataclass
class Tree:
    """Rows in the order of the tree.  Node v covers rows start..end, its centre is row center[v], its children are the nodes
    first..last (none for a leaf, whose rows are scored together)."""

    m: float
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    start: np.ndarray
    end: np.ndarray
    center: np.ndarray
    radius: np.ndarray
    first: np.ndarray
    last: np.ndarray

    def pack(self, shard: int) -> dict:
        return {"shard": shard, "n": len(self.ids), "m": self.m, **{k: getattr(self, k).tobytes() for k in _TYPES}}

    @classmethod
    def unpack(cls, row) -> Tree:
        parts = {k: np.frombuffer(row[k], dtype=t) for k, t in _TYPES.items()}
        parts["vectors"] = parts["vectors"].reshape(row["n"], -1)
        return cls(m=row["m"], **parts)


_TYPES = {"ids": np.int64, "labels": np.int64, "vectors": np.float64, "start": np.int32, "end": np.int32, "center": np.int32, "radius": np.float64,
          "first": np.int32, "last": np.int32}


def build(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, leaf: int = LEAF, base: float = BASE) -> Tree:
    """Cover tree of the rows; the first row is the root's centre."""
    squares = (vectors * vectors).sum(axis=1)
    m = float(np.sqrt(squares.max()))
    lifted = np.hstack((vectors, np.sqrt(np.maximum(0.0, m * m - squares))[:, None]))
    away = lambda c, block: np.sqrt(np.maximum(0.0, 2.0 * (m * m - block @ lifted[c])))  # noqa: E731  all lifted rows have length m
    same = max(0.5, 1e-6 * m)  # different whole-number rows are further apart, or so long that this is rounding
    order: list[np.ndarray] = []
    nodes: list[list] = []  # start, end, centre, radius, first child, last child
    placed = 0

    def add(rows, center, far) -> int:
        nodes.append([0, 0, center, float(far.max()), 0, 0, rows, far])
        return len(nodes) - 1

    add(np.arange(len(ids)), 0, away(0, lifted))
    at = 0
    while at < len(nodes):  # level by level: children of a node are next to each other
        _, _, center, far_most, _, _, rows, far = nodes[at]
        if len(rows) > leaf and far_most > same:
            cover = far_most / base
            nodes[at][4] = len(nodes)
            block, free, gap, c, near = lifted[rows], np.ones(len(rows), dtype=bool), far.copy(), center, far
            while True:  # the parent's centre first, then the farthest row that is not covered
                inside = free & (near <= cover)
                add(rows[inside], c, near[inside])
                free &= ~inside
                if not free.any():
                    break
                gap = np.where(free, np.minimum(gap, near), -1.0)
                at_row = int(np.argmax(gap))
                c = int(rows[at_row])
                near = away(c, block)
                near[at_row] = 0.0
            nodes[at][5] = len(nodes)
        at += 1
    # rows of a leaf together, leaves in the order of a walk down the tree
    stack = [0]
    while stack:
        v = stack.pop()
        node = nodes[v]
        node[0], node[1] = placed, placed + len(node[6])
        if node[4] == node[5]:
            order.append(node[6])
            placed += len(node[6])
        else:
            stack.extend(range(node[5] - 1, node[4] - 1, -1))
    walk = np.concatenate(order)
    row = np.empty(len(walk), dtype=np.int32)
    row[walk] = np.arange(len(walk), dtype=np.int32)
    column = lambda k, t: np.array([x[k] for x in nodes], dtype=t)
    radius = column(3, np.float64)
    return Tree(m, ids[walk], labels[walk], vectors[walk], column(0, np.int32), column(1, np.int32), row[column(2, np.int32)],
                radius + 1e-6 * (1.0 + m), column(4, np.int32), column(5, np.int32))


@dataclass
class Anchors:
    """A block of anchors; each has one window per row of ``low`` and ``high``.  ``same`` says whether rows of the own label are sought or the others."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    owner: np.ndarray  # of each window: number of its anchor
    low: np.ndarray
    high: np.ndarray
    k: int
    same: bool
    length: np.ndarray = field(init=False)

    def __post_init__(self):
        self.length = np.sqrt((self.vectors * self.vectors).sum(axis=1))


class Best:
    """The k best rows of each window so far, best first, and the score that a further row of the window must reach."""

    def __init__(self, anchors: Anchors):
        self.k, self.need = anchors.k, anchors.low.copy()
        self.score = np.full((len(anchors.low), anchors.k), -np.inf)
        self.id = np.full((len(anchors.low), anchors.k), np.iinfo(np.int64).max)

    def add(self, window: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        touched, place = np.unique(window, return_inverse=True)
        window = np.append(np.repeat(np.arange(len(touched)), self.k), place)
        score, ids = np.append(self.score[touched], score), np.append(self.id[touched], ids)
        order = np.lexsort((ids, -score, window))
        window = window[order]
        order = order[np.arange(len(window)) - np.searchsorted(window, window) < self.k]
        self.score[touched], self.id[touched] = score[order].reshape(-1, self.k), ids[order].reshape(-1, self.k)
        self.need[touched] = np.maximum(self.need[touched], self.score[touched, -1])


def descend(tree: Tree, anchors: Anchors, best: Best) -> int:
    """Best-first descent of a block of anchors; returns how many (anchor, row) products it took."""
    dim = max(tree.vectors.shape[1], anchors.vectors.shape[1])
    widen = lambda x: np.pad(x, ((0, 0), (0, dim - x.shape[1])))
    rows, asked = widen(tree.vectors), widen(anchors.vectors)
    taken, turn = 0, 0

    def verify(who: np.ndarray, found: np.ndarray, dots: np.ndarray) -> None:
        """Offer exact scores to the windows of the anchors."""
        fits = (anchors.labels[who][:, None] == tree.labels[found][None, :]) == anchors.same
        if anchors.same:
            fits &= anchors.ids[who][:, None] != tree.ids[found][None, :]
        place = np.full(len(anchors.ids), -1)
        place[who] = np.arange(len(who))
        mine = np.flatnonzero(place[anchors.owner] >= 0)
        at = place[anchors.owner[mine]]
        w, r = np.nonzero(fits[at] & (dots[at] >= best.need[mine][:, None]) & (dots[at] <= anchors.high[mine][:, None]))
        if len(w):
            best.add(mine[w], dots[at[w], r], tree.ids[found[r]])

    def interval(who: np.ndarray, dots: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of all inner products below nodes whose centres have the given ones."""
        size = anchors.length[who][:, None]
        slack = _SLACK * (1.0 + size * tree.m)
        both = size * size + tree.m * tree.m
        away = np.sqrt(np.maximum(0.0, both - 2.0 * dots))
        top = np.minimum(dots + size * radius, (both - np.maximum(0.0, away - radius) ** 2) / 2.0)
        return dots - size * radius - slack, top + slack

    def wanted(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Anchors with a window that the intervals meet."""
        meets = (hi[anchors.owner] >= best.need) & (lo[anchors.owner] <= anchors.high)
        out = np.zeros(len(anchors.ids), dtype=bool)
        out[anchors.owner[meets]] = True
        return out

    def push(v: int, who: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
        nonlocal turn
        if len(who):
            turn += 1
            heapq.heappush(queue, (-float(hi.max()), turn, v, who, lo, hi))

    queue: list = []
    everyone = np.arange(len(anchors.ids))
    dots = asked @ rows[tree.center[:1]].T
    lo, hi = interval(everyone, dots, tree.radius[:1])
    push(0, everyone, lo[:, 0], hi[:, 0])
    while queue:
        _, _, v, who, lo, hi = heapq.heappop(queue)
        full_lo, full_hi = np.full(len(anchors.ids), np.inf), np.full(len(anchors.ids), -np.inf)
        full_lo[who], full_hi[who] = lo, hi
        who = np.flatnonzero(wanted(full_lo, full_hi))
        if not len(who):
            continue
        if tree.first[v] == tree.last[v]:
            found = np.arange(tree.start[v], tree.end[v])
            verify(who, found, asked[who] @ rows[found].T)
            taken += len(who) * len(found)
            continue
        for part in range(tree.first[v], tree.last[v], _CHILDREN):
            children = np.arange(part, min(part + _CHILDREN, tree.last[v]))
            dots = asked[who] @ rows[tree.center[children]].T
            taken += dots.size
            many = tree.end[children] - tree.start[children] > 1
            verify(who, tree.center[children[~many]], dots[:, ~many])  # a child of one row is that row
            lo, hi = interval(who, dots[:, many], tree.radius[children[many]])
            for j, child in enumerate(children[many]):
                push(int(child), who, lo[:, j], hi[:, j])
    return taken


def _plant(leaf: int, base: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["id", "label"])
        size = max(1, int(group["v"].map(len).max()))
        vectors = np.zeros((len(group), size))
        for i, v in enumerate(group["v"]):
            vectors[i, :len(v)] = v
        return pd.DataFrame([build(group["id"].to_numpy(np.int64), group["label"].to_numpy(np.int64), vectors, leaf, base).pack(int(group["shard"].iloc[0]))])
    return run


def _ask(shipped):
    """Best rows of every window in the trees of a task."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        anchors = shipped.value
        best = Best(anchors)
        for batch in batches:
            for row in batch.to_dict("records"):
                descend(Tree.unpack(row), anchors, best)
        w, place = np.nonzero(best.score > -np.inf)
        yield pd.DataFrame({"w": w, "score": best.score[w, place].astype(np.int64), "id": best.id[w, place]})
    return run


def _answers(trees: DataFrame, anchors: Anchors) -> DataFrame:
    """(w, score, id, rank) of all windows: their k best rows over all trees, written."""
    shipped = trees.sparkSession.sparkContext.broadcast(anchors)
    found = trees.mapInPandas(_ask(shipped), "w long, score long, id long")
    order = Window.partitionBy("w").orderBy(F.col("score").desc(), F.col("id").asc())
    rows = written(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= anchors.k), "answers")
    shipped.unpersist()
    return rows


def scored_rows(df: DataFrame, id_col: str, label: Column, vector: str, scale: int) -> DataFrame:
    """(id, label, v): whole-number vectors of the rows that take part, each once."""
    v = named(df, vector)
    whole = F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    rows = df.where(named(df, id_col).isNotNull() & label.isNotNull() & v.isNotNull() & finite)
    return rows.select(named(df, id_col).cast("long").alias("id"), label.cast("long").alias("label"), whole.alias("v")).distinct()


def mine(df: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id", vector: str = "embedding", scale: int = 256, positives: int = 5,
         negatives: int = 10, low: int = 30, high: int = 90, shard: int = SHARD, block: int = ANCHORS, leaf: int = LEAF, base: float = BASE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); ``is_anchor`` is a condition on the column ``id``."""
    spark = df.sparkSession
    rows = written(scored_rows(df, id_col, label, vector, scale), "vectors")
    n = rows.count()
    n_shards = max(1, -(-n // shard))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id", "label"), F.lit(n_shards))).repartition(n_shards, "shard")
    trees = written(dealt.groupBy("shard").applyInPandas(_plant(leaf, base), _TREE), "trees")
    anchors = rows.where(is_anchor)
    n_blocks = -(-anchors.count() // block)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    path, made = shared_path(spark, "negatives"), False
    for b in range(n_blocks):
        own = sorted(anchors.where(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(n_blocks)) == b).collect())  # about ``block`` rows
        if not own:
            continue
        ids, labels = np.array([r.id for r in own], dtype=np.int64), np.array([r.label for r in own], dtype=np.int64)
        vectors = np.zeros((len(own), max(1, max(len(r.v) for r in own))))
        for i, r in enumerate(own):
            vectors[i, :len(r.v)] = r.v
        everything = np.full(len(own), np.inf)
        near = _answers(trees, Anchors(ids, labels, vectors, np.arange(len(own)), -everything, everything, positives, True))
        found = near.toPandas().sort_values(["w", "rank"])  # ``positives`` rows an anchor
        # whole numbers s with low * p <= 100 * s <= high * p
        least, most = -(-low * found["score"] // 100), high * found["score"] // 100
        found, least, most = found[least <= most], least[least <= most], most[least <= most]
        if len(found):
            windows = Anchors(ids, labels, vectors, found["w"].to_numpy(np.int64), least.to_numpy(np.float64), most.to_numpy(np.float64), negatives, False)
            far = _answers(trees, windows)
            named_windows = spark.createDataFrame(pd.DataFrame({
                "w": range(len(found)), "anchor_id": ids[found["w"].to_numpy(np.int64)], "positive_id": found["id"], "positive_score": found["score"]}),
                "w long, anchor_id long, positive_id long, positive_score long")
            out = far.join(F.broadcast(named_windows), "w").select(
                "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
            out.write.mode("append").parquet(path)
            made = True
            discard(spark, far)
        discard(spark, near)
    found = spark.read.schema(schema).parquet(path) if made else spark.createDataFrame([], schema)
    discard(spark, rows, trees)
    return found
