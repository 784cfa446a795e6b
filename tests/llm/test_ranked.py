"""Ranked search against a full scan in plain Python."""

import math
import random
import re
from collections import Counter

import pytest
from helpers import corpus

from parcelgrid.llm import ranked

SPLIT = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return SPLIT.findall((text or "").translate(UPPER))


def brute(docs, items, k):
    bags = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    bags = [b for b in bags if b[2]]
    n_docs, total = len(bags), sum(b[2] for b in bags)
    out = []
    for item, text in set(items):
        asked = set(terms(text))
        w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in b for _, b, _ in bags) + 1))) for t in asked}
        scored = []
        for i, bag, n in bags:
            m = 100 - 50 + (50 * n * n_docs) // total
            s = sum(w[t] * ((10**9 * bag[t]) // (1000 * bag[t] + 20 * m)) for t in asked if bag[t])
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def run(spark, docs, items, k, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    q = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in ranked.search(d, q, k, **kw).collect()), key=str)


def test_terms():
    for t in ["Ab-c1 ÄÖ_x\x7f日本 ÉA", "", "\x00 \t", "A" * 1000, "x\u0085y z"]:
        assert [b.decode() for b in ranked.terms_of(t)] == terms(t)
    assert ranked.terms_of(None) == []


def test_corpus_with_odd_rows(spark):
    docs = corpus(spark)
    items = [(i, t[i * 7:i * 7 + 200]) for i, t in docs[:12]] + [(90, None), (91, ""), (92, "  --"), (93, "nosuchterm"), (0, docs[0][1][:200]), (0, docs[3][1][:80]), (None, docs[4][1][:80])]
    assert run(spark, docs, items, 7) == brute(docs, items, 7)


@pytest.mark.parametrize("block", [2, 1024])
def test_ties_rounds_and_blocks(spark, block):
    """Many copies tie at the k-th place, and a few places for many terms make loose bounds, so several rounds are needed."""
    rng = random.Random(5)
    word = lambda: f"w{min(int(rng.expovariate(0.02)), 300)}"
    docs = [(1000 - i, " ".join(word() for _ in range(rng.randrange(1, 60)))) for i in range(150)]
    docs += [(2000 + i, "w1 w2 w3 w250") for i in range(60)] + [(None, "w1 w2 w3 w250"), (5, "w1 w2 w3 w250"), (5, "w1 w2 w3 w250"), (5, "w3 w9")]
    items = [(1, "w1 w2 w3"), (2, "w250 w4 w9"), (3, "w3"), (4, " ".join(f"W{i}" for i in range(0, 300, 7)))]
    assert run(spark, docs, items, 10, block=block) == brute(docs, items, 10)


def test_loose_sketches_stay_exact(spark, monkeypatch):
    """Sixteen places for all terms: bounds are poor, and the k best still equal the full scan."""
    rng = random.Random(9)
    docs = [(i, " ".join(f"t{rng.randrange(400)}" for _ in range(rng.randrange(1, 12)))) for i in range(120)]
    items = [(i, " ".join(f"t{rng.randrange(400)}" for _ in range(5))) for i in range(6)]
    real = ranked.place
    few = lambda term: real(term) % 16
    made = [(i, *ranked.sketch(ranked.terms_of(t))) for i, t in docs]
    assert all(len(at) == len(tf) and at == sorted(at) for _, at, tf in made)
    monkeypatch.setattr(ranked, "place", few)
    queries = ranked.Queries([i for i, _ in items], [t for _, t in items])
    n_docs, total = len(docs), sum(len(terms(t)) for _, t in docs)
    import numpy as np
    df = np.array([sum(t.decode() in set(terms(x)) for _, x in docs) for t in queries.terms])
    queries.weigh(df, n_docs, total)
    found = queries.lookup()
    for _, text in docs:
        at, tf = ranked.sketch(ranked.terms_of(text))
        n = len(terms(text))
        b = ranked.bounds(queries, found, np.array([n]), np.zeros(len(at), dtype=np.int64), np.array(at), np.array(tf))[0]
        bag = Counter(ranked.terms_of(text))
        exact = [queries.score(q, bag, queries.norm(n)) for q in range(len(items))]
        assert all(x >= y for x, y in zip(b, exact, strict=True))


def test_string_ids_and_other_columns(spark):
    d = spark.createDataFrame([("b", "x y", 1), ("a", "x y", 2), (None, "x y", 3), ("c", "z", 4), ("d", "q r s t", 5)], "`doc id` string, body string, score int")
    q = spark.createDataFrame([(7, "X z", "a")], "item_id int, text string, rank string")
    out = [tuple(r) for r in ranked.search(d, q, 3, doc_id="doc id", text="body").orderBy("rank").collect()]
    assert [(r[0], r[1], r[2]) for r in out] == [(7, 1, "c"), (7, 2, "a"), (7, 3, "b")]


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")], 5) == []
    assert run(spark, [(1, "a b")], [], 5) == []
    assert run(spark, [(1, None), (2, " ")], [(1, "a")], 5) == []


def test_very_long_text(spark):
    docs = [(1, "alpha " * 300_000), (2, "alpha beta"), (3, " ".join(f"v{i}" for i in range(60_000))), (4, "gamma"), (5, "delta")]
    items = [(1, "alpha v59999"), (2, "beta v1")]
    assert run(spark, docs, items, 50) == brute(docs, items, 50)
