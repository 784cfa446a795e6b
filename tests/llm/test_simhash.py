"""SimHash components against all pairs; the contract's fingerprint; odd inputs."""

import itertools
import random
import re

import pytest
import xxhash
from helpers import SF, corpus, docs, prose

from parcelgrid.llm import components as C
from parcelgrid.llm import simhash as S


def fingerprint(text, k=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    sh = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows, bits=4):
    fps = [fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, j in itertools.combinations(range(len(rows)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= bits:
            root[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc, f"{fps[i]:016x}", min(ids) if ids else None))
    return sorted(out, key=str)


def near_copies():
    """A cluster whose members lie at many distances from each other, around one text."""
    rng, base = random.Random(5), prose(1, 300).split()
    out = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randrange(1, 25)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(50)}"
        out.append((i, " ".join(w)))
    return out


def result(spark, rows):
    df = docs(spark, [t for _, t in rows], [i for i, _ in rows])
    got = S.near_duplicates(df)
    return sorted(((r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in got.collect()), key=str)


@pytest.mark.parametrize("case", ["corpus", "cluster"])
def test_components_equal_all_pairs(spark, case):
    rows = corpus(spark) if case == "corpus" else near_copies() + [(100 + i, prose(i + 50, 80)) for i in range(40)]
    assert result(spark, rows) == brute(rows)


def test_registered_query_equals_brute_force(spark):
    import __spark_entry__ as E
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in E.queries()["op2_simhash"](spark, SF).collect()), key=str)
    assert got == brute(rows)


@pytest.mark.parametrize("shared", range(1, 9))
def test_position_sets_cover_every_choice_of_shared_bytes(shared):
    sets = [set(s) for s in S.position_sets(shared)]
    assert all(any(s <= set(c) for s in sets) for c in itertools.combinations(range(8), shared))
    assert shared < 4 or len(sets) == 20


def test_too_wide_distance_is_refused():
    with pytest.raises(ValueError):
        S.position_sets(0)


def test_long_text_and_chunks(spark, monkeypatch):
    text = prose(3, 5000)
    monkeypatch.setattr(S, "_CHUNK", 100)
    assert S.text_fingerprint(text, 4) & (1 << 64) - 1 == fingerprint(text)


def test_keep_one_keeps_the_smallest_id_of_each_component(spark):
    rows = corpus(spark)
    df = docs(spark, [t for _, t in rows], [i for i, _ in rows]).withColumnRenamed("source", "fp").withColumnRenamed("lang", "__rank")
    kept = S.keep_one(df)
    assert kept.columns == df.columns
    want = {c for _, _, c in brute(rows)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)


def test_empty_table(spark):
    df = docs(spark, [])
    assert S.near_duplicates(df).count() == 0 and S.keep_one(df).count() == 0


def test_components_of_chains_hubs_and_loops(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(1, 80)] + [(7, 7)] + [
        (rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    got = {r.node: r.root for r in C.components(spark.createDataFrame(edges * 2, "a long, b long"), "a", "b").collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        if a != b:
            hi, lo = sorted((find(a), find(b)), reverse=True)
            root[hi] = lo
    assert got == {x: find(x) for x in list(root)}
