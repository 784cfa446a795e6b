"""C3 lossless pruning, C6/C7 tie rules, C9 resolution."""

import difflib
import random

import pytest
from pyspark.sql import functions as F

from parcelgrid.operators.linkage import best_match, first_match, similarity_join


def _lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def ratio(a, b, method):
    if method == "difflib":
        return difflib.SequenceMatcher(None, a, b).ratio()
    m = max(len(a), len(b))
    return 1.0 if m == 0 else 1.0 - _lev(a, b) / m


def _mutate(rnd, s, alphabet):
    s = list(s)
    for _ in range(rnd.randint(0, 3)):
        op = rnd.random()
        pos = rnd.randint(0, len(s))
        if op < 0.4 and s:
            del s[min(pos, len(s) - 1)]
        elif op < 0.8:
            s.insert(pos, rnd.choice(alphabet))
        elif s:
            s[min(pos, len(s) - 1)] = rnd.choice(alphabet)
    return "".join(s)


def _data(seed, n=120, alphabet="ABCDE 123"):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(3, 24))) for _ in range(40)]
    left = [(f"L{i}", f"B{rnd.randint(0, 2)}", _mutate(rnd, rnd.choice(base), alphabet)) for i in range(n)]
    right = [(f"R{i}", f"B{rnd.randint(0, 2)}", _mutate(rnd, rnd.choice(base), alphabet)) for i in range(n)]
    return left, right


@pytest.mark.parametrize("method,threshold", [("levenshtein", 0.85), ("levenshtein", 0.6),
                                              ("difflib", 0.85), ("difflib", 0.7)])
def test_similarity_join_is_lossless(spark, method, threshold):
    left, right = _data(hash((method, threshold)) % 1000)
    want = {(a, b) for a, ba, ta in left for b, bb, tb in right
            if ba == bb and ta and tb and ratio(ta, tb, method) >= threshold}
    l_df = spark.createDataFrame(left, "lid string, blk string, lt string")
    r_df = spark.createDataFrame(right, "rid string, blk string, rt string")
    got = {(r.lid, r.rid) for r in similarity_join(l_df, r_df, ["blk"], "lid", "rid", "lt", "rt",
                                                    threshold, method).collect()}
    assert got == want


def test_best_match_first_candidate_wins_ties(spark):
    t = spark.createDataFrame([("t1", "P", "12 HIGH ST")], "uprn string, postcode string, addr string")
    c = spark.createDataFrame([("c2", "P", "12 HIGH ST"), ("c1", "P", "12 HIGH ST"), ("c3", "P", "99 LOW RD")],
                              "cid string, postcode string, caddr string")
    r = best_match(t, c, ["postcode"], "uprn", "cid", "addr", "caddr", "cid", 0.85).collect()
    assert [(x.uprn, x.cid, x.ratio) for x in r] == [("t1", "c1", 1.0)]


def test_best_match_empty_addresses(spark):
    t = spark.createDataFrame([("t1", "P", None), ("t2", "Q", "")], "uprn string, postcode string, addr string")
    c = spark.createDataFrame([("c9", "P", ""), ("c5", "P", "  "), ("c1", "Q", "X")],
                              "cid string, postcode string, caddr string")
    r = sorted((x.uprn, x.cid) for x in best_match(t, c, ["postcode"], "uprn", "cid", "addr", "caddr", "cid").collect())
    assert r == [("t1", "c5")]  # '' vs '' scores 1.0; the first empty candidate by seq wins


def test_first_match_is_strict_and_ordered(spark):
    t = spark.createDataFrame([("s1", "P", "ABCDEFGHIJ")], "tid string, postcode string, a string")
    # ratio 0.8 exactly (2 edits of 10) must not match; 0.9 must
    c = spark.createDataFrame([("c1", "P", "ABCDEFGHXY", 10.0), ("c2", "P", "ABCDEFGHIX", 20.0),
                               ("c3", "P", "ABCDEFGHIJ", 30.0)], "cid string, postcode string, b string, area double")
    r = first_match(t, c, ["postcode"], "tid", "cid", "a", "b", "cid", carry=["area"], threshold=0.8).collect()
    assert [(x.tid, x.cid, x.area) for x in r] == [("s1", "c2", 20.0)]


def test_no_pairs_across_blocks(spark):
    l_df = spark.createDataFrame([("a", "X", "SAME TEXT")], "lid string, blk string, lt string")
    r_df = spark.createDataFrame([("b", "Y", "SAME TEXT")], "rid string, blk string, rt string")
    assert similarity_join(l_df, r_df, ["blk"], "lid", "rid", "lt", "rt", 0.5).count() == 0


def test_names_with_other_beginnings_are_resolved(spark):
    from parcelgrid.operators.linkage import resolve_company
    from parcelgrid.plans.corporate import company_search
    registry = spark.createDataFrame([("1", "ACME HOLDINGS LIMITED", "active"), ("2", "ZENITH PROPERTY LIMITED", None)],
                                     "company_number string, company_name string, company_status string")
    owners = spark.createDataFrame([("THE ACME HOLDINGS LIMITED",), ("SCME HOLDINGS LIMITED",), ("OTHER",)], "owner_name string")
    got = {r.owner_name: r.company_number for r in resolve_company(owners, registry, method="difflib").collect()}
    assert got == {"THE ACME HOLDINGS LIMITED": "1", "SCME HOLDINGS LIMITED": "1"}
    index = registry.withColumnRenamed("company_name", "title")
    assert [r.company_number for r in company_search(index, "SCME HOLDINGS LIMITED").collect()] == ["1"]


@pytest.mark.parametrize("method", ["levenshtein", "difflib"])
def test_candidates_stay_near_the_true_pairs(spark, method):
    """Candidates per true pair, from a table to one four times as large, and against all pairs of a block."""
    from parcelgrid.operators.linkage import candidate_pairs
    per_pair = []
    for n in (150, 600):
        rnd = random.Random(n)
        words = ["GREEN", "ALMOND", "STATION", "CHURCH", "MILL", "NORTH", "ABBEY", "KINGS", "QUARRY", "HARBOUR"]
        address = lambda: f"{rnd.randint(1, 200)} {rnd.choice(words)} {rnd.choice(words)} ROAD"  # noqa: E731, B023
        left = spark.createDataFrame([(f"L{i}", "B", address()) for i in range(n)], "lid string, blk string, lt string")
        right = spark.createDataFrame([(f"R{i}", "B", address()) for i in range(n)], "rid string, blk string, rt string")
        found = candidate_pairs(left, right, ["blk"], "lid", "rid", "lt", "rt", 0.85, method).count()
        true = similarity_join(left, right, ["blk"], "lid", "rid", "lt", "rt", 0.85, method).select("lid", "rid").distinct().count()
        assert found < 0.2 * n * n
        per_pair.append(found / true)
    assert per_pair[1] < 1.3 * per_pair[0]


def test_common_endings_are_not_indexed(spark):
    """Of names that all end alike, the segments of the ending are the most frequent ones and stay out of the index."""
    from parcelgrid.operators.linkage import _indexed, _texts
    rnd = random.Random(1)
    names = [("".join(rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(20)) + " LIMITED",) for _ in range(500)]
    df = spark.createDataFrame([(str(i), "", n) for i, (n,) in enumerate(names)], "id string, b string, n string")
    index = _indexed(_texts(df, "id", "n", ["b"]), ["b"], 0.9, "levenshtein")
    assert index.groupBy("_e", "_key").count().agg({"count": "max"}).first()[0] < 25


def test_one_address_many_times(spark):
    """A third of both sides has one address: it is compared once, and everyone gets a match."""
    rows = lambda p, n: [(f"{p}{i}", "B", "1 MILL ROAD" if i % 3 == 0 else f"{i} STATION APPROACH {i * 7919}") for i in range(n)]
    t = spark.createDataFrame(rows("t", 900), "tid string, blk string, a string")
    c = spark.createDataFrame(rows("c", 900), "cid string, blk string, b string")
    got = {r.tid: (r.cid, r.ratio) for r in best_match(t, c, ["blk"], "tid", "cid", "a", "b", "cid", 0.9, "levenshtein").collect()}
    assert len(got) == 900 and all(got[f"t{i}"] == ("c0", 1.0) for i in range(0, 900, 3))


def test_short_and_odd_texts(spark):
    texts = ["", "A", "B", "AB", "BA", "ABC", "É", "日本", "日本語", "A B", "𝔸𝔹ℂ", "𝔸𝔹", None]
    left = spark.createDataFrame([(f"L{i}", "X", t) for i, t in enumerate(texts)], "lid string, blk string, lt string")
    right = spark.createDataFrame([(f"R{i}", "X", t) for i, t in enumerate(texts)], "rid string, blk string, rt string")
    for method, threshold in (("levenshtein", 0.3), ("levenshtein", 0.5), ("difflib", 0.4), ("difflib", 0.66)):
        want = {(f"L{i}", f"R{j}") for i, a in enumerate(texts) for j, b in enumerate(texts) if a and b and ratio(a, b, method) >= threshold}
        got = {(r.lid, r.rid) for r in similarity_join(left, right, ["blk"], "lid", "rid", "lt", "rt", threshold, method).collect()}
        assert got == want


def test_growing_sides_are_not_gathered_for_a_broadcast(spark, tmp):
    """Frames that look small by their files are many rows after the explode: no join of the linkage broadcasts one."""
    from parcelgrid.operators.linkage import link_titles
    props = spark.createDataFrame([("1", None, "1 HIGH STREET", "P"), ("2", "T2", "1 HIGH STREE", "P"), ("3", "T3", "9 LOW ROAD", "P")],
                                  "uprn string, title_number string, address_line_1 string, postcode string")
    epc = spark.createDataFrame([("1", "F"), ("2", "A"), ("3", "A")], "uprn string, asset_rating_band string")
    props.write.parquet(f"{tmp}/props")
    epc.write.parquet(f"{tmp}/epc")
    props, epc = spark.read.parquet(f"{tmp}/props"), spark.read.parquet(f"{tmp}/epc")
    for method in ("difflib", "levenshtein"):
        out = link_titles(props, epc, method=method)
        assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
        assert {r.uprn: r.title_number for r in out.collect()} == {"1": "T2", "2": "T2", "3": "T3"}


@pytest.mark.parametrize("method", ["levenshtein", "difflib"])
def test_short_numbered_names_give_few_candidates(spark, method):
    """Names that differ in a few digits behind a common beginning: no segment tells them apart, the rest of the text does."""
    from parcelgrid.operators.linkage import candidate_pairs
    n = 1500
    rnd = random.Random(7)
    numbers = rnd.sample(range(100_000), n)
    left = [(f"L{k}", "B", f"SUPPLIER {k:09d}") for k in numbers]
    right = [(f"R{k}", "B", f"SUPPLIER#{k:09d}") for k in numbers]
    l_df, r_df = spark.createDataFrame(left, "lid string, blk string, lt string"), spark.createDataFrame(right, "rid string, blk string, rt string")
    assert candidate_pairs(l_df, r_df, ["blk"], "lid", "rid", "lt", "rt", 0.85, method).count() < 0.03 * n * n
    few = {k for k in numbers[:150]}
    got = similarity_join(l_df.where(l_df.lid.isin([f"L{k}" for k in few])), r_df, ["blk"], "lid", "rid", "lt", "rt", 0.85, method)
    want = {(a, b) for a, _, x in left if int(a[1:]) in few for b, _, y in right if _ratio(x, y, method) >= 0.85}
    assert {(r.lid, r.rid) for r in got.collect()} == want


@pytest.mark.parametrize("method,threshold", [("levenshtein", 0.85), ("difflib", 0.85), ("levenshtein", 0.5), ("difflib", 0.7)])
def test_short_texts_of_all_lengths_lose_no_pair(spark, method, threshold):
    rnd = random.Random(11)
    text = lambda: "".join(rnd.choice("AB0 ") for _ in range(rnd.randint(1, 22)))
    seeds = [text() for _ in range(25)]

    def near(t):
        for _ in range(rnd.randint(0, 4)):
            p = rnd.randrange(len(t) + 1)
            t = t[:p] + rnd.choice(["", "A", "0", "AB"]) + t[p + rnd.randint(0, 1):]
        return t or "A"

    left = [(f"L{i}", "B", near(rnd.choice(seeds))) for i in range(120)]
    right = [(f"R{i}", "B", near(rnd.choice(seeds))) for i in range(120)]
    got = similarity_join(spark.createDataFrame(left, "lid string, blk string, lt string"), spark.createDataFrame(right, "rid string, blk string, rt string"),
                          ["blk"], "lid", "rid", "lt", "rt", threshold, method)
    want = sorted((a, b) for a, _, x in left for b, _, y in right if _ratio(x, y, method) >= threshold)
    assert sorted((r.lid, r.rid) for r in got.collect()) == want and want


def _ratio(x, y, method):
    return difflib.SequenceMatcher(None, x, y).ratio() if method == "difflib" else 1.0 - _lev(x, y) / max(len(x), len(y))
