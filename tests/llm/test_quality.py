"""Quality counts against brute force; binomial bounds; cutoffs; odd inputs."""

import math
import random
import re

import pytest
from helpers import SF, corpus, docs, prose
from pyspark.sql import functions as F

from parcelgrid.llm import quality as Q


def brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    at = {}
    for i in range(len(w) - 2):
        at.setdefault(tuple(w[i:i + 3]), []).append(i)
    rep = len({j for s in at.values() if len(s) > 1 for i in s for j in range(i, i + 3)})
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 50 or 100 * rep > 50 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), rep, failed)


def base(df):
    return sorted(((str(r.doc_id), (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)) for r in df.collect()), key=str)


LABELS = "doc_id long, quality int, toxic int"


def test_counts_of_odd_texts(spark):
    texts = [None, "", " \n\t", "a b c a b c", "a " * 60, "x y #*$%&|<> \U0001f600 é", "one\ntwo\none\n \n\none \n", prose(1, 200),
             "a b c d " * 20 + prose(2, 30), "\x0bq\x0cw\re", "a b"]
    df = docs(spark, texts).withColumnRenamed("source", "__words").withColumnRenamed("n_chars", "kept")
    got = Q.judge(df, spark.createDataFrame([], LABELS))
    assert base(got) == sorted(((str(i), brute(t)) for i, t in enumerate(texts)), key=str)
    assert all(r.kept == (not r.base_failed) for r in got.collect())


def test_registered_query(spark):
    import __spark_entry__ as E
    got = E.queries()["op7_quality"](spark, SF)
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert base(got) == sorted(((str(r.doc_id), brute(r.text)) for r in rows), key=str)
    assert not [r for r in got.collect() if r.base_failed and r.kept]


def test_corpus_rows_with_nulls_and_repeats(spark):
    rows = corpus(spark)
    df = docs(spark, [t for _, t in rows], [i for i, _ in rows], [None if k % 9 == 0 else "en" for k in range(len(rows))])
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in rows if i is not None] + [(None, 1, None), (3, None, None)], LABELS)
    got = Q.judge(df, labels)
    assert base(got) == sorted(((str(i), brute(t)) for i, t in rows), key=str)
    kept = Q.keep_good(df, labels)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got.where("kept").collect())
    assert Q.judge(docs(spark, []), labels).count() == 0 and Q.keep_good(docs(spark, []), labels).count() == 0


@pytest.mark.parametrize("n,k,p", [(10, 0, 0.3), (500, 3, 0.02), (2000, 39, 0.02), (100_000, 150, 0.002), (30, 1, 0.1), (1, 0, 0.5)])
def test_binomial_tail(spark, n, k, p):
    got = spark.range(1).select(Q.log_binomial_tail(F.lit(n).cast("long"), F.lit(k).cast("long"), p).alias("x")).first().x
    top = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    want = max(top) + math.log(sum(math.exp(t - max(top)) for t in top))
    assert abs(got - want) < 1e-6 * max(1, abs(want))


def labelled_corpus(spark, n_good, n_bad):
    rng = random.Random(4)
    good = [prose(i, 80 + rng.randrange(60), 5000) for i in range(n_good)]
    bad = [" ".join(w + "&&&" for w in prose(10_000 + i, 90, 5000).split()) for i in range(n_bad)]
    texts = good + bad
    return docs(spark, texts), spark.createDataFrame([(i, int(i < n_good), 0) for i in range(len(texts))], LABELS)


def test_cutoffs_need_enough_labels_and_spare_good_texts(spark):
    few, few_labels = labelled_corpus(spark, 60, 20)
    assert Q.judge(few, few_labels).where("not kept and not base_failed").count() == 0
    many, labels = labelled_corpus(spark, 6000, 300)
    got = Q.judge(many, labels).where("not base_failed").collect()
    assert all(r.kept for r in got if r.doc_id < 6000)
    assert not any(r.kept for r in got if r.doc_id >= 6000)
    assert all("symbols" in r.broken for r in got if r.doc_id >= 6000)


def test_a_small_stratum_gets_cutoffs(spark):
    """300 good labels bound the joint false rejection; the rules are not charged one by one."""
    df, labels = labelled_corpus(spark, 300, 40)
    got = Q.judge(df, labels).where("not base_failed").collect()
    assert all(r.kept == (r.doc_id < 300) for r in got) and any(r.doc_id >= 300 for r in got)


def test_joint_cutoffs_by_hand(spark):
    rng = random.Random(9)
    cols = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long, n_marks long, good int, stratum string"
    rows = [(100, 500, int(100 * min(0.9, rng.expovariate(30))), 0, 0, 10, int(500 * min(0.9, rng.expovariate(40))), 0, 1, s) for s in ("a", None) for _ in range(1500)]
    rows += [(100, 500, rng.randrange(90), 0, 0, 10, rng.randrange(400), 0, 0, s) for s in ("a", None) for _ in range(60)]
    got = {(r.stratum, r.rule): r.cutoff for r in Q.joint_cutoffs(spark.createDataFrame(rows, cols)).collect()}
    cut = {r: [a + b * round((n - 1) * (1 - t / (Q.STEPS - 1))) for t in range(Q.STEPS)] for r, (a, b, n) in Q.GRID.items()}

    def broken(r, t):
        value = {"symbols": r[2] / 100, "shouting": r[6] / 500, "marks": 0.0, "dup_lines": 0.0, "repeats": 0.0, "long_words": 5.0, "short_words": -5.0}
        return any(value[x] > cut[x][t] for x in value)
    for s in ("a", None):
        good, bad = ([r for r in rows if r[9] == s and r[8] == g] for g in (1, 0))
        best = None
        for t in range(Q.STEPS):
            k = sum(broken(r, t) for r in good)
            tail = sum(math.comb(1500, i) * Q.RISK ** i * (1 - Q.RISK) ** (1500 - i) for i in range(k + 1))
            if k >= 1500 * Q.RISK or tail > Q.DELTA / 2:
                break
            caught = sum(broken(r, t) for r in bad)
            if caught and (best is None or caught > best[0]):
                best = (caught, t)
        assert best and all(got[(s, x)] == cut[x][best[1]] for x in Q.RULES)


def test_admissible_cutoffs_by_hand(spark):
    """The chosen cutoff is the most selective grid point whose exact bound holds."""
    rng = random.Random(8)
    n = 9000
    rows = [(100, 500, int(100 * min(0.9, rng.expovariate(30))), 0, 0, 10, 0, 0, 1, "en") for _ in range(n)]
    rows += [(100, 500, 80, 0, 0, 10, 0, 0, 0, "en")] * 50
    cols = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long, n_marks long, good int, stratum string"
    got = {r.rule: r.cutoff for r in Q.cutoffs(spark.createDataFrame(rows, cols)).collect()}
    start, step, points = Q.GRID["symbols"]
    p, m = Q.RISK / len(Q.RULES), sum(g[2] for g in Q.GRID.values())

    def ok(g):
        k = sum(r[8] and r[2] / 100 > start + step * g for r in rows)
        if k >= n * p:
            return False
        tail = sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)) for i in range(k + 1))
        return tail <= Q.DELTA / m
    want = min(start + step * g for g in range(points) if ok(g))
    assert abs(got["symbols"] - want) < 1e-12


def test_no_python_in_the_plan(spark):
    df, labels = labelled_corpus(spark, 30, 5)
    plan = Q.judge(df, labels)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
