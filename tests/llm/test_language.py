"""Language ID: held-out accuracy, predictions against plain dictionaries, defined results."""

import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import DOC_SCHEMA, SF
from pyspark.sql import functions as F

from parcelgrid.llm import language
from parcelgrid.llm.catalog import QUERIES

MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def predicted(spark):
    return {r.doc_id: r for r in QUERIES["op11_language"](spark, MID).collect()}


def test_held_out_accuracy(spark, predicted):
    docs = spark.read.parquet(f"{MID}/documents.parquet").select("doc_id", "lang").collect()
    assert len(predicted) == len(docs)
    assert all(predicted[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 4 == 2) for d in docs)
    held = [d for d in docs if predicted[d.doc_id].held_out]
    assert len(held) > 200
    right = sum(predicted[d.doc_id].lang_pred == d.lang for d in held) / len(held)
    assert right >= 0.98
    assert all(0 <= r.score <= 1 for r in predicted.values())
    assert sum(r.rejected for r in predicted.values()) < 0.03 * len(docs)


def plain_letters(text):
    """Letters of the lower-cased text with one blank for every run of others, and at the ends."""
    out = [" "]
    for c in text.lower():
        letter = unicodedata.category(c).startswith("L")
        if letter or out[-1] != " ":
            out.append(c if letter else " ")
    return "".join(out) + ("" if out[-1] == " " else " ")


@pytest.mark.parametrize("text", ["Ça va? Très  bien!", "a", "Straße\n\n42 İstanbul", "  x1y  ", "日本語 текст", "ǅ ﬁ"])
def test_letters(text):
    assert "".join(map(chr, language.letters_of(text))) == plain_letters(text)


def test_pieces_do_not_change_counts(monkeypatch):
    codes = language.letters_of("der die das und nicht " * 50)
    want = [x.tolist() for x in language.gram_counts(codes)]
    for piece in (1, 2, 3, 7, 64):
        monkeypatch.setattr(language, "PIECE", piece)
        assert [x.tolist() for x in language.gram_counts(codes)] == want


def test_counts_cover_all_grams():
    text = plain_letters("Ob die Ähre reift")
    n = sum(len(text) - k for k in range(3)) - text.count(" ")  # single blanks are left out
    assert language.gram_counts(language.letters_of("Ob die Ähre reift"))[1].sum() == n


def small(spark, rows):
    return spark.createDataFrame([(i, t, g, "src", None) for i, t, g in rows], DOC_SCHEMA)


WORDS = {"aa": "alpha arbor astra axis atlas", "bb": "brick broom bulb blend bronze", "cc": "zig zag zoom zest zinc"}


def test_equal_to_dictionaries(spark):
    """Frequencies, weights and cosines from plain Python; one cluster, so the centroid is the mean of the unit vectors."""
    rows = [(i, " ".join(np.random.default_rng(i).permutation(WORDS[g].split())[:3]), g) for g in WORDS for i in range(ord(g[0]) * 100, ord(g[0]) * 100 + 12)]
    unseen = [(1, "atlas axis", None), (2, "bulb brick zoom", None), (3, "zest", None)]
    out = {r.doc_id: r for r in language.identify(small(spark, rows + unseen), F.col("lang").isNotNull(), clusters=1).collect()}

    grams = lambda t: Counter(dict(zip(*(x.tolist() for x in language.gram_counts(language.letters_of(t))), strict=True)))
    df = Counter(g for _, t, _ in rows for g in grams(t))

    def vector(t):
        v = {g: n * (np.log((1 + len(rows)) / (1 + df[g])) + 1) for g, n in grams(t).items() if df[g]}
        full = np.sqrt(sum(x * x for x in v.values())) or 1.0
        return {g: x / full for g, x in v.items()}

    centroids = {}
    for lang in WORDS:
        total = Counter()
        for t in {t for _, t, g in rows if g == lang}:
            for g, x in vector(t).items():
                total[g] += x
        size = np.sqrt(sum(x * x for x in total.values()))
        centroids[lang] = {g: x / size for g, x in total.items()}
    for i, t, _ in unseen:
        v = vector(t)
        cosines = {lang: sum(x * c.get(g, 0.0) for g, x in v.items()) for lang, c in centroids.items()}
        best = max(sorted(cosines), key=cosines.get)
        assert (out[i].lang_pred, out[i].learned) == (best, False)
        assert out[i].score == pytest.approx(cosines[best], abs=1e-5)


def test_defined_results(spark):
    rows = [(i, WORDS[g] + f" {w}", g) for g in WORDS for i, w in enumerate(WORDS[g].split(), ord(g[0]) * 10)]
    odd = [(None, "atlas", "aa"), (2, None, "aa"), (3, "", "bb"), (4, "12 !? \n", "cc"), (5, "brick", None), (6, "brick", None), (6, "brick", None), (7, "zoom zest " * 30_000, None)]
    df = small(spark, rows + odd).withColumn("score", F.lit("clash")).withColumn("LANG_PRED", F.lit(1))
    out = language.identify(df, F.col("doc_id") > 50).collect()
    assert len(out) == len(rows) + len(odd)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    for i in (2, 3, 4):
        assert [(r.lang_pred, r.score, r.rejected) for r in by[i]] == [("und", 0.0, True)]
    assert [r.lang_pred for r in by[6]] == ["bb", "bb"] and by[6][0] == by[6][1]
    assert by[7][0].lang_pred == "cc" and by[None][0].lang_pred == "aa" and by[None][0].learned is False


def test_nothing_to_learn_from(spark):
    out = language.identify(small(spark, [(1, "some text", None), (2, "", "en")]), F.lit(True)).collect()
    assert {(r.lang_pred, r.score) for r in out} == {("und", 0.0)}
    assert language.identify(small(spark, []), F.lit(True)).collect() == []


def test_far_texts_are_rejected(spark):
    rows = [(i, " ".join(np.random.default_rng(i).permutation(WORDS[g].split())), g) for g in WORDS for i in range(ord(g[0]) * 100, ord(g[0]) * 100 + 20)]
    out = {r.doc_id: r for r in language.identify(small(spark, rows + [(1, "qwxk vjq qqx", None), (2, "alpha arbor astra", None)]), F.col("lang").isNotNull(), reject=0.0).collect()}
    assert out[1].rejected and not any(out[i].rejected for i, _, _ in rows)


def test_smallest_table(spark):
    out = QUERIES["op11_language"](spark, SF)
    assert out.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert dict(out.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double", "rejected": "boolean"}
