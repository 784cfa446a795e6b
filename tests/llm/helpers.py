"""Small inputs shared by the corpus tests."""

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


def docs(spark, texts, ids=None, langs=None):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, (langs or ["en"] * len(texts))[k], "src0", None if t is None else len(t)) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def corpus(spark, n=200):
    """Texts of the smallest table, with a null, an empty and a blank one, a repeated row and a null id."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(n).collect()]
    return rows + [(10_001, None), (10_002, ""), (10_003, " \n\t "), rows[0], (None, rows[1][1]), (None, None)]
