"""Encoding and decoding against the tokenizers library, on corpus texts and odd strings."""

import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
from helpers import SF, corpus, docs
from tokenizers import Tokenizer

from parcelgrid.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def odd_strings():
    rng, odd = random.Random(1), "éèß中文字ñΣσςİ́²½ⅷ१\U0001f600 　\x1c\x85'sré!?<|>#0123 \t\n\r"
    out = ["", " ", "a<|endoftext|>b", "<|startoftext|>", "it's WE'LL don't", "....", "hahahahaha", "A" * 3000, "=" * 500]
    for _ in range(3000):
        out.append("".join(rng.choice("abcdeinotsrh") for _ in range(rng.randint(1, 25))))
        out.append("".join(rng.choice("abcdefghij" + odd) for _ in range(rng.randint(0, 40))))
    return out


def test_ids_and_text_equal_the_library(library):
    v = bpe.vocabulary(PATH)
    enc, dec = bpe.Encoder(v), bpe.Decoder(v)
    for s in odd_strings():
        want = library.encode(s, add_special_tokens=False).ids
        assert enc.encode(s) == want, s
        assert dec.decode(np.array(want)) == library.decode(want, skip_special_tokens=False)


def test_every_token_encodes_to_itself():
    v = bpe.vocabulary(PATH)
    assert all(v._stable_cached(i) for i in v.ids.values())


def test_cache_bound_does_not_change_results(monkeypatch):
    monkeypatch.setattr(bpe.Encoder, "BOUND", 3)
    v = bpe.vocabulary(PATH)
    small, text = bpe.Encoder(v), "one two three four five six one two"
    assert small.encode(text) == [i for w in text.split() for i in bpe.Encoder(v).encode(w)]


def test_registered_query_equals_the_library(spark, library):
    import __spark_entry__ as E
    want = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want[r.doc_id] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                          hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in E.queries()["op6_bpe"](spark, SF).collect()}
    assert got == want


def test_nulls_empty_texts_repeats_and_empty_table(spark, library):
    rows = corpus(spark, 5)
    df = docs(spark, [t for _, t in rows], [i for i, _ in rows]).withColumnRenamed("source", "ids").withColumnRenamed("lang", "decoded")
    got = sorted((str(r.doc_id), list(r.ids), r.decoded) for r in bpe.encode_documents(df, PATH).collect())
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((str(i), ids, library.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want)
    assert bpe.encode_documents(docs(spark, []), PATH).count() == 0


@pytest.mark.parametrize("run", ["a", "ha", "abcdefgh", "=", "é", "internationalization"])
def test_unbroken_runs_equal_the_library(library, run):
    text = (run * 20_000)[:20_001]
    assert bpe.Encoder(bpe.vocabulary(PATH)).encode(text) == library.encode(text, add_special_tokens=False).ids


def test_an_unbroken_run_of_a_million_letters_takes_linear_time():
    rng, v = random.Random(3), bpe.vocabulary(PATH)
    text = "".join(rng.choice("abcdeinotsrh") for _ in range(1_000_000))

    def seconds(n):
        start = time.process_time()
        v.encode_letters(text[:n])
        return time.process_time() - start
    seconds(10_000)
    assert seconds(1_000_000) < 40 * max(seconds(100_000), 0.05)
