"""Line and substring dedup against brute force on odd and planted inputs."""

import hashlib
import random
import re

from helpers import SF, corpus, docs, prose

from parcelgrid.llm import line_dedup as L
from parcelgrid.llm import substring as B

MARGIN = " \t\x0b\x0c\r"


def brute_lines(rows):
    unique = sorted({r for r in rows}, key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0))
    seen, cut = set(), {}
    for key in unique:
        vis = [x.strip(MARGIN) for x in (key[1] or "").split("\n") if x.strip(MARGIN)]
        gone = set()
        for i in range(len(vis) - 2):
            w = tuple(vis[i:i + 3])
            if w in seen:
                gone |= {i, i + 1, i + 2}
            seen.add(w)
        cut[key] = gone
    out = []
    for key in rows:
        kept, n = [], 0
        for line in (key[1] or "").split("\n"):
            if line.strip(MARGIN):
                n += 1
                if n - 1 in cut[key]:
                    continue
            kept.append(line)
        out.append((str(key[0]), "\n".join(kept) if key[1] is not None else None, len(cut[key])))
    return sorted(out, key=str)


def line_rows():
    a, b, c, d = "alpha one", "beta two ", "\tgamma", "delta"
    return [(1, "\n".join([a, b, c, d])), (2, "\n".join(["x", a, "", b, c, "y"])), (3, "\n".join([a, b, c, a, b, c])), (4, a), (5, None),
            (6, ""), (7, "\n\n \n"), (8, "\n".join([b, c, d, "z"])), (8, "\n".join([b, c, d, "z"])), (9, "\n".join(["q"] * 6)),
            (None, "\n".join([b, c, d, "w"]))]


def test_lines_equal_brute_force(spark):
    rows = line_rows()
    df = docs(spark, [t for _, t in rows], [i for i, _ in rows]).withColumnRenamed("source", "__starts").withColumnRenamed("lang", "th")
    out = L.dedup_lines(df, removed_col="n_removed")
    assert out.columns == [*df.columns, "n_removed"]
    assert sorted(((str(r.doc_id), r.text, r.n_removed) for r in out.collect()), key=str) == brute_lines(rows)


def test_lines_of_the_corpus(spark):
    rows = corpus(spark)
    df = docs(spark, [t for _, t in rows], [i for i, _ in rows])
    got = sorted(((str(r.doc_id), r.text, r.n_removed) for r in L.dedup_lines(df, removed_col="n_removed").collect()), key=str)
    assert got == brute_lines(rows)
    assert L.dedup_lines(docs(spark, [])).count() == 0


def brute_windows(rows, width):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    count = {}
    for w in words:
        for i in range(len(w) - width + 1):
            count[tuple(w[i:i + width])] = count.get(tuple(w[i:i + width]), 0) + 1
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = {j for s in range(len(w) - width + 1) if count[tuple(w[s:s + width])] > 1 for j in range(s, s + width)}
        out.append((str(i), len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out)


def window_rows():
    shared = prose(9, 60).split()
    rows = [(i, " ".join([*prose(i + 100, 30).split(), *shared[i % 5: 60 - i % 7], *prose(i + 200, 25).split()])) for i in range(12)]
    rows += [(20, "a " * 200), (21, "b c " * 90), (22, prose(300, 34)), (23, prose(300, 34)), (24, prose(301, 35)), (25, prose(301, 35)),
             (26, None), (27, ""), (28, "  "), (29, prose(302, 70)), (29, prose(302, 70)), (None, prose(303, 50) + " " + " ".join(shared[:35])),
             (30, " ".join(shared[:34]))]
    return rows


def substring(spark, rows, width):
    df = docs(spark, [t for _, t in rows], [i for i, _ in rows]).withColumnRenamed("source", "th").withColumnRenamed("lang", "kept")
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in B.remove_repeats(df, width=width).collect())


def test_windows_equal_brute_force(spark):
    rows = window_rows()
    assert substring(spark, rows, 35) == brute_windows(rows, 35)
    assert substring(spark, [], 35) == []


def test_other_widths_and_the_corpus(spark):
    rows = corpus(spark, 120)
    for width in (1, 2, 6, 35):
        assert substring(spark, rows, width) == brute_windows(rows, width)


def test_registered_query_equals_brute_force(spark):
    import __spark_entry__ as E
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in E.queries()["op9_substring_dedup"](spark, SF).collect())
    assert got == sorted((i, n, k, hashlib.sha256(t.encode()).hexdigest()) for i, n, k, t in brute_windows(rows, 35))


def test_rolling_hash_is_a_function_of_the_words():
    import numpy as np
    rng = random.Random(1)
    h = np.array([rng.getrandbits(64) for _ in range(50)] * 2, dtype=np.uint64)
    win, low, _ = B.window_hashes(h, 35)
    assert len(win) == len(low) == 66 and (win[:16] == win[50:]).all() and (low[:16] == low[50:]).all()
    assert len(set(win[:50].tolist())) == 50
