"""Licence files, wrapped headers and header blocks; no Python on the main path."""

import random
import textwrap

import pytest
from helpers import SF, corpus, prose
from pyspark.sql import functions as F
from test_text_jobs import brute_own

from parcelgrid.llm import licences as Z

WHOLE = dict(Z.whole_texts())
GPL = next(t for n, t in Z.NOTICES if n == "GPL-3.0" and t.startswith("This program"))
MIT = next(t for n, t in Z.NOTICES if n == "MIT" and t.endswith("conditions"))
APACHE = next(t for n, t in Z.NOTICES if n == "Apache-2.0" and "compliance" in t)
CODE = "\n".join(f"def f{k}(x):\n    return x + {k}" for k in range(15))


def wrapped(text, mark="", width=60):
    return "\n".join(f"{mark}{x}" for x in textwrap.wrap(text, width))


def scan(spark, files, background=True):
    rows = [(f"d{i}", f"docs/{i}", t) for i, t in corpus(spark)] if background else []
    df = spark.createDataFrame([*files, *rows], "id string, path string, body string")
    return {(r.id, r.path): r for r in Z.scan(df, F.col("path").endswith("LICENSE"), "id", "path", "body").collect()}


def test_whole_licence_files_and_their_folders(spark):
    files = []
    for n, t in WHOLE.items():
        files += [(f"{n}", f"{n}/LICENSE", t.replace("<year> <copyright holders>", "2021 Jo Doe")), (f"{n}/code", f"{n}/src/a.py", CODE),
                  (f"{n}/wide", f"{n}.one", " ".join(t.split()))]
    got = scan(spark, files)
    for n in ("MIT", "Apache-2.0", "GPL-3.0", "BSD-3-Clause", "MPL-2.0", "GPL-2.0", "LGPL-2.1", "LGPL-3.0"):
        assert got[(n, f"{n}/LICENSE")].own_licence == got[(f"{n}/wide", f"{n}.one")].own_licence == n
        assert (got[(f"{n}/code", f"{n}/src/a.py")].licence, got[(f"{n}/code", f"{n}/src/a.py")].source_dir) == (n, n)


@pytest.mark.parametrize("mark", ["", "# ", "// ", " * ", "-- ", ";; "])
def test_wrapped_headers(spark, mark):
    gap = "\n\n" if not mark else "\n"
    heads = {"GPL-3.0": GPL, "MIT": MIT, "Apache-2.0": APACHE}
    files = [(n, f"{n}.x", f"{mark}Copyright 2020 Jo Doe\n{mark.rstrip()}\n{wrapped(t, mark)}{gap}{CODE}\n") for n, t in heads.items()]
    got = scan(spark, files)
    assert {n: (got[(n, f"{n}.x")].own_licence, got[(n, f"{n}.x")].own_line) for n in heads} == {n: (n, 2) for n in heads}


def plain_blocks(text):
    """The header blocks read line by line."""
    import re
    out, run, kind = [], [], None
    for i, x in [*enumerate(text.replace("\x01", " ").replace("\x02", " ").split("\n")), (None, "")]:
        now = bool(re.match(Z._MARK.replace("(?i:rem)", "[rR][eE][mM]"), x)) if re.search("[A-Za-z0-9]", x) else None
        if now != kind and run:
            if len(run) > 1:
                out.append((run[0][0], " ".join(" ".join(y for _, y in run).lower().split())))
            run = []
        kind = now
        if now is not None:
            run.append((i, re.sub(Z._MARK.replace("(?i:rem)", "[rR][eE][mM]"), "", x)))
    return out


def test_blocks_equal_a_plain_reading(spark):
    rng = random.Random(5)
    lines = ["", "  ", "# a b", "// c", "word word", " * star 7", "--", "rem this", "remark", "x \x01 y", "3", "#", "\ttab # not", "/* open", "*/", "\x02"]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 12)))) for i in range(400)]
    got = spark.createDataFrame(rows, "i int, t string").select("i", "t", Z.blocks(F.col("t")).alias("b")).collect()
    for r in got:
        assert [(b.line, " ".join(b.t.split())) for b in r.b] == plain_blocks(r.t), r.t


def test_lines_and_whole_texts_equal_brute_force(spark):
    rng, notices = random.Random(2), [t for _, t in Z.NOTICES]
    rows = [(i, prose(i, 30) + "\n\n" + rng.choice(["", "# "]) + rng.choice(notices) + rng.choice(["", " Copyright 2020"]) + "\n\n" + prose(i + 1, 20)) for i in range(40)]
    rows += [(100, None), (101, ""), (102, WHOLE["MIT"].replace("\n\n", "\n").replace("\n", " "))]
    df = spark.createDataFrame(rows, "id int, body string").withColumn("path", F.lit("p"))
    got = {r.id: (r.own_licence, r.own_line) for r in Z.scan(df, F.col("line") <= 0, "id", "path", "body").collect()}
    assert got == brute_own(rows)


def test_no_python_on_the_main_path(spark, monkeypatch):
    plans, keep = [], Z.written

    def noted(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df, name)
    monkeypatch.setattr(Z, "written", noted)
    import __spark_entry__ as E
    plans.append(E.queries()["op10_licences"](spark, SF)._jdf.queryExecution().executedPlan().toString())
    assert len(plans) == 5 and not any(w in p for p in plans for w in ("Python", "Arrow", "Pandas", "CartesianProduct"))
