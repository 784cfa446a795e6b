"""Licence scan: sparse TF-IDF cosine of headers and licence files, then inheritance by directory.

Templates are notices, header paragraphs and the whole texts of licences.  Compared with them are every line of a file,
every header block (a run of adjacent lines, comment marks off, that ends at a blank line or where comment and code
meet) and the whole text.  Terms are lower-case letter and digit runs; a term's weight
is tf * (ln((1 + N) / (1 + df)) + 1) with df counted over all texts.  Terms that no
template uses weigh as unseen terms (df = 0): they only lengthen the vector.  A file's own
licence is the template with the largest cosine of at least ``threshold`` (ties: lines and blocks before the
whole text, the earliest first line, then name).

The files that speak for a directory are given by the caller; a file without a licence of its own takes the one of
the nearest directory above it that has one.  Directories, not files, are expanded into their
ancestors, so the join is over distinct directories.

Only lines and blocks with a heavy template term are compared, and whole texts with such a line: without any of a template's heaviest terms
none can reach the threshold (the remaining weights are too short for it), so nothing is lost.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import named, written

THRESHOLD = 0.8
#: fixed values: notices and header paragraphs by licence
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
                   "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                     "the following conditions are met"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                "License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights "
            "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
            "whom the Software is furnished to do so, subject to the following conditions"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
)


def whole_texts(folder: Path = Path(__file__).with_name("licence_texts")) -> tuple[tuple[str, str], ...]:
    """(licence, text) of the licence files of a folder, named ``licence.txt``."""
    return tuple((p.stem, p.read_text(encoding="utf-8")) for p in sorted(folder.glob("*.txt")))


TEMPLATES = NOTICES + whole_texts()
_TERM = re.compile(r"[a-z0-9]+")
#: fixed values: marks of a comment at the start of a line
_MARK = r"^[ \t]*(?:/?\*+/?|//+|#+|;+|--+|%+|<!--|\x22{3}|'{3}|dnl\b|(?i:rem)\b)"


def _terms(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), "[^a-z0-9]+"), "")


def _bags(templates) -> list[tuple[str, Counter]]:
    return [(name, Counter(_TERM.findall(text.lower()))) for name, text in templates]


def document_frequencies(files: DataFrame, templates=TEMPLATES) -> tuple[int, dict[str, int]]:
    """(number of texts, {template term: texts that hold it}); one row per template term comes to the driver."""
    vocabulary = sorted({t for _, bag in _bags(templates) for t in bag})
    held = files.select(F.explode(F.array_intersect(_terms(F.coalesce("text", F.lit(""))), F.array(*map(F.lit, vocabulary)))).alias("term"))
    df = {r.term: r.n for r in held.groupBy("term").agg(F.count("*").alias("n")).collect()}
    return files.count(), {t: df.get(t, 0) for t in vocabulary}


def blocks(text: Column) -> Column:
    """Array of (line, t): the header blocks of more than one line, with the number of their first line.

    Each line is written as number, flag, text without comment mark, flag; a blank one as nothing.  Blocks are then what
    lies between empty lines and changes of the flag, found by one split."""
    def line(x: Column, i: Column) -> Column:
        flag = F.when(x.rlike(_MARK), "\x02").otherwise("\x01")
        return F.when(x.rlike("[A-Za-z0-9]"), F.concat(i.cast("string"), flag, F.regexp_replace(x, _MARK, ""), flag)).otherwise("")
    marked = F.array_join(F.transform(F.split(F.translate(text, "\x01\x02", "  "), "\n"), line), "\n")
    runs = F.split(marked, "\\n\\n+|(?<=\\x01)\\n(?=[0-9]+\\x02)|(?<=\\x02)\\n(?=[0-9]+\\x01)")
    more = F.filter(runs, lambda r: r.rlike("[\\x01\\x02]\\n[0-9]"))
    return F.transform(more, lambda r: F.struct(
        F.regexp_extract(r, r"([0-9]+)[\x01\x02]", 1).cast("int").alias("line"),
        F.lower(F.translate(F.regexp_replace(r, r"(?:^|\n)[0-9]+[\x01\x02]", " "), "\x01\x02", "  ")).alias("t")))


def own_licences(files: DataFrame, threshold: float = THRESHOLD, templates=TEMPLATES) -> DataFrame:
    """(id, path, th, line, licence, cosine): the best template of every file that has one at the
    threshold; ``line`` is the first line of the line or block, -1 for the whole text."""
    spark = files.sparkSession
    n, df = document_frequencies(files, templates)
    idf = {t: math.log((1 + n) / (1 + c)) + 1 for t, c in df.items()}
    unseen = math.log(1 + n) + 1
    rows, heavy = [], set()
    for k, (name, bag) in enumerate(_bags(templates)):
        w = {t: tf * idf[t] for t, tf in bag.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        rows += [(k, name, t, x / norm) for t, x in w.items()]
        rest = 1.0
        # most weight for the fewest texts first, until what is left is too short to reach the threshold alone
        for t in sorted(w, key=lambda t: (-w[t] * w[t] / (1 + df[t]), t)):
            if rest < (threshold - 1e-9) ** 2:
                break
            heavy.add(t)
            rest -= (w[t] / norm) ** 2
    weights = F.broadcast(spark.createDataFrame(rows, "template int, licence string, term string, w double"))
    pattern = "(^|[^a-z0-9])(" + "|".join(sorted(heavy)) + ")([^a-z0-9]|$)"
    text = F.coalesce("text", F.lit(""))
    named_lines = F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("line"), F.lower(x).alias("t")))
    lines = F.filter(named_lines, lambda x: x["t"].rlike(pattern))
    part = F.struct(F.lit(0).alias("size"), F.lit(-1).alias("line"), F.lower(text).alias("t"))
    single = F.transform(lines, lambda x: F.struct(F.lit(1).alias("size"), x["line"].alias("line"), x["t"].alias("t")))
    several = F.transform(F.filter(blocks(text), lambda x: x["t"].rlike(pattern)),
                          lambda x: F.struct(F.lit(2).alias("size"), x["line"].alias("line"), x["t"].alias("t")))
    parts = F.when(F.exists(F.split(text, "\n"), lambda x: F.lower(x).rlike(pattern)), F.concat(F.array(part), single, several))
    seg = files.select("id", "path", F.xxhash64("text").alias("th"), F.explode(parts).alias("s"))
    place = ["id", "path", "th", "size", "line"]
    # rows of equal id, path and text are one file (document frequencies count rows); only compared lines are shuffled, never whole corpora of texts
    seg = seg.select("id", "path", "th", "s.size", "s.line", _terms(F.col("s.t")).alias("terms")).dropDuplicates(place)
    seg = seg.select(*place, F.explode("terms").alias("term"))
    tf = seg.groupBy(*place, "term").agg(F.count("*").alias("tf"))
    # one row per template term: bounded by the templates
    known = F.broadcast(spark.createDataFrame(list(idf.items()), "term string, idf double"))
    tf = tf.join(known, "term", "left").withColumn("x", F.col("tf") * F.coalesce("idf", F.lit(unseen)))
    tf = written(tf.select(*place, "term", "x"), "notice-terms")
    length = tf.groupBy(*place).agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("length"))
    dot = tf.join(weights, "term").groupBy(*place, "template", "licence").agg(F.sum(F.col("x") * F.col("w")).alias("dot"))
    same = [F.col(c).eqNullSafe(F.col("r" + c)) for c in place]
    j = dot.join(length.withColumnsRenamed({c: "r" + c for c in place}), same)
    cos = F.round(F.col("dot") / F.col("length"), 9)
    # the largest cosine; of equal ones lines and blocks before the whole text, the earliest first line, a line before a block, the first name
    rank = F.struct((-cos).alias("c"), (F.col("line") < 0).alias("whole"), F.col("line"), F.col("size"), F.col("licence"))
    best = j.where(cos >= threshold).groupBy("id", "path", "th").agg(F.min(rank).alias("b"))
    return best.select("id", "path", "th", "b.line", "b.licence", (-F.col("b.c")).alias("cosine"))


def directory(path: Column) -> Column:
    """Directory of a path; files without one lie in the root, the empty directory."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan(files: DataFrame, speaks: Column, id_col: str, path_col: str, text_col: str, threshold: float = THRESHOLD,
         templates=TEMPLATES) -> DataFrame:
    """One row per row of ``files``: id, path, own_licence, own_line, own_cosine, licence, source_dir.

    ``speaks`` is a condition over (id, path, line): the licence of such a file holds for its directory (of
    several in one directory: largest cosine, then smallest path, then name).  ``licence`` is the own
    one, else the one of the nearest directory above that has one; ``source_dir`` names that directory.
    Null and empty texts have no licence of their own; texts of any length are compared whole; a null path inherits nothing; null ids are ids like others;
    rows of equal id, path and text are one file (document frequencies count rows); an empty table gives no rows; further columns are not read."""
    rows = files.select(named(files, id_col).alias("id"), named(files, path_col).alias("path"), named(files, text_col).alias("text"))
    own = written(own_licences(rows, threshold, templates), "own-licences")
    says = own.where(speaks & F.col("path").isNotNull()).withColumn("dir", directory(F.col("path")))
    rank = F.struct((-F.col("cosine")).alias("c"), "path", "licence")
    of_dir = written(says.groupBy("dir").agg(F.min(rank)["licence"].alias("dir_licence")), "directory-licences")

    dirs = files.select(directory(named(files, path_col)).alias("dir")).where("dir is not null").distinct()
    steps = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.when(F.col("dir") == "", 0).otherwise(F.size(steps))),
                        lambda i: F.struct(i.alias("depth"), F.when(i == 0, F.lit("")).otherwise(F.array_join(F.slice(steps, F.lit(1), i), "/")).alias("up")))
    up = dirs.select("dir", F.explode(above).alias("a")).select("dir", "a.depth", "a.up")
    near = up.join(of_dir.withColumnRenamed("dir", "up"), "up").groupBy("dir").agg(
        F.max(F.struct("depth", "up", "dir_licence")).alias("n"))
    near = written(near.select("dir", F.col("n.up").alias("source_dir"), "n.dir_licence"), "inherited")

    each = files.select(named(files, id_col).alias("id"), named(files, path_col).alias("path"), F.xxhash64(named(files, text_col)).alias("th"))
    mine = own.select(F.col("id").alias("oid"), F.col("path").alias("opath"), F.col("th").alias("oth"), "line", "licence", "cosine")
    j = each.join(mine, F.col("id").eqNullSafe(F.col("oid")) & F.col("path").eqNullSafe(F.col("opath")) & (F.col("th") == F.col("oth")), "left")
    j = j.withColumn("dir", directory(F.col("path"))).join(near, "dir", "left")
    inherits = F.col("licence").isNull()
    return j.select(F.col("id").alias(id_col), F.col("path").alias(path_col), F.col("licence").alias("own_licence"),
                    F.col("line").alias("own_line"), F.col("cosine").alias("own_cosine"),
                    F.coalesce("licence", "dir_licence").alias("licence"), F.when(inherits, F.col("source_dir")).alias("source_dir"))
