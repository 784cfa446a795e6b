"""C1 address normalisation and C2 string similarity.

Normalisation is native Column code.  Similarity has two methods:

* ``levenshtein`` - ``1 - d / max(len)``, native (``F.levenshtein``), runs in
  whole-stage codegen and has an SQL twin in DuckDB.
* ``difflib`` - the Ratcliff/Obershelp ratio of Python's ``SequenceMatcher``
  (argument order matters, popular-character heuristic for long second
  strings).  No JVM equivalent exists, so it is one Arrow-batched pandas UDF
  applied only to candidate pairs of the segment index of ``parcelgrid.operators.linkage``, and there only
  to those whose longest common subsequence allows the threshold.
"""

from __future__ import annotations

import difflib

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters Python's str.strip() removes (str.isspace()),
# written as a Java/RE2 character class so both engines strip the same set.
PY_WHITESPACE_CLASS = (
    r"[\t\n\x{0b}\x{0c}\r\x{1c}\x{1d}\x{1e}\x{1f} \x{85}\x{a0}\x{1680}"
    r"\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def normalize_address(c) -> Column:
    """NULL/'' -> ''; upper; ',' -> ' '; '.' removed; one non-recursive pass
    of '  ' -> ' '; then strip of all Python whitespace at both ends."""
    c = F.col(c) if isinstance(c, str) else c
    x = F.upper(F.coalesce(c, F.lit("")))
    x = F.replace(x, F.lit(","), F.lit(" "))
    x = F.replace(x, F.lit("."), F.lit(""))
    x = F.replace(x, F.lit("  "), F.lit(" "))
    x = F.regexp_replace(x, "^" + PY_WHITESPACE_CLASS + "+", "")
    return F.regexp_replace(x, PY_WHITESPACE_CLASS + "+$", "")


def normalize_address_sql(expr: str) -> str:
    """The same rule as SQL text (DuckDB / Spark SQL)."""
    x = f"replace(replace(replace(upper(coalesce({expr}, '')), ',', ' '), '.', ''), '  ', ' ')"
    x = f"regexp_replace({x}, '^{PY_WHITESPACE_CLASS}+', '')"
    return f"regexp_replace({x}, '{PY_WHITESPACE_CLASS}+$', '')"


def levenshtein_ratio(a, b) -> Column:
    """1 - levenshtein(a, b) / max(len a, len b); two empty strings -> 1.0."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    m = F.greatest(F.length(a), F.length(b))
    return F.when(m == 0, F.lit(1.0)).otherwise(
        F.lit(1.0) - F.levenshtein(a, b).cast("double") / m.cast("double"))


def levenshtein_ratio_sql(a: str, b: str) -> str:
    m = f"greatest(length({a}), length({b}))"
    return (f"CASE WHEN {m} = 0 THEN 1.0 ELSE "
            f"1.0 - CAST(levenshtein({a}, {b}) AS DOUBLE) / CAST({m} AS DOUBLE) END")


#: bits of a machine word
_WORD = 64


def _codes(texts: list[str], width: int, fill: int) -> np.ndarray:
    """Code points of texts, one row each, filled up to ``width``."""
    out = np.full((len(texts), width), fill, dtype=np.int64)
    for i, t in enumerate(texts):
        out[i, :len(t)] = np.frombuffer(t.encode("utf-32-le"), dtype=np.uint32)
    return out


def common_subsequence(a: list[str], b: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of each pair, all pairs at once: the bits of a word stand for
    the characters of the first text, and one addition per character of the second moves every chain on.  Texts over a
    word take several, joined by their carry."""
    la, lb = max(map(len, a), default=0), max(map(len, b), default=0)
    words = -(-la // _WORD)
    if not words or not lb:
        return np.zeros(len(a), dtype=np.int64)
    first, second = _codes(a, words * _WORD, -1), _codes(b, lb, -2)
    open_bits = np.full((len(a), words), np.uint64(2**_WORD - 1))
    bit = np.uint64(1) << np.arange(_WORD, dtype=np.uint64)
    for j in range(lb):
        same = (first == second[:, j:j + 1]).reshape(len(a), words, _WORD)
        mask = (same * bit).sum(axis=2, dtype=np.uint64)
        carry = np.zeros(len(a), dtype=np.uint64)
        for w in range(words):
            v = open_bits[:, w]
            hit = v & mask[:, w]
            low = v + hit
            total = low + carry
            carry = ((low < v) | (total < low)).astype(np.uint64)
            open_bits[:, w] = total | (v - hit)
    return np.bitwise_count(~open_bits).sum(axis=1).astype(np.int64)


def _difflib_ratio(a: pd.Series, b: pd.Series, least: float = 0.0) -> pd.Series:
    """Ratios; null for a null text, and for a pair whose longest common subsequence cannot reach ``least``
    (the matched blocks are a common subsequence)."""
    out: list[float | None] = [None] * len(a)
    pairs = [(i, x, y) for i, (x, y) in enumerate(zip(a, b, strict=True)) if x is not None and y is not None]
    if least > 0 and pairs:
        shared = common_subsequence([x for _, x, _ in pairs], [y for _, _, y in pairs])
        pairs = [p for p, n in zip(pairs, shared.tolist(), strict=True) if 2.0 * n >= (least - 1e-9) * (len(p[1]) + len(p[2]))]
    sm = difflib.SequenceMatcher(None)
    for i, x, y in pairs:
        # set_seq2 caches the analysis of the second string; set_seq1 is cheap
        sm.set_seqs(x, y)
        out[i] = sm.ratio()
    return pd.Series(out, dtype="float64")


@F.pandas_udf(T.DoubleType())
def difflib_ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return _difflib_ratio(a, b)


def difflib_ratio(a, b) -> Column:
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return difflib_ratio_udf(a, b)


def similarity(a, b, method: str = "levenshtein") -> Column:
    if method == "levenshtein":
        return levenshtein_ratio(a, b)
    if method == "difflib":
        return difflib_ratio(a, b)
    raise ValueError(f"unknown similarity method {method!r}")


def similarity_at_least(a: Column, b: Column, threshold: float, method: str) -> Column:
    """The similarity; it may be null where it is below the threshold.  difflib takes the common-subsequence bound of a
    whole batch before it looks at any pair."""
    if method != "difflib":
        return similarity(a, b, method)

    @F.pandas_udf(T.DoubleType())
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.concat([_difflib_ratio(x.iloc[i:i + 1024], y.iloc[i:i + 1024], threshold) for i in range(0, len(x), 1024)] or [pd.Series([], dtype="float64")],
                         ignore_index=True)

    return run(a, b)


def difflib_ratio_ctes(pairs: str) -> dict[str, str]:
    """Views, as SQL text for a recursive query, that end in ``difflib_ratios`` (a, b, ratio) for the text pairs (a, b) of a query.
    Runs of equal characters along the diagonals are found once; a step takes, of each open rectangle, the longest
    run inside it (the earliest in the first text, then in the second) and opens the two rectangles before and behind it.
    For second texts under 200 characters, where the measure has no popular characters."""
    own = lambda t, i: f"SELECT {t}, unnest(range(length({t}))) AS {i}, unnest(string_split({t}, '')) AS c FROM (SELECT DISTINCT {t} FROM texts WHERE {t} <> '')"
    start = "greatest(i0, alo, i0 + blo - j0)"
    return {
        "texts": f"SELECT DISTINCT a, b FROM ({pairs})",
        "runs": f"""
SELECT a, b, min(i) AS i0, min(j) AS j0, count(*) AS n FROM (
  SELECT t.a, t.b, i, j, i - row_number() OVER (PARTITION BY t.a, t.b, i - j ORDER BY i) AS island
  FROM texts t JOIN ({own('a', 'i')}) x ON x.a = t.a JOIN ({own('b', 'j')}) y ON y.b = t.b AND y.c = x.c)
GROUP BY a, b, i - j, island""",
        "rectangles": f"""
SELECT a, b, CAST(0 AS BIGINT) AS alo, CAST(length(a) AS BIGINT) AS ahi, CAST(0 AS BIGINT) AS blo, CAST(length(b) AS BIGINT) AS bhi, CAST(0 AS BIGINT) AS matched FROM texts
UNION ALL
(WITH longest AS (
  SELECT a, b, alo, ahi, blo, bhi, max((n, -i, -j)) AS m FROM (
    SELECT w.*, {start} AS i, {start} - i0 + j0 AS j, least(i0 + n, ahi, i0 + bhi - j0) - {start} AS n FROM rectangles w JOIN runs USING (a, b))
  WHERE n > 0 GROUP BY ALL)
 SELECT a, b, CASE side WHEN 0 THEN alo ELSE n - i END, CASE side WHEN 0 THEN -i ELSE ahi END,
        CASE side WHEN 0 THEN blo ELSE n - j END, CASE side WHEN 0 THEN -j ELSE bhi END, CASE side WHEN 0 THEN n ELSE 0 END
 FROM (SELECT * EXCLUDE (m), m[1] AS n, m[2] AS i, m[3] AS j FROM longest), (VALUES (0), (1)) AS sides(side))""",
        "difflib_ratios": """
SELECT a, b, CASE WHEN length(a) + length(b) = 0 THEN 1.0 ELSE 2.0 * CAST(sum(matched) AS DOUBLE) / (length(a) + length(b)) END AS ratio
FROM rectangles GROUP BY a, b""",
    }


def escape_like(q: str) -> str:
    """Escape LIKE wildcards so the user's text matches literally."""
    return q.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
