"""Quality rules with risk-controlled cutoffs, in DataFrame expressions only.

Each rule compares one feature of a text with a cutoff.  The cutoffs are not
typed in: they are chosen on labelled rows so that the share of good texts a
rule rejects is bounded.  For a stratum and a rule, candidate cutoffs come from a
fixed grid; a cutoff that rejects ``k`` of the stratum's ``n`` good labelled texts is
admissible when ``P(Bin(n, risk) <= k) <= delta / m``, that is, when the exact
(Clopper-Pearson) upper bound of its false rejection rate is at most ``risk``.
``m`` is the number of hypotheses tested, strata x rules x grid points
(Bonferroni), so with probability ``1 - delta`` all chosen cutoffs hold at once;
``risk`` is the total allowed per stratum divided by the number of rules, so the
bound also holds for the rules together.  The most selective admissible
cutoff that rejects any labelled bad text is used; a stratum with too few labels to prove anything gets no cutoff and rejects
nothing beyond the base rule.

:func:`judge` and :func:`keep_good` use :func:`joint_cutoffs`, which needs far fewer labels: per stratum the cutoffs of all rules
move together from loose to strict in ``STEPS`` settings, tested in this order on the share of good texts that any rule rejects
until one fails (fixed sequence).  So ``risk`` is not divided by the rules and ``delta`` only by the strata.  With four strata
and no false rejection 217 good labels past the base rule are enough at 2 % and 5 %.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, named, words, written

MIN_WORDS = 50
REPEAT_PERCENT = 50
#: counted as symbols, fixed values
SYMBOLS = "[#*$%&|<>]"
#: rule name -> feature over counts; a text is rejected when the feature exceeds the cutoff
RULES = ("symbols", "shouting", "marks", "dup_lines", "repeats", "long_words", "short_words")
#: cutoff grid: rule -> (start, step, points), values start + step * i
GRID = {"symbols": (0.02, 0.02, 25), "shouting": (0.1, 0.05, 18), "marks": (0.1, 0.1, 20), "dup_lines": (0.05, 0.05, 18),
        "repeats": (0.05, 0.025, 18), "long_words": (5.0, 0.5, 30), "short_words": (-5.0, 0.25, 17)}
#: settings of all cutoffs together, from loose to strict
STEPS = 30
RISK = 0.02
DELTA = 0.05


def _repeat_words(w: Column) -> Column:
    """Words inside three-word windows that occur twice or more in the text.  Window hashes are sorted with their
    positions; equal neighbours are repeats; sorted starts s1 < s2 < ... cover
    min(3, next - s) words each."""
    def starts(h: Column) -> Column:
        # h: (hash, start) sorted by hash
        hit = F.filter(h, lambda x, i: (F.get(h, i - 1)["h"] == x["h"]) | (F.get(h, i + 1)["h"] == x["h"]))
        return F.sort_array(F.transform(hit, lambda x: x["at"]))

    def covered(s: Column) -> Column:
        return F.aggregate(s, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")), lambda acc, x: F.struct(
            x.alias("last"), (acc["n"] + F.least(F.lit(3), x - acc["last"])).alias("n")))["n"].cast("long")

    def hashes(a: Column) -> Column:
        return F.sort_array(F.transform(F.sequence(F.lit(0), F.size(a) - 3), lambda i: F.struct(
            F.xxhash64(F.get(a, i), F.get(a, i + 1), F.get(a, i + 2)).alias("h"), i.alias("at"))))

    # one-element transforms bind each array once per row
    return F.when(F.size(w) >= 3, F.get(F.transform(F.transform(F.transform(
        F.array(w), hashes), starts), covered), F.lit(0))).otherwise(F.lit(0).cast("long"))


def _dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return F.get(F.transform(F.array(lines), lambda a: F.size(a) - F.size(F.array_distinct(a))), F.lit(0)).cast("long")


def _count(text: Column, pattern: str) -> Column:
    """Characters of a class: what stays when all others are removed."""
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), pattern.replace("[", "[^", 1) + "+", "")).cast("long")


def features(text: Column, split: Column) -> dict[str, Column]:
    """Base counts of one text, by name; ``split`` is its word array."""
    return {
        "n_words": F.size(split).cast("long"),
        "word_chars": F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")).cast("long"),
        "n_symbols": _count(text, SYMBOLS),
        "n_dup_lines": _dup_lines(text),
        "n_repeat_words": _repeat_words(split),
        "n_lines": F.size(F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))).cast("long"),
        "n_upper": _count(text, r"[\p{Lu}]"),
        "n_marks": _count(text, r"[!?]"),
    }


def measured(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all but the text), the base
    counts and ``base_failed``.  Null and empty texts have no words and fail."""
    keep = [c for c in docs.columns if c != text_col] if keep is None else keep
    (w,) = fresh(docs, "__words")
    text = named(docs, text_col)
    split = docs.select(*[named(docs, c) for c in dict.fromkeys([*keep, text_col])], words(text).alias(w))
    cols = features(named(split, text_col), F.col(w))
    out = split.select(*[named(split, c) for c in keep], *[c.alias(n) for n, c in cols.items()])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def rule_values() -> dict[str, Column]:
    """Rule features over the base counts; all are 0 for a text without words."""
    w = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    mean = F.col("word_chars") / w
    return {"symbols": F.col("n_symbols") / w, "shouting": F.col("n_upper") / chars, "marks": F.col("n_marks") / w,
            "dup_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)).cast("double"),
            "repeats": F.col("n_repeat_words") / w, "long_words": mean, "short_words": -mean}


def log_binomial_tail(n: Column, k: Column, p: float) -> Column:
    """ln P(Bin(n, p) <= k) for 0 <= k < n p, exact up to rounding, without underflow: the largest term is taken
    as a logarithm, the terms below it as ratios to it."""
    odds = (1 - p) / p
    log_choose = F.aggregate(F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>")),
                             F.lit(0.0), lambda acc, j: acc + F.log((n - j + 1) / j.cast("double")))
    # P(i - 1) / P(i) = i / (n - i + 1) * (1 - p) / p, walking down from i = k
    down = F.when(k >= 1, F.sequence(k, F.lit(1).cast("long"), F.lit(-1).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    total = F.aggregate(down, F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")), lambda acc, i: F.struct(
        (acc["term"] * i / (n - i + 1) * F.lit(odds)).alias("term"),
        (acc["sum"] + acc["term"] * i / (n - i + 1) * F.lit(odds)).alias("sum")))["sum"]
    return log_choose + k * math.log(p) + (n - k) * math.log(1 - p) + F.log(total)


def cutoffs(labelled: DataFrame, stratum_col: str = "stratum", good_col: str = "good",
            risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(stratum, rule, cutoff) chosen on labelled rows with the base counts.

    All labelled rows count.  Rows with a null label are ignored; a null stratum is a stratum of
    its own.  (stratum, rule) pairs without an admissible cutoff have no row."""
    vals = rule_values()
    rows = labelled.where(named(labelled, good_col).isNotNull()).select(
        named(labelled, stratum_col).alias("stratum"), named(labelled, good_col).alias("good"),
        F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), vals[r].cast("double").alias("value")) for r in RULES])).alias("v"))
    rows = rows.select("stratum", "good", "v.rule", "v.value")
    def by_rule(i: int) -> Column:
        return reduce(lambda acc, r: F.when(F.col("rule") == r, F.lit(float(GRID[r][i]))).otherwise(acc), RULES, F.lit(0.0))

    def point(g: Column) -> Column:
        return by_rule(0) + by_rule(1) * g

    # grid point g rejects a value above it; "above" counts the rejecting points, rounding mended by comparing
    near = F.ceil((F.col("value") - by_rule(0)) / by_rule(1)).cast("int")
    near = near - (F.col("value") <= point(near - 1)).cast("int") + (F.col("value") > point(near)).cast("int")
    above = F.least(by_rule(2).cast("int"), F.greatest(F.lit(0), near))
    hist = written(rows.groupBy("stratum", "rule", above.alias("above")).agg(
        F.sum(F.col("good").cast("long")).alias("good"), F.sum(1 - F.col("good").cast("long")).alias("bad")), "label-histogram")
    points_row = hist.select("stratum", "rule", "good", "bad", F.explode_outer(
        F.when(F.col("above") > 0, F.sequence(F.lit(0), F.col("above") - 1))).alias("g"))
    total = hist.groupBy("stratum", "rule").agg(F.sum("good").alias("n"))
    rejected = points_row.where("g is not null").groupBy("stratum", "rule", "g").agg(
        F.sum("good").alias("k"), F.sum("bad").alias("caught"))
    tested = rejected.join(total.withColumnRenamed("stratum", "s").withColumnRenamed("rule", "r"),
                           F.col("stratum").eqNullSafe(F.col("s")) & (F.col("rule") == F.col("r")))
    per_rule = risk / len(RULES)
    m = hist.select("stratum").distinct().count() * sum(g[2] for g in GRID.values())
    ok = tested.where((F.col("caught") > 0) & (F.col("k") < F.col("n") * per_rule)).where(
        log_binomial_tail(F.col("n"), F.col("k"), per_rule) <= math.log(delta / max(m, 1)))
    return ok.groupBy("stratum", "rule").agg(F.min(point(F.col("g"))).alias("cutoff"))


def joint_cutoffs(labelled: DataFrame, stratum_col: str = "stratum", good_col: str = "good",
                  risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(stratum, rule, cutoff) of all rules together, chosen on labelled rows with the base counts.

    Setting t of 0 .. STEPS - 1 puts every rule at the grid point t / (STEPS - 1) of the way from its loosest to its strictest, so what
    a setting rejects is rejected by all later ones.  Of the settings before the first that fails its test the loosest
    one that rejects the most labelled bad texts is taken; a stratum in which none rejects any has no row."""
    vals = rule_values()
    at = {r: [start + step * round((points - 1) * (1 - t / (STEPS - 1))) for t in range(STEPS)] for r, (start, step, points) in GRID.items()}
    # settings that spare a row: those whose cutoffs it does not exceed in any rule
    def below(r: str) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, at[r])), lambda c: vals[r] <= c))

    spared = F.least(*map(below, RULES))
    good = named(labelled, good_col).cast("long")
    hist = labelled.where(good.isNotNull()).groupBy(named(labelled, stratum_col).alias("stratum"), spared.alias("t")).agg(
        F.sum(good).alias("good"), F.sum(1 - good).alias("bad"))
    # at most STEPS + 1 entries per stratum
    per = written(hist.groupBy("stratum").agg(F.collect_list(F.struct("t", "good", "bad")).alias("h"), F.sum("good").alias("n")), "joint-labels")

    def upto(name: str, t: Column) -> Column:
        return F.aggregate("h", F.lit(0).cast("long"), lambda acc, x: acc + F.when(x["t"] <= t, x[name]).otherwise(F.lit(0).cast("long")))

    steps = per.select("stratum", "n", "h", F.explode(F.sequence(F.lit(0), F.lit(STEPS - 1))).alias("t"))
    steps = steps.select("stratum", "n", "t", upto("good", F.col("t")).alias("k"), upto("bad", F.col("t")).alias("caught"))
    strata = max(per.count(), 1)
    holds = F.when(F.col("k") < F.col("n") * risk, log_binomial_tail(F.col("n"), F.col("k"), risk) <= math.log(delta / strata)).otherwise(F.lit(False))
    tested = steps.withColumn("holds", holds)
    first = tested.groupBy(F.col("stratum").alias("s")).agg(F.coalesce(F.min(F.when(~F.col("holds"), F.col("t"))), F.lit(STEPS)).alias("stop"))
    ok = tested.join(first, F.col("stratum").eqNullSafe(F.col("s"))).where((F.col("t") < F.col("stop")) & (F.col("caught") > 0))
    best = ok.groupBy("stratum").agg((-F.max(F.struct("caught", (-F.col("t")).alias("back")))["back"]).alias("t"))
    entries = F.array(*[F.struct(F.lit(r).alias("rule"), F.get(F.array(*map(F.lit, at[r])), F.col("t")).alias("cutoff")) for r in RULES])
    return best.select("stratum", F.explode(entries).alias("e")).select("stratum", "e.rule", "e.cutoff")


def _judged(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, stratum_col: str, good_col: str,
            label_id_col: str | None, risk: float, delta: float) -> DataFrame:
    m = measured(docs.select(named(docs, id_col).alias("id"), named(docs, stratum_col).alias("stratum"),
                             named(docs, text_col).alias("text"), F.xxhash64(named(docs, text_col)).alias("th")), "text")
    m = written(m, "measured")
    lab = labels.select(named(labels, label_id_col or id_col).alias("lid"), named(labels, good_col).alias("good"))
    # rows that the base rule rejects anyway tell nothing about the other rules
    known = m.where(~F.col("base_failed")).join(lab, F.col("id") == F.col("lid"))
    cut = written(joint_cutoffs(known, "stratum", "good", risk, delta), "cutoffs")
    per = cut.groupBy(F.col("stratum").alias("s")).agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cut"))
    vals = rule_values()
    # a row per stratum with at most one entry per rule; Spark sees the size and decides on the join
    j = m.join(per, F.col("stratum").eqNullSafe(F.col("s")), "left")
    broken = F.array_compact(F.array(*[F.when(vals[r] > F.try_element_at(F.col("cut"), F.lit(r)), F.lit(r)) for r in sorted(RULES)]))
    out = j.withColumn("broken", F.coalesce(broken, F.array().cast("array<string>")))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
          good_col: str = "quality", label_id_col: str | None = None, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """Per row of ``docs``: id, the base counts, base_failed, kept, and ``broken``
    (the sorted names of the rules broken).

    kept is false when the base rule fails or a cutoff of the row's stratum is
    exceeded.  Null and empty texts have no words and fail the base rule; a null
    stratum is a stratum of its own; a null id has no label; every row, repeated or not, is judged by itself.
    A label counts once per (label row, document row) of its id; null labels are ignored.
    Without labels only the base rule rejects; empty tables give no rows; further columns are not read."""
    out = _judged(docs, labels, id_col, text_col, stratum_col, good_col, label_id_col, risk, delta)
    return out.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "broken")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
              good_col: str = "quality", label_id_col: str | None = None, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """``docs`` without the rows that :func:`judge` rejects; same columns.  Rows of equal id, stratum and
    text get equal verdicts, so the verdict is joined back on (id, stratum, text hash)."""
    (th,) = fresh(docs, "__text_hash")
    good = _judged(docs, labels, id_col, text_col, stratum_col, good_col, label_id_col, risk, delta).where("kept")
    rows = docs.withColumn(th, F.xxhash64(named(docs, text_col)))
    hit = rows.join(good, named(rows, id_col).eqNullSafe(good["id"]) & (rows[th] == good["th"])
                    & named(rows, stratum_col).eqNullSafe(good["stratum"]), "left_semi")
    return hit.select(*[named(hit, c) for c in docs.columns])
