"""Blocked record linkage without emitting all pairs of a block.

``text_pairs`` finds every pair of texts in the same block whose similarity is at least ``threshold`` - exactly the
pairs the reference's nested loop would accept - by a *segment index* (partition-based similarity join):

* A ratio of t bounds the edits between two texts of lengths la and lb: ``levenshtein`` allows ``(1 - t) * max(la, lb)`` edits, ``difflib``
  ``(1 - t) * (la + lb)`` insertions and deletions, since its matched blocks are a common subsequence.
* One side is cut into more segments than edits are allowed.  Every edit spoils at most one segment, so at least one stands unchanged in the
  other text, moved by no more than the edits before and behind it permit.
* Where segments keep ``MIN_SEGMENT`` characters there are up to ``SPARE`` more of them than needed, and only the rarest edits + 1 are indexed:
  word endings that thousands of texts share ("LIMITED") are left out without losing a pair.
* The index is an equi-join on block and a 64-bit hash of (length, edits, segment number, segment) with the substrings of the other side.  A
  collision only adds a candidate.  Its rows hold ids and a word of character parities: an insertion or deletion flips one
  bit, so pairs whose words differ in more bits than the edits can flip do not leave the join.
* Short texts with few edits (``SUPPLIER#000012345``) have no rare segment left when the edits fall on the few characters that tell them apart.  Where
  there are at most ``VARIANTS`` ways to leave the edited characters out, the whole rest is the key in place of the segments: a pair at the
  threshold has a common subsequence of known length, and an equi-join on all subsequences of that length finds it.
* The texts join the distinct candidates afterwards, and the exact ratio decides.

Nothing is capped.  Equal texts of a block are one text; what asks for one candidate per target (C6, C7, C9) picks it per text, so a
third of all rows with one address costs one comparison per other text.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelgrid.functions.text import normalize_address, similarity_at_least
from parcelgrid.session import dealt, written

_EPS = 1e-9
MIN_SEGMENT = 4
SPARE = 2
VARIANTS = 200


def allowed_edits(la: Column, lb: Column, threshold: float, method: str) -> Column:
    """Edits that two texts of these lengths may have at the threshold; insertions and deletions only for difflib."""
    if method == "difflib":
        size = la + lb
    elif method == "levenshtein":
        size = F.greatest(la, lb)
    else:
        raise ValueError(method)
    return F.floor(size * F.lit(1.0 - threshold) + F.lit(_EPS)).cast("int")


def partner_lengths(length: Column, threshold: float, method: str) -> tuple[Column, Column]:
    """Least and largest length of a text that can reach the threshold with one of the given length."""
    share = threshold / (2.0 - threshold) if method == "difflib" else threshold
    return (F.greatest(F.lit(1), F.ceil(length * F.lit(share) - F.lit(_EPS))).cast("int"),
            F.floor(length / F.lit(share) + F.lit(_EPS)).cast("int"))


def _common(la: Column, lb: Column, threshold: float, method: str) -> Column:
    """Length of a common subsequence that two texts of these lengths have at the threshold."""
    edits = allowed_edits(la, lb, threshold, method)
    return F.floor((la + lb - edits + 1) / F.lit(2)).cast("int") if method == "difflib" else F.greatest(la, lb) - edits


def _by_rest(la: Column, lb: Column, threshold: float, method: str) -> Column:
    """Whether a pair of these lengths is found by what is left of both texts, not by segments."""
    longer = F.greatest(la, lb)
    out = longer - _common(la, lb, threshold, method)
    by_rest, left_out = out == 0, 1
    while math.comb(2 * left_out, left_out) <= VARIANTS:
        longest = next(n for n in range(2 * left_out, VARIANTS + 1) if math.comb(n + 1, left_out) > VARIANTS)
        by_rest, left_out = by_rest | ((out == left_out) & (longer <= longest)), left_out + 1
    return by_rest


def _rests(text: Column, threshold: float, method: str) -> Column:
    """Keys of the subsequences of a text that a partner found by the rest may share."""
    own = F.length(text)
    partners = F.filter(F.sequence(*partner_lengths(own, threshold, method)), lambda other: _by_rest(own, other, threshold, method))
    sizes = F.array_distinct(F.transform(partners, lambda other: _common(own, other, threshold, method)))

    def without_one(t: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(t)), lambda p: F.concat(t.substr(F.lit(1), p - 1), t.substr(p + 1, F.length(t))))

    def of_size(n: Column) -> Column:
        return F.aggregate(F.array_repeat(F.lit(0), own - n), F.array(text), lambda rests, _: F.array_distinct(F.flatten(F.transform(rests, without_one))))

    sizes = F.filter(sizes, lambda n: n <= own)
    return F.transform(F.flatten(F.transform(sizes, of_size)), lambda rest: F.xxhash64(F.lit(-1), rest))


def _segments(length: Column, edits: Column) -> Column:
    """Number of segments for a text of this length: one more than the edits, and spare ones while segments are long enough."""
    return F.greatest(edits + 1, F.least(edits + 1 + SPARE, F.floor(length / F.lit(MIN_SEGMENT)).cast("int")))


def _segment(length: Column, n: Column, i: Column) -> tuple[Column, Column]:
    """Start (from 0) and length of segment i of n; the last ones take the remainder."""
    base = F.floor(length / n).cast("int")
    first_long = n - length % n
    return i * base + F.greatest(F.lit(0), i - first_long), base + F.when(i >= first_long, F.lit(1)).otherwise(F.lit(0))


def _texts(df: DataFrame, id_col: str, text_col: str, block: list[str]) -> DataFrame:
    """block, _txt, _rep: different non-empty texts, each with the smallest id that has it."""
    return (df.select(*block, F.col(id_col).alias("_id"), F.col(text_col).alias("_txt")).where(F.length("_txt") > 0)
              .groupBy(*block, "_txt").agg(F.min("_id").alias("_rep")))


def parities(text: Column) -> Column:
    """A word in which bit b tells whether the characters hashed to b are odd in number."""
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(c), F.lit(64)).cast("int"))
    return F.aggregate(F.split(text, ""), F.lit(0).cast("long"), lambda word, c: word.bitwiseXOR(bit(c)))


def _exploded(df: DataFrame, values: Column, name: str, *keep: str) -> DataFrame:
    # explode_outer + a filter on the value: an inner explode lets the optimizer infer size(array) > 0 and push that whole
    # expression below upstream aggregates (evaluating it per source row instead of per distinct text)
    return df.select(*keep, F.explode_outer(values).alias(name)).where(F.col(name).isNotNull())


def _indexed(texts: DataFrame, block: list[str], threshold: float, method: str) -> DataFrame:
    """(block, _key, _rep, _word, _e): the rarest edits + 1 segments of each text, for every number of edits a partner may allow;
    and the rests of the short ones, with the most edits of any partner."""
    length = F.length("_txt")
    lo, hi = partner_lengths(length, threshold, method)
    partners = F.filter(F.sequence(lo, hi), lambda other: ~_by_rest(length, other, threshold, method))
    edits = F.array_distinct(F.transform(partners, lambda other: allowed_edits(length, other, threshold, method)))
    texts = texts.withColumn("_word", parities(F.col("_txt")))
    rows = _exploded(texts, edits, "_e", *block, "_rep", "_txt", "_word").withColumn("_n", _segments(F.length("_txt"), F.col("_e")))
    own = [*block, "_rep", "_word", "_e"]

    def key(i: Column) -> Column:
        start, size = _segment(F.length("_txt"), F.col("_n"), i)
        return F.xxhash64(F.length("_txt"), F.col("_e"), i, F.col("_txt").substr(start + 1, size))

    keys = _exploded(rows, F.transform(F.sequence(F.lit(0), F.col("_n") - 1), key), "_key", *own, "_n")
    plain, spare = keys.where(F.col("_n") == F.col("_e") + 1), keys.where(F.col("_n") > F.col("_e") + 1)
    common = spare.groupBy(*block, "_key").agg(F.count(F.lit(1)).alias("_c"))
    rarest = (spare.join(dealt(common), [*block, "_key"]).groupBy(*own)
              .agg(F.sort_array(F.collect_list(F.struct("_c", "_key"))).alias("_k")))
    chosen = F.transform(F.slice("_k", F.lit(1), F.col("_e") + 1), lambda x: x["_key"])
    rests = _exploded(texts.withColumn("_e", allowed_edits(length, hi, threshold, method)), _rests(F.col("_txt"), threshold, method), "_key", *own)
    return plain.select("_key", *own).unionByName(_exploded(rarest, chosen, "_key", *own)).unionByName(rests)


def _probes(texts: DataFrame, block: list[str], threshold: float, method: str) -> DataFrame:
    """(block, _key, _rep, _word): the substrings of each text where a segment of a partner may stand, and the rests of the short ones."""
    rows = texts.withColumn("_len", F.length("_txt")).withColumn("_word", parities(F.col("_txt")))
    own = F.col("_len")

    def of_length(la: Column) -> Column:
        e = allowed_edits(la, own, threshold, method)
        n = _segments(la, e)
        grown = own - la
        # a shift of d takes |d| edits before the segment and |grown - d| behind it
        least, most = F.ceil((grown - e) / F.lit(2)).cast("int"), F.floor((grown + e) / F.lit(2)).cast("int")

        def of_segment(i: Column) -> Column:
            start, size = _segment(la, n, i)
            first, last = F.greatest(F.lit(0), start + least), F.least(own - size, start + most)
            at = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
            return F.transform(at, lambda p: F.xxhash64(la, e, i, F.col("_txt").substr(p + 1, size)))

        return F.flatten(F.transform(F.sequence(F.lit(0), n - 1), of_segment))

    lo, hi = partner_lengths(own, threshold, method)
    partners = F.filter(F.sequence(lo, hi), lambda la: ~_by_rest(la, own, threshold, method))
    keys = F.array_distinct(F.concat(F.flatten(F.transform(partners, of_length)), _rests(F.col("_txt"), threshold, method)))
    return _exploded(rows, keys, "_key", *block, "_rep", "_word")


def _candidates(lt: DataFrame, rt: DataFrame, block: list[str], threshold: float, method: str) -> DataFrame:
    """(block, _lrep, _rrep): candidate pairs of texts, each once."""
    probes = _probes(lt, block, threshold, method).withColumnsRenamed({"_rep": "_lrep", "_word": "_lword"})
    index = _indexed(rt, block, threshold, method).withColumnsRenamed({"_rep": "_rrep", "_word": "_rword"})
    flips = 1 if method == "difflib" else 2  # a substitution is a deletion and an insertion
    alike = F.bit_count(F.col("_lword").bitwiseXOR(F.col("_rword"))) <= F.col("_e") * flips
    return probes.join(dealt(index), [*block, "_key"]).where(alike).select(*block, "_lrep", "_rrep").distinct()


def candidate_pairs(left: DataFrame, right: DataFrame, block: list[str], l_id: str, r_id: str,
                    l_text: str, r_text: str, threshold: float, method: str) -> DataFrame:
    """C3+C5: candidate pairs of different non-empty texts (named by their smallest ids), before the exact ratio."""
    pairs = _candidates(_texts(left, l_id, l_text, block), _texts(right, r_id, r_text, block), block, threshold, method)
    return pairs.select(F.col("_lrep").alias(l_id), F.col("_rrep").alias(r_id))


def text_pairs(left: DataFrame, right: DataFrame, block: list[str], l_id: str, r_id: str, l_text: str, r_text: str,
               threshold: float, method: str = "levenshtein", strict: bool = False) -> DataFrame:
    """(block, _lt, _rt, ratio): all pairs of different non-empty texts of a block with ratio >= threshold (> when ``strict``).
    Ratio is sim(l_text, r_text), argument order kept."""
    lt, rt = _texts(left, l_id, l_text, block), _texts(right, r_id, r_text, block)
    found = (_candidates(lt, rt, block, threshold, method)
             .join(dealt(lt.select(*block, F.col("_rep").alias("_lrep"), F.col("_txt").alias("_lt"))), [*block, "_lrep"])
             .join(dealt(rt.select(*block, F.col("_rep").alias("_rrep"), F.col("_txt").alias("_rt"))), [*block, "_rrep"])
             .withColumn("ratio", similarity_at_least(F.col("_lt"), F.col("_rt"), threshold, method)))
    keep = F.col("ratio") > threshold if strict else F.col("ratio") >= threshold
    return found.where(keep).select(*block, "_lt", "_rt", "ratio")


def similarity_join(left: DataFrame, right: DataFrame, block: list[str], l_id: str, r_id: str,
                    l_text: str, r_text: str, threshold: float, method: str = "levenshtein",
                    strict: bool = False) -> DataFrame:
    """All (l_id, r_id, ratio) in the same block with ratio >= threshold (> when ``strict``), for non-empty texts."""
    pairs = text_pairs(left, right, block, l_id, r_id, l_text, r_text, threshold, method, strict)
    mine = lambda df, i, t, name: dealt(df.select(*block, F.col(i).alias("_i" + name), F.col(t).alias(name)))
    return (pairs.join(mine(left, l_id, l_text, "_lt"), [*block, "_lt"]).join(mine(right, r_id, r_text, "_rt"), [*block, "_rt"])
                 .select(F.col("_i_lt").alias(l_id), F.col("_i_rt").alias(r_id), "ratio"))


def _prepare(df: DataFrame, id_col: str, text_col: str, block: list[str], extra: list[str]) -> DataFrame:
    return df.select(*block, id_col, *extra, normalize_address(F.col(text_col)).alias("_norm"))


def _choose(targets: DataFrame, candidates: DataFrame, block: list[str], t_id: str, c_id: str, best_first: bool, row: Column,
            threshold: float, method: str, strict: bool) -> DataFrame:
    """(t_id, _m, ratio): per target the smallest candidate ``row`` among those of the highest ratio, or among all that reach the threshold.
    Chosen per text: of the candidates with one text only the smallest row can win.  Two empty texts have ratio 1.0."""
    first = candidates.groupBy(*block, F.col("_norm").alias("_rt")).agg(F.min(row).alias("_m"))
    pairs = text_pairs(targets, candidates, block, t_id, c_id, "_norm", "_norm", threshold, method, strict)
    empty = first.where(F.col("_rt") == "").select(*block, F.lit("").alias("_lt"), "_rt", F.lit(1.0).alias("ratio"))
    order = [(-F.col("ratio")).alias("_nr"), F.col("_m"), F.col("ratio")] if best_first else [F.col("_m"), F.col("ratio")]
    winner = F.min(F.struct(*order)).alias("_w")
    per_text = pairs.unionByName(empty).join(dealt(first), [*block, "_rt"]).groupBy(*block, F.col("_lt").alias("_norm")).agg(winner)
    per_target = targets.select(*block, t_id, "_norm").join(dealt(per_text), [*block, "_norm"]).groupBy(t_id).agg(F.min("_w").alias("_w"))
    return per_target.select(t_id, F.col("_w._m").alias("_m"), F.col("_w.ratio").alias("ratio"))


def best_match(targets: DataFrame, candidates: DataFrame, block: list[str], t_id: str, c_id: str,
               t_text: str, c_text: str, c_seq: str, threshold: float = 0.85,
               method: str = "difflib") -> DataFrame:
    """Per target the candidate with the highest ratio (first in
    ``c_seq`` order on ties), kept if ratio >= threshold.  Texts are
    normalised (C1) first.  Output: t_id, c_id, ratio."""
    t = _prepare(targets, t_id, t_text, block, [])
    c = _prepare(candidates, c_id, c_text, block, [c_seq] if c_seq != c_id else [])
    row = F.struct(F.col(c_seq).alias("_s"), F.col(c_id).alias("_c"))
    best = _choose(t, c, block, t_id, c_id, True, row, threshold, method, strict=False)
    return best.select(t_id, F.col("_m._c").alias(c_id), "ratio")


def first_match(targets: DataFrame, candidates: DataFrame, block: list[str], t_id: str, c_id: str,
                t_text: str, c_text: str, c_seq: str, carry: list[str] | None = None,
                threshold: float = 0.8, method: str = "difflib") -> DataFrame:
    """Per target the first candidate (``c_seq`` order) whose ratio is
    strictly above ``threshold``.  ``carry`` candidate columns come along
    (e.g. floor_area).  Output: t_id, c_id, ratio, *carry."""
    carry = [x for x in (carry or []) if x not in (c_id, c_seq)]
    extra = list(dict.fromkeys(x for x in [c_seq, *carry] if x != c_id))
    t = _prepare(targets, t_id, t_text, block, [])
    c = _prepare(candidates, c_id, c_text, block, extra)
    # ordered by seq, then id; carried columns ride along
    row = F.struct(F.col(c_seq).alias("_s"), F.col(c_id).alias("_c"), *[F.col(x).alias(f"_k{i}") for i, x in enumerate(carry)])
    first = _choose(t, c, block, t_id, c_id, False, row, threshold, method, strict=True)
    return first.select(t_id, F.col("_m._c").alias(c_id), "ratio", *[F.col(f"_m._k{i}").alias(x) for i, x in enumerate(carry)])


# ------------------------------------------------------------ C4, C5, C8

def unlinked_targets(props: DataFrame, epc: DataFrame, bands=("F", "G")) -> DataFrame:
    """C4: F/G properties with no title (NULL or '') and a postcode."""
    e = epc.where(F.col("asset_rating_band").isin(*bands)).select("uprn")
    p = props.where((F.col("title_number").isNull() | (F.col("title_number") == ""))
                    & F.col("postcode").isNotNull())
    return p.join(dealt(e), "uprn", "left_semi").select("uprn", "address_line_1", "postcode")


def titled_candidates(props: DataFrame) -> DataFrame:
    """Properties that carry a title (non-empty) and a postcode."""
    return (props.where(F.col("title_number").isNotNull() & (F.col("title_number") != "")
                        & F.col("postcode").isNotNull())
                 .select(F.col("uprn").alias("cand_uprn"), "title_number",
                         F.col("address_line_1").alias("cand_address"), "postcode"))


def block_candidates(targets: DataFrame, candidates: DataFrame, block: list[str]) -> DataFrame:
    """C5 statistic: candidates per target's block, counted by aggregate
    join (no pair is materialised)."""
    per_block = candidates.groupBy(*block).agg(F.count(F.lit(1)).alias("n_candidates"))
    return (targets.join(per_block, block, "left")
                   .select("uprn", *block, F.coalesce("n_candidates", F.lit(0)).alias("n_candidates")))


def title_links(props: DataFrame, epc: DataFrame, threshold: float = 0.85,
                method: str = "difflib") -> DataFrame:
    """C4 -> C5 -> C1 -> C3 -> C2 -> C6: accepted (uprn, title_number, ratio).
    Candidate order on ties: candidate uprn."""
    t = unlinked_targets(props, epc)
    c = titled_candidates(props)
    best = best_match(t, c, ["postcode"], "uprn", "cand_uprn", "address_line_1", "cand_address",
                      "cand_uprn", threshold, method)
    return (best.join(dealt(c.select("cand_uprn", "title_number")), "cand_uprn")
                .select("uprn", "title_number", "cand_uprn", "ratio"))


def link_titles(props: DataFrame, epc: DataFrame, threshold: float = 0.85,
                method: str = "difflib") -> DataFrame:
    """master_properties with matched titles written in."""
    from parcelgrid.operators.merge import update_by_key
    links = title_links(props, epc, threshold, method).select("uprn", "title_number")
    return update_by_key(props, links, ["uprn"], ["title_number"])


def link_report(props: DataFrame, epc: DataFrame, threshold: float = 0.85,
                method: str = "difflib") -> DataFrame:
    """C8 report: targets, matched targets and match percent (2 places)."""
    t = unlinked_targets(props, epc).select("uprn").distinct()
    links = title_links(props, epc, threshold, method).select("uprn", F.lit(1).alias("_hit"))
    g = t.join(dealt(links), "uprn", "left").agg(F.count(F.lit(1)).alias("targets"), F.count("_hit").alias("matched"))
    return g.withColumn("match_pct", F.round(F.try_divide(F.col("matched") * F.lit(100.0), F.col("targets")), 2))


# ------------------------------------------------------------------- C9

def company_key(c) -> Column:
    """Normalised company name used for exact resolution."""
    return normalize_address(c)


def resolve_company(owners: DataFrame, registry: DataFrame, name_col: str = "owner_name",
                    threshold: float = 0.85, method: str = "levenshtein") -> DataFrame:
    """Owner name -> one registry company.  Exact match on the
    normalised name wins (lowest company_number); otherwise the best fuzzy
    match >= threshold among all companies (candidates share a rare segment,
    which loses no pair).  Output: owner_name, company_number,
    company_name, company_status, match ('exact' | 'fuzzy')."""
    o = owners.select(F.col(name_col).alias("owner_name")).where(F.col("owner_name").isNotNull()).distinct()
    o = written(o, "owners").withColumn("_k", company_key(F.col("owner_name")))  # few names of many rows, read more than once
    r = registry.select("company_number", "company_name", "company_status").withColumn("_k", company_key(F.col("company_name")))
    exact = (o.join(dealt(r), "_k").groupBy("owner_name")
              .agg(F.min(F.struct("company_number", "company_name", "company_status")).alias("_m"))
              .select("owner_name", F.col("_m.*"), F.lit("exact").alias("match")))
    rest = o.join(dealt(exact.select("owner_name")), "owner_name", "left_anti")
    named = lambda df, *cols: df.select(*cols, F.col("_k").alias("_norm"), F.lit("").alias("_b"))  # noqa: E731  names have no block
    fuzzy = (_choose(named(rest, "owner_name"), named(r, "company_number"), ["_b"], "owner_name", "company_number", True,
                     F.struct("company_number"), threshold, method, strict=False)
             .select("owner_name", F.col("_m.company_number").alias("company_number"))
             .join(dealt(r.drop("_k")), "company_number")
             .select("owner_name", "company_number", "company_name", "company_status", F.lit("fuzzy").alias("match")))
    return exact.unionByName(fuzzy)
