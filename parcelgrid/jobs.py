"""
its oracle SQL where an SQL form exists.  Parameters used here are the
reference's own defaults (limits, thresholds)."""

from __future__ import annotations

from parcelgrid import fixtures as fx
from parcelgrid.catalog import register, tables
from parcelgrid.oracle import with_views
from parcelgrid.plans import distress as D
from parcelgrid.sources.tables import write_bucketed

# --------------------------------------------------------------- D: queries

#: certificates in the two worst bands with their premises, and who holds which title
DISTRESS_CTES = {
    "poor_premises": """
SELECT cert.certificate_id, cert.asset_rating_band, cert.floor_area, cert.property_type, premises.*
FROM master_properties premises, (FROM epc_assessments WHERE asset_rating_band >= 'F' AND asset_rating_band <= 'G') cert
WHERE cert.uprn = premises.uprn""",
    "title_holders": """
SELECT held.title_number, held.company_number AS holder, held.proprietor_name, held.date_registered,
       known.company_number AS registered, known.company_name, known.company_status, known.incorporation_country
FROM corporate_registry known RIGHT JOIN ownership_records held ON known.company_number = held.company_number""",
    "held_premises": "SELECT * FROM poor_premises LEFT JOIN title_holders USING (title_number)",
}
DISTRESS_SCAN_SQL = """
SELECT asset_rating_band, floor_area, uprn, address_line_1 AS address, local_authority_code AS local_authority,
       property_type, registered AS company_number, company_name, company_status
FROM held_premises
ORDER BY ascii(asset_rating_band) DESC, floor_area DESC NULLS LAST, uprn, certificate_id, holder NULLS LAST LIMIT 50"""

register("distress_scan", with_views(DISTRESS_SCAN_SQL, DISTRESS_CTES))(lambda lake: D.distress_scan(*tables(lake)))

register("distress_report", with_views("""
SELECT uprn, address_line_1 AS property_address, property_type, asset_rating_band, date_registered,
       coalesce(nullif(proprietor_name, ''), 'Unknown Owner (Individual?)') AS proprietor_name,
       coalesce(nullif(company_name, ''), 'N/A') AS company_name, coalesce(incorporation_country, '') AS incorporation_country
FROM held_premises
ORDER BY ascii(asset_rating_band) DESC, date_registered DESC NULLS LAST, uprn, certificate_id, holder NULLS LAST LIMIT 50""",
    DISTRESS_CTES))(lambda lake: D.distress_report(*tables(lake)))

register("distress_fallback", with_views("""
SELECT uprn, address_line_1, property_type, asset_rating_band FROM poor_premises ORDER BY uprn, certificate_id LIMIT 20""",
    DISTRESS_CTES))(lambda lake: D.distress_fallback(fx.epc_assessments(lake), fx.master_properties(lake)))

register("distressed_overseas", with_views("""
SELECT title_number, proprietor_name, incorporation_country, uprn, address_line_1, asset_rating_band
FROM held_premises WHERE registered IS NOT NULL AND incorporation_country <> 'United Kingdom'""", DISTRESS_CTES))(
    lambda lake: D.distressed_overseas(*tables(lake)))

register("property_search", with_views("""
SELECT found.uprn, found.address, cert.asset_rating_band
FROM (SELECT uprn, address_line_1 AS address FROM master_properties WHERE contains(lower(address_line_1), 'ring')) found
LEFT JOIN epc_assessments cert ON cert.uprn = found.uprn
ORDER BY found.uprn, cert.certificate_id NULLS LAST LIMIT 10"""))(
    lambda lake: D.property_search(fx.master_properties(lake), fx.epc_assessments(lake), "ring"))

register("planning_targets", with_views("""
SELECT located.uprn, located.postcode, located.latitude, located.longitude
FROM (SELECT uprn FROM epc_assessments WHERE asset_rating_band BETWEEN 'E' AND 'G') poor,
     (SELECT * FROM master_properties WHERE latitude IS NOT NULL) located WHERE located.uprn = poor.uprn"""))(lambda lake: D.planning_targets(fx.master_properties(lake), fx.epc_assessments(lake)))

#: incomplete companies that own a title of a badly rated property
INCOMPLETE_OWNERS_SQL = """
SELECT company_number, company_name FROM corporate_registry
WHERE (company_status IS NULL OR incorporation_country = 'Unknown') AND company_number IN (
  SELECT company_number FROM ownership_records WHERE title_number IN (
    SELECT title_number FROM master_properties WHERE uprn IN (
      SELECT uprn FROM epc_assessments WHERE asset_rating_band >= 'F' AND asset_rating_band <= 'G')))
GROUP BY company_number, company_name"""

register("enrichment_targets", with_views(INCOMPLETE_OWNERS_SQL))(lambda lake: D.enrichment_targets(fx.corporate_registry(lake), fx.ownership_records(lake),
                                                fx.master_properties(lake), fx.epc_assessments(lake)))

# ------------------------------------------------- A15: the same over bucketed tables


def bucketed_tables(lake):
    """The four core tables in their declared schemas, dealt by property, title and company."""
    frames = {"epc_assessments": fx.epc_assessments(lake), "master_properties": fx.master_properties(lake),
              "ownership_records": fx.ownership_records(lake).withColumnRenamed("seq", "id"), "corporate_registry": fx.corporate_registry(lake)}
    return [lake.spark.table(write_bucketed(df, name)) for name, df in frames.items()]


register("distressed_overseas_bucketed", with_views("""
SELECT title_number, proprietor_name, incorporation_country, uprn, address_line_1, asset_rating_band
FROM held_premises WHERE registered IS NOT NULL AND incorporation_country <> 'United Kingdom'""", DISTRESS_CTES))(
    lambda lake: D.distressed_overseas(*bucketed_tables(lake)))


def _enrichment_bucketed(lake):
    epc, props, owners, companies = bucketed_tables(lake)
    return D.enrichment_targets(companies, owners, props, epc)


register("enrichment_targets_bucketed", with_views(INCOMPLETE_OWNERS_SQL))(_enrichment_bucketed)

# ------------------------------------------------------- C: record linkage

from pyspark.sql import functions as F  # noqa: E402

from parcelgrid.functions.text import (difflib_ratio_ctes, levenshtein_ratio_sql, normalize_address,  # noqa: E402
                                       normalize_address_sql)
from parcelgrid.operators import linkage as L  # noqa: E402
from parcelgrid.plans import comps as CP  # noqa: E402

NORM = normalize_address_sql
RATIO = levenshtein_ratio_sql

_TARGETS_SQL = f"""
SELECT p.uprn, p.postcode, {NORM('p.address_line_1')} AS n FROM master_properties p
WHERE (p.title_number IS NULL OR p.title_number = '') AND p.postcode IS NOT NULL
  AND p.uprn IN (SELECT uprn FROM epc_assessments WHERE asset_rating_band IN ('F', 'G'))"""
_CANDS_SQL = f"""
SELECT uprn AS cand_uprn, title_number, postcode, {NORM('address_line_1')} AS n FROM master_properties
WHERE title_number IS NOT NULL AND title_number != '' AND postcode IS NOT NULL"""
_LINK_CTES = {
    "t": _TARGETS_SQL,
    "c": _CANDS_SQL,
    "s": f"SELECT t.uprn, c.cand_uprn, c.title_number, {RATIO('t.n', 'c.n')} AS ratio FROM t JOIN c ON t.postcode = c.postcode",
    "r": "SELECT *, row_number() OVER (PARTITION BY uprn ORDER BY ratio DESC, cand_uprn) AS rn FROM s",
    "links": "SELECT uprn, title_number, cand_uprn, ratio FROM r WHERE rn = 1 AND ratio >= 0.85",
}

register("normalize_addresses", with_views(f"""
SELECT uprn, address_line_1, {NORM('address_line_1')} AS address_norm FROM master_properties"""))(
    lambda lake: fx.master_properties(lake).select(
        "uprn", "address_line_1", normalize_address(F.col("address_line_1")).alias("address_norm")))

register("unlinked_targets", with_views("""
SELECT p.uprn, p.address_line_1, p.postcode FROM master_properties p
WHERE (p.title_number IS NULL OR p.title_number = '') AND p.postcode IS NOT NULL
  AND p.uprn IN (SELECT uprn FROM epc_assessments WHERE asset_rating_band IN ('F', 'G'))"""))(
    lambda lake: L.unlinked_targets(fx.master_properties(lake), fx.epc_assessments(lake)))

register("block_candidates", with_views("""
SELECT t.uprn, t.postcode, count(c.cand_uprn) AS n_candidates FROM t LEFT JOIN c ON t.postcode = c.postcode
GROUP BY t.uprn, t.postcode""", {"t": _TARGETS_SQL, "c": _CANDS_SQL}))(
    lambda lake: L.block_candidates(L.unlinked_targets(fx.master_properties(lake), fx.epc_assessments(lake)),
                                    L.titled_candidates(fx.master_properties(lake)), ["postcode"]))


def _similar_pairs(lake):
    props = fx.master_properties(lake)
    t = L.unlinked_targets(props, fx.epc_assessments(lake)).select(
        "uprn", "postcode", normalize_address(F.col("address_line_1")).alias("n"))
    c = L.titled_candidates(props).select("cand_uprn", "postcode", normalize_address(F.col("cand_address")).alias("n"))
    return L.similarity_join(t, c, ["postcode"], "uprn", "cand_uprn", "n", "n", 0.85, "levenshtein")


register("similar_pairs", with_views(
    "SELECT uprn, cand_uprn, ratio FROM s WHERE ratio >= 0.85",
    {k: _LINK_CTES[k] for k in ("t", "c", "s")}))(_similar_pairs)

register("best_match", with_views(
    "SELECT uprn, title_number, cand_uprn, ratio FROM links", _LINK_CTES))(
    lambda lake: L.title_links(fx.master_properties(lake), fx.epc_assessments(lake), method="levenshtein"))

_LINKED_SQL = """
SELECT p.uprn, CASE WHEN l.uprn IS NOT NULL THEN l.title_number ELSE p.title_number END AS title_number,
       p.address_line_1, p.postcode, p.latitude, p.longitude, p.local_authority_code
FROM master_properties p LEFT JOIN links l ON p.uprn = l.uprn"""

register("link_titles", with_views(_LINKED_SQL, _LINK_CTES))(
    lambda lake: L.link_titles(fx.master_properties(lake), fx.epc_assessments(lake), method="levenshtein"))

# the default measure, difflib (Python SequenceMatcher semantics): the SQL finds the matching blocks recursively
_LINK_DIFFLIB_CTES = {
    "t": _TARGETS_SQL, "c": _CANDS_SQL, **difflib_ratio_ctes("SELECT t.n AS a, c.n AS b FROM t JOIN c ON t.postcode = c.postcode"),
    "s": "SELECT t.uprn, c.cand_uprn, c.title_number, d.ratio FROM t JOIN c ON t.postcode = c.postcode JOIN difflib_ratios d ON d.a = t.n AND d.b = c.n",
    "r": _LINK_CTES["r"], "links": _LINK_CTES["links"]}

register("best_match_difflib", with_views("SELECT uprn, title_number, cand_uprn, ratio FROM links", _LINK_DIFFLIB_CTES, recursive=True))(
    lambda lake: L.title_links(fx.master_properties(lake), fx.epc_assessments(lake)))
register("link_titles_difflib", with_views(_LINKED_SQL, _LINK_DIFFLIB_CTES, recursive=True))(
    lambda lake: L.link_titles(fx.master_properties(lake), fx.epc_assessments(lake)))

# ------------------------------------------------------------ comps

_SALES_CTES = {
    "sales": """SELECT * FROM (SELECT transaction_id, transfer_date, price_paid, full_address, property_type, postcode,
       row_number() OVER (PARTITION BY postcode ORDER BY transfer_date DESC NULLS LAST, transaction_id) AS rn
       FROM raw_ppd_staging WHERE postcode IS NOT NULL) WHERE rn <= 20""",
    "sizes": """SELECT e.certificate_id, p.postcode, p.address_line_1, e.floor_area
       FROM epc_assessments e JOIN master_properties p ON e.uprn = p.uprn""",
}
_COMPS_CTES = dict(_SALES_CTES)
_COMPS_CTES.update({
    "pairs": f"""SELECT s.transaction_id, z.certificate_id, z.floor_area,
       {RATIO(NORM('s.full_address'), NORM('z.address_line_1'))} AS ratio
       FROM sales s JOIN sizes z ON s.postcode = z.postcode""",
    "firsts": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY certificate_id) AS rn2
       FROM pairs WHERE ratio > 0.8) WHERE rn2 = 1""",
    "per_sale": """SELECT s.postcode, s.transaction_id, s.transfer_date, s.price_paid, s.full_address,
       f.certificate_id, f.ratio, f.floor_area,
       CASE WHEN f.floor_area IS NOT NULL AND f.floor_area > 0 THEN s.price_paid / f.floor_area / 10.764 END AS psf
       FROM sales s LEFT JOIN firsts f ON s.transaction_id = f.transaction_id""",
})


def _sales_tables(lake):
    return fx.raw_ppd_staging(lake), fx.epc_assessments(lake), fx.master_properties(lake)


register("recent_sales", with_views(
    "SELECT transaction_id, transfer_date, price_paid, full_address, property_type, postcode FROM sales",
    _SALES_CTES))(lambda lake: CP.recent_sales(fx.raw_ppd_staging(lake)))

register("postcode_sizes", with_views("SELECT certificate_id, postcode, address_line_1, floor_area FROM sizes",
                                      _SALES_CTES))(
    lambda lake: CP.postcode_sizes(fx.epc_assessments(lake), fx.master_properties(lake)))

register("first_match", with_views(
    "SELECT transaction_id, postcode, certificate_id, ratio, floor_area FROM per_sale", _COMPS_CTES))(
    lambda lake: CP.sale_matches(*_sales_tables(lake), method="levenshtein").select(
        "transaction_id", "postcode", "certificate_id", "ratio", "floor_area"))

register("comps_sales", with_views("""
SELECT postcode, transaction_id, transfer_date, price_paid, certificate_id, psf,
       CAST(round_even(price_paid / 1000.0, 0) AS BIGINT) AS price_k,
       substr(full_address, 1, 35) AS address_35,
       CASE WHEN floor_area IS NOT NULL AND floor_area > 0 THEN CAST(CAST(trunc(floor_area) AS BIGINT) AS VARCHAR) ELSE 'N/A' END AS size_label
FROM per_sale""", _COMPS_CTES))(lambda lake: CP.comps_sales(*_sales_tables(lake), method="levenshtein"))

_COMPS_ALL_SQL = """
SELECT postcode, count(*) AS n_sales, count(psf) AS n_comps, CAST(floor(avg(psf)) AS BIGINT) AS avg_psf,
       CASE WHEN count(psf) = 0 THEN 'no size matches' ELSE 'ok' END AS signal
FROM per_sale GROUP BY postcode"""
_COMPS_DIFFLIB_CTES = {
    **_SALES_CTES,
    **difflib_ratio_ctes(f"SELECT {NORM('s.full_address')} AS a, {NORM('z.address_line_1')} AS b FROM sales s JOIN sizes z ON s.postcode = z.postcode"),
    "pairs": f"""SELECT s.transaction_id, z.certificate_id, z.floor_area, d.ratio FROM sales s JOIN sizes z ON s.postcode = z.postcode
       JOIN difflib_ratios d ON d.a = {NORM('s.full_address')} AND d.b = {NORM('z.address_line_1')}""",
    "firsts": _COMPS_CTES["firsts"], "per_sale": _COMPS_CTES["per_sale"]}

register("comps_all", with_views(_COMPS_ALL_SQL, _COMPS_CTES))(lambda lake: CP.comps_all(*_sales_tables(lake), method="levenshtein"))

register("comps_all_difflib", with_views(_COMPS_ALL_SQL, _COMPS_DIFFLIB_CTES, recursive=True))(lambda lake: CP.comps_all(*_sales_tables(lake)))

register("link_report", with_views("""
SELECT count(*) AS targets, count(l.uprn) AS matched,
       round(count(l.uprn) * 100.0 / count(*), 2) AS match_pct
FROM (SELECT DISTINCT uprn FROM t) x LEFT JOIN links l ON x.uprn = l.uprn""", _LINK_CTES))(
    lambda lake: L.link_report(fx.master_properties(lake), fx.epc_assessments(lake), method="levenshtein"))

COMPS_POSTCODE = "Brand#7"

register("comps_postcode", with_views(f"""
SELECT postcode, count(*) AS n_sales, count(psf) AS n_comps, CAST(floor(avg(psf)) AS BIGINT) AS avg_psf,
       CASE WHEN count(psf) = 0 THEN 'no size matches' ELSE 'ok' END AS signal
FROM per_sale WHERE postcode = '{COMPS_POSTCODE}' GROUP BY postcode""", _COMPS_CTES))(
    lambda lake: CP.comps(*_sales_tables(lake), postcode=COMPS_POSTCODE, method="levenshtein"))
