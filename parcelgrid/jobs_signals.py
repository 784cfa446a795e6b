"""Job registrations: signals (E), company resolution."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from parcelgrid import fixtures as fx
from parcelgrid.jobs import DISTRESS_CTES, DISTRESS_SCAN_SQL, INCOMPLETE_OWNERS_SQL
from parcelgrid.catalog import register, tables
from parcelgrid.functions import signals as S
from parcelgrid.functions.geo import add_latlng, haversine_sql, latlng_sql
from parcelgrid.functions.text import levenshtein_ratio_sql as RATIO
from parcelgrid.functions.text import normalize_address_sql as NORM
from parcelgrid.jobs_feeds import HYGIENE_CTES, PROFILE_CTES, TRANSPORT_CTES, hygiene_ratings
from parcelgrid.operators import graph as G
from parcelgrid.operators import linkage as L
from parcelgrid.operators import spatial as SP
from parcelgrid.oracle import FEED_SQL, with_views
from parcelgrid.plans import corporate as CO
from parcelgrid.plans import distress as D
from parcelgrid.plans import signals as SG
from parcelgrid.sources import payloads as PL

STALENESS_AS_OF = dt.date(2026, 1, 15)
LEASE_AS_OF = dt.date(2010, 1, 1)
SEARCH_POINT = (51.5, -0.1)
SEARCH_KM = 2.0
NEAR_KM = 0.15
STOP_KM = 1.0
HEATMAP_CELL = 0.01
COMPANY_QUERY = "supplier#000000007"

# ----------------------------------------------------------- E4, E5, E12

register("distress_cards", with_views("""
SELECT uprn, address, asset_rating_band, company_name,
       CASE WHEN asset_rating_band IN ('F', 'G') THEN 'critical' WHEN asset_rating_band = 'E' THEN 'high' ELSE 'low' END AS risk_band,
       floor_area * 350 AS flat_value, floor_area * 10.764 * 350 AS flat_value_sqft,
       CASE WHEN address IS NULL OR address = '' THEN 'Unknown Address' ELSE split_part(address, ',', 1) END AS short_address,
       coalesce(nullif(company_name, ''), nullif(property_type, ''), 'Commercial Asset') AS title_line
FROM d3""", {**DISTRESS_CTES, "d3": DISTRESS_SCAN_SQL}))(
    lambda lake: D.distress_scan(*tables(lake)).select(
        "uprn", "address", "asset_rating_band", "company_name",
        S.risk_band("asset_rating_band").alias("risk_band"),
        S.flat_value("floor_area").alias("flat_value"), S.flat_value_sqft("floor_area").alias("flat_value_sqft"),
        S.short_address("address").alias("short_address"),
        S.title_line("company_name", "property_type").alias("title_line")))

# ----------------------------------------------------------- E8, E9, E10

_ITEMS = "CAST(coalesce(json_extract({c}, '$.items'), '[]') AS JSON[])"


def _parsed(lake):
    return PL.load_company_payloads(fx.company_payloads(lake))


register("active_officers", with_views(f"""
SELECT company_number,
       array_to_string(list_transform((list_filter({_ITEMS.format(c='officers')}, lambda x: NOT json_exists(x, '$.resigned_on')))[1:3],
                                      lambda x: CASE WHEN json_exists(x, '$.name') THEN x->>'name' ELSE 'Unknown' END), ', ') AS directors
FROM company_payloads"""))(lambda lake: CO.officer_summary(_parsed(lake)))

register("outstanding_charges", with_views(f"""
SELECT company_number, CAST(len(o) AS INTEGER) AS n_outstanding,
       CASE WHEN len(o) > 0 THEN concat(CAST(len(o) AS VARCHAR), ' CHARGES') ELSE 'CLEAR' END AS charges_label,
       CASE WHEN len(o) > 0 THEN 'MATURING DEBT DETECTED' ELSE 'NO CHARGES FILED' END AS debt_label,
       CASE WHEN len(o) > 0 THEN coalesce(nullif(json_extract_string(o[1], '$.persons_entitled[0].name'), ''), 'UNKNOWN LENDER') END AS first_lender,
       CASE WHEN len(o) > 0 THEN coalesce(nullif(json_extract_string(o[1], '$.particulars.description'), ''), 'Fixed Charge over Property') END AS first_description,
       CASE WHEN len(o) > 0 THEN json_extract_string(o[1], '$.created_on') END AS first_created_on
FROM (SELECT company_number, list_filter({_ITEMS.format(c='charges')}, lambda x: (x->>'status') = 'outstanding') AS o
      FROM company_payloads)"""))(lambda lake: CO.charge_summary(_parsed(lake)))

register("corporate_tree", with_views(f"""
SELECT c.company_number, c.company_name, c.company_status, c.address,
       array_to_string(list_transform(({_ITEMS.format(c='officers')})[1:5], lambda x: coalesce(x->>'name', '')), '; ') AS officers_top,
       array_to_string(list_transform(({_ITEMS.format(c='owners')})[1:5],
           lambda x: concat(coalesce(x->>'name', ''), ' (', coalesce(nullif(x->>'kind', ''), 'INDIVIDUAL'), ')')), '; ') AS owners_top,
       CAST(len({_ITEMS.format(c='officers')}) AS INTEGER) AS n_officers,
       CAST(len({_ITEMS.format(c='owners')}) AS INTEGER) AS n_owners
FROM profiles c JOIN company_payloads p ON c.company_number = p.company_number""", PROFILE_CTES))(
    lambda lake: CO.corporate_tree(PL.load_company_profiles(fx.company_payloads(lake)), _parsed(lake)))

# ------------------------------------------------------ C9, D10, E11


def resolve_sql(owners_cte: str, registry_cte: str, name_col: str = "company_name") -> dict[str, str]:
    """CTEs 'ok', 'rk', 'ex', 'fz', 'resolved' for C9 over two CTE names."""
    return {
        "ok": f"SELECT owner_name, {NORM('owner_name')} AS k FROM {owners_cte}",
        "rk": f"SELECT company_number, {name_col} AS company_name, company_status, {NORM(name_col)} AS k FROM {registry_cte}",
        "ex": """SELECT owner_name, company_number, company_name, company_status FROM (
            SELECT ok.owner_name, rk.company_number, rk.company_name, rk.company_status,
                   row_number() OVER (PARTITION BY ok.owner_name ORDER BY rk.company_number, rk.company_name, rk.company_status) AS rn
            FROM ok JOIN rk ON ok.k = rk.k) WHERE rn = 1""",
        "fz": f"""SELECT owner_name, company_number, company_name, company_status FROM (
            SELECT ok.owner_name, rk.company_number, rk.company_name, rk.company_status,
                   row_number() OVER (PARTITION BY ok.owner_name ORDER BY {RATIO('ok.k', 'rk.k')} DESC, rk.company_number) AS rn
            FROM ok CROSS JOIN rk
            WHERE ok.owner_name NOT IN (SELECT owner_name FROM ex) AND length(ok.k) > 0 AND length(rk.k) > 0
              AND {RATIO('ok.k', 'rk.k')} >= 0.85) WHERE rn = 1""",
        "resolved": """SELECT *, 'exact' AS match FROM ex UNION ALL SELECT *, 'fuzzy' AS match FROM fz""",
    }


_OWNERS = """SELECT DISTINCT "Proprietor Name (1)" AS owner_name FROM ownership_feed WHERE "Proprietor Name (1)" IS NOT NULL"""
_C9 = {"ownership_feed": FEED_SQL["ownership_feed"], "owners": _OWNERS}
_C9.update(resolve_sql("owners", "corporate_registry"))

register("resolve_company", with_views("SELECT * FROM resolved", _C9))(
    lambda lake: L.resolve_company(fx.ownership_feed(lake).select(F.col("Proprietor Name (1)").alias("owner_name")),
                                   fx.corporate_registry(lake)))

_INDEX_SQL = """SELECT concat('CH', lpad(CAST(s_suppkey AS VARCHAR), 8, '0')) AS company_number, upper(s_name) AS title,
       CASE WHEN s_suppkey % 5 = 0 THEN NULL WHEN s_suppkey % 5 = 1 THEN 'dissolved' ELSE 'active' END AS company_status
FROM supplier"""
_D10 = {"company_index": _INDEX_SQL, "q": f"SELECT '{COMPANY_QUERY}' AS owner_name"}
_D10.update(resolve_sql("q", "company_index", "title"))

register("company_search", with_views("SELECT company_number, company_name, company_status FROM resolved", _D10))(
    lambda lake: CO.company_search(fx.company_index(lake), COMPANY_QUERY))

_E11 = {
    "company_index": _INDEX_SQL,
    "tg": INCOMPLETE_OWNERS_SQL,
    "tgo": "SELECT DISTINCT company_name AS owner_name FROM tg WHERE company_name IS NOT NULL",
}
_E11.update(resolve_sql("tgo", "company_index", "title"))
_E11["ch"] = """SELECT tg.company_number, coalesce(r.company_status, 'active') AS new_status, r.company_name AS official_name
       FROM tg JOIN resolved r ON tg.company_name = r.owner_name"""

register("enrich_companies", with_views("""
SELECT c.company_number,
       CASE WHEN ch.company_number IS NOT NULL THEN ch.official_name ELSE c.company_name END AS company_name,
       CASE WHEN ch.company_number IS NOT NULL THEN 'United Kingdom' ELSE c.incorporation_country END AS incorporation_country,
       CASE WHEN ch.company_number IS NOT NULL THEN ch.new_status ELSE c.company_status END AS company_status
FROM corporate_registry c LEFT JOIN ch ON c.company_number = ch.company_number""", _E11))(
    lambda lake: CO.enrich_companies(fx.corporate_registry(lake), fx.ownership_records(lake),
                                     fx.master_properties(lake), fx.epc_assessments(lake), fx.company_index(lake)))

# ------------------------------------------------------------------ E14

_E14 = latlng_sql("(SELECT postcode, eastings, northings FROM postcode_index)")


def _grid_to_latlng(lake):
    out = add_latlng(fx.postcode_index(lake).select("postcode", "eastings", "northings"), "eastings", "northings")
    return out.withColumns({c: F.round(c, 6) for c in ("latitude", "longitude")})


register("grid_to_latlng", with_views(
    "SELECT postcode, eastings, northings, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude FROM located",
    _E14))(_grid_to_latlng)
register("grid_to_latlng_full", with_views(
    "SELECT postcode, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude FROM located",
    _E14))(lambda lake: _grid_to_latlng(lake).select("postcode", "latitude", "longitude"))

# ------------------------------------------------------------ E15-E19

register("hygiene_staleness", with_views(f"""
SELECT postcode, count(*) AS n,
       CAST(sum(CASE WHEN rating_date IS NULL OR rating_date < DATE '{STALENESS_AS_OF.replace(year=STALENESS_AS_OF.year - 2)}' THEN 1 ELSE 0 END) AS BIGINT) AS n_stale,
       round(sum(CASE WHEN rating_date IS NULL OR rating_date < DATE '{STALENESS_AS_OF.replace(year=STALENESS_AS_OF.year - 2)}' THEN 1 ELSE 0 END) / count(*), 4) AS stale_share
FROM fsa GROUP BY postcode""", HYGIENE_CTES))(
    lambda lake: SG.hygiene_staleness(hygiene_ratings(lake), STALENESS_AS_OF, years=2))

register("covenant_flag", with_views("""
SELECT p.uprn, p.title_number, coalesce(c.has_covenant, FALSE) AS has_covenant
FROM master_properties p LEFT JOIN covenant_registry c ON p.title_number = c.title_number"""))(
    lambda lake: SG.covenant_flag(fx.master_properties(lake), fx.covenant_registry(lake)))

register("lease_expiry", with_views("""
SELECT unique_lease_id, title_number, lease_date, lease_term_years,
       CAST(lease_date + to_years(lease_term_years) AS DATE) AS lease_expiry_date FROM lease_registry"""))(
    lambda lake: SG.lease_expiry(fx.lease_registry(lake)))

register("expiry_cliff", with_views(f"""
SELECT CAST(year(lease_expiry_date) AS INTEGER) AS expiry_year, count(*) AS n_leases FROM (
  SELECT CAST(lease_date + to_years(lease_term_years) AS DATE) AS lease_expiry_date FROM lease_registry)
WHERE lease_expiry_date >= DATE '{LEASE_AS_OF}' GROUP BY year(lease_expiry_date)"""))(
    lambda lake: SG.expiry_cliff(fx.lease_registry(lake), LEASE_AS_OF))

register("rates_change", with_views("""
SELECT billing_authority_ref, postcode, rateable_value_2023, rateable_value_2026,
       rateable_value_2026 - rateable_value_2023 AS change,
       CASE WHEN rateable_value_2023 = 0 THEN NULL
            ELSE round((rateable_value_2026 - rateable_value_2023) * 100.0 / rateable_value_2023, 4) END AS change_pct
FROM voa_ratings"""))(lambda lake: SG.rates_change(fx.voa_ratings(lake)))

register("fibre_desert", with_views("""
SELECT p.postcode, count(*) AS n,
       CAST(sum(CASE WHEN NOT coalesce(c.fiber_availability, FALSE) AND c.max_download_speed < 100 THEN 1 ELSE 0 END) AS BIGINT) AS n_desert,
       round(sum(CASE WHEN NOT coalesce(c.fiber_availability, FALSE) AND c.max_download_speed < 100 THEN 1 ELSE 0 END) / count(*), 4) AS desert_share
FROM connectivity_metrics c JOIN master_properties p ON c.uprn = p.uprn GROUP BY p.postcode"""))(
    lambda lake: SG.fibre_desert(fx.connectivity_metrics(lake), fx.master_properties(lake)))

# ------------------------------------------------------------ E20, E21

_lat0, _lng0 = SEARCH_POINT
register("radius_search", with_views(f"""
SELECT uprn, latitude, longitude, round({haversine_sql('latitude', 'longitude', repr(_lat0), repr(_lng0))}, 6) AS dist_km
FROM master_properties WHERE {haversine_sql('latitude', 'longitude', repr(_lat0), repr(_lng0))} <= {SEARCH_KM}"""))(
    lambda lake: SP.radius_search(fx.master_properties(lake).select("uprn", "latitude", "longitude"),
                                  _lat0, _lng0, SEARCH_KM).withColumn("dist_km", F.round("dist_km", 6)))


def _near_properties(lake):
    p = fx.master_properties(lake).select("uprn", "latitude", "longitude")
    r = p.select(F.col("uprn").alias("near_uprn"), F.col("latitude").alias("r_latitude"),
                 F.col("longitude").alias("r_longitude"))
    return SP.near_join(p, r, NEAR_KM, digits=6).where(F.col("uprn") != F.col("near_uprn")).select("uprn", "near_uprn", "dist_km")


register("near_properties", with_views(f"""
SELECT a.uprn, b.uprn AS near_uprn,
       round({haversine_sql('a.latitude', 'a.longitude', 'b.latitude', 'b.longitude')}, 6) AS dist_km
FROM master_properties a JOIN master_properties b ON a.uprn != b.uprn
WHERE {haversine_sql('a.latitude', 'a.longitude', 'b.latitude', 'b.longitude')} <= {NEAR_KM}"""))(_near_properties)


def _stops(lake):
    return PL.load_transport(fx.transport_payloads(lake))


register("footfall_heatmap", with_views(f"""
SELECT CAST(cy AS DOUBLE) * CAST({HEATMAP_CELL} AS DOUBLE) AS cell_lat,
       CAST(cx AS DOUBLE) * CAST({HEATMAP_CELL} AS DOUBLE) AS cell_lng, cy AS cell_y, cx AS cell_x,
       CAST(sum(annual_footfall) AS BIGINT) AS total_annual_footfall, count(*) AS n_points
FROM (SELECT CAST(floor(latitude / {HEATMAP_CELL}) AS BIGINT) AS cy, CAST(floor(longitude / {HEATMAP_CELL}) AS BIGINT) AS cx,
             annual_footfall FROM stops WHERE latitude IS NOT NULL AND longitude IS NOT NULL)
GROUP BY cy, cx""", TRANSPORT_CTES))(lambda lake: SG.footfall_heatmap(_stops(lake), HEATMAP_CELL))

register("nearest_stop", with_views(f"""
SELECT uprn, location_id, round(d, 6) AS dist_km, annual_footfall FROM (
  SELECT p.uprn, s.location_id, s.annual_footfall,
         {haversine_sql('p.latitude', 'p.longitude', 's.latitude', 's.longitude')} AS d,
         row_number() OVER (PARTITION BY p.uprn ORDER BY {haversine_sql('p.latitude', 'p.longitude', 's.latitude', 's.longitude')}, s.location_id) AS rn
  FROM master_properties p JOIN stops s ON {haversine_sql('p.latitude', 'p.longitude', 's.latitude', 's.longitude')} <= {STOP_KM})
WHERE rn = 1""", TRANSPORT_CTES))(
    lambda lake: SG.nearest_stop(fx.master_properties(lake), _stops(lake), STOP_KM)
    .withColumn("dist_km", F.round("dist_km", 6)))

# ------------------------------------------------------------------ E22

_ANC = """SELECT child, parent AS ancestor, 1 AS depth FROM ownership_edges WHERE child != parent
  UNION ALL
  SELECT a.child, e.parent AS ancestor, a.depth + 1 AS depth FROM anc a JOIN ownership_edges e ON a.ancestor = e.child
  WHERE e.parent != a.child"""

register("owner_ancestors", with_views("SELECT child, ancestor, min(depth) AS depth FROM anc GROUP BY child, ancestor", {"anc": _ANC}, recursive=True))(
    lambda lake: G.ancestors(fx.ownership_edges(lake)))

register("ultimate_owners", with_views("""
SELECT child, ancestor AS ultimate_owner, depth FROM (
  SELECT *, row_number() OVER (PARTITION BY child ORDER BY depth DESC, ancestor DESC) AS rn FROM anc) WHERE rn = 1""",
    {"anc": _ANC}, recursive=True))(lambda lake: G.ultimate_owners(fx.ownership_edges(lake)))

# ------------------------------------------------------------------ E23

register("map_points", with_views(f"""
SELECT e.uprn, p.address_line_1, e.asset_rating_band, pc.latitude AS lat, pc.longitude AS lng
FROM epc_assessments e JOIN master_properties p ON e.uprn = p.uprn
JOIN postcode_index pc ON {NORM('p.postcode')} = {NORM('pc.postcode')}
WHERE e.asset_rating_band IN ('F', 'G') AND pc.latitude IS NOT NULL AND pc.longitude IS NOT NULL"""))(
    lambda lake: SG.map_points(
        D.distressed_certificates(fx.epc_assessments(lake), fx.master_properties(lake))
        .select("uprn", "address_line_1", "asset_rating_band", "postcode"),
        fx.postcode_index(lake)).drop("postcode"))

