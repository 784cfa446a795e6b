"""Job registrations: feed loads (A), merge rules (B), streaming merge (F)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from parcelgrid import fixtures as fx
from parcelgrid.catalog import register
from parcelgrid.functions.geo import latlng_sql
from parcelgrid.functions.text import PY_WHITESPACE_CLASS
from parcelgrid.operators import merge as M
from parcelgrid.operators.asof import asof_join
from parcelgrid.oracle import FEED_SQL, with_views
from parcelgrid.sources import feeds as FD
from parcelgrid.sources import listing as LS
from parcelgrid.sources import payloads as PL

SALES_MIN_YEAR = 1998          # baseline year filter used by the registered jobs
PLANNING_AS_OF = dt.datetime(2026, 9, 1, 10, 30, 0)


def _feeds(*names, **more):
    d = {n: FEED_SQL[n] for n in names}
    d.update(more)
    return d


def _or(c, text: str):
    return F.coalesce(c, F.lit(text))


def _strip_sql(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{PY_WHITESPACE_CLASS}+', ''), '{PY_WHITESPACE_CLASS}+$', '')"


# ------------------------------------------------------------------ A1

register("load_ownership_companies", with_views("""
SELECT company_number, company_name, company_category, incorporation_country FROM (
  SELECT "Company Registration No. (1)" AS company_number, "Proprietor Name (1)" AS company_name,
         "Proprietorship Category (1)" AS company_category, 'Unknown' AS incorporation_country,
         row_number() OVER (PARTITION BY "Company Registration No. (1)" ORDER BY _seq) AS rn
  FROM ownership_feed WHERE "Company Registration No. (1)" IS NOT NULL) WHERE rn = 1""", _feeds("ownership_feed")))(
    lambda lake: FD.load_ownership(fx.ownership_feed(lake))[0])

_OWN_ROWS = """
SELECT "Title Number" AS title_number, "Company Registration No. (1)" AS company_number,
       "Proprietor Name (1)" AS proprietor_name,
       concat(coalesce("Proprietor (1) Address (1)", ''), ' ', coalesce("Proprietor (1) Address (2)", ''), ' ',
              coalesce("Proprietor (1) Address (3)", '')) AS proprietor_address,
       CAST(TRY_CAST("Price Paid" AS DECIMAL(15,2)) AS DOUBLE) AS price_paid,
       CAST(try_strptime("Date Proprietor Added", '%d-%m-%Y') AS DATE) AS date_registered, _seq
FROM ownership_feed WHERE "Title Number" IS NOT NULL AND "Company Registration No. (1)" IS NOT NULL"""

register("load_ownership_records", with_views(
    "SELECT title_number, company_number, proprietor_name, proprietor_address, price_paid, date_registered FROM own_rows",
    _feeds("ownership_feed", own_rows=_OWN_ROWS)))(
    lambda lake: FD.load_ownership(fx.ownership_feed(lake))[1].select(
        "title_number", "company_number", "proprietor_name", "proprietor_address",
        F.col("price_paid").cast("double").alias("price_paid"), "date_registered"))

register("load_ownership_stubs", with_views("""
SELECT title_number, address_line_1, postcode FROM (
  SELECT "Title Number" AS title_number, "Property Address" AS address_line_1, "Postcode" AS postcode,
         row_number() OVER (PARTITION BY "Title Number" ORDER BY _seq) AS rn
  FROM ownership_feed WHERE "Title Number" IS NOT NULL) WHERE rn = 1""", _feeds("ownership_feed")))(
    lambda lake: FD.load_ownership(fx.ownership_feed(lake))[2])

# ------------------------------------------------------------------ A2

register("load_certificate_properties", with_views("""
SELECT uprn, address_line_1, postcode, local_authority_code FROM (
  SELECT uprn, address AS address_line_1, postcode, local_authority AS local_authority_code,
         row_number() OVER (PARTITION BY uprn ORDER BY _seq) AS rn FROM certificate_feed WHERE uprn IS NOT NULL)
WHERE rn = 1""", _feeds("certificate_feed")))(lambda lake: FD.load_certificates(fx.certificate_feed(lake))[0])

register("load_certificate_assessments", with_views("""
SELECT certificate_id, uprn, inspection_date, asset_rating, asset_rating_band, floor_area, property_type, is_latest FROM (
  SELECT lmk_key AS certificate_id, uprn, TRY_CAST(inspection_date AS DATE) AS inspection_date,
         TRY_CAST(asset_rating AS INTEGER) AS asset_rating, asset_rating_band,
         TRY_CAST(floor_area AS DOUBLE) AS floor_area, property_type, TRUE AS is_latest,
         row_number() OVER (PARTITION BY lmk_key ORDER BY _seq DESC) AS rn
  FROM certificate_feed WHERE lmk_key IS NOT NULL) WHERE rn = 1""", _feeds("certificate_feed")))(
    lambda lake: FD.load_certificates(fx.certificate_feed(lake))[1])

# ------------------------------------------------------- A3, F2, B2

_SALES_OUT = f"""id AS transaction_id, TRY_CAST(price AS BIGINT) AS price_paid,
       CAST(try_strptime(date, '%Y-%m-%d %H:%M') AS DATE) AS transfer_date, postcode, type AS property_type,
       upper({_strip_sql("concat(coalesce(paon, ''), ' ', coalesce(saon, ''), ' ', coalesce(street, ''))")}) AS full_address,
       paon, saon, street"""
_SALES_COLS = ["transaction_id", "price_paid", "transfer_date", "postcode", "property_type", "full_address",
               "paon", "saon", "street"]


def _baseline(lake):
    return FD.load_sales(fx.sales_feed(lake), min_year=SALES_MIN_YEAR, feed_rank=0)


def _update(lake):
    return FD.load_sales(fx.sales_update_feed(lake), feed_rank=1)


register("load_sales", with_views(
    f"SELECT {_SALES_OUT} FROM sales_feed WHERE year(CAST(try_strptime(date, '%Y-%m-%d %H:%M') AS DATE)) >= {SALES_MIN_YEAR}",
    _feeds("sales_feed")))(lambda lake: _baseline(lake).select(*_SALES_COLS))

_BPU = {
    "b": f"""SELECT * FROM sales_feed WHERE year(CAST(try_strptime(date, '%Y-%m-%d %H:%M') AS DATE)) >= {SALES_MIN_YEAR}
             UNION ALL SELECT * FROM sales_update_feed""",
    "r": "SELECT *, row_number() OVER (PARTITION BY id ORDER BY rank DESC, _seq DESC) AS rn FROM b",
}
_BPU_SQL = with_views(f"SELECT {_SALES_OUT} FROM r WHERE rn = 1", _feeds("sales_feed", "sales_update_feed", **_BPU))

register("baseline_plus_update", _BPU_SQL)(
    lambda lake: FD.baseline_plus_update(_baseline(lake), _update(lake)).select(*_SALES_COLS))

register("merge_keep_last", with_views(f"""
SELECT transaction_id, price_paid, transfer_date, postcode, property_type, full_address FROM raw_ppd_staging
WHERE transaction_id NOT IN (SELECT id FROM sales_update_feed)
UNION ALL
SELECT transaction_id, price_paid, transfer_date, postcode, property_type, full_address FROM (
  SELECT {_SALES_OUT}, row_number() OVER (PARTITION BY id ORDER BY _seq DESC) AS rn FROM sales_update_feed) WHERE rn = 1""",
    _feeds("sales_update_feed")))(
    lambda lake: M.merge_keep_last(fx.raw_ppd_staging(lake), _update(lake), ["transaction_id"], "_seq"))

# ------------------------------------------------------------------ B1, B3, B7

_BATCH_COMPANIES = """
SELECT "Company Registration No. (1)" AS company_number, "Proprietor Name (1)" AS company_name,
       'Unknown' AS incorporation_country, _seq FROM ownership_feed"""

register("merge_keep_first", with_views("""
SELECT company_number, company_name, incorporation_country, company_status FROM corporate_registry
UNION ALL
SELECT company_number, company_name, incorporation_country, CAST(NULL AS VARCHAR) AS company_status FROM (
  SELECT *, row_number() OVER (PARTITION BY company_number ORDER BY _seq) AS rn FROM bc WHERE company_number IS NOT NULL)
WHERE rn = 1 AND company_number NOT IN (SELECT company_number FROM corporate_registry)""",
    _feeds("ownership_feed", bc=_BATCH_COMPANIES)))(
    lambda lake: M.merge_keep_first(
        fx.corporate_registry(lake),
        fx.ownership_feed(lake).select(M.qcol("Company Registration No. (1)").alias("company_number"),
                                       F.col("Proprietor Name (1)").alias("company_name"),
                                       F.lit("Unknown").alias("incorporation_country"), "_seq"),
        ["company_number"], "_seq"))

register("append_rows", with_views("""
SELECT title_number, company_number, proprietor_name, date_registered, price_paid FROM ownership_records
UNION ALL
SELECT title_number, company_number, proprietor_name, date_registered, price_paid FROM (
  SELECT *, row_number() OVER (PARTITION BY title_number, company_number ORDER BY _seq) AS rn2 FROM own_rows) x
WHERE rn2 = 1 AND NOT EXISTS (SELECT 1 FROM ownership_records o
                              WHERE o.title_number = x.title_number AND o.company_number = x.company_number)""",
    _feeds("ownership_feed", own_rows=_OWN_ROWS)))(
    lambda lake: M.append_rows(
        fx.ownership_records(lake).drop("seq"),
        FD.load_ownership(fx.ownership_feed(lake))[1].withColumn("price_paid", F.col("price_paid").cast("double")),
        dedup_on=["title_number", "company_number"], seq="_seq"))


_OWNED = ["title_number", "company_number", "proprietor_name", "date_registered", "price_paid"]


def _numbered_ownership(lake):
    """The landed records numbered in their order, the feed's rows after them."""
    have = fx.ownership_records(lake)
    target = M.surrogate_ids(have, ["seq", *_OWNED]).select("id", *_OWNED)
    batch = FD.load_ownership(fx.ownership_feed(lake))[1].withColumn("price_paid", F.col("price_paid").cast("double"))
    return M.append_numbered(target, batch.select(*_OWNED, "_seq"), ["_seq", *_OWNED])


register("append_rows_numbered", with_views("""
SELECT row_number() OVER (ORDER BY seq, title_number, company_number, proprietor_name, date_registered, price_paid) AS id,
       title_number, company_number, proprietor_name, date_registered, price_paid FROM ownership_records
UNION ALL
SELECT (SELECT count(*) FROM ownership_records) + row_number() OVER (ORDER BY _seq, title_number, company_number, proprietor_name, date_registered, price_paid),
       title_number, company_number, proprietor_name, date_registered, price_paid FROM own_rows""",
    _feeds("ownership_feed", own_rows=_OWN_ROWS)))(_numbered_ownership)


def _quarantine_ownership(lake):
    raw = fx.ownership_feed(lake)
    date_ok = F.try_to_date(F.col("Date Proprietor Added"), FD.OWNERSHIP_DATE_FORMAT).isNotNull()
    _, bad = M.quarantine(raw, {
        "missing_title": F.col("Title Number").isNull(),
        "missing_company": M.qcol("Company Registration No. (1)").isNull(),
        "bad_date": ~date_ok,
    })
    return bad.select(F.col("Title Number").alias("title_number"),
                      M.qcol("Company Registration No. (1)").alias("company_number"),
                      F.concat_ws("-", *[F.col(f"_seq.{f}").cast("string") for f in "onps"]).alias("seq_key"),
                      F.col("_reason").alias("reason"))


register("quarantine", with_views("""
SELECT "Title Number" AS title_number, "Company Registration No. (1)" AS company_number,
       concat_ws('-', _seq.o, _seq.n, _seq.p, _seq.s) AS seq_key,
       CASE WHEN "Title Number" IS NULL THEN 'missing_title'
            WHEN "Company Registration No. (1)" IS NULL THEN 'missing_company'
            ELSE 'bad_date' END AS reason
FROM ownership_feed
WHERE "Title Number" IS NULL OR "Company Registration No. (1)" IS NULL
   OR try_strptime("Date Proprietor Added", '%d-%m-%Y') IS NULL""", _feeds("ownership_feed")))(_quarantine_ownership)

# --------------------------------------------------------------- A4, B4, E13

_PC_CTES = latlng_sql("postcode_feed")
_PC_CTES["pc_batch"] = ("SELECT postcode, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, "
                        "CAST(eastings AS INTEGER) AS eastings, CAST(northings AS INTEGER) AS northings, "
                        "district_code, _file FROM located")
# files in name order, each against the keys of the files that did load
_PC_CTES["files"] = """
SELECT f._file, row_number() OVER (ORDER BY f._file) AS i, f.bad, coalesce(r.rivals, []) AS rivals FROM (
  SELECT _file, bool_or(postcode IN (SELECT postcode FROM postcode_index)) OR count(*) > count(DISTINCT postcode) AS bad FROM postcode_feed GROUP BY _file) f
LEFT JOIN (SELECT b._file, list(DISTINCT a._file) AS rivals FROM postcode_feed a JOIN postcode_feed b ON a.postcode = b.postcode AND a._file < b._file
           GROUP BY b._file) r ON r._file = f._file"""
_PC_CTES["walk"] = """
SELECT CAST(0 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS loaded UNION ALL
SELECT w.i + 1, CASE WHEN f.bad OR list_has_any(f.rivals, w.loaded) THEN w.loaded ELSE list_append(w.loaded, f._file) END
FROM walk w JOIN files f ON f.i = w.i + 1"""
_PC_CTES["clash"] = "SELECT _file FROM files WHERE NOT list_contains((SELECT loaded FROM walk ORDER BY i DESC LIMIT 1), _file)"


def _postcodes(lake):
    return FD.load_postcodes(fx.postcode_feed(lake)).withColumn(
        "latitude", F.round("latitude", 6)).withColumn("longitude", F.round("longitude", 6))


register("load_postcodes", with_views(
    "SELECT postcode, latitude, longitude, eastings, northings, district_code FROM pc_batch",
    _feeds("postcode_feed", **_PC_CTES), recursive=True))(lambda lake: _postcodes(lake).drop("_file", "_seq"))


def _pc_target(lake):
    t = fx.postcode_index(lake)
    return t.select("postcode", F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude"),
                    "eastings", "northings", F.lit(None).cast("string").alias("district_code"))


register("append_reject", with_views("""
SELECT postcode, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, eastings, northings,
       CAST(NULL AS VARCHAR) AS district_code FROM postcode_index
UNION ALL
SELECT postcode, latitude, longitude, eastings, northings, district_code FROM pc_batch
WHERE _file NOT IN (SELECT _file FROM clash)""", _feeds("postcode_feed", **_PC_CTES), recursive=True))(
    lambda lake: M.append_reject(_pc_target(lake), _postcodes(lake).drop("_seq"), ["postcode"], "_file"))


def _load_counts(lake):
    from parcelgrid.plans.signals import load_with_counts
    return load_with_counts(_pc_target(lake), _postcodes(lake).drop("_seq"), ["postcode"], "_file")[1]


register("load_counts", with_views("""
SELECT coalesce(_file, 'TOTAL') AS unit, CAST(sum(n) AS BIGINT) AS rows,
       CAST(sum(CASE WHEN accepted THEN n ELSE 0 END) AS BIGINT) AS rows_loaded
FROM (SELECT _file, count(*) AS n, _file NOT IN (SELECT _file FROM clash) AS accepted FROM postcode_feed GROUP BY _file)
GROUP BY ROLLUP (_file)""", _feeds("postcode_feed", **_PC_CTES), recursive=True))(_load_counts)

# ------------------------------------------------------- A2, B7: files set aside

#: the rules of the folder's broken files, over its derived lines
_CERT_FILES = {
    "filed": f"""SELECT _seq % {fx.CERTIFICATE_FILES} AS file, (_seq // {fx.CERTIFICATE_FILES}) % 10 = 0 AS odd, * FROM certificate_feed""",
    "judged": """SELECT file, CASE WHEN file = 13 AND bool_or(odd) THEN 'not UTF-8' WHEN file = 11 AND bool_or(odd) THEN 'malformed line'
       WHEN file = 3 THEN 'missing columns' WHEN file = 7 AND bool_or(odd) THEN 'too many fields' END AS reason,
       count(*) AS n_lines, CAST(CASE WHEN file IN (7, 11, 13) THEN sum(CASE WHEN odd THEN 1 ELSE 0 END) ELSE 0 END AS BIGINT) AS n_bad
       FROM filed GROUP BY file""",
}


def _certificate_files(lake):
    return FD.read_files(lake.spark, fx.certificate_files(lake), [c.upper() for c in FD.CERTIFICATE_COLUMNS], ignore_case=True)


register("certificate_file_verdicts", with_views("SELECT file, reason, n_lines, n_bad FROM judged", _feeds("certificate_feed", **_CERT_FILES)))(
    lambda lake: _certificate_files(lake)[1].withColumn("file", F.regexp_extract("file", "file=(\\d+)", 1).cast("bigint")))

register("load_certificate_files", with_views("""
SELECT lmk_key AS certificate_id, uprn, TRY_CAST(inspection_date AS DATE) AS inspection_date, TRY_CAST(asset_rating AS INTEGER) AS asset_rating,
       asset_rating_band, TRY_CAST(floor_area AS DOUBLE) AS floor_area, property_type, TRUE AS is_latest
FROM filed WHERE file IN (SELECT file FROM judged WHERE reason IS NULL)""", _feeds("certificate_feed", **_CERT_FILES)))(
    lambda lake: FD.load_certificates(_certificate_files(lake)[0].drop("_file", "_path"))[1])

# ------------------------------------------------------------------ A5

_HYG = {
    "hp": "SELECT p.*, r.authority FROM hygiene_payloads p ASOF LEFT JOIN hygiene_requests r ON p.landed_at >= r.begun_at",
    "he": "SELECT page, authority, unnest(CAST(json_extract(payload, '$.establishments') AS JSON[])) AS est FROM hp",
    "hr": """SELECT page, CAST(est->>'FHRSID' AS BIGINT) AS fsa_id, est->>'BusinessName' AS business_name,
       est->>'AddressLine1' AS address_line_1, est->>'PostCode' AS postcode, est->>'RatingValue' AS rating_value,
       TRY_CAST(split_part(est->>'RatingDate', 'T', 1) AS DATE) AS rating_date,
       CAST(TRY_CAST(est->'geocode'->>'latitude' AS DECIMAL(10,6)) AS DOUBLE) AS latitude,
       CAST(TRY_CAST(est->'geocode'->>'longitude' AS DECIMAL(10,6)) AS DOUBLE) AS longitude,
       authority AS local_authority_code FROM he""",
    "fsa": """SELECT fsa_id, business_name, address_line_1, postcode, rating_value, rating_date, latitude, longitude,
       local_authority_code FROM (SELECT *, row_number() OVER (PARTITION BY fsa_id ORDER BY local_authority_code DESC NULLS LAST, page DESC) AS rn
       FROM hr WHERE fsa_id IS NOT NULL) WHERE rn = 1""",
}
HYGIENE_CTES = _HYG

def hygiene_ratings(lake):
    """Pages belong to the authority whose download was begun last before they landed."""
    pages = asof_join(fx.hygiene_payloads(lake), fx.hygiene_requests(lake), "landed_at", "begun_at", ["authority"])
    return PL.load_hygiene(pages, authority_col="authority")


register("load_hygiene", with_views("SELECT * FROM fsa", _HYG))(hygiene_ratings)

# ------------------------------------------------------------------ A6

_TRN = {
    "te": """SELECT seq, mode, unnest(CAST(json_extract(payload, '$.stopPoints') AS JSON[])) AS s FROM transport_payloads""",
    "tr": """SELECT seq, CASE mode WHEN 'tube' THEN 1 WHEN 'dlr' THEN 2 WHEN 'overground' THEN 3 END AS mrank,
       s->>'id' AS location_id, s->>'commonName' AS name, CAST(s->>'lat' AS DOUBLE) AS latitude,
       CAST(s->>'lon' AS DOUBLE) AS longitude,
       CAST(1000000 + 500000 * coalesce(json_array_length(s->'lines'), 0) AS INTEGER) AS annual_footfall,
       concat('TFL_', upper(mode)) AS metric_type FROM te""",
    "stops": """SELECT location_id, name, latitude, longitude, annual_footfall, metric_type FROM (
       SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY mrank DESC, seq DESC) AS rn
       FROM tr WHERE location_id IS NOT NULL) WHERE rn = 1""",
}
TRANSPORT_CTES = _TRN

register("load_transport", with_views("SELECT * FROM stops", _TRN))(
    lambda lake: PL.load_transport(fx.transport_payloads(lake)))

# ------------------------------------------------------------- A7 + E6



def _planning_answers(lake):
    """Payloads belong to the target property that was asked for last before they landed."""
    return asof_join(fx.planning_payloads(lake), fx.planning_requests(lake), "landed_at", "asked_at", ["uprn"])


_lo, _hi = PL.snipe_window(PLANNING_AS_OF)
register("load_planning", with_views(f"""
SELECT application_id, uprn, address, description, status, decision_date, expiry_date,
       days_remaining, days_remaining > 0 AND days_remaining < 180 AS is_lapsing_soon, url
FROM (SELECT *, row_number() OVER (PARTITION BY application_id ORDER BY seq DESC) AS rn FROM y) WHERE rn = 1""", {
    "pp": "SELECT p.*, q.uprn FROM planning_payloads p ASOF LEFT JOIN planning_requests q ON p.landed_at >= q.asked_at",
    "pe": "SELECT seq, uprn, unnest(CAST(json_extract(payload, '$.records') AS JSON[])) AS r FROM pp",
    "pg": """SELECT seq, uprn, r->>'uid' AS application_id, r->>'status' AS status,
       TRY_CAST(r->>'date_decision' AS DATE) AS decision_date, r->>'address' AS address,
       r->>'description' AS description, r->>'url' AS url FROM pe WHERE r->>'status' = 'Granted'""",
    "x": f"""SELECT *, CAST(decision_date + INTERVAL 1095 DAY AS DATE) AS expiry_date FROM pg
       WHERE decision_date BETWEEN DATE '{_lo}' AND DATE '{_hi}'""",
    "y": f"""SELECT *, CAST(floor((epoch(CAST(expiry_date AS TIMESTAMP)) - epoch(TIMESTAMP '{PLANNING_AS_OF:%Y-%m-%d %H:%M:%S}'))
       / 86400) AS INTEGER) AS days_remaining FROM x""",
}))(lambda lake: PL.load_planning(_planning_answers(lake), PLANNING_AS_OF, uprn_col="uprn").drop("_seq"))

# ------------------------------------------------------------------ A8

_ITEM_LIST = "CAST(coalesce(json_extract({c}, '$.items'), '[]') AS JSON[])"

register("load_company_payloads", with_views(f"""
SELECT company_number,
       array_to_string(list_transform({_ITEM_LIST.format(c='officers')}, lambda x: concat(coalesce(x->>'name', '?'), '/', coalesce(x->>'resigned_on', '-'))), '; ') AS officers,
       array_to_string(list_transform({_ITEM_LIST.format(c='owners')}, lambda x: concat(coalesce(x->>'name', '?'), '/', coalesce(x->>'kind', '-'))), '; ') AS owners,
       array_to_string(list_transform({_ITEM_LIST.format(c='charges')}, lambda x: concat(coalesce(x->>'status', '?'), '/', coalesce(x->>'created_on', '-'), '/',
           coalesce(json_extract_string(x, '$.persons_entitled[0].name'), '-'))), '; ') AS charges
FROM company_payloads"""))(
    lambda lake: PL.load_company_payloads(fx.company_payloads(lake)).select(
        "company_number", *[F.array_join(F.transform(c, f), "; ").alias(c) for c, f in (
            ("officers", lambda x: F.concat(_or(x["name"], "?"), F.lit("/"), _or(F.try_element_at(x, F.lit("resigned_on")), "-"))),
            ("owners", lambda x: F.concat(_or(x["name"], "?"), F.lit("/"), _or(x["kind"], "-"))),
            ("charges", lambda x: F.concat(_or(x["status"], "?"), F.lit("/"), _or(x["created_on"], "-"), F.lit("/"), _or(F.get(x["persons_entitled"], 0)["name"], "-"))))]))

PROFILE_CTES = {"profiles": """
SELECT company_number, j->>'company_name' AS company_name, j->>'company_status' AS company_status,
       concat_ws(', ', json_extract_string(j, '$.registered_office_address.address_line_1'), json_extract_string(j, '$.registered_office_address.locality'),
                 json_extract_string(j, '$.registered_office_address.postal_code')) AS address,
       TRY_CAST(json_extract_string(j, '$.accounts.last_accounts.made_up_to') AS DATE) AS last_accounts_date,
       coalesce(array_to_string(json_extract_string(j, '$.sic_codes[*]'), ','), '') AS sic_codes
FROM (SELECT company_number, CASE WHEN json_valid(profile) THEN CAST(profile AS JSON) END AS j FROM company_payloads)
WHERE j->>'company_name' IS NOT NULL"""}

register("load_company_profiles", with_views("SELECT * FROM profiles", PROFILE_CTES))(lambda lake: PL.load_company_profiles(fx.company_payloads(lake)))

register("load_search_hits", with_views("""
SELECT s_name AS query, concat('CH', lpad(CAST(s_suppkey AS VARCHAR), 8, '0')) AS company_number, upper(s_name) AS title,
       'active' AS company_status,  -- a missing status defaults to 'active'
       CASE WHEN s_suppkey % 2 = 0 THEN concat(CAST(s_suppkey AS VARCHAR), ' Main Road') ELSE '' END AS address_snippet
FROM supplier WHERE s_suppkey % 7 != 0"""))(lambda lake: PL.load_search_hits(fx.search_payloads(lake)))

# ------------------------------------------------------------------ A9

register("load_address_lookups", with_views("""
SELECT concat('Q', uprn) AS query,
       CASE WHEN CAST(uprn AS BIGINT) % 10 = 0 THEN NULL ELSE uprn END AS uprn,
       CASE WHEN CAST(uprn AS BIGINT) % 10 = 0 THEN NULL ELSE upper(address_line_1) END AS address,
       CASE WHEN CAST(uprn AS BIGINT) % 10 = 0 THEN NULL ELSE postcode END AS postcode,
       CASE WHEN CAST(uprn AS BIGINT) % 10 = 0 THEN NULL ELSE latitude END AS lat,
       CASE WHEN CAST(uprn AS BIGINT) % 10 = 0 THEN NULL ELSE longitude END AS lng,
       CASE WHEN CAST(uprn AS BIGINT) % 10 = 0 THEN NULL ELSE CAST(500000 + CAST(uprn AS BIGINT) AS DOUBLE) END AS x_coordinate,
       CASE WHEN CAST(uprn AS BIGINT) % 10 = 0 THEN NULL ELSE CAST(180000 + CAST(uprn AS BIGINT) AS DOUBLE) END AS y_coordinate
FROM master_properties"""))(lambda lake: PL.load_address_lookups(fx.address_payloads(lake)))

# ------------------------------------------------------------ A10-A13

_RATES = {
    "r23": """SELECT CAST(p_partkey AS VARCHAR) AS ref, concat(CAST(p_size AS VARCHAR), ' ', p_name) AS address,
       p_brand AS postcode, p_type AS description, CAST(floor(p_retailprice) AS INTEGER) AS rv,
       DATE '2023-04-01' AS eff FROM part""",
    "r26": """SELECT CAST(p_partkey AS VARCHAR) AS ref, concat(CAST(p_size AS VARCHAR), ' ', p_name) AS address,
       p_brand AS postcode, p_type AS description, CAST(floor(p_retailprice) AS INTEGER) + p_size * 4 - 50 AS rv,
       DATE '2026-04-01' AS eff FROM part WHERE p_partkey % 7 != 0""",
}
register("load_rates", with_views("""
SELECT coalesce(b.ref, a.ref) AS billing_authority_ref, coalesce(b.address, a.address) AS address,
       coalesce(b.postcode, a.postcode) AS postcode, coalesce(b.description, a.description) AS description,
       a.rv AS rateable_value_2023, b.rv AS rateable_value_2026, coalesce(b.eff, a.eff) AS effective_date,
       CASE WHEN b.ref IS NOT NULL THEN 2026 ELSE 2023 END AS list_year
FROM r23 a FULL OUTER JOIN r26 b ON a.ref = b.ref""", _RATES))(
    lambda lake: FD.load_rates(fx.rates_feed(lake, 2023), fx.rates_feed(lake, 2026)))

register("load_leases", with_views("""
SELECT unique_lease_id, title_number, lease_date, lease_term_years, lessee_name,
       CAST(lease_date + to_years(lease_term_years) AS DATE) AS lease_expiry_date, 'Leasehold' AS tenure
FROM (SELECT concat('L', CAST(o_orderkey AS VARCHAR)) AS unique_lease_id,
             concat('T', CAST(o_orderkey % (SELECT count(*) FROM part) AS VARCHAR)) AS title_number,
             CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS lease_date,
             CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(o_custkey % 30 + 1 AS INTEGER) END AS lease_term_years,
             concat('Tenant ', CAST(o_custkey AS VARCHAR)) AS lessee_name FROM orders)
WHERE lease_date IS NOT NULL AND lease_term_years IS NOT NULL"""))(
    lambda lake: FD.load_leases(fx.lease_feed(lake)))

register("load_covenants", with_views("""
SELECT DISTINCT concat('T', CAST(l_partkey AS VARCHAR)) AS title_number, TRUE AS has_covenant
FROM lineitem WHERE l_returnflag = 'R'"""))(lambda lake: FD.load_covenants(fx.covenant_feed(lake)))

register("load_connectivity", with_views("""
SELECT CAST(p_partkey AS VARCHAR) AS uprn, p_size * 10 AS max_download_speed, p_size AS max_upload_speed,
       p_partkey % 2 = 0 AS fiber_availability, p_partkey % 5 = 0 AS five_g_availability FROM part"""))(
    lambda lake: FD.load_connectivity(fx.connectivity_feed(lake)))

# ------------------------------------------------------------ A14, A16

register("select_feed_files", with_views("""
SELECT seq, object_key, CAST(size AS BIGINT) AS size FROM object_listing
WHERE starts_with(object_key, 'raw/epc/') AND contains(object_key, 'certificates.csv')
  AND NOT contains(object_key, 'recommendations')"""))(
    lambda lake: LS.select_feed_files(fx.object_listing(lake), "raw/epc/", "certificates.csv", "recommendations")
    .withColumn("size", F.col("size").cast("bigint")))

_FOLDER_SQL = """CASE WHEN len(string_split(object_key, '/')) > 2
     THEN concat(string_split(object_key, '/')[1], '/', string_split(object_key, '/')[2])
     WHEN len(string_split(object_key, '/')) = 2 THEN string_split(object_key, '/')[1] ELSE 'root' END"""

register("lake_inventory", with_views(f"""
SELECT coalesce(folder, 'TOTAL') AS folder, count(*) AS files, CAST(sum(size) AS BIGINT) AS size_bytes,
       round_even(sum(size) / 1048576.0, 2) AS size_mb,
       CASE WHEN folder IS NULL THEN 0 ELSE greatest(count(*) - 20, 0) END AS more_files
FROM (SELECT {_FOLDER_SQL} AS folder, size FROM object_listing) GROUP BY ROLLUP (folder)"""))(
    lambda lake: LS.lake_inventory(fx.object_listing(lake).withColumn("size", F.col("size").cast("bigint"))))

register("lake_inventory_files", with_views(f"""
SELECT folder, object_key, size, round_even(size / 1048576.0, 2) AS size_mb FROM (
  SELECT {_FOLDER_SQL} AS folder, object_key, CAST(size AS BIGINT) AS size,
         row_number() OVER (PARTITION BY {_FOLDER_SQL} ORDER BY object_key) AS rn FROM object_listing)
WHERE rn <= 20"""))(
    lambda lake: LS.lake_inventory_files(fx.object_listing(lake).withColumn("size", F.col("size").cast("bigint"))))


# ------------------------------------------------------------------ F1

def _stream_merge(lake):
    """Updates landed one after the other (by line number, so that later ones correct earlier ones), each as the files of its
    tasks and one micro-batch."""
    from parcelgrid.session import shared_dir, written
    from parcelgrid.streaming.merge_stream import file_stream, stream_merge
    spark, li = lake.spark, lake.table("lineitem")
    landing, root, checkpoint = (shared_dir(spark, name) for name in ("sales-landing", "sales-table", "sales-stream"))
    base = written(_baseline(lake).drop("_seq", "record_status"), "sales-base")

    def prepare(batch):
        return FD.load_sales(fx.sales_update_rows(batch), feed_rank=1).drop("record_status")

    for k, lines in enumerate((F.col("l_linenumber") <= 2, F.col("l_linenumber").between(3, 4), F.col("l_linenumber") >= 5)):
        li.where(lines).write.parquet(f"{landing}/part={k}")
        # the stream goes on where it ended: all files of the update that has just landed are one micro-batch
        source = file_stream(spark, f"{landing}/*", li.schema, glob="part-*")
        table = stream_merge(source, base, lambda t, b: M.merge_keep_last(t, b, ["transaction_id"], "_seq"), root, checkpoint, prepare)
    return table.select(*_SALES_COLS)


register("stream_merge", _BPU_SQL)(_stream_merge)
