"""DuckDB oracle SQL: the fixture views of FIXTURES.md §2 as CTE text.

The oracle is an independent formulation of each job written in plain SQL
over the driver's raw tables; ``with_views`` prepends exactly the views a
query uses.  Latitude/longitude are cast to DOUBLE so both engines return
the same type.
"""

from __future__ import annotations

import re

VIEW_SQL: dict[str, str] = {
    "master_properties": """
SELECT CAST(p_partkey AS VARCHAR) AS uprn,
       CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE concat('T', CAST(p_partkey AS VARCHAR)) END AS title_number,
       concat(CAST(p_size AS VARCHAR), ' ', p_name, ', ', p_type) AS address_line_1,
       p_brand AS postcode,
       CAST(51.3 + (p_partkey % 400) / 1000.0 AS DOUBLE) AS latitude,
       CAST(-0.3 + (p_partkey % 300) / 1000.0 AS DOUBLE) AS longitude,
       concat('LA', CAST(p_partkey % 12 AS VARCHAR)) AS local_authority_code
FROM part""",
    "epc_assessments": """
SELECT concat('C', CAST(p_partkey AS VARCHAR)) AS certificate_id, CAST(p_partkey AS VARCHAR) AS uprn,
       p_size * 3 AS asset_rating,
       substr('ABCDEFG', CAST(floor(p_size / 8.0) AS INT) + 1, 1) AS asset_rating_band,
       CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_retailprice / 10 END AS floor_area, p_type AS property_type
FROM part""",
    "ownership_records": """
SELECT concat('T', CAST(l_partkey AS VARCHAR)) AS title_number, concat('S', CAST(l_suppkey AS VARCHAR)) AS company_number,
       concat('Owner ', CAST(l_suppkey AS VARCHAR)) AS proprietor_name,
       CAST(l_shipdate AS DATE) AS date_registered, l_extendedprice AS price_paid,
       l_orderkey * 8 + l_linenumber AS seq
FROM lineitem""",
    "corporate_registry": """
SELECT concat('S', CAST(s_suppkey AS VARCHAR)) AS company_number, s_name AS company_name,
       CASE WHEN n_regionkey = 0 THEN 'United Kingdom' WHEN n_regionkey = 1 THEN 'Unknown' ELSE n_name END AS incorporation_country,
       CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE 'active' END AS company_status
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "raw_ppd_staging": """
SELECT concat('X', CAST(o_orderkey AS VARCHAR)) AS transaction_id, CAST(round(o_totalprice) AS BIGINT) AS price_paid,
       CAST(o_orderdate AS DATE) AS transfer_date, p_brand AS postcode, substr(p_type, 1, 1) AS property_type,
       upper(concat(CAST(p_size AS VARCHAR), ' ', p_name, ' ', p_type, CASE WHEN o_orderkey % 5 = 0 THEN ' X' ELSE '' END)) AS full_address
FROM orders JOIN part ON p_partkey = o_orderkey % (SELECT count(*) FROM part)""",
    "postcode_index": """
SELECT p_brand AS postcode, CAST(min(51.3 + (p_partkey % 400) / 1000.0) AS DOUBLE) AS latitude,
       CAST(min(-0.3 + (p_partkey % 300) / 1000.0) AS DOUBLE) AS longitude,
       CAST(400000 + 1000 * min(p_size) AS INT) AS eastings, CAST(200000 + 1000 * max(p_size) AS INT) AS northings
FROM part GROUP BY p_brand""",
    "hygiene_payloads": """
SELECT event_id AS page, ts AS landed_at, concat('{"establishments":[{"FHRSID":', CAST(user_id AS VARCHAR),
       ',"BusinessName":"', event_type, '","PostCode":"Brand#', CAST(user_id % 25 + 1 AS VARCHAR),
       '","RatingValue":"', CAST(event_id % 6 AS VARCHAR), '","RatingDate":"', CAST(CAST(ts AS DATE) AS VARCHAR), 'T00:00:00"',
       CASE WHEN event_id % 4 = 0 THEN '' ELSE ',"geocode":{"latitude":"51.5","longitude":"-0.1"}' END, '}]}') AS payload
FROM events""",
    "transport_payloads": """
SELECT event_id AS seq, CASE WHEN event_id % 3 = 0 THEN 'tube' WHEN event_id % 3 = 1 THEN 'dlr' ELSE 'overground' END AS mode,
       concat('{"stopPoints":[{"id":"N', CAST(user_id AS VARCHAR), '","commonName":"Stop ', CAST(user_id AS VARCHAR),
       '","lat":51.5,"lon":-0.1,"lines":[', CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN '{"id":"a"}' ELSE '{"id":"a"},{"id":"b"}' END, ']}]}') AS payload
FROM events""",
    "planning_payloads": """
SELECT event_id AS seq, ts AS landed_at, concat('{"records":[{"uid":"PA/', CAST(event_id AS VARCHAR), '","status":"',
       CASE WHEN event_type = 'error' THEN 'Refused' ELSE 'Granted' END, '","date_decision":"', CAST(CAST(ts AS DATE) AS VARCHAR), '"}]}') AS payload
FROM events""",
    "company_payloads": """
SELECT concat('S', CAST(s_suppkey AS VARCHAR)) AS company_number,
       concat('{"items":[{"name":"A', CAST(s_suppkey AS VARCHAR), '"},{"name":"B","resigned_on":"2020-01-01"},{"name":"C"}]}') AS officers,
       concat('{"items":[{"name":"Owner ', CAST(s_suppkey AS VARCHAR), '"}]}') AS owners,
       CASE WHEN s_suppkey % 3 = 0 THEN '{}' WHEN s_suppkey % 3 = 1 THEN '{"items":[{"status":"fully-satisfied","created_on":"2019-05-01"}]}'
            ELSE '{"items":[{"status":"outstanding","created_on":"2021-02-03","persons_entitled":[{"name":"Bank"}]},{"status":"outstanding","created_on":"2022-02-03"}]}' END AS charges,
       CASE WHEN s_suppkey % 10 = 0 THEN NULL WHEN s_suppkey % 10 = 1 THEN '{"errors":[{"error":"company-profile-not-found"}]}'
            WHEN s_suppkey % 10 = 2 THEN '{"company_name":'
            WHEN s_suppkey % 10 = 3 THEN concat('{"company_name":"Company ', s_suppkey, '","company_number":"S', s_suppkey, '","registered_office_address":{"locality":"Paris"}}')
            ELSE concat('{"company_name":"Company ', s_suppkey, '","company_number":"S', s_suppkey, '","company_status":"',
                        CASE WHEN s_suppkey % 4 = 0 THEN 'dissolved' ELSE 'active' END, '","registered_office_address":{"address_line_1":"', s_suppkey,
                        ' Main Road","locality":"London","postal_code":"Brand#', s_suppkey % 25 + 1, '"},"accounts":{"last_accounts":{"made_up_to":"2024-03-31"}},"sic_codes":["68100","',
                        68200 + s_suppkey % 10, '"]}') END AS profile
FROM supplier""",
    "planning_requests": """
SELECT ts AS asked_at, CAST(event_id % (SELECT count(*) FROM part) AS VARCHAR) AS uprn FROM events
WHERE event_id % 7 = 0 AND CAST(event_id % (SELECT count(*) FROM part) AS VARCHAR) IN (
  SELECT CAST(p_partkey AS VARCHAR) FROM part WHERE substr('ABCDEFG', CAST(floor(p_size / 8.0) AS INT) + 1, 1) IN ('E', 'F', 'G'))""",
    "hygiene_requests": """
SELECT ts AS begun_at, CAST(100 + CAST(floor(event_id / 50) AS BIGINT) % 350 AS VARCHAR) AS authority FROM events WHERE event_id % 50 = 0""",
    "object_listing": """
SELECT page_id AS seq, concat('raw/', CASE page_id % 3 WHEN 0 THEN 'epc/' WHEN 1 THEN 'ppd/' ELSE '' END, CAST(page_id AS VARCHAR),
       CASE WHEN page_id % 2 = 0 THEN '_certificates.csv' ELSE '_recommendations_certificates.csv' END) AS object_key,
       length(html) AS size
FROM pages""",
    "lease_registry": """
SELECT concat('L', CAST(o_orderkey AS VARCHAR)) AS unique_lease_id, concat('T', CAST(o_orderkey % (SELECT count(*) FROM part) AS VARCHAR)) AS title_number,
       CAST(o_orderdate AS DATE) AS lease_date, CAST(o_custkey % 30 + 1 AS INT) AS lease_term_years
FROM orders""",
    "covenant_registry": """
SELECT DISTINCT concat('T', CAST(l_partkey AS VARCHAR)) AS title_number, TRUE AS has_covenant
FROM lineitem WHERE l_returnflag = 'R'""",
    "voa_ratings": """
SELECT CAST(p_partkey AS VARCHAR) AS billing_authority_ref, p_brand AS postcode,
       CAST(floor(p_retailprice) AS INT) AS rateable_value_2023,
       CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE CAST(floor(p_retailprice) AS INT) + p_size * 4 - 50 END AS rateable_value_2026
FROM part""",
    "connectivity_metrics": """
SELECT CAST(p_partkey AS VARCHAR) AS uprn, p_size * 10 AS max_download_speed, p_size AS max_upload_speed,
       p_partkey % 2 = 0 AS fiber_availability, p_partkey % 5 = 0 AS five_g_availability
FROM part""",
    "ownership_edges": """
SELECT concat('S', CAST(s_suppkey AS VARCHAR)) AS child, concat('S', CAST(CAST(floor(s_suppkey / 2.0) AS BIGINT) AS VARCHAR)) AS parent
FROM supplier WHERE s_suppkey > 0""",
}


def with_views(body: str, extra: dict[str, str] | None = None, recursive: bool = False) -> str:
    """Prefix ``body`` with the CTEs it references (views first, then
    ``extra`` CTEs in the given order, which may reference the views)."""
    extra = extra or {}
    text = body + " " + " ".join(extra.values())
    used = [v for v in VIEW_SQL if re.search(rf"\b{v}\b", text) and v not in extra]
    ctes = [f"{v} AS ({VIEW_SQL[v].strip()})" for v in used]
    ctes += [f"{k} AS ({s.strip()})" for k, s in extra.items()]
    if not ctes:
        return body.strip()
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(ctes) + "\n" + body.strip()


# Raw feeds (twins of parcelgrid.fixtures *_feed), usable as extra CTEs.
FEED_SQL: dict[str, str] = {
    "ownership_feed": """
SELECT CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE concat('T', CAST(l_partkey AS VARCHAR)) END AS "Title Number",
       concat('Unit ', CAST(l_linenumber AS VARCHAR), ', ', CAST(l_partkey AS VARCHAR), ' High Street') AS "Property Address",
       concat('Brand#', CAST(l_partkey % 25 + 1 AS VARCHAR)) AS "Postcode",
       CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) AS "Price Paid",
       CASE WHEN l_linenumber % 3 = 0 THEN lower(s_name) WHEN l_linenumber % 3 = 1 THEN s_name ELSE replace(s_name, '#', ' ') END AS "Proprietor Name (1)",
       CASE WHEN l_linenumber = 7 THEN NULL ELSE concat('S', CAST(l_suppkey AS VARCHAR)) END AS "Company Registration No. (1)",
       CASE WHEN l_returnflag = 'R' THEN 'Limited Company or Public Limited Company' ELSE 'Corporate Body' END AS "Proprietorship Category (1)",
       concat(CAST(l_suppkey AS VARCHAR), ' Main Road') AS "Proprietor (1) Address (1)",
       CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE 'London' END AS "Proprietor (1) Address (2)",
       CASE WHEN l_linenumber % 3 = 0 THEN 'UK' ELSE NULL END AS "Proprietor (1) Address (3)",
       CASE WHEN l_orderkey % 13 = 0 THEN 'unknown' ELSE strftime(l_shipdate, '%d-%m-%Y') END AS "Date Proprietor Added",
       struct_pack(o := l_orderkey, n := CAST(l_linenumber AS BIGINT), p := l_partkey, s := l_suppkey, d := l_shipdate, x := l_extendedprice) AS _seq
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "certificate_feed": """
SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(p_partkey AS VARCHAR) END AS uprn,
       concat(CAST(p_size AS VARCHAR), ' ', p_name, ', ', p_type) AS address, p_brand AS postcode,
       concat('LA', CAST(p_partkey % 12 AS VARCHAR)) AS local_authority, concat('C', CAST(o_orderkey AS VARCHAR)) AS lmk_key,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS inspection_date, CAST(p_size * 3 AS VARCHAR) AS asset_rating,
       substr('ABCDEFG', CAST(floor(p_size / 8.0) AS INT) + 1, 1) AS asset_rating_band,
       CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) AS floor_area, p_type AS property_type, o_orderkey AS _seq
FROM orders JOIN part ON p_partkey = o_orderkey % (SELECT count(*) FROM part)""",
    "sales_feed": """
SELECT concat('X', CAST(o_orderkey AS VARCHAR)) AS id, CAST(CAST(round(o_totalprice) AS BIGINT) AS VARCHAR) AS price,
       strftime(o_orderdate, '%Y-%m-%d %H:%M') AS date, p_brand AS postcode, substr(p_type, 1, 1) AS type,
       CAST(p_size AS VARCHAR) AS paon, CASE WHEN o_orderkey % 4 = 0 THEN 'FLAT 1' ELSE NULL END AS saon,
       p_name AS street, 'A' AS status, 0 AS rank,
       struct_pack(o := o_orderkey, n := CAST(0 AS BIGINT), p := CAST(0 AS BIGINT), s := CAST(0 AS BIGINT), d := o_orderdate, x := o_totalprice) AS _seq
FROM orders JOIN part ON p_partkey = o_orderkey % (SELECT count(*) FROM part)""",
    "sales_update_feed": """
SELECT concat('X', CAST(l_orderkey AS VARCHAR)) AS id, CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) AS price,
       strftime(l_shipdate, '%Y-%m-%d %H:%M') AS date, concat('Brand#', CAST(l_partkey % 25 + 1 AS VARCHAR)) AS postcode,
       'S' AS type, CAST(l_linenumber AS VARCHAR) AS paon, CAST(NULL AS VARCHAR) AS saon, 'UPDATED ROAD' AS street,
       CASE WHEN l_returnflag = 'R' THEN 'D' ELSE 'C' END AS status, 1 AS rank,
       struct_pack(o := l_orderkey, n := CAST(l_linenumber AS BIGINT), p := l_partkey, s := l_suppkey, d := l_shipdate, x := l_extendedprice) AS _seq
FROM lineitem""",
    "postcode_feed": """
SELECT CASE WHEN p_partkey % 997 = 0 THEN p_brand
            WHEN p_partkey % 991 = 0 OR (p_partkey % 100 = 99 AND (p_partkey // 100) % 7 IN (1, 2, 3)) THEN concat('PC', CAST(p_partkey + 1 AS VARCHAR))
            ELSE concat('PC', CAST(p_partkey AS VARCHAR)) END AS postcode,
       400000 + (p_partkey * 7) % 100000 AS eastings, 100000 + (p_partkey * 13) % 800000 AS northings,
       concat('D', CAST(p_partkey % 33 AS VARCHAR)) AS district_code,
       concat('codepoint-', lpad(CAST(CAST(floor(p_partkey / 100) AS BIGINT) AS VARCHAR), 5, '0'), '.csv') AS _file, p_partkey AS _seq
FROM part""",
}
