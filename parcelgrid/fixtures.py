"""Domain tables derived from the driver's synthetic tables (FIXTURES.md §2).

Each function takes a ``Lake`` over one scale-factor folder and returns a
DataFrame with the conformed schema of one domain table or one raw feed.
Everything is a projection / join / aggregate of the given tables, so the
work of every job grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelgrid.plans.distress import planning_targets
from parcelgrid.session import shared_dir
from parcelgrid.sources.tables import Lake


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _part_count(lake: Lake) -> Column:
    # scalar subquery: the part count is computed inside the plan, not on the driver
    return lake.table("part").select(F.count(F.lit(1))).scalar()


def master_properties(lake: Lake) -> DataFrame:
    k = F.col("p_partkey")
    return lake.table("part").select(
        _s(k).alias("uprn"),
        F.when(k % 3 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("T"), _s(k))).alias("title_number"),
        F.concat(_s("p_size"), F.lit(" "), "p_name", F.lit(", "), "p_type").alias("address_line_1"),
        F.col("p_brand").alias("postcode"),
        ((F.lit(51300) + k % 400) / 1000).alias("latitude"),
        ((F.lit(-300) + k % 300) / 1000).alias("longitude"),
        F.concat(F.lit("LA"), _s(k % 12)).alias("local_authority_code"),
    )


def epc_assessments(lake: Lake) -> DataFrame:
    k = F.col("p_partkey")
    band_pos = (F.floor(F.col("p_size") / 8) + 1).cast("int")
    return lake.table("part").select(
        F.concat(F.lit("C"), _s(k)).alias("certificate_id"),
        _s(k).alias("uprn"),
        (F.col("p_size") * 3).alias("asset_rating"),
        F.substr(F.lit("ABCDEFG"), band_pos, F.lit(1)).alias("asset_rating_band"),
        F.when(k % 11 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("p_retailprice") / 10).alias("floor_area"),
        F.col("p_type").alias("property_type"),
    )


def ownership_records(lake: Lake) -> DataFrame:
    li = lake.table("lineitem")
    return li.select(
        F.concat(F.lit("T"), _s("l_partkey")).alias("title_number"),
        F.concat(F.lit("S"), _s("l_suppkey")).alias("company_number"),
        F.concat(F.lit("Owner "), _s("l_suppkey")).alias("proprietor_name"),
        F.to_date("l_shipdate").alias("date_registered"),
        F.col("l_extendedprice").alias("price_paid"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"),
    )


def corporate_registry(lake: Lake) -> DataFrame:
    s, n = lake.table("supplier"), lake.table("nation")
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.concat(F.lit("S"), _s("s_suppkey")).alias("company_number"),
        F.col("s_name").alias("company_name"),
        F.when(F.col("n_regionkey") == 0, "United Kingdom")
         .when(F.col("n_regionkey") == 1, "Unknown")
         .otherwise(F.col("n_name")).alias("incorporation_country"),
        F.when(F.col("s_suppkey") % 4 == 0, F.lit(None).cast("string"))
         .otherwise(F.lit("active")).alias("company_status"),
    )


def raw_ppd_staging(lake: Lake) -> DataFrame:
    o, p = lake.table("orders"), lake.table("part")
    return o.join(p, p.p_partkey == o.o_orderkey % _part_count(lake)).select(
        F.concat(F.lit("X"), _s("o_orderkey")).alias("transaction_id"),
        F.round("o_totalprice").cast("bigint").alias("price_paid"),
        F.to_date("o_orderdate").alias("transfer_date"),
        F.col("p_brand").alias("postcode"),
        F.substring("p_type", 1, 1).alias("property_type"),
        F.upper(F.concat(_s("p_size"), F.lit(" "), "p_name", F.lit(" "), "p_type",
                         F.when(F.col("o_orderkey") % 5 == 0, F.lit(" X")).otherwise(F.lit("")))
                ).alias("full_address"),
    )


def postcode_index(lake: Lake) -> DataFrame:
    k = F.col("p_partkey")
    return lake.table("part").groupBy(F.col("p_brand").alias("postcode")).agg(
        F.min((F.lit(51300) + k % 400) / 1000).alias("latitude"),
        F.min((F.lit(-300) + k % 300) / 1000).alias("longitude"),
        (F.lit(400000) + F.lit(1000) * F.min("p_size")).cast("int").alias("eastings"),
        (F.lit(200000) + F.lit(1000) * F.max("p_size")).cast("int").alias("northings"),
    )


def hygiene_payloads(lake: Lake) -> DataFrame:
    """One JSON page per event: ``{"establishments":[{...}]}``; geocode is
    missing on every fourth page."""
    e = lake.table("events")
    est = F.struct(
        F.col("user_id").alias("FHRSID"),
        F.col("event_type").alias("BusinessName"),
        F.concat(F.lit("Brand#"), _s(F.col("user_id") % 25 + 1)).alias("PostCode"),
        _s(F.col("event_id") % 6).alias("RatingValue"),
        F.concat(_s(F.to_date("ts")), F.lit("T00:00:00")).alias("RatingDate"),
        F.when(F.col("event_id") % 4 != 0,
               F.struct(F.lit("51.5").alias("latitude"), F.lit("-0.1").alias("longitude"))).alias("geocode"),
    )
    return e.select(F.col("event_id").alias("page"), F.col("ts").alias("landed_at"),
                    F.to_json(F.struct(F.array(est).alias("establishments"))).alias("payload"))


def transport_payloads(lake: Lake) -> DataFrame:
    e = lake.table("events")
    r = F.col("event_id") % 3
    line_a = F.struct(F.lit("a").alias("id"))
    line_b = F.struct(F.lit("b").alias("id"))
    lines = (F.when(r == 0, F.array().cast("array<struct<id:string>>"))
              .when(r == 1, F.array(line_a)).otherwise(F.array(line_a, line_b)))
    stop = F.struct(
        F.concat(F.lit("N"), _s("user_id")).alias("id"),
        F.concat(F.lit("Stop "), _s("user_id")).alias("commonName"),
        F.lit(51.5).alias("lat"), F.lit(-0.1).alias("lon"), lines.alias("lines"))
    return e.select(
        F.col("event_id").alias("seq"),
        F.when(r == 0, "tube").when(r == 1, "dlr").otherwise("overground").alias("mode"),
        F.to_json(F.struct(F.array(stop).alias("stopPoints"))).alias("payload"))


def planning_payloads(lake: Lake) -> DataFrame:
    e = lake.table("events")
    rec = F.struct(
        F.concat(F.lit("PA/"), _s("event_id")).alias("uid"),
        F.when(F.col("event_type") == "error", "Refused").otherwise("Granted").alias("status"),
        _s(F.to_date("ts")).alias("date_decision"))
    return e.select(F.col("event_id").alias("seq"), F.col("ts").alias("landed_at"),
                    F.to_json(F.struct(F.array(rec).alias("records"))).alias("payload"))


def company_payloads(lake: Lake) -> DataFrame:
    s = lake.table("supplier")
    k = F.col("s_suppkey")
    officers = F.array(
        F.struct(F.concat(F.lit("A"), _s(k)).alias("name"), F.lit(None).cast("string").alias("resigned_on")),
        F.struct(F.lit("B").alias("name"), F.lit("2020-01-01").alias("resigned_on")),
        F.struct(F.lit("C").alias("name"), F.lit(None).cast("string").alias("resigned_on")))
    owners = F.array(F.struct(F.concat(F.lit("Owner "), _s(k)).alias("name")))
    charge_t = "array<struct<status:string,created_on:string,persons_entitled:array<struct<name:string>>>>"
    satisfied = F.array(F.struct(F.lit("fully-satisfied").alias("status"), F.lit("2019-05-01").alias("created_on"),
                                 F.lit(None).cast("array<struct<name:string>>").alias("persons_entitled")))
    outstanding = F.array(
        F.struct(F.lit("outstanding").alias("status"), F.lit("2021-02-03").alias("created_on"),
                 F.array(F.struct(F.lit("Bank").alias("name"))).alias("persons_entitled")),
        F.struct(F.lit("outstanding").alias("status"), F.lit("2022-02-03").alias("created_on"),
                 F.lit(None).cast("array<struct<name:string>>").alias("persons_entitled")))
    charges = (F.when(k % 3 == 0, F.lit("{}"))
                .when(k % 3 == 1, F.to_json(F.struct(satisfied.cast(charge_t).alias("items"))))
                .otherwise(F.to_json(F.struct(outstanding.cast(charge_t).alias("items")))))
    return s.select(
        F.concat(F.lit("S"), _s(k)).alias("company_number"),
        F.to_json(F.struct(officers.alias("items"))).alias("officers"),
        F.to_json(F.struct(owners.alias("items"))).alias("owners"),
        charges.alias("charges"), _profile(k).alias("profile"))


def _profile(k: Column) -> Column:
    """Profile payload: none (not found) for some companies, an error or broken text for others, else of two shapes."""
    name, number = F.concat(F.lit("Company "), _s(k)), F.concat(F.lit("S"), _s(k))
    full = F.struct(
        name.alias("company_name"), number.alias("company_number"), F.when(k % 4 == 0, "dissolved").otherwise("active").alias("company_status"),
        F.struct(F.concat(_s(k), F.lit(" Main Road")).alias("address_line_1"), F.lit("London").alias("locality"),
                 F.concat(F.lit("Brand#"), _s(k % 25 + 1)).alias("postal_code")).alias("registered_office_address"),
        F.struct(F.struct(F.lit("2024-03-31").alias("made_up_to")).alias("last_accounts")).alias("accounts"),
        F.array(F.lit("68100"), _s(F.lit(68200) + k % 10)).alias("sic_codes"))
    short = F.struct(name.alias("company_name"), number.alias("company_number"), F.struct(F.lit("Paris").alias("locality")).alias("registered_office_address"))
    return (F.when(k % 10 == 0, F.lit(None).cast("string")).when(k % 10 == 1, F.lit('{"errors":[{"error":"company-profile-not-found"}]}'))
             .when(k % 10 == 2, F.lit('{"company_name":')).when(k % 10 == 3, F.to_json(short)).otherwise(F.to_json(full)))


def object_listing(lake: Lake) -> DataFrame:
    pg = lake.table("pages")
    k = F.col("page_id")
    folder = F.when(k % 3 == 0, "epc/").when(k % 3 == 1, "ppd/").otherwise("")
    suffix = F.when(k % 2 == 0, "_certificates.csv").otherwise("_recommendations_certificates.csv")
    return pg.select(k.alias("seq"),
                     F.concat(F.lit("raw/"), folder, _s(k), suffix).alias("object_key"),
                     F.length("html").alias("size"))


def lease_registry(lake: Lake) -> DataFrame:
    o = lake.table("orders")
    return o.select(
        F.concat(F.lit("L"), _s("o_orderkey")).alias("unique_lease_id"),
        F.concat(F.lit("T"), _s(F.col("o_orderkey") % _part_count(lake))).alias("title_number"),
        F.to_date("o_orderdate").alias("lease_date"),
        (F.col("o_custkey") % 30 + 1).cast("int").alias("lease_term_years"))


def covenant_registry(lake: Lake) -> DataFrame:
    li = lake.table("lineitem")
    return (li.where(F.col("l_returnflag") == "R")
              .select(F.concat(F.lit("T"), _s("l_partkey")).alias("title_number"),
                      F.lit(True).alias("has_covenant"))
              .distinct())


def voa_ratings(lake: Lake) -> DataFrame:
    p = lake.table("part")
    rv23 = F.floor("p_retailprice").cast("int")
    return p.select(
        _s("p_partkey").alias("billing_authority_ref"),
        F.col("p_brand").alias("postcode"),
        rv23.alias("rateable_value_2023"),
        F.when(F.col("p_partkey") % 7 == 0, F.lit(None).cast("int"))
         .otherwise(rv23 + F.col("p_size") * 4 - 50).alias("rateable_value_2026"))


def connectivity_metrics(lake: Lake) -> DataFrame:
    p = lake.table("part")
    k = F.col("p_partkey")
    return p.select(_s(k).alias("uprn"), (F.col("p_size") * 10).alias("max_download_speed"),
                    F.col("p_size").alias("max_upload_speed"),
                    (k % 2 == 0).alias("fiber_availability"), (k % 5 == 0).alias("five_g_availability"))


def ownership_edges(lake: Lake) -> DataFrame:
    s = lake.table("supplier")
    return s.where(F.col("s_suppkey") > 0).select(
        F.concat(F.lit("S"), _s("s_suppkey")).alias("child"),
        F.concat(F.lit("S"), _s(F.floor(F.col("s_suppkey") / 2).cast("bigint"))).alias("parent"))


# ---------------------------------------------------------------- raw feeds
# Feeds shaped like the files the loaders read (all-string columns, feed
# headers, a file-order key ``_seq`` and a file name ``_file``).  The SQL
# twins live in ``parcelgrid.oracle.FEED_SQL``.

def _fmt_date(ts: str, pattern: str) -> Column:
    """Format the date part of a timestamp_ntz without a time-zone round trip."""
    return F.date_format(F.to_date(ts), pattern)


def _fmt_minute(ts: str) -> Column:
    """'yyyy-MM-dd HH:mm' of a timestamp_ntz, time-zone free."""
    return F.concat(_fmt_date(ts, "yyyy-MM-dd"), F.lit(" "), F.lpad(_s(F.hour(ts)), 2, "0"), F.lit(":"),
                    F.lpad(_s(F.minute(ts)), 2, "0"))


def _band(size_col: str) -> Column:
    return F.substr(F.lit("ABCDEFG"), (F.floor(F.col(size_col) / 8) + 1).cast("int"), F.lit(1))


def ownership_feed(lake: Lake) -> DataFrame:
    li, s = lake.table("lineitem"), lake.table("supplier")
    ln, ok = F.col("l_linenumber"), F.col("l_orderkey")
    name = (F.when(ln % 3 == 0, F.lower("s_name")).when(ln % 3 == 1, F.col("s_name"))
             .otherwise(F.replace(F.col("s_name"), F.lit("#"), F.lit(" "))))
    null = F.lit(None).cast("string")
    return li.join(s, li.l_suppkey == s.s_suppkey).select(
        F.when(ok % 50 == 0, null).otherwise(F.concat(F.lit("T"), _s("l_partkey"))).alias("Title Number"),
        F.concat(F.lit("Unit "), _s(ln), F.lit(", "), _s("l_partkey"), F.lit(" High Street")).alias("Property Address"),
        F.concat(F.lit("Brand#"), _s(F.col("l_partkey") % 25 + 1)).alias("Postcode"),
        _s(F.floor("l_extendedprice")).alias("Price Paid"),
        name.alias("Proprietor Name (1)"),
        F.when(ln == 7, null).otherwise(F.concat(F.lit("S"), _s("l_suppkey"))).alias("Company Registration No. (1)"),
        F.when(F.col("l_returnflag") == "R", "Limited Company or Public Limited Company")
         .otherwise("Corporate Body").alias("Proprietorship Category (1)"),
        F.concat(_s("l_suppkey"), F.lit(" Main Road")).alias("Proprietor (1) Address (1)"),
        F.when(ln % 2 == 0, null).otherwise(F.lit("London")).alias("Proprietor (1) Address (2)"),
        F.when(ln % 3 == 0, F.lit("UK")).otherwise(null).alias("Proprietor (1) Address (3)"),
        F.when(ok % 13 == 0, F.lit("unknown"))
         .otherwise(_fmt_date("l_shipdate", "dd-MM-yyyy")).alias("Date Proprietor Added"),
        _li_seq().alias("_seq"))


def _li_seq() -> Column:
    """Line-item order: (orderkey, linenumber, partkey, suppkey, shipdate,
    price); rows equal on all of these carry equal feed values."""
    return F.struct(F.col("l_orderkey").alias("o"), F.col("l_linenumber").cast("bigint").alias("n"),
                    F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"),
                    F.col("l_shipdate").alias("d"), F.col("l_extendedprice").alias("x"))


def certificate_feed(lake: Lake) -> DataFrame:
    o, p = lake.table("orders"), lake.table("part")
    k = F.col("o_orderkey")
    return o.join(p, p.p_partkey == k % _part_count(lake)).select(
        F.when(k % 97 == 0, F.lit(None).cast("string")).otherwise(_s("p_partkey")).alias("UPRN"),
        F.concat(_s("p_size"), F.lit(" "), "p_name", F.lit(", "), "p_type").alias("ADDRESS"),
        F.col("p_brand").alias("POSTCODE"),
        F.concat(F.lit("LA"), _s(F.col("p_partkey") % 12)).alias("LOCAL_AUTHORITY"),
        F.concat(F.lit("C"), _s(k)).alias("LMK_KEY"),
        _s(F.to_date("o_orderdate")).alias("INSPECTION_DATE"),
        _s(F.col("p_size") * 3).alias("ASSET_RATING"),
        _band("p_size").alias("ASSET_RATING_BAND"),
        _s(F.floor("p_retailprice")).alias("FLOOR_AREA"),
        F.col("p_type").alias("PROPERTY_TYPE"),
        k.alias("_seq"))


def sales_feed(lake: Lake) -> DataFrame:
    """Headerless 16-column sales file (baseline), columns _c0.._c15."""
    o, p = lake.table("orders"), lake.table("part")
    k = F.col("o_orderkey")
    null = F.lit(None).cast("string")
    cols = [F.concat(F.lit("X"), _s(k)), _s(F.round("o_totalprice").cast("bigint")),
            _fmt_minute("o_orderdate"), F.col("p_brand"), F.substring("p_type", 1, 1),
            F.lit("N"), F.lit("F"), _s("p_size"), F.when(k % 4 == 0, F.lit("FLAT 1")).otherwise(null),
            F.col("p_name"), null, F.lit("LONDON"), F.lit("CITY"), F.lit("GREATER LONDON"), F.lit("A"), F.lit("A")]
    zero = F.lit(0).cast("bigint")
    seq = F.struct(k.alias("o"), zero.alias("n"), zero.alias("p"), zero.alias("s"),
                   F.col("o_orderdate").alias("d"), F.col("o_totalprice").alias("x"))
    return o.join(p, p.p_partkey == k % _part_count(lake)).select(
        *[c.alias(f"_c{i}") for i, c in enumerate(cols)], seq.alias("_seq"))


def sales_update_feed(lake: Lake) -> DataFrame:
    """Monthly update file: one row per line item, correcting its order's sale."""
    return sales_update_rows(lake.table("lineitem"))


def sales_update_rows(li: DataFrame) -> DataFrame:
    """The update-file rows for a frame of line items (batch or stream)."""
    k, ln = F.col("l_orderkey"), F.col("l_linenumber")
    null = F.lit(None).cast("string")
    cols = [F.concat(F.lit("X"), _s(k)), _s(F.floor("l_extendedprice").cast("bigint")),
            _fmt_minute("l_shipdate"),
            F.concat(F.lit("Brand#"), _s(F.col("l_partkey") % 25 + 1)), F.lit("S"), F.lit("N"), F.lit("F"),
            _s(ln), null, F.lit("UPDATED ROAD"), null, F.lit("LONDON"), F.lit("CITY"), F.lit("GREATER LONDON"),
            F.lit("A"), F.when(F.col("l_returnflag") == "R", F.lit("D")).otherwise(F.lit("C"))]
    return li.select(*[c.alias(f"_c{i}") for i, c in enumerate(cols)], _li_seq().alias("_seq"))


def postcode_feed(lake: Lake) -> DataFrame:
    """Headerless postcode files (10 columns), one file name per row group.  Of seven files in a row the second to fourth
    end with the first postcode of the next one: a chain in which a file that is turned away no longer bars the next."""
    p = lake.table("part")
    k = F.col("p_partkey")
    next_first = (k % 100 == 99) & F.floor(k / 100 % 7).isin(1, 2, 3)
    pc = (F.when(k % 997 == 0, F.col("p_brand")).when((k % 991 == 0) | next_first, F.concat(F.lit("PC"), _s(k + 1)))
           .otherwise(F.concat(F.lit("PC"), _s(k))))
    cols = [pc, F.lit("10"), _s(F.lit(400000) + (k * 7) % 100000), _s(F.lit(100000) + (k * 13) % 800000),
            F.lit("E92000001"), F.lit("X"), F.lit("Y"), F.lit("Z"), F.concat(F.lit("D"), _s(k % 33)), F.lit("W")]
    unit = F.concat(F.lit("codepoint-"), F.lpad(_s(F.floor(k / 100)), 5, "0"), F.lit(".csv"))
    return p.select(*[c.alias(f"_c{i}") for i, c in enumerate(cols)], unit.alias("_file"), k.alias("_seq"))


def rates_feed(lake: Lake, year: int) -> DataFrame:
    p = lake.table("part")
    k = F.col("p_partkey")
    rv = F.floor("p_retailprice").cast("int")
    if year == 2026:
        p = p.where(k % 7 != 0)
        rv = rv + F.col("p_size") * 4 - 50
    return p.select(_s(k).alias("BA Reference"), F.concat(_s("p_size"), F.lit(" "), "p_name").alias("Address"),
                    F.col("p_brand").alias("Postcode"), F.col("p_type").alias("Description"),
                    _s(rv).alias("Rateable Value"),
                    F.lit(f"{year}-04-01").alias("Effective Date"), k.alias("_seq"))


def lease_feed(lake: Lake) -> DataFrame:
    o = lake.table("orders")
    k = F.col("o_orderkey")
    null = F.lit(None).cast("string")
    return o.select(
        F.concat(F.lit("L"), _s(k)).alias("Unique Identifier"),
        F.concat(F.lit("T"), _s(k % _part_count(lake))).alias("Title Number"),
        F.when(k % 17 == 0, null).otherwise(_fmt_date("o_orderdate", "dd-MM-yyyy")).alias("Date of Lease"),
        F.when(k % 19 == 0, F.lit("unknown")).otherwise(_s(F.col("o_custkey") % 30 + 1)).alias("Term"),
        F.concat(F.lit("Tenant "), _s("o_custkey")).alias("Lessee Name"), k.alias("_seq"))


def covenant_feed(lake: Lake) -> DataFrame:
    li = lake.table("lineitem")
    return li.where(F.col("l_returnflag") == "R").select(
        F.concat(F.lit("T"), _s("l_partkey")).alias("Title Number"), _s("l_orderkey").alias("Deed Reference"))


def connectivity_feed(lake: Lake) -> DataFrame:
    p = lake.table("part")
    k = F.col("p_partkey")
    return p.select(_s(k).alias("UPRN"), _s(F.col("p_size") * 10).alias("Max_Down"), _s("p_size").alias("Max_Up"),
                    F.when(k % 2 == 0, "Y").otherwise("N").alias("FTTP_Availability"),
                    F.when(k % 5 == 0, "Yes").otherwise("No").alias("5G_Outdoor"), k.alias("_seq"))


def address_payloads(lake: Lake) -> DataFrame:
    """Address-lookup responses: one per property, empty on every tenth."""
    p = master_properties(lake)
    k = F.col("uprn").cast("bigint")
    dpa = F.struct(F.col("uprn").alias("UPRN"), F.upper("address_line_1").alias("ADDRESS"),
                   F.col("postcode").alias("POSTCODE"), F.col("latitude").alias("LAT"),
                   F.col("longitude").alias("LNG"), (F.lit(500000) + k).cast("double").alias("X_COORDINATE"),
                   (F.lit(180000) + k).cast("double").alias("Y_COORDINATE"))
    results = F.when(k % 10 == 0, F.array().cast("array<struct<DPA:" + "struct<UPRN:string,ADDRESS:string,"
                                                 "POSTCODE:string,LAT:double,LNG:double,X_COORDINATE:double,"
                                                 "Y_COORDINATE:double>>>")).otherwise(F.array(F.struct(dpa.alias("DPA"))))
    return p.select(F.concat(F.lit("Q"), F.col("uprn")).alias("query"),
                    F.to_json(F.struct(results.alias("results"))).alias("payload"))


def company_index(lake: Lake) -> DataFrame:
    """Landed company-search results: official number, title, status."""
    s = lake.table("supplier")
    k = F.col("s_suppkey")
    return s.select(F.concat(F.lit("CH"), F.lpad(_s(k), 8, "0")).alias("company_number"),
                    F.upper("s_name").alias("title"),
                    F.when(k % 5 == 0, F.lit(None).cast("string")).when(k % 5 == 1, F.lit("dissolved"))
                     .otherwise(F.lit("active")).alias("company_status"))


def search_payloads(lake: Lake) -> DataFrame:
    """Company-search responses: one per ownership-feed owner name; the top
    hit is the supplier with that key, no hit for every seventh supplier."""
    s = lake.table("supplier")
    k = F.col("s_suppkey")
    item = F.struct(F.concat(F.lit("CH"), F.lpad(_s(k), 8, "0")).alias("company_number"),
                    F.upper("s_name").alias("title"),
                    F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(F.lit("active")).alias("company_status"),
                    F.when(k % 2 == 0, F.concat(_s(k), F.lit(" Main Road"))).alias("address_snippet"))
    items = F.when(k % 7 == 0, F.array().cast("array<struct<company_number:string,title:string,"
                                               "company_status:string,address_snippet:string>>")).otherwise(F.array(item))
    return s.select(F.col("s_name").alias("query"), F.to_json(F.struct(items.alias("items"))).alias("payload"))


#: files of the certificate folder; some of them are broken, see certificate_files
CERTIFICATE_FILES = 16


def certificate_files(lake: Lake) -> str:
    """The certificate feed as a folder of CSV files (one per remainder of the order key), written to the shared folder.  Broken
    are: 3 (a column has another name), 7 (an extra field in some lines), 11 (an open quote in some lines), 13 (a byte that is no UTF-8);
    file 5 has lower-case columns in reverse order, which is fine."""
    feed = certificate_feed(lake)
    names = [c for c in feed.columns if c != "_seq"]
    file, some = F.col("_seq") % CERTIFICATE_FILES, F.floor(F.col("_seq") / CERTIFICATE_FILES) % 10 == 0
    text = lambda c: F.concat(F.lit('"'), F.coalesce(F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit("")), F.lit('"'))
    value = {c: text(c) if c == "ADDRESS" else F.coalesce(F.col(c), F.lit("")) for c in names}
    value["ADDRESS"] = (F.when((file == 11) & some, F.concat(F.lit('"'), F.coalesce("ADDRESS", F.lit(""))))
                        .when((file == 13) & some, F.concat(F.lit("caf"), F.unhex(F.lit("E9")).cast("string"))).otherwise(value["ADDRESS"]))
    line = F.when(file == 5, F.concat_ws(",", *[value[c] for c in reversed(names)])).otherwise(F.concat_ws(",", *[value[c] for c in names]))
    line = F.when((file == 7) & some, F.concat(line, F.lit(",surplus"))).otherwise(line)
    rows = feed.select(file.alias("file"), F.col("_seq").alias("at"), line.alias("line"))
    head = (F.when(F.col("file") == 3, ",".join(["REFERENCE" if c == "LMK_KEY" else c for c in names]))
             .when(F.col("file") == 5, ",".join(c.lower() for c in reversed(names))).otherwise(",".join(names)))
    heads = rows.select("file").distinct().select("file", F.lit(-1).cast("long").alias("at"), head.alias("line"))
    path = shared_dir(lake.spark, "certificate-files")
    # one file a folder: all of its lines are in one task, the header first
    (rows.unionByName(heads).repartition(CERTIFICATE_FILES, "file").sortWithinPartitions("file", "at").select("file", "line")
     .write.partitionBy("file").text(path))
    return path


def planning_requests(lake: Lake) -> DataFrame:
    """Log of planning searches: at some events a target property was asked for; the payloads that land until the next one are its answers."""
    e, n = lake.table("events").where(F.col("event_id") % 7 == 0), _part_count(lake)
    asked = e.select(F.col("ts").alias("asked_at"), _s(F.col("event_id") % n).alias("uprn"))
    targets = planning_targets(master_properties(lake), epc_assessments(lake)).select("uprn").distinct()
    return asked.join(targets, "uprn", "left_semi").select("asked_at", "uprn")


def hygiene_requests(lake: Lake) -> DataFrame:
    """Log of hygiene downloads: when the pages of an authority were begun."""
    e = lake.table("events").where(F.col("event_id") % 50 == 0)
    return e.select(F.col("ts").alias("begun_at"), _s(F.lit(100) + F.floor(F.col("event_id") / 50) % 350).alias("authority"))
