"""Landed JSON payloads -> conformed rows.

The reference fetches these over HTTP; here the responses are landed as
text (one payload per row, e.g. ``spark.read.text`` or a column of a
table) and parsed with explicit schemas (``from_json``), arrays exploded,
missing lists treated as empty.  Upserts use the keyed merge rules.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelgrid.functions.signals import footfall_score
from parcelgrid.operators.merge import dedup_last

# ------------------------------------------------------------ schemas
# Field names of the public payloads.

HYGIENE_SCHEMA = T.StructType([T.StructField("establishments", T.ArrayType(T.StructType([
    T.StructField("FHRSID", T.LongType()),
    T.StructField("BusinessName", T.StringType()),
    T.StructField("AddressLine1", T.StringType()),
    T.StructField("PostCode", T.StringType()),
    T.StructField("RatingValue", T.StringType()),
    T.StructField("RatingDate", T.StringType()),
    T.StructField("geocode", T.StructType([T.StructField("latitude", T.StringType()),
                                           T.StructField("longitude", T.StringType())])),
])))])

STOP_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("commonName", T.StringType()),
    T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType()),
    T.StructField("lines", T.ArrayType(T.StructType([T.StructField("id", T.StringType())]))),
])
TRANSPORT_SCHEMA = T.StructType([T.StructField("stopPoints", T.ArrayType(STOP_SCHEMA))])

PLANNING_SCHEMA = T.StructType([T.StructField("records", T.ArrayType(T.StructType([
    T.StructField(c, T.StringType()) for c in ("uid", "description", "status", "date_decision", "address", "url")
])))])

# officers are maps: whether a key is present matters, not only its value
OFFICERS_SCHEMA = T.StructType([T.StructField("items", T.ArrayType(T.MapType(T.StringType(), T.StringType())))])
OWNERS_SCHEMA = T.StructType([T.StructField("items", T.ArrayType(T.StructType([
    T.StructField("name", T.StringType()), T.StructField("kind", T.StringType())])))])
CHARGES_SCHEMA = T.StructType([T.StructField("items", T.ArrayType(T.StructType([
    T.StructField("status", T.StringType()), T.StructField("created_on", T.StringType()),
    T.StructField("persons_entitled", T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))),
    T.StructField("particulars", T.StructType([T.StructField("description", T.StringType())])),
])))])
SEARCH_SCHEMA = T.StructType([T.StructField("items", T.ArrayType(T.StructType([
    T.StructField(c, T.StringType()) for c in ("company_number", "title", "company_status", "address_snippet")
])))])

ADDRESS_SCHEMA = T.StructType([T.StructField("results", T.ArrayType(T.StructType([T.StructField("DPA", T.StructType([
    T.StructField("UPRN", T.StringType()), T.StructField("ADDRESS", T.StringType()),
    T.StructField("POSTCODE", T.StringType()), T.StructField("LAT", T.DoubleType()),
    T.StructField("LNG", T.DoubleType()), T.StructField("X_COORDINATE", T.DoubleType()),
    T.StructField("Y_COORDINATE", T.DoubleType())]))])))])

# Reference rules.
MODE_ORDER = ["tube", "dlr", "overground"]     # later mode wins on the same stop id
PERMISSION_DAYS = 1095                          # 365 * 3: consent lifetime
WINDOW_START_DAYS = 1095.0                      # granted 3 years ago ...
WINDOW_END_DAYS = 912.5                         # ... to 2.5 years ago
LAPSING_DAYS = 180                              # 0 < days left < 180 is lapsing


def _dec(c):
    return c.try_cast("decimal(10,6)").cast("double")


# ------------------------------------------------------------------ A5

def load_hygiene(payloads: DataFrame, page_col: str = "page", payload_col: str = "payload",
                 authority: str | None = None, page_cap: int | None = None, authority_col: str | None = None) -> DataFrame:
    """A5: hygiene pages -> fsa_ratings.  Per FHRSID the last entry wins, by authority,
    page and place on the page.  The authority is one for all pages, or a column
    of them.  ``page_cap`` reproduces the demo page limit when asked."""
    p = payloads
    if page_cap is not None:
        p = p.where(F.col(page_col) <= page_cap)
    area = (F.col(authority_col) if authority_col else F.lit(authority)).cast("string")
    e = p.select(F.col(page_col).alias("_page"), area.alias("_area"),
                 F.posexplode(F.from_json(F.col(payload_col), HYGIENE_SCHEMA)["establishments"]).alias("_at", "e"))
    rows = e.select(
        F.col("e.FHRSID").alias("fsa_id"), F.col("e.BusinessName").alias("business_name"),
        F.col("e.AddressLine1").alias("address_line_1"), F.col("e.PostCode").alias("postcode"),
        F.col("e.RatingValue").alias("rating_value"),
        F.try_to_date(F.split(F.col("e.RatingDate"), "T")[0]).alias("rating_date"),
        _dec(F.col("e.geocode.latitude")).alias("latitude"), _dec(F.col("e.geocode.longitude")).alias("longitude"),
        F.col("_area").alias("local_authority_code"), F.struct("_area", "_page", "_at").alias("_seq"))
    return dedup_last(rows.where(F.col("fsa_id").isNotNull()), ["fsa_id"], "_seq")


# ------------------------------------------------------------------ A6

def load_transport(payloads: DataFrame, mode_col: str = "mode", seq_col: str = "seq",
                   payload_col: str = "payload") -> DataFrame:
    """Stop points (enveloped or bare list) -> mobility_metrics; per stop
    id the later mode (tube, dlr, overground), then the later page, then the later place on it wins."""
    txt = F.col(payload_col)
    bare = F.from_json(txt, T.ArrayType(STOP_SCHEMA))
    env = F.from_json(txt, TRANSPORT_SCHEMA)["stopPoints"]
    stops = F.when(F.ltrim(txt).startswith("["), bare).otherwise(env)
    rank = F.array_position(F.array(*[F.lit(m) for m in MODE_ORDER]), F.lower(F.col(mode_col)))
    e = payloads.select(F.col(mode_col).alias("_mode"), rank.alias("_rank"), F.col(seq_col).alias("_s"),
                        F.posexplode(stops).alias("_at", "s"))
    rows = e.select(
        F.col("s.id").alias("location_id"), F.col("s.commonName").alias("name"),
        F.col("s.lat").alias("latitude"), F.col("s.lon").alias("longitude"),
        footfall_score(F.col("s.lines")).alias("annual_footfall"),
        F.concat(F.lit("TFL_"), F.upper("_mode")).alias("metric_type"),
        F.struct("_rank", "_s", "_at").alias("_seq"))
    return dedup_last(rows.where(F.col("location_id").isNotNull()), ["location_id"], "_seq")


# ------------------------------------------------------------------ A7 / E6

def snipe_window(as_of: dt.datetime) -> tuple[dt.date, dt.date]:
    """Decision dates searched: [as_of - 1095 d, as_of - 912.5 d] as dates."""
    return ((as_of - dt.timedelta(days=WINDOW_START_DAYS)).date(),
            (as_of - dt.timedelta(days=WINDOW_END_DAYS)).date())


def load_planning(payloads: DataFrame, as_of: dt.datetime, seq_col: str = "seq", payload_col: str = "payload",
                  uprn_col: str | None = None, window: bool = True) -> DataFrame:
    """A7 + E6: granted permissions; expiry = decision + 1095 d; days left =
    floor((expiry midnight - as_of) / 1 day); lapsing when 0 < days < 180.
    Per application the last record wins, by page and place on it.
    ``as_of`` is a parameter, never the clock."""
    cols = [F.col(seq_col).alias("_page"),
            F.posexplode(F.from_json(F.col(payload_col), PLANNING_SCHEMA)["records"]).alias("_at", "r")]
    if uprn_col:
        cols.insert(0, F.col(uprn_col).alias("uprn"))
    e = payloads.select(*cols)
    dec = F.try_to_date(F.col("r.date_decision"))
    g = e.where(F.col("r.status") == "Granted").withColumn("decision_date", dec)
    if window:
        lo, hi = snipe_window(as_of)
        g = g.where(F.col("decision_date").between(F.lit(lo), F.lit(hi)))
    expiry = F.date_add("decision_date", PERMISSION_DAYS)
    # floor((expiry midnight - as_of) / 1 day): one day less than the date
    # difference when as_of has a time of day (time-zone free)
    past_midnight = 1 if (as_of - dt.datetime.combine(as_of.date(), dt.time())).total_seconds() > 0 else 0
    days = (F.datediff(expiry, F.lit(as_of.date())) - F.lit(past_midnight)).cast("int")
    rows = g.select(
        F.col("r.uid").alias("application_id"),
        (F.col("uprn") if uprn_col else F.lit(None).cast("string")).alias("uprn"),
        F.col("r.address").alias("address"), F.col("r.description").alias("description"),
        F.col("r.status").alias("status"), "decision_date", expiry.alias("expiry_date"),
        days.alias("days_remaining"),
        ((days > 0) & (days < LAPSING_DAYS)).alias("is_lapsing_soon"),
        F.col("r.url").alias("url"), F.struct("_page", "_at").alias("_seq"))
    return dedup_last(rows.where(F.col("application_id").isNotNull()), ["application_id"], "_seq")


# ------------------------------------------------------------------ A8

def load_company_payloads(df: DataFrame, officers: str = "officers", owners: str = "owners",
                          charges: str = "charges") -> DataFrame:
    """Officers / owners / charges payloads -> arrays (missing -> [])."""
    def items(c, schema):
        return F.coalesce(F.from_json(F.col(c), schema)["items"], F.array().cast(schema["items"].dataType))
    return df.select("company_number",
                     items(officers, OFFICERS_SCHEMA).alias("officers"),
                     items(owners, OWNERS_SCHEMA).alias("owners"),
                     items(charges, CHARGES_SCHEMA).alias("charges"))


def load_company_profiles(df: DataFrame, payload_col: str = "profile") -> DataFrame:
    """Company profile payloads -> name, status, address, accounts date and trade codes.  Payloads differ in shape, so each is parsed once into
    a VARIANT and read by path; a payload that is missing, broken or without a company name (not found) gives no row."""
    v = df.select("company_number", F.try_parse_json(F.col(payload_col)).alias("v"))
    text = lambda path: F.try_variant_get("v", path, "string")
    address = F.array_compact(F.array(*[text(f"$.registered_office_address.{x}") for x in ("address_line_1", "locality", "postal_code")]))
    return v.select(
        "company_number", text("$.company_name").alias("company_name"), text("$.company_status").alias("company_status"),
        F.array_join(address, ", ").alias("address"), F.try_to_date(text("$.accounts.last_accounts.made_up_to")).alias("last_accounts_date"),
        F.array_join(F.coalesce(F.try_variant_get("v", "$.sic_codes", "array<string>"), F.array().cast("array<string>")), ",").alias("sic_codes"),
    ).where(F.col("company_name").isNotNull())


def load_search_hits(df: DataFrame, query_col: str = "query", payload_col: str = "payload") -> DataFrame:
    """Company search payloads -> the top hit per query (or no row)."""
    top = F.get(F.from_json(F.col(payload_col), SEARCH_SCHEMA)["items"], 0)
    return (df.select(F.col(query_col).alias("query"), top.alias("h")).where(F.col("h").isNotNull())
              .select("query", "h.company_number", "h.title",
                      F.coalesce("h.company_status", F.lit("active")).alias("company_status"),
                      F.coalesce("h.address_snippet", F.lit("")).alias("address_snippet")))


# ------------------------------------------------------------------ A9

def load_address_lookups(df: DataFrame, query_col: str = "query", payload_col: str = "payload") -> DataFrame:
    """First result's DPA block -> uprn, address, postcode, lat, lng, x, y;
    all NULL when there is no result."""
    dpa = F.get(F.from_json(F.col(payload_col), ADDRESS_SCHEMA)["results"], 0)["DPA"]
    return df.select(F.col(query_col).alias("query"), dpa["UPRN"].alias("uprn"), dpa["ADDRESS"].alias("address"),
                     dpa["POSTCODE"].alias("postcode"), dpa["LAT"].alias("lat"), dpa["LNG"].alias("lng"),
                     dpa["X_COORDINATE"].alias("x_coordinate"), dpa["Y_COORDINATE"].alias("y_coordinate"))
