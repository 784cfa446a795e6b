"""Distressed-asset queries over the conformed tables.

Plans are ordinary DataFrame joins; two habits keep them cheap at scale:

* Top-k reports whose sort keys live on the driving side are cut to k rows
  *before* the owner joins (left joins only add rows, so the first k output
  rows come from the first k driving rows).  The k-row side is then the
  broadcast side of a semi-join that filters the big owner tables without a
  shuffle.
* A k-row frame used twice (semi-join keys and join input) is materialised
  once as a local relation (at most k rows, checked), so the scan and joins
  under it run once instead of once per use.
* Every first/limit has a unique tie-break so results are repeatable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelgrid.session import materialize_bounded

DISTRESS_BANDS = ("F", "G")
PLANNING_BANDS = ("E", "F", "G")


def _filter_to(big: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows of ``big`` whose ``on`` occurs in ``keys`` (a k-row frame)."""
    return big.join(F.broadcast(keys.select(on).where(F.col(on).isNotNull()).distinct()), on, "left_semi")


def distressed_certificates(epc: DataFrame, props: DataFrame, bands=DISTRESS_BANDS) -> DataFrame:
    """EPC (band filter pushed to the scan) inner-joined to its property."""
    e = epc.where(F.col("asset_rating_band").isin(*bands))
    return e.join(props.drop("latitude", "longitude"), "uprn")


def distress_scan(epc, props, owners, companies, limit: int = 50) -> DataFrame:
    """D3: F/G assets with owner company, biggest first; top ``limit``."""
    order1 = [F.col("asset_rating_band").desc(), F.col("floor_area").desc_nulls_last(),
              F.col("uprn").asc(), F.col("certificate_id").asc()]
    top = materialize_bounded(distressed_certificates(epc, props).orderBy(*order1).limit(limit), limit)
    own = _filter_to(owners.select("title_number", "company_number"), top, "title_number")
    j = top.join(own, "title_number", "left")
    order2 = order1 + [F.col("company_number").asc_nulls_last()]
    top2 = materialize_bounded(j.orderBy(*order2).limit(limit), limit)
    reg = _filter_to(companies.select("company_number", "company_name", "company_status"),
                     top2, "company_number")
    out = (top2.join(reg.withColumnRenamed("company_number", "c_number"),
                     top2.company_number == F.col("c_number"), "left")
               .orderBy(*order2).limit(limit))
    return out.select(
        "uprn", F.col("address_line_1").alias("address"), "asset_rating_band", "floor_area",
        "property_type", F.col("local_authority_code").alias("local_authority"),
        "company_name", F.col("c_number").alias("company_number"), "company_status")


def distress_report(epc, props, owners, companies, limit: int = 50) -> DataFrame:
    """F/G assets with owner and company, newest registration first.
    The sort key comes from the ownership side, so the owner join runs
    before the cut; the company lookup runs after it on <= limit rows."""
    order = [F.col("asset_rating_band").desc(), F.col("date_registered").desc_nulls_last(),
             F.col("uprn").asc(), F.col("certificate_id").asc(),
             F.col("company_number").asc_nulls_last()]
    base = distressed_certificates(epc, props)
    own = owners.where(F.col("title_number").isNotNull()).select(
        "title_number", "company_number", "proprietor_name", "date_registered")
    # a null title matches nothing; a key of its own per property keeps all of them from one task
    owned = base.withColumnRenamed("title_number", "_title").join(
        own, own.title_number == F.coalesce("_title", F.concat(F.lit("\u0000"), "uprn")), "left")
    top = materialize_bounded(owned.orderBy(*order).limit(limit), limit)
    reg = _filter_to(companies.select("company_number", "company_name", "incorporation_country"),
                     top, "company_number")
    out = top.join(reg, "company_number", "left").orderBy(*order).limit(limit)

    def blank_to(c, default):
        return F.when(F.col(c).isNull() | (F.col(c) == ""), F.lit(default)).otherwise(F.col(c))

    return out.select(
        "asset_rating_band", "property_type", F.col("address_line_1").alias("property_address"), "uprn",
        blank_to("proprietor_name", "Unknown Owner (Individual?)").alias("proprietor_name"),
        "date_registered",
        blank_to("company_name", "N/A").alias("company_name"),
        blank_to("incorporation_country", "").alias("incorporation_country"))


def distress_fallback(epc, props, limit: int = 20) -> DataFrame:
    """Plain F/G certificates with their property, first ``limit``."""
    return (distressed_certificates(epc, props)
            .orderBy("uprn", "certificate_id").limit(limit)
            .select("asset_rating_band", "property_type", "address_line_1", "uprn"))


def distressed_overseas(epc, props, owners, companies, exclude_unknown: bool = False) -> DataFrame:
    """The overseas view - 4-way inner join, F/G, country != UK."""
    c = companies.where(F.col("incorporation_country") != "United Kingdom")
    if exclude_unknown:
        c = c.where(F.col("incorporation_country") != "Unknown")
    j = (distressed_certificates(epc, props)
         .join(owners.select("title_number", "company_number", "proprietor_name"), "title_number")
         .join(c.select("company_number", "incorporation_country"), "company_number"))
    return j.select("uprn", "address_line_1", "title_number", "asset_rating_band",
                    "proprietor_name", "incorporation_country")


def property_search(props, epc, q: str, limit: int = 10, escape: bool = False) -> DataFrame:
    """Address contains ``q`` (ASCII case-insensitive LIKE), with band."""
    from parcelgrid.functions.text import escape_like
    pattern = f"%{escape_like(q) if escape else q}%"
    hits = props.where(F.col("address_line_1").ilike(pattern)).select("uprn", "address_line_1")
    top = materialize_bounded(hits.orderBy("uprn").limit(limit), limit)
    e = _filter_to(epc.select("uprn", "certificate_id", "asset_rating_band"), top, "uprn")
    out = top.join(e, "uprn", "left").orderBy("uprn", F.col("certificate_id").asc_nulls_last()).limit(limit)
    return out.select("uprn", F.col("address_line_1").alias("address"), "asset_rating_band")


def planning_targets(props, epc, limit: int | None = None) -> DataFrame:
    """E/F/G properties with a location; all of them unless a ``limit`` is given."""
    e = epc.where(F.col("asset_rating_band").isin(*PLANNING_BANDS)).select("uprn", "certificate_id")
    p = props.where(F.col("latitude").isNotNull()).select("uprn", "postcode", "latitude", "longitude")
    out = p.join(e, "uprn")
    if limit is not None:
        out = out.orderBy("uprn", "certificate_id").limit(limit)
    return out.select("uprn", "postcode", "latitude", "longitude")


def enrichment_targets(companies, owners, props, epc, limit: int | None = None) -> DataFrame:
    """Companies owning an F/G asset that still lack status or country.
    A semi-join replaces the reference's DISTINCT over a 4-way join, so
    the join result is never materialised per certificate."""
    linked = (owners.select("title_number", "company_number")
              .join(props.select("uprn", "title_number"), "title_number")
              .join(epc.where(F.col("asset_rating_band").isin(*DISTRESS_BANDS)).select("uprn"), "uprn", "left_semi")
              .select("company_number"))
    c = companies.where(F.col("company_status").isNull() | (F.col("incorporation_country") == "Unknown"))
    out = c.join(linked, "company_number", "left_semi").select("company_number", "company_name").distinct()
    if limit is None:
        return out
    return out.orderBy("company_number", "company_name").limit(limit)
