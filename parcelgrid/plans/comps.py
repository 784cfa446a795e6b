"""Comparable sales and price per area.

The reference answers one postcode at a time and re-runs the same
certificate query for every sale.  Here one plan covers every postcode:
the newest 20 sales per postcode (row_number <= 20 gets a partial
per-task top-k before the shuffle, so a hot postcode never reaches one
task whole), matched to certificates of the same postcode by ``first_match``
(lossless prefix-filtered candidates, no all-pairs block).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelgrid.functions.signals import price_k, sale_psf, size_label
from parcelgrid.operators.linkage import first_match


def recent_sales(sales: DataFrame, limit: int = 20, postcode: str | None = None) -> DataFrame:
    """Newest ``limit`` sales per postcode (or in one postcode)."""
    s = sales if postcode is None else sales.where(F.col("postcode") == postcode)
    w = Window.partitionBy("postcode").orderBy(F.col("transfer_date").desc_nulls_last(),
                                               F.col("transaction_id").asc())
    return (s.where(F.col("postcode").isNotNull())
             .select("transaction_id", "transfer_date", "price_paid", "full_address", "property_type", "postcode")
             .withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= limit).drop("_rn"))


def postcode_sizes(epc: DataFrame, props: DataFrame, postcode: str | None = None) -> DataFrame:
    """Certificate address and floor area per postcode."""
    p = props if postcode is None else props.where(F.col("postcode") == postcode)
    return (epc.select("certificate_id", "uprn", "floor_area")
               .join(p.select("uprn", "address_line_1", "postcode"), "uprn")
               .select("certificate_id", "postcode", "address_line_1", "floor_area"))


def sale_matches(sales: DataFrame, epc: DataFrame, props: DataFrame, limit: int = 20,
                 threshold: float = 0.8, method: str = "difflib") -> DataFrame:
    """C7 on comps: each recent sale with the first certificate (by id) of
    its postcode whose address ratio > threshold; unmatched sales kept."""
    rs = recent_sales(sales, limit)
    sizes = postcode_sizes(epc, props)
    m = first_match(rs, sizes, ["postcode"], "transaction_id", "certificate_id", "full_address",
                    "address_line_1", "certificate_id", carry=["floor_area"],
                    threshold=threshold, method=method)
    return rs.join(m, "transaction_id", "left")


def comps_sales(sales, epc, props, limit: int = 20, threshold: float = 0.8,
                method: str = "difflib") -> DataFrame:
    """E1 + E3 per sale: psf, price in £k, 35-char address, size label."""
    j = sale_matches(sales, epc, props, limit, threshold, method)
    return j.select(
        "postcode", "transaction_id", "transfer_date", "price_paid", "certificate_id",
        sale_psf(F.col("price_paid"), F.col("floor_area")).alias("psf"),
        price_k("price_paid").alias("price_k"),
        F.substring("full_address", 1, 35).alias("address_35"),
        size_label("floor_area").alias("size_label"))


def comps_all(sales, epc, props, limit: int = 20, threshold: float = 0.8,
              method: str = "difflib") -> DataFrame:
    """E2 for every postcode: mean psf over sized sales (truncated to int),
    number of sized comps, number of sales, and the 'no match' message."""
    per_sale = comps_sales(sales, epc, props, limit, threshold, method)
    g = per_sale.groupBy("postcode").agg(
        F.count(F.lit(1)).alias("n_sales"),
        F.count("psf").alias("n_comps"),
        F.avg("psf").alias("_avg"))
    return g.select(
        "postcode", "n_sales", "n_comps",
        F.floor("_avg").cast("bigint").alias("avg_psf"),
        F.when(F.col("n_comps") == 0, F.lit("no size matches")).otherwise(F.lit("ok")).alias("signal"))


def comps(sales, epc, props, postcode: str, limit: int = 20, threshold: float = 0.8,
          method: str = "difflib") -> DataFrame:
    """E2 for one postcode (the reference's entry point): the postcode
    filter is applied to sales and properties before anything else, so it
    reaches both scans; the result is the one-row ``comps_all`` report."""
    s = sales.where(F.col("postcode") == postcode)
    p = props.where(F.col("postcode") == postcode)
    return comps_all(s, epc, p, limit, threshold, method)
