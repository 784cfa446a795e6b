"""Signal reports over the conformed tables.

E15-E19 are declared-only in the reference (schema comments and README);
the definitions here are ours and documented per function.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from parcelgrid.functions.text import normalize_address
from parcelgrid.operators.merge import rejected_units
from parcelgrid.operators.spatial import grid_cell_sum, nearest
from parcelgrid.session import written


def load_with_counts(target: DataFrame, batch: DataFrame, key: list[str], unit: str) -> tuple[DataFrame, DataFrame]:
    """The append of B4 with its counts, taken in the load's own passes: (new target, rows and rows loaded per unit and in total).
    The feed is scanned once, into a staged table; the totals are observed while that table and the new target are written, the
    units' rows come from the staged column of their names."""
    seen, kept = Observation(), Observation()
    staged = written(batch.observe(seen, F.count(F.lit(1)).alias("rows")), "staged")
    bad = rejected_units(target, staged, key, unit)
    good = staged.join(bad, unit, "left_anti").observe(kept, F.count(F.lit(1)).alias("rows"))
    loaded = written(target.unionByName(good.drop(unit), allowMissingColumns=True), "loaded")
    per_unit = staged.groupBy(unit).agg(F.count(F.lit(1)).alias("rows")).join(bad.withColumn("_bad", F.lit(True)), unit, "left")
    total = target.sparkSession.createDataFrame([("TOTAL", seen.get["rows"], kept.get["rows"])], "unit string, rows long, rows_loaded long")
    counts = per_unit.select(F.col(unit).alias("unit"), "rows", F.when(F.col("_bad"), F.lit(0)).otherwise(F.col("rows")).alias("rows_loaded"))
    return loaded, counts.unionByName(total)


def hygiene_staleness(ratings: DataFrame, as_of: dt.date, years: int = 2) -> DataFrame:
    """E15 (ours): share of establishments per postcode whose last rating is
    older than ``years`` before ``as_of`` (no date counts as stale)."""
    cutoff = F.add_months(F.lit(as_of), -12 * years)
    stale = F.col("rating_date").isNull() | (F.col("rating_date") < cutoff)
    g = ratings.groupBy("postcode").agg(F.count(F.lit(1)).alias("n"),
                                        F.sum(stale.cast("int")).alias("n_stale"))
    return g.withColumn("stale_share", F.round(F.col("n_stale") / F.col("n"), 4))


def covenant_flag(props: DataFrame, covenants: DataFrame) -> DataFrame:
    """E16 (ours): every property with has_covenant (false when absent)."""
    c = covenants.select("title_number", "has_covenant").where(F.col("title_number").isNotNull()).distinct()
    # a null title matches nothing; a key of its own per property keeps all of them from one task
    key = F.coalesce("title_number", F.concat(F.lit("\u0000"), "uprn"))
    c = c.withColumnRenamed("title_number", "_title")
    return (props.select("uprn", "title_number").join(c, F.col("_title") == key, "left")
                 .select("uprn", "title_number", F.coalesce("has_covenant", F.lit(False)).alias("has_covenant")))


def lease_expiry(leases: DataFrame) -> DataFrame:
    """E17 (ours, from the schema comment): expiry = start + term years."""
    return leases.select("unique_lease_id", "title_number", "lease_date", "lease_term_years",
                         F.add_months("lease_date", F.col("lease_term_years") * 12).alias("lease_expiry_date"))


def expiry_cliff(leases: DataFrame, as_of: dt.date) -> DataFrame:
    """E17 (ours): leases per expiry year from ``as_of``'s year on."""
    e = lease_expiry(leases)
    return (e.where(F.col("lease_expiry_date") >= F.lit(as_of))
             .groupBy(F.year("lease_expiry_date").alias("expiry_year"))
             .agg(F.count(F.lit(1)).alias("n_leases")))


def rates_change(voa: DataFrame) -> DataFrame:
    """E18 (ours): 2026 vs 2023 rateable value, amount and percent."""
    ch = F.col("rateable_value_2026") - F.col("rateable_value_2023")
    return voa.select("billing_authority_ref", "postcode", "rateable_value_2023", "rateable_value_2026",
                      ch.alias("change"),
                      F.round(F.try_divide(ch * F.lit(100.0), F.col("rateable_value_2023")), 4).alias("change_pct"))


def fibre_desert(connectivity: DataFrame, props: DataFrame, max_speed: int = 100) -> DataFrame:
    """E19 (ours): per postcode, properties without fibre and with download
    below ``max_speed``; share of the postcode's connected properties."""
    j = connectivity.join(props.select("uprn", "postcode"), "uprn")
    desert = (~F.coalesce(F.col("fiber_availability"), F.lit(False))) & (F.col("max_download_speed") < max_speed)
    g = j.groupBy("postcode").agg(F.count(F.lit(1)).alias("n"), F.sum(desert.cast("int")).alias("n_desert"))
    return g.withColumn("desert_share", F.round(F.col("n_desert") / F.col("n"), 4))


def footfall_heatmap(stops: DataFrame, cell_deg: float = 0.01) -> DataFrame:
    """E21 (ours): total footfall per grid cell."""
    return grid_cell_sum(stops, "annual_footfall", cell_deg)


def nearest_stop(props: DataFrame, stops: DataFrame, km: float = 1.0) -> DataFrame:
    """E21 (ours): per property the nearest stop within ``km`` and its footfall."""
    s = stops.select("location_id", F.col("latitude").alias("r_latitude"), F.col("longitude").alias("r_longitude"),
                     "annual_footfall")
    return nearest(props.select("uprn", "latitude", "longitude"), s, km, "uprn", "location_id", ["annual_footfall"])


def map_points(assets: DataFrame, postcodes: DataFrame, postcode_col: str = "postcode") -> DataFrame:
    """Assets placed at their postcode's coordinates (normalised
    postcode join); assets without coordinates are omitted."""
    pc = postcodes.select(normalize_address(F.col("postcode")).alias("_pc"), F.col("latitude").alias("lat"),
                          F.col("longitude").alias("lng")).where(F.col("lat").isNotNull() & F.col("lng").isNotNull())
    a = assets.withColumn("_pc", normalize_address(F.col(postcode_col)))
    return a.join(pc, "_pc").drop("_pc")
