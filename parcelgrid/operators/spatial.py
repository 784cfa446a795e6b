"""Radius search and near-join on a grid-cell equi-join.

A range join on distance becomes an equi-join.  Latitude is cut into bands at
least ``radius`` high, and each band into a whole number of longitude cells, fewer toward
the poles, so that cells are about as wide as the radius everywhere.  The left side takes
its own cell; the right side is exploded to the cells its circle can reach in its band and the
two next to it, counted around the globe.  The join runs on the cell key
(hash-partitioned, no cartesian product), and the exact haversine distance filters the candidates.

Cells follow the load: a cell with more than ``CELL_ROWS`` left rows is cut into 4, 16, ... equal parts (a quadtree code within the cell), and a right
row goes to the parts that its circle's box can reach.  A dense town is then many keys, and the parts fit the circles more closely than the cell did.

Right rows of one location (the flats of a house) are joined as one block, so that their distance is worked out once for each left row.  The join
ends in all pairs, which grow with the square of the density; it is cut into pieces by number, as its bytes do not show its work.

``nearest`` expands rings.  It works on different locations, so a third of all rows on one spot are one location.  The first ring is
a 16th of the radius, each further ring four times as wide, and only locations without an answer go on; a ring holds everything within its
width, so the nearest row found there is the nearest of all.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelgrid.functions.geo import EARTH_RADIUS_KM, haversine_km, haversine_of_radians
from parcelgrid.session import dealt, written

KM_PER_DEG_LAT = math.pi * EARTH_RADIUS_KM / 180.0
#: widens boxes beyond rounding errors
_SLACK = 1e-9
#: left rows of a cell before it is cut, and the deepest cut
CELL_ROWS = 10_000
MAX_DEPTH = 8
#: right rows of one location that are joined as one, and partitions of that join for each core
BLOCK_ROWS = 512
PIECES = 8
#: rings of nearest(), each so many times as wide as the one before
RINGS = 3
WIDER = 4


def radius_search(points: DataFrame, lat: float, lng: float, km: float,
                  lat_col: str = "latitude", lng_col: str = "longitude") -> DataFrame:
    """Points within ``km`` of (lat, lng), anywhere on the globe.  A bounding-box
    prefilter goes first so parquet min/max statistics can skip row groups; the box is
    cut in two at the 180th meridian and takes every longitude around a pole."""
    dlat = km / KM_PER_DEG_LAT + _SLACK
    box = F.col(lat_col).between(lat - dlat, lat + dlat)
    if abs(lat) + dlat < 90.0:
        dlng = math.degrees(math.asin(min(1.0, math.sin(math.radians(dlat)) / math.cos(math.radians(lat))))) + _SLACK
        around = [F.col(lng_col).between(at - dlng, at + dlng) for at in (lng - 360.0, lng, lng + 360.0)
                  if at + dlng >= -180.0 and at - dlng <= 180.0]
        side = around[0]
        for more in around[1:]:
            side = side | more
        box = box & side
    d = haversine_km(F.col(lat_col), F.col(lng_col), F.lit(lat), F.lit(lng))
    return points.where(box).withColumn("dist_km", d).where(F.col("dist_km") <= km)


def _cells(df: DataFrame, lat: str, lng: str, cell: float) -> DataFrame:
    return df.withColumn("_cy", F.floor(F.col(lat) / cell)).withColumn("_cx", F.floor(F.col(lng) / cell))


def _side(depth: Column) -> Column:
    """Parts of a cut cell along one side."""
    return F.pow(F.lit(2.0), depth).cast("long")


def _cells_in_band(band: Column, km: float, height: float) -> Column:
    """Number of longitude cells of a band: cells are ``km`` wide at its edge nearest a pole."""
    edge = F.least(F.lit(90.0), F.greatest(F.abs(band * F.lit(height)), F.abs((band + 1) * F.lit(height))))
    return F.greatest(F.lit(1), F.floor(F.lit(360.0 * KM_PER_DEG_LAT / km) * F.cos(F.radians(edge)))).cast("long")


def _left_cells(left: DataFrame, km: float, lat: str, lng: str, cell_rows: int | None) -> tuple[DataFrame, DataFrame | None]:
    """Left rows with their cell (_cy, _cx) and part (_sy, _sx); and the cut cells with the depth of the cut (a cell has 4^depth parts).
    Without ``cell_rows`` no cell is cut, and the rows have no part."""
    height = km / KM_PER_DEG_LAT + _SLACK
    at = left.where(F.col(lat).isNotNull() & F.col(lng).isNotNull()).withColumn("_y", F.col(lat) / F.lit(height)).withColumn("_cy", F.floor("_y"))
    n = _cells_in_band(F.col("_cy"), km, height)
    at = at.withColumn("_x", F.pmod(F.col(lng) + F.lit(180.0), F.lit(360.0)) * n / F.lit(360.0)).withColumn("_cx", F.least(F.floor("_x"), n - 1))
    if cell_rows is None:
        return at.drop("_y", "_x"), None
    deep = F.least(F.lit(MAX_DEPTH), F.ceil(F.log(4.0, F.col("_n") / F.lit(cell_rows)))).cast("int")
    cut = (at.groupBy("_cy", "_cx").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > cell_rows).select("_cy", "_cx", deep.alias("_depth")))
    side = _side(F.col("_depth"))
    part = lambda position, cell: F.least(F.floor((F.col(position) - F.col(cell)) * side), side - 1)
    return (at.join(cut, ["_cy", "_cx"], "left").withColumn("_depth", F.coalesce("_depth", F.lit(0)))
              .withColumns({"_sy": part("_y", "_cy"), "_sx": part("_x", "_cx")}).drop("_y", "_x", "_depth")), cut


def near_join(left: DataFrame, right: DataFrame, km: float, l_lat: str = "latitude", l_lng: str = "longitude",
              r_lat: str = "r_latitude", r_lng: str = "r_longitude", cell_rows: int | None = CELL_ROWS, digits: int | None = None,
              block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """All (left, right) pairs within ``km`` (haversine), poles and the 180th meridian
    included.  Column names of the two sides must be distinct.  Adds ``dist_km``, rounded to
    ``digits`` where given (pairs are chosen by the distance before it is rounded).
    Without ``block_rows`` right rows are joined one by one."""
    height = km / KM_PER_DEG_LAT + _SLACK
    lc, cut = _left_cells(_with_radians(left, l_lat, l_lng, "_l"), km, l_lat, l_lng, cell_rows)
    others = [c for c in right.columns if c not in (r_lat, r_lng)]
    rc = right.where(F.col(r_lat).isNotNull() & F.col(r_lng).isNotNull())
    in_blocks = block_rows is not None and bool(others)
    if in_blocks:
        rc = _spot_blocks(rc, r_lat, r_lng, others, block_rows)
    rc = _with_radians(rc, r_lat, r_lng, "_r")

    reach = F.sin(F.radians(F.lit(height))) / F.cos(F.radians(F.col(r_lat)))
    dlng = F.when(F.abs(F.col(r_lat)) + F.lit(height) >= 90.0, F.lit(180.0)).otherwise(
        F.degrees(F.asin(F.least(F.lit(1.0), reach))) + F.lit(_SLACK))
    rc = (rc
          .withColumn("_cy", F.explode(F.array(*[F.floor(F.col(r_lat) / height) + i for i in (-1, 0, 1)])))
          .withColumn("_n", _cells_in_band(F.col("_cy"), km, height))
          .withColumns({"_x": F.pmod(F.col(r_lng) + F.lit(180.0), F.lit(360.0)) * F.col("_n") / F.lit(360.0), "_w": dlng * F.col("_n") / F.lit(360.0)}))
    first, last = F.floor(F.col("_x") - F.col("_w")), F.floor(F.col("_x") + F.col("_w"))
    around = last - first >= F.col("_n") - 1  # the box goes all around the band
    rc = (rc.withColumn("_around", around).withColumn("_k", F.explode(F.sequence(first, F.least(last, first + F.col("_n") - 1))))
            .withColumn("_cx", F.pmod("_k", "_n")))
    key = ["_cy", "_cx"]
    if cut is not None:
        rc, key = _parts(rc, cut, height, r_lat), [*key, "_sy", "_sx"]
    rc = rc.drop("_n", "_x", "_w", "_around", "_k")
    if in_blocks:
        lc, rc = _pieces(lc, key), _pieces(rc, key)
    d = haversine_of_radians(*[F.col(c) for c in ("_l_lat", "_l_lng", "_l_cos", "_r_lat", "_r_lng", "_r_cos")])
    in_band = F.abs(F.col("_l_lat") - F.col("_r_lat")) <= F.lit(math.radians(height))  # turns many away before their distance is worked out
    near = lc.join(dealt(rc), key).withColumn("dist_km", d).where(in_band & (F.col("dist_km") <= km))
    if digits is not None:
        near = near.withColumn("dist_km", F.round("dist_km", digits))
    if in_blocks:
        near = near.select("*", F.posexplode(_array(others[0])).alias("_at", others[0])).withColumns({c: F.get(_array(c), "_at") for c in others[1:]})
    return near.select(*left.columns, *right.columns, "dist_km")


def _array(column: str) -> str:
    """Name of the array of a column in a block."""
    return f"_rows_{column}"


def _with_radians(df: DataFrame, lat: str, lng: str, to: str) -> DataFrame:
    """``df`` with what the distance takes from one point alone, so that it is not worked out again for each pair."""
    rad = lambda c: F.radians(F.col(c).cast("double"))
    return df.withColumns({f"{to}_lat": rad(lat), f"{to}_lng": rad(lng), f"{to}_cos": F.cos(rad(lat))})


def _spot_blocks(df: DataFrame, lat: str, lng: str, others: list[str], block_rows: int) -> DataFrame:
    """Rows in blocks of at most ``block_rows`` rows of one location: lat, lng and an array for each other column."""
    spot = Window.partitionBy(lat, lng).orderBy(F.lit(1))
    return (df.withColumn("_block", F.floor((F.row_number().over(spot) - 1) / F.lit(block_rows)))
              .groupBy(lat, lng, "_block").agg(F.collect_list(F.struct(*others)).alias("_rows"))
              .select(lat, lng, *[F.col("_rows").getField(c).alias(_array(c)) for c in others]))


def _pieces(df: DataFrame, key: list[str]) -> DataFrame:
    """``df`` dealt out by key into a number of partitions that stays: those of a join that makes many rows of few bytes must not be put together by their bytes."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), PIECES * spark.sparkContext.defaultParallelism), *key)


def _parts(rc: DataFrame, cut: DataFrame, height: float, r_lat: str) -> DataFrame:
    """Right rows of a cut cell once for each part (_sy, _sx) that their box reaches."""
    side = _side(F.col("_depth"))
    rc = rc.join(cut, ["_cy", "_cx"], "left").withColumn("_depth", F.coalesce("_depth", F.lit(0)))
    y, x = F.col(r_lat) / F.lit(height) - F.col("_cy"), F.col("_x") - F.col("_k")
    parts = lambda lo, hi: F.explode(F.sequence(F.greatest(F.lit(0), F.floor(lo * side)), F.least(side - 1, F.floor(hi * side))))
    reaches = lambda lo, hi: (lo * side < side) & (hi >= 0)
    return (rc.where(reaches(y - 1, y + 1)).withColumn("_sy", parts(y - 1, y + 1))
              .where(F.col("_around") | reaches(x - F.col("_w"), x + F.col("_w")))
              .withColumn("_sx", parts(F.when(F.col("_around"), F.lit(0.0)).otherwise(x - F.col("_w")), F.when(F.col("_around"), F.lit(1.0)).otherwise(x + F.col("_w"))))
              .drop("_depth"))


def nearest(left: DataFrame, right: DataFrame, km: float, l_id: str, r_id: str, carry: list[str], l_lat: str = "latitude", l_lng: str = "longitude",
            r_lat: str = "r_latitude", r_lng: str = "r_longitude") -> DataFrame:
    """Per left row the nearest right row within ``km`` (ties: lowest
    r_id).  Output: l_id, r_id, dist_km, *carry."""
    spots = (right.where(F.col(r_lat).isNotNull() & F.col(r_lng).isNotNull())
             .groupBy(F.col(r_lat).cast("double").alias("_rlat"), F.col(r_lng).cast("double").alias("_rlng"))
             .agg(F.min(F.struct(F.col(r_id).alias("_r"), *[F.col(c) for c in carry])).alias("_m")))
    spots = written(spots, "spots")
    rows = left.where(F.col(l_lat).isNotNull() & F.col(l_lng).isNotNull()).select(l_id, F.col(l_lat).cast("double").alias("_lat"), F.col(l_lng).cast("double").alias("_lng"))
    open_rows, rings = rows.select("_lat", "_lng").distinct(), []
    for ring in range(RINGS):
        pairs = near_join(open_rows, spots, km / WIDER ** (RINGS - 1 - ring), "_lat", "_lng", "_rlat", "_rlng", cell_rows=None, block_rows=None)
        best = pairs.groupBy(F.col("_lat").alias("_blat"), F.col("_lng").alias("_blng")).agg(F.min(F.struct("dist_km", "_m")).alias("_b"))
        if ring == RINGS - 1:
            rings.append(best.select(F.col("_blat").alias("_lat"), F.col("_blng").alias("_lng"), "_b"))
            break
        step = written(open_rows.join(best, (F.col("_lat") == F.col("_blat")) & (F.col("_lng") == F.col("_blng")), "left").select("_lat", "_lng", "_b"), "ring")
        rings.append(step.where(F.col("_b").isNotNull()))
        open_rows = step.where(F.col("_b").isNull()).select("_lat", "_lng")
        if open_rows.isEmpty():
            break
    found = reduce(DataFrame.unionByName, rings)
    return rows.join(found, ["_lat", "_lng"]).select(
        l_id, F.col("_b._m._r").alias(r_id), F.col("_b.dist_km").alias("dist_km"), *[F.col(f"_b._m.{c}").alias(c) for c in carry])


def grid_cell_sum(points: DataFrame, value: str, cell_deg: float, lat: str = "latitude",
                  lng: str = "longitude") -> DataFrame:
    """E21 heatmap: sum and count per grid cell (cell south-west corner)."""
    c = _cells(points.where(F.col(lat).isNotNull() & F.col(lng).isNotNull()), lat, lng, cell_deg)
    return c.groupBy("_cy", "_cx").agg(F.sum(value).alias(f"total_{value}"), F.count(F.lit(1)).alias("n_points")).select(
        (F.col("_cy") * F.lit(cell_deg)).alias("cell_lat"), (F.col("_cx") * F.lit(cell_deg)).alias("cell_lng"),
        F.col("_cy").alias("cell_y"), F.col("_cx").alias("cell_x"), f"total_{value}", "n_points")
