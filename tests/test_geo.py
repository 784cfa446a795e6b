"""E14 grid conversion, E20 distances, E22 graph."""

import math
import random

import pytest
from pyspark.sql import functions as F

from parcelgrid.functions.geo import add_latlng, haversine_km
from parcelgrid.operators.graph import ancestors, ultimate_owners
from parcelgrid.operators.spatial import near_join, radius_search


def test_grid_conversion_near_published_example(spark):
    # OS guide worked example: E 651409.903 N 313177.270; ETRS89/WGS84 about 52.65801 N, 1.71607 E
    df = spark.createDataFrame([(651409.903, 313177.270)], "e double, n double")
    r = add_latlng(df, "e", "n").first()
    assert r.latitude == pytest.approx(52.658008, abs=1e-4)
    assert r.longitude == pytest.approx(1.716074, abs=1e-4)


def test_haversine_known_distance(spark):
    d = spark.range(1).select(haversine_km(F.lit(51.5074), F.lit(-0.1278), F.lit(48.8566), F.lit(2.3522))).first()[0]
    assert d == pytest.approx(343.5, abs=1.0)


def great_circle(a, b):
    """Distance in km of two (id, lat, lng) points from the angle between their unit vectors."""
    def unit(p):
        lat, lng = math.radians(p[1]), math.radians(p[2])
        return math.cos(lat) * math.cos(lng), math.cos(lat) * math.sin(lng), math.sin(lat)
    u, v = unit(a), unit(b)
    return 6371.0088 * 2 * math.asin(min(1.0, math.dist(u, v) / 2))


@pytest.mark.parametrize("lat,lng,spread_lat,spread_lng,km", [
    (51.5, -0.1, 0.05, 0.05, 0.5),      # a town
    (80.0, 20.0, 0.05, 0.3, 2.0),       # far north
    (10.0, 179.99, 0.05, 0.05, 1.0),    # both sides of the 180th meridian
    (-89.95, 0.0, 0.05, 180.0, 2.0),    # around a pole
])
def test_near_join_equals_brute_force(spark, lat, lng, spread_lat, spread_lng, km):
    rnd = random.Random(7)
    pts = []
    for i in range(200):
        x = lng + rnd.uniform(-spread_lng, spread_lng)
        pts.append((f"p{i}", lat + rnd.uniform(-spread_lat, spread_lat), (x + 180) % 360 - 180))
    left = spark.createDataFrame(pts, "id string, latitude double, longitude double")
    right = left.select(F.col("id").alias("rid"), F.col("latitude").alias("r_latitude"),
                        F.col("longitude").alias("r_longitude"))
    got = [(r.id, r.rid) for r in near_join(left, right, km).collect()]
    want = {(a[0], b[0]) for a in pts for b in pts if great_circle(a, b) <= km}
    assert len(got) == len(want) > len(pts) and set(got) == want
    near = {r.id for r in radius_search(left, lat, lng, 2 * km).collect()}
    assert near == {p[0] for p in pts if great_circle(p, (None, lat, lng)) <= 2 * km}


def test_ancestors_to_the_root_with_a_cycle_guard(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "d")], "child string, parent string")
    got = sorted((r.child, r.ancestor, r.depth) for r in ancestors(edges).collect())
    assert got == [("a", "b", 1), ("a", "c", 2), ("b", "a", 2), ("b", "c", 1), ("c", "a", 1), ("c", "b", 2)]
    top = {r.child: r.ultimate_owner for r in ultimate_owners(
        spark.createDataFrame([("x", "y"), ("y", "z")], "child string, parent string")).collect()}
    assert top == {"x": "z", "y": "z"}


def test_long_chains_and_layered_owners(spark):
    chain = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(14)], "child string, parent string")
    top = {r.child: (r.ultimate_owner, r.depth) for r in ultimate_owners(chain).collect()}
    assert top["n0"] == ("n14", 14) and top["n13"] == ("n14", 1)
    layers = [(f"l{i}{a}", f"l{i + 1}{b}") for i in range(5) for a in "xy" for b in "xy"]
    got = ancestors(spark.createDataFrame(layers, "child string, parent string")).collect()
    assert len(got) == len({(r.child, r.ancestor) for r in got}) == 60


def top_by_hand(edges):
    """Follow the largest owner step by step; a cycle ends at its smallest member."""
    up = {}
    for c, p in edges:
        if c is not None and p is not None and c != p:
            up[c] = max(p, up.get(c, p))
    out = {}
    for start in up:
        seen, at = [start], start
        while at in up and up[at] not in seen:
            at = up[at]
            seen.append(at)
        if at in up:  # seen closes a cycle
            cycle = seen[seen.index(up[at]):]
            end = min(cycle)
        else:
            end = at
        if end == start:
            continue
        steps, at = 0, start
        while at != end:
            at, steps = up[at], steps + 1
        out[start] = (end, steps)
    return out


def owners(spark, edges):
    df = spark.createDataFrame(edges, "child string, parent string")
    return {r.child: (r.ultimate_owner, r.depth) for r in ultimate_owners(df).collect()}


@pytest.mark.parametrize("seed", range(4))
def test_ultimate_owners_with_cycles_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    edges = [(f"c{i:02d}", f"c{rnd.randrange(60):02d}") for i in range(60) if rnd.random() < 0.9]
    edges += [(f"t{i:02d}", f"t{i + 1:02d}") for i in range(20)] + [("t20", "c00"), (None, "x"), ("x", None), ("y", "y")]
    edges += [("u0", "u1"), ("u1", "u2"), ("u2", "u0"), ("v", "u1"), ("w", "v"), ("w", "a"), ("v", "u1")]
    assert owners(spark, edges) == top_by_hand(edges)


def test_no_owners(spark):
    assert owners(spark, []) == {} and owners(spark, [("a", "a"), (None, None)]) == {}


def test_a_chain_of_100_000_companies(spark):
    """log2 n rounds of n rows each; the pairs of ancestors would be five billion."""
    n = 100_000
    chain = spark.range(n).select(F.format_string("n%06d", "id").alias("child"), F.format_string("n%06d", F.col("id") + 1).alias("parent"))
    out = ultimate_owners(chain)
    assert out.count() == n
    assert out.where((F.col("ultimate_owner") != f"n{n:06d}") | (F.col("depth") != n - F.substring("child", 2, 6).cast("int"))).isEmpty()


def test_a_dense_town_is_many_keys(spark):
    """A cell with most of the points is cut until its parts hold a bounded number of rows, and no pair is lost."""
    from parcelgrid.operators.spatial import _left_cells
    rnd = random.Random(11)
    pts = [(f"p{i}", 51.5 + rnd.uniform(0, 0.004), -0.1 + rnd.uniform(0, 0.006)) for i in range(600)]
    pts += [(f"q{i}", 51.5 + rnd.uniform(-0.2, 0.2), -0.1 + rnd.uniform(-0.2, 0.2)) for i in range(200)]
    left = spark.createDataFrame(pts, "id string, latitude double, longitude double")
    right = left.select(F.col("id").alias("rid"), F.col("latitude").alias("r_latitude"), F.col("longitude").alias("r_longitude"))
    want = {(a[0], b[0]) for a in pts for b in pts if great_circle(a, b) <= 0.5}
    got = [(r.id, r.rid) for r in near_join(left, right, 0.5, cell_rows=20).collect()]
    assert len(got) == len(want) and set(got) == want
    cells, cut = _left_cells(left, 0.5, "latitude", "longitude", 20)
    assert cut.count() >= 1
    assert cells.groupBy("_cy", "_cx", "_sy", "_sx").count().agg({"count": "max"}).first()[0] <= 40
    whole, _ = _left_cells(left, 0.5, "latitude", "longitude", 10_000)
    assert whole.groupBy("_cy", "_cx").count().agg({"count": "max"}).first()[0] > 250


@pytest.mark.parametrize("lat,lng,spread", [(51.5, -0.1, 0.02), (-89.99, 0.0, 180.0), (0.0, 179.995, 0.02)])
def test_cut_cells_at_poles_and_the_180th_meridian(spark, lat, lng, spread):
    rnd = random.Random(2)
    pts = [(f"p{i}", max(-90.0, lat + rnd.uniform(-0.01, 0.01)), (lng + rnd.uniform(-spread, spread) + 180) % 360 - 180) for i in range(150)]
    left = spark.createDataFrame(pts, "id string, latitude double, longitude double")
    right = left.select(F.col("id").alias("rid"), F.col("latitude").alias("r_latitude"), F.col("longitude").alias("r_longitude"))
    got = [(r.id, r.rid) for r in near_join(left, right, 0.6, cell_rows=4).collect()]
    want = {(a[0], b[0]) for a in pts for b in pts if great_circle(a, b) <= 0.6}
    assert len(got) == len(want) and set(got) == want


def test_nearest_equals_brute_force_with_a_hot_spot(spark):
    from parcelgrid.operators.spatial import nearest
    rnd = random.Random(5)
    props = [(f"p{i}", 51.5 + rnd.uniform(-0.05, 0.05), -0.1 + rnd.uniform(-0.05, 0.05)) for i in range(150)]
    props += [(f"h{i}", 51.5, -0.1) for i in range(150)] + [("far", 10.0, 10.0), ("none", None, 1.0)]
    stops = [(f"s{i:03d}", 51.5 + rnd.uniform(-0.05, 0.05), -0.1 + rnd.uniform(-0.05, 0.05), i) for i in range(60)]
    stops += [(f"z{i:03d}", 51.5003, -0.1, 1000 + i) for i in range(100)] + [("a", None, None, 7)]
    left = spark.createDataFrame(props, "uprn string, latitude double, longitude double")
    right = spark.createDataFrame(stops, "location_id string, r_latitude double, r_longitude double, footfall int")
    got = {r.uprn: (r.location_id, round(r.dist_km, 9), r.footfall) for r in nearest(left, right, 2.0, "uprn", "location_id", ["footfall"]).collect()}
    want = {}
    for p in props:
        if p[1] is not None:
            near = sorted((great_circle(p, s), s[0], s[3]) for s in stops if s[1] is not None and great_circle(p, s) <= 2.0)
            if near:
                want[p[0]] = (near[0][1], round(near[0][0], 9), near[0][2])
    assert got == want and got["h0"][0] == "z000" and "far" not in got


def test_nearest_joins_only_up_to_the_answering_ring(spark, monkeypatch):
    """Locations with a near stop do not take part in the wider rings."""
    from parcelgrid.operators import spatial
    asked = []
    real = spatial.near_join
    monkeypatch.setattr(spatial, "near_join", lambda left, right, km, *a, **k: asked.append((km, left.count())) or real(left, right, km, *a, **k))
    left = spark.createDataFrame([(i, 51.5 + i * 1e-5, -0.1) for i in range(20)] + [(99, 51.5, -0.088)], "uprn int, latitude double, longitude double")
    right = spark.createDataFrame([("a", 51.5, -0.1)], "location_id string, r_latitude double, r_longitude double")
    assert spatial.nearest(left, right, 1.0, "uprn", "location_id", []).count() == 21
    assert [n for _, n in asked] == [21, 1, 1] and asked[0][0] == 1 / 16


def test_near_join_gathers_no_side_for_a_broadcast(spark, tmp):
    from parcelgrid.operators.spatial import near_join
    left = spark.createDataFrame([(1, 51.5, -0.1), (2, 51.6, -0.1)], "a long, latitude double, longitude double")
    right = spark.createDataFrame([(7, 51.5005, -0.1), (8, 52.0, 0.0)], "b long, r_latitude double, r_longitude double")
    left.write.parquet(f"{tmp}/left")
    right.write.parquet(f"{tmp}/right")
    left, right = spark.read.parquet(f"{tmp}/left"), spark.read.parquet(f"{tmp}/right")
    out = near_join(left, right, 0.15, cell_rows=None)
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
    assert [(r.a, r.b) for r in near_join(left, right, 0.15).collect()] == [(1, 7)]


def test_rows_of_one_location_are_joined_in_blocks(spark):
    """Right rows of one location take part as blocks of bounded size; every pair comes out once, with null and repeated ids."""
    from parcelgrid.operators.spatial import PIECES, _spot_blocks
    pts = [(f"h{i}", i, 51.5, -0.1) for i in range(50)] + [(f"n{i}", None, 51.5008, -0.1) for i in range(20)]
    pts += [(f"q{i}", i, 51.5 + i * 4e-4, -0.1 + i * 3e-4) for i in range(30)]
    pts += [("twice", 1, 51.5008, -0.1), ("twice", 1, 51.5008, -0.1), (None, 2, 51.5, -0.1), ("lost", 3, None, -0.1), ("lost", 4, 51.5, None)]
    left = spark.createDataFrame(pts, "id string, n int, latitude double, longitude double")
    right = left.select(F.col("n").alias("m"), F.col("latitude").alias("r_latitude"), F.col("id").alias("rid"), F.col("longitude").alias("r_longitude"))
    at = [p for p in pts if p[2] is not None and p[3] is not None]
    dist = lambda a, b: great_circle((0, *a[2:]), (0, *b[2:]))
    key = lambda r: tuple((v is None, v) for v in r)
    want = sorted(((*a, b[1], b[2], b[0], b[3], round(dist(a, b), 6)) for a in at for b in at if dist(a, b) <= 0.15), key=key)
    out = near_join(left, right, 0.15, digits=6, block_rows=7)
    assert out.columns == [*left.columns, *right.columns, "dist_km"]
    assert sorted(map(tuple, out.collect()), key=key) == want
    lone = near_join(left, right, 0.15, digits=6, block_rows=None)
    assert sorted(map(tuple, lone.collect()), key=key) == want
    bare = near_join(left, right.select("r_latitude", "r_longitude"), 0.15)
    assert bare.count() == len(want)
    sizes = [len(r["_rows_rid"]) for r in _spot_blocks(right.dropna(subset=["r_latitude", "r_longitude"]), "r_latitude", "r_longitude", ["m", "rid"], 7).collect()]
    assert sum(sizes) == len(at) and max(sizes) == 7 and len(sizes) == 8 + 4 + 29
    assert out.rdd.getNumPartitions() >= PIECES * spark.sparkContext.defaultParallelism
