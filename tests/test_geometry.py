"""Reprojection against known values and tile cover against brute force."""

import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from trafficloom.catalogue_data import PROFILES, Profile
from trafficloom.functions import geometry as geo
from trafficloom.operators import tiles as ops

GOLDEN = [
    (25832, 626677.117, 6023913.142, 10.9489168, 54.3472880, 1e-6),
    (25832, 550000.0, 5800000.0, 9.7340371, 52.3480135, 1e-6),
    (25832, 640000.0, 5700000.0, 11.0140999, 51.4338789, 1e-6),
    (25832, 600000.0, 5600000.0, 10.4113388, 50.5433796, 1e-6),
    (25832, 400000.0, 5700000.0, 7.5611232, 51.4423523, 1e-6),
    (25833, 360000.0, 5800000.0, 12.9453217, 52.3324256, 1e-6),
    (25833, 300000.0, 5650000.0, 12.1515510, 50.9668349, 1e-6),
    (31466, 2568104.0, 5636313.0, 6.966639, 50.858160, 2e-5),
]


def test_known_points_both_ways(spark):
    df = spark.createDataFrame([g[:3] for g in GOLDEN], "srid int, x double, y double")
    nested = df.select(geo.first_point(geo.to_wgs84(
        geo.point(F.col("x"), F.col("y"), F.col("srid")))).alias("p")).collect()
    for (srid, x, y, lon, lat, eps), r in zip(GOLDEN, nested):
        assert (r.p.x, r.p.y) == (pytest.approx(lon, abs=eps), pytest.approx(lat, abs=eps))
        one = spark.createDataFrame([(x, y)], "x double, y double")
        flat = geo.reproject_columns(one, srid, "x", "y", "lon", "lat").first()
        assert (flat.lon, flat.lat) == (pytest.approx(r.p.x, abs=1e-12),
                                        pytest.approx(r.p.y, abs=1e-12))


def forward(lon, lat, meridian):
    """Textbook forward projection (Snyder series), independent of the code under test."""
    a, f, k0 = 6378137.0, 1 / 298.257222101, 0.9996
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)
    phi, dl = math.radians(lat), math.radians(lon - meridian)
    n = a / math.sqrt(1 - e2 * math.sin(phi) ** 2)
    t, c, aa = math.tan(phi) ** 2, ep2 * math.cos(phi) ** 2, dl * math.cos(phi)
    m = a * ((1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * phi
             - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * math.sin(2 * phi)
             + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * math.sin(4 * phi)
             - 35 * e2**3 / 3072 * math.sin(6 * phi))
    x = k0 * n * (aa + (1 - t + c) * aa**3 / 6
                  + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * aa**5 / 120) + 500000
    y = k0 * (m + n * math.tan(phi) * (aa**2 / 2 + (5 - t + 9 * c + 4 * c * c) * aa**4 / 24
              + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * aa**6 / 720))
    return x, y


def test_inverse_of_an_independent_forward_projection(spark):
    rnd = random.Random(3)
    rows = []
    for _ in range(300):
        srid, meridian = rnd.choice([(25832, 9), (25833, 15)])
        lon, lat = meridian + rnd.uniform(-2.5, 2.5), rnd.uniform(47, 55)
        rows.append((srid, *forward(lon, lat, meridian), lon, lat))
    df = spark.createDataFrame(rows, "srid int, x double, y double, lon double, lat double")
    p = geo.first_point(geo.to_wgs84(geo.point(F.col("x"), F.col("y"), F.col("srid"))))
    off = df.select(F.max(F.abs(p["x"] - df.lon)), F.max(F.abs(p["y"] - df.lat))).first()
    assert max(off) < 1e-6


def test_unknown_system_is_kept_for_the_contract(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    g = df.select(geo.to_wgs84(geo.point(df.x, df.y, 3857)).alias("g")).first().g
    assert g.srid == 3857


def unit(lon, lat):
    return ((lon + 180) / 360,
            (1 - math.asinh(math.tan(math.radians(lat))) / math.pi) / 2)


def brute_cover(points, z, steps=40000):
    """Tiles met by walking along the line in very small steps."""
    size, out = 2**z, set()
    for (a, b), (c, d) in zip(points, points[1:]):
        (ax, ay), (bx, by) = unit(a, b), unit(c, d)
        for i in range(steps + 1):
            t = i / steps
            out.add((int((ax + (bx - ax) * t) * size), int((ay + (by - ay) * t) * size)))
    return out


def test_line_cover_against_brute_force(spark):
    rnd = random.Random(7)
    lines = []
    for i in range(12):
        x, y = rnd.uniform(6, 14), rnd.uniform(47.5, 54.5)
        points = [(x, y)]
        for _ in range(rnd.randint(1, 4)):
            x, y = x + rnd.uniform(-0.4, 0.4), y + rnd.uniform(-0.3, 0.3)
            points.append((x, y))
        lines.append((i, points))
    lines.append((98, [(9.0, 50.0), (9.0, 50.6)]))  # straight north
    lines.append((99, [(9.0, 50.3), (9.7, 50.3)]))  # straight east
    rows = [(i, 20000, ("LineString", 4326, [p])) for i, p in lines]
    df = spark.createDataFrame(rows, "station_id int, dtv_kfz bigint, geometry struct<kind:string,"
                                     "srid:int,parts:array<array<struct<x:double,y:double>>>>")
    cut = ops.tile_index(df, Profile("t", 9, 12))
    got = {}
    for r in cut.collect():
        assert (r.x, r.y) not in got.setdefault((r.station_id, r.z), set())
        got[(r.station_id, r.z)].add((r.x, r.y))
    for i, points in lines:
        for z in range(9, 13):
            want = brute_cover(points, z)
            # a step may jump over a corner that the exact walk touches, never the reverse
            assert want <= got[(i, z)]
            assert len(got[(i, z)] - want) <= 1


def test_points_multipoints_and_edges_of_the_world(spark):
    schema = ("station_id int, dtv_kfz bigint, geometry struct<kind:string,srid:int,"
              "parts:array<array<struct<x:double,y:double>>>>")
    rows = [(1, 1, ("Point", 4326, [[(180.0, -89.0)]])), (2, 1, ("Point", 4326, [[(-180.0, 89.0)]])),
            (3, 1, ("MultiPoint", 4326, [[(9.0, 50.0)], [(9.0, 50.0)], [(100.0, 0.1)]]))]
    df = spark.createDataFrame(rows, schema)
    p = Profile("t", 3, 3)
    got = sorted((r.station_id, r.x, r.y) for r in ops.tile_index(df, p).collect())
    assert got == [(1, 7, 7), (2, 0, 0), (3, 4, 2), (3, 6, 3)]
    flat = ops.tile_index(df.filter("station_id < 3"), p, single_points=True)
    assert sorted((r.station_id, r.x, r.y) for r in flat.collect()) == [(1, 7, 7), (2, 0, 0)]


@pytest.mark.parametrize("ranked_ahead", ["1000", "10"])
def test_limit_keeps_the_busiest_of_a_crowded_tile(spark, ranked_ahead):
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", ranked_ahead)
    df = spark.range(5000).selectExpr(
        "cast(id as int) as station_id", "case when id % 10 = 0 then null else id % 997 end as dtv_kfz",
        "named_struct('kind', 'Point', 'srid', 4326, 'parts', "
        "array(array(named_struct('x', 9D + id / 1e9, 'y', 50D)))) as geometry")
    cut = ops.tile_index(df, Profile("t", 8, 8, max_features=30), key=F.col("station_id"))
    got = sorted(r.station_id for r in cut.collect())
    spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    ranked = sorted(((0 if i % 10 else 1, -(i % 997), i) for i in range(5000)))
    assert got == sorted(i for _, _, i in ranked[:30])


def test_thinning_keeps_the_same_features_further_in(spark):
    df = spark.range(1000).selectExpr(
        "cast(id as string) as station_id", "cast(20000 as bigint) as dtv_kfz",
        "named_struct('kind', 'Point', 'srid', 4326, 'parts', "
        "array(array(named_struct('x', 9D, 'y', 50D)))) as geometry")
    cut = ops.tile_index(df, Profile("t", 5, 9, drop_rate=2.0, base_zoom=8))
    by_zoom = {}
    for r in cut.collect():
        by_zoom.setdefault(r.z, set()).add(r.station_id)
    assert len(by_zoom[8]) == len(by_zoom[9]) == 1000
    assert by_zoom[5] < by_zoom[6] < by_zoom[7] < by_zoom[8]
    assert 60 < len(by_zoom[5]) < 190
    everything = ops.tile_index(df, Profile("t", 5, 9))
    assert everything.count() == 5000


def test_coalesced_features_lose_no_part(spark):
    df = spark.range(1000).selectExpr(
        "cast(id % 2 as string) as road_class", "cast(20000 as bigint) as dtv_kfz",
        "named_struct('kind', 'LineString', 'srid', 4326, 'parts', array(array("
        "named_struct('x', 9D + id / 1e6, 'y', 50D), named_struct('x', 9.00001D + id / 1e6, "
        "'y', 50.5D + id / 1e6)))) as geometry")
    cut = ops.tile_index(df, Profile("t", 5, 5)).drop("dtv_kfz")
    one = ops.coalesce_features(cut, ["road_class"]).collect()
    assert [(len(r.geometry.parts), r.copies) for r in one] == [(1, 1)] * 1000
    same = cut.withColumn("geometry", F.first("geometry").over(Window.partitionBy("z")))
    copies = ops.coalesce_features(same, ["road_class"]).collect()
    assert sorted(r.copies for r in copies) == [500, 500]
    through_profile = ops.tile_index(df, Profile("t", 5, 5, coalesce=True))
    assert through_profile.count() == 1000


def test_profiles_cover_every_group():
    assert {p.layer for p in PROFILES.values()} == {
        "svz", "svz_points", "bast", "kommunal", "kommunal_points"}
