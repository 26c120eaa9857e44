"""Points, reprojection, bounds and shape keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from trafficloom.functions import geometry as geo
from trafficloom.operators import catalogue as cat
from trafficloom.queries import standins as s
from trafficloom.queries.registry import query, table
from trafficloom.sources.readers import in_box


@query(f"""
    with {s.SECTIONS_SQL},
    {s.utm_sql("sections", "west", [("e1", "n1", "lon32", "lat32")], 25832)},
    {s.utm_sql("sections", "east", [("e1", "n1", "lon33", "lat33")], 25833)}
    select west.station_id, round(lon32, 6) as lon32, round(lat32, 6) as lat32,
        round(lon33, 6) as lon33, round(lat33, 6) as lat33
    from west join east on west.station_id = east.station_id
""")
def reproject_utm(spark, folder):
    """Both zones, as compiled arithmetic over flat columns."""
    rows = s.sections(spark, folder)
    moved = geo.reproject_columns(rows, 25832, "e1", "n1", "lon32", "lat32")
    moved = geo.reproject_columns(moved, 25833, "e1", "n1", "lon33", "lat33")
    return moved.select(
        "station_id",
        *[F.round(c, 6).alias(c) for c in ("lon32", "lat32", "lon33", "lat33")],
    )


GK = {
    "c_custkey": "c_custkey",
    "x": "cast(2540000 + (c_custkey * 7919) % 60000 as double)",
    "y": "cast(5610000 + (c_custkey * 104729) % 60000 as double)",
}


@query(f"""
    with t as (select {s.columns_sql(GK)} from customer),
    {s.utm_sql("t", "placed", [("x", "y", "lon", "lat")], 31466)}
    select c_custkey, round(lon, 6) as lon, round(lat, 6) as lat from placed
""")
def reproject_with_datum_shift(spark, folder):
    rows = s.derive(table(spark, folder, "customer"), GK)
    moved = geo.reproject_columns(rows, 31466, "x", "y", "lon", "lat")
    return moved.select("c_custkey", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


MIXED = {
    "c_custkey": "c_custkey",
    "srid": """cast(case c_custkey % 4 when 0 then 25832 when 1 then 25833 when 2 then 31466
        else 4326 end as int)""",
    "x": """case c_custkey % 4 when 2 then cast(2540000 + (c_custkey * 7919) % 60000 as double)
        when 3 then 6.0 + (c_custkey % 900) / 100.0
        else cast(300000 + (c_custkey * 7919) % 500000 as double) end""",
    "y": """case c_custkey % 4 when 2 then cast(5610000 + (c_custkey * 104729) % 60000 as double)
        when 3 then 47.0 + (c_custkey % 800) / 100.0
        else cast(5250000 + (c_custkey * 104729) % 800000 as double) end""",
}


@query(f"""
    with t as (select {s.columns_sql(MIXED)} from customer),
    a as (select c_custkey, x, y from t where srid = 25832),
    b as (select c_custkey, x, y from t where srid = 25833),
    c as (select c_custkey, x, y from t where srid = 31466),
    {s.utm_sql("a", "pa", [("x", "y", "lon", "lat")], 25832)},
    {s.utm_sql("b", "pb", [("x", "y", "lon", "lat")], 25833)},
    {s.utm_sql("c", "pc", [("x", "y", "lon", "lat")], 31466)},
    placed as (select c_custkey, lon, lat from pa union all select c_custkey, lon, lat from pb
        union all select c_custkey, lon, lat from pc
        union all select c_custkey, x, y from t where srid = 4326)
    select c_custkey, 4326 as srid, round(lon, 6) as lon, round(lat, 6) as lat from placed
""")
def reproject_by_row_system(spark, folder):
    """Nested geometries, each in the system it names."""
    rows = s.derive(table(spark, folder, "customer"), MIXED)
    shape = geo.to_wgs84(geo.point(F.col("x"), F.col("y"), F.col("srid")))
    moved = rows.select("c_custkey", shape.alias("g"))
    p = geo.first_point(F.col("g"))
    return moved.select(
        "c_custkey", F.col("g.srid").alias("srid"),
        F.round(p["x"], 6).alias("lon"), F.round(p["y"], 6).alias("lat"),
    )


LATLON = {
    "c_custkey": "c_custkey",
    "lat": "47.0 + (c_custkey * 104729 % 800000) / 100000.0",
    "lon": "6.0 + (c_custkey * 7919 % 900000) / 100000.0",
}


@query(f"""
    with t as (select {s.columns_sql(LATLON)} from customer)
    select c_custkey, 4326 as srid, cast(lon as double) as x, cast(lat as double) as y from t
""")
def axis_and_system_override(spark, folder):
    """Lat/lon delivered under a wrong system name: state the system, swap the axes."""
    rows = s.derive(table(spark, folder, "customer"), LATLON)
    shape = geo.swap_axes(geo.with_srid(geo.point(F.col("lat"), F.col("lon"), 25832), 4326))
    moved = rows.select("c_custkey", shape.alias("g"))
    p = geo.first_point(F.col("g"))
    return moved.select(
        "c_custkey", F.col("g.srid").alias("srid"), p["x"].alias("x"), p["y"].alias("y")
    )


@query(f"""
    with {s.FEATURES_SQL}
    select source, bool_and(is_point) as only_points, count(distinct is_point) as kinds
    from features group by source
""")
def geometry_kinds_per_source(spark, folder):
    return (
        s.features(spark, folder)
        .groupBy("source")
        .agg(
            F.bool_and(geo.is_point(F.col("geometry"))).alias("only_points"),
            F.count_distinct("geometry.kind").alias("kinds"),
        )
    )


@query("""
    select o_orderkey, o_orderkey % 4 in (0, 1, 2) as missing from orders
""")
def missing_geometries(spark, folder):
    """Null geometry, no part, and a part without points all count as missing."""
    empty = F.array().cast("array<array<struct<x:double,y:double>>>")
    hollow = F.array(F.array().cast("array<struct<x:double,y:double>>"))
    parts = F.expr("o_orderkey % 4")
    shape = (
        F.when(parts == 1, geo.geometry("LineString", 4326, empty))
        .when(parts == 2, geo.geometry("MultiLineString", 4326, hollow))
        .when(parts == 3, geo.point(F.lit(1.0), F.lit(2.0)))
    )
    rows = table(spark, folder, "orders").select("o_orderkey", shape.alias("g"))
    return rows.select("o_orderkey", geo.is_missing(F.col("g")).alias("missing"))


@query(f"""
    with {s.FEATURES_SQL}
    select round_even(min(least(lon1, lon2)), 4) as west,
        round_even(min(least(lat1, lat2)), 4) as south,
        round_even(max(greatest(lon1, lon2)), 4) as east,
        round_even(max(greatest(lat1, lat2)), 4) as north
    from features
""")
def total_bounds(spark, folder):
    return cat.with_bounds(s.features(spark, folder)).agg(*cat.bounds_of())


@query(f"""
    with {s.FEATURES_SQL}
    select station_id, round(least(lon1, lon2), 6) as x from features
    where least(lon1, lon2) <= 10.5 and greatest(lon1, lon2) >= 8.0
        and least(lat1, lat2) <= 51.5 and greatest(lat1, lat2) >= 49.0
""")
def features_in_box(spark, folder):
    found = in_box(s.features(spark, folder), 8.0, 49.0, 10.5, 51.5)
    return found.select(
        "station_id", F.round(geo.bounds(F.col("geometry"))["xmin"], 6).alias("x")
    )


SHAPES = {
    "o_orderkey": "o_orderkey",
    "a": "cast(o_custkey % 40 as double)",
    "b": "cast(o_custkey % 30 as double)",
    "turned": "o_orderkey % 2 = 1",
}


@query(f"""
    with t as (select {s.columns_sql(SHAPES)} from orders)
    select a, b, turned, count(*) as n from t group by a, b, turned
""")
def exact_shapes(spark, folder):
    """Rows per exact shape; a line drawn the other way round is another shape."""
    start, end = geo.xy(F.col("a"), F.col("b")), geo.xy(F.col("b") + 1, F.col("a") + 1)
    shape = F.when(F.col("turned"), geo.line(F.array(end, start))).otherwise(
        geo.line(F.array(start, end))
    )
    rows = s.derive(table(spark, folder, "orders"), SHAPES).select("turned", shape.alias("g"))
    keyed = rows.groupBy(geo.shape_hash(F.col("g")).alias("key"), "g").agg(
        F.count("*").alias("n"), F.bool_and("turned").alias("turned")
    )
    first, last = geo.first_point(F.col("g")), F.get(F.col("g.parts")[0], F.lit(1))
    origin = F.when(F.col("turned"), last).otherwise(first)
    return keyed.select(
        origin["x"].alias("a"), origin["y"].alias("b"), "turned", "n"
    )
