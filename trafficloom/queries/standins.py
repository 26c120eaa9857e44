"""Traffic-like inputs derived from the benchmark tables, in Spark and in SQL.

The derivations below are written once, in the SQL both engines read; the operators under test
are not part of them.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficloom.functions import geometry as geo
from trafficloom.functions import roads
from trafficloom.functions.geometry import ZONES, series
from trafficloom.operators.grouping import backfill
from trafficloom.queries.registry import table

# ---------------------------------------------------------------------- raw sections

KFZ_TEXT = """case when o_orderkey % 10 = 0 then '0' when o_orderkey % 17 = 0 then 'k. A.'
    when o_orderkey % 23 = 0 then null
    else cast(cast(floor(o_totalprice / 10) as bigint) as string) || '.5' end"""
SV_TEXT = """case when o_custkey % 4 = 0 then '0' when o_custkey % 7 = 0 then null
    when o_custkey % 11 = 0 then ' '
    else cast(cast(floor(o_totalprice / 70) as bigint) as string) end"""
ROAD_TEXT = """case o_orderkey % 6
    when 0 then 'A ' || cast(o_custkey % 900 + 1 as string)
    when 1 then 'b' || cast(o_custkey % 900 + 1 as string)
    when 2 then ' L ' || cast(o_custkey % 900 + 1 as string)
    when 3 then 'K' || cast(o_custkey % 900 + 1 as string)
    when 4 then 'St ' || cast(o_custkey % 900 + 1 as string) else null end"""
CODE = "substr(o_orderpriority, 1, 1)"

# name -> expression over `orders`
SECTION = {
    "okey": "o_orderkey",
    "station_id": "cast(o_orderkey as string)",
    "kfz_text": KFZ_TEXT,
    "sv_text": SV_TEXT,
    "share": "case when o_orderkey % 5 = 0 then cast(o_custkey % 40 as double) + 0.25 end",
    "code": f"case when o_orderkey % 3 = 0 then ' ' || {CODE} || ' ' else {CODE} end",
    "road_no": ROAD_TEXT,
    "name": """case when o_orderkey % 4 = 0 then '' when o_orderkey % 4 = 1 then null
        else 'Knoten ' || cast(o_custkey as string) end""",
    "year": "cast(year(o_orderdate) as int)",
    "nr": "cast(o_custkey % 25 as int)",
    "source": "'n' || cast(o_custkey % 25 as string)",
    "state": "case when o_custkey % 25 = 7 then 'DE' else 'S' || cast(o_custkey % 16 as string) end",
    "metric": "case o_custkey % 3 when 0 then 'DTV' when 1 then 'DTVw' else '24h' end",
    "license": "'dl-de/by-2.0'",
    "e1": "cast(300000 + (o_orderkey * 7919) % 500000 as double)",
    "n1": "cast(5250000 + (o_orderkey * 104729) % 800000 as double)",
    "e2": "cast(300500 + (o_orderkey * 7919) % 500000 + o_orderkey % 3000 as double)",
    "n2": "cast(5249300 + (o_orderkey * 104729) % 800000 + o_orderkey % 1500 as double)",
}


def columns_sql(columns: Mapping[str, str]) -> str:
    return ", ".join(f"{e} as {n}" for n, e in columns.items())


def derive(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} as {n}" for n, e in columns.items()])


SECTIONS_SQL = f"sections as (select {columns_sql(SECTION)} from orders)"


def sections(spark: SparkSession, folder: str) -> DataFrame:
    return derive(table(spark, folder, "orders"), SECTION)


# ------------------------------------------------------------------------- catalogue

NATION = {
    "ord": "n_nationkey",
    "code": "'n' || cast(n_nationkey as string)",
    "status": """case n_nationkey % 5 when 3 then 'research' when 4 then 'blocked'
        else 'live' end""",
    "level": """case n_regionkey % 3 when 0 then 'land' when 1 then 'kommune'
        else 'bund' end""",
    "name": "n_name",
    "state": "substr(r_name, 1, 2)",
    "kind": "'csv'",
    "year": "cast(2000 + n_nationkey as int)",
    "license": "'dl-de/by-2.0'",
    "metric": "'DTV'",
}
CATALOGUE_SQL = (
    f"catalogue as (select {columns_sql(NATION)} from nation "
    "join region on n_regionkey = r_regionkey)"
)


def catalogue(spark: SparkSession, folder: str) -> DataFrame:
    both = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.expr("n_regionkey = r_regionkey")
    )
    return derive(both, NATION)


def levels(spark: SparkSession, folder: str) -> dict[str, str]:
    """The hand-kept catalogue as the mapping sees it: code to level, one entry per nation."""
    rows = catalogue(spark, folder).select("code", "level").collect()
    return {r["code"]: r["level"] for r in rows}


# --------------------------------------------------------------------- reprojection SQL


def utm_sql(
    source: str, out: str, points: Sequence[tuple[str, str, str, str]], srid: int = 25832
) -> str:
    """CTEs adding lon/lat for every ``(x, y, lon, lat)`` of the CTE ``source``."""
    z, s = ZONES[srid], series(ZONES[srid])
    scale = z.scale * s.rectifying

    def step(name: str, source: str, body) -> str:
        cells = ", ".join(body(i, p) for i, p in enumerate(points))
        return f"{name} as (select *, {cells} from {source})"

    def grid(i, p):
        return (
            f"{p[1]} / {scale!r}::double as g{i}, "
            f"({p[0]} - {z.false_easting!r}::double) / {scale!r}::double as h{i}"
        )

    def conformal(i, p):
        xi = "".join(
            f" - {b!r}::double * sin({2 * j} * g{i}) * cosh({2 * j} * h{i})"
            for j, b in enumerate(s.beta, 1)
        )
        eta = "".join(
            f" - {b!r}::double * cos({2 * j} * g{i}) * sinh({2 * j} * h{i})"
            for j, b in enumerate(s.beta, 1)
        )
        return f"g{i}{xi} as q{i}, h{i}{eta} as r{i}"

    def angles(i, p):
        return f"asin(sin(q{i}) / cosh(r{i})) as c{i}, atan2(sinh(r{i}), cos(q{i})) as d{i}"

    def latitude(i, p):
        phi = "".join(
            f" + {d!r}::double * sin({2 * j} * c{i})" for j, d in enumerate(s.delta, 1)
        )
        lam = math.radians(z.meridian)
        return f"c{i}{phi} as phi{i}, d{i} + {lam!r}::double as lam{i}"

    steps = [
        step(f"{out}_1", source, grid),
        step(f"{out}_2", f"{out}_1", conformal),
        step(f"{out}_3", f"{out}_2", angles),
        step(f"{out}_4", f"{out}_3", latitude),
    ]
    last = f"{out}_4"
    if z.helmert:
        steps += helmert_sql(last, out, points, z)
        last = f"{out}_7"
    steps.append(
        step(out, last, lambda i, p: f"degrees(lam{i}) as {p[2]}, degrees(phi{i}) as {p[3]}")
    )
    return ", ".join(steps)


def helmert_sql(source: str, out: str, points, z) -> list[str]:
    """Geodetic to earth-centred, seven parameters, and back on WGS 84."""
    f = 1.0 / z.inverse_flattening
    e2 = f * (2 - f)
    dx, dy, dz, rx, ry, rz, ppm = z.helmert
    rx, ry, rz = (math.radians(v / 3600) for v in (rx, ry, rz))
    m = 1 + ppm * 1e-6
    a = geo.WGS84[0]
    wf = 1.0 / geo.WGS84[1]
    w2 = wf * (2 - wf)
    b = a * math.sqrt(1 - w2)
    each = range(len(points))
    first = ", ".join(
        f"{z.semi_major!r}::double / sqrt(1 - {e2!r}::double * sin(phi{i}) * sin(phi{i})) as nn{i}"
        for i in each
    )
    second = ", ".join(
        f"nn{i} * cos(phi{i}) * cos(lam{i}) as ex{i}, nn{i} * cos(phi{i}) * sin(lam{i}) as ey{i}, "
        f"nn{i} * {1 - e2!r}::double * sin(phi{i}) as ez{i}"
        for i in each
    )
    third = ", ".join(
        f"{dx}::double + {m!r}::double * (ex{i} - {rz!r}::double * ey{i} + {ry!r}::double * ez{i}) as sx{i}, "
        f"{dy}::double + {m!r}::double * ({rz!r}::double * ex{i} + ey{i} - {rx!r}::double * ez{i}) as sy{i}, "
        f"{dz}::double + {m!r}::double * ({-ry!r}::double * ex{i} + {rx!r}::double * ey{i} + ez{i}) as sz{i}"
        for i in each
    )
    theta = ", ".join(
        f"atan2(sz{i} * {a!r}::double, sqrt(sx{i} * sx{i} + sy{i} * sy{i}) * {b!r}::double) as th{i}"
        for i in each
    )
    fourth = ", ".join(
        f"atan2(sz{i} + {w2 / (1 - w2) * b!r}::double * pow(sin(th{i}), 3), "
        f"sqrt(sx{i} * sx{i} + sy{i} * sy{i}) - {w2 * a!r}::double * pow(cos(th{i}), 3)) as phi{i}, "
        f"atan2(sy{i}, sx{i}) as lam{i}"
        for i in each
    )
    gone = ", ".join(f"phi{i}, lam{i}" for i in each)
    return [
        f"{out}_5 as (select *, {second} from (select *, {first} from {source}))",
        f"{out}_6 as (select * exclude ({gone}), {theta} from "
        f"(select *, {third} from {out}_5))",
        f"{out}_7 as (select *, {fourth} from {out}_6)",
    ]


# -------------------------------------------------------------------- canonical features

CLASSES = {"1": "A", "2": "B", "3": "L", "4": "K"}

CLEAN_SQL = """
    nullif(kfz_n, 0) as dtv_kfz,
    case when nullif(kfz_n, 0) is null and sv_n = 0 then null else sv_n end as dtv_sv"""

FEATURES_SQL = f"""{SECTIONS_SQL}, {CATALOGUE_SQL},
{utm_sql("sections", "placed", [("e1", "n1", "lon1", "lat1"), ("e2", "n2", "lon2", "lat2")])},
numbered as (select *,
    cast(round_even(try_cast(kfz_text as double), 0) as bigint) as kfz_n,
    cast(round_even(try_cast(sv_text as double), 0) as bigint) as sv_n from placed),
features as (select {CLEAN_SQL}, share as sv_anteil, p.metric, p.year,
    case trim(p.code) when '1' then 'A' when '2' then 'B' when '3' then 'L' when '4' then 'K'
        else 'G' end as road_class,
    p.road_no, p.name, p.station_id, p.state, p.source, c.level, p.license,
    nr % 2 = 1 as is_point, lon1, lat1,
    case when nr % 2 = 1 then lon1 else lon2 end as lon2,
    case when nr % 2 = 1 then lat1 else lat2 end as lat2, okey
    from numbered p left join catalogue c on p.source = c.code)"""


def raw_features(spark: SparkSession, folder: str) -> DataFrame:
    """An interim table of an older build: no level yet, counts still texts."""
    raw = sections(spark, folder)
    moved = geo.reproject_columns(raw, 25832, "e1", "n1", "lon1", "lat1")
    moved = geo.reproject_columns(moved, 25832, "e2", "n2", "lon2", "lat2")
    start = geo.xy(F.col("lon1"), F.col("lat1"))
    end = geo.xy(F.col("lon2"), F.col("lat2"))
    shape = F.when(
        F.col("nr") % 2 == 1, geo.point(F.col("lon1"), F.col("lat1"))
    ).otherwise(geo.line(F.array(start, end)))
    rule = roads.class_by_code(CLASSES, "G")
    return moved.select(
        F.col("kfz_text").alias("dtv_kfz"),
        F.col("sv_text").alias("dtv_sv"),
        F.col("share").alias("sv_anteil"),
        "metric",
        "year",
        rule(F.col("code")).alias("road_class"),
        "road_no",
        "name",
        "station_id",
        "state",
        "source",
        "license",
        shape.alias("geometry"),
    )


def features(spark: SparkSession, folder: str) -> DataFrame:
    return backfill(raw_features(spark, folder), levels(spark, folder))


SCALARS = (
    "dtv_kfz", "dtv_sv", "sv_anteil", "metric", "year", "road_class", "road_no", "name",
    "station_id", "state", "source", "level", "license",
)


def flat(df: DataFrame) -> DataFrame:
    """Canonical columns plus first vertex and number of vertices, for comparison."""
    g = F.col("geometry")
    return df.select(
        *SCALARS,
        g["kind"].alias("kind"),
        g["srid"].alias("srid"),
        F.round(geo.first_point(g)["x"], 6).alias("x0"),
        F.round(geo.first_point(g)["y"], 6).alias("y0"),
        geo.point_count(g).alias("vertices"),
    )
