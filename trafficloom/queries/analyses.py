"""Reports and release comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from trafficloom.functions.values import parse_number
from trafficloom.operators import analyses as ops
from trafficloom.queries import standins as s
from trafficloom.queries.registry import query, table
from trafficloom.queries.viewer import SHARE_SQL


@query(f"""
    with {s.FEATURES_SQL}
    select state, count(*) as sections from features where road_class = 'A' group by state
""")
def motorway_sections_per_state(spark, folder):
    return ops.sections_per_state(s.features(spark, folder), "A")


@query(f"""
    with {s.FEATURES_SQL}
    select source, round(quantile_cont(({SHARE_SQL})::double, 0.5), 6)
        as median_share
    from features where {SHARE_SQL} is not null group by source
""")
def median_heavy_share_per_source(spark, folder):
    return ops.median_heavy_share(s.features(spark, folder)).select(
        "source", F.round("median_share", 6).alias("median_share")
    )


@query(f"""
    with {s.SECTIONS_SQL}
    select source, count(*) filter (try_cast(kfz_text as double) = 0) as zeros
    from sections group by source
""")
def placeholder_zeros_per_source(spark, folder):
    return ops.placeholder_zeros(s.sections(spark, folder), parse_number(F.col("kfz_text")))


BOUNDS = {"A": 48000, "B": 45000, "L": 40000, "K": 35000, "G": 30000}


@query(f"""
    with {s.FEATURES_SQL}
    select station_id, road_class, dtv_kfz from features where dtv_kfz > case road_class
        {" ".join(f"when '{k}' then {v}" for k, v in BOUNDS.items())} end
""")
def count_outliers(spark, folder):
    return ops.outliers(s.features(spark, folder), BOUNDS).select(
        "station_id", "road_class", "dtv_kfz"
    )


@query("""
    select l_orderkey as station, l_quantity as value, count(*) as n from lineitem l
    where not exists (select 1 from orders o where o.o_orderkey = l.l_orderkey
        and cast(o.o_custkey % 50 + 1 as double) = l.l_quantity)
    group by 1, 2
""")
def values_not_known_yet(spark, folder):
    """A derived table brings something new where station and value do not both agree."""
    derived = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey as station", "l_quantity as value"
    )
    known = table(spark, folder, "orders").selectExpr(
        "o_orderkey as station", "cast(o_custkey % 50 + 1 as double) as value"
    )
    return (
        ops.new_values(derived, known, "station", "value")
        .groupBy("station", "value").agg(F.count("*").alias("n"))
    )


# Two releases: the later one lacks some stations, has some more, and moves a few.
OLD = "select o_orderkey as station, o_custkey as x, o_custkey % 7 as y, o_totalprice as value from orders where o_orderkey % 11 <> 0"
NEW = "select o_orderkey as station, o_custkey + (case when o_orderkey % 13 = 0 then 1 else 0 end) as x, o_custkey % 7 as y, o_totalprice * (1 + (o_orderkey % 21 - 9) / 100.0) as value from orders where o_orderkey % 17 <> 0"
COMPARED_SQL = f"""compared as (select coalesce(a.station, b.station) as station,
    case when b.station is null then 'removed' when a.station is null then 'added'
        when a.x <> b.x or a.y <> b.y then 'moved' else 'common' end as fate,
    a.value as old_value, b.value as new_value
    from ({OLD}) a full join ({NEW}) b on a.station = b.station)"""


def _compared(spark, folder):
    rows = table(spark, folder, "orders")
    old, new = (
        spark.sql(text.replace("from orders", "from {orders}"), orders=rows) for text in (OLD, NEW)
    )
    return ops.compare_releases(old, new, "station")


@query(f"with {COMPARED_SQL} select station, fate from compared")
def release_comparison(spark, folder):
    return _compared(spark, folder).select("station", "fate")


@query(f"""
    with {COMPARED_SQL}
    select fate, round(quantile_cont((new_value - old_value) / old_value * 100, 0.5), 6)
        as median_change
    from compared where old_value > 0 and new_value is not null group by fate
""")
def median_change_between_releases(spark, folder):
    return ops.median_change(_compared(spark, folder)).select(
        "fate", F.round("median_change", 6).alias("median_change")
    )


@query(f"""
    with {s.FEATURES_SQL}
    select station_id, source, road_class from features
    where level = 'bund' or road_class not in ('A', 'B')
""")
def federal_before_state(spark, folder):
    return ops.prefer_federal(s.features(spark, folder)).select(
        "station_id", "source", "road_class"
    )
