"""Shares, colours, labels and filters of the feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from trafficloom.functions import view
from trafficloom.operators import viewer as ops
from trafficloom.queries import standins as s
from trafficloom.queries.registry import query, table

SHARE_SQL = "coalesce(sv_anteil, case when dtv_kfz > 0 then dtv_sv / dtv_kfz * 100.0::double end)"


@query(f"""
    with {s.FEATURES_SQL}
    select station_id, round({SHARE_SQL}, 6) as heavy_share,
        case when dtv_sv is not null then case when dtv_kfz <> 0 then
            round(cast(dtv_sv / dtv_kfz * 100.0::double as decimal(38, 18)), 1)::double end
            else sv_anteil end as popup_share
    from features
""")
def heavy_vehicle_share(spark, folder):
    """Two precedences: the stated share for colours, the counted one beside the numbers."""
    return ops.with_shares(s.features(spark, folder)).select(
        "station_id", F.round("heavy_share", 6).alias("heavy_share"), "popup_share"
    )


def _index(value, stops):
    return " + ".join(f"cast({value} >= {x} as integer)" for x in stops)


def _channel(value, stops, colours, at):
    parts = [int(c[at : at + 2], 16) for c in colours]
    arms = [f"when {value} < {stops[0]} then {parts[0]}"]
    for i in range(len(stops) - 1):
        arms.append(
            f"when {value} < {stops[i + 1]} then floor({parts[i]}::double + "
            f"({parts[i + 1] - parts[i]})::double * (({value} - {stops[i]}) / "
            f"{stops[i + 1] - stops[i]}::double) + 0.5)"
        )
    number = f"case {' '.join(arms)} else {parts[-1]} end"
    return f"printf('%02x', cast({number} as integer))"


def _colour(value, stops, colours):
    mixed = " || ".join(_channel(value, stops, colours, at) for at in (1, 3, 5))
    return f"case when {value} is null then '#b4b4b4' else '#' || {mixed} end"


def _class(value, stops, labels):
    arms = " ".join(
        f"when {value} >= {x} then '{t}'" for x, t in reversed(list(zip(stops, labels)))
    )
    return f"case when {value} is null then 'keine Angabe' {arms} end"


def _colours_sql(colours):
    return f"""
    with {s.FEATURES_SQL}, shared as (select *, {SHARE_SQL} as share from features)
    select station_id, {_colour("dtv_kfz", view.DTV_STOPS, colours)} as dtv_colour,
        {_class("dtv_kfz", view.DTV_STOPS, view.DTV_LABELS)} as dtv_class,
        {_colour("share", view.SHARE_STOPS, colours)} as share_colour,
        {_class("share", view.SHARE_STOPS, view.SHARE_LABELS)} as share_class
    from shared"""


def _colours(spark, folder, accessible):
    rows = ops.with_colours(ops.with_shares(s.features(spark, folder)), accessible)
    return rows.select("station_id", "dtv_colour", "dtv_class", "share_colour", "share_class")


@query(_colours_sql(view.STANDARD))
def colour_classes(spark, folder):
    return _colours(spark, folder, False)


@query(_colours_sql(view.ACCESSIBLE))
def accessible_colour_classes(spark, folder):
    return _colours(spark, folder, True)


@query(f"""
    with flows as (select o_orderkey, case when o_orderkey % 9 = 0 then null
        else floor(o_totalprice * 100) end as flow from orders)
    select o_orderkey, round(flow / 365.0::double, 6) as daily,
        cast(floor(flow / 365.0::double + 0.5::double) as bigint) as shown,
        {_colour("(flow / 365.0::double)", view.DTV_STOPS, view.STANDARD)} as colour
    from flows
""")
def annual_flow_as_daily(spark, folder):
    flow = F.expr(
        "case when o_orderkey % 9 = 0 then null else cast(floor(o_totalprice * 100) as double) end"
    )
    rows = table(spark, folder, "orders").select("o_orderkey", flow.alias("flow"))
    daily = view.daily_from_annual(F.col("flow"))
    return rows.select(
        "o_orderkey", F.round(daily, 6).alias("daily"),
        view.shown_daily(F.col("flow")).alias("shown"),
        view.ramp_colour(daily, view.DTV_STOPS, view.STANDARD).alias("colour"),
    )


CLASS_SQL = "case road_class " + " ".join(
    f"when '{k}' then '{t}'" for k, t in view.CLASS_TEXT.items()
) + " else 'Klasse ' || road_class end"


@query(f"""
    with {s.FEATURES_SQL}
    select station_id,
        coalesce(nullif(name, ''), nullif(road_no, ''), road_class || '-Straße') as title,
        {CLASS_SQL} as class_text,
        {CLASS_SQL} || case when name <> '' and road_no <> '' then ' ' || road_no else '' end
            as class_line,
        case metric when '24h' then '24h-Zählung' else metric end as metric_label,
        case metric {" ".join(f"when '{k}' then '{t}'" for k, t in view.METRIC_TITLE.items())}
            else '' end as metric_title
    from (select * replace (coalesce(name, '') as name, coalesce(road_no, '') as road_no)
        from features)
""")
def popup_texts(spark, folder):
    return ops.with_texts(s.features(spark, folder)).select(
        "station_id", "title", "class_text", "class_line", "metric_label", "metric_title"
    )


@query(f"""
    with {s.FEATURES_SQL}
    select station_id, source from features where source in ('n1', 'n2', 'n3', 'n5', 'n8', 'n13')
        and coalesce(dtv_kfz, 0) >= 2000
""")
def active_sources_at_zoom(spark, folder):
    """The chosen sources' features that show at zoom 6.4."""
    chosen = ops.active_sources(
        s.features(spark, folder), ["n1", "n2", "n3", "n5", "n8", "n13"]
    )
    return ops.visible_at(chosen, 6.4).select("station_id", "source")
