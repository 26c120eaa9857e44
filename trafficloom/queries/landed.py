"""Every source plan on layers derived from the benchmark tables, with the real column names."""

from __future__ import annotations

from pyspark.sql import functions as F

from trafficloom.catalogue_data import BY_CODE, LEVEL_OF, live_codes
from trafficloom.functions import geometry as geo
from trafficloom.model import ORDINAL
from trafficloom.operators import grouping
from trafficloom.operators.canonical import where_they_lie
from trafficloom.operators.catalogue import stats_of_points
from trafficloom.operators.tiles import combine
from trafficloom.queries import standins as s
from trafficloom.queries.joins import (
    EDGES_SQL,
    FIRSTS_SQL,
    HOT,
    ORDER_SQL,
    _choice,
    edges,
    lines,
    node_sql,
)
from trafficloom.queries.registry import QUERIES, Run, query, table
from trafficloom.sources import municipal, readers, states

FEATURES: dict[str, Run] = {}  # canonical features of every source


def source(sql):
    """Register a source's plan: its flat form is compared, its features can be merged."""

    def keep(run: Run) -> Run:
        FEATURES[run.__name__.removeprefix("source_")] = run

        def flat(spark, folder):
            return s.flat(run(spark, folder))

        flat.__name__ = run.__name__
        query(sql)(flat)
        return run

    return keep


TEXT = "cast(cast(floor(o_totalprice / 10) as bigint) as string) || '.0'"
KFZ = "case when o_orderkey % 10 = 0 then 0.0 else floor(o_totalprice / 5) / 2.0 end"
SV = "case when o_custkey % 4 = 0 then 0.0 when o_custkey % 7 = 0 then null else floor(o_totalprice / 70) end"
CODE = "substr(o_orderpriority, 1, 1)"
CLASS = f"case {CODE} when '1' then 'A' when '2' then 'B' when '3' then 'L' when '4' then 'K' else 'X' end"
LON = "cast(6.0 + (o_orderkey * 7919 % 900000) / 100000.0 as double)"
LAT = "cast(47.0 + (o_orderkey * 104729 % 800000) / 100000.0 as double)"
EAST = "cast(300000 + (o_orderkey * 7919) % 500000 as double)"
NORTH = "cast(5250000 + (o_orderkey * 104729) % 800000 as double)"


def shaped(df, columns, srid, x=EAST, y=NORTH, point=False, keep=()):
    """A landed layer: the given columns and a line (or point) starting at x, y."""
    start = geo.xy(F.expr(x), F.expr(y))
    end = geo.xy(F.expr(x) + 0.01, F.expr(y) + 0.01)
    shape = geo.point(F.expr(x), F.expr(y), srid) if point else geo.line(F.array(start, end), srid)
    return df.select(
        *[F.expr(e).alias(n) for n, e in columns.items()], *keep, shape.alias("geometry")
    )


def cells(columns):
    return ", ".join(f'{e} as "{n}"' for n, e in columns.items())


def canonical(
    code, source, kfz, sv="null", share="null", road_class="'G'", road_no="null", name="null",
    station="null", x="lon", y="lat", year=None, point=False,
):
    """SQL of the canonical rows of one source out of the CTE ``source``."""
    c = BY_CODE[code]

    def count(e):
        return f"cast(round_even(try_cast({e} as double), 0) as bigint)"

    return f"""select nullif({count(kfz)}, 0) as dtv_kfz,
        case when nullif({count(kfz)}, 0) is null and {count(sv)} = 0 then null
            else {count(sv)} end as dtv_sv,
        try_cast({share} as double) as sv_anteil, '{c.metric}' as metric,
        cast({year or c.year} as integer) as year, {road_class} as road_class,
        cast({road_no} as varchar) as road_no, cast({name} as varchar) as name,
        cast({station} as varchar) as station_id, '{c.state}' as state, '{code}' as source,
        '{c.level}' as level, '{c.license}' as license,
        '{"Point" if point else "LineString"}' as kind, 4326 as srid,
        round({x}, 6) as x0, round({y}, 6) as y0, {1 if point else 2} as vertices
    from {source}"""


def by_code(column, default, **codes):
    arms = " ".join(f"when '{k}' then '{v}'" for k, v in codes.items())
    return f"case {column} {arms} else '{default}' end"


ABLK = {"A": "A", "B": "B", "L": "L", "K": "K"}


def first_letter(column, allowed, default):
    return f"coalesce(nullif(regexp_extract(upper(trim({column})), '^[{allowed}]'), ''), '{default}')"


def orders(spark, folder):
    return table(spark, folder, "orders")


# ------------------------------------------------------------------------------- states

BY = {
    "Straßenklasse": f"case {CODE} when '1' then 'A' when '2' then ' B' when '3' then 'St' "
    "when '4' then 'K ' else 'X' end",
    "Straße": s.ROAD_TEXT,
    "Zählstelle": "cast(o_orderkey as string)",
    "DTV_Kfz": KFZ,
    "DTV_SV": SV,
    "Link": "'x'",
}


@source(f"""
    with t as (select {cells(BY)}, {LON} as lon, {LAT} as lat from orders)
    {canonical("by", "t", '"DTV_Kfz"', '"DTV_SV"',
        road_class=by_code('trim("Straßenklasse")', "L", A="A", B="B", St="L", K="K"),
        road_no='"Straße"', station='"Zählstelle"')}
""")
def source_by(spark, folder):
    layer = shaped(orders(spark, folder), BY, 4326, LON, LAT)
    return states.by({"sections": layer})


BE = {
    "link_id": HOT.format(k="o_orderkey"),
    "strklasse": f"case {CODE} when '1' then 'A' when '2' then 'B' when '3' then ' L' "
    "when '4' then 'G' else 'N' end",
    "str_bez": "case when o_orderkey % 3 = 0 then '' else 'B' || cast(o_custkey as string) end",
    "dtvw_kfz": "cast(floor(o_totalprice / 10) as bigint)",
}


@source(f"""
    with t as (select {cells(BE)}, {LON} as lon, {LAT} as lat from orders),
    v as (select {HOT.format(k="l_orderkey")} as link_id,
        cast(l_quantity * l_linenumber as bigint) as lkw, {ORDER_SQL} from lineitem),
    f as (select link_id, lkw from (select *, row_number() over
        (partition by link_id order by {ORDER_SQL}) as rn from v) where rn = 1),
    j as (select t.*, f.lkw from t left join f on t.link_id is not distinct from f.link_id)
    {canonical("be", "j", "dtvw_kfz", "lkw", road_no="nullif(str_bez, '')", station="link_id",
        road_class=by_code("strklasse", "G", A="A", B="B", L="L", K="K", G="G"))}
""")
def source_be(spark, folder):
    trucks = lines(spark, folder).select(
        F.expr(HOT.format(k="l_orderkey")).alias("link_id"),
        F.expr("cast(l_quantity * l_linenumber as bigint)").alias("dtvw_lkw"), ORDINAL,
    )
    layer = shaped(orders(spark, folder), BE, 4326, LON, LAT)
    return states.be({"sections": layer, "trucks": trucks})


BB = {
    "klasse": CLASS,
    "strasse": s.ROAD_TEXT,
    "zaehlstellennummer": "cast(o_orderkey as string)",
    "KFZ": f"case when o_orderkey % 13 = 0 then 'k. A.' else {TEXT} end",
    "DTV_SV": s.SV_TEXT,
    "SV_KFZ": "case when o_orderkey % 4 = 0 then '4,5' else cast(o_custkey % 30 as string) || '.5' end",
    "jahr": "'2021'",
}


@source(f"""
    with t as (select {cells(BB)}, {EAST} as e, {NORTH} as n from orders),
    {s.utm_sql("t", "p", [("e", "n", "lon", "lat")], 25833)}
    {canonical("bb", "p", '"KFZ"', '"DTV_SV"', '"SV_KFZ"', by_code("klasse", "L", **ABLK),
        "strasse", station="zaehlstellennummer")}
""")
def source_bb(spark, folder):
    return states.bb({"sections": shaped(orders(spark, folder), BB, 25833)})


HH = {
    "id": "o_orderkey",
    "dtv": "cast(floor(o_totalprice / 10) as bigint)",
    "sv": "cast(o_custkey % 30 as int)",
    "strassenklasse": "case when o_orderstatus = 'F' then 'BAB ' when o_custkey % 5 = 0 then 'X' else 'HVS' end",
}


@source(f"""
    with t as (select {cells(HH)}, {EAST} as e, {NORTH} as n from orders),
    {s.utm_sql("t", "p", [("e", "n", "lon", "lat")], 25832)}
    {canonical("hh", "p", "dtv", share="sv", station="id",
        road_class=by_code("trim(strassenklasse)", "B", BAB="A", HVS="B"))}
""")
def source_hh(spark, folder):
    rows = orders(spark, folder)
    motorway = F.col("o_orderstatus") == "F"
    return states.hh(
            {
                "main_roads": shaped(rows.filter(~motorway), HH, 25832),
                "motorways": shaped(rows.filter(motorway), HH, 25832),
            }
        )


NI = {
    "strkl": CLASS,
    "strbez": s.ROAD_TEXT,
    "zstnr": "cast(o_orderkey as string)",
    "dtv21": KFZ,
    "dtvsv21": SV,
}


@source(f"""
    with t as (select {cells(NI)}, {EAST} as e, {NORTH} as n from orders),
    {s.utm_sql("t", "p", [("e", "n", "lon", "lat")], 25832)}
    {canonical("ni", "p", "dtv21", "dtvsv21", road_class=by_code("strkl", "L", G="G", **ABLK),
        road_no="strbez", station="zstnr")}
""")
def source_ni(spark, folder):
    return states.ni({"sections": shaped(orders(spark, folder), NI, 25832)})


NW = {
    "STRKL": CLASS,
    "STRBEZ": s.ROAD_TEXT,
    "ZSTNR": "cast(o_orderkey as string)",
    "DTVKFZA": KFZ,
    "DTVKFZW": "o_totalprice",
    "DTVSVA": SV,
}


@source(f"""
    with t as (select {cells(NW)}, {EAST} as e, {NORTH} as n from orders),
    {s.utm_sql("t", "p", [("e", "n", "lon", "lat")], 25832)}
    {canonical("nw", "p", '"DTVKFZA"', '"DTVSVA"', road_class=by_code('"STRKL"', "L", **ABLK),
        road_no='"STRBEZ"', station='"ZSTNR"')}
""")
def source_nw(spark, folder):
    return states.nw({"sections": shaped(orders(spark, folder), NW, 25832)})


SN = {
    "klasse": f"case {CODE} when '1' then 'A' when '2' then 'B' when '3' then 'S' when '4' then 'K' else 'X' end",
    "strasse": s.ROAD_TEXT,
    "nummer": "cast(o_orderkey as string)",
    "dtv_kfzges": s.KFZ_TEXT,
    "dtv_sv": s.SV_TEXT,
    "sv_kfz": "cast(o_custkey % 30 as string)",
    "bemerkung": "'x'",
}


@source(f"""
    with t as (select {cells(SN)}, {EAST} as e, {NORTH} as n from orders),
    {s.utm_sql("t", "p", [("e", "n", "lon", "lat")], 25833)}
    {canonical("sn", "p", "dtv_kfzges", "dtv_sv", "sv_kfz",
        by_code("klasse", "L", A="A", B="B", S="L", L="L", K="K"), "strasse", station="nummer")}
""")
def source_sn(spark, folder):
    return states.sn({"sections": shaped(orders(spark, folder), SN, 25833)})


NET = {
    "vnk": """case l_linenumber when 1 then cast(l_partkey as string) || '.0'
        when 2 then ' ' || cast(l_partkey as string) when 3 then 'x'
        else cast(l_partkey as string) end""",
    "nnk": "cast(l_suppkey as string)",
}
ST = {
    "VonNK": "case when o_orderkey % 50 = 0 then null else cast(o_orderkey % 2000 as int) end",
    "NachNK": "cast(o_custkey % 100 as int)",
    "Str": s.ROAD_TEXT,
    "TKZST": "cast(o_orderkey as string)",
    "DTV": TEXT,
    "DTVSV": s.SV_TEXT,
}
LINE_EAST = "cast(300000 + (l_orderkey * 7919 + l_linenumber) % 500000 as double)"
LINE_NORTH = "cast(5250000 + (l_orderkey * 104729 + l_suppkey) % 800000 as double)"
# Network layers in their order: motorways, federal, state and district roads.
NET_LAYER = """case when l_returnflag = 'A' then 0 when l_returnflag = 'N' then 1
    when l_linestatus = 'F' then 2 else 3 end"""


@source(f"""
    with n as (select {cells(NET)}, {LINE_EAST} as e, {LINE_NORTH} as n, {ORDER_SQL} from lineitem),
    nk as (select *, {node_sql("vnk")} || '_' || {node_sql("nnk")} as k from n),
    nf as (select k, e, n from (select *, row_number() over (partition by k
        order by {NET_LAYER}, {ORDER_SQL}) as rn from nk) where rn = 1),
    v as (select {cells(ST)}, o_orderkey from orders),
    vf as (select * from (select *, row_number() over (partition by k order by o_orderkey) as rn
        from (select *, {node_sql('"VonNK"')} || '_' || {node_sql('"NachNK"')} as k from v))
        where rn = 1),
    j as (select vf.*, e, n as nn from nf join vf on nf.k = vf.k),
    {s.utm_sql("j", "p", [("e", "nn", "lon", "lat")], 25832)}
    {canonical("st", "p", '"DTV"', '"DTVSV"', road_class=first_letter('"Str"', "ABLK", "L"),
        road_no='"Str"', station='"TKZST"')}
""")
def source_st(spark, folder):
    rows = lines(spark, folder).withColumn("layer", F.expr(NET_LAYER))
    net = {
        f"net_{name}": shaped(
            rows.filter(F.col("layer") == at), NET, 25832, LINE_EAST, LINE_NORTH, keep=[ORDINAL],
        )
        for at, name in enumerate(states.NETWORK_LAYERS)
    }
    values = orders(spark, folder).select(
        *[F.expr(e).alias(n) for n, e in ST.items()], F.col("o_orderkey").alias(ORDINAL)
    )
    return states.st({**net, "values": values})


TH = {
    "zst_nr": "cast(l_orderkey as string)",
    "von_stat": "case when l_quantity < 5 then null else cast(l_linenumber as string) end",
    "bis_stat": "cast(l_suppkey % 3 as string)",
}
TH_ROAD = {
    "str_name": "'B ' || cast(l_suppkey as string)",
    "str_klasse": "case l_linenumber when 1 then 'A' when 2 then 'B ' when 3 then 'L' when 4 then 'K' else 'S' end",
}


@source(f"""
    with t as (select {cells({**TH, **TH_ROAD})}, {LINE_EAST} as e, {LINE_NORTH} as n,
        l_partkey, l_quantity, {ORDER_SQL} from lineitem),
    v as (select zst_nr, von_stat, bis_stat, l_partkey as kfz, l_quantity as sv from (select *,
        row_number() over (partition by zst_nr, von_stat, bis_stat order by {ORDER_SQL}) as rn
        from t) where rn = 1),
    j as (select t.zst_nr, str_name, str_klasse, e, t.n as nn, v.kfz, v.sv from t left join v
        on t.zst_nr = v.zst_nr and t.von_stat is not distinct from v.von_stat
        and t.bis_stat = v.bis_stat),
    {s.utm_sql("j", "p", [("e", "nn", "lon", "lat")], 25832)}
    {canonical("th", "p", "kfz", "sv", road_class=by_code("trim(str_klasse)", "L", **ABLK),
        road_no="str_name", station="zst_nr")}
""")
def source_th(spark, folder):
    rows = lines(spark, folder)
    sections = shaped(rows, {**TH, **TH_ROAD}, 25832, LINE_EAST, LINE_NORTH)
    values = rows.select(
        *[F.expr(e).alias(n) for n, e in TH.items()],
        F.expr("cast(l_partkey as string)").alias("dtv_kfz"),
        F.expr("cast(l_quantity as string)").alias("dtv_sv"), ORDINAL,
    )
    return states.th({"sections": sections, "values": values})


BW = {
    "klasse": f"case when o_orderkey % 8 = 0 then null else ' ' || {CLASS} end",
    "nummer": "cast(o_custkey as string) || ' '",
    "svznr": "'00' || cast(o_orderkey as string)",
    "DTV2024": s.KFZ_TEXT,
    "DTVSV": s.SV_TEXT,
    "gpsx1": f"case when o_orderkey % 9 = 0 then '' else cast({LON} as string) end",
    "gpsy1": f"case when o_orderkey % 11 = 0 then null else cast({LAT} as string) end",
}


@source(f"""
    with t as (select {cells(BW)}, try_cast(gpsx1 as double) as lon,
        try_cast(gpsy1 as double) as lat from orders),
    k as (select * from t where lon is not null and lat is not null)
    {canonical("bw", "k", '"DTV2024"', '"DTVSV"', station="svznr", point=True,
        road_class=by_code("trim(klasse)", "L", **ABLK),
        road_no="trim(klasse) || ' ' || trim(nummer)")}
""")
def source_bw(spark, folder):
    stations = orders(spark, folder).select(*[F.expr(e).alias(n) for n, e in BW.items()])
    return states.bw({"stations": stations})


SL = {"Str": s.ROAD_TEXT, "TKZST": "cast(o_orderkey as string)", "DTV": TEXT, "DTVSV": s.SV_TEXT}


@source(f"""
    with t as (select {cells(SL)}, {LON} as lon, {LAT} as lat from orders)
    {canonical("sl", "t", '"DTV"', '"DTVSV"', road_class=first_letter('"Str"', "ABLK", "L"),
        road_no='"Str"', station='"TKZST"', point=True)}
""")
def source_sl(spark, folder):
    layer = shaped(orders(spark, folder), SL, 4326, LON, LAT, point=True)
    return states.sl({"stations": layer})


BAST = {
    "Str": s.ROAD_TEXT,
    "TKZST": "cast(o_orderkey as string)",
    "X_Koordinate": f"case when o_orderkey % 9 = 0 then null else {EAST} end",
    "Y_Koordinate": f"case when o_orderkey % 9 = 0 then null else {NORTH} end",
    "DTV": KFZ,
    "DTVSV": SV,
}


@source(f"""
    with t as (select {cells(BAST)} from orders),
    k as (select * from t where "X_Koordinate" is not null),
    {s.utm_sql("k", "p", [('"X_Koordinate"', '"Y_Koordinate"', "lon", "lat")], 25832)}
    {canonical("bast", "p", '"DTV"', '"DTVSV"', road_class=first_letter('"Str"', "AB", "A"),
        road_no='"Str"', station='"TKZST"', point=True)}
""")
def source_bast(spark, folder):
    rows = orders(spark, folder)
    picked = [F.expr(e).alias(n) for n, e in BAST.items()]
    motorway = F.col("o_orderstatus") == "F"
    sheets = {
        "motorways": rows.filter(motorway).select(*picked),
        "federal_roads": rows.filter(~motorway).select(*picked),
    }
    return states.bast(sheets)


# ---------------------------------------------------------------------------- municipal

GK_X = "cast(2540000 + (NO * 7919) % 60000 as double)"
GK_Y = "cast(5610000 + (NO * 104729) % 60000 as double)"


@source(f"""
    with {EDGES_SQL}, picked as (select NO, {GK_X} as e, {GK_Y} as n,
        coalesce({_choice("and", "value")}, {_choice("or", "value")}) as kfz,
        coalesce({_choice("and", "year")}, {_choice("or", "year")}) as y from edges),
    k as (select * from picked where y is not null),
    {s.utm_sql("k", "p", [("e", "n", "lon", "lat")], 31466)}
    {canonical("koeln", "p", "kfz", name="'Str ' || NO", station="NO", year="y")}
""")
def source_koeln(spark, folder):
    rows = edges(spark, folder)
    start = geo.xy(F.expr(GK_X), F.expr(GK_Y))
    end = geo.xy(F.expr(GK_X) + 100, F.expr(GK_Y))
    layer = rows.withColumns(
        {
            "STR_NAME": F.expr("'Str ' || cast(NO as string)"),
            "geometry": geo.line(F.array(start, end), 31466),
        }
    )
    return municipal.koeln({"edges": layer})


# Shapes that many rows share.
CITY_LON = "cast(6.0 + {k} % 4000 / 8192.0 as double)"
CITY_LAT = "cast(51.0 + {k} % 3 as double)"
DUS = {
    "_uuid": "'u' || cast(o_orderkey as string)",
    "strasse": "case o_orderkey % 4 when 0 then 'Autobahn A' || cast(o_custkey as string) when 1 then 'B 8a Nord' "
    "when 2 then 'Am K 12' else null end",
    "belastung_gesamt_5j": "case when o_orderkey % 3 = 0 then null else o_totalprice end",
    "zeitraum_5j": "'2020 - ' || cast(year(o_orderdate) as string)",
    "belastung_gesamt_10j": "case when o_orderkey % 12 = 0 then null else o_totalprice + 1 end",
    "zeitraum_10j": "'2015 - 2024 '",
}
DUS_LINE = {
    "belastung_gesamt_5j": "case when l_linenumber = 4 then null else l_quantity / 2 end",
    "zeitraum_5j": "'2020 - 2024'",
    "belastung_gesamt_10j": "case when l_linenumber = 4 and l_suppkey % 2 = 0 then null else l_quantity end",
    "zeitraum_10j": "'2015 - 2024'",
}
STREET_ROAD = r"\b([ABLK])\s?(\d{1,4})\b"


@source(f"""
    with t as (select l_orderkey % 4000 as a, l_orderkey % 3 as b, coalesce(
        {DUS_LINE["belastung_gesamt_5j"]}, {DUS_LINE["belastung_gesamt_10j"]}) as value,
        {ORDER_SQL} from lineitem), {FIRSTS_SQL.format(keys="a, b")},
    o as (select {cells(DUS)}, o_orderkey, {CITY_LON.format(k="o_orderkey")} as lon,
        {CITY_LAT.format(k="o_orderkey")} as lat, sv from orders left join sums
        on o_orderkey % 4000 = sums.a and o_orderkey % 3 = sums.b),
    k as (select *, coalesce(belastung_gesamt_5j, belastung_gesamt_10j) as kfz,
        regexp_extract(case when belastung_gesamt_5j is not null then zeitraum_5j
            else zeitraum_10j end, '(\\d{{4}})\\s*$', 1) as y,
        nullif(regexp_extract(strasse, '{STREET_ROAD}', 1), '') as klass,
        regexp_extract(strasse, '{STREET_ROAD}', 2) as num from o)
    {canonical("duesseldorf", "k where kfz is not null", "kfz", "sv",
        road_class="coalesce(klass, 'G')",
        road_no="case when klass is not null then klass || ' ' || num end", name="strasse",
        station="_uuid", year="y")}
""")
def source_duesseldorf(spark, folder):
    base = shaped(
        orders(spark, folder), DUS, 4326,
        CITY_LON.format(k="o_orderkey"), CITY_LAT.format(k="o_orderkey"),
    )
    heavy = {
        name: shaped(
            lines(spark, folder).filter(F.col("l_returnflag") == flag), DUS_LINE, 4326,
            CITY_LON.format(k="l_orderkey"), CITY_LAT.format(k="l_orderkey"), keep=[ORDINAL],
        )
        for name, flag in zip(municipal.DUESSELDORF_HEAVY, "ANR")
    }
    return municipal.duesseldorf({"sections": base, **heavy})


FRA = {
    "str_nr": "cast(o_orderkey % 5000 as int)",
    "mittl_bel": "case when o_orderkey % 17 = 0 then null when o_orderkey % 11 = 0 then 0.0 "
    "else floor(o_totalprice / 5) / 2.0 end",
    "str_name": "case o_orderkey % 4 when 0 then 'A ' || cast(o_custkey % 999 as string) when 1 then 'B 40a' "
    "when 2 then 'Nahe L' || cast(o_custkey % 99 as string) || ' Süd' else 'Kaiserstraße' end",
    "zaehldatum": "case when o_orderkey % 13 = 0 then null else o_orderdate end",
}
SUFFIX_ROAD = r"\b([ABLK])\s?(\d{1,4}[a-z]?)\b"


@source(f"""
    with t as (select l_orderkey % 5000 as nr, case when l_linenumber = 4 then null
        else l_quantity / 2 end as value, l_linestatus as l_returnflag_, {ORDER_SQL} from lineitem),
    firsts as (select * from (select *, row_number() over (partition by nr, l_linestatus
        order by {ORDER_SQL}) as rn from t) where rn = 1),
    sums as (select nr, case when count(value) > 0 then sum(value) end as sv from firsts group by nr),
    o as (select {cells(FRA)}, {EAST} as e, {NORTH} as n from orders),
    k as (select o.*, sums.sv, year(zaehldatum) as y,
        nullif(regexp_extract(str_name, '{SUFFIX_ROAD}', 1), '') as klass,
        regexp_extract(str_name, '{SUFFIX_ROAD}', 2) as num
        from o left join sums on o.str_nr = sums.nr
        where mittl_bel is not null and zaehldatum is not null),
    {s.utm_sql("k", "p", [("e", "n", "lon", "lat")], 25832)}
    {canonical("frankfurt", "p", "mittl_bel", "sv", road_class="coalesce(klass, 'G')",
        road_no="case when klass is not null then klass || ' ' || num end", name="str_name",
        station="str_nr", year="y")}
""")
def source_frankfurt(spark, folder):
    base = shaped(orders(spark, folder), FRA, 25832)
    heavy = {
        name: lines(spark, folder).filter(F.col("l_linestatus") == flag).select(
            F.expr("cast(l_orderkey % 5000 as int)").alias("str_nr"),
            F.expr("case when l_linenumber = 4 then null else l_quantity / 2 end")
            .alias("mittl_bel"),
            ORDINAL,
        )
        for name, flag in zip(municipal.FRANKFURT_HEAVY, "OF")
    }
    return municipal.frankfurt({"sections": base, **heavy})


# A station per user and event type; blocks by event number, some of them empty.
SHEET_KEY = "user_id * 10 + length(event_type)"
STATION_NAME = """case nr % 3 when 0 then 'B' || cast(nr as string) || '_Ulmerstraße_88212_Ravensburg'
    when 1 then 'Markdorferstraße_L ' || cast(nr as string) || '_88213_Ravensburg'
    else 'Eywiesenstraße_Gartenstraße_88212_Weingarten' end"""


def _cell(n, what):
    return f"max(case when event_id % 4 = {n - 1} then {what} end)"


SHEET = {}
for _n in (1, 2, 3, 4):
    SHEET[f"kfz_{_n}"] = f"cast({_cell(_n, 'floor(value * 100)')} as string)"
    SHEET[f"sv_{_n}"] = f"cast({_cell(_n, 'floor(value * 3)')} as string)"
    SHEET[f"datum_{_n}"] = f"substr(cast({_cell(_n, 'ts')} as string), 1, 10)"


def _town_sql(code):
    long = " union all ".join(
        f"select nr, {n} as block, kfz_{n} as kfz, sv_{n} as sv, datum_{n} as datum from sheet "
        f"where kfz_{n} is not null and datum_{n} is not null"
        for n in (1, 2, 3, 4)
    )
    town = BY_CODE[code].name
    place = {"Ravensburg": "'Eywiesenstraße / Gartenstraße / Weingarten'",
             "Weingarten": "'Eywiesenstraße / Gartenstraße'"}.get(
        town, "'Eywiesenstraße / Gartenstraße / Weingarten'")
    tail = "" if town == "Ravensburg" else " / Ravensburg"
    name = (
        f"case nr % 3 when 0 then 'B ' || nr || ' / Ulmerstraße{tail}' "
        f"when 1 then 'Markdorferstraße / L ' || nr || '{tail}' else {place} end"
    )
    return f"""
    with sheet as (select {SHEET_KEY} as nr, {s.columns_sql(SHEET)} from events group by 1),
    long as ({long}),
    newest as (select *, 9.0::double + nr % 1000 / 1000.0::double as lon,
        47.0::double + nr % 777 / 1000.0::double as lat from (select *, row_number() over
        (partition by nr order by cast(datum as date) desc, block desc) as rn from long)
        where rn = 1)
    {canonical(code, "newest", "kfz", "sv", name=name, station="nr", point=True,
        road_class="case nr % 3 when 0 then 'B' when 1 then 'L' else 'G' end",
        road_no="case nr % 3 when 0 then 'B ' || nr when 1 then 'L ' || nr end",
        year="year(cast(datum as date))")}"""


def _town(code):
    def run(spark, folder):
        cells_ = [F.expr(e).alias(n) for n, e in SHEET.items()]
        rows = table(spark, folder, "events").groupBy(F.expr(SHEET_KEY).alias("nr")).agg(*cells_)
        sheet = rows.select(
            F.col("nr").alias("Id"), F.expr(STATION_NAME).alias("Name"),
            F.expr("47.0D + nr % 777 / 1000.0D").alias("Breitengrad"),
            F.expr("9.0D + nr % 1000 / 1000.0D").alias("laengengrad "), *SHEET,
        )
        return municipal.stations(code, {"sheet": sheet})

    run.__name__ = f"source_{code}"
    return source(_town_sql(code))(run)


source_ravensburg = _town("ravensburg")
source_weingarten = _town("weingarten")
source_berg = _town("berg")
source_baienfurt = _town("baienfurt")
source_baindt = _town("baindt")


# ------------------------------------------------------------------------- all together

MERGED_SQL = "merged as (" + " union all ".join(
    f"select * from ({QUERIES['source_' + code].sql})" for code in live_codes()
) + ")"
ALL_GROUPS_SQL = f"""{MERGED_SQL}, groups as (select source, case min(level) when 'bund'
    then 'bast' when 'land' then '' else 'kommunal_' end || case when min(level) = 'bund' then ''
    when bool_and(kind = 'Point') then 'points' else 'lines' end as "group"
    from merged group by source)"""


def merged(spark, folder):
    """All twenty sources in one table."""
    return combine([FEATURES[code](spark, folder) for code in live_codes()])


@query(f"""
    with {ALL_GROUPS_SQL}
    select g."group", count(distinct m.source) as sources, count(*) as features
    from merged m join groups g on m.source = g.source group by 1
""")
def all_sources_by_group(spark, folder):
    """Every source from its landed layers to the merged groups."""
    return grouping.summary(merged(spark, folder))


@query(f"""
    with {MERGED_SQL}
    select source, count(*) as n, max(year) as year, round_even(min(x0), 4) as west
    from merged group by source
""")
def all_sources_statistics(spark, folder):
    """Every line runs east, so the first vertices alone give the western bound."""
    with where_they_lie():
        features = merged(spark, folder)
    return stats_of_points(features).select("source", "n", "year", "west")


# -------------------------------------------------------------------------------- links

LINK_SQL = """links as (select page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) as href,
    generate_subscripts(regexp_extract_all(html, 'href="([^"]+)"', 1), 1) - 1 as place
    from pages),
    fitting as (select * from links where regexp_matches(lower(href), '(e|s|n)$')
        and contains(lower(href), 'e'))"""


@query(f"""
    with {LINK_SQL} select page_id, cast(place as integer) as place, href from fitting
""")
def candidate_links(spark, folder):
    """All links with one of the endings that contain a text, whatever the case."""
    return readers.feed_links(
        table(spark, folder, "pages"), "html", "page_id", match="E", endings=("e", "s", "n")
    ).select("page_id", F.col("at").alias("place"), "href")


@query(f"""
    with {LINK_SQL} select page_id, arg_min(href, place) as href from fitting group by page_id
""")
def first_fitting_link(spark, folder):
    return readers.first_link(
        table(spark, folder, "pages"), "html", "page_id", match="E", endings=("e", "s", "n")
    )
