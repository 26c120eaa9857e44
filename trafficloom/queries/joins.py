"""Joins, picks per key and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from trafficloom.functions import geometry as geo
from trafficloom.model import ORDINAL
from trafficloom.operators import keyed, reshape
from trafficloom.operators.tiles import combine
from trafficloom.queries import standins as s
from trafficloom.queries.registry import query, table

# A third of all rows share one key, some have none.
HOT = "case when {k} % 41 = 0 then null when {k} % 3 = 0 then 'hot' else 'k' || cast({k} as string) end"
LINE_ORDER = (
    "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_orderkey",
)
ORDER_SQL = ", ".join(LINE_ORDER)

SEGMENT = {
    "okey": "o_orderkey",
    "link_id": HOT.format(k="o_orderkey"),
    "kfz": "cast(floor(o_totalprice / 10) as bigint)",
}
TRUCK = {
    "link_id": HOT.format(k="l_orderkey"),
    "lkw": "cast(l_quantity * l_linenumber as bigint)",
}


def lines(spark, folder):
    """`lineitem` with its place in the input."""
    return table(spark, folder, "lineitem").withColumn(ORDINAL, F.struct(*LINE_ORDER))


@query(f"""
    with t as (select {s.columns_sql(TRUCK)}, {ORDER_SQL} from lineitem)
    select link_id, lkw from (select *,
        row_number() over (partition by link_id order by {ORDER_SQL}) as rn from t) where rn = 1
""")
def first_row_per_key(spark, folder):
    rows = lines(spark, folder).selectExpr(
        *[f"{e} as {n}" for n, e in TRUCK.items()], ORDINAL
    )
    return keyed.first_per_key(rows, ["link_id"]).drop(ORDINAL)


@query(f"""
    with k as (select {s.columns_sql(SEGMENT)} from orders),
    t as (select {s.columns_sql(TRUCK)}, {ORDER_SQL} from lineitem),
    f as (select link_id, lkw from (select *,
        row_number() over (partition by link_id order by {ORDER_SQL}) as rn from t) where rn = 1)
    select k.okey, k.link_id, k.kfz, f.lkw
    from k left join f on k.link_id is not distinct from f.link_id
""")
def attach_heavy_counts(spark, folder):
    """Left join with the first row per key; keys missing on both sides meet."""
    left = s.derive(table(spark, folder, "orders"), SEGMENT)
    right = lines(spark, folder).selectExpr(
        *[f"{e} as {n}" for n, e in TRUCK.items()], ORDINAL
    )
    return keyed.attach_first(left, right, ["link_id"], ["lkw"])


NET = {
    "vnk": """case l_linenumber when 1 then cast(l_partkey as string) || '.0'
        when 2 then ' ' || cast(l_partkey as string) when 3 then 'x'
        else cast(l_partkey as string) end""",
    "nnk": "cast(l_suppkey as string)",
    "x": "l_extendedprice",
    "y": "l_quantity",
}


def node_sql(column):
    """Node key of a column; the sign-keeping cut of a number, empty when unreadable."""
    return f"coalesce(cast(cast(trunc(try_cast({column} as double)) as bigint) as varchar), '')"


PAIR_VALUE = {
    "VonNK": "case when o_orderkey % 50 = 0 then null else cast(o_orderkey % 2000 as int) end",
    "NachNK": "cast(o_custkey % 100 as int)",
    "DTV": "cast(o_totalprice as string)",
    "TKZST": "cast(o_orderkey as string)",
}


@query(f"""
    with n as (select {s.columns_sql(NET)}, {ORDER_SQL} from lineitem),
    nk as (select *, coalesce(cast(cast(trunc(try_cast(vnk as double)) as bigint) as varchar), '')
        || '_' || coalesce(cast(cast(trunc(try_cast(nnk as double)) as bigint) as varchar), '') as k
        from n),
    nf as (select k, x, y from (select *, row_number() over (partition by k order by
        case when l_returnflag = 'A' then 0 when l_returnflag = 'N' then 1 when l_linestatus = 'F'
        then 2 else 3 end, {ORDER_SQL}) as rn from nk) where rn = 1),
    v as (select {s.columns_sql(PAIR_VALUE)}, o_orderkey from orders),
    vk as (select *, coalesce(cast(VonNK as varchar), '') || '_' || cast(NachNK as varchar) as k
        from v),
    vf as (select k, DTV, TKZST from (select *, row_number() over (partition by k
        order by o_orderkey) as rn from vk) where rn = 1)
    select x, y, DTV, TKZST from nf join vf on nf.k = vf.k
""")
def join_by_node_pair(spark, folder):
    """Four network layers in a row, then sections and values with the same end nodes."""
    rows = lines(spark, folder)
    flag = F.col("l_returnflag")
    split = {
        0: flag == "A", 1: flag == "N",
        2: (flag == "R") & (F.col("l_linestatus") == "F"),
        3: (flag == "R") & (F.col("l_linestatus") != "F"),
    }
    net = combine(
        [
            rows.filter(which).selectExpr(
                *[f"{e} as {n}" for n, e in NET.items()],
                f"struct({place} as file, {ORDINAL} as row) as {ORDINAL}",
            )
            for place, which in split.items()
        ]
    ).withColumn("geometry", geo.point(F.col("x"), F.col("y")))
    values = table(spark, folder, "orders").selectExpr(
        *[f"{e} as {n}" for n, e in PAIR_VALUE.items()], f"o_orderkey as {ORDINAL}"
    )
    joined = keyed.join_node_pairs(
        net, values, ("vnk", "nnk"), ("VonNK", "NachNK"), ["DTV", "TKZST"]
    )
    p = geo.first_point(F.col("geometry"))
    return joined.select(p["x"].alias("x"), p["y"].alias("y"), "DTV", "TKZST")


STRETCH = {
    "zst_nr": "l_orderkey",
    "von_stat": "case when l_quantity < 5 then null else l_linenumber end",
    "bis_stat": "l_suppkey % 3",
}


@query(f"""
    with t as (select {s.columns_sql(STRETCH)}, l_extendedprice as price, l_tax as tax,
        {ORDER_SQL} from lineitem),
    v as (select zst_nr, von_stat, bis_stat, l_discount as dtv from (select *, row_number() over
        (partition by zst_nr, von_stat, bis_stat order by {ORDER_SQL}) as rn from t) where rn = 1)
    select t.zst_nr, t.von_stat, t.bis_stat, t.price, t.tax, v.dtv
    from t left join v on t.zst_nr = v.zst_nr and t.von_stat is not distinct from v.von_stat
        and t.bis_stat = v.bis_stat
""")
def attach_by_three_keys(spark, folder):
    rows = lines(spark, folder)
    keys = [f"{e} as {n}" for n, e in STRETCH.items()]
    left = rows.selectExpr(*keys, "l_extendedprice as price", "l_tax as tax")
    right = rows.selectExpr(*keys, "l_discount as dtv", ORDINAL)
    return keyed.attach_first(left, right, list(STRETCH), ["dtv"])


LAYER_VALUE = "case when l_linenumber = 4 then null else l_quantity / 2 end"
# Shapes repeat: many sections share one, as sections and layers of a city do.
SHAPE = {"a": "cast({k} % 4000 as double)", "b": "cast({k} % 3 as double)"}


def _shape(key):
    a, b = (F.expr(e.format(k=key)) for e in SHAPE.values())
    return geo.line(F.array(geo.xy(a, b), geo.xy(a + 1, b)))


FIRSTS_SQL = f"""
    firsts as (select * from (select *, row_number() over (partition by {{keys}}, l_returnflag
        order by {ORDER_SQL}) as rn from t) where rn = 1),
    sums as (select {{keys}}, case when count(value) > 0 then sum(value) end as sv
        from firsts group by {{keys}})"""


@query(f"""
    with t as (select l_orderkey % 4000 as a, l_orderkey % 3 as b, {LAYER_VALUE} as value,
        {ORDER_SQL} from lineitem), {FIRSTS_SQL.format(keys="a, b")}
    select o_orderkey, sv from orders left join sums
        on o_orderkey % 4000 = sums.a and o_orderkey % 3 = sums.b
""")
def sum_layers_by_geometry(spark, folder):
    """Three layers matched by exact shape; each gives its first value, missing ones nothing."""
    base = table(spark, folder, "orders").select(
        "o_orderkey", _shape("o_orderkey").alias("geometry")
    )
    layers = {
        flag: lines(spark, folder).filter(F.col("l_returnflag") == flag).select(
            F.expr(LAYER_VALUE).alias("value"), _shape("l_orderkey").alias("geometry"), ORDINAL
        )
        for flag in ("A", "N", "R")
    }
    return keyed.sum_layers_by_shape(base, layers, "value", "sv").select("o_orderkey", "sv")


@query(f"""
    with t as (select {HOT.format(k="l_orderkey")} as nr, {LAYER_VALUE} as value,
        {ORDER_SQL} from lineitem), {FIRSTS_SQL.format(keys="nr")}
    select o_orderkey, sums.sv from (select *, {HOT.format(k="o_orderkey")} as nr from orders) o
        left join sums on o.nr is not distinct from sums.nr
""")
def sum_layers_by_section(spark, folder):
    base = table(spark, folder, "orders").selectExpr(
        "o_orderkey", f"{HOT.format(k='o_orderkey')} as nr"
    )
    layers = {
        flag: lines(spark, folder).filter(F.col("l_returnflag") == flag).selectExpr(
            f"{HOT.format(k='l_orderkey')} as nr", f"{LAYER_VALUE} as value", ORDINAL
        )
        for flag in ("A", "N", "R")
    }
    return keyed.sum_layers(base, layers, ["nr"], "value", "sv").select("o_orderkey", "sv")


@query("""
    select l_orderkey, l_linenumber, l_partkey, l_extendedprice,
        cast(6.0 + (l_suppkey * 7919 % 900000) / 100000.0 as double) as x
    from lineitem join supplier on l_suppkey = s_suppkey
""")
def values_with_station_geometry(spark, folder):
    values = table(spark, folder, "lineitem").withColumnRenamed("l_suppkey", "station")
    x = F.expr("6.0 + (s_suppkey * 7919 % 900000) / 100000.0")
    stations = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("station"), geo.point(x, F.lit(50.0)).alias("geometry")
    )
    joined = keyed.join_stations(values, stations, "station")
    return joined.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
        geo.first_point(F.col("geometry"))["x"].alias("x"),
    )


@query("""
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
        coalesce(case when l_linenumber <> 2 then l_quantity end, 0)
            + coalesce(case when l_linenumber <> 3 then l_extendedprice end, 0) as total
    from lineitem
""")
def cross_section_sum(spark, folder):
    """Both directions added, a missing one as zero."""
    k = F.when(F.col("l_linenumber") != 2, F.col("l_quantity"))
    r = F.when(F.col("l_linenumber") != 3, F.col("l_extendedprice"))
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        reshape.both_directions(k, r).alias("total"),
    )


# -------------------------------------------------------------------- wide count tables

YEARS = tuple(range(1992, 2003))  # all that occur
_WIDE = {}
for _y in YEARS:
    _WIDE[f"K_{_y}_24H"] = (
        f"sum(case when year(l_shipdate) = {_y} and l_linestatus = 'O' then l_quantity end)"
    )
    if _y != 1998:
        _WIDE[f"R_K_{_y}_X"] = (
            f"sum(case when year(l_shipdate) = {_y} and l_linestatus = 'F' then l_quantity end)"
        )
# Grouped so finely that many direction-year cells stay empty.
WIDE_KEY = "l_partkey * 4 + l_linenumber % 4"


def edges(spark, folder):
    return table(spark, folder, "lineitem").groupBy(F.expr(WIDE_KEY).alias("NO")).agg(
        *[F.expr(e).alias(n) for n, e in _WIDE.items()]
    )


def _choice(joiner: str, pick: str) -> str:
    arms = " ".join(
        f"when K_{y}_24H is not null {joiner} R_K_{y}_X is not null then "
        + (str(y) if pick == "year" else f"coalesce(K_{y}_24H, 0) + coalesce(R_K_{y}_X, 0)")
        for y in sorted(YEARS, reverse=True)
        if y != 1998
    )
    return f"case {arms} end"


WIDE_SQL = ", ".join(f"{e} as {n}" for n, e in _WIDE.items())
EDGES_SQL = f"edges as (select {WIDE_KEY} as NO, {WIDE_SQL} from lineitem group by 1)"


@query(f"""
    with {EDGES_SQL}
    select NO, coalesce({_choice("and", "value")}, {_choice("or", "value")}) as dtv_kfz,
        coalesce({_choice("and", "year")}, {_choice("or", "year")}) as year
    from edges where {_choice("or", "year")} is not null
""")
def newest_direction_year(spark, folder):
    """Newest year with both directions, else with one; years lacking a column do not count."""
    return reshape.pick_direction_year(edges(spark, folder)).select("NO", "dtv_kfz", "year")


# One station per user; a count block per residue of the event number.
BLOCK = "event_id % 4 + 1"


def sheet(spark, folder):
    events = table(spark, folder, "events")
    cells = []
    for n in (1, 2, 3, 4):
        mine = f"{BLOCK} = {n}"
        cells += [
            F.expr(f"cast(sum(case when {mine} then value end) as string)").alias(f"Kfz_{n} "),
            F.expr(f"count(case when {mine} then 1 end)").alias(f"sv_{n}"),
        ]
        if n != 3:  # an incomplete block is left out
            cells.append(
                F.expr(
                    f"substr(cast(max(case when {mine} then ts end) as string), 1, 10)"
                ).alias(f"Datum_{n}")
            )
    return events.groupBy(F.expr("nullif(user_id, 7)").alias("id")).agg(*cells)


SHEET_SQL = """sheet as (select nullif(user_id, 7) as id, """ + ", ".join(
    f"sum(case when {BLOCK} = {n} then value end) as k{n}, "
    f"count(case when {BLOCK} = {n} then 1 end) as s{n}, "
    f"cast(max(case when {BLOCK} = {n} then ts end) as date) as d{n}"
    for n in (1, 2, 3, 4)
) + " from events group by 1)"
LONG_SQL = "long as (" + " union all ".join(
    f"select id, {n} as block, k{n} as kfz, cast(s{n} as double) as sv, d{n} as datum from sheet "
    f"where k{n} is not null and d{n} is not null"
    for n in (1, 2, 4)
) + ")"


@query(f"""
    with {SHEET_SQL}, {LONG_SQL}
    select id, block, round(kfz, 4) as kfz, sv, cast(year(datum) as integer) as year,
        strftime(datum, '%Y-%m-%d') as day from long
""")
def count_blocks_to_rows(spark, folder):
    long = reshape.blocks_to_long(sheet(spark, folder), ["ID"])
    return long.select(
        F.col("ID").alias("id"), "block", F.round("kfz", 4).alias("kfz"), "sv",
        F.year("datum").alias("year"), F.date_format("datum", "yyyy-MM-dd").alias("day"),
    )


@query(f"""
    with {SHEET_SQL}, {LONG_SQL}
    select id, block, round(kfz, 4) as kfz, sv from (select *, row_number() over
        (partition by id order by datum desc, block desc) as rn from long where id is not null)
    where rn = 1
""")
def newest_count_per_station(spark, folder):
    """One count per station by date; stations without a number are left out."""
    newest = reshape.latest_count(reshape.blocks_to_long(sheet(spark, folder), ["ID"]))
    return newest.select(
        F.col("ID").alias("id"), "block", F.round("kfz", 4).alias("kfz"), "sv"
    )


@query(f"""
    select l_returnflag, 'A' as layer, count(*) as n from lineitem where l_returnflag = 'A'
    group by 1 union all select l_returnflag, 'N', count(*) from lineitem
    where l_returnflag = 'N' group by 1
    union all select null, 'R', count(*) from lineitem where l_returnflag = 'R'
""")
def union_of_layers(spark, folder):
    """Layers of different width in one table; a column a layer lacks is null."""
    rows = table(spark, folder, "lineitem")
    parts = []
    for flag in ("A", "N", "R"):
        keep = ["l_orderkey"] if flag == "R" else ["l_orderkey", "l_returnflag"]
        part = rows.filter(F.col("l_returnflag") == flag).select(*keep)
        parts.append(part.withColumn("layer", F.lit(flag)))
    return combine(parts).groupBy("l_returnflag", "layer").agg(F.count("*").alias("n"))


@query("""
    select o_orderkey, row_number() over (partition by o_orderdate order by o_totalprice,
        o_orderkey) = 1 as first_of_day from orders
""")
def first_of_ordered_rows(spark, folder):
    """The first row of each day in price order, marked by joining the pick back."""
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    firsts = keyed.first_per_key(
        rows, ["o_orderdate"], F.struct("o_totalprice", "o_orderkey")
    ).select("o_orderdate", F.col("o_orderkey").alias("pick"))
    both = keyed.attach(rows, firsts, ["o_orderdate"])
    return both.select("o_orderkey", (F.col("o_orderkey") == F.col("pick")).alias("first_of_day"))
