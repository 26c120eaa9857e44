"""Numbers, classes, names, the canonical mapping and the contract."""

from __future__ import annotations

from pyspark.sql import functions as F

from trafficloom.functions import roads
from trafficloom.functions import values as v
from trafficloom.operators import contract
from trafficloom.operators.canonical import Spec, normalize_counts, points_from_xy, to_canonical
from trafficloom.functions import geometry as geo
from trafficloom.model import ENUMS
from trafficloom.operators.tiles import cast_attributes
from trafficloom.queries import standins as s
from trafficloom.queries.registry import query, table


@query("""
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
        try_cast(case when txt in ('nan', 'Infinity') or txt like '%d' then null else txt end
            as double) as number
    from (select *, case l_linenumber
            when 1 then ' ' || cast(l_quantity as bigint) || '.5 ' when 2 then '1e' || cast(l_quantity as bigint) % 7
            when 3 then cast(l_partkey as varchar) || ',5' when 4 then 'nan'
            when 5 then 'Infinity' when 6 then cast(l_partkey as varchar) || 'd' else null end as txt
        from lineitem)
""")
def number_coercion(spark, folder):
    text = F.expr("""case l_linenumber
        when 1 then ' ' || cast(l_quantity as bigint) || '.5 '
        when 2 then '1e' || cast(l_quantity as bigint) % 7
        when 3 then cast(l_partkey as string) || ',5' when 4 then 'nan' when 5 then 'Infinity'
        when 6 then cast(l_partkey as string) || 'd' else null end""")
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        v.parse_number(text).alias("number"),
    )


@query(f"""
    with {s.SECTIONS_SQL}, numbered as (select *,
        cast(round_even(try_cast(kfz_text as double), 0) as bigint) as kfz_n,
        cast(round_even(try_cast(sv_text as double), 0) as bigint) as sv_n from sections)
    select station_id, {s.CLEAN_SQL} from numbered
""")
def count_clean_up(spark, folder):
    raw = s.sections(spark, folder).select(
        "station_id", F.col("kfz_text").alias("dtv_kfz"), F.col("sv_text").alias("dtv_sv")
    )
    return normalize_counts(raw)


@query(f"""
    with {s.SECTIONS_SQL}, numbered as (select *,
        cast(round_even(try_cast(kfz_text as double), 0) as bigint) as kfz_n,
        cast(round_even(try_cast(sv_text as double), 0) as bigint) as sv_n from sections),
    {s.utm_sql("numbered", "placed", [("e1", "n1", "lon", "lat")])}
    select {s.CLEAN_SQL}, share as sv_anteil, 'DTV' as metric, 2021 as year,
        case trim(code) when '1' then 'A' when '2' then 'B' when '3' then 'L' when '4' then 'K'
            else 'G' end as road_class,
        road_no, cast(null as varchar) as name, station_id, 'BY' as state, 'n0' as source,
        (select case n_regionkey % 3 when 0 then 'land' when 1 then 'kommune' else 'bund' end
            from nation where n_nationkey = 0) as level,
        'CC-BY-4.0' as license, 'LineString' as kind, 4326 as srid,
        round(lon, 6) as x0, round(lat, 6) as y0, 2 as vertices
    from placed
""")
def canonical_mapping(spark, folder):
    ends = F.array(
        geo.xy(F.col("e1"), F.col("n1")), geo.xy(F.col("e2"), F.col("n2"))
    )
    source = s.sections(spark, folder).select(
        "kfz_text", "sv_text", "share", "code", F.col("road_no").alias("strasse"),
        "station_id", F.col("name").alias("junk"), geo.line(ends, 25832).alias("geometry"),
    )
    spec = Spec(
        {"kfz_text": "dtv_kfz", "sv_text": "dtv_sv", "share": "sv_anteil", "strasse": "road_no"},
        metric="DTV", state="BY", source="n0", license="CC-BY-4.0", year=2021,
        levels=s.levels(spark, folder), road_class_from="code",
        road_class_map=roads.class_by_code(s.CLASSES, "G"),
    )
    return s.flat(to_canonical(source, spec))


@query(f"""
    with {s.SECTIONS_SQL}
    select station_id, case when okey % 7 = 0 then null else year end as year,
        'G' as road_class, 'kommune' as level
    from sections
""")
def year_from_column(spark, folder):
    """Years as texts: whole ones are kept, fractional ones become null for the contract."""
    source = s.sections(spark, folder).select(
        F.col("station_id"), F.col("kfz_text").alias("dtv_kfz"),
        F.expr("cast(year as string) || case when okey % 7 = 0 then '.5' else '.0' end")
        .alias("jahr"),
        geo.point(F.col("e1"), F.col("n1"), 4326).alias("geometry"),
    )
    spec = Spec(
        {}, metric="24h", state="BW", source="x", license="l", year_from="jahr",
        level="kommune", road_class="G",
    )
    return to_canonical(source, spec).select("station_id", "year", "road_class", "level")


@query(f"""
    with {s.SECTIONS_SQL}
    select station_id,
        case trim(code) when '1' then 'A' when '2' then 'B' when '3' then 'L' when '4' then 'K'
            else 'L' end as with_default,
        case code when '1' then 'A' when '2' then 'B' when '3' then 'L' when '4' then 'K'
            else 'G' end as untrimmed,
        case code when '1' then 'A' when '2' then 'B' when '3' then 'L' when '4' then 'K'
            end as strict
    from sections
""")
def road_class_by_code(spark, folder):
    code = F.col("code")
    return s.sections(spark, folder).select(
        "station_id",
        roads.class_by_code(s.CLASSES, "L")(code).alias("with_default"),
        roads.class_by_code(s.CLASSES, "G", trimmed=False)(code).alias("untrimmed"),
        roads.lookup(s.CLASSES, code).alias("strict"),
    )


@query(f"""
    with {s.SECTIONS_SQL}
    select station_id, coalesce(nullif(regexp_extract(upper(trim(road_no)), '^[ABLK]'), ''), 'L')
            as state_class,
        coalesce(nullif(regexp_extract(upper(trim(road_no)), '^[AB]'), ''), 'A') as federal_class
    from sections
""")
def road_class_by_first_letter(spark, folder):
    return s.sections(spark, folder).select(
        "station_id",
        roads.class_by_first_letter("ABLK", "L")(F.col("road_no")).alias("state_class"),
        roads.class_by_first_letter("AB", "A")(F.col("road_no")).alias("federal_class"),
    )


COORDINATE = {
    "c_custkey": "c_custkey",
    "gx": """case when c_custkey % 9 = 0 then '' when c_custkey % 13 = 0 then 'n/a'
        else cast(6.0 + (c_custkey * 7919 % 900000) / 100000.0 as string) end""",
    "gy": """case when c_custkey % 11 = 0 then null
        else ' ' || cast(47.0 + (c_custkey * 104729 % 800000) / 100000.0 as string) end""",
}


@query(f"""
    with t as (select {s.columns_sql(COORDINATE)} from customer)
    select c_custkey, round(try_cast(gx as double), 6) as x, round(try_cast(gy as double), 6) as y
    from t where try_cast(gx as double) is not null and try_cast(gy as double) is not null
""")
def points_from_text_columns(spark, folder):
    rows = s.derive(table(spark, folder, "customer"), COORDINATE)
    p = geo.first_point(F.col("geometry"))
    return points_from_xy(rows, "gx", "gy").select(
        "c_custkey", F.round(p["x"], 6).alias("x"), F.round(p["y"], 6).alias("y")
    )


@query(f"""
    with {s.SECTIONS_SQL}
    select station_id, try_cast(kfz_text as double) as kfz, nullif(name, '') as name
    from sections where try_cast(kfz_text as double) is not null
""")
def rows_with_value(spark, folder):
    raw = s.sections(spark, folder)
    return raw.select(
        "station_id", v.number(raw, "kfz_text").alias("kfz"),
        v.empty_to_null(F.col("name")).alias("name"),
    ).filter("kfz is not null")


@query("""
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
        case when txt in ('', 'NA', 'n/a', 'NULL', 'nan') then null else txt end as cell
    from (select *, case l_linenumber when 1 then '' when 2 then 'NA' when 3 then 'n/a'
            when 4 then 'NULL' when 5 then 'nan' else '00' || cast(l_partkey as varchar) end as txt
        from lineitem)
""")
def missing_cell_texts(spark, folder):
    text = F.expr("""case l_linenumber when 1 then '' when 2 then 'NA' when 3 then 'n/a'
        when 4 then 'NULL' when 5 then 'nan' else '00' || cast(l_partkey as string) end""")
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        v.null_tokens(text).alias("cell"),
    )


@query(f"""
    with {s.FEATURES_SQL}
    select dtv_kfz, dtv_sv, sv_anteil, metric, year, road_class, road_no, name, station_id,
        state, source, level, license, case when is_point then 'Point' else 'LineString' end as kind,
        4326 as srid, round(lon1, 6) as x0, round(lat1, 6) as y0,
        case when is_point then 1 else 2 end as vertices
    from features
""")
def backfill_older_table(spark, folder):
    return s.flat(s.features(spark, folder))


@query(f"""
    with {s.SECTIONS_SQL}
    select station_id, cast(trunc(try_cast(nullif(kfz_text, '0') as double)) as integer) as dtv_kfz,
        cast(okey as integer) as dtv_sv, year
    from sections
""")
def attribute_types(spark, folder):
    raw = s.sections(spark, folder).select(
        "station_id", v.parse_number(F.nullif(F.col("kfz_text"), F.lit("0"))).alias("dtv_kfz"),
        F.col("okey").cast("string").alias("dtv_sv"), F.col("year").cast("bigint").alias("year"),
    )
    return cast_attributes(raw, {"dtv_kfz": "int", "dtv_sv": "int", "year": "int"})


NODE = {
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
    "l_partkey": "l_partkey",
    "l_suppkey": "l_suppkey",
    "l_extendedprice": "l_extendedprice",
    "vnk": """case l_linenumber when 1 then cast(l_partkey as string) || '.0'
        when 2 then ' ' || cast(l_partkey as string) when 3 then ''
        when 4 then 'x' || cast(l_partkey as string) when 5 then cast(l_partkey as string) || '.9'
        when 6 then null else cast(l_partkey as string) end""",
    "nnk": "cast(l_suppkey as string)",
}
KEY_SQL = "coalesce(cast(cast(trunc(try_cast({} as double)) as bigint) as varchar), '')"


@query(f"""
    with t as (select {s.columns_sql(NODE)} from lineitem)
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
        {KEY_SQL.format("vnk")} as node, {KEY_SQL.format("vnk")} || '_' || {KEY_SQL.format("nnk")} as pair
    from t
""")
def node_keys(spark, folder):
    rows = s.derive(table(spark, folder, "lineitem"), NODE)
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        roads.node_key(F.col("vnk")).alias("node"),
        roads.node_pair(F.col("vnk"), F.col("nnk")).alias("pair"),
    )


@query(f"""
    with {s.SECTIONS_SQL}
    select station_id, case when name is null then null
        else trim(code) || ' ' || trim(name) end as road_no
    from sections
""")
def road_number_of_two_columns(spark, folder):
    return s.sections(spark, folder).select(
        "station_id", roads.numbered(F.col("code"), F.col("name")).alias("road_no")
    )


STREET = {
    "p_partkey": "p_partkey",
    "street": """case p_partkey % 8
        when 0 then 'Autobahn A' || cast(p_size as string) || ' ' || p_name
        when 1 then p_name || ' B ' || cast(p_size as string) || 'a'
        when 2 then 'L' || cast(p_partkey as string) || ' ' || p_type
        when 3 then 'K ' || cast(p_size as string)
        when 4 then 'XA ' || cast(p_size as string)
        when 5 then p_name when 6 then 'B 12345' else null end""",
}


def _street_sql(pattern: str) -> str:
    return f"""
    with t as (select {s.columns_sql(STREET)} from part)
    select p_partkey,
        case when regexp_matches(street, '{pattern}') then regexp_extract(street, '{pattern}', 1)
            || ' ' || regexp_extract(street, '{pattern}', 2) end as road_no,
        coalesce(nullif(regexp_extract(street, '{pattern}', 1), ''), 'G') as road_class
    from t
    """


def _streets(spark, folder, pattern):
    road = roads.road_in_name(F.col("street"), pattern)
    return s.derive(table(spark, folder, "part"), STREET).select(
        "p_partkey", road.number.alias("road_no"), road.road_class.alias("road_class")
    )


@query(_street_sql(r"\b([ABLK])\s?(\d{1,4})\b"))
def road_in_street_name(spark, folder):
    return _streets(spark, folder, roads.ROAD_IN_NAME)


@query(_street_sql(r"\b([ABLK])\s?(\d{1,4}[a-z]?)\b"))
def road_with_letter_suffix(spark, folder):
    return _streets(spark, folder, roads.ROAD_IN_NAME_SUFFIX)


PERIOD = {
    "okey": "o_orderkey",
    "v5": "case when o_orderkey % 3 = 0 then null else o_totalprice end",
    "v10": "case when o_orderkey % 12 = 0 then null else o_totalprice + 1 end",
    "p5": """case when o_orderkey % 4 = 1 then null
        else '1990 - ' || cast(year(o_orderdate) as string) || ' ' end""",
    "p10": "cast(year(o_orderdate) as string) || '-' || cast(o_custkey % 3000 as string)",
}


@query(f"""
    with t as (select {s.columns_sql(PERIOD)} from orders)
    select okey, coalesce(v5, v10) as value,
        try_cast(regexp_extract(case when v5 is not null then p5 else p10 end,
            '(\\d{{4}})\\s*$', 1) as integer) as year
    from t
""")
def period_value_and_year(spark, folder):
    """Five-year value else ten-year value; the year follows the choice of the value."""
    from trafficloom.operators.reshape import five_or_ten

    raw = s.derive(table(spark, folder, "orders"), PERIOD).withColumnsRenamed(
        {"v5": "w_5j", "v10": "w_10j", "p5": "z_5j", "p10": "z_10j"}
    )
    value, year = five_or_ten(raw, "w", "z")
    return raw.select("okey", value.alias("value"), year.alias("year"))


STATION = {
    "p_partkey": "p_partkey",
    "label": """case p_partkey % 6
        when 0 then 'B' || cast(p_size as string) || '_' || p_name || '_88212_RAVENSBURG'
        when 1 then p_name || '_L ' || cast(p_partkey as string) || '_88213_Ravensburg'
        when 2 then p_name || '_ ' || p_type || ' __ ' || p_brand
        when 3 then 'K1_A2_' || p_type
        when 4 then 'B32x_12345_123456' else null end""",
}


@query(f"""
    with t as (select {s.columns_sql(STATION)} from part),
    tokens as (select p_partkey, label, unnest(string_split(label, '_')) as tok,
        generate_subscripts(string_split(label, '_'), 1) as pos from t),
    kept as (select p_partkey, label, trim(tok) as tok, pos,
        regexp_matches(replace(trim(tok), ' ', ''), '^[ABLK]\\d+$') as road from tokens
        where trim(tok) <> '' and not regexp_matches(trim(tok), '^\\d{{5}}$')
            and lower(trim(tok)) <> 'ravensburg'),
    firsts as (select p_partkey, min(pos) as pos from kept where road group by p_partkey),
    shown as (select k.p_partkey, k.pos, f.pos = k.pos as hit,
        case when f.pos = k.pos then substr(tok, 1, 1) || ' ' || replace(substr(tok, 2), ' ', '')
            else tok end as tok
        from kept k left join firsts f on k.p_partkey = f.p_partkey),
    joined as (select p_partkey, string_agg(tok, ' / ' order by pos) as name,
        max(case when hit then tok end) as road_no from shown group by p_partkey)
    select t.p_partkey, case when label is null then null else coalesce(name, '') end as name,
        road_no, coalesce(substr(road_no, 1, 1), 'G') as road_class
    from t left join joined j on t.p_partkey = j.p_partkey
""")
def station_name_parts(spark, folder):
    parsed = roads.station_name(F.col("label"), "Ravensburg")
    return s.derive(table(spark, folder, "part"), STATION).select(
        "p_partkey", parsed.name.alias("name"), parsed.number.alias("road_no"),
        parsed.road_class.alias("road_class"),
    )


DATE_TEXT = {
    "event_id": "event_id",
    "day": """case event_id % 7 when 0 then '' when 1 then 'kein Datum' when 2 then null
        when 3 then substr(cast(ts as string), 9, 2) || '.' || substr(cast(ts as string), 6, 2) || '.'
            || substr(cast(ts as string), 1, 4)
        when 4 then '31.02.2020' when 5 then substr(cast(ts as string), 1, 10) || 'Z'
        else substr(cast(ts as string), 1, 10) end""",
}


@query(f"""
    with t as (select {s.columns_sql(DATE_TEXT)} from events)
    select event_id, cast(year(coalesce(try_cast(rtrim(day, 'Z') as date),
            try_cast(try_strptime(day, '%d.%m.%Y') as date))) as integer) as year,
        cast(event_id as varchar) as id_text
    from t
""")
def year_of_date_text(spark, folder):
    return s.derive(table(spark, folder, "events"), DATE_TEXT).select(
        "event_id", v.year_of(F.col("day")).alias("year"),
        v.id_text(F.col("event_id")).alias("id_text"),
    )


# ------------------------------------------------------------------------------ contract

# Features with some broken values, as a damaged source would deliver them.
BROKEN = {
    "metric": "case when okey % 19 = 0 then 'DTVx' when okey % 29 = 0 then 'dtv' else metric end",
    "road_class": "case when okey % 31 = 0 then null else road_class end",
    "level": "case when okey % 37 = 0 then 'stadt' else level end",
    "year": "case when okey % 41 = 0 then null else year end",
}
BROKEN_SQL = f"""{s.FEATURES_SQL}, broken as (select f.* replace ({s.columns_sql(BROKEN)}),
    okey % 43 = 0 as empty from features f)"""


def damaged(spark, folder):
    okey = F.col("station_id").cast("bigint")
    good = s.features(spark, folder).withColumn("okey", okey)
    # The 43rd features lose their shape; the 47th claim another reference system.
    shape = F.when(
        okey % 43 != 0,
        F.when(okey % 47 == 0, geo.with_srid(F.col("geometry"), 25832))
        .otherwise(F.col("geometry")),
    )
    return good.withColumns(
        {**{c: F.expr(e) for c, e in BROKEN.items()}, "geometry": shape}
    ).drop("okey")


RULES_SQL = """
    unnest(['null:metric', 'null:year', 'null:road_class', 'null:state', 'null:source',
        'null:level', 'null:license', 'enum:metric', 'enum:road_class', 'enum:level',
        'geometry', 'srid']) as rule,
    unnest([count(*) filter (metric is null), count(*) filter (year is null),
        count(*) filter (road_class is null), count(*) filter (state is null),
        count(*) filter (source is null), count(*) filter (level is null),
        count(*) filter (license is null),
        count(*) filter (metric not in ('DTV', 'DTVw', '24h')),
        count(*) filter (road_class not in ('A', 'B', 'L', 'K', 'G')),
        count(*) filter (level not in ('bund', 'land', 'kommune')),
        count(*) filter (empty), count(*) filter (okey % 47 = 0 and not empty)]) as n"""


@query(f"""
    with {BROKEN_SQL}, counted as (select {RULES_SQL} from broken)
    select rule, n from counted where n > 0
""")
def contract_violations(spark, folder):
    return contract.violations(damaged(spark, folder))


@query(f"""
    with {BROKEN_SQL}, counted as (select source, {RULES_SQL} from broken group by source)
    select source, rule, n from counted where n > 0
""")
def contract_violations_by_source(spark, folder):
    return contract.violations(damaged(spark, folder), ["source"])


@query(f"""
    with {BROKEN_SQL}
    select 'metric' as "column", metric as value, count(*) as n from broken
        where metric not in ('DTV', 'DTVw', '24h') group by metric
    union all select 'road_class', road_class, count(*) from broken
        where road_class not in ('A', 'B', 'L', 'K', 'G') group by road_class
    union all select 'level', level, count(*) from broken
        where level not in ('bund', 'land', 'kommune') group by level
""")
def values_out_of_domain(spark, folder):
    return contract.invalid_values(damaged(spark, folder))


@query(f"""
    with {BROKEN_SQL}
    select unnest(['metric', 'year', 'road_class', 'state', 'source', 'level', 'license'])
            as "column",
        unnest([count(*) - count(metric), count(*) - count(year), count(*) - count(road_class),
            count(*) - count(state), count(*) - count(source), count(*) - count(level),
            count(*) - count(license)]) as n
    from broken
""")
def nulls_per_required_column(spark, folder):
    return contract.null_counts(damaged(spark, folder))


@query(f"""
    with {BROKEN_SQL}
    select station_id, empty or okey % 47 = 0 or year is null or road_class is null
        or metric not in ('DTV', 'DTVw', '24h') or level not in ('bund', 'land', 'kommune')
        as quarantined
    from broken
""")
def quarantined_rows(spark, folder):
    good, bad = contract.quarantine(damaged(spark, folder))
    return good.select("station_id", F.lit(False).alias("quarantined")).unionByName(
        bad.select("station_id", F.lit(True).alias("quarantined"))
    )


@query("""
    select 'road_class' as "column", l_returnflag as value, count(*) as n from lineitem
        where l_returnflag not in ('A', 'B', 'L', 'K', 'G') group by l_returnflag
    union all select 'level', l_linestatus, count(*) from lineitem group by l_linestatus
""")
def set_difference_of_values(spark, folder):
    """Values a column takes minus the values allowed, of all columns at once."""
    rows = table(spark, folder, "lineitem").selectExpr(
        "l_returnflag as road_class", "l_linestatus as level", "'DTV' as metric"
    )
    return contract.invalid_values(rows)
