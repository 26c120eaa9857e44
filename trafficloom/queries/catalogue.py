"""Sources, groups, datasets and run summaries."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from trafficloom.operators import catalogue as cat
from trafficloom.operators import chains, contract, grouping
from trafficloom.operators.canonical import near_each_other, write_ready
from trafficloom.operators.viewer import with_provider
from trafficloom.plans.jobs import build_summary
from trafficloom.queries import standins as s
from trafficloom.queries.cleaning import BROKEN_SQL, RULES_SQL, damaged
from trafficloom.queries.registry import query
from trafficloom.sources import footers

STATS_SQL = """stats as (select source, count(*) as n,
    round_even(min(least(lon1, lon2)), 4) as west, round_even(min(least(lat1, lat2)), 4) as south,
    round_even(max(greatest(lon1, lon2)), 4) as east,
    round_even(max(greatest(lat1, lat2)), 4) as north, max(year) as year
    from features group by source)"""

GROUPS_SQL = """groups as (select source, case min(level) when 'bund' then 'bast'
    when 'land' then '' else 'kommunal_' end || case when min(level) = 'bund' then ''
    when bool_and(is_point) then 'points' else 'lines' end as "group"
    from features group by source),
    routed as (select f.*, g."group" from features f join groups g on f.source = g.source)"""


@query(f"""
    with {s.FEATURES_SQL}, {STATS_SQL} select * from stats
""")
def features_per_source(spark, folder):
    """Feature count, bounds and newest year per source."""
    return cat.source_stats(s.features(spark, folder))


@query(f"""
    with {s.FEATURES_SQL}, {STATS_SQL} select * from stats
""")
def statistics_from_footers(spark, folder):
    """The same of a table as the jobs write it, split by source: no row of it is read."""
    path = f"{chains.shared_folder(spark)}/features-{uuid.uuid4().hex}"
    rows = write_ready(s.features(spark, folder))
    near_each_other(rows, ["source"], spread=True).write.partitionBy("source").parquet(path)
    return cat.source_stats(footers.read(spark, path))


@query(f"""
    with {s.SECTIONS_SQL}, {s.CATALOGUE_SQL}
    select f.station_id, f.source, c.level
    from sections f left join catalogue c on f.source = c.code
""")
def level_of_source(spark, folder):
    from trafficloom.functions.roads import lookup

    known = s.levels(spark, folder)
    return s.sections(spark, folder).select(
        "station_id", "source", lookup(known, F.col("source")).alias("level")
    )


def _built_stats(spark, folder):
    """Statistics of the sources that the catalogue calls live."""
    live = s.catalogue(spark, folder).filter("status = 'live'").select(F.col("code").alias("source"))
    return cat.source_stats(s.features(spark, folder)).join(live, "source", "left_semi")


@query(f"""
    with {s.FEATURES_SQL}, {STATS_SQL}
    select ord, code, status, level, name, state, kind, coalesce(t.year, c.year) as year,
        license, metric, n, west, south, east, north
    from catalogue c left join stats t on c.code = t.source
""")
def catalogue_with_statistics(spark, folder):
    """Every catalogued source; those without features keep their stated year."""
    return cat.source_entries(s.catalogue(spark, folder), cat.source_stats(s.features(spark, folder)))


@query(f"""
    with {s.FEATURES_SQL}
    select station_id, case when c.level = 'kommune' then c.name || ' (' || c.state || ')'
        when c.level = 'bund' or f.state = 'DE' then 'BASt' else f.state end as provider
    from features f left join catalogue c on f.source = c.code
""")
def provider_of_feature(spark, folder):
    found = with_provider(s.features(spark, folder), s.catalogue(spark, folder))
    return found.select("station_id", "provider")


@query(f"""
    with {s.FEATURES_SQL}, {GROUPS_SQL}
    select station_id, "group" from routed
""")
def features_by_group(spark, folder):
    """Every feature with its level x geometry group; a source goes as a whole."""
    codes = s.levels(spark, folder)
    return grouping.route(s.features(spark, folder)).select("station_id", "group")


@query(f"""
    with {s.FEATURES_SQL}, {GROUPS_SQL}
    select "group", count(distinct source) as sources, count(*) as features
    from routed group by "group"
""")
def group_sizes(spark, folder):
    routed = grouping.route(s.features(spark, folder))
    return grouping.group_summary(routed)


@query(f"""
    with {s.FEATURES_SQL}, {GROUPS_SQL}
    select case when "group" = 'bast' then 'svz_bast' when "group" in ('lines', 'points')
        then 'svz_de' else 'svz_kommunal' end as dataset, max(year) as year,
        cast(max(year) as varchar) as vintage
    from routed group by 1
""")
def newest_year_per_dataset(spark, folder):
    routed = grouping.route(s.features(spark, folder))
    return cat.dataset_years(routed).withColumn(
        "vintage", cat.vintage(F.lit("auto"), F.col("year"))
    )


@query(f"""
    with {s.FEATURES_SQL}, {GROUPS_SQL}, years as (select case when "group" = 'bast' then 'svz_bast'
        when "group" in ('lines', 'points') then 'svz_de' else 'svz_kommunal' end as dataset,
        max(year) as year from routed group by 1)
    select d.dataset, d.file, y.year is not null as present, cast(y.year as varchar) as vintage
    from (select unnest(['svz_de', 'svz_bast', 'svz_kommunal']) as dataset,
        unnest(['tiles/svz_de', 'tiles/svz_bast', 'tiles/svz_kommunal']) as file) d
        left join years y on d.dataset = y.dataset
""")
def dataset_list(spark, folder):
    routed = grouping.route(s.features(spark, folder))
    years = cat.dataset_years(routed)
    keys = [r["dataset"] for r in years.select("dataset").collect()]  # three at most
    entries = cat.dataset_entries(cat.dataset_table(spark), years, keys)
    return entries.select("dataset", "file", "present", "vintage")


@query(f"""
    with {s.CATALOGUE_SQL}
    select level, count(*) as sources from catalogue where status = 'live' group by level
""")
def live_sources_per_level(spark, folder):
    return cat.live_per_level(s.catalogue(spark, folder))


@query(f"""
    with {s.CATALOGUE_SQL}, shown as (
        select ord, code, name, level, year, metric from catalogue where status = 'live'
        union all select 2147483647, 'hvs', 'UBA-Hauptverkehrsstraßen', 'bund', 2021, 'DTV≈')
    select code, name, level, year, metric,
        case level when 'land' then 1 when 'kommune' then 2 else 3 end as panel,
        cast(row_number() over (partition by level order by
            case when level <> 'bund' then lower(name) end, ord) as integer) as place
    from shown
""")
def panel_sources(spark, folder):
    """Live sources and the external one in panel order, numbered inside their level."""
    from pyspark.sql import Window

    shown = cat.viewer_sources(s.catalogue(spark, folder))
    by_name = F.when(F.col("level") != "bund", F.collate("name", "de"))
    place = F.row_number().over(Window.partitionBy("level").orderBy(by_name, "ord"))
    return shown.select(
        "code", "name", "level", "year", "metric", F.col("panel").cast("int").alias("panel"),
        place.alias("place"),
    )


@query(f"""
    with {s.FEATURES_SQL}, {STATS_SQL}
    select code as source, name, 8 as minzoom, round((west + east) / 2, 6) as lon,
        round((south + north) / 2, 6) as lat
    from catalogue c join stats on code = source
    where status = 'live' and level = 'kommune'
""")
def overview_markers(spark, folder):
    entries = cat.source_entries(
        s.catalogue(spark, folder), cat.source_stats(s.features(spark, folder))
    )
    return cat.overview_markers(entries).select(
        "source", "name", "minzoom", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat")
    )


@query(f"""
    with {s.FEATURES_SQL}, {STATS_SQL}
    select cast(ord as integer) as ord, code, name, level, n,
        west is not null as has_box, round(west, 4) as west
    from catalogue c left join (select * from stats where source in (select code from catalogue where status = 'live')) t
        on c.code = t.source
""")
def catalogue_json(spark, folder):
    """The catalogue as JSON texts, read back: keys without a value are absent."""
    entries = cat.source_entries(s.catalogue(spark, folder), _built_stats(spark, folder))
    texts = cat.source_json(entries)
    e = F.col("entry")
    return texts.select(
        F.col("ord").cast("int").alias("ord"),
        "code",
        F.get_json_object(e, "$.name").alias("name"),
        F.get_json_object(e, "$.level").alias("level"),
        F.get_json_object(e, "$.n").cast("bigint").alias("n"),
        e.contains('"bbox"').alias("has_box"),
        F.get_json_object(e, "$.bbox[0]").cast("double").alias("west"),
    )


@query(f"""
    with {BROKEN_SQL}, counted as (select source, {RULES_SQL} from broken group by source),
    failed as (select source, sum(n) as bad from counted
        where rule in ('enum:level', 'null:road_class') and n > 0 group by source having sum(n) > {{limit}}),
    per_source as (select source, cast(substr(source, 2) as integer) as ord, count(*) as n
        from broken group by source)
    select case when f.source is null then 'ok' else 'failed' end as state,
        cast(sum(case when f.source is null then p.n end) as bigint) as features,
        string_agg(p.source, ',' order by p.ord) as codes, count(*) as entries
    from per_source p left join failed f on p.source = f.source group by 1
""".replace("{limit}", "0").replace(" having sum(n) > 0", " having sum(n) > (select avg(b) from (select source, sum(n) as b from counted where rule in ('enum:level', 'null:road_class') group by source))"))
def run_summary(spark, folder):
    """Outcome per source as a run table: sources with more broken rows than average fail."""
    rows = damaged(spark, folder)
    wanted = F.col("rule").isin("enum:level", "null:road_class")
    broken = (
        contract.violations(rows, ["source"]).filter(wanted).groupBy("source")
        .agg(F.sum("n").alias("bad"))
    )
    sizes = rows.groupBy("source").agg(F.count("*").alias("n"))
    both = sizes.join(broken, "source", "left").withColumn("bad", F.coalesce("bad", F.lit(0)))
    both = both.withColumn("mean", F.avg("bad").over(Window.partitionBy()))  # a row per source
    ok = F.col("bad") <= F.col("mean")
    runs = both.select(
        F.lit("build").alias("stage"), F.lit("1").alias("run"),
        F.substr("source", F.lit(2)).cast("int").alias("ord"), F.col("source").alias("code"),
        F.when(ok, F.col("n")).alias("n"),
        F.when(~ok, F.concat(F.lit("ContractError: "), F.col("bad").cast("string"))).alias("error"),
    )
    return build_summary(runs).select(
        "state", "features", F.array_join("codes", ",").alias("codes"),
        F.size("codes").cast("bigint").alias("entries"),
    )
