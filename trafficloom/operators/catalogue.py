"""Source catalogue: counts, bounds and newest year per source, datasets, markers."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficloom.catalogue_data import (
    ACCESS,
    DATASETS,
    EXTERNAL_SOURCE,
    LEVEL_ORDER,
    MARKER_LEVELS,
    SORTED_LEVELS,
    SOURCES,
    Source,
    portal,
)
from trafficloom.functions import geometry as geo
from trafficloom.model import LEVELS

SOURCE_KEYS = ("name", "level", "state", "status", "kind", "year", "metric", "license")


def source_table(
    spark: SparkSession, sources: Sequence = SOURCES, places: Mapping[str, Mapping] | None = None
) -> DataFrame:
    """The hand-kept source list as a table, with where to fetch each source: ``places`` has the
    ``portal`` and ``access`` of those that state their own."""
    places = places or {}

    def place(code: str) -> tuple:
        own = places.get(code, {})
        access = own["access"] if "access" in own else ACCESS.get(code)
        links = [(a["label"], a["url"]) if isinstance(a, Mapping) else a for a in access or ()]
        return own["portal"] if "portal" in own else portal(code), links or None

    rows = [(i, *s, *place(s.code)) for i, s in enumerate(sources)]
    return spark.createDataFrame(
        rows,
        "ord int, code string, status string, level string, name string, state string, "
        "kind string, year int, license string, metric string, portal string, "
        "access array<struct<label:string,url:string>>",
    )


def read_source_table(spark: SparkSession, path: str) -> DataFrame:
    """A source list kept as a JSON object ``{code: {...}}`` beside the data."""
    listed = json.loads(spark.read.text(path, wholetext=True).first()["value"])
    if not isinstance(listed, dict):
        raise ValueError(f"{path} does not hold an object of sources")
    return source_table(
        spark,
        [Source(code, **{f: s.get(f) for f in Source._fields[1:]}) for code, s in listed.items()],
        listed,
    )


def dataset_table(spark: SparkSession) -> DataFrame:
    rows = [(i, d.key, d.file, d.label, d.attribution, d.date) for i, d in enumerate(DATASETS)]
    return spark.createDataFrame(
        rows, "ord int, dataset string, file string, label string, attribution string, date string"
    )


def with_bounds(features: DataFrame) -> DataFrame:
    """Flat envelope columns, unless the table was written with them."""
    if set(geo.BOX) <= set(features.columns):
        return features
    box = features.withColumn("_box", geo.bounds(F.col("geometry")))
    return box.withColumns({n: F.col(f"_box.{n}") for n in geo.BOX}).drop("_box")


def bounds_of(prefix: str = "") -> list[Column]:
    """Total bounds as aggregates, W, S, E, N, four decimals."""
    names = [prefix + n for n in ("west", "south", "east", "north")]
    parts = [F.min("xmin"), F.min("ymin"), F.max("xmax"), F.max("ymax")]
    return [geo.rounded(p).alias(n) for p, n in zip(parts, names)]


def source_stats(features: DataFrame) -> DataFrame:
    """Feature count, bounds and newest year per source: one partial aggregate per task."""
    return (
        with_bounds(features)
        .groupBy("source")
        .agg(F.count("*").alias("n"), *bounds_of(), F.max("year").alias("year"))
    )


def stats_of_points(features: DataFrame) -> DataFrame:
    """``source_stats`` of features in any known system: every point is a row on its way through the
    projection, which then compiles to plain arithmetic as it can't inside an array."""
    geometry = F.col("geometry")
    points = features.select(
        "source", "year", geometry["srid"].alias("_srid"), F.posexplode_outer(F.flatten(geometry["parts"])).alias("_at", "_p")
    ).select("source", "year", "_srid", "_at", F.col("_p.x").alias("_x"), F.col("_p.y").alias("_y"))
    lon, lat = [], []
    for srid in geo.ZONES:
        here = F.col("_srid") == srid
        points = points.withColumns({f"_x{srid}": F.when(here, F.col("_x")), f"_y{srid}": F.when(here, F.col("_y"))})
        points = geo.reproject_columns(points, srid, f"_x{srid}", f"_y{srid}", f"_lon{srid}", f"_lat{srid}")
        lon.append((here, F.col(f"_lon{srid}")))
        lat.append((here, F.col(f"_lat{srid}")))

    def moved(own: str, cases: Sequence[tuple[Column, Column]]) -> Column:
        out = F.when(F.col("_srid") == geo.SRID, F.col(own))
        for here, place in cases:
            out = out.when(here, place)
        return out.otherwise(F.col(own))

    x, y = moved("_x", lon), moved("_y", lat)
    box = points.withColumns({"xmin": x, "ymin": y, "xmax": x, "ymax": y})
    # A feature without points has one row, too, without a place.
    n = F.count_if(F.coalesce("_at", F.lit(0)) == 0).alias("n")
    return box.groupBy("source").agg(n, *bounds_of(), F.max("year").alias("year"))


def table_stats(features: DataFrame, code: str) -> DataFrame:
    """The same of a table that holds one source and was written with its envelope columns; read by
    ``footers.read`` it takes no row of it."""
    whole = features.agg(F.count("*").alias("n"), *bounds_of(), F.max("year").alias("year"))
    return whole.select(F.lit(code).alias("source"), *whole.columns)


def source_entries(catalogue: DataFrame, stats: DataFrame) -> DataFrame:
    """Every catalogued source, with statistics where it is built; data year wins."""
    found = stats.withColumnsRenamed({"source": "code", "year": "data_year"})
    return catalogue.join(found, "code", "left").withColumn(
        "year", F.coalesce("data_year", "year")
    ).drop("data_year")


def dataset_years(routed: DataFrame) -> DataFrame:
    """Newest year per dataset, read from the year and group columns alone."""
    pairs = F.create_map(
        *[F.lit(t) for d in DATASETS for g in d.groups for t in (g, d.key)]
    )
    newest = routed.groupBy("group").agg(F.max("year").alias("year"))
    return (
        newest.withColumn("dataset", pairs[F.col("group")])
        .groupBy("dataset")
        .agg(F.max("year").alias("year"))
    )


def vintage(date: Column, newest: Column) -> Column:
    fixed = F.when(date.startswith("fixed:"), F.substr(date, F.lit(7)))
    return F.when(date == "auto", newest.cast("string")).otherwise(fixed)


def dataset_entries(datasets: DataFrame, years: DataFrame, present: Sequence[str]) -> DataFrame:
    return (
        datasets.join(years.withColumnRenamed("year", "_newest"), "dataset", "left")
        .withColumns(
            {
                "vintage": vintage(F.col("date"), F.col("_newest")),
                "present": F.col("dataset").isin(*present) if present else F.lit(False),
                "built": F.date_format(F.current_date(), "yyyy-MM-dd"),
            }
        )
        .drop("_newest")
    )


def live_per_level(catalogue: DataFrame) -> DataFrame:
    return (
        catalogue.filter("status = 'live'")
        .groupBy("level")
        .agg(F.count("*").alias("sources"))
    )


def viewer_sources(entries: DataFrame) -> DataFrame:
    """Live sources of a known level plus the externally hosted one, with panel order."""
    spark = entries.sparkSession
    code, name, level, year, metric, license_ = EXTERNAL_SOURCE
    last = 2**31 - 1
    extra = spark.createDataFrame(
        [(last, code, name, level, year, metric, license_)],
        "ord int, code string, name string, level string, year int, metric string, "
        "license string",
    )
    shown = entries.filter((F.col("status") == "live") & F.col("level").isin(*LEVELS))
    both = shown.unionByName(extra, allowMissingColumns=True)
    levels = F.array(*[F.lit(x) for x in LEVEL_ORDER])
    by_name = F.when(F.col("level").isin(*SORTED_LEVELS), F.collate("name", "de"))
    return both.withColumn("panel", F.array_position(levels, F.col("level"))).orderBy(
        "panel", by_name, "ord"
    )


def overview_markers(entries: DataFrame) -> DataFrame:
    """One point per built source of a level that hides its features at low zooms."""
    least = F.create_map(*[F.lit(t) for pair in MARKER_LEVELS.items() for t in pair])
    return entries.filter(
        (F.col("status") == "live")
        & F.col("level").isin(*MARKER_LEVELS)
        & F.col("west").isNotNull()
    ).select(
        F.col("code").alias("source"),
        "name",
        least[F.col("level")].alias("minzoom"),
        ((F.col("west") + F.col("east")) / 2).alias("lon"),
        ((F.col("south") + F.col("north")) / 2).alias("lat"),
    )


def source_json(entries: DataFrame) -> DataFrame:
    """``(ord, code, entry)``; keys without a value are left out."""
    box = F.when(F.col("west").isNotNull(), F.array("west", "south", "east", "north"))
    fields = [*SOURCE_KEYS, *[c for c in ("portal", "access") if c in entries.columns]]
    return entries.select(
        "ord", "code", F.to_json(F.struct(*fields, "n", box.alias("bbox"))).alias("entry")
    )


def dataset_json(entries: DataFrame) -> DataFrame:
    return entries.select(
        "ord",
        F.col("dataset").alias("code"),
        F.to_json(
            F.struct("label", "attribution", "file", "present", "vintage", "built"),
            {"ignoreNullFields": "false"},
        ).alias("entry"),
    )
