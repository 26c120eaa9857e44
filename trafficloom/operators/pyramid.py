"""Tiles as two tables: every feature once, and a narrow index of the tiles that show it.

A long line meets thousands of tiles. In the plain tile table (``tiles.tile_index``) its geometry and
attributes are written, and shuffled, once for each; here a tile holds the feature's number only.
A feature is cut once, at the last zoom. The tiles further out are those around its tiles: half the
column, half the row, zoom by zoom, inside the feature's own row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficloom.catalogue_data import Profile
from trafficloom.functions import geometry as geo
from trafficloom.functions import tiling
from trafficloom.operators import chains
from trafficloom.operators.tiles import TILE, Zooms, cap_per_tile, drop_densest, feature_bytes, thin, zooms_of

NUMBER = "feature"


def numbered(df: DataFrame, path: str | None = None) -> DataFrame:
    """The features with a number each, written to ``path`` or else the shared folder: numbers given
    to rows must not change when a task is repeated. Rows alike in everything keep numbers of their
    own; numbers rise in the order of the rows, so features near each other have near numbers."""
    out = df.withColumn(NUMBER, F.monotonically_increasing_id())
    if path is None:
        return chains.saved(out)
    out.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(out.schema).parquet(path)


def rolled_up(last: Column, steps: Column) -> Column:
    """Lists of tiles: those given, those of the zoom before, and so on for so many steps."""
    levels = F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>"))

    def outwards(found: Column, _: Column) -> Column:
        around = F.transform(
            F.element_at(found, -1), lambda t: tiling.tile(F.shiftright(t, 33), F.shiftright(tiling.row_of(t), 1))
        )
        return F.concat(found, F.array(F.array_distinct(around)))

    return F.aggregate(levels, F.array(last), outwards)


def shown_in(df: DataFrame, zooms: Zooms, keep: Sequence[str] = ()) -> DataFrame:
    """``(keep, _u, _v, z, x, y)``: a row per feature and tile, without its geometry. ``_u`` and
    ``_v`` are the middle of its envelope in the unit square. Missing and empty geometries are in no
    tile, nor are features whose first zoom lies behind the last."""
    shape = tiling.unit_parts(F.col("geometry"))
    unit = df.withColumns({"_first": zooms.first, "_last": zooms.last, "_unit": shape})
    box = geo.bounds_of_parts(F.col("_unit"))
    placed = unit.filter("_first <= _last").select(
        *keep, "_first", "_last", tiling.segments(F.col("_unit")).alias("_segments"), box.alias("_box")
    )
    size = tiling.scale(F.col("_last"))
    cut = tiling.box_tiles(F.col("_box"), tiling.cover(F.col("_segments"), size), size)
    middle = [((F.col(f"_box.{a}min") + F.col(f"_box.{a}max")) / 2.0).alias(n) for a, n in (("x", "_u"), ("y", "_v"))]
    levels = rolled_up(cut, (F.col("_last") - F.col("_first")).cast("int"))
    rows = placed.select(*keep, "_last", *middle, F.posexplode(levels).alias("_step", "_tiles"))
    rows = rows.select(*keep, "_u", "_v", (F.col("_last") - F.col("_step")).alias("z"), F.explode("_tiles").alias("_t"))
    return rows.withColumns({"x": tiling.tile_x(F.col("_t")), "y": tiling.tile_y(F.col("_t"))}).drop("_t")


def narrow_index(
    features: DataFrame, profile: Profile, layer: str | None = None, key: Column | None = None
) -> DataFrame:
    """``(layer, z, x, y, feature)`` of numbered features of one group, thinned and limited as the
    profile says; ``key`` as for ``tiles.tile_index``. What decides travels as single numbers: a row
    is as wide for a line of a million points as for a point."""
    if profile.coalesce:
        raise ValueError("merged features have shapes of their own in every tile: use tiles.tile_index")
    if profile.max_bytes and not profile.drop_densest:
        raise ValueError("a limit of bytes needs drop_densest")
    own = [c for c in features.columns if c != NUMBER]
    carried = {"_key": F.xxhash64(*own) if key is None else key, "_count": F.col("dtv_kfz")}
    if profile.drop_densest:
        carried["_size"] = feature_bytes([c for c in own if c != "geometry"])
    out = shown_in(features.withColumns(carried), zooms_of(profile), [NUMBER, *carried])
    out = out.withColumn("layer", F.lit(layer or profile.layer))
    base = profile.maxzoom if profile.base_zoom is None else profile.base_zoom
    out = thin(out, profile.drop_rate, base, F.col("_key"))
    if profile.drop_densest:
        out = drop_densest(out, F.col("_key"), F.col("_size"), profile.max_features, profile.max_bytes)
    elif profile.max_features:
        out = cap_per_tile(out.withColumnRenamed("_count", "dtv_kfz"), profile.max_features, F.col("_key"))
    return out.select(*TILE, NUMBER)


def with_features(index: DataFrame, features: DataFrame) -> DataFrame:
    """The rows of the plain tile table: each tile's features in full. Meant for a part of the index,
    a tile or a zoom; of those, a feature's geometry is read once."""
    rows = features.join(index, NUMBER)
    return rows.select(*TILE, *[c for c in features.columns if c != NUMBER])
