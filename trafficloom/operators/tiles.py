"""Cutting features into a zoom-dependent tile table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trafficloom.catalogue_data import DATASETS, PROFILES, Profile
from trafficloom.functions import geometry as geo
from trafficloom.functions import joining, tiling
from trafficloom.model import POINT_KINDS
from trafficloom.operators import chains

TILE = ("layer", "z", "x", "y")
SALTS = 64  # shares of a tile in the first ranking round
CROWD = 16_384  # points of a block of tiles with the same attributes that one row may hold
TASK_POINTS = 2_000_000  # points that one task joins


def cast_attributes(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns})


class Zooms(NamedTuple):
    """First and last zoom of a row."""

    first: Column
    last: Column


def zooms_of(profile: Profile) -> Zooms:
    start = tiling.first_zoom(F.col("dtv_kfz"), profile.minzoom, bool(profile.ladder))
    return Zooms(start, F.lit(profile.maxzoom))


def spread(df: DataFrame, zooms: Zooms) -> DataFrame:
    return df.withColumn("z", F.explode(F.sequence(zooms.first, zooms.last)))


def zoom_rows(df: DataFrame, profile: Profile) -> DataFrame:
    """One row per feature and zoom it shows at; only those zooms are ever produced."""
    return spread(df, zooms_of(profile))


def thin(df: DataFrame, rate: float, base_zoom: int, key: Column) -> DataFrame:
    """Below the base zoom keep one feature in ``rate`` per zoom step, the same ones each time.

    Rate 0 or 1 keeps all. ``key`` is a whole number spread evenly over the features.
    """
    if rate <= 1:
        return df
    steps = F.greatest(F.lit(base_zoom) - F.col("z"), F.lit(0))
    keep_one_in = F.greatest(F.floor(F.pow(F.lit(float(rate)), steps)), F.lit(1))
    return df.filter(F.pmod(key, keep_one_in.cast("bigint")) == 0)


def point_index(df: DataFrame, zooms: Zooms) -> DataFrame:
    """Tiles of single points: flat arithmetic, one row per point and zoom. ``_u`` and ``_v`` are
    the point in the unit square."""
    first = geo.first_point(F.col("geometry"))
    placed = df.withColumn("_p", first).withColumns(
        {"_u": tiling.unit_x(F.col("_p.x")), "_v": tiling.unit_y(F.col("_p.y"))}
    )
    size = tiling.scale(F.col("z"))
    return (
        spread(placed, zooms)
        .withColumns(
            {
                "x": tiling.cell(F.col("_u") * size).cast("int"),
                "y": tiling.cell(F.col("_v") * size).cast("int"),
            }
        )
        .drop("_p")
    )


def shape_index(df: DataFrame, zooms: Zooms, clamped: bool = True) -> DataFrame:
    """Tiles of any geometry: worked out inside the feature's row, so nothing is shuffled. ``_u`` and
    ``_v`` are the middle of the envelope in the unit square."""
    unit = df.withColumn("_unit", tiling.unit_parts(F.col("geometry"), clamped))
    boxed = unit.withColumn("_box", geo.bounds_of_parts(F.col("_unit")))
    # What lies inside one tile at the last zoom does so at all others: nobody asks for its segments.
    walked = ~F.coalesce(tiling.in_one_tile(F.col("_box"), tiling.scale(zooms.last)), F.lit(False))
    placed = boxed.withColumn("_segments", F.when(walked, tiling.segments(F.col("_unit")))).drop("_unit")
    middle = {
        "_u": (F.col("_box.xmin") + F.col("_box.xmax")) / 2.0,
        "_v": (F.col("_box.ymin") + F.col("_box.ymax")) / 2.0,
    }
    placed = placed.withColumns(middle)
    sized = spread(placed, zooms).withColumn("_size", tiling.scale(F.col("z")))
    size = F.col("_size")
    tiles = tiling.box_tiles(F.col("_box"), tiling.cover(F.col("_segments"), size), size)
    return (
        sized.withColumn("_t", F.explode(tiles))
        .withColumns({"x": tiling.tile_x(F.col("_t")), "y": tiling.tile_y(F.col("_t"))})
        .drop("_segments", "_box", "_size", "_t")
    )


def tile_index(
    df: DataFrame,
    profile: Profile,
    layer: str | None = None,
    single_points: bool = False,
    key: Column | None = None,
    clamped: bool = True,
) -> DataFrame:
    """Rows ``(layer, z, x, y, attributes, geometry)`` of one group.

    ``single_points`` promises that every geometry is a Point. ``key`` is the feature's number
    for the thinning and for breaking ties under a feature limit. What lies beyond the edges of the
    map is in its outermost tiles, or unless ``clamped`` in tiles beyond them.
    """
    if single_points and not clamped:
        raise ValueError("single points are always moved to the edges")
    key = F.xxhash64(*df.columns) if key is None else key
    keyed = cast_attributes(df, dict(profile.types)).withColumn("_key", key)
    zooms = zooms_of(profile)
    cut = point_index(keyed, zooms) if single_points else shape_index(keyed, zooms, clamped)
    out = cut.withColumn("layer", F.lit(layer or profile.layer))
    base = profile.maxzoom if profile.base_zoom is None else profile.base_zoom
    out = thin(out, profile.drop_rate, base, F.col("_key"))
    if profile.coalesce:
        out = coalesce_features(out.drop("_key"), [c for c in df.columns if c != "geometry"])
        box = geo.bounds_of_parts(tiling.unit_parts(F.col("geometry"), clamped))
        out = out.withColumns({"_key": F.xxhash64(*df.columns), "_box": box})
        middle = {a: (F.col(f"_box.{m}min") + F.col(f"_box.{m}max")) / 2.0 for a, m in (("_u", "x"), ("_v", "y"))}
        out = out.withColumns(middle).drop("_box")
    if profile.drop_densest:
        size = feature_bytes([c for c in df.columns if c != "geometry"])
        out = drop_densest(out, F.col("_key"), size, profile.max_features, profile.max_bytes)
    elif profile.max_bytes:
        raise ValueError("a limit of bytes needs drop_densest")
    elif profile.max_features:
        out = cap_per_tile(out, profile.max_features, F.col("_key"))
    return out.select(*TILE, *df.columns)


def cap_per_tile(df: DataFrame, limit: int, tie: Column) -> DataFrame:
    """The ``limit`` busiest features of each tile.

    A low-zoom tile may hold a large share of everything: features are ranked in ``SALTS`` shares
    of the tile before the best of each share meet.
    """
    order = [F.desc_nulls_last("dtv_kfz"), tie]
    out = df.withColumn("_salt", F.pmod(F.xxhash64(tie), F.lit(SALTS)))
    for place in ([*TILE, "_salt"], list(TILE)):
        rank = F.row_number().over(Window.partitionBy(*place).orderBy(*order))
        out = out.withColumn("_rank", rank).filter(F.col("_rank") <= limit).drop("_rank")
    return out.drop("_salt")


def feature_bytes(attributes: Sequence[str]) -> Column:
    """What a feature takes in a tile, roughly: its attributes as text and 16 bytes a vertex."""
    size = geo.point_count(F.col("geometry")) * 16
    for c in attributes:
        size = size + F.octet_length(F.coalesce(F.col(c).cast("string"), F.lit("")))
    return size


def drop_densest(
    df: DataFrame,
    key: Column,
    size: Column,
    max_features: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Tiles over a limit lose what stands closest together, as little as needed.

    Features of a tile are ordered along a space-filling curve. At gap 1 those stay that stand on
    another place than the one before them, at gap 2 the places are four times as large, and so on
    until one feature is left: the first of each place. A tile takes the smallest gap whose features
    and bytes are within the limits. ``key`` tells features apart and breaks ties; in a tile over
    its limits, rows with one key count as one.

    A feature stays at all gaps below the one that puts it on the place of the feature before it, so
    one ordering serves all gaps. A map task sends one row per place at most, however many features
    a tile has, and no task sorts a whole tile. The features themselves are only filtered.
    """
    if not max_features and not max_bytes:
        return df
    curve = tiling.curve_in_tile(F.col("_u"), F.col("_v"), F.col("z"), F.col("x"), F.col("y"))
    df = df.withColumn("_id", key)
    narrow = chains.saved(df.select(*TILE, "_id", curve.alias("_curve"), size.cast("bigint").alias("_bytes")))

    def fits(n: str, total: str) -> Column:
        good = F.lit(True)
        if max_features:
            good = good & (F.col(n) <= max_features)
        if max_bytes:
            good = good & (F.col(total) <= max_bytes)
        return good

    tiles = narrow.groupBy(*TILE).agg(F.count("*").alias("_n"), F.sum("_bytes").alias("_total"))
    over = tiles.filter(~fits("_n", "_total")).select(*TILE)
    crowded = narrow.join(over, list(TILE), "left_semi")
    # Of the features at one place of the curve the first stays longest, the others at no gap.
    places = crowded.groupBy(*TILE, "_curve").agg(F.min(F.struct("_id", "_bytes")).alias("_first"))
    # How many gaps tell a place from the one before it: first among neighbours, then among the
    # first places of the neighbourhoods, of which a tile has 2^12.
    half = tiling.CURVE_BITS // 2
    near = Window.partitionBy(*TILE, F.shiftright("_curve", 2 * half)).orderBy("_curve")
    places = places.withColumn("_apart", _gaps_apart(F.lag("_curve").over(near)))
    heads = places.filter("_apart is null")
    among = F.lag("_curve").over(Window.partitionBy(*TILE).orderBy("_curve"))
    heads = heads.withColumn("_apart", F.coalesce(_gaps_apart(among), F.lit(tiling.CURVE_BITS + 1)))
    apart = chains.saved(places.filter("_apart is not null").unionByName(heads).select(
        *TILE, "_apart", F.col("_first._id").alias("_id"), F.col("_first._bytes").alias("_bytes")
    ))
    counted = apart.groupBy(*TILE, "_apart").agg(F.count("*").alias("_n"), F.sum("_bytes").alias("_bytes"))
    gaps = range(tiling.CURVE_BITS + 1)
    stay = [F.col("_apart") > gap for gap in gaps]
    counted = counted.groupBy(*TILE).agg(
        *[F.sum(F.when(on, F.col("_n"))).alias(f"_n{gap}") for gap, on in zip(gaps, stay)],
        *[F.sum(F.when(on, F.col("_bytes"))).alias(f"_total{gap}") for gap, on in zip(gaps, stay)],
    )
    first_fit = F.coalesce(*[F.when(fits(f"_n{gap}", f"_total{gap}"), gap) for gap in gaps], F.lit(gaps[-1]))
    chosen = counted.select(*TILE, first_fit.alias("_gap"))
    kept = apart.join(chosen, list(TILE)).filter(F.col("_apart") > F.col("_gap")).select(*TILE, "_id")
    calm = df.join(over, list(TILE), "left_anti")
    thinned = df.join(kept, [*TILE, "_id"], "left_semi").dropDuplicates([*TILE, "_id"])
    return calm.unionByName(thinned).drop("_id")


def _gaps_apart(before: Column) -> Column:
    """The number of gaps at which ``_curve`` and the place before it are two places."""
    differ = F.col("_curve").bitwiseXOR(before)
    return F.when(differ == 0, 0).otherwise(F.ceil(F.length(F.bin(differ)) / 2)).cast("int")


def coalesce_features(df: DataFrame, attributes: Sequence[str], joined: bool = True) -> DataFrame:
    """Features of one tile with the same attributes become one where they touch.

    ``joined=False`` only makes one of those that lie on each other. Otherwise lines are joined end to end at every point where exactly two ends meet, whichever way they were
    drawn; where more meet, or none, a line ends. Parts that repeat, in either direction, and points
    at one place count once. ``copies`` is the number of parts in a row. A line runs from its
    smaller end; a closed one starts at the smallest of the points it was joined at.
    """
    keys = [*TILE, *attributes]
    shape = F.col("geometry")
    point = shape["kind"].isin(*POINT_KINDS)
    parts = df.select(
        *keys, point.alias("_point"), shape["srid"].alias("_srid"), F.explode(shape["parts"]).alias("_part")
    )
    parts = parts.withColumn("_part", F.least("_part", F.reverse("_part")))
    if not joined:
        once = _counted(parts, keys)
        one = geo.geometry(_kind(), F.col("_srid"), F.array("_part"))
        return once.select(*keys, one.alias("geometry"), "copies")
    parts = parts.withColumn("_line", F.coalesce(~F.col("_point") & (F.size("_part") > 1), F.lit(False)))
    own = [*keys, "_point", "_srid", "_line"]
    # A block is a tile of every fourth zoom with those inside it. Its rows stay together, so what they
    # share travels once, and a block that is not crowded has no crowded tile.
    z = F.expr("z & 3")
    block = F.xxhash64("layer", F.col("z") - z, *[F.expr(f"shiftright({c}, z & 3)") for c in "xy"], *own[len(TILE):])
    parts = parts.withColumn("_block", block)
    crowded, tasks = _crowded(parts)
    calm = parts if crowded is None else parts.join(crowded, "_block", "left_anti")
    calm = calm.repartition(tasks, "_block") if tasks else calm.repartition("_block")
    # The hash comes first for the sake of sorting only.
    found = F.sort_array(F.collect_list(joining.with_codes(F.col("_part"))))
    lists = calm.groupBy(F.xxhash64(*own).alias("_group"), "_block", *own).agg(found.alias("_parts"))
    made = F.when(F.col("_line"), joining.joined(F.col("_parts"))).otherwise(joining.counted(F.col("_parts")))
    made = lists.select(*keys, "_point", "_srid", F.explode(made).alias("_made"))
    one = geo.geometry(_kind(), F.col("_srid"), F.array("_made.part"))
    out = made.select(*keys, one.alias("geometry"), F.col("_made.copies").alias("copies"))
    if crowded is None:
        return out
    return out.unionByName(_joined_by_jumps(parts.join(crowded, "_block", "left_semi"), keys))


def _kind() -> Column:
    return F.when(F.col("_point"), "Point").otherwise("LineString")


def _counted(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return parts.groupBy(*keys, "_point", "_srid", "_part").agg(F.count("*").alias("copies"))


def _crowded(parts: DataFrame) -> tuple[DataFrame | None, int | None]:
    """The blocks of more than ``CROWD`` points, if any, and the number of tasks for all others where
    that is more than one task's work."""
    sizes = parts.groupBy("_block").agg(F.sum(F.greatest(F.size("_part"), F.lit(1))).alias("_n"))
    shares = sizes.groupBy(F.when(F.col("_n") > CROWD, F.col("_block")).alias("_block")).agg(F.sum("_n").alias("_n"))
    shares = chains.saved(shares)
    totals = shares.agg(F.sum(F.when(F.col("_block").isNull(), F.col("_n"))), F.count("_block")).first()
    tasks = -(-(totals[0] or 0) // TASK_POINTS)
    usual = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    crowded = shares.filter("_block is not null").select("_block") if totals[1] else None
    return crowded, max(tasks, usual) if tasks > 1 else None


def _joined_by_jumps(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``coalesce_features`` of parts of crowded tiles: no task holds all of a group."""
    # Numbers given to rows must not change when a task is repeated.
    parts = chains.saved(_counted(parts, keys).withColumn("_edge", F.monotonically_increasing_id()))
    placed = _chains(parts.filter("not _point"), [*keys, "_srid"])
    rows = parts.join(placed, "_edge", "left")
    alone = rows.filter("_chain is null").select(*keys, "_srid", "copies", _kind().alias("_kind"), "_part")
    linked = rows.filter("_chain is not null").groupBy("_chain").agg(
        *[F.any_value(k).alias(k) for k in (*keys, "_srid")],
        F.sum("copies").alias("copies"),
        F.any_value("_ring").alias("_ring"),
        F.array_sort(F.collect_list(F.struct("_at", _directed().alias("_part")))).alias("_parts"),
    )
    linked = linked.withColumn("_parts", F.col("_parts._part"))
    line = joining.one_line(F.col("_parts"), F.col("_ring"))
    lines = linked.select(*keys, "_srid", "copies", F.lit("LineString").alias("_kind"), line.alias("_part"))
    one = geo.geometry(F.col("_kind"), F.col("_srid"), F.array("_part"))
    return alone.unionByName(lines).select(*keys, one.alias("geometry"), "copies")


def _chains(edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(_edge, _chain, _at, _back, _ring)`` of the lines that touch another: which chain, which
    place in it, and whether the line is drawn against it.

    An end of a line is the number ``2 * edge + side``, side 0 its first point. Standing for walking
    into the line at that end, it is also a state of the walk: the walk that enters at an end comes
    from the line whose end it touches, entered at that line's other end.
    """
    # Ends only meet within a tile and attributes; their hash and the point stand for both.
    ends = edges.filter(F.size("_part") > 1).select(
        F.xxhash64(*keys).alias("_group"),
        F.explode(
            F.array(
                F.struct((F.col("_edge") * 2).alias("end"), F.get("_part", F.lit(0)).alias("at")),
                F.struct((F.col("_edge") * 2 + 1).alias("end"), F.element_at("_part", -1).alias("at")),
            )
        ).alias("_e"),
    )
    nodes = ends.groupBy("_group", "_e.at").agg(
        F.count("*").alias("n"), F.min("_e.end").alias("a"), F.max("_e.end").alias("b")
    )
    # Two ends of one line make it closed: it touches no other.
    met = nodes.filter((F.col("n") == 2) & (F.shiftright("a", 1) != F.shiftright("b", 1)))
    met = chains.saved(met.select("a", "b"))
    other = F.col("a").bitwiseXOR(F.lit(1).cast("bigint"))
    ways = met.select(F.col("b").alias("state"), other.alias("prev")).unionByName(
        met.select(F.col("a").alias("state"), F.col("b").bitwiseXOR(F.lit(1).cast("bigint")).alias("prev"))
    )
    # The far ends of linked lines are states as well, also those that touch nothing.
    far = ways.select(F.explode(F.array("state", F.col("state").bitwiseXOR(F.lit(1).cast("bigint")))).alias("state"))
    states = far.distinct().join(ways, "state", "left")
    walks = chains.ranked(states)
    # Both walks of a line meet the same chain from its two ends: the one from the smaller counts.
    edge = F.shiftright("state", 1).alias("_edge")
    best = walks.groupBy(edge).agg(F.min(F.struct("root", "at", "state", "ring")).alias("w"))
    return best.select(
        "_edge",
        F.col("w.root").alias("_chain"),
        F.col("w.at").alias("_at"),
        (F.col("w.state") % 2 == 1).alias("_back"),
        F.col("w.ring").alias("_ring"),
    )


def _directed() -> Column:
    return F.when(F.col("_back"), F.reverse("_part")).otherwise(F.col("_part"))


def combine(layers: Sequence[DataFrame]) -> DataFrame:
    """One dataset out of several layers."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), layers)


def all_alike(profiles: Sequence[Profile]) -> bool:
    """Do the profiles only differ in layer, zooms and ladder?"""
    return all(
        p.drop_rate <= 1 and not p.max_features and not p.drop_densest and not p.coalesce and p.types == profiles[0].types
        for p in profiles
    )


def one_pass(routed: DataFrame, profiles: Mapping[str, Profile]) -> DataFrame:
    """Tiles of several groups in one scan, each row with its own group's layer and zooms."""

    def by_group(value: Callable[[Profile], Column]) -> Column:
        out = None
        for group, profile in profiles.items():
            when = F.when if out is None else out.when
            out = when(F.col("group") == group, value(profile))
        return out

    first = next(iter(profiles.values()))
    rows = cast_attributes(routed.filter(F.col("group").isin(*profiles)), dict(first.types))
    zooms = Zooms(by_group(lambda p: zooms_of(p).first), by_group(lambda p: zooms_of(p).last))
    layer = by_group(lambda p: F.lit(p.layer))
    return shape_index(rows.withColumn("layer", layer), zooms)


def dataset_tiles(
    routed: DataFrame,
    present: Sequence[str],
    only: Sequence[str] | None = None,
    profiles: Mapping[str, Profile] = PROFILES,
) -> DataFrame:
    """Tiles of all datasets (or the ones named) whose groups are present.

    Profiles without thinning, limit or merging share one scan of the features.
    """
    wanted = {
        group: dataset.key
        for dataset in DATASETS
        for group in dataset.groups
        if group in present and (not only or dataset.key in only)
    }
    if not wanted:
        raise FileNotFoundError("no merged group to cut into tiles")
    chosen = {group: profiles[group] for group in wanted}
    columns = [c for c in routed.columns if c != "group"]
    if all_alike(list(chosen.values())):
        cut = one_pass(routed, chosen)
    else:
        cut = combine(
            [
                tile_index(routed.filter(F.col("group") == group).drop("group"), profile)
                .withColumn("group", F.lit(group))
                for group, profile in chosen.items()
            ]
        )
    dataset = F.create_map(*[F.lit(t) for pair in wanted.items() for t in pair])
    return cut.select(dataset[F.col("group")].alias("dataset"), *TILE, *columns)
