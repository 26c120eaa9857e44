"""Tiles as two tables: the same rows as the plain tile table, and no geometry in a shuffle."""

import random

import pytest
from pyspark.sql import functions as F

from trafficloom.catalogue_data import DATASETS, PROFILES, Profile
from trafficloom.functions import geometry as geo
from trafficloom.operators import pyramid
from trafficloom.operators import tiles as ops
from trafficloom.plans import jobs

from test_jobs import canonical_rows


def roads(spark, n, seed):
    """Lines of up to 40 points in one to three parts, some across many tiles, points, repeats."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.choice((1, 1, 1, 2, 3))):
            x, y, far = 6 + 8 * rng.random(), 47 + 7 * rng.random(), rng.choice((0.001, 0.02, 0.3))
            points = [(x, y)]
            for _ in range(rng.choice((0, 1, 5, 40))):
                x, y = x + far * rng.gauss(0, 1), y + far * rng.gauss(0, 1)
                points.append((x, y))
            parts.append(points)
        rows.append((i, rng.choice((None, 0, 500, 1500, 5000, 50000)), "n" * (i % 7), ("MultiLineString", 4326, parts)))
    rows += rows[:5] + [(-1, 10**6, "none", None), (-2, 10**6, "empty", ("LineString", 4326, []))]
    shape = "geometry struct<kind:string,srid:int,parts:array<array<struct<x:double,y:double>>>>"
    return spark.createDataFrame(rows, f"id long, dtv_kfz int, name string, {shape}")


def rows_of(df):
    return sorted(map(tuple, df.select("z", "x", "y", "id", "name").collect()))


LIMITS = [
    {},
    {"drop_rate": 2.0, "base_zoom": 9},
    {"max_features": 3},
    {"max_features": 4, "max_bytes": 900, "drop_densest": True},
    {"minzoom": 11, "ladder": False},
]


@pytest.mark.parametrize("limits", LIMITS, ids=str)
def test_two_tables_hold_the_rows_of_one(spark, limits):
    profile = Profile("t", 4, 11, types=())._replace(**{"ladder": True, **limits})
    df = roads(spark, 60, 3).dropDuplicates(["id"])
    stored = pyramid.numbered(df.repartition(7))
    index = pyramid.narrow_index(stored, profile, key=F.col("id"))
    assert index.columns == [*ops.TILE, "feature"]
    assert rows_of(pyramid.with_features(index, stored)) == rows_of(ops.tile_index(df, profile, key=F.col("id")))


def test_equal_rows_stay_apart_and_tables_may_be_empty(spark):
    profile = Profile("t", 4, 9, types=())
    df = roads(spark, 30, 4)
    stored = pyramid.numbered(df)
    index = pyramid.narrow_index(stored, profile)
    assert rows_of(pyramid.with_features(index, stored)) == rows_of(ops.tile_index(df, profile))
    # Neither a missing shape nor one without points is in a tile.
    assert pyramid.with_features(index, stored).filter("id < 0").isEmpty()
    none = pyramid.numbered(df.limit(0))
    assert pyramid.narrow_index(none, profile).count() == 0
    clashing = pyramid.numbered(df.withColumns({"_u": F.lit("x"), "_t": F.lit(1), "size": F.lit(2)}))
    assert pyramid.narrow_index(clashing, profile).count() == index.count()
    for wrong in ({"coalesce": True}, {"max_bytes": 9}):
        with pytest.raises(ValueError):
            pyramid.narrow_index(stored, profile._replace(**wrong))


def shuffled(df):
    df._jdf.queryExecution().toRdd().count()  # noqa: SLF001
    plan = df._jdf.queryExecution().executedPlan()  # noqa: SLF001
    plan = plan.executedPlan() if "Adaptive" in plan.getClass().getName() else plan
    total, todo = 0, [plan]
    while todo:
        node = todo.pop()
        metrics = node.metrics()
        if metrics.contains("shuffleBytesWritten"):
            total += metrics.apply("shuffleBytesWritten").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        if node.getClass().getName().endswith("QueryStageExec"):
            todo.append(node.plan())
    return total


def test_shuffled_bytes_do_not_grow_with_the_points_of_a_line(spark):
    """The limit ranks the features of every tile: in two tables that moves numbers only."""
    profile = Profile("t", 6, 13, types=())._replace(max_features=5)

    def moved(points):
        x = F.transform(F.sequence(F.lit(0), F.lit(points)), lambda i: geo.xy(
            F.col("id") / 500.0 + 8.0 + i * (0.3 / points), F.col("id") % 50 / 90.0 + 49.0))
        df = spark.range(300).select(
            "id", F.lit(10**6).alias("dtv_kfz"), F.col("id").cast("string").alias("name"), geo.line(x).alias("geometry"))
        stored = pyramid.numbered(df)
        return (shuffled(pyramid.narrow_index(stored, profile, key=F.col("id"))),
                shuffled(ops.tile_index(df, profile, key=F.col("id"))))

    few, many = moved(2), moved(400)
    print("bytes shuffled", few, many)
    assert many[0] < 1.3 * few[0] and many[1] > 5 * many[0]


def test_written_tiles_are_read_alike(spark, tmp_path):
    warehouse = str(tmp_path)
    features = canonical_rows(spark, 400).withColumn("group", F.lit("lines"))
    path, n = jobs.checked_write(features, f"{warehouse}/features/r0", "merge", ["group", "source"], spread=True)
    jobs.record(spark, warehouse, [jobs.Run("merge", 0, "features", "r0", path, n, None)])
    key = next(d.key for d in DATASETS if "lines" in d.groups)
    columns = ["dataset", *ops.TILE, "dtv_kfz", "station_id", "geometry"]

    def read(condition=None):
        return sorted(map(str, jobs.read_tiles(spark, warehouse, key, condition).select(*columns).collect()))

    with pytest.raises(FileNotFoundError):
        read()
    jobs.build_tiles(spark, warehouse, run="r1")
    plain, one_zoom = read(), read(F.col("z") == 9)
    jobs.build_tiles(spark, warehouse, run="r2", two_tables=True)
    assert read() == plain and read(F.col("z") == 9) == one_zoom and one_zoom
    once = spark.read.parquet(f"{jobs.newest(spark, warehouse, 'tiles')[key]}/features")
    assert once.count() == 400 and PROFILES["lines"].maxzoom > 9
