"""Ranked lists, joined lines, density limits and medians against plain loops."""

import random
from collections import Counter, defaultdict
from statistics import median as plain_median

import pytest
from pyspark.sql import functions as F

from trafficloom.catalogue_data import Profile
from trafficloom.functions import geometry as geo
from trafficloom.functions import tiling
from trafficloom.operators import analyses, chains
from trafficloom.operators import tiles as ops


def lists_and_rings(rng):
    """state -> prev, with the place of every row in its list."""
    names = list(range(900))
    rng.shuffle(names)
    prev, want = {}, {}
    for length in (1, 1, 2, 3, 64, 65, 300):
        own = [names.pop() for _ in range(length)]
        for at, x in enumerate(own):
            prev[x], want[x] = (own[at - 1] if at else None), (own[0], at, False)
    for length in (1, 2, 3, 32, 33, 100):
        own = [names.pop() for _ in range(length)]
        start = own.index(min(own))
        for at, x in enumerate(own):
            prev[x], want[x] = own[at - 1], (min(own), (at - start) % length, True)
    return prev, want


@pytest.mark.parametrize("seed", range(2))
def test_lists_and_circles_are_ranked(spark, seed):
    prev, want = lists_and_rings(random.Random(seed))
    rows = spark.createDataFrame(list(prev.items()), "state long, prev long")
    got = {r.state: (r.root, r.at, r.ring) for r in chains.ranked(rows).collect()}
    assert got == want
    low = {r.state: r.low for r in chains.follow(rows).filter("ring").collect()}
    assert low == {x: root for x, (root, _, ring) in want.items() if ring}
    assert chains.ranked(rows.filter("1 = 0")).count() == 0


def joined(parts):
    """Lines joined where exactly two ends meet, by walking."""
    parts = sorted({min(tuple(p), tuple(p[::-1])) for p in parts})
    ends = defaultdict(list)
    for i, p in enumerate(parts):
        if len(p) > 1:
            ends[p[0]].append((i, 0))
            ends[p[-1]].append((i, 1))
    link = {}
    for met in ends.values():
        if len(met) == 2 and met[0][0] != met[1][0]:
            link[met[0]], link[met[1]] = met[1], met[0]
    left, out = set(range(len(parts))), []

    def walk(i, side):
        line, used = [], []
        while True:
            used.append(i)
            left.discard(i)
            p = parts[i] if side == 0 else parts[i][::-1]
            line += p[1:] if line else p
            after = link.get((i, 1 - side))
            if after is None or after[0] == used[0]:
                return line, used, after
            i, side = after

    for i in range(len(parts)):  # lists first: start at ends that touch nothing
        for side in (0, 1):
            if i in left and (i, side) not in link:
                line, used, _ = walk(i, side)
                out.append((min(tuple(line), tuple(line[::-1])), len(used)))
    while left:  # circles, from their smallest joint
        _, ring, _ = walk(min(left), 0)
        at = min(p for i in ring for p in (parts[i][0], parts[i][-1]))
        i, side = ends[at][0]
        line, used, _ = walk(i, side)
        out.append((min(tuple(line), tuple(line[::-1])), len(used)))
    return Counter(out)


def network(rng, n):
    points = [(float(rng.randrange(5)), float(rng.randrange(5))) for _ in range(14)]
    parts = [[rng.choice(points) for _ in range(rng.randint(2, 4))] for _ in range(n)]
    parts += [[(9.0, 9.0)], [(7.0, 7.0), (7.5, 7.0), (7.0, 7.0)]]
    for _ in range(2):  # long lists and circles of their own, drawn in any direction
        x, size, closed = 100.0 + 100 * rng.random(), rng.randint(2, 40), rng.random() < 0.5
        joints = [(x + i, rng.random()) for i in range(size + 1)]
        if closed:
            joints[-1] = joints[0]
        for a, b in zip(joints, joints[1:]):
            part = [a, (rng.random(), 50.0), b] if rng.random() < 0.5 else [a, b]
            parts.append(part[:: rng.choice((1, -1))])
    return [p for p in parts if len(p) < 2 or len(set(p)) > 1]


@pytest.mark.parametrize("seed", range(2))
def test_lines_are_joined_where_two_ends_meet(spark, seed):
    rng = random.Random(seed)
    rows, want = [], {}
    for x in range(5):
        for cls in "AB":
            parts = network(rng, rng.choice((0, 3, 8, 15)))
            want[x, cls] = joined(parts)
            parts += rng.sample(parts, 2)  # repeated, one of them the other way round
            parts[-1] = parts[-1][::-1]
            rows += [("t", 5, x, 0, cls, ("LineString", 4326, [p])) for p in parts]
    rng.shuffle(rows)
    df = spark.createDataFrame(
        rows, "layer string, z int, x int, y int, road_class string, "
        "geometry struct<kind:string,srid:int,parts:array<array<struct<x:double,y:double>>>>"
    ).repartition(7)
    got = defaultdict(list)
    made = ops.coalesce_features(df, ["road_class"]).collect()
    for r in made:
        got[r.x, r.road_class].append(tuple(tuple(p) for p in r.geometry.parts[0]))
    assert {k: Counter(v) for k, v in got.items()} == {k: Counter(line for line, _ in c) for k, c in want.items()}
    assert sum(r.copies for r in made) == len(rows)


def test_a_long_road_becomes_one_line(spark):
    n = 3000
    cells = spark.range(n).selectExpr("id % 2 = 0 as back", "cast(id as double) as a", "cast(id + 1 as double) as b")
    ends = F.when(F.col("back"), F.array(geo.xy(F.col("b"), F.lit(0.0)), geo.xy(F.col("a"), F.lit(0.0)))).otherwise(
        F.array(geo.xy(F.col("a"), F.lit(0.0)), geo.xy(F.col("b"), F.lit(0.0))))
    df = cells.select(F.lit("t").alias("layer"), F.lit(1).alias("z"), F.lit(0).alias("x"), F.lit(0).alias("y"),
                      F.lit("A").alias("road_class"), geo.line(ends).alias("geometry"))
    one = ops.coalesce_features(df.repartition(16), ["road_class"]).collect()
    assert len(one) == 1 and one[0].copies == n
    assert [p.x for p in one[0].geometry.parts[0]] == [float(i) for i in range(n + 1)]


def dropped(rows, most, most_bytes):
    """rows: id, curve, bytes of one tile; what stays, by raising the gap."""
    def fits(left):
        return len(left) <= most and sum(b for *_, b in left) <= most_bytes

    if fits(rows):
        return sorted(i for i, _, _ in rows)
    for gap in range(tiling.CURVE_BITS + 1):
        left, before = [], None
        for i, c, b in sorted(rows, key=lambda r: (r[1], r[0])):
            if c >> 2 * gap != before:
                left.append((i, c, b))
                before = c >> 2 * gap
        if fits(left):
            break
    return sorted(i for i, _, _ in left)


@pytest.mark.parametrize("most,most_bytes", [(40, 10**9), (10**9, 700), (25, 900), (1, 1)])
def test_densest_features_go_first(spark, most, most_bytes):
    """One crowded town, one place with many features, and open country."""
    rng = random.Random(most)
    rows = [(i, 8.5 + rng.gauss(0, 0.02), 50.1 + rng.gauss(0, 0.02)) for i in range(600)]
    rows += [(1000 + i, 9.0, 51.0) for i in range(200)] + [(2000 + i, 6 + 8 * rng.random(), 47 + 8 * rng.random()) for i in range(200)]
    df = spark.createDataFrame([(i, "n" * (i % 9), x, y) for i, x, y in rows], "id long, name string, lon double, lat double")
    df = df.select("id", "name", F.lit(10**6).alias("dtv_kfz"), geo.point(F.col("lon"), F.col("lat")).alias("geometry"))
    free = Profile("t", 4, 9, types=())
    limited = free._replace(max_features=most, max_bytes=most_bytes, drop_densest=True)
    placed = ops.point_index(df, ops.zooms_of(free)).withColumns({
        "curve": tiling.curve_in_tile(F.col("_u"), F.col("_v"), F.col("z"), F.col("x"), F.col("y")),
        "bytes": ops.feature_bytes(["id", "name", "dtv_kfz"]),
    })
    tiles = defaultdict(list)
    for r in placed.collect():
        tiles[r.z, r.x, r.y].append((r.id, r.curve, r.bytes))
    got = defaultdict(list)
    for r in ops.tile_index(df, limited, single_points=True, key=F.col("id")).collect():
        got[r.z, r.x, r.y].append(r.id)
    assert {k: sorted(v) for k, v in got.items()} == {k: dropped(v, most, most_bytes) for k, v in tiles.items()}
    again = df.unionByName(df)  # rows alike in everything are one in a tile over its limits
    twice = ops.tile_index(again, limited, single_points=True)
    counts = twice.groupBy("z", "x", "y").agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"))
    if most < 50:
        assert counts.filter(F.col("n") > most).isEmpty()
    assert ops.tile_index(df.filter("1 = 0"), limited, single_points=True).count() == 0
    with pytest.raises(ValueError):
        ops.tile_index(df, free._replace(max_bytes=5), single_points=True)


@pytest.mark.parametrize("ranges", [4096, 7])
def test_median_by_ranges(spark, monkeypatch, ranges):
    monkeypatch.setattr(analyses, "RANGES", ranges)
    rng = random.Random(ranges)
    groups = {
        "hot": [rng.gauss(0, 1) * 10 ** rng.randrange(-6, 7) for _ in range(5001)],
        "even": [rng.random() for _ in range(1000)], "one": [3.5], "two": [1.0, 2.0], "same": [7.0] * 100,
        "half": [0.0] * 50 + [1.0] * 50, "near": [1.0 + i * 2.0**-52 for i in range(30)], None: [1.0, 5.0, 9.0],
        "wide": [-1.7e308, 1.7e308, 0.0, 1e-300], "zeros": [0.0, -0.0, 0.0],
    }
    rows = [(g, v) for g, own in groups.items() for v in own] + [("gone", None), ("one", None), ("two", float("nan"))]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    got = {r.g: r.m for r in analyses.median(df, "g", F.col("v"), "m").collect()}
    assert got == {g: plain_median(own) for g, own in groups.items()}
    assert analyses.median(df.filter("1 = 0"), "g", F.col("v"), "m").count() == 0


def test_median_sends_counts_and_no_values(spark):
    """A group with all rows, all different: what a task sends is bounded by the ranges."""
    df = spark.range(0, 400_000, 1, 8).select(F.lit("all").alias("g"), (F.col("id") * 7919 % 400_000).cast("double").alias("v"))
    got = analyses.median(df, "g", F.col("v"), "m").collect()
    assert [r.m for r in got] == [199_999.5]


def joined_network(spark, seed):
    """Rows of a network, and the lines they make by walking."""
    rng = random.Random(seed)
    rows, want = [], Counter()
    for x in range(0, 48, 8):  # blocks of their own
        parts = network(rng, rng.choice((0, 3, 8, 15, 40)))
        want.update({(x, line): n for (line, _), n in joined(parts).items()})
        parts += [p[:: rng.choice((1, -1))] for p in rng.sample(parts, 3)]
        rows += [("t", 7, x, -3, "A", ("LineString", 4326, [p])) for p in parts]
    rng.shuffle(rows)
    df = spark.createDataFrame(
        rows, "layer string, z int, x int, y int, road_class string, "
        "geometry struct<kind:string,srid:int,parts:array<array<struct<x:double,y:double>>>>")
    return df.repartition(5), want, len(rows)


def joined_lines(df):
    made = ops.coalesce_features(df, ["road_class"]).collect()
    return Counter((r.x, (tuple(tuple(p) for p in r.geometry.parts[0]), r.copies)) for r in made)


def test_calm_tiles_are_joined_in_one_pass(spark, monkeypatch):
    """F1 of round 4: no round of jumps over all lines is written, and crowded blocks give the same lines."""
    written, saved = [], chains.saved

    def noted(df):
        out = saved(df)
        written.append(out.count())
        return out

    monkeypatch.setattr(chains, "saved", noted)
    df, want, n = joined_network(spark, 11)
    calm = joined_lines(df)
    assert sum(written) == 1  # the sizes of the blocks
    assert {(x, line): n for (x, (line, _)), n in calm.items()} == want
    assert sum(copies * k for (_, (_, copies)), k in calm.items()) == n
    for crowd in (0, 120):  # all of them crowded, some of them
        monkeypatch.setattr(ops, "CROWD", crowd)
        written.clear()
        assert joined_lines(df) == calm and sum(written) > 1


def test_ends_whose_hashes_meet(spark, monkeypatch):
    """Points of one hash are told apart by themselves."""
    from trafficloom.functions import joining

    df, _, _ = joined_network(spark, 12)
    plain = joined_lines(df)
    few = lambda c: F.pmod(c, F.lit(2)) * joining.NUMBERS
    given = joining.with_codes
    monkeypatch.setattr(joining, "with_codes", lambda part: F.transform(F.array(given(part)), lambda p: F.struct(
        few(p["first"]).alias("first"), few(p["last"]).alias("last"), p["part"]))[0])
    assert joined_lines(df) == plain


def test_zeros_have_no_sign(spark):
    """Lines that differ in the sign of a zero are one, in either way of joining."""
    lines = [[(-0.0, 1.0), (2.0, 0.0)], [(0.0, 1.0), (2.0, -0.0)], [(2.0, -0.0), (3.0, -0.0)]]
    rows = [("t", 3, 0, 0, "A", ("LineString", 4326, [p])) for p in lines]
    df = spark.createDataFrame(
        rows, "layer string, z int, x int, y int, road_class string, "
        "geometry struct<kind:string,srid:int,parts:array<array<struct<x:double,y:double>>>>")
    one, = ops.coalesce_features(df, ["road_class"]).collect()
    assert one.copies == 3 and str([tuple(p) for p in one.geometry.parts[0]]) == "[(0.0, 1.0), (2.0, 0.0), (3.0, 0.0)]"
