"""Queries on rows of their own that the given tables do not hold."""

import sys
from datetime import date
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

import __spark_entry__ as entry  # noqa: E402
import check  # noqa: E402
import duckdb  # noqa: E402

TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string",
    "lineitem": "l_orderkey long, l_linenumber int, l_returnflag string",
}
NATIONS = {"region": [(0, "AFRICA"), (1, "ASIA")], "nation": [(i, f"N{i}", i % 2) for i in range(6)]}


def order(key, cust=0):
    return key, cust, "F", 200_000.0 + cust, date(1995, 1, 1 + cust % 28), "1-URGENT"


@pytest.fixture()
def against_sql(spark, tmp_path):
    """What check.compare says of a query on given rows, and the query's rows."""

    def run(name, **rows):
        con = duckdb.connect()
        for table, given in {**NATIONS, **rows}.items():
            spark.createDataFrame(given, TABLES[table]).write.parquet(f"{tmp_path}/{table}.parquet")
            con.execute(f"create view {table} as select * from '{tmp_path}/{table}.parquet/*.parquet'")
        query = entry.queries()[name]
        result, _, _ = check.compare(spark, con, str(tmp_path), name, query, entry.oracle_sql()[name])
        return result, query(spark, str(tmp_path)).collect()

    return run


def test_sources_that_are_not_live_have_statistics(against_sql):
    """the features of a source count, whatever its status."""
    result, rows = against_sql("catalogue_with_statistics", orders=[order(k, k % 5) for k in range(1, 41)])
    assert result == "ok"
    assert {r.code: r.n for r in rows} == {**{f"n{i}": 8 for i in range(5)}, "n5": None}
    assert {r.status for r in rows if r.n} == {"live", "research", "blocked"}


def test_features_that_only_touch_stay_apart(against_sql):
    """two lines from one place are two rows, the same line twice is one."""
    start = 4_000_000  # keys so far apart start at one place
    rows = [order(k, 10) for k in (28, 28 + start, 31, 31)]
    result, found = against_sql("coalesced_features", orders=rows)
    assert result == "ok"
    assert sorted(r.copies for r in found if r.z == 5) == [1, 1, 2]


def test_lines_beyond_the_edge_of_the_map(against_sql):
    """F2: north of 85.05 degrees, and beyond the pole, tiles are those of the formula."""
    keys = (1, 3_367_999, 3_400_000, 3_818_004, 3_900_000, 8_999_999)
    rows = [(k, n, "ANR"[k % 3]) for k in keys for n in (1, 2, 4)]
    result, found = against_sql("lines_joined_end_to_end", lineitem=rows)
    assert result == "ok"
    assert min(r.y for r in found) < 0


def test_long_way_is_walked_by_milestones(spark, monkeypatch):
    """rounds write less than every row each time."""
    from trafficloom.operators import chains

    sizes, saved = [], chains.saved

    def counted(df):
        out = saved(df)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(chains, "saved", counted)
    rows = spark.range(4000).selectExpr("id as state", "case when id > 0 then id - 1 end as prev")
    found = chains.follow(rows).filter("root = 0 and at = state and not ring")
    assert found.count() == 4000
    assert sum(n == 4000 for n in sizes) <= 10 < len(sizes)


def test_gaps_do_not_multiply_the_rows(spark):
    """one ordering serves all gaps of a crowded tile."""
    from pyspark.sql import functions as F

    from trafficloom.operators import tiles

    df = spark.range(100).selectExpr(
        "'t' as layer", "8 as z", "1 as x", "1 as y", "id", "cast((1 + id / 100) / 256 as double) as _u", "1.5D / 256 as _v")
    out = tiles.drop_densest(df, F.col("id"), F.lit(20), 5)
    assert "Generate" not in out._jdf.queryExecution().optimizedPlan().toString()  # noqa: SLF001
    assert 0 < out.count() <= 5


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()  # noqa: SLF001


def test_attached_columns_that_nobody_reads_cost_no_join(spark):
    """F6, F8: the join and the pick before it leave the plan; with the column, missing keys meet."""
    from pyspark.sql import functions as F

    from trafficloom.operators import keyed

    left = spark.createDataFrame([("a", None, 1), (None, None, 2), ("a", 0.0, 3), ("c", 1.0, 4)], "k string, d double, v int")
    right = spark.createDataFrame(
        [("a", None, 5), ("a", None, 4), (None, None, 6), ("a", -0.0, 7), (None, 1.0, 8)], "k string, d double, w int")
    both = keyed.attach_first(left, right, ["k", "d"], ["w"], F.col("w"))
    assert sorted((r.v, r.w) for r in both.collect()) == [(1, 4), (2, 6), (3, 7), (4, None)]
    assert "Join" not in optimized(both.groupBy("k").agg(F.count("*"))) and "Join" in optimized(both.select("v", "w"))
    summed = keyed.sum_layers(left, {n: right for n in "xy"}, ["k", "d"], "w", "s")
    assert sorted((r.v, r.s) for r in summed.collect()) == [(1, 8.0), (2, 12.0), (3, 14.0), (4, None)]
    assert "Join" not in optimized(summed.agg(F.count("*")))
    # Keys of other types still meet.
    wide = spark.createDataFrame([(1, 5), (2, 6)], "v long, w int")
    assert sorted((r.v, r.w) for r in keyed.attach_first(left.drop("d"), wide, ["v"], ["w"], F.col("w")).collect()) == [
        (1, 5), (2, 6), (3, None), (4, None)]


def test_sections_without_a_value_are_not_picked(spark):
    """F6, F8: the pick of a network's sections reads only those that meet a value."""
    from trafficloom.functions import geometry as geo
    from trafficloom.operators import keyed
    from pyspark.sql import functions as F

    net = spark.createDataFrame([("7.0", "8", 2, 1.0), (" 7", "8", 1, 2.0), ("7", "9", 3, 3.0), ("x", None, 4, 4.0)],
                                "a string, b string, _ord int, x double")
    net = net.withColumn("geometry", geo.point(F.col("x"), F.col("x")))
    values = spark.createDataFrame([(7, 8, "p", 2), (7, 8, None, 1), (None, None, "q", 3), (5, 5, "r", 4)], "c int, d int, t string, _ord int")
    found = keyed.join_node_pairs(net, values, ("a", "b"), ("c", "d"), ["t"])
    got = {(geo_.geometry["parts"][0][0]["x"], geo_.t) for geo_ in found.collect()}
    assert got == {(2.0, None), (4.0, "q")}
    lines = optimized(found).splitlines()
    join = next(i for i, x in enumerate(lines) if "Join Inner" in x)
    assert any("min_by(geometry" in x for x in lines[:join]) and not any("min_by(geometry" in x for x in lines[join:])


def test_statistics_move_points_without_arrays(spark):
    """the same statistics as of moved geometries, and no projection inside a lambda."""
    from pyspark.sql import functions as F

    from trafficloom.functions import geometry as geo
    from trafficloom.operators import catalogue

    parts = "array<array<struct<x:double,y:double>>>"
    rows = [
        ("a", 2020, 25832, [[(500_000.0, 5_500_000.0), (400_000.5, 5_400_000.0)], [(610_000.0, 5_300_000.0)]]), ("a", None, 25833, [[(350_000.0, 5_700_000.0)]]),
        ("a", 2024, None, None), ("b", 2021, 31466, [[(2_560_000.0, 5_640_000.0), (2_570_000.0, 5_650_000.0)]]), ("b", 2019, 4326, [[(6.5, 51.0)]]),
        ("b", 2019, 25832, []), ("b", 2018, 25832, [[], [None]]), ("c", 2017, 25832, [[]]), ("c", None, 25832, None),
    ]
    df = spark.createDataFrame(rows, f"source string, year int, srid int, parts {parts}")
    df = df.select("source", "year", geo.geometry("LineString", F.col("srid"), F.col("parts")).alias("geometry"))
    moved = df.withColumn("geometry", geo.to_wgs84(F.col("geometry")))
    found = catalogue.stats_of_points(df)
    assert sorted(found.collect()) == sorted(catalogue.source_stats(moved).select(*found.columns).collect())
    assert [r.n for r in found.orderBy("source").collect()] == [3, 4, 2]
    assert "lambda" in optimized(catalogue.source_stats(moved)) and "lambda" not in optimized(found)
