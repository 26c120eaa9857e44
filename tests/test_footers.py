"""Statistics out of Parquet footers."""

import json

import pytest
from pyspark.sql import functions as F

from trafficloom.operators import catalogue as cat
from trafficloom.plans import jobs
from trafficloom.sources import footers

from test_jobs import canonical_rows


def plan(df):
    return df._jdf.queryExecution().toString()  # noqa: SLF001


@pytest.fixture()
def house(spark, tmp_path):
    """Two sources built, one with a table of no rows."""
    def build(code, rows, run):
        table = canonical_rows(spark, rows).withColumn("source", F.lit(code))
        path, n = jobs.checked_write(table, f"{tmp_path}/interim/{run}/{code}", code)
        jobs.record(spark, str(tmp_path), [jobs.Run("build", 0, code, run, path, n, None)])
        return path

    build("by", 50, "r1")
    build("by", 700, "r2")
    build("sl", 3, "r2")
    build("hh", 0, "r2")
    return str(tmp_path)


def test_statistics_of_the_newest_builds_read_no_row(spark, house):
    got = jobs.built_stats(spark, house)
    want = cat.source_stats(jobs.read_interim(spark, house))
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert {r.source: r.n for r in got.collect()} == {"by": 700, "sl": 3}
    text = plan(got)
    assert "PushedAggregation" in text and "PushedAggregation: []" not in text and "geometry" not in text.split("== Physical")[1]
    sources = json.loads(jobs.manifest(spark, house))["_sources"]
    assert sources["by"]["n"] == 700 and "n" not in sources["hh"]


def test_statistics_by_partition_come_from_footers(spark, house, tmp_path):
    path = str(tmp_path / "split")
    rows = jobs.read_interim(spark, house)
    path, _ = jobs.checked_write(rows, path, "t", ["source"], spread=True)
    got, want = cat.source_stats(footers.read(spark, path)), cat.source_stats(rows)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert "PushedGroupBy: [source]" in plan(got)


def test_reading_footers_leaves_the_session_as_it_was(spark, house):
    path = jobs.newest(spark, house, "build")["by"]
    before = spark.conf.get(footers.NATIVE)
    with pytest.raises(Exception):
        footers.read(spark, f"{house}/nowhere")
    assert footers.read(spark, path).count() == 700 and spark.conf.get(footers.NATIVE) == before
    assert "parquet" in before.split(",")


def test_tables_with_a_nested_column_first_are_not_asked(spark, house, tmp_path):
    rows = spark.read.parquet(jobs.newest(spark, house, "build")["by"])
    rows.select("geometry", *[c for c in rows.columns if c != "geometry"]).write.parquet(str(tmp_path / "odd"))
    assert footers.read(spark, str(tmp_path / "odd")) is None
    rows.write.partitionBy("state", "source").parquet(str(tmp_path / "split"))
    assert footers.read(spark, str(tmp_path / "split")) is not None
    jobs.record(spark, house, [jobs.Run("build", 0, "by", "r3", str(tmp_path / "odd"), 700, None)])
    assert {r.source: r.n for r in jobs.built_stats(spark, house).collect()} == {"by": 700, "sl": 3}


def test_older_tables_without_an_envelope_are_aggregated(spark, house):
    old = canonical_rows(spark, 9).withColumn("source", F.lit("be")).drop("name")
    path = f"{house}/interim/r0/be"
    old.write.parquet(path)
    jobs.record(spark, house, [jobs.Run("build", 0, "be", "r0", path, 9, None)])
    found = {r.source: r for r in jobs.built_stats(spark, house).collect()}
    assert set(found) == {"by", "sl", "be"} and found["be"].n == 9 and found["be"].west is not None
