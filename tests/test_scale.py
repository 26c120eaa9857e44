"""Plans stay safe when one key holds a third of the rows, and nothing runs in Python."""

import pytest
from pyspark.sql import functions as F

from trafficloom.operators import keyed
from trafficloom.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def small_limits(spark):
    """Limits low enough that test data counts as large."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, x in changed.items():
        spark.conf.set(k, x)
    yield
    for k, x in before.items():
        spark.conf.unset(k) if x is None else spark.conf.set(k, x)


def hot_rows(spark, n):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    return spark.range(0, n, 1, 16).select(
        key.alias("k"), F.col("id").alias("v"), F.sha2(F.col("id").cast("string"), 512).alias("pad")
    )


def test_hot_join_key_is_split(spark, small_limits):
    left = hot_rows(spark, 60000)
    right = hot_rows(spark, 6000).withColumnRenamed("v", "w").drop("pad")
    joined = keyed.attach_first(left, right, ["k"], ["w"], F.col("w"))
    rows = joined.collect()
    assert len(rows) == 60000
    assert {r.w for r in rows if r.k == "hot"} == {0}
    assert all(r.w is None or str(r.w) == r.k for r in rows if r.k != "hot")
    text = plan(joined)
    assert "skew=true" in text or "isSkew" in text or "skewed" in text.lower()


def test_hot_layer_sum_is_split(spark, small_limits):
    left = hot_rows(spark, 60000)
    layers = {n: hot_rows(spark, 6000).withColumnRenamed("v", "w") for n in ("a", "b")}
    joined = keyed.sum_layers(left, {n: df.withColumn("_ord", F.col("w"))
                                     for n, df in layers.items()}, ["k"], "w", "s")
    rows = joined.collect()
    assert len(rows) == 60000 and {r.s for r in rows if r.k == "hot"} == {0.0}
    assert all(r.s is None or r.s == 2.0 * r.v for r in rows if r.k != "hot")
    assert "skew=true" in plan(joined)


def test_first_row_is_picked_before_the_shuffle(spark):
    df = keyed.first_per_key(hot_rows(spark, 3000), ["k"], F.col("v"))
    text = plan(df)
    assert text.count("partial_min_by") == 1 and "Window" not in text


@pytest.mark.parametrize("name", QUERIES)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name].run(spark, FOLDER))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in text, name
