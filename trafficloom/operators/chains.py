"""Lists of rows that name their predecessor, ranked by pointer jumping.

A row points to its predecessor; in every round it takes over its target's pointer and distance, so
the reach doubles and a list of a million rows takes twenty rounds. Pointers of unfinished rows are
all different, so no round has a hot key. Rounds are written to the shared folder: the plan stays
short and a lost executor repeats its own tasks only.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MILES = 8  # one row in so many is a milestone


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a local session without one (a test) gets its own."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    context = spark.sparkContext
    if not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="trafficloom-"))
    return context.getCheckpointDir().rstrip("/")


def saved(df: DataFrame) -> DataFrame:
    """Written to the shared folder and read again."""
    path = f"{shared_folder(df.sparkSession)}/rounds-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def follow(rows: DataFrame) -> DataFrame:
    """``(state, prev)`` to ``(state, root, at, low, ring)``.

    ``state``  identifies a row, ``prev`` its predecessor, null at the start of a list; every row
               is the predecessor of one row at most
    ``root``   start of the list, ``at`` the steps from there
    ``ring``   the rows form a circle without a start; ``low`` is its smallest state

    One row in ``MILES``, picked by its hash, is a milestone. Rows first walk to the milestone (or
    start) before them and are done there, most of them after a few rounds; the long way is walked
    by milestones alone, and all others take over the result of theirs.
    """
    first, later = F.coalesce("prev", "state"), F.col("prev").isNotNull()
    now = saved(
        rows.select(
            "state",
            first.alias("root"),
            later.cast("long").alias("at"),
            F.least("state", first).alias("low"),
            (later & ~_milestone("prev")).alias("open"),
        )
    )
    left, before = now.filter("open").count(), None
    # Circles without a milestone stay open; any other open row has one that ends in this round.
    while left and left != before:
        there = now.filter(~_milestone("state")).select(*[F.col(c).alias(f"_{c}") for c in now.columns])
        moved = now.filter("open").join(there, F.col("root") == F.col("_state"))
        moved = moved.select("state", *_onward(), F.col("_open").alias("open"))
        now = saved(now.filter("not open").unionByName(moved))
        left, before = now.filter("open").count(), left
    done = now.filter("not open").drop("open")
    is_head = _milestone("state") | (F.col("state") == F.col("root"))
    heads = done.filter(is_head).withColumn("ring", F.col("at") > 0)
    if left:
        circles = rows.join(now.filter("open").select("state"), "state", "left_semi")
        heads = heads.unionByName(
            circles.select(
                "state",
                F.col("prev").alias("root"),
                F.lit(1).cast("long").alias("at"),
                F.least("state", "prev").alias("low"),
                F.lit(True).alias("ring"),
            )
        )
    heads = _jumped(saved(heads))
    there = heads.select(*[F.col(c).alias(f"_{c}") for c in heads.columns])
    rest = done.filter(~is_head).join(there, F.col("root") == F.col("_state"))
    rest = rest.select("state", *_onward(), F.col("_ring").alias("ring"))
    return saved(heads.unionByName(rest))


def _milestone(state: str) -> Column:
    return F.pmod(F.xxhash64(state), F.lit(MILES)) == 0


def _onward() -> list[Column]:
    """Pointer, steps and smallest state, taken on by those of the row pointed to."""
    return [
        F.col("_root").alias("root"),
        (F.col("at") + F.col("_at")).alias("at"),
        F.least("low", "_low").alias("low"),
    ]


def _jumped(now: DataFrame) -> DataFrame:
    """Every row's pointer moved to the start of its list, the reach doubling in every round."""
    while True:
        there = now.select(*[F.col(c).alias(f"_{c}") for c in now.columns])
        moved = now.filter("ring").join(there, F.col("root") == F.col("_state"))
        low = F.least("low", "_low")
        moved = moved.select(
            "state",
            *_onward(),
            F.col("_ring").alias("ring"),
            (~F.col("_ring") | (low != F.col("low"))).alias("changed"),
        )
        still = now.filter("not ring").withColumn("changed", F.lit(False))
        made = saved(still.unionByName(moved))
        now = made.drop("changed")
        # Where no circle has a new smallest state, all of them are known: see the tests.
        if made.filter("changed").isEmpty():
            return now


def ranked(rows: DataFrame) -> DataFrame:
    """As ``follow``, with every circle cut open before its smallest state: ``(state, root, at, ring)``."""
    found = follow(rows)
    lists = found.filter("not ring").select("state", "root", "at", "ring")
    rings = found.filter("ring")
    if rings.isEmpty():
        return lists
    cut = rows.join(rings.select("state", "low"), "state").select(
        "state", F.when(F.col("state") != F.col("low"), F.col("prev")).alias("prev")
    )
    opened = follow(cut).select("state", "root", "at", F.lit(True).alias("ring"))
    return lists.unionByName(opened)
