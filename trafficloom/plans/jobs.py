"""The four jobs and the table of their runs.

Every run writes to a new directory and only then records it in ``<warehouse>/runs``. Readers
take the newest recorded directory, so a failed or half-written run never hides the last good
one, and a lost executor only repeats its own tasks.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trafficloom.catalogue_data import DATASETS, LEVEL_OF, PROFILES, Source, live_codes, using
from trafficloom.functions import geometry as geo
from trafficloom.model import CANONICAL
from trafficloom.operators import catalogue as cat
from trafficloom.operators import contract, pyramid
from trafficloom.operators.canonical import canonical_columns, near_each_other, write_ready
from trafficloom.operators.grouping import backfill, group_summary, route
from trafficloom.operators.tiles import TILE, cast_attributes, combine, dataset_tiles
from trafficloom.sources import footers
from trafficloom.sources.landing import landed_layers
from trafficloom.sources.registry import plan_for

RUNS = "stage string, ord int, code string, run string, path string, n bigint, error string"


class Run(NamedTuple):
    """Outcome of one unit of work."""

    stage: str  # build, merge or tiles
    ord: int
    code: str
    run: str
    path: str | None
    n: int | None
    error: str | None


def new_run() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")


def record(spark: SparkSession, warehouse: str, runs: Sequence[Run]) -> None:
    spark.createDataFrame(list(runs), RUNS).coalesce(1).write.mode("append").parquet(
        f"{warehouse}/runs"
    )


def run_table(spark: SparkSession, warehouse: str) -> DataFrame:
    return spark.read.schema(RUNS).parquet(f"{warehouse}/runs")


def newest(spark: SparkSession, warehouse: str, stage: str) -> dict[str, str]:
    """Path of the newest good run per code: one entry per source or dataset."""
    return {code: path for code, (path, _) in newest_with_rows(spark, warehouse, stage).items()}


def newest_with_rows(spark: SparkSession, warehouse: str, stage: str) -> dict[str, tuple[str, int]]:
    """Path and number of rows of the newest good run per code."""
    try:
        runs = run_table(spark, warehouse)
    except AnalysisException as missing:  # nothing has been recorded in this warehouse yet
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    good = runs.filter((F.col("stage") == stage) & F.col("error").isNull())
    runs = good.groupBy("code").agg(F.max_by(F.struct("path", "n"), "run").alias("r")).collect()
    return {r["code"]: tuple(r["r"]) for r in sorted(runs, key=lambda r: r["code"])}


def checked_write(
    df: DataFrame,
    path: str,
    where: str,
    partitions: Sequence[str] = (),
    set_aside: bool = False,
    spread: bool = False,
) -> tuple[str, int]:
    """Write features in one pass, those that fit the contract apart from the others; returns the
    folder of the good part and its rows.

    Rows that break a rule are under ``<path>/fits=false``, where no reader looks. With
    ``set_aside`` the good part counts all the same; otherwise it is deleted and the error says
    what is wrong. Rows lie in the order of a space-filling curve, over all tasks with ``spread``.
    """
    contract.check_columns(df, where)
    rows = write_ready(contract.marked(df), keep_missing=True)
    folders = ["fits", *partitions]
    near_each_other(rows, folders, spread).write.mode("overwrite").partitionBy(*folders).parquet(path)
    spark, good = df.sparkSession, f"{path}/fits=true"
    written = spark.read.schema(rows.schema).parquet(path)
    n = written.agg(F.count_if("fits").alias("good"), F.count_if(~F.col("fits")).alias("bad")).first()
    if n["bad"] and not set_aside:
        _remove(spark, good)
        contract.validate(written.filter("not fits"), where)
    if not n["good"]:  # no folder was made: a table without rows
        write_ready(df).limit(0).write.mode("overwrite").parquet(good)
    return good, n["good"]


def _remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)  # noqa: SLF001


# ------------------------------------------------------------------------------- build


def build_source(
    spark: SparkSession,
    code: str,
    landing: str,
    warehouse: str,
    run: str,
    normalize: Callable[[Mapping[str, DataFrame]], DataFrame] | None = None,
    layers: Mapping[str, DataFrame] | None = None,
    set_aside: bool = False,
) -> tuple[str, int]:
    """Read, map, check and write one source; returns path and row count."""
    layers = landed_layers(spark, landing, code) if layers is None else layers
    features = (normalize or plan_for(code))(layers)
    path = f"{warehouse}/interim/{run}/{code}"
    return checked_write(features, path, code, set_aside=set_aside)


def build_all(
    spark: SparkSession,
    landing: str,
    warehouse: str,
    codes: Sequence[str] | None = None,
    run: str | None = None,
    threads: int = 4,
    catalogue: DataFrame | None = None,
    set_aside: bool = False,
) -> DataFrame:
    """Build all live sources; one that fails is recorded and does not stop the others.

    With ``set_aside`` rows that break the contract do not fail their source, see ``checked_write``.

    ``catalogue`` is a source list read from a file: its live sources are built, in its order, with
    its years, licences, metrics, names and levels; without one the built-in list counts.
    """
    sources = []
    if catalogue is not None:
        # A hand-kept list: a row per source.
        rows = catalogue.orderBy("ord").select(*Source._fields).collect()
        sources = [Source(*r) for r in rows]
        codes = [s.code for s in sources if s.status == "live"] if codes is None else codes
    codes = live_codes() if codes is None else list(codes)
    run = run or new_run()

    def attempt(item: tuple[int, str]) -> Run:
        place, code = item
        try:
            with using(sources):
                path, n = build_source(spark, code, landing, warehouse, run, set_aside=set_aside)
            return Run("build", place, code, run, path, n, None)
        except Exception as problem:  # noqa: BLE001 - one source must not stop the others
            text = f"{type(problem).__name__}: {problem}"
            return Run("build", place, code, run, None, None, text)

    with ThreadPoolExecutor(max_workers=threads) as pool:
        runs = list(pool.map(attempt, enumerate(codes)))
    record(spark, warehouse, runs)
    return spark.createDataFrame(runs, RUNS)


def build_summary(runs: DataFrame) -> DataFrame:
    """Built and failed codes of the newest build, in build order: one row per source of it."""
    runs = runs.filter("stage = 'build'")
    last = F.max("run").over(Window.partitionBy("stage"))  # a short table: a row per source and run
    runs = runs.withColumn("_newest", last).filter(F.col("run") == F.col("_newest")).drop("_newest")
    state = F.when(F.col("error").isNull(), "ok").otherwise("failed")
    entry = F.struct("ord", "code", "n", "error")
    return (
        runs.groupBy(state.alias("state"))
        .agg(F.sort_array(F.collect_list(entry)).alias("_items"), F.sum("n").alias("features"))
        .select(
            "state",
            "features",
            F.transform("_items", lambda i: i["code"]).alias("codes"),
            F.transform("_items", lambda i: i["error"]).alias("errors"),
        )
    )


# ------------------------------------------------------------------------------- merge


def read_interim(spark: SparkSession, warehouse: str) -> DataFrame:
    """Newest good table of every source, older ones brought up to the contract."""
    paths = newest(spark, warehouse, "build")
    if not paths:
        raise FileNotFoundError(f"no built source in {warehouse}; run build_all first")
    alike: dict[str, list[str]] = {}
    for path in paths.values():
        alike.setdefault(spark.read.parquet(path).schema.json(), []).append(path)
    return combine(
        [backfill(spark.read.parquet(*same), LEVEL_OF) for same in alike.values()]
    )


def merge(spark: SparkSession, warehouse: str, run: str | None = None) -> DataFrame:
    """All sources in one table, split by group and source; returns the group summary."""
    run = run or new_run()
    path = f"{warehouse}/features/{run}"
    routed = route(read_interim(spark, warehouse))
    path, n = checked_write(routed, path, "merge", ["group", "source"], spread=True)
    record(spark, warehouse, [Run("merge", 0, "features", run, path, n, None)])
    return group_summary(read_features(spark, warehouse))


def read_features(spark: SparkSession, warehouse: str) -> DataFrame:
    """The newest merged table, with the flat envelope columns it was written with."""
    paths = newest(spark, warehouse, "merge")
    if not paths:
        raise FileNotFoundError(f"no merged table in {warehouse}; run merge first")
    return spark.read.parquet(paths["features"])


# ------------------------------------------------------------------------------- tiles


def build_tiles(
    spark: SparkSession,
    warehouse: str,
    only: Sequence[str] | None = None,
    run: str | None = None,
    shapes: bool = True,
    two_tables: bool = False,
) -> DataFrame:
    """Write the tile table of every dataset (or the ones named) whose groups exist.

    Without ``shapes`` the rows carry no geometry: a long line is otherwise stored once per tile.
    With ``two_tables`` features are stored once, under ``features``, and the tiles hold their
    numbers, under ``index``; ``read_tiles`` reads both layouts.
    """
    run = run or new_run()
    features = read_features(spark, warehouse)
    groups = [r["group"] for r in features.select("group").distinct().collect()]
    slim = canonical_columns(features).columns
    features = features.select(*slim, "group")
    runs = []
    for place, dataset in enumerate(DATASETS):
        if (only and dataset.key not in only) or not set(dataset.groups) & set(groups):
            continue
        path = f"{warehouse}/{dataset.file}/{run}"
        if two_tables:
            tiles = tile_numbers(features, [g for g in dataset.groups if g in groups], f"{path}/features")
        else:
            tiles = dataset_tiles(features, groups, [dataset.key])
            tiles = tiles if shapes else tiles.drop("geometry")
        # Rebalancing splits a crowded zoom over several files and fills up the sparse ones.
        written = f"{path}/index" if two_tables else path
        (
            tiles.hint("rebalance", "z")
            .sortWithinPartitions("z", "layer", "x", "y")
            .write.mode("overwrite")
            .partitionBy("z")
            .parquet(written)
        )
        n = spark.read.parquet(written).count()
        runs.append(Run("tiles", place, dataset.key, run, path, n, None))
    if not runs:
        raise FileNotFoundError("no merged group to cut into tiles")
    record(spark, warehouse, runs)
    return spark.createDataFrame(runs, RUNS)


def tile_numbers(features: DataFrame, groups: Sequence[str], path: str) -> DataFrame:
    """Write the features of some groups with their numbers to ``path``; returns the tile index."""
    types = dict(PROFILES[groups[0]].types)
    chosen = features.filter(F.col("group").isin(*groups))
    stored = pyramid.numbered(cast_attributes(chosen, types), path)
    return combine(
        [
            pyramid.narrow_index(stored.filter(F.col("group") == g).drop("group"), PROFILES[g])
            for g in groups
        ]
    )


def read_tiles(
    spark: SparkSession, warehouse: str, dataset: str, tiles: Column | None = None
) -> DataFrame:
    """The newest tiles of a dataset, those that the condition on layer, z, x and y names. The same
    columns whether features are stored in their tiles or once."""
    path = newest(spark, warehouse, "tiles").get(dataset)
    if path is None:
        raise FileNotFoundError(f"no tiles of {dataset} in {warehouse}; run build_tiles first")
    chosen = F.lit(True) if tiles is None else tiles
    try:
        index = spark.read.parquet(f"{path}/index")
    except AnalysisException as missing:  # features stored in their tiles
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.read.parquet(path).filter(chosen)
    features = spark.read.parquet(f"{path}/features").drop("group")
    rows = pyramid.with_features(index.filter(chosen), features)
    return rows.select(F.lit(dataset).alias("dataset"), *TILE, *[c for c in rows.columns if c not in TILE])


# ---------------------------------------------------------------------------- manifest


def built_features(spark: SparkSession, warehouse: str) -> DataFrame:
    """The newest table of every built source with its group, merged or not; maybe none."""
    if newest(spark, warehouse, "build"):
        return route(read_interim(spark, warehouse))
    return spark.createDataFrame([], CANONICAL).withColumn("group", F.lit(None).cast("string"))


def built_stats(spark: SparkSession, warehouse: str) -> DataFrame:
    """Statistics of the newest table of every source, from the footers where it was written with
    its envelope; older tables are aggregated."""
    stats, older = [], []
    for code, (path, n) in newest_with_rows(spark, warehouse, "build").items():
        if not n:
            continue
        table = footers.read(spark, path)
        if table is not None and set(geo.BOX) <= set(table.columns):
            stats.append(cat.table_stats(table, code))
        else:
            older.append(backfill(spark.read.parquet(path), LEVEL_OF))
    if older or not stats:
        rows = combine(older) if older else spark.createDataFrame([], CANONICAL)
        stats.append(cat.source_stats(rows))
    return combine(stats)


def manifest(spark: SparkSession, warehouse: str, catalogue: DataFrame | None = None) -> str:
    """Write ``<warehouse>/manifest``: one JSON text with datasets and sources.

    Numbers are those of the newest build of each source; sources never built have none.
    """
    features = built_features(spark, warehouse)
    present = [d.key for d in DATASETS if d.key in newest(spark, warehouse, "tiles")]
    datasets = cat.dataset_json(
        cat.dataset_entries(cat.dataset_table(spark), cat.dataset_years(features), present)
    )
    sources = cat.source_json(
        cat.source_entries(
            cat.source_table(spark) if catalogue is None else catalogue, built_stats(spark, warehouse)
        )
    )

    def entries(df: DataFrame) -> dict:  # at most one row per catalogue entry
        return {r["code"]: json.loads(r["entry"]) for r in df.orderBy("ord").collect()}

    document = {**entries(datasets), "_sources": entries(sources)}
    text = json.dumps(document, indent=2, ensure_ascii=False)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{warehouse}/manifest"
    )
    return text
