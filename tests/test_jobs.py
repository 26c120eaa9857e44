"""Build, merge, tiles and manifest on landed files, with a failing source among them."""

import json

import pytest
from test_readers import GML, collection, feature, put

from trafficloom.plans import jobs


def land(folder):
    put(folder, "by/sections/1.json", collection(
        feature({"Straßenklasse": "B", "Straße": "B 285", "Zählstelle": "1", "DTV_Kfz": 12000.0,
                 "DTV_SV": 61.0}, "LineString", [[10.0, 50.0], [10.3, 50.2]]),
        feature({"Straßenklasse": "St", "Straße": "St 1", "Zählstelle": "2", "DTV_Kfz": 0},
                "LineString", [[11.0, 49.0], [11.1, 49.0]])))
    put(folder, "sl/stations/1.json", collection(
        feature({"Str": "L 375", "TKZST": "9", "DTV": "1692", "DTVSV": "60"}, "Point", [7.0, 49.3])))
    put(folder, "bast/motorways/Zeilenformat.csv",
        "Str,TKZST,X_Koordinate,Y_Koordinate,DTV,DTVSV\nA 1,1,626677.117,6023913.142,18316,9\n"
        "A 7,2,,,5,5\n")
    put(folder, "bast/federal_roads/Zeilenformat.csv",
        "Str,TKZST,X_Koordinate,Y_Koordinate,DTV,DTVSV\nB 5,3,550000,5800000,90000,1\n")
    put(folder, "ravensburg/sheet/0.csv",
        "ID,NAME,BREITENGRAD,LAENGENGRAD,KFZ_1,SV_1,DATUM_1\n"
        "1000,B32_Ulmerstraße_88212_Ravensburg,47.79,9.62,30262,44,2024-07-11\n")
    put(folder, "hh/main_roads/1.json", collection(
        feature({"id": 1, "dtv": 4, "sv": 3, "strassenklasse": "HVS"}, None, None)))
    put(folder, "hh/motorways/1.json", collection())
    bb = GML.replace("app:road", "app:verkehrsstaerke_2021")
    put(folder, "bb/sections/a.gml", bb.split(" <wfs:member><app:verkehrsstaerke_2021 gml:id=\"r2\"")[0]
        + "</wfs:FeatureCollection>")


CODES = ["by", "be", "bb", "hh", "sl", "bast", "ravensburg"]


def test_jobs_end_to_end(spark, tmp_path):
    landing, house = str(tmp_path / "landing"), str(tmp_path / "house")
    land(tmp_path / "landing")

    runs = {r.code: r for r in jobs.build_all(spark, landing, house, CODES, run="r1").collect()}
    assert [c for c in CODES if runs[c].error] == ["be", "hh"]
    assert "geometry in 1 rows" in runs["hh"].error  # a null geometry fails the source
    assert {c: runs[c].n for c in CODES if not runs[c].error} == {
        "by": 2, "bb": 1, "sl": 1, "bast": 2, "ravensburg": 1}
    summary = {r.state: r.codes for r in jobs.build_summary(jobs.run_table(spark, house)).collect()}
    assert summary == {"ok": ["by", "bb", "sl", "bast", "ravensburg"], "failed": ["be", "hh"]}

    groups = {r["group"]: (r.sources, r.features) for r in jobs.merge(spark, house, "r1").collect()}
    assert groups == {"lines": (2, 3), "points": (1, 1), "bast": (1, 2), "kommunal_points": (1, 1)}

    tiles = {r.code: r.n for r in jobs.build_tiles(spark, house, run="r1").collect()}
    assert set(tiles) == {"svz_de", "svz_bast", "svz_kommunal"}
    town = spark.read.parquet(f"{house}/tiles/svz_kommunal/r1")
    assert sorted(r.z for r in town.select("z").collect()) == list(range(8, 15))
    assert {r.layer for r in town.select("layer").collect()} == {"kommunal_points"}
    only = jobs.build_tiles(spark, house, only=["svz_bast"], run="r2").collect()
    assert [r.code for r in only] == ["svz_bast"]

    text = jobs.manifest(spark, house)
    document = json.loads(text)
    assert text.startswith("{\n  \"svz_de\"") and "Länder" in text
    assert document["svz_de"]["vintage"] == "2021" and document["svz_de"]["present"] is True
    assert document["svz_kommunal"]["vintage"] == "2024"
    by = document["_sources"]["by"]
    assert by["access"][0]["label"] == "WFS" and "portal" not in by
    assert document["_sources"]["koeln"]["portal"].startswith("https://")
    assert "access" not in document["_sources"]["rp"]
    assert (by["n"], by["bbox"]) == (2, [10.0, 49.0, 11.1, 50.2])
    assert document["_sources"]["ravensburg"]["year"] == 2024  # the data beats the stated year
    assert "n" not in document["_sources"]["be"] and len(document["_sources"]) == 25
    assert spark.read.text(f"{house}/manifest", wholetext=True).first().value.strip() == text


def test_failed_rebuild_keeps_the_last_good_table(spark, tmp_path):
    landing, house = str(tmp_path / "landing"), str(tmp_path / "house")
    land(tmp_path / "landing")
    jobs.build_all(spark, landing, house, ["sl"], run="r1")
    put(tmp_path / "landing", "sl/stations/1.json", collection(
        feature({"Str": "L 1", "DTV": "1"}, None, None)))
    again = jobs.build_all(spark, landing, house, ["sl"], run="r2").collect()
    assert again[0].error
    assert jobs.newest(spark, house, "build")["sl"].endswith("r1/sl/fits=true")
    assert jobs.merge(spark, house).collect()[0].features == 1


def test_older_interim_table_is_backfilled(spark, tmp_path):
    house = str(tmp_path / "house")
    land(tmp_path / "landing")
    jobs.build_all(spark, str(tmp_path / "landing"), house, ["bast", "by"], run="r1")
    old = spark.read.parquet(f"{house}/interim/r1/bast").drop("level", "name")
    old = old.withColumns({"dtv_kfz": old.dtv_kfz.cast("double") * 0, "dtv_sv": old.dtv_sv * 0})
    path = f"{house}/interim/r2/bast"
    old.write.parquet(path)
    jobs.record(spark, house, [jobs.Run("build", 0, "bast", "r2", path, 2, None)])
    jobs.merge(spark, house)
    rows = jobs.read_features(spark, house).filter("source = 'bast'").collect()
    assert {(r.level, r.name, r.dtv_kfz, r.dtv_sv) for r in rows} == {("bund", None, None, None)}


def test_manifest_needs_no_merge_and_follows_the_builds(spark, tmp_path):
    house = str(tmp_path / "house")
    assert "n" not in json.loads(jobs.manifest(spark, house))["_sources"]["sl"]
    land(tmp_path / "landing")
    jobs.build_all(spark, str(tmp_path / "landing"), house, ["sl"], run="r1")
    assert json.loads(jobs.manifest(spark, house))["_sources"]["sl"]["n"] == 1
    put(tmp_path, "sources.json", json.dumps({"sl": {
        "name": "S", "status": "live", "level": "land", "portal": "https://p.example",
        "access": [{"label": "WFS", "url": "https://w.example"}]}}))
    from trafficloom.operators import catalogue as cat

    own = cat.read_source_table(spark, str(tmp_path / "sources.json"))
    entry = json.loads(jobs.manifest(spark, house, own))["_sources"]["sl"]
    assert (entry["portal"], entry["access"][0]["url"]) == ("https://p.example", "https://w.example")
    assert [r.code for r in jobs.build_all(spark, str(tmp_path / "landing"), house, catalogue=own).collect()] == ["sl"]


def test_builds_follow_a_catalogue_file(spark, tmp_path):
    """Another year, licence and town than the built-in list has."""
    from trafficloom.operators import catalogue as cat

    land(tmp_path / "landing")
    put(tmp_path / "landing", "neustadt/sheet/0.csv",
        "ID,NAME,BREITENGRAD,LAENGENGRAD,KFZ_1,SV_1,DATUM_1\n"
        "1,B32_Hauptstraße_88999_Neustadt,47.5,9.5,100,4,11.07.2023\n")
    put(tmp_path, "sources.json", json.dumps({
        "neustadt": {"status": "live", "level": "kommune", "name": "Neustadt", "state": "BW", "kind": "xlsx",
                     "license": "cc0", "metric": "24h"},
        "sl": {"status": "live", "year": 2030, "license": "own"},
        "by": {"status": "blocked"},
        "nowhere": {"status": "live", "level": "land", "name": "x", "state": "x", "kind": "wfs", "metric": "DTV"}}))
    own = cat.read_source_table(spark, str(tmp_path / "sources.json"))
    house = str(tmp_path / "house")
    runs = {r.code: r for r in jobs.build_all(spark, str(tmp_path / "landing"), house, catalogue=own).collect()}
    assert set(runs) == {"neustadt", "sl", "nowhere"} and "nowhere" in runs["nowhere"].error
    rows = {c: spark.read.parquet(runs[c].path).first() for c in ("neustadt", "sl")}
    assert (rows["sl"].year, rows["sl"].license, rows["sl"].metric, rows["sl"].level) == (2030, "own", "DTV", "land")
    town = rows["neustadt"]
    assert (town.name, town.road_no, town.year, town.level, town.license) == ("B 32 / Hauptstraße", "B 32", 2023, "kommune", "cc0")
    assert spark.read.parquet(jobs.build_all(spark, str(tmp_path / "landing"), house, ["sl"]).first().path).first().year == 2021


def test_empty_warehouse_names_the_missing_step(spark, tmp_path):
    for job in (jobs.merge, jobs.build_tiles):
        with pytest.raises(FileNotFoundError, match="first"):
            job(spark, str(tmp_path / "none"))


def test_nothing_built_is_an_error(spark, tmp_path):
    jobs.record(spark, str(tmp_path), [jobs.Run("build", 0, "by", "r1", None, None, "x")])
    with pytest.raises(FileNotFoundError):
        jobs.merge(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        jobs.build_tiles(spark, str(tmp_path))


def canonical_rows(spark, n):
    """Features all over the country, in no order."""
    return spark.range(n).selectExpr(
        "cast(id + 1 as bigint) as dtv_kfz", "cast(null as bigint) as dtv_sv", "cast(null as double) as sv_anteil",
        "'DTV' as metric", "2021 as year", "'B' as road_class", "'B 1' as road_no", "'x' as name",
        "cast(id as string) as station_id", "'BY' as state", "'by' as source", "'land' as level", "'cc' as license",
        "named_struct('kind', 'Point', 'srid', 4326, 'parts', array(array(named_struct("
        "'x', 6D + (id * 7919 % 10007) / 1250.9, 'y', 47D + (id * 104729 % 9973) / 1246.7)))) as geometry")


def rows_scanned(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()  # noqa: SLF001
    plan = plan.executedPlan() if "Adaptive" in plan.getClass().getName() else plan
    return plan.collectLeaves().head().metrics().apply("numOutputRows").value()


def test_a_small_box_reads_few_rows(spark, tmp_path):
    from trafficloom.sources.readers import in_box

    spark.conf.set("parquet.block.size", str(1 << 15))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path, n = jobs.checked_write(canonical_rows(spark, 200_000), str(tmp_path / "t"), "t", ["source"], spread=True)
    finally:
        spark.conf.unset("parquet.block.size")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    table = spark.read.parquet(path)
    assert n == table.count() == 200_000
    found = in_box(table, 9.0, 50.0, 9.8, 50.8)  # a hundredth of the area
    rows = found.count()
    scanned = rows_scanned(in_box(table, 9.0, 50.0, 9.8, 50.8).select("station_id"))
    print("rows in the box", rows, "scanned", scanned)
    assert 1600 < rows < 2400 and scanned < 10_000


def test_a_broken_table_is_not_left_behind(spark, tmp_path):
    from pyspark.sql import functions as F

    from trafficloom.operators import contract

    odd = F.when(F.col("dtv_kfz") % 10 == 0, "Q").otherwise(F.col("road_class"))
    shape = F.when(F.col("dtv_kfz") % 25 != 0, F.col("geometry"))
    df = canonical_rows(spark, 100).withColumns({"road_class": odd, "geometry": shape})
    path = tmp_path / "t"
    with pytest.raises(contract.ContractError, match="t: enum:road_class in 10 rows, geometry in 4 rows; e.g. road_class='Q'"):
        jobs.checked_write(df, str(path), "t")
    assert not (path / "fits=true").exists() and (path / "fits=false").exists()
    good, n = jobs.checked_write(df, str(path), "t", set_aside=True)
    assert n == 88 and spark.read.parquet(good).count() == 88
    aside = spark.read.parquet(str(path / "fits=false"))
    assert aside.count() == 12 and aside.filter("geometry is null").count() == 4
    assert aside.columns == spark.read.parquet(good).columns
    good, n = jobs.checked_write(df.filter("dtv_kfz < 0"), str(tmp_path / "none"), "none")
    assert n == 0 and spark.read.parquet(good).count() == 0
