"""Mapping rules, contract, grouping, picks and views on small tables."""

import pytest
from conftest import dot, line

from trafficloom import catalogue_data as data
from trafficloom.functions import geometry as geo
from trafficloom.functions import roads, view
from trafficloom.functions import values as v
from trafficloom.model import CANONICAL
from trafficloom.operators import canonical, catalogue, contract, grouping, keyed, reshape
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

SPEC = dict(metric="DTV", state="BW", source="by", license="x", levels=data.LEVEL_OF)


def test_basic_mapping(layer):
    df = layer("DTV int, DTV_SV int, strasse string, junk string",
               [(12000, 800, "B10", "x", line(500000, 5400000)),
                (5000, 300, "L1187", "y", line(500000, 5400000))], srid=25832)
    spec = canonical.Spec({"DTV": "dtv_kfz", "DTV_SV": "dtv_sv", "strasse": "road_no"}, year=2021,
                          road_class="B", **SPEC)
    out = contract.validate(canonical.to_canonical(df, spec))
    assert out.columns == CANONICAL.names
    rows = out.collect()
    assert [r.road_no for r in rows] == ["B10", "L1187"] and rows[0].level == "land"
    assert rows[0].geometry.srid == 4326 and rows[0].geometry.parts[0][0].x == pytest.approx(9.0)


def test_year_column_and_level_from_catalogue(layer):
    df = layer("jahr string", [("2019", dot(9, 48)), ("2021", dot(9, 48))])
    spec = canonical.Spec({}, **{**SPEC, "source": "ravensburg", "metric": "24h"},
                          year_from="jahr", road_class="G")
    rows = contract.validate(canonical.to_canonical(df, spec)).collect()
    assert [(r.year, r.level, r.name) for r in rows] == [
        (2019, "kommune", None), (2021, "kommune", None)]


def test_mapping_needs_year_class_and_level(layer):
    df = layer("a int", [(1, dot(9, 48))])
    with pytest.raises(ValueError, match="year"):
        canonical.to_canonical(df, canonical.Spec({}, road_class="G", **SPEC))
    with pytest.raises(ValueError, match="road_class"):
        canonical.to_canonical(df, canonical.Spec({}, year=2021, **SPEC))
    with pytest.raises(ValueError, match="level"):
        canonical.to_canonical(
            df, canonical.Spec({}, year=1, road_class="G", **{**SPEC, "source": "nowhere"}))
    assert [canonical.source_level(c, data.LEVEL_OF) for c in ("ravensburg", "by", "bast")] == [
        "kommune", "land", "bund"]


def test_class_rules_dict_column_rule_and_python_function(layer):
    df = layer("k string, year int", [("A", 1, dot(9, 48)), ("x", 1, dot(9, 48)),
                                      (None, 1, dot(9, 48))])

    def classes(rule):
        spec = canonical.Spec({}, year_from="year", road_class_from="k", road_class_map=rule, **SPEC)
        return [r.road_class for r in canonical.to_canonical(df, spec).collect()]

    assert classes({"A": "A"}) == ["A", None, None]
    assert classes(roads.class_by_code({"A": "A"}, "L")) == ["A", "L", "L"]
    assert classes(lambda value: "B" if str(value) == "None" else "K") == ["K", "K", "B"]
    assert classes(None) == ["A", "x", None]


def test_zero_rule_and_idempotence(spark):
    df = spark.createDataFrame([(0, 0), (0, 194), (4200, 0), (None, 0)], "dtv_kfz int, dtv_sv int")
    once = canonical.normalize_counts(df)
    want = [(None, None), (None, 194), (4200, 0), (None, None)]
    assert [tuple(r) for r in once.collect()] == want
    assert [tuple(r) for r in canonical.normalize_counts(once).collect()] == want
    texts = spark.createDataFrame(
        [("8000.5", "14.5"), ("1e3", " 7 "), ("1,5", "12d"), ("inf", "nan"), ("0x10", "1e400")],
        "dtv_kfz string, dtv_sv string")
    assert [tuple(r) for r in canonical.normalize_counts(texts).collect()] == [
        (8000, 14), (1000, 7), (None, None), (None, None), (None, None)]
    nans = spark.createDataFrame([(0.0, 0.0), (6626.0, 0.0), (float("nan"), 12.0)],
                                 "dtv_kfz double, dtv_sv double")
    assert [tuple(r) for r in canonical.normalize_counts(nans).collect()] == [
        (None, None), (6626, 0), (None, 12)]


def good(layer, **change):
    df = layer("a int", [(1, dot(9, 48)), (2, dot(9, 49))])
    out = canonical.to_canonical(df, canonical.Spec({}, year=2021, road_class="B", **SPEC))
    return out.withColumns({c: F.expr(e) for c, e in change.items()}) if change else out


@pytest.mark.parametrize("change, text", [
    ({"level": "'stadt'"}, "enum:level in 2 rows; e.g. level='stadt'"),
    ({"metric": "'DTVx'"}, "enum:metric"),
    ({"year": "cast(null as int)"}, "null:year in 2 rows"),
    ({"geometry": "named_struct('kind', geometry.kind, 'srid', 25832, 'parts', geometry.parts)"},
     "srid in 2 rows"),
    ({"geometry": "named_struct('kind', geometry.kind, 'srid', 4326, 'parts', "
                  "array(slice(geometry.parts[0], 1, 0)))"}, "geometry in 2 rows"),
])
def test_contract_refuses(layer, change, text):
    with pytest.raises(contract.ContractError, match="here: .*" + text.replace(".", r"\.")):
        contract.validate(good(layer, **change), "here")


def test_contract_says_how_many_values_it_does_not_quote(layer):
    df = layer("a int", [(i, dot(9, 48)) for i in range(contract.EXAMPLES + 3)])
    df = canonical.to_canonical(df, canonical.Spec({}, year=2021, road_class="B", **SPEC))
    df = df.withColumn("level", F.concat(F.lit("x"), F.uuid()))
    with pytest.raises(contract.ContractError, match="and 3 other values"):
        contract.validate(df, "here")


def test_contract_accepts_quarantines_and_names_missing_columns(layer):
    df = good(layer)
    assert contract.validate(df) is df
    with pytest.raises(contract.ContractError, match="missing columns"):
        contract.validate(df.drop("name"))
    half = df.withColumn("year", F.expr("case when geometry.parts[0][0].y > 48.5 then year end"))
    ok, bad = contract.quarantine(half)
    assert ok.count() == 1 and [r.broken for r in bad.collect()] == [["null:year"]]


def test_sink_drops_missing_geometries(layer):
    df = good(layer).withColumn("geometry", F.expr(
        "case when geometry.parts[0][0].y > 48.5 then geometry end"))
    rows = canonical.write_ready(df).collect()
    assert len(rows) == 1 and (rows[0].xmin, rows[0].ymax) == (9.0, 49.0)


@pytest.mark.parametrize("level, kinds, group", [
    ("land", ["LineString"], "lines"), ("land", ["Point"], "points"),
    ("land", ["Point", "MultiPoint"], "points"), ("land", ["Point", "LineString"], "lines"),
    ("bund", ["Point"], "bast"), ("bund", ["LineString"], "bast"),
    ("kommune", ["LineString"], "kommunal_lines"), ("kommune", ["Point"], "kommunal_points"),
])
def test_route(spark, level, kinds, group):
    df = spark.createDataFrame([("s", level, (k,)) for k in kinds],
                               "source string, level string, geometry struct<kind:string>")
    assert {r["group"] for r in grouping.route(df).collect()} == {group}


def test_every_source_is_routed_by_its_own_level(spark):
    """No list of sources decides: unknown and null ones have a group like the others."""
    df = spark.createDataFrame([("not listed", "land", ("Point",)), (None, "kommune", ("LineString",))],
                               "source string, level string, geometry struct<kind:string>")
    got = {r["source"]: r["group"] for r in grouping.route(df).collect()}
    assert got == {"not listed": "points", None: "kommunal_lines"}


def test_numbers_and_keys(spark):
    df = spark.createDataFrame(
        [("4639027.0",), (" 12 ",), ("-0.4",), ("x",), (None,), ("nan",), ("inf",),
         ("1e20",)], "t string")
    got = [r[0] for r in df.select(roads.node_key(F.col("t"))).collect()]
    assert got == ["4639027", "12", "0", "", "", "", "", "100000000000000000000"]


def test_station_names(spark):
    df = spark.createDataFrame(
        [("B32_Ulmerstraße_88212_ravensburg",), ("Markdorferstraße_L288_88213_Ravensburg",),
         (" A _ _B 7a_K 2",), ("A1_A1_A1",), ("88212_Ravensburg",), (None,)], "t string")
    s = roads.station_name(F.col("t"), "Ravensburg")
    assert [tuple(r) for r in df.select(s.name, s.number, s.road_class).collect()] == [
        ("B 32 / Ulmerstraße", "B 32", "B"), ("Markdorferstraße / L 288", "L 288", "L"),
        ("A / B 7a / K 2", "K 2", "K"), ("A 1 / A1 / A1", "A 1", "A"), ("", None, "G"),
        (None, None, "G")]


def test_roads_in_names_use_unicode_word_borders(spark):
    df = spark.createDataFrame([("Autobahn A46",), ("ÄB 8",), ("B 40a",), ("zur B 8!",)],
                               "t string")
    plain = roads.road_in_name(F.col("t"))
    suffix = roads.road_in_name(F.col("t"), roads.ROAD_IN_NAME_SUFFIX)
    got = [tuple(r) for r in df.select(plain.number, suffix.number).collect()]
    assert got == [("A 46", "A 46"), (None, None), (None, "B 40a"), ("B 8", "B 8")]


def test_first_row_wins_with_null_keys_and_no_payload(spark):
    df = spark.createDataFrame([(None, 2, 1), (None, 1, 2), ("a", 5, 0), ("a", 4, 1)],
                               "k string, v int, _ord int")
    got = {r.k: r.v for r in keyed.first_per_key(df, ["k"]).collect()}
    assert got == {None: 2, "a": 5}
    assert keyed.first_per_key(df.select("k"), ["k"]).count() == 2


def test_direction_years_are_an_intersection():
    names = ["NO", "K_2016_24H", "K_2019_24H", "K_2020_24H", "R_K_2016~2", "R_K_2019~5", "K_2016"]
    assert [y for y, _, _ in reshape.direction_years(names)] == [2019, 2016]
    with pytest.raises(ValueError):
        reshape.direction_years(["K_2016_24H"])


def test_kind_alone_moves_no_point(spark):
    df = spark.range(3).select(geo.line(F.array(geo.xy(F.lit(5e5), F.lit(5e6))), 25832).alias("g"))
    moved = df.select(geo.to_wgs84(F.col("g"), 25832).alias("g"))
    text = moved.select("g.kind")._jdf.queryExecution().optimizedPlan().toString()
    assert "transform" not in text and "SIN" not in text


def test_ladder_table_and_monotone_zooms(spark):
    from trafficloom.functions import tiling
    from trafficloom.operators.tiles import zoom_rows

    counts = [None, 500, 1000, 1999, 2000, 9999, 10000]
    df = spark.createDataFrame([(c,) for c in counts], "dtv_kfz bigint")
    first = [r[0] for r in df.select(tiling.first_zoom(F.col("dtv_kfz"), 5, True)).collect()]
    assert first == [8, 8, 7, 7, 6, 6, 5]
    rows = zoom_rows(df.withColumn("c", F.coalesce("dtv_kfz", F.lit(-1))), data.PROFILES["lines"])
    seen = {(r.c, r.z) for r in rows.collect()}
    by_rule = df.select(F.coalesce("dtv_kfz", F.lit(-1)).alias("c"), "dtv_kfz").withColumn(
        "z", F.explode(F.sequence(F.lit(5), F.lit(14)))
    ).filter(tiling.on_ladder(F.col("z"), F.col("dtv_kfz")))
    assert seen == {(r.c, r.z) for r in by_rule.collect()}
    town = zoom_rows(df, data.PROFILES["kommunal_lines"])
    assert town.agg(F.min("z"), F.max("z")).first() == (8, 14)


def test_catalogue_is_consistent():
    assert len(data.SOURCES) == 25 and len(data.live_codes()) == 20
    assert {s.status for s in data.SOURCES} == {"live", "research", "blocked"}
    assert data.live_codes("bund") == ["bast"] and len(data.live_codes("kommune")) == 8
    assert sorted(g for d in data.DATASETS for g in d.groups) == sorted(data.GROUPS)
    p = data.PROFILES["lines"]
    assert (p.layer, p.minzoom, p.maxzoom, p.drop_rate) == ("svz", 5, 14, 0.0)
    assert [least for _, least in p.ladder] == [0, 1000, 2000, 10000]


def test_source_list_from_a_file(spark, tmp_path):
    path = tmp_path / "sources.json"
    path.write_text('{"xy": {"status": "live", "level": "land", "name": "Übung", "year": 2020}}')
    row = catalogue.read_source_table(spark, str(path)).first()
    assert (row.code, row.name, row.level, row.state, row.access) == (
        "xy", "Übung", "land", None, None)
    path.write_text("[1]")
    with pytest.raises(ValueError):
        catalogue.read_source_table(spark, str(path))
    with pytest.raises(AnalysisException):
        catalogue.read_source_table(spark, str(tmp_path / "none.json"))


def test_panel_order_is_german(spark):
    stats = spark.createDataFrame([], "source string, n bigint, west double, south double, "
                                      "east double, north double, year int")
    entries = catalogue.source_entries(catalogue.source_table(spark), stats)
    rows = catalogue.viewer_sources(entries).collect()
    names = [r.name for r in rows]
    assert names[:3] == ["Baden-Württemberg", "Bayern", "Berlin"]
    assert names.index("Düsseldorf") < names.index("Frankfurt am Main") < names.index("Köln")
    assert names[-2:] == ["BASt-Backbone (A+B)", "UBA-Hauptverkehrsstraßen"]


def test_ramp_ends_and_stops(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (0.0,), (1500.0,), (3000.0,), (60000.0,),
                                (1e9,)], "v double")
    c = [r[0] for r in df.select(
        view.ramp_colour(F.col("v"), view.DTV_STOPS, view.STANDARD)).collect()]
    assert c == ["#b4b4b4", "#1a9850", "#1a9850", "#40ab5a", "#66bd63", "#d73027", "#d73027"]


def test_popup_titles_skip_empty_texts(spark):
    df = spark.createDataFrame([("", "B 1", "B"), (None, "", "G"), ("Ring", "L 2", "L"),
                                ("Ring", "", "Z")], "name string, road_no string, road_class string")
    got = df.select(view.title(df.name, df.road_no, df.road_class),
                    view.class_line(df.name, df.road_no, df.road_class)).collect()
    assert [tuple(r) for r in got] == [
        ("B 1", "Bundesstraße"), ("G-Straße", "Gemeinde-/Stadtstraße"),
        ("Ring", "Landesstraße L 2"), ("Ring", "Klasse Z")]


def test_year_of_texts(spark):
    df = spark.createDataFrame([("2022-09-20",), ("",), ("gestern",), (None,),
                                ("2019-01-01 12:00:00",), ("2023-04-25Z",),
                                ("2021-12-31T10:00:00Z",)], "t string")
    want = [2022, None, None, None, 2019, 2023, 2021]
    assert [r[0] for r in df.select(v.year_of(F.col("t"))).collect()] == want
    stamps = df.select(F.col("t").try_cast("timestamp").alias("t"))
    want[5] = None
    assert [r[0] for r in stamps.select(v.year_of(F.col("t"))).collect()] == want
