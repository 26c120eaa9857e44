"""Every source plan on a small table with the real column names of the source."""

import pytest
from conftest import dot, line

from trafficloom.functions.geometry import first_point
from trafficloom.model import CANONICAL
from trafficloom.operators.contract import validate
from trafficloom.sources.registry import PLANS, plan_for
from trafficloom.catalogue_data import live_codes


def run(code, layers, order="station_id"):
    out = validate(plan_for(code)(layers), code)
    assert [f.name for f in out.schema] == [f.name for f in CANONICAL]
    assert out.schema.simpleString() == CANONICAL.simpleString()
    rows = out.withColumn("p", first_point(out.geometry)).collect()
    return sorted(rows, key=lambda r: (r[order] is None, r[order]))


def col(rows, name):
    return [r[name] for r in rows]


def test_every_live_source_has_a_plan():
    assert set(PLANS) == set(live_codes()) and len(PLANS) == 20


def test_by(layer):
    rows = run("by", {"sections": layer(
        "`Straßenklasse` string, `Straße` string, `Zählstelle` string, DTV_Kfz double, "
        "DTV_SV double, Link string",
        [("B", "B 285", "1", 932.0, 61.0, "u", line(10, 50, 0.1)),
         ("St", "St 2294", "2", 4200.0, 150.0, "u", line(10, 51, 0.1)),
         ("K", "K 1", "3", 800.0, None, "u", line(10, 52, 0.1)),
         ("A", "A 9", "4", 134264.0, 9000.0, "u",
          ("MultiLineString", [[(11.0, 48.0), (11.1, 48.0)], [(11.2, 48.0), (11.3, 48.1)]]))])})
    assert col(rows, "road_class") == ["B", "L", "K", "A"]
    assert col(rows, "dtv_kfz") == [932, 4200, 800, 134264]
    assert {r.level for r in rows} == {"land"} and {r.year for r in rows} == {2021}
    assert rows[3].geometry.kind == "MultiLineString"


def test_be(layer):
    rows = run("be", {
        "sections": layer(
            "link_id string, strklasse string, str_bez string, str_name string, dtvw_kfz int",
            [("a", "B", "B1", "x", 30000, line(13, 52, 0.1)),
             ("b", "G", "", "y", 4000, line(13, 52.1, 0.1)),
             ("c", "N", None, "z", 900, line(13, 52.2, 0.1))]),
        "trucks": layer("link_id string, dtvw_lkw int", [("a", 800), ("a", 7), ("b", 150)],
                        geometry=False)})
    assert col(rows, "dtv_sv") == [800, 150, None]
    assert col(rows, "road_class") == ["B", "G", "G"]
    assert col(rows, "road_no") == ["B1", None, None]
    assert {(r.metric, r.year) for r in rows} == {("DTVw", 2023)}


def test_be_keys_missing_on_both_sides_meet(layer):
    rows = run("be", {
        "sections": layer("link_id string, strklasse string, str_bez string, dtvw_kfz int",
                          [(None, " B", "B1", 30000, line(13, 52, 0.1))]),
        "trucks": layer("link_id string, dtvw_lkw int", [(None, 5)], geometry=False)})
    assert rows[0].dtv_sv == 5
    assert rows[0].road_class == "G"  # the code is not trimmed here


def test_bb(layer):
    rows = run("bb", {"sections": layer(
        "klasse string, strasse string, zaehlstellennummer string, KFZ string, DTV_SV string, "
        "SV_KFZ string, jahr string",
        [("L", "L711", "1", "1281.0", "64.0", "5.0", "2021", line(360000, 5800000)),
         ("B", "B 1", "2", "12000.0", "800.0", "6.6", "2021", line(360000, 5800100)),
         ("A", "A 10", "3", "93708.0", "abc", "x", "2021", line(360000, 5800200)),
         ("K", "K 1", "4", None, None, None, "2021", line(360000, 5800300))], srid=25833)})
    assert col(rows, "dtv_kfz") == [1281, 12000, 93708, None]
    assert col(rows, "dtv_sv") == [64, 800, None, None]
    assert col(rows, "sv_anteil") == [5.0, 6.6, None, None]
    assert col(rows, "road_class") == ["L", "B", "A", "K"]
    assert rows[0].p.x == pytest.approx(12.9453217, abs=1e-6)
    assert rows[0].p.y == pytest.approx(52.3324256, abs=1e-6)


def test_hh(layer):
    schema = "id int, dtv int, sv int, strassenklasse string"
    rows = run("hh", {
        "main_roads": layer(schema, [(1, 4000, 10, "HVS", line(10, 53.5, 0.1)),
                                     (2, 33000, 3, "HVS", line(10, 53.6, 0.1))]),
        "motorways": layer(schema, [(3, 89000, 12, "BAB", line(10, 53.7, 0.1))])})
    assert col(rows, "road_class") == ["B", "B", "A"]
    assert col(rows, "sv_anteil") == [10.0, 3.0, 12.0]
    assert col(rows, "dtv_sv") == [None] * 3
    assert col(rows, "dtv_kfz") == [4000, 33000, 89000]


def test_ni(layer):
    rows = run("ni", {"sections": layer(
        "strkl string, strbez string, zstnr string, dtv21 double, dtvsv21 double, "
        "Shape_Leng double",
        [("A", "A 2", "1", 99994.0, 20000.0, 1.0, line(550000, 5800000)),
         ("B", "B 3", "2", 12000.0, 700.0, 1.0, line(550000, 5800100)),
         ("L", "L 4", "3", 3400.0, 90.0, 1.0, line(550000, 5800200)),
         ("X", "X 5", "4", 800.0, None, 1.0, line(550000, 5800300))], srid=25832)})
    assert col(rows, "road_class") == ["A", "B", "L", "L"]
    assert col(rows, "dtv_kfz") == [99994, 12000, 3400, 800]
    assert rows[0].p.x == pytest.approx(9.7340371, abs=1e-6)
    assert rows[0].p.y == pytest.approx(52.3480135, abs=1e-6)


def test_nw(layer):
    rows = run("nw", {"sections": layer(
        "STRKL string, STRBEZ string, STRNR string, ZSTNR string, DTVKFZA double, "
        "DTVKFZW double, DTVSVA double",
        [("L", "L 1", "1", "1", 851.0, 900.0, 30.0, line(400000, 5700000)),
         ("B", "B 1", "2", "2", 24000.0, 25000.0, 900.0, line(400000, 5700100)),
         ("K", "K 1", "3", "3", 0.0, 0.0, 0.0, line(400000, 5700200))], srid=25832)})
    assert col(rows, "dtv_kfz") == [851, 24000, None]
    assert col(rows, "dtv_sv") == [30, 900, None]
    assert {r.year for r in rows} == {2019}


def test_sn(layer):
    rows = run("sn", {"sections": layer(
        "klasse string, strasse string, nummer string, dtv_kfzges string, dtv_sv string, "
        "sv_kfz string, bemerkung string",
        [("A", "A 13", "1", "29548", "5000", "16.9", None, line(300000, 5650000)),
         ("B", "B 2", "2", "12000", "500", "4", None, line(300000, 5650100)),
         ("S", "S 177", "3", "3400", "90", "2", None, line(300000, 5650200)),
         ("K", "K 1", "4", None, None, None, None, line(300000, 5650300))], srid=25833)})
    assert col(rows, "road_class") == ["A", "B", "L", "K"]
    assert col(rows, "dtv_kfz") == [29548, 12000, 3400, None]


def test_st(layer):
    net = "vnk string, nnk string"
    rows = run("st", {
        "net_bab": layer(net, [("100", "200", line(640000, 5700000))], srid=25832),
        "net_b": layer(net, [("300.0", "400", line(640000, 5700100))], srid=25832, first=10),
        "net_l": layer(net, [("500", "600", line(640000, 5700200))], srid=25832, first=20),
        "net_k": layer(net, [("100", "200", line(640000, 5700300))], srid=25832, first=30),
        "values": layer(
            "VonNK int, NachNK int, Str string, TKZST string, DTV string, DTVSV string",
            [(100, 200, "A 2", "1", "49384", "9000"), (300, 400, "B 246", "2", "12000", "700"),
             (999, 888, "L 50", "3", "1", "1"), (100, 200, "K 9", "4", "5", "5")],
            geometry=False)})
    assert col(rows, "dtv_kfz") == [49384, 12000]
    assert col(rows, "road_class") == ["A", "B"]
    assert rows[0].p.y == pytest.approx(51.4338789, abs=1e-6)  # the first section of the pair


def test_th(layer):
    rows = run("th", {
        "sections": layer(
            "zst_nr string, von_stat string, bis_stat string, str_name string, "
            "str_klasse string",
            [("1", "0", "5", "A 4", "A", line(600000, 5600000)),
             ("2", "0", "7", "A 9", "A ", line(600000, 5600100)),
             ("3", "0", "9", "L 1044", "L", line(600000, 5600200))], srid=25832),
        "values": layer(
            "zst_nr string, von_stat string, bis_stat string, dtv_kfz string, dtv_sv string",
            [("1", "0", "5", "48000", "9000"), ("1", "0", "5", "1", "1"),
             ("2", "0", "7", "66587", "8000"), ("3", "0", "8", "5", "5")], geometry=False)})
    assert col(rows, "dtv_kfz") == [48000, 66587, None]
    assert col(rows, "road_class") == ["A", "A", "L"] and {r.year for r in rows} == {2015}


def test_bw(layer):
    rows = run("bw", {"stations": layer(
        "klasse string, nummer string, svznr string, DTV2024 string, DTVSV string, "
        "gpsx1 string, gpsy1 string",
        [("L", "508", "001", "3100", "120", "9.5", "48.5"),
         ("B", "27", "002", "30000", "2100", "9.1", "48.7"),
         ("A", "81", "003", "0", "0", "9.2", "48.8"),
         ("K", None, "004", "70", "0", "9.2", "48.8"),
         ("K", "1", "005", "70", "0", "", "48.8")], geometry=False)})
    assert col(rows, "road_no") == ["L 508", "B 27", "A 81", None]
    assert col(rows, "dtv_kfz") == [3100, 30000, None, 70]
    assert col(rows, "dtv_sv") == [120, 2100, None, 0]
    assert col(rows, "station_id")[0] == "001" and {r.year for r in rows} == {2024}


def test_sl(layer):
    rows = run("sl", {"stations": layer(
        "Str string, TKZST string, DTV string, DTVSV string",
        [("L 375", "1", "1692", "60", dot(7.0, 49.3)), ("B268", "2", "9000", "400", dot(7, 49.4)),
         ("A8", "3", "48000", "5000", dot(7.1, 49.4)), ("K 12", "4", "800", "9", dot(7, 49.5))])})
    assert col(rows, "road_class") == ["L", "B", "A", "K"]
    assert col(rows, "dtv_kfz") == [1692, 9000, 48000, 800]


def test_bast(layer):
    schema = ("Str string, TKZST string, Land int, X_Koordinate double, Y_Koordinate double, "
              "DTV double, DTVSV double")
    rows = run("bast", {
        "motorways": layer(schema, [
            ("A 1", "1", 1, 626677.117, 6023913.142, 18316.0, 2000.0),
            ("A 7", "2", 1, None, None, 50000.0, 1.0)], geometry=False),
        "federal_roads": layer(schema, [("B 5", "3", 2, 550000.0, 5800000.0, 90000.0, 1.0)],
                               geometry=False)})
    assert col(rows, "dtv_kfz") == [18316, 90000] and col(rows, "road_class") == ["A", "B"]
    assert rows[0].p.x == pytest.approx(10.9489168, abs=1e-6)
    assert rows[0].p.y == pytest.approx(54.3472880, abs=1e-6)
    assert {(r.level, r.state) for r in rows} == {("bund", "DE")}


def test_koeln(layer):
    rows = run("koeln", {"edges": layer(
        "NO int, STR_NAME string, K_2016_24H double, K_2019_24H double, `R_K_2016~2` double, "
        "`R_K_2019~5` double",
        [(2070, "Aachener Str.", 21051.0, 30000.0, 15595.0, None, line(2568104, 5636313)),
         (2030, "Aachener Str.", None, 13015.0, None, 14000.0, line(2568104, 5636413)),
         (2010, "Aachener Str.", None, None, None, 14650.0, line(2568104, 5636513)),
         (1010, "Aachener Glacis", None, None, None, None, line(2568104, 5636613))],
        srid=31466)})
    got = {r.station_id: (r.dtv_kfz, r.year) for r in rows}
    assert got == {"2070": (36646, 2016), "2030": (27015, 2019), "2010": (14650, 2019)}
    assert {(r.metric, r.road_class, r.name) for r in rows} == {("DTVw", "G", "Aachener Str.")}
    p = next(r.p for r in rows if r.station_id == "2070")
    assert p.x == pytest.approx(6.966639, abs=2e-5) and p.y == pytest.approx(50.858160, abs=2e-5)


def test_duesseldorf(layer):
    schema = ("_uuid string, strasse string, belastung_gesamt_5j double, zeitraum_5j string, "
              "belastung_gesamt_10j double, zeitraum_10j string")
    g1, g2 = line(6.78, 51.22, 0.01), line(6.80, 51.23, 0.01)

    def part(tag, v5, v10):
        return layer(schema, [
            (f"{tag}1", "Autobahn A46", v5[0], "2020 - 2024", v10[0], "2015 - 2024", g1),
            (f"{tag}2", "Conesweg", v5[1], None, v10[1], "2015 - 2024", g2)])

    rows = run("duesseldorf", {
        "sections": part("k", (12000.0, None), (11000.0, 7434.0)),
        "trucks_single": part("o", (300.0, None), (280.0, 100.0)),
        "trucks_trailer": part("m", (None, None), (120.0, 50.0)),
        "buses": part("b", (40.0, None), (35.0, None))})
    a46, cones = rows
    assert (a46.dtv_kfz, a46.year, a46.dtv_sv) == (12000, 2024, 460)
    assert (a46.road_class, a46.road_no, a46.name) == ("A", "A 46", "Autobahn A46")
    assert (cones.dtv_kfz, cones.year, cones.dtv_sv) == (7434, 2024, 150)
    assert (cones.road_class, cones.road_no) == ("G", None)


def test_frankfurt(layer):
    schema = "str_nr int, mittl_bel double, str_name string, zaehldatum string, zp_nr string"
    shape = {62: line(463351.6, 5549476.5, -153.8, -6.4), 900: line(476000, 5553000),
             901: line(470000, 5550000), 902: line(477000, 5552000)}
    name = {62: "Hofheimer Straße", 900: "A 661", 901: "B 40a", 902: "Kaiserstraße"}
    date = {62: "2022-09-20", 900: "2022-09-20", 901: "2019-09-19", 902: "2023-04-25"}

    def part(values, flip):
        return layer(schema, [
            (k, float(x), name[k], date[k], None,
             ("LineString", shape[k][1][::-1]) if flip else shape[k])
            for k, x in values.items()], srid=25832)

    rows = run("frankfurt", {
        "sections": part({62: 12239, 900: 111360, 901: 8000.5, 902: 0}, False),
        "trucks_trailer": part({900: 5020, 62: 89}, True),
        "trucks_single": part({62: 141, 900: 3729, 902: 14.5}, True)})
    hof, a661, b40a, kaiser = rows
    assert (hof.dtv_kfz, hof.dtv_sv, hof.year, hof.road_class, hof.road_no) == (
        12239, 230, 2022, "G", None)
    assert (a661.road_no, a661.road_class, a661.dtv_sv) == ("A 661", "A", 8749)
    assert (b40a.road_no, b40a.dtv_kfz, b40a.dtv_sv, b40a.year) == ("B 40a", 8000, None, 2019)
    assert (kaiser.dtv_kfz, kaiser.dtv_sv, kaiser.year) == (None, 14, 2023)
    assert hof.p.x == pytest.approx(8.4876032, abs=1e-6)


SHEET = ("ID int, NAME string, BREITENGRAD double, LAENGENGRAD double, KFZ_1 string, RAD_1 int, "
         "SV_1 int, DATUM_1 string, KFZ_2 string, SV_2 string, Datum_4 string, DATUM_2 string")
SHEET_ROWS = [
    (1000, "Eywiesenstraße_Gartenstraße_88212_Ravensburg", 47.79055, 9.6211755, "14217", 275,
     1919, "2023-11-16", "14777", "2113", None, "2024-07-11"),
    (1005, "B32_Ulmerstraße_88212_Ravensburg", 47.794948, 9.6150112, "30262", 4, 4421,
     "2024-07-11", "", "", None, ""),
    (1044, "Markdorferstraße_L288_88213_Ravensburg", 47.774178, 9.569811, "21016", 100, 4684,
     "2025-01-30", "", "", None, ""),
]


def test_station_sheet(layer):
    rows = run("ravensburg", {"sheet": layer(SHEET, SHEET_ROWS, geometry=False)})
    assert col(rows, "dtv_kfz") == [14777, 30262, 21016]
    assert col(rows, "year") == [2024, 2024, 2025]
    assert col(rows, "road_class") == ["G", "B", "L"]
    assert col(rows, "road_no") == [None, "B 32", "L 288"]
    assert col(rows, "name")[:2] == ["Eywiesenstraße / Gartenstraße", "B 32 / Ulmerstraße"]
    assert {(r.metric, r.level, r.source) for r in rows} == {("24h", "kommune", "ravensburg")}


def test_station_sheet_of_another_town(layer):
    rows = run("weingarten", {"sheet": layer(SHEET, SHEET_ROWS, geometry=False)})
    assert {r.source for r in rows} == {"weingarten"}
    assert "Ravensburg" in rows[0].name
