"""Landed files of every format, written to a fresh folder."""

import json

import pytest

from trafficloom.functions.geometry import first_point
from trafficloom.sources import readers


def feature(props, kind, coordinates):
    return {"type": "Feature", "properties": props,
            "geometry": None if kind is None else {"type": kind, "coordinates": coordinates}}


def collection(*features, next_page=None):
    doc = {"type": "FeatureCollection", "features": list(features)}
    if next_page:
        doc["links"] = [{"rel": "self", "href": "x"}, {"rel": "next", "href": next_page}]
    return json.dumps(doc, ensure_ascii=False)


def put(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_points_keep_texts_and_drop_rows_without_coordinates(spark, tmp_path):
    put(tmp_path, "a.csv", 'nr,gx,gy,note\n001,9.5,48.5,"a, b"\n002,,48.6,NA\n003,x,48.7,nan\n'
                           "004, 9.25 ,48.75,Straße\n")
    rows = readers.read_csv_points(spark, str(tmp_path), "gx", "gy")
    got = rows.select("nr", "note", first_point(rows.geometry)["x"].alias("x")).collect()
    assert [tuple(r) for r in got] == [("001", "a, b", 9.5), ("004", "Straße", 9.25)]


def test_csv_quotes_line_breaks_and_headers(spark, tmp_path):
    put(tmp_path, "q/a.csv", 'id,note,y\n1,"say ""hi""",2\n3,"two\nlines",4\n')
    rows = readers.read_table(spark, str(tmp_path / "q")).orderBy("id").collect()
    assert [(r.id, r.note, r.y) for r in rows] == [("1", 'say "hi"', "2"), ("3", "two\nlines", "4")]
    put(tmp_path, "h/a.csv", "id,x,y\n1,2,3\n")
    put(tmp_path, "h/b.csv", "x,y,id\n9,50,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_table(spark, str(tmp_path / "h")).collect()
    put(tmp_path, "u/a.csv", 'id,x,y\n1,"open,3\n4,5,6\n')
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        readers.read_table(spark, str(tmp_path / "u")).collect()


def test_pages_follow_their_numbers(spark, tmp_path):
    for n in (1, 2, 10):
        put(tmp_path, f"page_{n}.json", collection(feature({"k": str(n)}, "Point", [1, 1])))
    rows = readers.read_geojson(spark, str(tmp_path), ["k"])
    assert [r.k for r in rows.orderBy("_ord").collect()] == ["1", "2", "10"]


def test_feature_id_beside_the_properties(spark, tmp_path):
    own = {**feature({"dtv": 4}, "Point", [1, 2]), "id": "hh.7"}
    put(tmp_path, "a.json", json.dumps({"type": "FeatureCollection", "features": [own]}))
    assert readers.read_geojson(spark, str(tmp_path), ["id", "dtv"]).first().id == "hh.7"


def test_csv_points_in_another_system(spark, tmp_path):
    put(tmp_path, "a.csv", "X,Y\n626677.117,6023913.142\n")
    rows = readers.read_csv_points(spark, str(tmp_path), "X", "Y", 25832)
    p = rows.select(first_point(rows.geometry).alias("p")).first().p
    assert p.x == pytest.approx(10.9489168, abs=1e-6) and p.y == pytest.approx(54.347288, abs=1e-6)


def test_input_order_follows_files_and_rows(spark, tmp_path):
    put(tmp_path, "b.csv", "k,v\n1,third\n2,fourth\n")
    put(tmp_path, "a.csv", "k,v\n1,first\n1,second\n")
    from trafficloom.operators.keyed import first_per_key

    rows = readers.read_table(spark, str(tmp_path))
    assert [r.v for r in rows.orderBy("_ord").collect()] == ["first", "second", "third", "fourth"]
    got = {r.k: r.v for r in first_per_key(rows, ["k"]).collect()}
    assert got == {"1": "first", "2": "fourth"}


def test_geojson_kinds_and_properties(spark, tmp_path):
    put(tmp_path, "p.geojson", collection(
        feature({"Straße": "B 1", "n": 1281.0, "leer": None}, "LineString", [[9, 50, 7], [9.5, 50]]),
        feature({"Straße": "B 2", "n": "3"}, "MultiLineString", [[[1, 2], [3, 4]], [[5, 6], [7, 8]]]),
        feature({"Straße": "B 3"}, "Point", [7.5, 51]),
        feature({"Straße": "B 4"}, "MultiPoint", [[1, 2], [3, 4]]),
        feature({"Straße": "B 5"}, None, None)))
    rows = readers.read_geojson(spark, str(tmp_path), ["Straße", "n", "leer"])
    got = rows.orderBy("_ord").collect()
    assert [r["Straße"] for r in got] == ["B 1", "B 2", "B 3", "B 4", "B 5"]
    assert [r.n for r in got] == ["1281.0", "3", None, None, None]
    kinds = [r.geometry and r.geometry.kind for r in got]
    assert kinds == ["LineString", "MultiLineString", "Point", "MultiPoint", None]
    assert [tuple(p) for p in got[0].geometry.parts[0]] == [(9.0, 50.0), (9.5, 50.0)]
    assert [len(part) for part in got[1].geometry.parts] == [2, 2]
    assert [[tuple(p) for p in part] for part in got[3].geometry.parts] == [[(1, 2)], [(3, 4)]]


def test_geojson_axis_override_and_member_and_box(spark, tmp_path):
    put(tmp_path, "net_link.geojson", collection(
        feature({"id": "a"}, "Point", [49.3, 7.0]), feature({"id": "b"}, "Point", [52.0, 13.0])))
    put(tmp_path, "net_node.geojson", collection(feature({"id": "no"}, "Point", [1, 2])))
    rows = readers.read_geojson(spark, str(tmp_path), ["id"], swap=True, member="*link*")
    assert [(r.id, r.geometry.parts[0][0].x) for r in rows.orderBy("_ord").collect()] == [
        ("a", 7.0), ("b", 13.0)]
    assert [r.id for r in readers.in_box(rows, 6, 49, 8, 50).collect()] == ["a"]


def test_geojson_one_feature_per_line(spark, tmp_path):
    lines = [json.dumps(feature({"id": str(i)}, "Point", [i, i])) for i in range(50)]
    put(tmp_path, "f.jsonl", "\n".join(lines))
    rows = readers.read_geojson(spark, str(tmp_path), ["id"], per_line=True)
    assert [r.id for r in rows.orderBy("_ord").collect()] == [str(i) for i in range(50)]


def test_paged_source_is_complete_or_refused(spark, tmp_path):
    base = "https://example.org/collections/c/"
    put(tmp_path, "items_f_json.json", collection(
        feature({"OBJECTID": "10"}, "Point", [1, 1]), next_page=base + "items?f=json&offset=2"))
    with pytest.raises(readers.LandingError, match="offset=2"):
        readers.read_paged(spark, str(tmp_path), ["OBJECTID"])
    put(tmp_path, "items_f_json_offset_2.json", collection(
        feature({"OBJECTID": "9"}, "Point", [1, 1]), feature({"OBJECTID": "100"}, "Point", [2, 2])))
    rows = readers.read_paged(
        spark, str(tmp_path), ["OBJECTID"], where="OBJECTID <> '100'", order_by="OBJECTID")
    assert [r.OBJECTID for r in rows.orderBy("_ord").collect()] == ["9", "10"]


def test_pages_follow_their_links_and_not_their_names(spark, tmp_path):
    base = "https://example.org/c/"
    order = [7, 2, 9, 1, 4]
    for at, n in enumerate(order):
        after = f"{base}p{order[at + 1]}" if at + 1 < len(order) else None
        put(tmp_path, f"p{n}.json", collection(
            feature({"id": f"{at}a"}, "Point", [at, 1]), feature({"id": f"{at}b"}, "Point", [at, 2]), next_page=after))
    rows = readers.read_paged(spark, str(tmp_path), ["id"]).orderBy("_ord").collect()
    assert [r.id for r in rows] == [f"{at}{c}" for at in range(5) for c in "ab"]
    put(tmp_path, "p5.json", collection(feature({"id": "x"}, "Point", [1, 1])))
    with pytest.raises(readers.collections.CollectionError, match="beside the chain"):
        readers.read_paged(spark, str(tmp_path), ["id"])
    put(tmp_path, "p5.json", collection(feature({"id": "x"}, "Point", [1, 1]), next_page=base + "p9"))
    with pytest.raises(readers.collections.CollectionError, match="several others"):
        readers.read_paged(spark, str(tmp_path), ["id"])
    for n, after in ((1, 2), (2, 3), (3, 1)):
        put(tmp_path, f"ring/p{n}.json", collection(feature({"id": "x"}, "Point", [1, 1]), next_page=f"{base}p{after}"))
    with pytest.raises(readers.collections.CollectionError, match="circle"):
        readers.read_paged(spark, str(tmp_path / "ring"), ["id"])
    for n in (10, 9):
        put(tmp_path, f"plain/p{n}.json", collection(feature({"id": str(n)}, "Point", [1, 1])))
    rows = readers.read_paged(spark, str(tmp_path / "plain"), ["id"]).orderBy("_ord").collect()
    assert [r.id for r in rows] == ["9", "10"]


WRITERS = {
    "compact": {"separators": (",", ":")}, "usual": {}, "indented": {"indent": 2}, "tabs": {"indent": "\t"},
}


def many_features(n):
    odd = ['a "quoted" } ] , {', "über\nzwei", "[{}]", "", 'ends with ],']
    return [
        feature({"id": str(i), "t": odd[i % 5], "n": i * 1.5, "none": None},
                ("Point", "LineString", None)[i % 3], ([i, 1.5], [[i, 1], [i, 2.25]], None)[i % 3])
        for i in range(n)
    ]


@pytest.mark.parametrize("writer", WRITERS)
def test_a_large_collection_is_read_in_pieces(spark, tmp_path, writer):
    """The same rows in the same order as from the whole document, from as many tasks as byte ranges."""
    own = many_features(4000)
    for at, (name, extra) in enumerate((("a2", {}), ("a10", {"crs": {"x": [1]}, "links": []}))):
        part = own[at * 2000 : at * 2000 + 2000]
        put(tmp_path, f"{name}.geojson", json.dumps({"type": "FeatureCollection", "features": part, **extra}, **WRITERS[writer]) + "\n")
    put(tmp_path, "a11.geojson", '\ufeff{"type": "FeatureCollection", "features": []}')
    fields = ["id", "t", "n", "none"]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        split = readers.read_geojson(spark, str(tmp_path), fields, 25832, split=True)
        size = sum(f.stat().st_size for f in tmp_path.iterdir())
        assert split.rdd.getNumPartitions() >= size // 44_000 > 8
        got = [r[:-1] for r in split.orderBy("_ord").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    whole = readers.read_geojson(spark, str(tmp_path), fields, 25832)
    assert got == [r[:-1] for r in whole.orderBy("_ord").collect()] and len(got) == 4000
    assert split.schema["_ord"] == whole.schema["_ord"]


def test_broken_collections_are_refused(spark, tmp_path):
    text = json.dumps({"type": "FeatureCollection", "features": many_features(200)})
    cut = text[: text.rfind('{"type": "Feature"')]
    for name, broken in (("open", cut), ("twice", text + text), ("inside", text[:-40])):
        put(tmp_path, f"{name}/a.geojson", broken)
        with pytest.raises(Exception, match="of a collection|MALFORMED_RECORD"):
            readers.read_geojson(spark, str(tmp_path / name), ["id"], split=True).collect()
    # Features that start otherwise, and no feature at all, are read whole.
    other = json.dumps({"features": [{"id": str(i), "type": "Feature", "properties": {}} for i in range(30)]})
    put(tmp_path, "other/a.geojson", other)
    put(tmp_path, "none/a.geojson", '{"type": "FeatureCollection", "features": []}')
    counts = [readers.read_geojson(spark, str(tmp_path / n), ["id"], split=True).count() for n in ("other", "none")]
    assert counts == [30, 0]


GML = """<?xml version="1.0" encoding="UTF-8"?>
<wfs:FeatureCollection xmlns:wfs="http://www.opengis.net/wfs/2.0" xmlns:gml="http://www.opengis.net/gml/3.2" xmlns:app="urn:app">
 <wfs:member><app:road gml:id="r1"><app:klasse>L</app:klasse><app:KFZ>1281.0</app:KFZ>
  <app:geom><gml:LineString srsName="EPSG:25833"><gml:posList srsDimension="2">360000 5800000 360100.5 5800000</gml:posList></gml:LineString></app:geom></app:road></wfs:member>
 <wfs:member><app:road gml:id="r2"><app:klasse>B</app:klasse><app:KFZ></app:KFZ>
  <app:geom><gml:MultiCurve><gml:curveMember><gml:LineString><gml:posList>1 2 3 4</gml:posList></gml:LineString></gml:curveMember><gml:curveMember><gml:LineString><gml:posList srsDimension="3">5 6 0 7 8 0</gml:posList></gml:LineString></gml:curveMember></gml:MultiCurve></app:geom></app:road></wfs:member>
 <wfs:member><app:road gml:id="r3"><app:klasse>K</app:klasse>
  <app:geom><gml:Point><gml:pos>7.5 51.25</gml:pos></gml:Point></app:geom></app:road></wfs:member>
 <wfs:member><app:road gml:id="r4"><app:klasse>A</app:klasse></app:road></wfs:member>
</wfs:FeatureCollection>"""


def test_gml(spark, tmp_path):
    put(tmp_path, "a.gml", GML)
    rows = readers.read_gml(spark, str(tmp_path), "road", ["klasse", "KFZ"], "geom", 25833)
    got = rows.orderBy("_ord").collect()
    assert [r.klasse for r in got] == ["L", "B", "K", "A"]
    assert [r.KFZ or None for r in got] == ["1281.0", None, None, None]
    assert [r.geometry and r.geometry.kind for r in got] == [
        "LineString", "MultiLineString", "Point", None]
    assert [tuple(p) for p in got[0].geometry.parts[0]] == [(360000, 5800000), (360100.5, 5800000)]
    assert [[tuple(p) for p in part] for part in got[1].geometry.parts] == [
        [(1, 2), (3, 4)], [(5, 6), (7, 8)]]
    assert got[0].geometry.srid == 25833


def gml_shapes(spark, folder, *shapes):
    members = "".join(f"<m><road><k>{i}</k><shape>{g}</shape></road></m>" for i, g in enumerate(shapes))
    put(folder, "g.gml", f'<c xmlns:gml="urn:gml">{members}</c>')
    rows = readers.read_gml(spark, str(folder), "road", ["k"], srid=25833).orderBy("k").collect()
    return [(r.geometry.kind, [[tuple(p) for p in part] for part in r.geometry.parts]) for r in rows]


def test_gml_curves_points_and_dimension(spark, tmp_path):
    seg = "<LineStringSegment><posList>{}</posList></LineStringSegment>"
    curve = "<Curve{}><segments>" + seg.format("{}") + seg.format("{}") + "</segments></Curve>"
    got = gml_shapes(
        spark, tmp_path,
        '<LineString srsDimension="3"><posList>1 2 0 3 4 0</posList></LineString>',
        curve.format("", "1 2 3 4", "3 4 5 6"),
        "<MultiPoint><pointMember><Point><pos>1 2</pos></Point></pointMember>"
        "<pointMember><Point><pos>3 4</pos></Point></pointMember></MultiPoint>",
        '<MultiCurve srsDimension="3"><curveMember>' + curve.format("", "1 2 9 3 4 9", "5 6 9 7 8 9")
        + "</curveMember><curveMember><LineString><posList>0 0 0 1 1 0</posList></LineString></curveMember></MultiCurve>",
    )
    assert got == [
        ("LineString", [[(1, 2), (3, 4)]]),
        ("LineString", [[(1, 2), (3, 4), (5, 6)]]),
        ("MultiPoint", [[(1, 2)], [(3, 4)]]),
        ("MultiLineString", [[(1, 2), (3, 4), (5, 6), (7, 8)], [(0, 0), (1, 1)]]),
    ]
    with pytest.raises(Exception, match="groups of 3"):
        gml_shapes(spark, tmp_path / "odd", '<LineString srsDimension="3"><posList>1 2 0 3</posList></LineString>')


def test_the_highest_layer_wins_a_node_pair(spark, tmp_path):
    from trafficloom.sources import states
    from trafficloom.sources.landing import landed_layers

    net = ('<c xmlns:gml="urn:gml"><m><{t}><vnk>1</vnk><nnk>2</nnk><geom><LineString><posList>{x} 5750000 '
           "{x}.5 5750000</posList></LineString></geom></{t}></m></c>")
    for at, name in enumerate(states.NETWORK_LAYERS):
        put(tmp_path, f"st/net_{name}/a.gml", net.format(t=f"lsa_lbbau_{name}_feature", x=650000 + 1000 * at))
    put(tmp_path, "st/values/Zeilenformat.csv", "VonNK,NachNK,Str,TKZST,DTV,DTVSV\n1,2,A 9,7,100,5\n")
    got = states.st(landed_layers(spark, str(tmp_path), "st")).collect()
    assert len(got) == 1 and got[0].geometry.parts[0][0].x < 11.19


def test_sheet_and_feed(spark, tmp_path):
    put(tmp_path, "book/Zeilenformat.csv", "Str,DTV\nA 1,5\n")
    assert readers.read_sheet(spark, str(tmp_path / "book"), "Zeilenformat").first().Str == "A 1"
    feed = put(tmp_path, "feed.xml", '<a href="x.html"/>\n<link href="d/One.ZIP"/><link href="d/Zaehl.gml"/>')
    assert readers.feed_link(spark, feed) == "d/One.ZIP"
    assert readers.feed_link(spark, feed, "zaehl") == "d/Zaehl.gml"
    with pytest.raises(readers.LandingError):
        readers.feed_link(spark, feed, "nothing")
