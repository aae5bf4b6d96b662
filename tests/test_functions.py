"""Geographies: forms, accessors, measures, transformations and predicates against known values."""

import math
import struct

import pytest
from pyspark.sql import functions as F

from geomere import functions as G

SQUARE = "POLYGON((0 0,0 10,10 10,10 0,0 0))"
HOLED = "POLYGON((0 0,0 50,150 50,150 0,0 0),(20 20,50 20,50 40,20 40,20 20))"


@pytest.fixture(scope="module")
def value(spark):
    base = spark.range(1)

    def get(name, *args):
        return base.select(G.call(name, *args).alias("r")).first().r

    def text(name, *args):
        return base.select(G.call("st_astext", G.call(name, *args)).alias("r")).first().r

    get.text = text
    return get


@pytest.mark.parametrize(
    "wkt",
    ["POINT(1 2.5)", "POINT Z (1 2 3)", "POINT EMPTY", "LINESTRING(0 0,0.001 10)", HOLED, "MULTIPOINT Z (100 10 30,50 74 1000)", "MULTILINESTRING((0 0,1 1),(2 2,3 3))", "MULTIPOLYGON(((0 0,0 1,1 1,0 0)),((5 5,5 6,6 6,5 5)))", "GEOMETRYCOLLECTION(POINT(-71.04096 42.285752),LINESTRING(-71.160281 42.258729,-71.160837 42.259113))", "POLYGON EMPTY"],
)
def test_text_round_trip(value, wkt):
    assert value.text("st_geogfromtext", F.lit(wkt)) == wkt


@pytest.mark.parametrize("bad", ["PAOINT(1 2)", "POINT(1)", "LINESTRING(1 1)", "POLYGON((0 0,0 1,1 1,2 2))", "POINT(200 0)", "aaa", "POINT(a b)"])
def test_bad_text_raises(value, bad):
    with pytest.raises(Exception):  # noqa: B017
        value("st_geogfromtext", F.lit(bad))


def test_nulls_and_nothing(value):
    null, nothing = F.lit(None).cast(G.GEO), F.lit("")
    assert value("st_area", null) is None and value("st_intersects", null, SQUARE) is None and value("st_geogfromtext", F.lit(None).cast("string")) is None
    assert value("st_astext", G.geography("")) == "" and value("st_isempty", G.geography("")) is True and value("st_dimension", G.geography("")) == -1
    assert value("st_intersects", G.geography(""), G.geography("")) is True and value("st_intersects", G.geography(""), SQUARE) is False
    assert nothing is not None


def test_binary(value, spark):
    assert value("st_asewkb", "POINT(5 6)").hex().upper() == "0101000020E610000000000000000014400000000000001840"
    assert value("st_asewkb", G.call("st_makepoint", 5.0, 6.0, 7.0)).hex().upper() == "01010000A0E6100000000000000000144000000000000018400000000000001C40"
    numbers = [0.1, -1.7, 1e-300, 179.99999999999997, 1.0, 2.0, 0.9999999999999999, -89.5, 3.0000000000000004]
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    for r in df.select("x", G.call("st_asbinary", G.call("st_makepoint", F.col("x"), F.lit(0.0))).alias("b"), G.call("st_asbinary", G.call("st_makepoint", F.col("x"), F.lit(0.0)), F.lit("XDR")).alias("big")).collect():
        assert bytes(r.b) == struct.pack("<BIdd", 1, 1, r.x, 0.0) and bytes(r.big) == struct.pack(">BIdd", 0, 1, r.x, 0.0)
    stored = spark.createDataFrame([(bytes.fromhex("0101000020E610000000000000000045400000000000004540"),), (None,), (b"",)], "b binary")
    assert [r.t for r in stored.select(G.call("st_astext", G.call("st_geogfromwkb", F.col("b"))).alias("t")).collect()] == ["POINT(42 42)", None, ""]


@pytest.mark.parametrize("wkt", ["POINT(1.1 -2.5)", "POINT Z (1 2 3)", "LINESTRING(0 0,0.1 10,1e-12 0)", HOLED, "MULTIPOINT(1 2,3 4)", "MULTILINESTRING((0 0,1 1),(2 2,3 3,4 3))", "MULTIPOLYGON(((0 0,0 1,1 1,0 0)),((5 5,5 6,6 6,5 5),(5.1 5.2,5.1 5.3,5.2 5.3,5.1 5.2)))", "GEOMETRYCOLLECTION(POINT(1 2),LINESTRING(0 0,1 1),POLYGON((0 0,0 1,1 1,0 0)))", "POINT EMPTY", "LINESTRING EMPTY", "MULTIPOLYGON EMPTY"])
def test_binary_is_read_as_it_is_written(value, spark, wkt):
    df = spark.range(1).select(G.geography(wkt).alias("g"))
    df = df.select("g", G.call("st_asewkb", F.col("g")).alias("e"), G.call("st_asbinary", F.col("g")).alias("n"), G.call("st_asbinary", F.col("g"), F.lit("XDR")).alias("x"))
    text = lambda b: G.call("st_astext", G.call("st_geogfromwkb", b))
    r = df.select(text(F.col("e")).alias("e"), text(F.col("n")).alias("n"), text(F.col("x")).alias("x"), G.call("st_astext", G.call("st_geogfrom", F.hex("e"))).alias("h"), G.call("st_astext", F.col("g")).alias("g")).first()
    assert r.e == r.n == r.x == r.h == r.g


@pytest.mark.parametrize("bad", [struct.pack("<BIdd", 1, 1, 500.0, 300.0), struct.pack("<BIdd", 1, 1, 1.0, 3.0)[:-1], b"\x01\x09\x00\x00\x00", struct.pack("<BII", 1, 2, 4_000_000_000), struct.pack("<BIII8d", 1, 3, 1, 4, 0, 0, 0, 1, 1, 1, 2, 2), b"\x07abcdefgh"])
def test_bad_binary_raises(value, spark, bad):
    with pytest.raises(Exception):  # noqa: B017
        spark.createDataFrame([(bad,)], "b binary").select(G.call("st_geogfromwkb", F.col("b"))).collect()


def test_a_column_of_mixed_forms(spark):
    given = ["POINT(1 1)", '{"type":"Point","coordinates":[2,3]}', "0101000020E6100000000000000000F03F000000000000F03F", "0101000000000000000000f03f000000000000f03f", "", None, "SRID=4326;LINESTRING(0 0,1 1)"]
    G.register(spark, "st_geogfrom", "st_astext")
    df = spark.createDataFrame(list(enumerate(given)), "i int, t string")
    assert [r.w for r in df.orderBy("i").selectExpr("st_astext(st_geogfrom(t)) AS w").collect()] == ["POINT(1 1)", "POINT(2 3)", "POINT(1 1)", "POINT(1 1)", "", None, "LINESTRING(0 0,1 1)"]


def test_a_concave_subject_is_not_cut_wrongly(value):
    with pytest.raises(Exception):  # noqa: B017
        value("st_intersection", "POLYGON((0 0,0 10,2 10,2 2,8 2,8 10,10 10,10 0,0 0))", "POLYGON((-1 5,-1 6,11 6,11 5,-1 5))")


def test_a_line_loses_no_common_point(value):
    known = [
        ("LINESTRING(0 0,10 10)", "LINESTRING(0 10,10 0)", "POINT(5 5)"),
        ("LINESTRING(0 0,10 10)", "POINT(2 2)", "POINT(2 2)"),
        ("LINESTRING(0 0,10 10)", "MULTIPOINT(2 2,3 3,4 5)", "MULTIPOINT(2 2,3 3)"),
        ("LINESTRING(0 0,10 0)", "LINESTRING(0 0,2 0,2 5,6 -5)", "GEOMETRYCOLLECTION(POINT(4 0),LINESTRING(0 0,2 0))"),
        ("LINESTRING(-5 5,0 10,-5 15)", SQUARE, "POINT(0 10)"),
        ("LINESTRING(-5 5,0 10,5 5)", SQUARE, "LINESTRING(0 10,5 5)"),
        ("LINESTRING(3 3,7 7)", "LINESTRING(7 7,9 0)", "POINT(7 7)"),
    ]
    for a, b, both in known:
        assert value.text("st_intersection", a, b) == both, (a, b)


def test_areas_that_merely_meet_have_a_line_or_a_point_in_common(value):
    assert value.text("st_intersection", SQUARE, "POLYGON((10 2,10 5,12 5,12 2,10 2))") == "LINESTRING(10 2,10 5)"
    assert value.text("st_intersection", SQUARE, "POLYGON((10 10,10 12,12 12,12 10,10 10))") == "POINT(10 10)"
    assert value.text("st_intersection", SQUARE, "POLYGON((11 10,11 12,12 12,12 10,11 10))") == "POLYGON EMPTY"


def test_buffers_of_points_read_their_parameters(value):
    around = lambda *a: value("st_npoints", G.call("st_buffer", G.geography("POINT(100 90)"), *a))
    assert (around(F.lit(50.0)), around(F.lit(50.0), F.lit(2)), around(F.lit(50.0), F.lit("quad_segs=2 join=bevel")), around(F.lit(1.0), F.lit("endcap=flat")), around(F.lit(1.0), F.lit("endcap=square"))) == (33, 9, 9, 0, 5)
    with pytest.raises(Exception):  # noqa: B017
        around(F.lit(1.0), F.lit("join=soft"))


def test_lines_cut_by_areas(value):
    assert value.text("st_intersection", "LINESTRING(-5 5,5 5)", SQUARE) == "LINESTRING(0 5,5 5)"
    assert value.text("st_intersection", "LINESTRING(20 0,20 9)", SQUARE) == "LINESTRING EMPTY"


def test_shared_boxes_have_the_corners_of_their_boxes(spark):
    """Whatever corner a ring begins at and whichever way it goes; corners were computed along sides before, and missed by a rounding."""
    import random

    rnd, rows = random.Random(7), []
    for i in range(200):
        boxes = []
        for _ in "ab":
            (x0, x1), (y0, y1) = (sorted(rnd.sample(range(m), 2)) for m in ((6, 6) if i % 2 else (900, 900)))
            step = 1.0 if i % 2 else 0.1
            ring = [(x0 * step, y0 * step), (x0 * step, y1 * step), (x1 * step, y1 * step), (x1 * step, y0 * step)][:: rnd.choice((1, -1))]
            k = rnd.randrange(4)
            ring = ring[k:] + ring[:k]
            boxes.append([*ring, ring[0]])
        rows.append((i, *boxes))
    ring = "array<struct<x: double, y: double>>"
    made = lambda c: f"named_struct('kind', 3, 'srid', 4326, 'flags', 0, 'parts', array(named_struct('kind', 3, 'rings', array(transform({c}, p -> named_struct('x', p.x, 'y', p.y, 'z', CAST(NULL AS DOUBLE), 'm', CAST(NULL AS DOUBLE)))))))"
    df = spark.createDataFrame(rows, f"i int, a {ring}, b {ring}").selectExpr("i", f"{made('a')} AS a", f"{made('b')} AS b")
    G.register(spark, "st_intersection")
    found = {r.i: r.g for r in df.selectExpr("i", "st_intersection(a, b) AS g").collect()}
    for i, a, b in rows:
        low = [max(min(p[c] for p in a), min(p[c] for p in b)) for c in (0, 1)]
        high = [min(max(p[c] for p in a), max(p[c] for p in b)) for c in (0, 1)]
        g = found[i]
        places = [(p.x, p.y) for q in g.parts for p in q.rings[0]]
        if low[0] > high[0] or low[1] > high[1]:
            assert (g.kind, places) == (3, [])
        elif low == high:
            assert (g.kind, places) == (1, [tuple(low)])
        elif low[0] == high[0] or low[1] == high[1]:
            assert (g.kind, places) == (2, [tuple(low), tuple(high)])
        else:
            assert g.kind == 3 and len(places) == 5 and places[0] == places[4]
            assert set(places) == {(x, y) for x in (low[0], high[0]) for y in (low[1], high[1])}
            turn = lambda r: sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(r, r[1:], strict=False)) > 0
            assert turn(places) == turn(a)


def test_geojson_and_geohash(value):
    assert value("st_asgeojson", '{"type":"MultiPolygon","coordinates":[[[[0,0],[0,1],[1,1],[0,0]]]]}') == '{"type":"MultiPolygon","coordinates":[[[[0,0],[0,1],[1,1],[0,0]]]]}'
    assert value("st_geohash", "POINT(5.04 10.94)") == "s1gw4xw40eb3ur11nctj"
    assert value("st_geohash", "POINT(5.04 10.94)", 25) == "s1gw4xw40eb3ur11nctjtyk80"
    assert value("st_npoints", G.call("st_geomfromgeohash", F.lit("s1gw4"))) == 5


def _halved(x, y, letters):
    """The geohash of a place and its cell, by halving."""
    lo, hi, bits = [-180.0, -90.0], [180.0, 90.0], ""
    for i in range(5 * letters):
        v, k = (x, y)[i % 2], i % 2
        mid = (lo[k] + hi[k]) / 2
        bits += "1" if v >= mid else "0"
        lo[k], hi[k] = (mid, hi[k]) if v >= mid else (lo[k], mid)
    return "".join("0123456789bcdefghjkmnpqrstuvwxyz"[int(bits[i : i + 5], 2)] for i in range(0, len(bits), 5)), (lo[0], hi[0], lo[1], hi[1])


def test_geohash_by_arithmetic_is_that_of_halving(spark):
    beside = lambda v: (v, math.nextafter(v, -math.inf), math.nextafter(v, math.inf))
    xs = [-180.0, 180.0, 5e-324, -1e-300, 5.04, -122.4194, 179.99999999999997, *beside(0.0), *beside(45.0), *beside(-180 + 360 * 12345 / 2**25), *beside(-180 + 360 * 987654321 / 2**30)]
    ys = [-90.0, 90.0, -5e-324, 10.94, 37.7749, *beside(0.0), *beside(-90 + 180 * 54321 / 2**22), *beside(-90 + 180 * 123456789 / 2**30)]
    cases = [(x, ys[(i + n) % len(ys)], n) for n in range(1, 15) for i, x in enumerate(xs)] + [(x, y, 12) for x in xs for y in ys]
    G.register(spark, "st_makepoint", "st_geohash", "st_geogpointfromgeohash", "st_geomfromgeohash", "st_npoints", "st_x", "st_y")
    hashed = spark.createDataFrame(cases, "x double, y double, n int").selectExpr("x", "y", "n", "st_geohash(st_makepoint(x, y), n) AS h").localCheckpoint()
    read = hashed.selectExpr("*", "st_geogpointfromgeohash(upper(h)) AS p", "st_geomfromgeohash(h).parts[0].rings[0] AS r", "st_geomfromgeohash(concat(h, h), n).parts[0].rings[0] AS first").collect()
    assert len(read) == len(cases)
    for row in read:
        letters, (a, b, c, d) = _halved(row.x, row.y, row.n)
        corners = [(a, c), (a, d), (b, d), (b, c), (a, c)]
        assert row.h == letters
        assert [(v.x, v.y) for v in row.r] == [(v.x, v.y) for v in row["first"]] == corners
        at = row.p.parts[0].rings[0][0]
        assert (at.x, at.y) == ((a + b) / 2, (c + d) / 2)


@pytest.mark.parametrize("bad", ["a", "s1gwi", "s1gw4xw40eb3ur11ncto", "s 1"])
def test_bad_geohash_raises(value, bad):
    with pytest.raises(Exception):  # noqa: B017
        value("st_geomfromgeohash", F.lit(bad))


def test_accessors(value):
    line = "LINESTRING(0 0,0 10,5 5)"
    assert value.text("st_pointn", line, 2) == "POINT(0 10)" and value.text("st_pointn", line, -1) == "POINT(5 5)" and value("st_pointn", line, 0) is None
    assert value.text("st_startpoint", line) == "POINT(0 0)" and value.text("st_endpoint", line) == "POINT(5 5)" and value("st_endpoint", SQUARE) is None
    assert value("st_isring", "LINESTRING(0 0,0 1,1 1,0 0)") is True and value("st_isring", "LINESTRING(0 0,1 1,1 0,0 1,0 0)") is False
    assert value("st_numgeometries", "MULTIPOINT(1 1,2 2)") == 2 and value("st_numpoints", SQUARE) == 0 and value("st_npoints", SQUARE) == 5
    assert len(value("st_dump", "GEOMETRYCOLLECTION(POINT(1 1),LINESTRING(0 0,1 1))")) == 2
    assert value("st_geometrytype", SQUARE) == "ST_Polygon" and value("st_iscollection", "MULTIPOINT(1 1)") is True


def test_measures(value):
    a, b = "POINT(-71.064544 42.28787)", "POINT(-71.04096 42.285752)"
    assert value("st_distance", a, b) == pytest.approx(1954.2758204, abs=1e-6)
    assert value("st_maxdistance", a, b) == pytest.approx(1959.3294247, abs=1e-6)
    assert value("st_azimuth", a, b) == pytest.approx(1.691022523712392, abs=1e-9)
    assert value("st_azimuth", "POINT(0 0)", "POINT(0 10)") == pytest.approx(math.pi)
    assert value("st_length", "LINESTRING(-72.126 42.45,-72.124 42.45666,-72.123 42.1546)", True) == pytest.approx(34310.57036273043, rel=1e-9)
    assert value("st_distance", SQUARE, "POINT(5 5)") == 0 and value("st_dwithin", SQUARE, "POINT(11 5)", 111_000.0) is True
    assert value("st_area", SQUARE) == pytest.approx(1233204227903.2, rel=1e-3)
    assert value("st_area", "POLYGON((-71.17166 42.353675,-71.172026 42.354044,-71.17239 42.354358,-71.171794 42.354971,-71.170511 42.354855,-71.17112 42.354238,-71.17166 42.353675))", True) == pytest.approx(11314.85973843611, rel=1e-5)
    assert value("st_angle", "LINESTRING(0 0,1 0)", "LINESTRING(0 0,0 1)") == pytest.approx(3 * math.pi / 2)


def test_transformations(value):
    assert value.text("st_boundary", "LINESTRING(1 1,0 0,-1 1)") == "MULTIPOINT(1 1,-1 1)"
    assert value.text("st_boundary", "POINT(1 1)") == "GEOMETRYCOLLECTION EMPTY"
    assert value.text("st_convexhull", "LINESTRING(-72.126 42.45,-72.124 42.45666,-72.123 42.1546)") == "POLYGON((-72.123 42.1546,-72.126 42.45,-72.124 42.45666,-72.123 42.1546))"
    assert value.text("st_simplify", "LINESTRING(0 0,0 10,0 51,50 20,30 20,7 32)", 2.0) == "LINESTRING(0 0,0 51,50 20,30 20,7 32)"
    assert value.text("st_snaptogrid", "LINESTRING(1.1115678 2.123,4.111111 3.2374897,4.11112 3.23748667)", 0.001) == "LINESTRING(1.112 2.123,4.111 3.237)"
    assert value.text("st_closestpoint", SQUARE, "POINT(20 5)") == "POINT(10 5)"
    assert value.text("st_intersection", SQUARE, "POLYGON((5 5,5 15,15 15,15 5,5 5))") == "POLYGON((5 5,5 10,10 10,10 5,5 5))"
    assert value.text("st_intersection", "MULTIPOINT(1 1,20 20)", SQUARE) == "POINT(1 1)" and value.text("st_difference", "MULTIPOINT(1 1,20 20)", SQUARE) == "POINT(20 20)"
    assert value.text("st_boundingbox", "LINESTRING(1 2,3 0)") == "POLYGON((1 0,1 2,3 2,3 0,1 0))"
    assert value.text("st_makeline", "LINESTRING(0 0,1 1)", "POINT(1 1)") == "LINESTRING(0 0,1 1)"


def test_closest_point_inside_of_an_area(value):
    assert value.text("st_closestpoint", SQUARE, "POINT(4 5)") == "POINT(4 5)" and value.text("st_closestpoint", "POINT(4 5)", SQUARE) == "POINT(4 5)"
    assert value.text("st_closestpoint", SQUARE, "LINESTRING(4 5,30 5)") == "POINT(4 5)"
    assert value.text("st_closestpoint", SQUARE, "POLYGON((2 2,2 4,4 4,4 2,2 2))") == "POINT(2 2)" and value.text("st_closestpoint", "POLYGON((2 2,2 4,4 4,4 2,2 2))", SQUARE) == "POINT(2 2)"
    assert value.text("st_closestpoint", "POLYGON((0 0,0 10,10 10,10 0,0 0),(2 2,8 2,8 8,2 8,2 2))", "POINT(3 5)") == "POINT(2 5)"


PAIRS = [
    (SQUARE, "POINT(5 5)", "contains covers intersects"),
    (SQUARE, "POINT(0 5)", "covers intersects touches"),
    (SQUARE, "POINT(11 5)", "disjoint"),
    (SQUARE, "POLYGON((2 2,2 4,4 4,4 2,2 2))", "contains covers intersects"),
    (SQUARE, "POLYGON((10 0,10 10,20 10,20 0,10 0))", "intersects touches"),
    (SQUARE, "POLYGON((5 5,5 15,15 15,15 5,5 5))", "intersects"),
    (SQUARE, "POLYGON((0 10,10 10,10 0,0 0,0 10))", "contains within covers coveredby intersects equals"),
    (HOLED, "POINT(30 30)", "disjoint"),
    (HOLED, "POLYGON((20 20,50 20,50 40,20 40,20 20))", "intersects touches"),
    ("LINESTRING(0 0,5 5)", "POINT(5 5)", "covers intersects touches"),
    ("LINESTRING(0 0,5 5)", "LINESTRING(0 5,5 0)", "intersects"),
    ("LINESTRING(0 0,5 5)", "LINESTRING(5 5,9 0)", "intersects touches"),
    (SQUARE, "LINESTRING(0 0,0 10)", "covers intersects touches"),
    (SQUARE, "LINESTRING(-5 5,5 5)", "intersects"),
]


def test_predicates(spark):
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(PAIRS)], "i int, a string, b string")
    G.register(spark, "st_geogfromtext")
    df = df.selectExpr("i", "st_geogfromtext(a) AS a", "st_geogfromtext(b) AS b").cache()
    for name in ("contains", "within", "covers", "coveredby", "intersects", "disjoint", "touches", "equals"):
        found = {r.i: r.r for r in df.select("i", G.call(f"st_{name}", F.col("a"), F.col("b")).alias("r")).collect()}
        for i, (a, b, true) in enumerate(PAIRS):
            assert found[i] == (name in true.split()), (name, a, b)


def test_mixed_srids_raise(value):
    with pytest.raises(Exception):  # noqa: B017
        value("st_intersects", "SRID=4269;POINT(1 1)", "POINT(1 1)")
