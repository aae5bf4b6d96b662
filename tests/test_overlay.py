"""Intersection, difference and union: known shapes, and random ones against places drawn at random."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from geomere import functions as G

U = "POLYGON((0 0,0 10,2 10,2 2,8 2,8 10,10 10,10 0,0 0))"
SQUARE = "POLYGON((0 0,0 10,10 10,10 0,0 0))"
HOLED = "POLYGON((0 0,0 10,10 10,10 0,0 0),(2 2,8 2,8 8,2 8,2 2))"

KNOWN = [
    ("intersection", U, "POLYGON((-1 5,-1 6,11 6,11 5,-1 5))", "MULTIPOLYGON(((0 5,0 6,2 6,2 5,0 5)),((8 5,8 6,10 6,10 5,8 5)))"),
    ("difference", SQUARE, "POLYGON((2 2,2 8,8 8,8 2,2 2))", "POLYGON((0 0,0 10,10 10,10 0,0 0),(2 2,8 2,8 8,2 8,2 2))"),
    ("union", HOLED, "POLYGON((2 2,2 8,8 8,8 2,2 2))", "POLYGON((0 0,0 10,10 10,10 0,0 0))"),
    ("intersection", HOLED, "POLYGON((2 2,2 8,8 8,8 2,2 2))", "MULTILINESTRING((2 2,8 2),(8 2,8 8),(8 8,2 8),(2 8,2 2))"),
    ("intersection", SQUARE, "POLYGON((10 4,10 6,12 6,12 4,10 4))", "LINESTRING(10 6,10 4)"),
    ("intersection", SQUARE, "POLYGON((10 10,10 12,12 12,12 10,10 10))", "POINT(10 10)"),
    ("union", SQUARE, "POLYGON((10 10,10 12,12 12,12 10,10 10))", "MULTIPOLYGON(((0 0,0 10,10 10,10 0,0 0)),((10 10,10 12,12 12,12 10,10 10)))"),
    ("union", SQUARE, "POLYGON((5 5,5 15,15 15,15 5,5 5))", "POLYGON((0 0,0 10,5 10,5 15,15 15,15 5,10 5,10 0,0 0))"),
    ("difference", SQUARE, "POLYGON((4 -1,4 11,6 11,6 -1,4 -1))", "MULTIPOLYGON(((0 0,0 10,4 10,4 0,0 0)),((6 0,6 10,10 10,10 0,6 0)))"),
    ("difference", SQUARE, SQUARE, "POLYGON EMPTY"),
    ("difference", SQUARE, "LINESTRING(0 0,5 5)", SQUARE),
    ("intersection", "LINESTRING(0 0,10 10)", "LINESTRING(0 10,10 0)", "POINT(5 5)"),
    ("intersection", "LINESTRING(0 0,4 0,4 4)", "LINESTRING(4 4,4 0,9 0)", "LINESTRING(4 0,4 4)"),
    ("intersection", "LINESTRING(0 0,2 1,3 5)", SQUARE, "LINESTRING(0 0,2 1,3 5)"),
    ("intersection", SQUARE, "LINESTRING(-5 5,5 5,6 6)", "LINESTRING(0 5,5 5,6 6)"),
    ("intersection", "LINESTRING(-5 5,0 5,-5 6)", SQUARE, "POINT(0 5)"),
    ("intersection", "LINESTRING(-5 0,0 5,-5 9,-5 12,5 12,5 5)", SQUARE, "GEOMETRYCOLLECTION(LINESTRING(5 10,5 5),POINT(0 5))"),
    ("intersection", SQUARE, "MULTIPOINT(1 1,20 20)", "POINT(1 1)"),
    ("intersection", "LINESTRING(0 0,4 4)", "POINT(2 2)", "POINT(2 2)"),
    ("intersection", "LINESTRING(0 0,4 4)", "LINESTRING(9 9,8 8)", "LINESTRING EMPTY"),
    ("difference", "LINESTRING(-5 5,5 5,15 5)", SQUARE, "MULTILINESTRING((-5 5,0 5),(10 5,15 5))"),
    ("difference", "LINESTRING(0 0,9 0)", "POINT(3 0)", "LINESTRING(0 0,9 0)"),
    ("union", "LINESTRING(0 0,10 10)", "LINESTRING(0 10,10 0)", "MULTILINESTRING((0 0,5 5),(5 5,10 10),(0 10,5 5),(5 5,10 0))"),
    ("union", "LINESTRING(-5 5,5 5)", SQUARE, "GEOMETRYCOLLECTION(LINESTRING(-5 5,0 5),POLYGON((0 0,0 10,10 10,10 0,0 0)))"),
    ("union", "MULTIPOINT(1 1,20 20)", SQUARE, "GEOMETRYCOLLECTION(POINT(20 20),POLYGON((0 0,0 10,10 10,10 0,0 0)))"),
    ("union", "POINT(1 1)", "POINT(1 1)", "POINT(1 1)"),
    ("difference", "MULTIPOINT(1 1,20 20)", SQUARE, "POINT(20 20)"),
    ("intersection", "POINT(30 30)", SQUARE, "POINT EMPTY"),
]


def _run(spark, op, pairs):
    G.register(spark, "st_geogfromtext")
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string").selectExpr("i", "st_geogfromtext(a) AS a", "st_geogfromtext(b) AS b")
    return {r.i: r.r for r in df.select("i", G.call("st_astext", G.call(f"st_{op}_any", F.col("a"), F.col("b"))).alias("r")).collect()}


def _rings(wkt):
    """The rings of all areas of a text; areas come last in a collection."""
    areas = wkt[wkt.index("POLYGON") :] if "POLYGON" in wkt else ""
    return [[tuple(map(float, p.split())) for p in ring.split(",")] for ring in re.findall(r"\(([^()]+)\)", areas)]


def _inside(x, y, rings):
    return sum((a[1] > y) != (b[1] > y) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0] for r in rings for a, b in zip(r, r[1:], strict=False)) % 2 == 1


def _wkt(rings):
    return "POLYGON(" + ",".join("(" + ",".join(f"{x!r} {y!r}" for x, y in [*r, r[0]]) + ")" for r in rings) + ")"


def _shape(r):
    """A star of random radii around a place, sometimes with a hole, on whole degrees or not; or a staircase of whole degrees."""
    cx, cy = r.uniform(-3, 3), r.uniform(-3, 3)
    if r.random() < 0.35:
        heights = [r.randint(1, 5) for _ in range(r.randint(1, 5))]
        x0, y0 = r.randint(-4, 0), r.randint(-4, 0)
        top = [(x0 + i + d, y0 + h) for i, h in enumerate(heights) for d in (0, 1)]
        kept = [p for i, p in enumerate(top) if not (0 < i < len(top) - 1 and top[i - 1][1] == p[1] == top[i + 1][1])]
        return _wkt([[(x0, y0), *kept, (x0 + len(heights), y0)]])
    n = r.randint(3, 9)
    star = lambda size: [(cx + size * k * math.cos(2 * math.pi * i / n), cy + size * k * math.sin(2 * math.pi * i / n)) for i in range(n) for k in [r.uniform(0.4, 1)]]
    shell = star(r.uniform(2, 5))
    rings = [shell]
    if r.random() < 0.4:
        rings.append([(cx + (x - cx) * 0.35, cy + (y - cy) * 0.35) for x, y in shell])
    return _wkt(rings)


TRUTH = {"intersection": lambda p, q: p and q, "difference": lambda p, q: p and not q, "union": lambda p, q: p or q}


EMPTY = {"union": [("POLYGON EMPTY", SQUARE, SQUARE), (SQUARE, "POINT EMPTY", SQUARE)], "difference": [("POLYGON EMPTY", SQUARE, "POLYGON EMPTY"), (SQUARE, "POINT EMPTY", SQUARE)], "intersection": [(None, SQUARE, None), ("POLYGON EMPTY", SQUARE, "POLYGON EMPTY")]}


@pytest.mark.parametrize("op", sorted(TRUTH))
def test_overlays(spark, op):
    r = random.Random(11)
    known = [k[1:] for k in KNOWN if k[0] == op] + EMPTY[op]
    pairs = [(_shape(r), _shape(r)) for _ in range(120)]
    found = _run(spark, op, [k[:2] for k in known] + pairs)
    assert [found[i] for i in range(len(known))] == [k[2] for k in known]
    for i, (a, b) in enumerate(pairs, len(known)):
        p, q, s = _rings(a), _rings(b), _rings(found[i])
        for _ in range(150):
            x, y = r.uniform(-8, 8), r.uniform(-8, 8)
            assert _inside(x, y, s) == TRUTH[op](_inside(x, y, p), _inside(x, y, q)), (op, a, b, found[i], x, y)
