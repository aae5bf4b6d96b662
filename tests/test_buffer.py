"""Buffers against distances of places drawn at random, closed forms and known areas."""

import math
import random

import pytest
from pyspark.sql import functions as F

from geomere.functions import geography
from geomere.operators.buffer import buffer, style

from test_arrangement import _area, _geo, _inside, _plain, _shapes

#: Of a polygon of 4 n sides in a circle of radius 1.
disc = lambda n: 2 * n * math.sin(math.pi / (2 * n))


def _line(ring):
    return (2, 4326, 0, [(2, [[(float(x), float(y), None, None) for x, y in ring]])])


def _buffered(spark, rows, params="", schema="i long, g {0}, r double"):
    from geomere.functions.shape import GEO

    df = spark.createDataFrame(rows, schema.format(GEO))
    return {x["i"]: _plain(x["b"]) for x in buffer(df, "g", F.col("r"), params, "b").collect()}


def _off(p, g):
    """The distance of a place from the edges of a geography."""
    best = math.inf
    for _, rings in g[3]:
        for ring in rings:
            for a, b in zip(ring, ring[1:]):
                dx, dy = b[0] - a[0], b[1] - a[1]
                t = max(0, min(1, ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / (dx * dx + dy * dy)))
                best = min(best, math.hypot(p[0] - a[0] - t * dx, p[1] - a[1] - t * dy))
    return best


def test_round_buffers_hold_what_is_near(spark):
    r = random.Random(5)
    shapes = _shapes(11, 30)
    for _ in range(20):
        at = [(round(r.uniform(-5, 5), 1), round(r.uniform(-5, 5), 1))]
        while len(at) < 6:
            p = (round(r.uniform(-5, 5), 1), round(r.uniform(-5, 5), 1))
            if p != at[-1]:
                at.append(p)
        shapes.append(_line(at))
    rows = [(i, g, r.choice([0.3, 1.0, 2.0] + [-0.3, -1.0] * (g[0] != 2))) for i, g in enumerate(shapes)]
    found = _buffered(spark, rows)
    shrink = math.cos(math.pi / 32)  # chords of arcs lie inside of the circle by this
    asked = 0
    for i, g, size in rows:
        for _ in range(150):
            p = (r.uniform(-9, 13), r.uniform(-9, 13))
            near, in_ = _off(p, g), g[0] != 2 and _inside(*p, g)
            if abs(size) * shrink * 0.999 < near < abs(size) * 1.001:
                continue
            asked += 1
            true = (in_ or near < size) if size > 0 else (in_ and near > -size)
            assert _inside(*p, found[i]) == true, (i, size, p)
    assert asked > 5000


def test_joins_and_caps_have_their_areas(spark):
    box = _geo([[[(0, 0), (0, 4), (6, 4), (6, 0), (0, 0)]]], 3)
    bent = _line([(0, 0), (6, 0), (6, 4)])  # turns left: the join is outside, the inner corner is covered twice
    for params, n, corners, caps, join in (
        ("", 8, disc(8), disc(8), disc(8) / 4),
        ("quad_segs=2", 2, disc(2), disc(2), disc(2) / 4),
        ("join=bevel endcap=flat", 8, 2, 0, 0.5),
        ("join=mitre endcap=square", 8, 4, 4, 1),
        ("join=mitre mitre_limit=1.2 endcap=butt", 8, None, 0, None),
    ):
        found = _buffered(spark, [(0, box, 1.0), (1, bent, 1.0), (2, box, -1.0), (3, box, -2.0), (4, bent, -1.0), (5, box, 0.0), (6, None, 1.0), (7, box, None)], params)
        if corners is None:  # a corner cut off at 1.2 along its bisector, whose tip is at the root of 2
            corners = 4 * (1 - (math.sqrt(2) - 1.2) ** 2)
            join = corners / 4
        assert _area(found[0]) == pytest.approx(24 + 20 + corners, abs=1e-6), params
        assert _area(found[1]) == pytest.approx(20 - 1 + join + caps, abs=1e-6), params
        assert _area(found[2]) == pytest.approx(8) and found[3][3] == [] and found[4][3] == [] and _area(found[5]) == 24
        assert found[6] is None and found[7] is None


def test_single_sides_points_and_rings(spark):
    bent = _line([(0, 0), (6, 0), (6, 4)])
    assert _area(_buffered(spark, [(0, bent, 1.0)], "side=left")[0]) == pytest.approx(9)
    assert _area(_buffered(spark, [(0, bent, 1.0)], "side=right join=mitre")[0]) == pytest.approx(11)
    ring = _line([(0, 0), (0, 4), (6, 4), (6, 0), (0, 0)])
    dots = (4, 4326, 0, [(1, [[(0.0, 0.0, None, None)]]), (1, [[(9.0, 0.0, None, None)]]), (1, [[(9.0, 0.0, None, None)]])])
    still = _line([(1, 1), (1, 1)])
    found = _buffered(spark, [(0, ring, 1.0), (1, dots, 1.0), (2, still, 2.0), (3, (1, 4326, 0, []), 1.0)])
    assert _area(found[0]) == pytest.approx(24 + 20 + disc(8) - 8) and len(found[0][3][0][1]) == 2
    assert _area(found[1]) == pytest.approx(2 * disc(8)) and len(found[1][3]) == 2
    assert _area(found[2]) == pytest.approx(4 * disc(8)) and found[3][3] == []
    assert _area(_buffered(spark, [(0, dots, 1.0)], "endcap=square")[0]) == pytest.approx(8)
    assert _buffered(spark, [(0, dots, 1.0)], "endcap=flat")[0][3] == []


def test_no_rows_other_columns_and_bad_words(spark):
    df = spark.createDataFrame([(1, 2, "LINESTRING(0 0,3 0)")], "side int, member int, t string").select("side", "member", geography(F.col("t")).alias("part"))
    (one,) = buffer(df, "part", 1.0, "endcap=flat", "g").collect()
    assert (one.side, one.member) == (1, 2) and _area(_plain(one.g)) == pytest.approx(6)
    assert buffer(df.where("side = 0"), "part", 1.0).collect() == []
    with pytest.raises(ValueError):
        buffer(df.withColumn("pid", F.lit(1)), "part", 1.0)
    for bad in ("join=soft", "join", "quad_segs=0", "colour=red"):
        with pytest.raises(ValueError):
            style(bad)
    assert style("quad_segs=2 join=miter endcap=butt miter_limit=3").join == "mitre"


# fixed values: results to match
KNOWN = [
    (
        "MULTIPOINT(100 10, 50 74)", 50.0, "quad_segs=2", 1e-9,
        "POLYGON((57 26.899494936611667,50 24,14.64466094067263 38.64466094067262,0 74,14.644660940672615 109.35533905932738,49.99999999999999 124,85.35533905932738 109.35533905932738,100 74,93 57.10050506338834,99.99999999999999 60,135.35533905932738 45.355339059327385,150 10,135.35533905932738 -25.35533905932737,100 -40,64.64466094067262 -25.355339059327378,50 9.999999999999995,57 26.899494936611667))",
    ),
    # edges far shorter than the radius
    (
        "LINESTRING(-72.1260 42.45, -72.1240 42.45666, -72.123 42.1546)", 50.0, "quad_segs=2", 1e-9,
        "POLYGON((-120.0113544840855 56.8372469322339,-98.99718594659981 84.62100366949721,-64.93842448326687 91.93764124020305,-34.36763455185338 75.23556889193843,-22.124273999646576 42.62218912004199,-22.123273999646585 42.32012912004199,-27.558809101318367 29.07371979011488,-24.236645515914496 28.076073067766096,-24.238645515914506 28.0694130677661,-31.746093077091306 18.86930081641101,-36.65080792441523 6.916501450946292,-44.0108344266051 3.839292783737402,-48.43313744844437 -1.580083626006122,-59.70390195223073 -2.721939487719954,-71.95747087995802 -7.845126000353417,-79.54419920471322 -4.731985896575468,-86.50658693223392 -5.437354484085496,-95.28775850969842 1.728230385142692,-107.36109854905372 6.682407924415237,-110.46934001411238 14.116658257132194,-116.15608362600614 18.75713744844437,-117.35427342430654 30.583949833690607,-122.12272600035342 41.989070879958014,-122.12372600035341 42.29113087995801,-118.54154468365384 42.30299005136987,-120.01335448408551 56.830586932233906,-120.0113544840855 56.8372469322339))",
    ),
]


@pytest.mark.parametrize("text, size, params, off, want", KNOWN)
def test_known_buffers(spark, text, size, params, off, want):
    df = spark.createDataFrame([(text, want)], "t string, w string").select(geography(F.col("t")).alias("g"), F.col("w"))
    (got,) = buffer(df, "g", size, params, "b").collect()
    corners = [tuple(map(float, p.split())) for p in want[len("POLYGON((") : -2].split(",")]
    assert _area(_plain(got.b)) == pytest.approx(abs(_area(_geo([[corners]]))), rel=off)
