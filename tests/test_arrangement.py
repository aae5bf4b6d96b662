"""Overlays, unions, relations and places as Spark jobs, against places drawn at random and by hand."""

import random

import pytest
from pyspark.sql import functions as F

from geomere.functions import geography
from geomere.operators import arrangement


def _geo(parts, kind=6):
    ring = lambda r: [(float(x), float(y), None, None) for x, y in r]
    return (kind, 4326, 0, [(3, [ring(r) for r in rings]) for rings in parts])


def _inside(x, y, g):
    """Whether a place is in an area; none is asked on a border."""
    n = 0
    for _, rings in g[3]:
        for r in rings:
            for a, b in zip(r, r[1:]):
                if (a[1] > y) != (b[1] > y) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0]:
                    n += 1
    return n % 2 == 1


def _plain(g):
    return None if g is None else (g.kind, g.srid, g.flags, [(p.kind, [[(q.x, q.y) for q in r] for r in p.rings]) for p in g.parts])


def _area(g):
    return -sum(a[0] * b[1] - b[0] * a[1] for _, rings in g[3] for r in rings for a, b in zip(r, r[1:])) / 2


def _star(r, cx, cy, size, n=9):
    """A concave polygon around a place, on tenths of degrees."""
    import math

    turns = sorted(r.uniform(0, 2 * math.pi) for _ in range(n))
    ring = [(round(cx + size * r.uniform(0.3, 1) * math.cos(t), 1), round(cy + size * r.uniform(0.3, 1) * math.sin(t), 1)) for t in turns]
    return [*ring, ring[0]]


def _simple(ring):
    def side(o, a, b):
        return (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])

    es = list(zip(ring, ring[1:]))
    if len(set(ring)) != len(es) or any(abs(side(ring[k - 1] if k else ring[-2], ring[k], ring[k + 1])) < 1e-9 for k in range(len(es))):
        return False
    for i, (a, b) in enumerate(es):
        for j in range(i + 2, len(es)):
            c, d = es[j]
            if (i, j) != (0, len(es) - 1) and side(a, b, c) * side(a, b, d) <= 0 and side(c, d, a) * side(c, d, b) <= 0:
                return False
    return True


def _shapes(seed, n):
    r, out = random.Random(seed), []
    box = lambda x, y, w, h: [(x, y), (x, y + h), (x + w, y + h), (x + w, y), (x, y)]
    while len(out) < n:
        kind = r.randrange(4)
        x, y = r.randint(-4, 4), r.randint(-4, 4)
        if kind == 0:
            out.append(_geo([[box(x, y, r.randint(1, 6), r.randint(1, 6))]]))
        elif kind == 1:  # a hole
            out.append(_geo([[box(x, y, 6, 5), box(x + 1, y + 1, r.randint(1, 4), 2)]]))
        elif kind == 2:  # two parts, turned either way
            out.append(_geo([[box(x, y, 2, 3)], [box(x + 3, y, 2, 3)[:: r.choice([1, -1])]]]))
        else:
            ring = _star(r, x, y, 5)
            if _simple(ring):
                out.append(_geo([[ring]], 3))
    return out


@pytest.fixture(scope="module")
def pairs(spark):
    a, b = _shapes(1, 60), _shapes(2, 60)
    rows = [(k, x, y) for k, (x, y) in enumerate(zip(a, b, strict=True))]
    rows += [(100 + k, x, x) for k, x in enumerate(a[:8])]
    from geomere.functions import GEO

    return rows, spark.createDataFrame(rows, f"id long, a {GEO}, b {GEO}").repartition(4)


OPS = {"intersection": lambda a, b: a and b, "union": lambda a, b: a or b, "difference": lambda a, b: a and not b, "symdifference": lambda a, b: a != b}


@pytest.mark.parametrize("op", OPS)
def test_overlays_hold_the_right_places(pairs, op):
    rows, df = pairs
    found = {r.id: _plain(r.result) for r in arrangement.overlay(df, "a", "b", op).select("id", "result").collect()}
    r = random.Random(5)
    assert len(found) == len(rows)
    for k, a, b in rows:
        for _ in range(150):
            x, y = r.uniform(-10, 12), r.uniform(-10, 12)
            assert _inside(x, y, found[k]) == OPS[op](_inside(x, y, a), _inside(x, y, b)), (op, k, x, y)
        for _, rings in found[k][3]:  # shells with the clock, holes against it, all closed
            turns = [-sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:])) > 0 for ring in rings]
            assert turns == [True] + [False] * (len(rings) - 1)
            assert all(ring[0] == ring[-1] and len(set(ring)) == len(ring) - 1 for ring in rings)


def test_areas_add_up(pairs):
    rows, df = pairs
    size = {op: {r.id: _area(_plain(r.result)) for r in arrangement.overlay(df, "a", "b", op).select("id", "result").collect()} for op in OPS}
    for k, a, b in rows:
        one, two = (abs(_area((0, 0, 0, [(3, [ring])]))) for ring in (a[3][0][1][0], b[3][0][1][0]))
        assert size["union"][k] == pytest.approx(size["intersection"][k] + size["symdifference"][k], abs=1e-6)
        assert size["difference"][k] + size["intersection"][k] == pytest.approx(size["union"][k] - (size["symdifference"][k] - size["difference"][k]), abs=1e-6)
        assert size["union"][k] >= max(0.0, one - 12, two - 12)
    assert all(size["difference"][k] == 0 and size["symdifference"][k] == 0 for k in size["union"] if k >= 100)


def test_relations(pairs):
    rows, df = pairs
    found = {r.id: r for r in arrangement.relate(df, "a", "b").collect()}
    size = {op: {r.id: _area(_plain(r.result)) for r in arrangement.overlay(df, "a", "b", op).select("id", "result").collect()} for op in ("intersection", "difference", "union")}
    for k, _, _ in rows:
        both, a_only, every = (size[op][k] > 1e-6 for op in ("intersection", "difference", "union"))
        b_only = size["union"][k] - size["difference"][k] - size["intersection"][k] > 1e-6
        r = found[k]
        assert (r.covers, r.coveredby, r.equals, r.overlaps) == (both and not b_only, both and not a_only, not a_only and not b_only, both and a_only and b_only)
        assert r.intersects == (both or r.touches) and r.disjoint == (not r.intersects) and every
    assert {(r.intersects, r.touches) for r in found.values()} >= {(True, False), (False, False), (True, True)}


CASES = [
    # squares that share a side, a corner, nothing; one in a hole that it fills; one around; crossing bars
    ("POLYGON((0 0,0 2,2 2,2 0,0 0))", "POLYGON((2 0,2 2,4 2,4 0,2 0))", 0, 8, True, 1),
    ("POLYGON((0 0,0 2,2 2,2 0,0 0))", "POLYGON((2 2,2 4,4 4,4 2,2 2))", 0, 8, True, 2),
    ("POLYGON((0 0,0 2,2 2,2 0,0 0))", "POLYGON((3 3,3 4,4 4,4 3,3 3))", 0, 5, False, 2),
    ("POLYGON((0 0,0 9,9 9,9 0,0 0),(3 3,6 3,6 6,3 6,3 3))", "POLYGON((3 3,3 6,6 6,6 3,3 3))", 0, 81, True, 1),
    ("POLYGON((0 0,0 9,9 9,9 0,0 0))", "POLYGON((3 3,3 6,6 6,6 3,3 3))", 9, 81, False, 1),
    ("POLYGON((0 4,0 5,9 5,9 4,0 4))", "POLYGON((4 0,4 9,5 9,5 0,4 0))", 1, 17, False, 1),
    ("MULTIPOLYGON(((0 4,0 5,9 5,9 4,0 4)),((0 6,0 7,9 7,9 6,0 6)))", "POLYGON((4 0,4 9,5 9,5 0,4 0))", 2, 25, False, 1),
    ("GEOMETRYCOLLECTION(POINT(1 1),LINESTRING(0 0,9 9),POLYGON((0 0,0 2,2 2,2 0,0 0)))", "POLYGON((1 1,1 3,3 3,3 1,1 1))", 1, 7, False, 1),
    ("LINESTRING(0 0,9 9)", "POLYGON((1 1,1 3,3 3,3 1,1 1))", 0, 4, False, 1),
]


def test_known_shapes(spark):
    df = spark.createDataFrame([(k, *c[:2]) for k, c in enumerate(CASES)], "id long, s string, t string").select("id", geography(F.col("s")).alias("a"), geography(F.col("t")).alias("b"))
    both, any_ = ({r.id: _plain(r.result) for r in arrangement.overlay(df, "a", "b", op).select("id", "result").collect()} for op in ("intersection", "union"))
    touch = {r.id: r.touches for r in arrangement.relate(df, "a", "b").collect()}
    for k, (_, _, shared, together, touches, parts) in enumerate(CASES):
        assert (_area(both[k]), _area(any_[k]), touch[k], len(any_[k][3])) == (pytest.approx(shared), pytest.approx(together), touches, parts), k


def test_nulls_and_empty_tables(spark):
    from geomere.functions import GEO

    g = _geo([[[(0, 0), (0, 2), (2, 2), (2, 0), (0, 0)]]])
    df = spark.createDataFrame([(1, g, None), (2, None, None), (3, (3, 4326, 0, []), g)], f"id long, a {GEO}, b {GEO}")
    found = {r.id: _plain(r.result) for r in arrangement.overlay(df, "a", "b", "union").collect()}
    assert found[1] is None and found[2] is None and _area(found[3]) == 4
    assert {r.id: r.intersects for r in arrangement.relate(df, "a", "b").collect()} == {1: None, 2: None, 3: False}
    assert arrangement.overlay(df.where("false"), "a", "b", "union").count() == 0
    with pytest.raises(ValueError):
        arrangement.overlay(df.withColumnRenamed("id", "pid"), "a", "b", "union")


def test_dissolve(spark):
    from geomere.functions import GEO

    box = lambda x, y, w, h: [(x, y), (x, y + h), (x + w, y + h), (x + w, y), (x, y)]
    r = random.Random(3)
    groups = {"tiles": [_geo([[box(i, j, 1, 1)]]) for i in range(6) for j in range(5) if (i, j) != (2, 2)], None: [_geo([[box(0, 0, 2, 2)]])] * 3 + [_geo([[box(1, 1, 2, 2)]])]}
    groups["random"] = [s for s in _shapes(9, 14)]
    groups["none"] = [(1, 4326, 0, [])]
    rows = [(k, g) for k, gs in groups.items() for g in gs] + [("random", None)]
    r.shuffle(rows)
    found = {x.k: _plain(x.result) for x in arrangement.dissolve(spark.createDataFrame(rows, f"k string, g {GEO}").repartition(3), ["k"], "g").collect()}
    assert _area(found["tiles"]) == pytest.approx(29) and [len(rings) for _, rings in found["tiles"][3]] == [2]
    assert _area(found[None]) == pytest.approx(7) and found["none"][3] == []
    for _ in range(400):
        x, y = r.uniform(-9, 11), r.uniform(-9, 11)
        assert _inside(x, y, found["random"]) == any(_inside(x, y, g) for g in groups["random"])


def test_locate(spark):
    from geomere.functions import GEO

    shapes = _shapes(11, 25)
    r = random.Random(8)
    places = [(k, r.uniform(-9, 11), r.uniform(-9, 11)) for k in range(800)] + [(1000 + k, *shapes[k][3][0][1][0][0][:2]) for k in range(25)] + [(2000, None, 1.0)]
    areas_, points = spark.createDataFrame(list(enumerate(shapes)), f"region int, g {GEO}"), spark.createDataFrame(places, "id long, lon double, lat double").repartition(3)
    found = {(x.id, x.region): x.place for x in arrangement.locate(points, "id", areas_, "region", "g").collect()}
    want = {(k, j) for k, x, y in places[:800] for j, g in enumerate(shapes) if _inside(x, y, g)}
    assert {p for p in found if p[0] < 1000} == want and all(found[p] == 2 for p in want)
    assert all(found[1000 + k, k] == 1 for k in range(25))
    assert arrangement.locate(points, "id", areas_.where("false"), "region", "g").count() == 0


def test_copies_are_one_problem(spark, monkeypatch):
    from geomere.operators.buffer import buffer

    seen, whole = [], arrangement.pieces
    monkeypatch.setattr(arrangement, "pieces", lambda rows: (seen.append(rows.count()), whole(rows))[1])
    text = lambda x: F.lit(f"POLYGON(({x} {x},{x} {x + 2},{x + 2} {x + 2},{x + 2} {x},{x} {x}))")
    pairs = spark.range(50).select("id", (F.col("id") % 2).alias("k"), geography(text(0)).alias("a"), F.when(F.col("id") != 49, geography(text(1))).alias("b"))
    over = arrangement.overlay(pairs, "a", "b", "union", "g").select("id", "g").collect()
    assert sorted(r.id for r in over) == list(range(50)) and {_area(r.g) for r in over if r.id != 49} == {7.0} and [r.g for r in over if r.id == 49] == [None]
    told = arrangement.relate(pairs, "a", "b").groupBy("overlaps").count().collect()
    assert sorted((r["overlaps"] is None, r["count"]) for r in told) == [(False, 49), (True, 1)]
    assert [_area(r.g) for r in arrangement.dissolve(pairs, ["k"], "a", "g").collect()] == [4.0, 4.0]
    grown = buffer(pairs, "a", 1.0, "join=mitre", "g").select("id", "g").collect()
    assert len(grown) == 50 and {round(_area(r.g), 6) for r in grown} == {16.0}
    # edges: of one pair and of the one whose b is null, twice; of one area in two groups; of one area with its four strips
    assert seen[:3] == [12, 12, 8] and seen[3] <= 40
