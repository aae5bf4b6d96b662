"""Spatial joins, clustering, components, sources and streams against brute force."""

import math
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from geomere.functions import call
from geomere.operators.cluster import dbscan
from geomere.operators.components import components
from geomere.operators.joins import box_join, dwithin_join
from geomere.sources.geography import read_wkb, write_wkb
from geomere.streaming.geofence import counts, inside_boxes

R = 6371008.771415059


def _metres(a, b):
    (x, y), (u, v) = ([math.radians(c) for c in p] for p in (a, b))
    d = u - x
    return R * math.atan2(math.hypot(math.cos(v) * math.sin(d), math.cos(y) * math.sin(v) - math.sin(y) * math.cos(v) * math.cos(d)), math.sin(y) * math.sin(v) + math.cos(y) * math.cos(v) * math.cos(d))


def test_dwithin_join_at_poles_and_date_line(spark):
    r = random.Random(1)
    place = lambda: (r.choice([r.uniform(-180, 180), r.uniform(-180, -179.5), r.uniform(179.5, 180), 180.0, -180.0]), r.choice([r.uniform(-90, 90), r.uniform(88, 90), -90.0, 90.0, r.uniform(-90, -89)]))
    left, right = [(i, *place()) for i in range(150)], [(i, *place()) for i in range(150)]
    a, b = spark.createDataFrame(left, "a int, lon double, lat double"), spark.createDataFrame(right, "b int, r_lon double, r_lat double")
    for metres in (20_000.0, 500_000.0, 5_000_000.0, 30_000_000.0):
        found = sorted((x.a, x.b) for x in dwithin_join(a, b, metres).collect())
        assert found == sorted((i, j) for i, *p in left for j, *q in right if _metres(p, q) <= metres)


def test_box_join_gives_each_pair_once(spark):
    r = random.Random(2)
    boxes = [(i, x := r.uniform(-10, 10), y := r.uniform(-10, 10), x + r.uniform(0, 6), y + r.uniform(0, 6)) for i in range(80)]
    a = spark.createDataFrame(boxes, "a int, xmin double, ymin double, xmax double, ymax double")
    b = spark.createDataFrame(boxes, "b int, r_xmin double, r_ymin double, r_xmax double, r_ymax double")
    found = sorted((x.a, x.b) for x in box_join(a, b, 2.0).select("a", "b").collect())
    assert found == sorted((p[0], q[0]) for p in boxes for q in boxes if p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4])


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(6, 40)] + [(1, 2), (2, 1), (7, 7)]
    found = {x.node: x.root for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found[i] == 100 for i in range(100, 161)) and all(found[i] == 5 for i in range(5, 40)) and found[2] == found[1] == 1


def test_dbscan(spark):
    r = random.Random(3)
    rows = [(i, r.gauss(c, 0.3), r.gauss(c, 0.3)) for i, c in enumerate([0, 5, 10] * 40)] + [(500, 50.0, 50.0), (501, None, 1.0)]
    found = {x.id: x.cluster for x in dbscan(spark.createDataFrame(rows, "id long, lon double, lat double"), 0.8 * 6371008.8, 4).collect()}
    near = lambda p, q: (p[1] - q[1]) ** 2 + (p[2] - q[2]) ** 2 <= 0.64
    core = [p for p in rows[:-1] if sum(near(p, q) for q in rows[:-1]) >= 4]
    assert found[500] is None and found[501] is None and {found[p[0]] for p in core} == {0, 1, 2}
    assert all(found[p[0]] == found[q[0]] for p in core for q in core if near(p, q))
    assert dbscan(spark.createDataFrame([], "id long, lon double, lat double"), 1.0, 1).count() == 0


def test_geographies_in_parquet(spark):
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp") + "/t"
    df = spark.createDataFrame([(1, "POINT(1 2)"), (2, "LINESTRING(0 0,3 4)")], "i int, t string").select("i", call("st_geogfromtext", F.col("t")).alias("g"))
    write_wkb(df, folder, "g")
    back = read_wkb(spark, folder, "g")
    assert {(r.i, r.t, r.xmax, r.ymax) for r in back.select("i", call("st_astext", F.col("g")).alias("t"), "xmax", "ymax").collect()} == {(1, "POINT(1 2)", 1.0, 2.0), (2, "LINESTRING(0 0,3 4)", 3.0, 4.0)}


def test_geofence_stream(spark):
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    rows = [(i, float(i % 20), 1.0, f"2024-01-01 00:{i:02d}:00") for i in range(40)]
    points = spark.createDataFrame(rows, "id int, lon double, lat double, t string").withColumn("ts", F.to_timestamp("t"))
    points.write.parquet(f"{folder}/in")
    boxes = spark.createDataFrame([("a", 0.0, 0.0, 4.0, 2.0), ("b", 3.0, 0.0, 9.0, 2.0)], "box string, xmin double, ymin double, xmax double, ymax double")
    stream = spark.readStream.schema(points.schema).parquet(f"{folder}/in")
    out = counts(inside_boxes(stream, boxes, 5.0), "box", "ts", "1 hour", "10 minutes")
    query = out.writeStream.format("memory").queryName("fenced").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", f"{folder}/state").start()
    query.awaitTermination(120)
    assert {(r.box, r["count"]) for r in spark.table("fenced").collect()} == {("a", 10), ("b", 14)}


def _dbscan(rows, eps, least):
    """Clusters by their definition, over all pairs; numbered by their least core."""
    placed = [r for r in rows if r[1] is not None]
    if len(placed) <= least:
        return {r[0]: None for r in rows}
    near = {p[0]: [q[0] for q in placed if (p[1] - q[1]) ** 2 + (p[2] - q[2]) ** 2 <= eps * eps] for p in placed}
    core = {i for i, n in near.items() if len(n) >= max(least, 1)}
    root = {}
    for i in sorted(core):
        todo = [i]
        while todo:
            j = todo.pop()
            if j not in root:
                root[j] = i
                todo += [q for q in near[j] if q in core]
    number = {r: k for k, r in enumerate(sorted(set(root.values())))}
    border = {i: root[min(q for q in near[i] if q in core)] for i in near if i not in core and any(q in core for q in near[i])}
    return {r[0]: number.get(root.get(r[0], border.get(r[0]))) for r in rows}


def test_dbscan_is_brute_force(spark):
    r = random.Random(8)
    sets = [
        [(i, r.uniform(0, 10), r.uniform(0, 10)) for i in range(150)] + [(900, None, 1.0)],
        [(i, r.gauss(r.choice([0, 3]), 0.2), r.gauss(0, 0.2)) for i in range(120)] + [(200 + i, 5.0, 5.0) for i in range(6)] + [(300, 5.6, 5.0)],
        [(i, float(i), 0.0) for i in range(3)],
    ]
    for rows in sets:
        df = spark.createDataFrame(rows, "id long, lon double, lat double")
        for eps, least in ((0.7, 4), (1.2, 3), (0.0, 2), (1.0, 0)):
            assert {x.id: x.cluster for x in dbscan(df, eps * 6371008.8, least).collect()} == _dbscan(rows, eps, least), (eps, least)


def test_dense_cells_are_linked_by_sub_cells(spark, monkeypatch):
    from geomere.operators import cluster

    r = random.Random(12)
    blob = lambda k, n, x, y, s: [(k + i, r.gauss(x, s), r.gauss(y, s)) for i in range(n)]
    sets = [
        blob(0, 90, 0.0, 0.0, 0.15) + blob(100, 90, 1.4, 0.0, 0.15) + blob(200, 40, 0.7, 1.5, 0.3) + [(900, None, 1.0)],
        # two columns whose places are the radius apart, or a little more
        [(i, 0.0, 0.01 * i) for i in range(60)] + [(100 + i, 1.0, 0.01 * i) for i in range(60)],
        [(i, 0.0, 0.01 * i) for i in range(60)] + [(100 + i, 1.0000001, 0.01 * i) for i in range(60)],
        # one place that holds a third of all rows
        [(i, 0.25, 0.25) for i in range(60)] + blob(100, 120, 0.6, 0.6, 0.8),
    ]
    rows = [(1000 * k + i, x, y if y is None else y + 20.0 * k) for k, own in enumerate(sets) for i, x, y in own]
    monkeypatch.setattr(cluster, "FEW", 0)
    df = spark.createDataFrame(rows, "id long, lon double, lat double")
    assert {x.id: x.cluster for x in dbscan(df, 6371008.8, 4).collect()} == _dbscan(rows, 1.0, 4)


def test_dense_cells_make_no_quadratic_pairs(spark, monkeypatch):
    from geomere.operators import cluster

    made = {}
    keep = cluster.written

    def counted(df, name):
        out = keep(df, name)
        made[name] = max(made.get(name, 0), out.count())
        return out

    monkeypatch.setattr(cluster, "written", counted)
    # two crowds in cells side by side, too far apart to be neighbours, and a crowd that joins the second
    n = 20_000
    df = spark.range(3 * n).selectExpr("id", f"CASE WHEN id < {n} THEN 0 WHEN id < {2 * n} THEN 1.3 ELSE 1.9 END + (id * 7919 % 1000) / 10000 AS lon", "(id * 104729 % 997) / 10000 AS lat")
    found = {(r.cluster, r["count"]) for r in dbscan(df, 6371008.8, 5).groupBy("cluster").count().collect()}
    assert found == {(0, n), (1, 2 * n)} and max(made.values()) <= 3 * n


def test_nearest_join_is_whole(spark):
    from geomere.operators.joins import nearest_join

    r = random.Random(4)
    place = lambda: (r.choice([r.uniform(-180, 180), r.gauss(10, 0.1), 180.0]), r.choice([r.uniform(-90, 90), r.gauss(50, 0.1), -90.0]))
    left, right = [(i, *place()) for i in range(120)], [(i, *place()) for i in range(90)]
    left_df = spark.createDataFrame([*left, (500, None, 1.0)], "a int, lon double, lat double")
    for k, others in ((1, right), (5, right), (3, right[:2])):
        found = {(x.a, x["rank"]): x.metres for x in nearest_join(left_df, spark.createDataFrame(others, "b int, r_lon double, r_lat double"), k, "a", "b").collect()}
        want = {(i, n + 1): d for i, *p in left for n, d in enumerate(sorted(_metres(p, q) for _, *q in others)[:k])}
        assert found == pytest.approx(want, abs=1e-4)


def test_nearest_join_under_skew_makes_few_pairs(spark):
    from geomere.operators.joins import FEW, _candidates, _vector, nearest_join

    r = random.Random(8)
    # left rows far from a dense cluster, a third of all on one place, and right rows on one place
    left = [(i, r.gauss(-100, 0.5), r.gauss(40, 0.5)) for i in range(1200)] + [(i, 30.0, 10.0) for i in range(1200, 1800)]
    right = [(i, r.gauss(80, 0.01), r.gauss(-30, 0.01)) for i in range(2000)] + [(i, 30.0, 10.0) for i in range(2000, 3000)]
    a, b = spark.createDataFrame(left, "a int, lon double, lat double"), spark.createDataFrame(right, "b int, r_lon double, r_lat double")
    found = {(x.a, x["rank"]): (x.b, x.metres) for x in nearest_join(a, b, 3, "a", "b").collect()}
    assert len(found) == 3 * 1800
    for i, *p in r.sample(left, 60):
        want = sorted((_metres(p, q), j) for j, *q in right)[:3]
        if p == [30.0, 10.0]:
            assert [found[i, n][0] for n in (1, 2, 3)] == [2000, 2001, 2002]
        assert [found[i, n][1] for n in (1, 2, 3)] == pytest.approx([d for d, _ in want], abs=1e-4)
    asked = a.select(F.col("a").alias("_row"), *(v.alias(n) for n, v in _vector(F.col("lon"), F.col("lat")).items()))
    placed = b.where("b < 2003").withColumns(_vector(F.col("r_lon"), F.col("r_lat")))
    assert _candidates(asked, placed, 3)[2] <= FEW * len(left)
    none = b.where("b < 0")
    assert nearest_join(a, none, 3, "a", "b").count() == 0 == nearest_join(a.where("a < 0"), b, 3, "a", "b").count()


def test_hulls_of_groups(spark):
    from geomere.functions import geography
    from geomere.operators.hull import hull

    r = random.Random(3)
    rows = [("a", f"POINT({r.randint(0, 40)} {r.randint(0, 40)})") for _ in range(3000)] + [("a", "LINESTRING(-5 0,50 60)")]
    rows += [(None, f"POINT({k} {k})") for k in range(9)] + [("b", "POINT(1 2)")] * 5 + [("c", None), ("d", "POINT EMPTY"), ("e", "MULTIPOINT(0 0,4 0,4 4,0 4,2 2,2 0)")]
    df = spark.createDataFrame(rows, "k string, t string").select("k", geography(F.col("t")).alias("g")).repartition(5)
    text = {x.k: x.t for x in hull(df, ["k"], "g").select("k", call("st_astext", F.col("hull")).alias("t")).collect()}
    assert text.pop("a").startswith("POLYGON((")
    assert text == {None: "LINESTRING(0 0,8 8)", "b": "POINT(1 2)", "c": None, "d": None, "e": "POLYGON((0 0,0 4,4 4,4 0,0 0))"}
    (a,) = hull(df.where("k = 'a'"), ["k"], "g").collect()
    ring = [(p.x, p.y) for p in a.hull.parts[0].rings[0]]
    turn = lambda p, q, s: (q[0] - p[0]) * (s[1] - p[1]) - (q[1] - p[1]) * (s[0] - p[0])
    places = [tuple(map(float, w[6:-1].split())) for k, w in rows[:3000]] + [(-5.0, 0.0), (50.0, 60.0)]
    assert all(turn(p, q, s) <= 0 for p, q in zip(ring, ring[1:]) for s in places) and all(turn(*ring[i : i + 3]) < 0 for i in range(len(ring) - 2)) and set(ring) <= set(places)
    assert hull(df.where("k = 'z'"), ["k"], "g").collect() == []


def test_box_join_of_large_and_small_boxes(spark):
    r = random.Random(6)
    boxes = [(i, x := r.uniform(-170, 0), y := r.uniform(-80, 0), x + (w := r.choice([0, 0.01, 3, 170])), y + min(80, w)) for i in range(90)]
    a = spark.createDataFrame(boxes, "a int, xmin double, ymin double, xmax double, ymax double")
    b = spark.createDataFrame(boxes, "b int, r_xmin double, r_ymin double, r_xmax double, r_ymax double")
    found = sorted((x.a, x.b) for x in box_join(a, b, 0.5).select("a", "b").collect())
    assert found == sorted((p[0], q[0]) for p in boxes for q in boxes if p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4])


def test_aggregates_of_groups(spark):
    from geomere.functions import geography
    from geomere.operators.aggregates import centroid, extent

    rows = [(1, "POINT(1 2)"), (1, "POINT(3 -4)"), (1, "POINT(3 -4)"), (2, "POINT(5 5)"), (3, None)]
    df = spark.createDataFrame(rows, "k int, t string").select("k", geography(F.col("t")).alias("g"))
    text = lambda d, c: {r.k: r.t for r in d.select("k", call("st_astext", F.col(c)).alias("t")).collect()}
    assert text(extent(df, ["k"], "g"), "extent") == {1: "POLYGON((1 -4,1 2,3 2,3 -4,1 -4))", 2: "POINT(5 5)", 3: None}
    near = {r.k: (round(r.x, 2), round(r.y, 2)) for r in centroid(df, ["k"], "g").selectExpr("k", "centroid.parts[0].rings[0][0].x AS x", "centroid.parts[0].rings[0][0].y AS y").collect()}
    assert near == {1: (2.0, -1.0), 2: (5.0, 5.0)}
    lines = spark.createDataFrame([(1, "LINESTRING(0 0,3 9)"), (1, "POINT(-1 2)")], "k int, t string").select("k", geography(F.col("t")).alias("g"))
    assert text(extent(lines, ["k"], "g"), "extent") == {1: "POLYGON((-1 0,-1 9,3 9,3 0,-1 0))"}


def test_rows_of_one_place_ask_once(spark, monkeypatch):
    from geomere.operators import joins

    asked, whole = [], joins._candidates
    monkeypatch.setattr(joins, "_candidates", lambda a, p, k: (asked.append(a.count()), whole(a, p, k))[1])
    left = spark.range(300).selectExpr("id AS a", "CAST(id % 3 AS DOUBLE) AS lon", "0D AS lat")
    right = spark.createDataFrame([(0, 0.1, 0.0), (1, 1.1, 0.0), (2, 2.1, 0.0)], "b int, r_lon double, r_lat double")
    found = joins.nearest_join(left, right, 1, "a", "b")
    assert sorted((r.a, r.b, r["rank"]) for r in found.collect()) == [(i, i % 3, 1) for i in range(300)] and asked == [3]
    assert found.columns == ["a", "lon", "lat", "b", "r_lon", "r_lat", "metres", "rank"]


def test_places_are_paired_once_and_customers_spread(spark, tmp_path, monkeypatch):
    from geomere.plans import catalog, tables

    spark.range(40).selectExpr("id % 4 + 144000 * (id DIV 4) AS c_custkey", "CAST(id % 3 AS INT) AS c_nationkey").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(20).selectExpr("id % 2 + 144000 * (id DIV 2) AS s_suppkey").write.parquet(f"{tmp_path}/supplier.parquet")
    sides, whole = [], catalog.dwithin_join
    monkeypatch.setattr(catalog, "dwithin_join", lambda a, b, m: (sides.append((a.count(), b.count())), whole(a, b, m))[1])
    found = catalog.dwithin_count(spark, str(tmp_path)).collect()
    assert len(found) == 20 and {r.n for r in found} == {40} and sides == [(4, 2)]
    assert tables.customer_box(spark, str(tmp_path)).rdd.getNumPartitions() >= 32


def test_boxes_have_their_predicates_by_comparison(spark):
    r = random.Random(5)
    box = lambda: (x := r.randint(0, 3), y := r.randint(0, 3), x + r.randint(1, 3), y + r.randint(1, 3))
    ways = ((0, 1, 2, 3), (0, 3, 2, 1), (2, 3, 0, 1), (1, 2, 3, 0))

    def text(b):
        corners = [(b[0], b[1]), (b[0], b[3]), (b[2], b[3]), (b[2], b[1])]
        way = r.choice(ways)
        return "POLYGON((" + ",".join(f"{corners[k][0]} {corners[k][1]}" for k in (*way, way[0])) + "))"

    pairs = [(box(), box()) for _ in range(60)]
    df = spark.createDataFrame([(i, text(a), text(b)) for i, (a, b) in enumerate(pairs)], "i int, ta string, tb string")
    shaped = df.select("i", call("st_geogfromtext", F.col("ta")).alias("a"), call("st_geogfromtext", F.col("tb")).alias("b"))
    names = ("intersects", "disjoint", "covers", "coveredby", "contains", "within", "touches", "equals")
    for row in shaped.select("i", *(call(f"st_{n}", F.col("a"), F.col("b")).alias(n) for n in names)).collect():
        a, b = pairs[row.i]
        meet = all(a[k] <= b[k + 2] and b[k] <= a[k + 2] for k in (0, 1))
        inner = all(a[k] < b[k + 2] and b[k] < a[k + 2] for k in (0, 1))
        holds, held = (all(p[k] <= q[k] and p[k + 2] >= q[k + 2] for k in (0, 1)) for p, q in ((a, b), (b, a)))
        assert [row[n] for n in names] == [meet, not meet, holds, held, holds, held, meet and not inner, a == b]
