"""The registered queries of the geospatial library and their plain-SQL equivalents."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import call, geography, register
from ..operators import arrangement
from ..operators.aggregates import centroid, extent
from ..operators.buffer import buffer
from ..operators.cluster import dbscan
from ..operators.hull import hull
from ..operators.joins import box_join, dwithin_join, nearest_join
from ..session import written
from . import tables as t

FLAGSHIP = "nearest_supplier"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _add(name: str, query: Callable[[SparkSession, str], DataFrame], oracle: str | None = None) -> None:
    QUERIES[name] = query
    if oracle:
        ORACLES[name] = f"{t.CTES} {oracle}"


def _sql(name: str, text: str, oracle: str | None = None) -> None:
    """A query in Spark SQL over the places; tables in braces."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        register(spark, *dict.fromkeys(re.findall(r"\bst_\w+", text)))
        used = {n: getattr(t, n)(spark, sf_dir) for n in set(re.findall(r"\{(\w+)\}", text))}
        return spark.sql(text, **used)

    _add(name, query, oracle)


# --- joins ------------------------------------------------------------------------------

def nearest_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each customer the nearest supplier."""
    left = t.customer_pt(spark, sf_dir).select("c_custkey", "lon", "lat")
    right = t.supplier_pt(spark, sf_dir).select("s_suppkey", F.col("lon").alias("r_lon"), F.col("lat").alias("r_lat"))
    return nearest_join(left, right, 1, "c_custkey", "s_suppkey").select("c_custkey", "s_suppkey", F.round(F.col("metres") / 1000, 3).alias("km"))


_PAIRS = f"SELECT c.c_custkey, s.s_suppkey, {t.HAV.format(a='c', b='s')} AS metres FROM customer_pt c, supplier_pt s"
_add(FLAGSHIP, nearest_supplier, f"SELECT c_custkey, s_suppkey, round(metres / 1000, 3) AS km FROM ({_PAIRS}) QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY metres, s_suppkey) = 1")


def dwithin_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each supplier the customers within 800 km. Places are paired once, with their numbers of customers."""
    left = t.customer_pt(spark, sf_dir).groupBy("lon", "lat").agg(F.count("*").alias("held"))
    right = t.supplier_pt(spark, sf_dir).select("s_suppkey", F.col("lon").alias("r_lon"), F.col("lat").alias("r_lat"))
    met = dwithin_join(left, right.select("r_lon", "r_lat").distinct(), 800_000.0)
    found = met.groupBy("r_lon", "r_lat").agg(F.sum("held").alias("n"), F.round(F.max("metres"), 2).alias("farthest"))
    return right.join(found, ["r_lon", "r_lat"]).select("s_suppkey", "n", "farthest")


_add("dwithin_join", dwithin_count, f"SELECT s_suppkey, count(*) AS n, round(max(metres), 2) AS farthest FROM ({_PAIRS}) WHERE metres <= 800000 GROUP BY s_suppkey")


def events_in_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events inside of each nation's box: a grid join, then ``st_contains``. The polygons are made before the join."""
    register(spark, "st_makepoint", "st_makebox", "st_contains")
    boxes = written(t.nation_box(spark, sf_dir).withColumn("g", F.expr(_BOX)), "boxes")
    events = t.event_pt(spark, sf_dir).select("event_id", *(F.col(c).alias(n) for n, c in (("r_xmin", "lon"), ("r_ymin", "lat"), ("r_xmax", "lon"), ("r_ymax", "lat"))))
    met = box_join(boxes, events, 4.0)
    return met.where(F.expr("st_contains(g, st_makepoint(r_xmin, r_ymin))")).groupBy("n_nationkey").agg(F.count("*").alias("n"), F.sum("event_id").alias("total"))


_BOX = "st_makebox(xmin, ymin, xmax, ymax)"
_add("contains_join", events_in_boxes, "SELECT n_nationkey, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS total FROM event_pt, nation_box WHERE lon > xmin AND lon < xmax AND lat > ymin AND lat < ymax GROUP BY n_nationkey")


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers clustered by density: three within 6 degrees."""
    return dbscan(t.supplier_pt(spark, sf_dir), 6 * 6371008.8, 3, "s_suppkey")


_NEAR = "near AS (SELECT a.s_suppkey AS a, b.s_suppkey AS b FROM supplier_pt a, supplier_pt b WHERE pow(a.lon - b.lon, 2) + pow(a.lat - b.lat, 2) <= 36)"
_add(
    "clusterdbscan",
    clusters,
    None,
)
ORACLES["clusterdbscan"] = t.CTES.replace("WITH ", "WITH RECURSIVE ") + f""", {_NEAR},
core AS (SELECT a FROM near WHERE (SELECT count(*) FROM supplier_pt) > 3 GROUP BY a HAVING count(*) >= 3),
link AS (SELECT n.a, n.b FROM near n JOIN core c ON n.a = c.a JOIN core d ON n.b = d.a),
reach AS (SELECT a, a AS b FROM core UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
root AS (SELECT a, min(b) AS root FROM reach GROUP BY a),
member AS (SELECT a, root FROM root UNION ALL SELECT n.a, min_by(r.root, r.a) FROM near n JOIN root r ON n.b = r.a WHERE n.a NOT IN (SELECT a FROM core) GROUP BY n.a),
number AS (SELECT root, CAST(row_number() OVER (ORDER BY root) - 1 AS INTEGER) AS cluster FROM (SELECT DISTINCT root FROM root))
SELECT s.s_suppkey, n.cluster FROM supplier_pt s LEFT JOIN member m ON s.s_suppkey = m.a LEFT JOIN number n ON m.root = n.root"""

# --- constructors, formatters, parsers --------------------------------------------------

_TEXT = "rtrim(rtrim(printf('%.2f', {0}), '0'), '.')"
_XY = f"{_TEXT.format('lon')} || '{{0}}' || {_TEXT.format('lat')}"
_sql("astext", "SELECT c_custkey, st_astext(st_makepoint(round(lon, 2), round(lat, 2))) AS wkt FROM {customer_pt}", f"SELECT c_custkey, 'POINT(' || {_XY.format(' ')} || ')' AS wkt FROM customer_pt")
_sql("asgeojson", "SELECT c_custkey, st_asgeojson(st_makepoint(round(lon, 2), round(lat, 2))) AS json FROM {customer_pt}", f"SELECT c_custkey, '{{\"type\":\"Point\",\"coordinates\":[' || {_XY.format(',')} || ']}}' AS json FROM customer_pt")
_sql("fromtext", "SELECT c_custkey, st_x(g) AS x, st_y(g) AS y FROM (SELECT c_custkey, st_geogfromtext(concat('SRID=4326;POINT (', lon, '  ', lat, ')')) AS g FROM {customer_pt})", "SELECT c_custkey, lon AS x, lat AS y FROM customer_pt")
_sql("fromgeojson", "SELECT c_custkey, st_x(g) AS x, st_y(g) AS y FROM (SELECT c_custkey, st_geogfromgeojson(concat('{{\"type\":\"Point\",\"coordinates\":[', lon, ',', lat, ']}}')) AS g FROM {customer_pt})".replace("{{", "{{").replace("}}", "}}"), "SELECT c_custkey, lon AS x, lat AS y FROM customer_pt")
_sql("wkb", "SELECT s_suppkey, hex(st_asewkb(st_geogfrombinary(unhex(concat('0101000000', IF(s_suppkey % 2 = 1, '000000000000F03F', '0000000000000000'), '0000000000000000'))))) AS ewkb, hex(st_aswkb(st_makepoint(s_suppkey % 2, 0))) AS wkb FROM {supplier_pt}", "SELECT s_suppkey, '0101000020E6100000' || CASE WHEN s_suppkey % 2 = 1 THEN '000000000000F03F' ELSE '0000000000000000' END || '0000000000000000' AS ewkb, '0101000000' || CASE WHEN s_suppkey % 2 = 1 THEN '000000000000F03F' ELSE '0000000000000000' END || '0000000000000000' AS wkb FROM supplier_pt")
_BASE = "'0123456789bcdefghjkmnpqrstuvwxyz'"
_BIT = "((CASE WHEN {b} % 2 = 0 THEN CAST(floor((lon + 180) / 360 * 8192) AS BIGINT) >> CAST(12 - {b} // 2 AS BIGINT) ELSE CAST(floor((lat + 90) / 180 * 4096) AS BIGINT) >> CAST(11 - {b} // 2 AS BIGINT) END) & 1)"
_LETTERS = " || ".join("substr(" + _BASE + ", CAST(" + " + ".join(f"{16 >> i} * {_BIT.format(b=5 * k + i)}" for i in range(5)) + " AS BIGINT) + 1, 1)" for k in range(5))
_sql("geohash", "SELECT c_custkey, st_geohash(st_makepoint(lon, lat), 5) AS hash FROM {customer_pt}", f"SELECT c_custkey, {_LETTERS} AS hash FROM customer_pt")
_sql(
    "fromgeohash",
    "SELECT c_custkey, st_x(p) AS x, st_y(p) AS y, st_npoints(g) AS n FROM (SELECT c_custkey, st_geogpointfromgeohash(h) AS p, st_geomfromgeohash(h) AS g FROM (SELECT c_custkey, st_geohash(st_makepoint(lon, lat), 5) AS h FROM {customer_pt}))",
    "SELECT c_custkey, (floor((lon + 180) / 360 * 8192) + 0.5) * 360 / 8192 - 180 AS x, (floor((lat + 90) / 180 * 4096) + 0.5) * 180 / 4096 - 90 AS y, 5 AS n FROM customer_pt",
)

# --- lines: orders of a customer in order of time ---------------------------------------

#: Orders without a date or key come last, as in SQL; a struct sorts them first.
_PATH = "SELECT o_custkey, st_makeline_list(transform(array_sort(collect_list(struct(isnull(o_orderdate), o_orderdate, isnull(o_orderkey), o_orderkey, lon, lat))), p -> named_struct('kind', 1, 'srid', 4326, 'flags', 0, 'parts', array(named_struct('kind', 1, 'rings', array(array(named_struct('x', p.lon, 'y', p.lat, 'z', CAST(NULL AS DOUBLE), 'm', CAST(NULL AS DOUBLE))))))))) AS g FROM {order_pt} GROUP BY o_custkey"
_STEPS = "steps AS (SELECT o_custkey, lon, lat, lag(lon) OVER w AS plon, lag(lat) OVER w AS plat, row_number() OVER w AS i, count(*) OVER (PARTITION BY o_custkey) AS n FROM order_pt WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))"
_LEG = t.HAV.replace("{a}.lon", "plon").replace("{a}.lat", "plat").replace("{b}.lon", "lon").replace("{b}.lat", "lat")
_sql("makeline_length", f"SELECT o_custkey, round(st_length(g), 2) AS metres, st_numpoints(g) AS n, st_npoints(g) AS places FROM ({_PATH})", f", {_STEPS} SELECT o_custkey, round(coalesce(sum({_LEG}), 0), 2) AS metres, CAST(count(*) AS INTEGER) AS n, CAST(count(*) AS INTEGER) AS places FROM steps GROUP BY o_custkey")
_sql(
    "line_ends",
    f"SELECT o_custkey, st_x(st_startpoint(g)) AS x0, st_y(st_startpoint(g)) AS y0, st_x(st_endpoint(g)) AS x1, st_y(st_endpoint(g)) AS y1, st_x(st_pointn(g, 2)) AS x2, st_isclosed(g) AS closed, st_geometrytype(g) AS kind, st_dimension(g) AS dimension FROM ({_PATH})",
    f", {_STEPS} SELECT o_custkey, max(CASE WHEN i = 1 THEN lon END) AS x0, max(CASE WHEN i = 1 THEN lat END) AS y0, max(CASE WHEN i = n THEN lon END) AS x1, max(CASE WHEN i = n THEN lat END) AS y1, max(CASE WHEN i = 2 THEN lon END) AS x2, max(CASE WHEN i = 1 THEN lon END) = max(CASE WHEN i = n THEN lon END) AND max(CASE WHEN i = 1 THEN lat END) = max(CASE WHEN i = n THEN lat END) AS closed, 'ST_LineString' AS kind, 1 AS dimension FROM steps GROUP BY o_custkey",
)
_sql(
    "line_envelope",
    f"SELECT o_custkey, e.parts[0].rings[0][0].x AS xmin, e.parts[0].rings[0][0].y AS ymin, st_npoints(e) AS n FROM (SELECT o_custkey, st_boundingbox(g) AS e FROM ({_PATH}))",
    ", s AS (SELECT o_custkey, min(lon) AS xmin, min(lat) AS ymin, max(lon) AS xmax, max(lat) AS ymax FROM order_pt GROUP BY o_custkey) SELECT o_custkey, xmin, ymin, CASE WHEN xmin = xmax AND ymin = ymax THEN 1 WHEN xmin = xmax OR ymin = ymax THEN 2 ELSE 5 END AS n FROM s",
)


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.customer_pt(spark, sf_dir).select("c_nationkey", call("st_makepoint", F.col("lon"), F.col("lat")).alias("g"))


def extents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The box of each nation's customers."""
    ring = F.col("e")["parts"][0]["rings"][0]
    found = extent(_customers(spark, sf_dir), ["c_nationkey"], "g", "e")
    return found.select("c_nationkey", *(ring[k][c].alias(n) for n, k, c in (("xmin", 0, "x"), ("ymin", 0, "y"), ("xmax", 2, "x"), ("ymax", 2, "y"))))


def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The centroid of the places of each nation's customers."""
    found = centroid(_customers(spark, sf_dir), ["c_nationkey"], "g", "p")
    return found.select("c_nationkey", *(F.round(call(f"st_{c}", F.col("p")), 6).alias(c) for c in "xy"))


_add("extent", extents, "SELECT c_nationkey, min(lon) AS xmin, min(lat) AS ymin, max(lon) AS xmax, max(lat) AS ymax FROM customer_pt GROUP BY c_nationkey")
_MEAN = [f"sum({v})" for v in ("cos(radians(lat)) * cos(radians(lon))", "cos(radians(lat)) * sin(radians(lon))", "sin(radians(lat))")]
_add("centroid", centroids, f"SELECT c_nationkey, round(degrees(atan2({_MEAN[1]}, {_MEAN[0]})), 6) AS x, round(degrees(atan2({_MEAN[2]}, sqrt(pow({_MEAN[0]}, 2) + pow({_MEAN[1]}, 2)))), 6) AS y FROM (SELECT DISTINCT c_nationkey, lon, lat FROM customer_pt) GROUP BY c_nationkey")

# --- measures of pairs ------------------------------------------------------------------

#: Every customer's place or box with its nation's.
_AT = "SELECT c_custkey, {0} FROM {{customer_pt}} JOIN (SELECT n_nationkey, xmin, ymin FROM {{nation_box}}) ON c_nationkey = n_nationkey"
_AT_SQL = "SELECT c_custkey, {0} FROM customer_pt b JOIN (SELECT n_nationkey, xmin AS lon, ymin AS lat FROM nation_box) a ON c_nationkey = n_nationkey"
_sql("distance", _AT.format("round(st_distance(st_makepoint(lon, lat), st_makepoint(xmin, ymin)), 3) AS metres"), _AT_SQL.format(f"round({t.HAV.format(a='b', b='a')}, 3) AS metres"))
_sql("dwithin", _AT.format("st_dwithin(st_makepoint(lon, lat), st_makepoint(xmin, ymin), 3000000) AS near"), _AT_SQL.format(f"{t.HAV.format(a='b', b='a')} <= 3000000 AS near"))

#: The inverse solution on the spheroid to the place (0, 0), in plain SQL: 40 steps for the difference in longitude, then the series.
_F = "(1 / 298.257223563)"
_SS, _CS = "sqrt(pow(sin({l}), 2) + pow(su * cos({l}), 2))", "(cu * cos({l}))"
_SA = f"(cu * sin({{l}}) / {_SS})"
_C = f"({_F} / 16 * (1 - pow({_SA}, 2)) * (4 + {_F} * (4 - 3 * (1 - pow({_SA}, 2)))))"
_STEP = f"l0 + (1 - {_C}) * {_F} * {_SA} * (atan2({_SS}, {_CS}) + {_C} * {_SS} * ({_CS} + {_C} * {_CS} * (2 * pow({_CS}, 2) - 1)))".replace("{l}", "lam")
_U2 = f"((1 - sa * sa) * (1 / pow(1 - {_F}, 2) - 1))"
_sql(
    "spheroid_measures",
    "SELECT s_suppkey, round(st_distance(st_makepoint(lon, lat), st_makepoint(0, 0), true), 4) AS metres, round(st_maxdistance(st_makepoint(lon, lat), st_makepoint(0, 0)), 4) AS most, round(st_azimuth(st_makepoint(lon, lat), st_makepoint(0, 0)), 9) AS bearing FROM {supplier_pt}",
    f""", u AS (SELECT s_suppkey, radians(-lon) AS l0, sin(atan((1 - {_F}) * tan(radians(lat)))) AS su, cos(atan((1 - {_F}) * tan(radians(lat)))) AS cu FROM supplier_pt),
steps AS (SELECT *, list_reduce(list_prepend(l0, list_transform(range(40), lambda i: CAST(i AS DOUBLE))), lambda lam, i: {_STEP}) AS lam FROM u),
ends AS (SELECT *, {_SS.replace("{l}", "lam")} AS ss, {_CS.replace("{l}", "lam")} AS cs, {_SA.replace("{l}", "lam")} AS sa, atan2(sin(lam), -su * cos(lam)) AS az FROM steps),
series AS (SELECT *, 1 + {_U2} / 16384 * (4096 + {_U2} * (-768 + {_U2} * (320 - 175 * {_U2}))) AS big, {_U2} / 1024 * (256 + {_U2} * (-128 + {_U2} * (74 - 47 * {_U2}))) AS small FROM ends),
far AS (SELECT s_suppkey, az, round(6378137 * (1 - {_F}) * big * (atan2(ss, cs) - small * ss * (cs + small / 4 * (cs * (2 * cs * cs - 1) - small / 6 * cs * (4 * ss * ss - 3) * (4 * cs * cs - 3)))), 4) AS metres FROM series)
SELECT s_suppkey, metres, metres AS most, round(CASE WHEN az > 0 THEN az WHEN az = 0 THEN pi() ELSE 2 * pi() + az END, 9) AS bearing FROM far""",
)
_ANGLE = "atan2(0 - lon, 0 - lat)"
_sql("angle", "SELECT c_custkey, round(st_angle(st_makepoint(lon, lat), st_makepoint(0, 0), st_makepoint(lon, lat), st_makepoint(lon, 85)), 9) AS angle FROM {customer_pt}", f"SELECT c_custkey, round(CASE WHEN lon = 0 AND lat = 0 THEN 0 WHEN d < 0 THEN d + 2 * pi() ELSE d END, 9) AS angle FROM (SELECT c_custkey, lon, lat, atan2(0, 85 - lat) - {_ANGLE} AS d FROM customer_pt)")


def _box_area(x0: str, y0: str, x1: str, y1: str) -> str:
    """Square metres of a box on the sphere, its sides great circles, in plain SQL: two triangles."""
    u = lambda x, y: (f"cos(radians({y})) * cos(radians({x}))", f"cos(radians({y})) * sin(radians({x}))", f"sin(radians({y}))")
    dot = lambda p, q: "(" + " + ".join(f"({i}) * ({j})" for i, j in zip(p, q, strict=True)) + ")"

    def triangle(p: tuple, q: tuple, r: tuple) -> str:
        cross = tuple(f"({q[i]}) * ({r[j]}) - ({q[j]}) * ({r[i]})" for i, j in ((1, 2), (2, 0), (0, 1)))
        return f"2 * atan2({dot(p, cross)}, 1 + {dot(p, q)} + {dot(q, r)} + {dot(r, p)})"

    a, b, c, d = u(x0, y0), u(x0, y1), u(x1, y1), u(x1, y0)
    return f"(abs({triangle(a, b, c)} + {triangle(a, c, d)}) * pow(6371008.771415059, 2))"


_side = lambda x0, y0, x1, y1: t.HAV.replace("{a}.lon", x0).replace("{a}.lat", y0).replace("{b}.lon", x1).replace("{b}.lat", y1)
_AROUND = " + ".join(_side(*e) for e in (("xmin", "ymin", "xmin", "ymax"), ("xmin", "ymax", "xmax", "ymax"), ("xmax", "ymax", "xmax", "ymin"), ("xmax", "ymin", "xmin", "ymin")))
_sql(
    "box_measures",
    "SELECT c_custkey, round(st_perimeter(g), 3) AS around, round(st_area(g) / 1e6, 3) AS km2, st_npoints(st_boundary(g)) AS n, st_isring(st_boundary(g)) AS ring FROM (SELECT c_custkey, " + _BOX + " AS g FROM {customer_box})",
    f"SELECT c_custkey, round({_AROUND}, 3) AS around, round({_box_area('xmin', 'ymin', 'xmax', 'ymax')} / 1e6, 3) AS km2, 5 AS n, true AS ring FROM customer_box",
)
_sql("snaptogrid", "SELECT c_custkey, st_x(g) AS x, st_y(g) AS y FROM (SELECT c_custkey, st_snaptogrid(st_makepoint(lon, lat), 0.25) AS g FROM {customer_pt})", "SELECT c_custkey, round_even(lon / 0.25, 0) * 0.25 AS x, round_even(lat / 0.25, 0) * 0.25 AS y FROM customer_pt")

# --- predicates on boxes ----------------------------------------------------------------

_BOTH = "SELECT c_custkey, {0} FROM (SELECT c_custkey, c_nationkey, " + _BOX + " AS a FROM {{customer_box}}) JOIN (SELECT n_nationkey, " + _BOX + " AS b FROM {{nation_box}}) ON c_nationkey = n_nationkey"
_BOTH_SQL = "SELECT c_custkey, {0} FROM customer_box a JOIN nation_box b ON c_nationkey = n_nationkey"
_MEET = "a.xmin <= b.xmax AND b.xmin <= a.xmax AND a.ymin <= b.ymax AND b.ymin <= a.ymax"
_INNER = "a.xmin < b.xmax AND b.xmin < a.xmax AND a.ymin < b.ymax AND b.ymin < a.ymax"
_HOLDS = "a.xmin <= b.xmin AND a.xmax >= b.xmax AND a.ymin <= b.ymin AND a.ymax >= b.ymax"
_HELD = "b.xmin <= a.xmin AND b.xmax >= a.xmax AND b.ymin <= a.ymin AND b.ymax >= a.ymax"
for _name, _truth in (
    ("intersects", _MEET),
    ("disjoint", f"NOT ({_MEET})"),
    ("covers", _HOLDS),
    ("contains", _HOLDS),
    ("within", _HELD),
    ("coveredby", _HELD),
    ("touches", f"{_MEET} AND NOT ({_INNER})"),
    ("equals", f"{_HOLDS} AND {_HELD}"),
):
    _sql(_name, _BOTH.format(f"st_{_name}(a, b) AS holds"), _BOTH_SQL.format(f"({_truth}) AS holds"))
_SHARED = _box_area("greatest(a.xmin, b.xmin)", "greatest(a.ymin, b.ymin)", "least(a.xmax, b.xmax)", "least(a.ymax, b.ymax)")
_sql("intersection", _BOTH.format("round(st_area(st_intersection(a, b)) / 1e6, 3) AS km2"), _BOTH_SQL.format(f"round(CASE WHEN {_INNER} THEN {_SHARED} ELSE 0 END / 1e6, 3) AS km2"))
_sql(
    "closestpoint",
    "SELECT c_custkey, n_nationkey, round(st_x(p), 6) AS x, round(st_y(p), 6) AS y FROM (SELECT c_custkey, n_nationkey, st_closestpoint(" + _BOX + ", st_makepoint(lon, lat)) AS p FROM {customer_pt} JOIN {nation_box} ON c_nationkey = n_nationkey)",
    "SELECT c_custkey, n_nationkey, round(least(xmax, greatest(xmin, lon)), 6) AS x, round(least(ymax, greatest(ymin, lat)), 6) AS y FROM customer_pt JOIN nation_box ON c_nationkey = n_nationkey",
)
#: Corners of a hull are as many as its sides: pairs of places that have all others on one side, or between them. Places are whole
#: degrees here, as hundredths have no exact doubles and three on one line would be up to rounding.
_WHOLE = _PATH.replace("{order_pt}", "(SELECT o_custkey, o_orderdate, o_orderkey, floor(lon) AS lon, floor(lat) AS lat FROM {order_pt})")
_CROSS = "(q.x - p.x) * (r.y - p.y) - (q.y - p.y) * (r.x - p.x)"
_sql(
    "convexhull",
    f"SELECT o_custkey, st_npoints(st_convexhull(g)) AS n, st_geometrytype(st_convexhull(g)) AS kind FROM ({_WHOLE})",
    f""", place AS (SELECT DISTINCT o_custkey, CAST(floor(lon) AS BIGINT) AS x, CAST(floor(lat) AS BIGINT) AS y FROM order_pt),
side AS (SELECT p.o_custkey FROM place p JOIN place q ON p.o_custkey = q.o_custkey AND (p.x <> q.x OR p.y <> q.y) JOIN place r ON p.o_custkey = r.o_custkey GROUP BY p.o_custkey, p.x, p.y, q.x, q.y
  HAVING bool_and({_CROSS} < 0 OR ({_CROSS} = 0 AND (r.x - p.x) * (r.x - q.x) + (r.y - p.y) * (r.y - q.y) <= 0))),
corners AS (SELECT o_custkey, count(*) AS n FROM side GROUP BY o_custkey)
SELECT o_custkey, CAST(CASE WHEN n IS NULL THEN 1 WHEN n = 2 THEN 2 ELSE n + 1 END AS INTEGER) AS n, CASE WHEN n IS NULL THEN 'ST_Point' WHEN n = 2 THEN 'ST_LineString' ELSE 'ST_Polygon' END AS kind FROM (SELECT DISTINCT o_custkey FROM place) LEFT JOIN corners USING (o_custkey)""",
)
def hull_corners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corners of the hull of each nation's customers, in whole degrees."""
    placed = t.customer_pt(spark, sf_dir).select("c_nationkey", call("st_makepoint", F.floor("lon").cast("double"), F.floor("lat").cast("double")).alias("g"))
    ring = F.col("hull.parts")[0]["rings"][0]
    return hull(placed, ["c_nationkey"], "g").select("c_nationkey", F.explode(F.array_distinct(ring)).alias("p")).select("c_nationkey", "p.x", "p.y")


_add(
    "hull_of_groups",
    hull_corners,
    f""", place AS (SELECT DISTINCT c_nationkey, floor(lon) AS x, floor(lat) AS y FROM customer_pt),
side AS (SELECT p.c_nationkey, p.x, p.y FROM place p JOIN place q ON p.c_nationkey = q.c_nationkey AND (p.x <> q.x OR p.y <> q.y) JOIN place r ON p.c_nationkey = r.c_nationkey GROUP BY p.c_nationkey, p.x, p.y, q.x, q.y
  HAVING bool_and({_CROSS} < 0 OR ({_CROSS} = 0 AND (r.x - p.x) * (r.x - q.x) + (r.y - p.y) * (r.y - q.y) <= 0)))
SELECT DISTINCT c_nationkey, x, y FROM side UNION SELECT c_nationkey, min(x), min(y) FROM place GROUP BY c_nationkey HAVING count(*) = 1""",
)
_sql("simplify", f"SELECT o_custkey, st_npoints(st_simplify(g, 5.0)) AS n, st_numpoints(g) AS before FROM ({_PATH})")
_sql(
    "buffer",
    "SELECT s_suppkey, st_npoints(b) AS n, round(st_x(st_pointn(st_boundary(b), 1)), 6) AS x, round(st_y(st_pointn(st_boundary(b), 9)), 6) AS y FROM (SELECT s_suppkey, st_buffer(st_makepoint(lon, lat), 2) AS b FROM {supplier_pt})",
    "SELECT s_suppkey, 33 AS n, round(lon + 2, 6) AS x, round(lat - 2, 6) AS y FROM supplier_pt",
)
_sql(
    "sets_of_points",
    "SELECT s_suppkey, st_numgeometries(st_union(a, b)) AS both, st_isempty(st_intersection(a, b)) AS apart, st_iscollection(st_union(a, b)) AS multi, size(st_dump(st_union(a, b))) AS n, st_equals(st_difference(a, b), a) AS kept FROM (SELECT s_suppkey, st_makepoint(lon, lat) AS a, st_makepoint(lon, IF(s_suppkey % 3 = 0, lat, 85)) AS b FROM {supplier_pt})",
    "SELECT s_suppkey, CASE WHEN same THEN 1 ELSE 2 END AS both, NOT same AS apart, NOT same AS multi, CASE WHEN same THEN 1 ELSE 2 END AS n, NOT same AS kept FROM (SELECT s_suppkey, s_suppkey % 3 = 0 OR lat = 85 AS same FROM supplier_pt)",
)

# --- overlays of shapes as Spark jobs ---------------------------------------------------

#: Of a geography of areas on whole degrees: square degrees, length of all borders, parts.
_NET = "aggregate(g.parts, 0D, (s, p) -> s + aggregate(p.rings, 0D, (t, r) -> t + aggregate(arrays_zip(r, slice(r, 2, size(r))), 0D, (u, e) -> u + coalesce((e['1'].x - e.r.x) * (e['1'].y + e.r.y) / 2, 0D))))"
_ROUND = "aggregate(g.parts, 0D, (s, p) -> s + aggregate(p.rings, 0D, (t, r) -> t + aggregate(arrays_zip(r, slice(r, 2, size(r))), 0D, (u, e) -> u + coalesce(abs(e['1'].x - e.r.x) + abs(e['1'].y - e.r.y), 0D))))"
_MEASURED = [f"round({_NET}, 6) AS area", f"round({_ROUND}, 6) AS around", "size(g.parts) AS parts"]


def _measured(df: DataFrame, *by: str) -> DataFrame:
    return df.select(*by, "g").selectExpr(*by, *_MEASURED)


def _shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's shape with its nation's."""
    return t.customer_shape(spark, sf_dir).join(t.nation_shape(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))


def overlaid(op: str) -> Callable[[SparkSession, str], DataFrame]:
    """An overlay of each customer's shape with its nation's."""
    return lambda spark, sf_dir: _measured(arrangement.overlay(_shapes(spark, sf_dir), "a", "b", op, "g"), "c_custkey")


#: Cells (k, x, y) measured: their number, the sides that no neighbour has, and the parts that share sides.
_CELLS = """, own AS ({0}),
side AS (SELECT o.k, count(*) AS n FROM own o, (VALUES (1, 0), (-1, 0), (0, 1), (0, -1)) d(i, j) WHERE NOT EXISTS (SELECT 1 FROM own p WHERE p.k = o.k AND p.x = o.x + d.i AND p.y = o.y + d.j) GROUP BY o.k),
reach AS (SELECT k, x, y, x AS u, y AS v FROM own UNION SELECT r.k, r.x, r.y, o.x, o.y FROM reach r JOIN own o ON r.k = o.k AND abs(r.u - o.x) + abs(r.v - o.y) = 1),
part AS (SELECT k, count(DISTINCT first) AS n FROM (SELECT k, x, y, min(u * 1000 + v) AS first FROM reach GROUP BY k, x, y) GROUP BY k)
SELECT {1}, CAST(coalesce(m.n, 0) AS DOUBLE) AS area, CAST(coalesce(s.n, 0) AS DOUBLE) AS around, CAST(coalesce(p.n, 0) AS INTEGER) AS parts FROM {2} LEFT JOIN (SELECT k, count(*) AS n FROM own GROUP BY k) m ON m.k = {3} LEFT JOIN side s ON s.k = {3} LEFT JOIN part p ON p.k = {3}"""
_A = "SELECT c_custkey AS k, x, y FROM customer_cell"
_B = "SELECT c_custkey AS k, x, y FROM customer JOIN nation_cell ON c_nationkey = n_nationkey"
for _name, _set in (("intersection", f"{_A} INTERSECT {_B}"), ("union", f"{_A} UNION {_B}"), ("difference", f"{_A} EXCEPT {_B}")):
    QUERIES[f"overlay_{_name}"] = overlaid(_name)
    ORACLES[f"overlay_{_name}"] = t.CTES.replace("WITH ", "WITH RECURSIVE ") + _CELLS.format(_set, "c_custkey", "customer", "c_custkey")


def dissolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shapes of each nation's customers as one."""
    return _measured(arrangement.dissolve(t.customer_shape(spark, sf_dir), ["c_nationkey"], "a", "g"), "c_nationkey")


QUERIES["dissolve"] = dissolved
ORACLES["dissolve"] = t.CTES.replace("WITH ", "WITH RECURSIVE ") + _CELLS.format("SELECT DISTINCT c_nationkey AS k, x, y FROM customer_cell", "c_nationkey", "(SELECT DISTINCT c_nationkey FROM customer)", "c_nationkey")


def buffered_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's shape, grown by a degree or, every third, shrunk by one, with mitres."""
    radius = F.when(F.col("c_custkey") % 3 == 0, -1.0).otherwise(1.0)
    return _measured(buffer(t.customer_shape(spark, sf_dir), "a", radius, "join=mitre", "g"), "c_custkey")


#: A cell is in the grown shape if any of the nine around it is in the shape, in the shrunk one if all are.
_NINE = f"SELECT k, x, y FROM (SELECT a.k, a.x + d.i AS x, a.y + e.j AS y FROM ({_A}) a, (VALUES (-1), (0), (1)) d(i), (VALUES (-1), (0), (1)) e(j)) GROUP BY k, x, y HAVING k % 3 <> 0 OR count(*) = 9"
QUERIES["buffer_areas"] = buffered_areas
ORACLES["buffer_areas"] = t.CTES.replace("WITH ", "WITH RECURSIVE ") + _CELLS.format(_NINE, "c_custkey", "customer", "c_custkey")


def buffered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lower and right side of each customer's box as a line of half a degree to either side, with round ends."""
    line = geography(F.expr("concat('LINESTRING(', xmin, ' ', ymin, ',', xmax, ' ', ymin, ',', xmax, ' ', ymax, ')')"))
    made = buffer(t.customer_box(spark, sf_dir).select("c_custkey", line.alias("a")), "a", 0.5, "", "g")
    return made.select("c_custkey", "g").selectExpr("c_custkey", f"round({_NET}, 4) AS area", "size(g.parts) AS parts")


#: Two strips, less the inner corner that both cover; a quarter of a disc of 32 corners at the turn, half of one at each end.
_add("buffer_lines", buffered_lines, "SELECT c_custkey, round(xmax - xmin + ymax - ymin - 0.25 + 1.25 * 0.25 * 16 * sin(pi() / 16), 4) AS area, 1 AS parts FROM customer_box")


def related(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each customer's shape lies to its nation's: all predicates from one arrangement."""
    return arrangement.relate(_shapes(spark, sf_dir), "a", "b").select("c_custkey", *arrangement.RELATIONS)


_add(
    "relate",
    related,
    f""", a AS ({_A}), b AS ({_B}),
n AS (SELECT c_custkey AS k, (SELECT count(*) FROM a WHERE a.k = c_custkey) AS a, (SELECT count(*) FROM b WHERE b.k = c_custkey) AS b, (SELECT count(*) FROM a JOIN b USING (k, x, y) WHERE k = c_custkey) AS shared,
  EXISTS (SELECT 1 FROM a JOIN b USING (k) WHERE k = c_custkey AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1) AS met FROM customer)
SELECT k AS c_custkey, met AS intersects, NOT met AS disjoint, b = shared AS covers, a = shared AS coveredby, b = shared AS contains, a = shared AS within, met AND shared = 0 AS touches, a = shared AND b = shared AS equals, shared > 0 AND a > shared AND b > shared AS overlaps FROM n""",
)


def located(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events inside and on the borders of each nation's shape."""
    events = t.event_pt(spark, sf_dir).select("event_id", "lon", "lat")
    found = arrangement.locate(events, "event_id", t.nation_shape(spark, sf_dir), "n_nationkey", "b")
    return found.groupBy("n_nationkey").agg(*(F.count(F.when(F.col("place") == k, 1)).alias(n) for k, n in ((2, "inside"), (1, "border"))), F.sum("event_id").alias("total"))


_CLOSED = "lon BETWEEN xmin AND xmax AND lat BETWEEN ymin AND ymax AND NOT (lon > xmin + 1 AND lon < xmin + 2 AND lat > ymin + 1 AND lat < ymin + 3) AND NOT (lon > xmax - 1 AND lat > ymin + 1 AND lat < ymin + 2)"
_OPEN = "lon > xmin AND lon < xmax AND lat > ymin AND lat < ymax AND NOT (lon BETWEEN xmin + 1 AND xmin + 2 AND lat BETWEEN ymin + 1 AND ymin + 3) AND NOT (lon >= xmax - 1 AND lat BETWEEN ymin + 1 AND ymin + 2)"
_add("locate", located, f"SELECT n_nationkey, count(*) FILTER ({_OPEN}) AS inside, count(*) FILTER (NOT ({_OPEN})) AS border, CAST(sum(event_id) AS BIGINT) AS total FROM event_pt, nation_box WHERE {_CLOSED} GROUP BY n_nationkey")
