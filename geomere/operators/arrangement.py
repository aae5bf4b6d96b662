"""Overlays, unions and relations of areas as Spark jobs over tables of edges.

A job is many problems side by side, each with its number (``pid``): a pair of geographies, or a group to be united. Equal pairs are one problem. Areas become
rows of directed edges with their inside to the right. Edges are cut where they meet (noding), equal pieces of a problem are added
up, so that shared borders that run against each other cancel, and a ray from the middle of each piece tells
how many areas of either side lie to its left; with what it carries itself that gives its right. Pieces between
result and rest are joined to rings by successor joins and pointer doubling.

Who meets whom is found by bands of latitude, as many in each problem as keep its index below twice its edges, so
no problem is gathered in one task; only a ring, which is one value of the result, is.

Places are held as whole billionths of a degree (a tenth of a millimetre), so they are joined as numbers.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.shape import GEO, PARTS
from ..session import written
from .joins import box_join

#: Units of a degree.
UNIT = 10**9
#: Units that a place may be off an edge that it is on.
NEAR = 1.5
#: Bands of a problem, at most.
BANDS = 1_000_000


def edges(areas: DataFrame, keep: list[str], column: str) -> DataFrame:
    """``keep`` and ax, ay, bx, by (in units) of every edge of the areas of a geography, insides to the right; points and lines have none."""
    part = areas.select(*keep, F.posexplode(F.filter(F.col(column)["parts"], lambda p: p["kind"] == 3)).alias("_part", "_p"))
    ring = part.select(*keep, "_part", F.posexplode("_p.rings").alias("_ring", "_r"))
    n = F.size("_r")
    ends = F.arrays_zip(F.slice("_r", 1, F.greatest(n - 1, F.lit(0))).alias("a"), F.slice("_r", 2, F.greatest(n - 1, F.lit(0))).alias("b"))
    ring = ring.withColumn("_e", ends)
    signed = F.aggregate("_e", F.lit(0.0), lambda s, e: s + e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"])
    turned = ring.withColumn("_turn", (signed > 0) == (F.col("_ring") == 0))
    at = lambda end, axis: F.round(F.col(f"_s.{end}.{axis}") * UNIT).cast("long")
    one = turned.select(*keep, "_turn", F.explode("_e").alias("_s"))
    way = lambda p, q, axis: F.when(F.col("_turn"), at(q, axis)).otherwise(at(p, axis))
    out = one.select(*keep, way("a", "b", "x").alias("ax"), way("a", "b", "y").alias("ay"), way("b", "a", "x").alias("bx"), way("b", "a", "y").alias("by"))
    return out.where("ax <> bx OR ay <> by")


def _banded(rows: DataFrame, y0: str, y1: str, pad: int = 0) -> tuple[DataFrame, DataFrame]:
    """For each problem how its bands lie (pid, low, height), and the rows once for each band (band) that they, or places up to ``pad`` units off, reach."""
    low, high = F.least(y0, y1), F.greatest(y0, y1)
    sums = rows.groupBy("pid").agg(F.count("*").alias("n"), F.min(low).alias("low"), F.max(high).alias("high"), F.sum((high - low).cast("double")).alias("climb"))
    tall = (F.col("high") - F.col("low") + 1).cast("double")
    many = F.greatest(F.lit(1.0), F.least(F.lit(float(BANDS)), F.col("n") * tall / (F.col("climb") + 1)))
    index = sums.select("pid", "low", F.ceil(tall / many).alias("height"))
    band = lambda y: F.floor((y - F.col("low")) / F.col("height"))
    spread = rows.join(index, "pid").withColumn("band", F.explode(F.sequence(band(low - pad), band(high + pad))))
    return index, spread.drop("low", "height")


def _cross(ox: Column, oy: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return (ax - ox).cast("double") * (by - oy).cast("double") - (ay - oy).cast("double") * (bx - ox).cast("double")


def _places(e: str, f: str) -> Column:
    """Where two edges meet: an array of structs of on_e, on_f, x and y."""
    c = lambda n: F.col(n)
    ea, eb, fa, fb = ((c(f"{s}.{k}x"), c(f"{s}.{k}y")) for s, k in ((e, "a"), (e, "b"), (f, "a"), (f, "b")))

    def off(a: tuple, b: tuple, p: tuple) -> Column:
        return _cross(*a, *b, *p)

    def on(a: tuple, b: tuple, p: tuple) -> Column:
        dx, dy = (b[0] - a[0]).cast("double"), (b[1] - a[1]).cast("double")
        along = (p[0] - a[0]).cast("double") * dx + (p[1] - a[1]).cast("double") * dy
        size = dx * dx + dy * dy
        return (F.abs(off(a, b, p)) <= NEAR * F.sqrt(size)) & along.between(-NEAR * F.sqrt(size), size + NEAR * F.sqrt(size))

    touch = [(on(fa, fb, ea), ea), (on(fa, fb, eb), eb), (on(ea, eb, fa), fa), (on(ea, eb, fb), fb)]
    s1, s2, s3, s4 = off(ea, eb, fa), off(ea, eb, fb), off(fa, fb, ea), off(fa, fb, eb)
    t = s3 / (s3 - s4)
    across = (s1 * s2 < 0) & (s3 * s4 < 0) & ~(touch[0][0] | touch[1][0] | touch[2][0] | touch[3][0])
    x, y = (F.round(a + t * (b - a).cast("double")).cast("long") for a, b in zip(ea, eb, strict=True))
    spot = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    found = [F.when(test, spot(*p)) for test, p in touch] + [F.when(across, spot(x, y))]
    return F.array_compact(F.array(*found))


def _noded(rows: DataFrame) -> DataFrame:
    """The rows (pid, member, side, ax, ay, bx, by) cut where those of other members meet them."""
    edge = written(rows.withColumn("eid", F.monotonically_increasing_id()), "edges")
    index, spread = _banded(edge, "ay", "by", 2)
    ends = spread.select("pid", "band", F.struct("eid", "member", "ax", "ay", "bx", "by").alias("e"))
    other = ends.select("pid", "band", F.col("e").alias("f"))
    lower = lambda s, axis: F.least(F.col(f"{s}.a{axis}"), F.col(f"{s}.b{axis}"))
    upper = lambda s, axis: F.greatest(F.col(f"{s}.a{axis}"), F.col(f"{s}.b{axis}"))
    near = [lower(p, axis) <= upper(q, axis) + 2 for axis in "xy" for p, q in (("e", "f"), ("f", "e"))]
    pairs = ends.join(other, ["pid", "band"]).where((F.col("e.eid") < F.col("f.eid")) & (F.col("e.member") != F.col("f.member")) & near[0] & near[1] & near[2] & near[3])
    # a pair is looked at in the first band that both reach
    first = F.floor((F.greatest(lower("e", "y"), lower("f", "y")) - 2 - F.col("low")) / F.col("height"))
    pairs = pairs.join(index, "pid").where(F.col("band") == first).select("pid", "e", "f")
    met = pairs.withColumn("at", F.explode(_places("e", "f")))
    cuts = met.select(F.explode(F.array("e.eid", "f.eid")).alias("eid"), "at.x", "at.y").distinct()
    cuts = cuts.groupBy("eid").agg(F.collect_list(F.struct("x", "y")).alias("cuts"))
    whole = edge.join(cuts, "eid", "left")
    dx, dy = (F.col("bx") - F.col("ax")).cast("double"), (F.col("by") - F.col("ay")).cast("double")
    along = lambda p: F.struct(((p["x"] - F.col("ax")) * dx + (p["y"] - F.col("ay")) * dy).alias("t"), p["x"].alias("x"), p["y"].alias("y"))
    ends = F.array(F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")), F.struct(F.col("bx").alias("x"), F.col("by").alias("y")))
    size = dx * dx + dy * dy
    inner = F.filter(F.transform(F.coalesce("cuts", F.array().cast("array<struct<x: bigint, y: bigint>>")), along), lambda p: (p["t"] > 0) & (p["t"] < size))
    way = F.array_sort(F.array_distinct(F.concat(F.transform(ends, along), inner)))
    n = F.size("way")
    steps = F.arrays_zip(F.slice("way", 1, n - 1).alias("p"), F.slice("way", 2, n - 1).alias("q"))
    cut = whole.withColumn("way", way).select("pid", "side", F.explode(steps).alias("s"))
    return cut.select("pid", "side", F.col("s.p.x").alias("ax"), F.col("s.p.y").alias("ay"), F.col("s.q.x").alias("bx"), F.col("s.q.y").alias("by")).where("ax <> bx OR ay <> by")


def pieces(rows: DataFrame) -> DataFrame:
    """Each piece of border of a problem once, from its lesser place (lx, ly) to its greater (hx, hy).

    on_a and on_b: edges of side 0 and 1 that run along it; net_a and net_b: those with the piece less those against it;
    left_a and left_b: areas to its left. To the right there are net_a and net_b more. ``rows``: pid, member, side, ax, ay, bx, by.
    """
    cut = _noded(rows)
    ahead = (F.col("ax") < F.col("bx")) | ((F.col("ax") == F.col("bx")) & (F.col("ay") < F.col("by")))
    low, high = ({n: F.when(ahead, F.col(f"{p}{n}")).otherwise(F.col(f"{q}{n}")) for n in "xy"} for p, q in ("ab", "ba"))
    way = F.when(ahead, 1).otherwise(-1)
    of = lambda side, value: F.sum(F.when(F.col("side") == side, value).otherwise(0))
    cut = cut.select("pid", "side", low["x"].alias("lx"), low["y"].alias("ly"), high["x"].alias("hx"), high["y"].alias("hy"), way.alias("way"))
    names = {"on_a": of(0, F.lit(1)), "on_b": of(1, F.lit(1)), "net_a": of(0, F.col("way")), "net_b": of(1, F.col("way"))}
    once = written(cut.groupBy("pid", "lx", "ly", "hx", "hy").agg(*(v.alias(k) for k, v in names.items())).withColumn("sid", F.monotonically_increasing_id()), "pieces")
    east = _rays(once.select("pid", "sid", ((F.col("lx") + F.col("hx")) / 2).alias("mx"), ((F.col("ly") + F.col("hy")) / 2).alias("my")), once.where("ly <> hy AND (net_a <> 0 OR net_b <> 0)"), ["net_a", "net_b"])
    known = once.join(east, "sid", "left")
    right_is_east = F.col("ly") < F.col("hy")
    left = lambda n: (F.coalesce(F.col(f"ray_net_{n}"), F.lit(0)) - F.when(right_is_east, F.col(f"net_{n}")).otherwise(0)).alias(f"left_{n}")
    return known.select("pid", "sid", "lx", "ly", "hx", "hy", *names, left("a"), left("b"))


def _rays(middles: DataFrame, borders: DataFrame, sums: list[str]) -> DataFrame:
    """For each place (pid, sid, mx, my) the borders to its east, those downwards less those upwards: ray_ and each of ``sums``. A border of the same sid is left out."""
    index, spread = _banded(borders, "ly", "hy")
    asked = middles.join(index, "pid").withColumn("band", F.floor((F.col("my") - F.col("low")) / F.col("height"))).select("pid", "band", F.col("sid").alias("mid"), "mx", "my")
    met = asked.join(spread, ["pid", "band"]).where(F.col("mid") != F.col("sid"))
    x = F.col("lx") + (F.col("my") - F.col("ly")) * (F.col("hx") - F.col("lx")).cast("double") / (F.col("hy") - F.col("ly")).cast("double")
    met = met.where(((F.col("ly") > F.col("my")) != (F.col("hy") > F.col("my"))) & (x > F.col("mx")))
    sign = F.when(F.col("ly") > F.col("hy"), 1).otherwise(-1)
    return met.groupBy(F.col("mid").alias("sid")).agg(*(F.sum(sign * F.col(n)).alias(f"ray_{n}") for n in sums))


def _cycles(links: DataFrame) -> DataFrame:
    """sid and least (the least sid of its cycle) of every row (sid, next) of a permutation, by pointer doubling."""
    now = written(links.select("sid", "next", F.col("sid").alias("least")), "links")
    while True:
        ahead = now.select(F.col("sid").alias("at"), F.col("next").alias("then"), F.col("least").alias("other"))
        after = written(now.join(ahead, F.col("next") == F.col("at")).select("sid", F.col("then").alias("next"), F.least("least", "other").alias("least"), (F.col("other") < F.col("least")).alias("moved")), "links")
        if not after.where("moved").limit(1).count():  # windows that cover no cycle twice would still differ
            return after.select("sid", "least")
        now = after.select("sid", "next", "least")


def _loops(table: pa.Table) -> pa.Table:
    """The edges of one ring in order; a place that the ring meets again parts it in two."""
    ax, ay, bx, by = (table.column(n).to_pylist() for n in ("ax", "ay", "bx", "by"))
    follow = dict(zip(table.column("sid").to_pylist(), table.column("next").to_pylist(), strict=True))
    at = {s: k for k, s in enumerate(follow)}
    s, path, seen, out = min(follow), [], {}, []
    for _ in range(len(follow)):
        k = at[s]
        p = (ax[k], ay[k])
        if p in seen:
            first = seen[p]
            out.append(path[first:])
            for q in path[first:]:
                seen.pop(q, None)
            del path[first:]
        seen[p] = len(path)
        path.append(p)
        s = follow[s]
    out.append(path)
    out = [r for r in out if len(r) > 2]
    pid = table.column("pid")[0].as_py()
    return pa.table({"pid": pa.array([pid] * len(out), pa.int64()), "ring": pa.array([[{"x": x, "y": y} for x, y in [*r, r[0]]] for r in out], pa.list_(pa.struct([("x", pa.int64()), ("y", pa.int64())])))})


def areas(border: DataFrame) -> DataFrame:
    """pid and parts (the rings of areas, shells first) of the directed pieces (pid, ax, ay, bx, by) that bound them, insides to the right."""
    step = written(border.withColumn("sid", F.monotonically_increasing_id()), "border")
    onward = step.select("pid", F.col("ax").alias("bx"), F.col("ay").alias("by"), F.col("sid").alias("to"), F.col("bx").alias("cx"), F.col("by").alias("cy"))
    turn = F.pmod(F.atan2((F.col("cy") - F.col("by")).cast("double"), (F.col("cx") - F.col("bx")).cast("double")) - F.atan2((F.col("ay") - F.col("by")).cast("double"), (F.col("ax") - F.col("bx")).cast("double")) - 1e-12, F.lit(6.283185307179586))
    links = written(step.join(onward, ["pid", "bx", "by"]).groupBy("sid").agg(F.min_by("to", turn).alias("next")), "turns")
    ringed = step.join(links, "sid").join(_cycles(links), "sid")
    loops = ringed.select("pid", "least", "sid", "next", "ax", "ay", "bx", "by").groupBy("pid", "least").applyInArrow(_loops, "pid long, ring array<struct<x: long, y: long>>")
    n = F.size("ring")
    ends = F.arrays_zip(F.slice("ring", 1, n - 1).alias("a"), F.slice("ring", 2, n - 1).alias("b"))
    x0, y0 = F.col("ring")[0]["x"], F.col("ring")[0]["y"]
    signed = F.aggregate(ends, F.lit(0.0), lambda s, e: s + (e["a"]["x"] - x0).cast("double") * (e["b"]["y"] - y0).cast("double") - (e["b"]["x"] - x0).cast("double") * (e["a"]["y"] - y0).cast("double"))
    rings = written(loops.withColumn("signed", signed).where("signed <> 0").withColumn("rid", F.monotonically_increasing_id()), "rings")
    holes = rings.where("signed > 0")
    held = _held(holes, rings.where("signed < 0"))
    point = lambda p: F.struct((p["x"] / UNIT).alias("x"), (p["y"] / UNIT).alias("y"), F.lit(None).cast("double").alias("z"), F.lit(None).cast("double").alias("m"))
    of_shell = holes.join(held, "rid").groupBy("shell").agg(F.array_sort(F.collect_list(F.transform("ring", point))).alias("holes"))
    shells = rings.where("signed < 0").join(of_shell, F.col("rid") == F.col("shell"), "left")
    empty = F.array().cast("array<array<struct<x: double, y: double, z: double, m: double>>>")
    part = F.struct(F.lit(3).alias("kind"), F.concat(F.array(F.transform("ring", point)), F.coalesce("holes", empty)).alias("rings"))
    return shells.groupBy("pid").agg(F.array_sort(F.collect_list(part)).cast(PARTS).alias("parts"))


def _held(holes: DataFrame, shells: DataFrame) -> DataFrame:
    """rid of each hole with the least shell around it (shell)."""
    a, b = F.col("ring")[0], F.col("ring")[1]
    middles = holes.select("pid", F.col("rid").alias("sid"), ((a["x"] + b["x"]) / 2).alias("mx"), ((a["y"] + b["y"]) / 2).alias("my"))
    n = F.size("ring")
    sides = shells.select("pid", "rid", "signed", F.explode(F.arrays_zip(F.slice("ring", 1, n - 1).alias("a"), F.slice("ring", 2, n - 1).alias("b"))).alias("s"))
    sides = sides.select("pid", "rid", "signed", F.col("s.a.x").alias("lx"), F.col("s.a.y").alias("ly"), F.col("s.b.x").alias("hx"), F.col("s.b.y").alias("hy")).where("ly <> hy")
    index, spread = _banded(sides, "ly", "hy")
    asked = middles.join(index, "pid").withColumn("band", F.floor((F.col("my") - F.col("low")) / F.col("height"))).drop("low", "height")
    x = F.col("lx") + (F.col("my") - F.col("ly")) * (F.col("hx") - F.col("lx")).cast("double") / (F.col("hy") - F.col("ly")).cast("double")
    met = asked.join(spread, ["pid", "band"]).where(((F.col("ly") > F.col("my")) != (F.col("hy") > F.col("my"))) & (x > F.col("mx")))
    around = met.groupBy("sid", "rid").agg(F.count("*").alias("n"), F.max("signed").alias("signed")).where("n % 2 = 1")
    return around.groupBy(F.col("sid").alias("rid")).agg(F.max_by("rid", "signed").alias("shell"))


_OPS: dict[str, Callable[[Column, Column], Column]] = {"intersection": lambda a, b: a & b, "union": lambda a, b: a | b, "difference": lambda a, b: a & ~b, "symdifference": lambda a, b: a != b}


def bounding(found: DataFrame, op: str) -> DataFrame:
    """The directed pieces that bound the result of an operation on what :func:`pieces` has found."""
    inside = _OPS[op]
    left = inside(F.col("left_a") > 0, F.col("left_b") > 0)
    right = inside(F.col("left_a") + F.col("net_a") > 0, F.col("left_b") + F.col("net_b") > 0)
    kept = found.where(left != right).withColumn("ahead", right)
    way = lambda p, q, axis: F.when(F.col("ahead"), F.col(f"{p}{axis}")).otherwise(F.col(f"{q}{axis}"))
    return kept.select("pid", way("l", "h", "x").alias("ax"), way("l", "h", "y").alias("ay"), way("h", "l", "x").alias("bx"), way("h", "l", "y").alias("by"))


def _geography(parts: Column, srid: Column) -> Column:
    parts = F.coalesce(parts, F.array().cast(PARTS))
    return F.struct(F.when(F.size(parts) > 1, 6).otherwise(3).cast("int").alias("kind"), srid.alias("srid"), F.lit(0).alias("flags"), parts.alias("parts")).cast(GEO)


def numbered(rows: DataFrame, *columns: str) -> tuple[DataFrame, DataFrame]:
    """The rows with the number (pid) of what they hold in some columns, and that with its number once: rows that hold the same are one problem."""
    fresh = written(rows, "rows")
    once = written(fresh.select(*columns).distinct().withColumn("pid", F.monotonically_increasing_id()), "problems")
    same = F.lit(True)
    for c in columns:
        same &= F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    named = once.withColumnsRenamed({c: f"_of_{c}" for c in columns})
    return fresh.join(named, same).select(*rows.columns, "pid"), once


def _paired(pairs: DataFrame, a: str, b: str) -> tuple[DataFrame, DataFrame]:
    """The pairs with their numbers, and the edges of each problem."""
    fresh, once = numbered(pairs, a, b)
    sides = [edges(once, ["pid"], c).withColumn("member", F.lit(k)).withColumn("side", F.lit(k)) for k, c in enumerate((a, b))]
    return fresh, sides[0].unionByName(sides[1])


def overlay(pairs: DataFrame, a: str, b: str, op: str, name: str = "result") -> DataFrame:
    """``pairs`` with the areas that are in both (``intersection``), in either (``union``), in ``a`` alone (``difference``) or in one (``symdifference``).

    Geographies of any form: concave, with holes, in parts, collections; of those only the areas count. The result has what has an area;
    borders that merely touch leave an empty polygon. A null geography gives null.
    """
    _same(pairs, a, b)
    fresh, rows = _paired(pairs, a, b)
    made = written(areas(bounding(pieces(rows), op)), "made")
    joined = fresh.join(made, "pid", "left")
    known = F.col(a).isNotNull() & F.col(b).isNotNull()
    return joined.select(*pairs.columns, F.when(known, _geography(F.col("parts"), F.col(a)["srid"])).alias(name))


def _same(pairs: DataFrame, *columns: str) -> None:
    taken = {"pid", "parts"} & {c.lower() for c in pairs.columns}
    if taken:
        raise ValueError(f"columns may not be called {', '.join(sorted(taken))}")
    for c in columns:
        if "parts" not in pairs.schema[c].dataType.fieldNames():
            raise TypeError(f"{c} is no geography")


def overlay_join(left: DataFrame, right: DataFrame, op: str, a: str, b: str, size: float, name: str = "result") -> DataFrame:
    """:func:`overlay` of all pairs whose boxes meet, found by grid cells of ``size`` degrees. The columns of both sides must differ."""
    from ..sources.geography import with_box

    met = box_join(with_box(left, a, "_l_"), with_box(right, b, "_r_"), size, *(tuple(f"{p}{c}" for c in ("xmin", "ymin", "xmax", "ymax")) for p in ("_l_", "_r_")))
    return overlay(met.select(*left.columns, *right.columns), a, b, op, name)


def dissolve(df: DataFrame, by: list[str], column: str, name: str = "result") -> DataFrame:
    """``by`` and the union of all areas of each group. Rows without areas add nothing; a group of such rows has an empty polygon. Of equal areas of a group one takes part."""
    _same(df, column)
    groups = written(df.select(*by).distinct().withColumn("pid", F.monotonically_increasing_id()), "groups")
    same = F.lit(True)
    for c in by:
        same &= df[c].eqNullSafe(groups[c])
    parts = df.select(*by, column).join(groups, same).select("pid", F.explode(f"{column}.parts").alias("part"), F.col(f"{column}.srid").alias("srid"))
    members = written(parts.groupBy("pid", "part").agg(F.min("srid").alias("srid")).withColumn("member", F.monotonically_increasing_id()), "members")
    one = members.where("part.kind = 3").select("pid", "member", F.struct(F.array("part").alias("parts")).alias("g"))
    rows = edges(one, ["pid", "member"], "g").withColumn("side", F.lit(0))
    made = areas(bounding(pieces(rows), "union"))
    srid = members.groupBy("pid").agg(F.min("srid").alias("srid"))
    return groups.join(made, "pid", "left").join(srid, "pid", "left").select(*by, _geography(F.col("parts"), F.coalesce("srid", F.lit(4326))).alias(name))


RELATIONS = ("intersects", "disjoint", "covers", "coveredby", "contains", "within", "touches", "equals", "overlaps")


def relate(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """``pairs`` with a column for each of :data:`RELATIONS` of the areas of two geographies, all from one arrangement. Null geographies give nulls; without areas all but disjoint (and, if both have none, equals) are false."""
    _same(pairs, a, b)
    fresh, rows = _paired(pairs, a, b)
    found = written(pieces(rows), "related")
    in_a, in_b = (F.col("left_a") > 0, F.col("left_a") + F.col("net_a") > 0), (F.col("left_b") > 0, F.col("left_b") + F.col("net_b") > 0)
    either = lambda test: F.max(test(in_a[0], in_b[0]) | test(in_a[1], in_b[1]))
    sides = found.groupBy("pid").agg(either(lambda x, y: x & y).alias("both"), either(lambda x, y: x & ~y).alias("a_only"), either(lambda x, y: y & ~x).alias("b_only"))
    ends = found.select("pid", "on_a", "on_b", F.explode(F.array(F.struct(F.col("lx").alias("x"), F.col("ly").alias("y")), F.struct(F.col("hx").alias("x"), F.col("hy").alias("y")))).alias("at"))
    shared = ends.groupBy("pid", "at").agg(((F.max("on_a") > 0) & (F.max("on_b") > 0)).alias("shared")).where("shared").select("pid").distinct().withColumn("shared", F.lit(True))
    joined = fresh.join(written(sides.join(shared, "pid", "left"), "told"), "pid", "left")
    both, a_only, b_only, met = (F.coalesce(F.col(n), F.lit(False)) for n in ("both", "a_only", "b_only", "shared"))
    truth = {
        "intersects": both | met,
        "disjoint": ~(both | met),
        "covers": both & ~b_only,
        "coveredby": both & ~a_only,
        "contains": both & ~b_only,
        "within": both & ~a_only,
        "touches": met & ~both,
        "equals": ~a_only & ~b_only,
        "overlaps": both & a_only & b_only,
    }
    known = F.col(a).isNotNull() & F.col(b).isNotNull()
    return joined.select(*pairs.columns, *(F.when(known, v).alias(k) for k, v in truth.items()))


def locate(points: DataFrame, key: str, regions: DataFrame, region: str, column: str, xy: tuple[str, str] = ("lon", "lat"), size: float = 4.0) -> DataFrame:
    """``key``, ``region`` and place (2 inside, 1 on the border) of every point in the areas of a geography.

    Each edge of an area is put into the bands of latitude that it reaches; a point meets the edges of its band alone, and
    the parity of those to its east is a sum. ``key`` and ``region`` must be unique. Places are compared as they are, not in units.
    """
    side = regions.select(F.col(region).alias("pid"), F.col(column).alias("_g"))
    x, y = (F.col(c) for c in xy)
    sides = written(_sides(side), "sides")
    box = sides.groupBy("pid").agg(*(f(g(F.col(f"a{c}"), F.col(f"b{c}"))).alias(f"{n}{c}") for n, f, g in (("min", F.min, F.least), ("max", F.max, F.greatest)) for c in "xy"))
    index, spread = _banded_degrees(sides)
    bounds = written(box.join(index, "pid"), "bounds")
    placed = points.select(F.col(key).alias("_id"), x.alias("px"), y.alias("py")).where(x.isNotNull() & y.isNotNull())
    met = box_join(bounds, placed.select("_id", F.col("px").alias("r0"), F.col("py").alias("r1"), F.col("px").alias("r2"), F.col("py").alias("r3")), size, ("minx", "miny", "maxx", "maxy"), ("r0", "r1", "r2", "r3"))
    asked = met.select("pid", "_id", F.col("r0").alias("px"), F.col("r1").alias("py"), F.floor((F.col("r1") - F.col("low")) / F.col("height")).alias("band"))
    near = asked.join(spread, ["pid", "band"])
    px, py, ax, ay, bx, by = (F.col(c) for c in ("px", "py", "ax", "ay", "bx", "by"))
    turn = (bx - ax) * (py - ay) - (by - ay) * (px - ax)
    on = (turn == 0) & px.between(F.least(ax, bx), F.greatest(ax, bx)) & py.between(F.least(ay, by), F.greatest(ay, by))
    crossed = ((ay > py) != (by > py)) & (px < (bx - ax) * (py - ay) / (by - ay) + ax)
    seen = near.select("pid", "_id", on.alias("on"), crossed.alias("crossed")).where("on OR crossed")
    told = seen.groupBy("_id", "pid").agg(F.max("on").alias("on"), F.sum(F.col("crossed").cast("int")).alias("n")).where("on OR n % 2 = 1")
    return told.select(F.col("_id").alias(key), F.col("pid").alias(region), F.when(F.col("on"), 1).otherwise(2).alias("place"))


def _sides(areas_: DataFrame) -> DataFrame:
    """pid and the ends, in degrees, of all edges of the areas of _g, as they run."""
    ring = areas_.select("pid", F.explode(F.filter(F.col("_g.parts"), lambda p: p["kind"] == 3)).alias("p")).select("pid", F.explode("p.rings").alias("r"))
    n = F.size("r")
    steps = ring.select("pid", F.explode(F.arrays_zip(F.slice("r", 1, F.greatest(n - 1, F.lit(0))).alias("a"), F.slice("r", 2, F.greatest(n - 1, F.lit(0))).alias("b"))).alias("s"))
    return steps.select("pid", F.col("s.a.x").alias("ax"), F.col("s.a.y").alias("ay"), F.col("s.b.x").alias("bx"), F.col("s.b.y").alias("by"))


def _banded_degrees(sides: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As :func:`_banded`, in degrees and with an index that has four times as many bands."""
    low, high = F.least("ay", "by"), F.greatest("ay", "by")
    sums = sides.groupBy("pid").agg(F.count("*").alias("n"), F.min(low).alias("low"), F.max(high).alias("high"), F.sum(high - low).alias("climb"))
    tall = F.greatest(F.col("high") - F.col("low"), F.lit(1e-9))
    many = F.greatest(F.lit(1.0), F.least(F.lit(float(BANDS)), 4 * F.col("n") * tall / (F.col("climb") + 1e-9)))
    index = sums.select("pid", "low", (tall / many).alias("height"))
    band = lambda y: F.floor((y - F.col("low")) / F.col("height"))
    spread = sides.join(index, "pid").withColumn("band", F.explode(F.sequence(band(low), band(high))))
    return index, spread.drop("low", "height")

