"""Buffers of points, lines and areas as one Spark job over tables of edges.

Each edge of a path makes one small area on its left: the strip between the edge and its parallel, with the join or cap that follows
it. A line is a path there and another back, with caps where they turn; a border is a path around with its outside to the left,
or, where an area shrinks, with its inside. The arrangement then adds up the area and its strips, or takes them off.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from . import arrangement


@dataclass(frozen=True)
class Style:
    """How a buffer is drawn; the defaults are those of the function to match."""

    quad_segs: int = 8
    join: str = "round"
    endcap: str = "round"
    mitre_limit: float = 5.0
    side: str = "both"


# fixed values: the parameters and their words
_WORDS = {
    "join": {"round": "round", "mitre": "mitre", "miter": "mitre", "bevel": "bevel"},
    "endcap": {"round": "round", "flat": "flat", "butt": "flat", "square": "square"},
    "side": {"both": "both", "left": "left", "right": "right"},
}
_NUMBERS = {"quad_segs": int, "mitre_limit": float, "miter_limit": float}


def style(text: str = "") -> Style:
    """The style that a parameter text like ``'quad_segs=2 join=bevel'`` names."""
    named = {}
    for word in text.split():
        key, _, value = word.partition("=")
        if not value:
            raise ValueError(f"{key} has no value")
        if key in _WORDS:
            if value not in _WORDS[key]:
                raise ValueError(f"{key} may be {', '.join(_WORDS[key])}, not {value}")
            named[key] = _WORDS[key][value]
        elif key in _NUMBERS:
            named[key.replace("miter", "mitre")] = _NUMBERS[key](value)
        else:
            raise ValueError(f"a buffer has no parameter {key}")
    if named.get("quad_segs", 1) < 1:
        raise ValueError("quad_segs must be 1 at least")
    return Style(**named)


def _spot(x: Column, y: Column) -> Column:
    nothing = F.lit(None).cast("double")
    return F.struct(x.alias("x"), y.alias("y"), nothing.alias("z"), nothing.alias("m"))


def _part(ring: Column) -> Column:
    return F.struct(F.lit(3).alias("kind"), F.array(ring).alias("rings"))


def _paths(members: DataFrame, drawn: Style) -> DataFrame:
    """pid, r (above 0), side, way (the places of a directed path, its strips to the left), closed and capped of every line and border."""
    one = members.where("part.kind > 1 AND r <> 0").select("pid", "r", F.col("part.kind").alias("kind"), F.posexplode("part.rings").alias("at", "ring"))
    distinct = F.filter("ring", lambda p, i: (i == 0) | (p["x"] != F.get("ring", i - 1)["x"]) | (p["y"] != F.get("ring", i - 1)["y"]))
    one = one.withColumn("way", distinct).where(F.size("way") > 1)
    one = one.withColumn("closed", (F.col("way")[0]["x"] == F.element_at("way", -1)["x"]) & (F.col("way")[0]["y"] == F.element_at("way", -1)["y"]))
    back = F.reverse("way")
    lines = one.where("kind = 2 AND r > 0")
    ways = {"both": F.array("way", back), "left": F.array("way"), "right": F.array(back)}[drawn.side]
    capped = F.lit(drawn.side == "both")
    lines = lines.select("pid", "r", F.lit(0).alias("side"), F.explode(ways).alias("way"), "closed", capped.alias("capped"))
    n = F.size("way")
    turn = F.aggregate(F.arrays_zip(F.slice("way", 1, n - 1).alias("a"), F.slice("way", 2, n - 1).alias("b")), F.lit(0.0), lambda s, e: s + e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"])
    # insides to the right: shells clockwise, holes the other way; a shrinking area turns round
    right = ((turn < 0) == (F.col("at") == 0)) == (F.col("r") > 0)
    borders = one.where("kind = 3").select("pid", F.abs("r").alias("r"), F.when(F.col("r") < 0, 1).otherwise(0).alias("side"), F.when(right, F.col("way")).otherwise(back).alias("way"), F.lit(True).alias("closed"), F.lit(False).alias("capped"))
    return lines.unionByName(borders)


def _strips(paths: DataFrame, drawn: Style) -> DataFrame:
    """pid, side and part (an area) of every edge of the paths, each with the join or cap after it."""
    n = F.size("way")
    # of a closed path the place after the last is the second, of an open one there is none
    after = F.concat(F.slice("way", 3, n - 2), F.array(F.when(F.col("closed"), F.col("way")[1])))
    corner = F.arrays_zip(F.slice("way", 1, n - 1).alias("p"), F.slice("way", 2, n - 1).alias("q"), after.alias("s"))
    one = paths.select("pid", "r", "side", "capped", F.explode(corner).alias("c"))
    xy = lambda k: (F.col(f"c.{k}.x"), F.col(f"c.{k}.y"))
    (px, py), (qx, qy), (sx, sy) = xy("p"), xy("q"), xy("s")
    r = F.col("r")
    one = one.select("pid", "side", "capped", "c", "r", *(v.alias(k) for k, v in {"dx": qx - px, "dy": qy - py, "ex": sx - qx, "ey": sy - qy}.items()))
    long = lambda x, y: F.sqrt(F.col(x) * F.col(x) + F.col(y) * F.col(y))
    # left normals of the edge and of the next
    one = one.withColumns({"nx": -F.col("dy") / long("dx", "dy"), "ny": F.col("dx") / long("dx", "dy"), "mx": -F.col("ey") / long("ex", "ey"), "my": F.col("ex") / long("ex", "ey")})
    nx, ny, mx, my = (F.col(c) for c in ("nx", "ny", "mx", "my"))
    bend = F.col("dx") * F.col("ey") - F.col("dy") * F.col("ex")
    ahead = F.col("dx") * F.col("ex") + F.col("dy") * F.col("ey")
    last = sx.isNull()
    one = one.withColumn("turned", F.when(last, math.pi).when(bend < 0, F.least(F.lit(math.pi), F.atan2(-bend, ahead))).when((bend == 0) & (ahead < 0), math.pi).otherwise(0.0))
    turned = F.col("turned")
    start, end = _spot(px + r * nx, py + r * ny), _spot(qx + r * nx, qy + r * ny)
    then = F.when(last, _spot(qx - r * nx, qy - r * ny)).otherwise(_spot(qx + r * mx, qy + r * my))
    steps = F.greatest(F.lit(1), F.floor(turned / (math.pi / 2 / drawn.quad_segs) + 0.5)).cast("int")
    angle = F.atan2(ny, nx)
    arc = F.filter(F.transform(F.sequence(F.lit(1), steps), lambda i: F.when(i < steps, _spot(qx + r * F.cos(angle - turned * i / steps), qy + r * F.sin(angle - turned * i / steps)))), lambda p: p.isNotNull())
    none = F.array().cast("array<struct<x: double, y: double, z: double, m: double>>")
    # along the edge by t radii from its end, and back along the next by as many
    along = lambda t: (_spot(qx + r * (nx + t * ny), qy + r * (ny - t * nx)), _spot(F.when(last, qx + r * (t * ny - nx)).otherwise(qx + r * (mx - t * my)), F.when(last, qy - r * (ny + t * nx)).otherwise(qy + r * (my + t * mx))))
    half = turned / 2
    sharp = 1 / F.cos(half) > drawn.mitre_limit
    mitre = F.when(sharp, F.array(*along((drawn.mitre_limit - F.cos(half)) / F.sin(half)))).otherwise(F.array(along(F.tan(half))[0]))
    square = F.array(*along(F.lit(1.0)))
    joined = {"round": arc, "bevel": none, "mitre": mitre}[drawn.join]
    capped = {"round": arc, "flat": none, "square": square}[drawn.endcap]
    corner = F.when(last & F.col("capped"), F.concat(F.array(end), capped, F.array(then))).when(last | (turned == 0), F.array(end)).otherwise(F.concat(F.array(end), joined, F.array(then)))
    ring = F.concat(F.array(_spot(px, py), start), corner, F.array(_spot(qx, qy), _spot(px, py)))
    return one.select("pid", "side", _part(ring).alias("part"))


def _dots(members: DataFrame, drawn: Style) -> DataFrame:
    """pid, side and part of every point, and every line of no length."""
    first = F.col("part.rings")[0][0]
    single = F.forall(F.col("part.rings")[0], lambda p: (p["x"] == first["x"]) & (p["y"] == first["y"]))
    one = members.where("part.kind < 3 AND r > 0").where(single).select("pid", "r", first["x"].alias("x"), first["y"].alias("y"))
    if drawn.endcap == "flat":
        one = one.where(F.lit(False))
    many = 4 if drawn.endcap == "square" else 4 * drawn.quad_segs
    reach, off = (math.sqrt(2), math.pi / 4) if drawn.endcap == "square" else (1.0, 0.0)
    turn = lambda k: off - (k % many) * (2 * math.pi / many)
    x, y, r = F.col("x"), F.col("y"), F.col("r") * reach
    ring = F.transform(F.sequence(F.lit(0), F.lit(many)), lambda k: _spot(x + r * F.cos(turn(k)), y + r * F.sin(turn(k))))
    return one.select("pid", F.lit(0).alias("side"), _part(ring).alias("part"))


def buffer(df: DataFrame, column: str, radius: Column | float, params: str = "", name: str = "result") -> DataFrame:
    """``df`` with the places within ``radius`` (in degrees of the plane) of each geography, as an area.

    Of a negative radius areas lose what is as near to their border, points and lines all; of zero areas stay as they are. ``params``: text
    of quad_segs, join (round, mitre, bevel), mitre_limit, endcap (round, flat, square) and side (both, left, right; of lines, without caps
    on a single side). Mitres longer than the limit are cut there. Nulls, also of the radius, give null; what leaves nothing an empty polygon.

    Equal geographies of equal radius are drawn once. Work is that of the arrangement: of a geography whose edges are much shorter than the radius, all strips near a place meet.
    """
    arrangement._same(df, column)
    drawn = style(params)
    fresh, once = arrangement.numbered(df.withColumn("_radius", (radius if isinstance(radius, Column) else F.lit(radius)).cast("double")), column, "_radius")
    members = once.where("_radius IS NOT NULL").select("pid", F.col("_radius").alias("r"), F.explode(f"{column}.parts").alias("part"))
    own = members.where("part.kind = 3").select("pid", F.lit(0).alias("side"), "part")
    every = own.unionByName(_strips(_paths(members, drawn), drawn)).unionByName(_dots(members, drawn))
    every = written(every.withColumn("member", F.monotonically_increasing_id()), "strips")
    rows = arrangement.edges(every.withColumn("g", F.struct(F.array("part").alias("parts"))), ["pid", "member", "side"], "g")
    made = written(arrangement.areas(arrangement.bounding(arrangement.pieces(rows), "difference")), "made")
    known = F.col(column).isNotNull() & F.col("_radius").isNotNull()
    return fresh.join(made, "pid", "left").select(*df.columns, F.when(known, arrangement._geography(F.col("parts"), F.col(column)["srid"])).alias(name))
