"""Spatial joins as equi-joins on grid cells, followed by an exact check.

A row of the one side goes to its own cell; a row of the other side to every cell in which
a partner may lie. So a pair meets in one cell only and nothing has to be made distinct.
Spark then shuffles, broadcasts, splits skewed cells and spills as in any join.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.shape import R
from ..session import written

#: Degrees of latitude that a distance spans.
_DEGREES = 180 / (math.pi * R)


def sphere_distance(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Metres between two places on the sphere, compiled into the query."""
    dl, u, v = F.radians(lon2 - lon1), F.radians(lat1), F.radians(lat2)
    side = F.sqrt(F.pow(F.cos(v) * F.sin(dl), 2) + F.pow(F.cos(u) * F.sin(v) - F.sin(u) * F.cos(v) * F.cos(dl), 2))
    return F.lit(R) * F.atan2(side, F.sin(u) * F.sin(v) + F.cos(u) * F.cos(v) * F.cos(dl))


def dwithin_join(left: DataFrame, right: DataFrame, metres: float, left_xy: tuple[str, str] = ("lon", "lat"), right_xy: tuple[str, str] = ("r_lon", "r_lat"), distance: str = "metres") -> DataFrame:
    """All pairs of points at most ``metres`` apart on the sphere, with their distance.

    Cells are bands of latitude of that height, cut into cells that are as wide as the
    distance is at the end of the band and its neighbours that is nearer to the pole; where that is over a half turn, a band
    is one cell. The right side, which should be the smaller one, is copied to the cells around it.
    """
    height = max(metres * _DEGREES * (1 + 1e-9), 1e-7)
    top = math.ceil(90 / height)

    def cells(band: Column) -> Column:
        """Cells in a band, the same for whoever asks."""
        lat = F.least(F.lit(90.0), (F.greatest(F.abs(band), F.abs(band + 1)) + 1) * height)
        width = F.degrees(F.asin(F.least(F.lit(1.0), F.sin(F.radians(F.lit(min(height, 90.0)))) / F.cos(F.radians(F.least(lat, F.lit(89.9999)))))))
        return F.when(lat >= 89.9999, F.lit(1)).otherwise(F.greatest(F.lit(1), F.floor(F.lit(360.0) / (width * (1 + 1e-9))))).cast("long")

    column = lambda lon, n: F.least(n - 1, F.floor((F.pmod(lon + 180, F.lit(360.0))) * n / 360)).cast("long")
    lx, ly = (F.col(c) for c in left_xy)
    rx, ry = (F.col(c) for c in right_xy)
    band = F.floor(ly / height).cast("long")
    own = left.withColumn("_band", band).withColumn("_cell", column(lx, cells(F.col("_band"))))
    around = right.withColumn("_band", F.explode(F.array(*(F.floor(ry / height).cast("long") + k for k in (-1, 0, 1))))).where(F.col("_band").between(-top - 1, top + 1))
    n = cells(F.col("_band"))
    places = F.when(n <= 3, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array(*(F.pmod(column(rx, n) + k, n) for k in (-1, 0, 1))))
    around = around.withColumn("_cell", F.explode(places))
    many = max(32, 4 * left.sparkSession.sparkContext.defaultParallelism)  # few rows make many pairs, so tasks are not merged by their size
    own, around = (df.repartition(many, "_band", "_cell") for df in (own, around))
    paired = own.join(around, ["_band", "_cell"]).withColumn(distance, sphere_distance(lx, ly, rx, ry))
    return paired.where(F.col(distance) <= metres).drop("_band", "_cell")


#: Candidates for each row of a nearest join that are compared outright, or 16 for each partner asked for; where cells leave more, finer ones thin them out first.
FEW = 64
#: Halvings of the cube around the globe, at most: beyond them places differ by rounding alone.
LAST = 48
#: How much nearer a cell may be by rounding than its rows, as a chord of the unit sphere.
SLACK = 1e-12


def _vector(lon: Column, lat: Column) -> dict[str, Column]:
    u, v = F.radians(lon), F.radians(lat)
    return {"_x": F.cos(v) * F.cos(u), "_y": F.cos(v) * F.sin(u), "_z": F.sin(v)}


def _cube(level: int) -> list[Column]:
    """The cell of a place of the unit sphere, the cube around it being halved ``level`` times along each axis."""
    return [F.floor((F.col(c) + 1) * 0.4999999 * float(1 << level)).cast("long").alias(n) for c, n in zip(("_x", "_y", "_z"), "ijl", strict=True)]


def _candidates(asked: DataFrame, placed: DataFrame, k: int) -> tuple[DataFrame, int, int]:
    """For each row (_row, _x, _y, _z) the cells (i, j, l, with n rows) of ``placed`` that may hold one of its ``k`` nearest, their level, and how many pairs that makes.

    Cells are known by their number of rows and a tight box. The least range by which boxes with ``k`` rows in all
    lie as a whole bounds the distance of the last partner; cells that begin beyond it are dropped, the others cut in 64.
    So no pair of rows is made until few are left, wherever the rows lie.
    """
    rows, many, level = asked.count(), placed.count(), 0
    open_, work = asked.select("*", *(F.lit(0).cast("long").alias(c) for c in "ijl"), F.lit(many).alias("n")), rows * many
    by = Window.partitionBy("_row").orderBy("far").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    while work > max(FEW, 16 * k) * rows and level < LAST:
        level += 2
        ends = [f(c).alias(f"{c}{e}") for c in ("_x", "_y", "_z") for e, f in (("0", F.min), ("1", F.max))]
        box = placed.groupBy(*_cube(level)).agg(F.count("*").alias("n"), *ends)
        box = box.select(*(F.floor(F.col(c) / 4).cast("long").alias(f"up_{c}") for c in "ijl"), F.struct("*").alias("c"))
        box = F.broadcast(box) if level <= 4 else written(box, "boxes")  # 16^3 boxes at most
        met = open_.drop("n").join(box, [F.col(c) == F.col(f"up_{c}") for c in "ijl"])
        gap = lambda c: F.greatest(F.lit(0.0), F.col(f"c.{c}0") - F.col(c), F.col(c) - F.col(f"c.{c}1"))
        reach = lambda c: F.greatest(F.abs(F.col(c) - F.col(f"c.{c}0")), F.abs(F.col(c) - F.col(f"c.{c}1")))
        size = lambda of: F.sqrt(sum((F.pow(of(c), 2) for c in ("_y", "_z")), F.pow(of("_x"), 2)))
        met = met.select("_row", "_x", "_y", "_z", "c.i", "c.j", "c.l", "c.n", size(gap).alias("near"), size(reach).alias("far"))
        met = met.withColumn("held", F.sum("n").over(by))
        met = met.withColumn("bound", F.min(F.when(F.col("held") >= k, F.col("far"))).over(Window.partitionBy("_row")))
        open_ = written(met.where(F.col("bound").isNull() | (F.col("near") <= F.col("bound") + SLACK)).drop("near", "far", "held", "bound"), "open")
        total, most = open_.agg(F.sum("n"), F.max("n")).first()
        work = total or 0
        if (most or 0) <= 1:
            break
    return open_, level, work


def nearest_join(left: DataFrame, right: DataFrame, k: int, key: str, right_key: str, **names) -> DataFrame:
    """For each ``key`` (unique) of the left side its ``k`` nearest points of the right side, ties to the smaller ``right_key`` (unique), with rank.

    Cells around the globe, finer from round to round, say by their numbers of rows how far the last partner of a row can be, before any pair of rows is
    made (:func:`_candidates`); so neither a dense place nor rows far off from all others make a pair of everything. Of the right rows of
    one place only the ``k`` least take part, and left rows of one place ask once. Rows without a place have no partner; with fewer than ``k`` points all are partners.
    """
    distance = names.get("distance", "metres")
    (lx, ly), (rx, ry) = names.get("left_xy", ("lon", "lat")), names.get("right_xy", ("r_lon", "r_lat"))
    placed = right.where(F.col(rx).isNotNull() & F.col(ry).isNotNull())
    for salt in (F.pmod(F.xxhash64(right_key), F.lit(64)), F.lit(0)):  # a busy place is thinned in 64 shares first
        least = Window.partitionBy(rx, ry, "_salt").orderBy(right_key)
        placed = placed.withColumn("_salt", salt).withColumn("_at", F.row_number().over(least)).where(F.col("_at") <= k).drop("_salt", "_at")
    placed = written(placed.withColumns(_vector(F.col(rx), F.col(ry))), "placed")
    asked = left.where(F.col(lx).isNotNull() & F.col(ly).isNotNull()).select(F.col(lx).alias("_lon"), F.col(ly).alias("_lat")).distinct()
    asked = written(asked.withColumns(_vector(F.col("_lon"), F.col("_lat"))).withColumn("_row", F.monotonically_increasing_id()), "asked")
    open_, level, _ = _candidates(asked, placed, k)
    cells = placed.withColumns({f"_{c}": v for c, v in zip("ijl", _cube(level), strict=True)}).drop("_x", "_y", "_z")
    pairs = open_.select("_row", *(F.col(c).alias(f"_{c}") for c in "ijl")).join(cells, ["_i", "_j", "_l"]).drop("_i", "_j", "_l")
    pairs = pairs.join(asked.select("_row", "_lon", "_lat"), "_row").withColumn(distance, sphere_distance(F.col("_lon"), F.col("_lat"), F.col(rx), F.col(ry)))
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("_row").orderBy(distance, right_key))).where(F.col("rank") <= k)
    return left.join(ranked.drop("_row"), (F.col(lx) == F.col("_lon")) & (F.col(ly) == F.col("_lat"))).drop("_lon", "_lat")


def box_join(left: DataFrame, right: DataFrame, size: float, left_box: tuple[str, ...] = ("xmin", "ymin", "xmax", "ymax"), right_box: tuple[str, ...] = ("r_xmin", "r_ymin", "r_xmax", "r_ymax")) -> DataFrame:
    """All pairs of rows whose boxes share a point, by grid cells of ``size`` degrees and coarser ones; an exact predicate may follow.

    Each box goes to the cells that it covers of the finest grid of which it covers at most four by four; grids double
    their cells from ``size`` on, so a box of any size has 16 copies at most. To meet boxes of coarser grids it
    also goes to the coarser cells that it covers: the left side's, which should be the smaller one, to those of all grids, the
    right side's to those of grids only that the left side has boxes of, so points of the right mostly go to one cell. Pairs meet on the coarser box's grid, in the cell
    that holds the lower left corner of what the boxes share, so each comes once.
    """
    top = max(0, math.ceil(math.log2(720 / size)))  # a cell that is wider than the globe

    def gridded(df: DataFrame, box: tuple[str, ...]) -> DataFrame:
        wide = F.greatest(F.col(box[2]) - F.col(box[0]), F.col(box[3]) - F.col(box[1])) / (3 * size)
        return df.withColumn("_own", F.least(F.lit(top), F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(wide, F.lit(1.0)))))).cast("int"))

    def covered(df: DataFrame, box: tuple[str, ...], other: DataFrame) -> DataFrame:
        at = lambda c: F.floor(F.col(c) / (size * F.pow(F.lit(2.0), F.col("_grid")))).cast("long")
        df = df.withColumn("_grid", F.explode(other))
        return df.withColumn("_cx", F.explode(F.sequence(at(box[0]), at(box[2])))).withColumn("_cy", F.explode(F.sequence(at(box[1]), at(box[3]))))

    a, b = [F.col(c) for c in left_box], [F.col(c) for c in right_box]
    own, one, two = F.col("_own"), gridded(left, left_box), gridded(right, right_box)
    used = range(top + 1) if left.isStreaming else sorted(r["_own"] for r in one.select("_own").where("_own IS NOT NULL").distinct().collect())  # top + 1 rows at most
    one = covered(one, left_box, F.sequence(own, F.lit(top))).withColumnRenamed("_own", "_own_a")
    coarser = F.filter(F.array(*map(F.lit, used)).cast("array<int>"), lambda g: g > own)
    two = covered(two, right_box, F.concat(F.array(own), coarser)).withColumnRenamed("_own", "_own_b")
    pairs = one.join(two, ["_grid", "_cx", "_cy"]).where(F.col("_grid") == F.greatest("_own_a", "_own_b"))
    cell = size * F.pow(F.lit(2.0), F.col("_grid"))
    meet = (a[0] <= b[2]) & (b[0] <= a[2]) & (a[1] <= b[3]) & (b[1] <= a[3])
    first = (F.floor(F.greatest(a[0], b[0]) / cell) == F.col("_cx")) & (F.floor(F.greatest(a[1], b[1]) / cell) == F.col("_cy"))
    return pairs.where(meet & first).drop("_grid", "_cx", "_cy", "_own_a", "_own_b")
