"""Density clustering as Spark jobs: a grid join for neighbours, counts for cores, components for clusters."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.shape import CLUSTER_R
from ..session import written
from .components import components

#: Pairs of rows for each row that are compared outright; where dense cells leave more, sub-cells thin them out first.
FEW = 32
#: Halvings of a cell, at most: beyond them places differ by rounding alone.
LAST = 48


def dbscan(points: DataFrame, eps_metres: float, min_points: int, key: str = "id", x: str = "lon", y: str = "lat") -> DataFrame:
    """``key`` and cluster of every row; cluster is null for noise and for rows without a place.

    As in the function to match, the radius is metres over the mean radius of the Earth,
    taken as degrees of the plane. A core has ``min_points`` rows in its radius, itself included; a
    border row goes to the cluster of its least core. With ``min_points`` of one or less every row is a core.
    With no more rows that have a place than ``min_points`` there are no clusters, as in the function to match.
    Clusters are numbered from 0 by their least core. ``key`` must be unique, of type long.

    A cell whose diagonal is the radius holds neighbours only. Where it has ``min_points`` rows all of them are cores of
    one cluster: each is linked to the least of them instead of to all others, so dense places cost no pairs of their own.
    Two dense cells need one pair of neighbours, which :func:`_linked` finds by sub-cells; a row of a sparse cell keeps
    one count and the least row of each dense cell near it. Rows of dense cells are copied only to sparse cells that exist.
    """
    if eps_metres < 0 or min_points < 0:
        raise ValueError("radius and number of points must not be negative")
    eps, enough = eps_metres / CLUSTER_R, max(min_points, 1)
    size = max(eps, 1e-12) / math.sqrt(2) * (1 - 1e-9)
    placed = points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.col(key).cast("long").alias("a"), F.col(x).alias("ax"), F.col(y).alias("ay"))
    placed = placed.withColumn("cx", F.floor(F.col("ax") / size).cast("long")).withColumn("cy", F.floor(F.col("ay") / size).cast("long"))
    cells = written(placed.groupBy("cx", "cy").agg(F.count("*").alias("held"), F.min("a").alias("head")).withColumn("dense", F.col("held") >= enough), "cells")
    total = cells.agg(F.sum("held")).first()[0] or 0
    if total <= min_points:
        return points.select(key, F.lit(None).cast("int").alias("cluster"))
    placed = written(placed.join(cells, ["cx", "cy"]), "placed")
    near = F.pow(F.col("ax") - F.col("bx"), 2) + F.pow(F.col("ay") - F.col("by"), 2) <= eps * eps
    # cells meet in 24 others, and sparse ones in their own
    around = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(-2, 3) for j in range(-2, 3)))
    beside = cells.withColumn("d", F.explode(around)).select(F.col("cx").alias("to_x"), F.col("cy").alias("to_y"), F.col("dense").alias("to_dense"), F.col("held").alias("to_held"), F.col("head").alias("to_head"), (F.col("cx") + F.col("d.i")).alias("cx"), (F.col("cy") + F.col("d.j")).alias("cy"))
    met = beside.join(cells, ["cx", "cy"])
    copies = placed.join(met.where("NOT to_dense").select("cx", "cy", "to_x", "to_y"), ["cx", "cy"])
    copies = copies.select(F.col("a").alias("b"), F.col("ax").alias("bx"), F.col("ay").alias("by"), F.when(F.col("dense"), F.col("head")).otherwise(F.col("a")).alias("of"), F.col("to_x").alias("cx"), F.col("to_y").alias("cy"))
    # b: the least neighbour of a dense cell stands for its others
    pairs = placed.where("NOT dense").select("a", "ax", "ay", "cx", "cy").join(copies, ["cx", "cy"]).where(near)
    sparse = written(pairs.groupBy("a", "of").agg(F.count("*").alias("n"), F.min("b").alias("b")).select("a", "b", "n"), "neighbours")
    counted = sparse.groupBy("a").agg(F.sum("n").alias("n")).where(F.col("n") >= enough).select("a")
    core = written(counted.unionByName(placed.where("dense").select("a")), "cores")
    within = placed.where("dense").select("a", F.col("head").alias("b"))
    across = met.where("dense AND to_dense AND head < to_head").select("head", F.col("to_head").alias("head_b"), F.col("held").cast("double").alias("n"), F.col("to_held").cast("double").alias("m"))
    across = _linked(placed.where("dense"), written(across, "dense"), size, eps, FEW * total).select(F.col("head").alias("a"), F.col("head_b").alias("b"))
    of_cores = sparse.select("a", "b").join(core, "a").join(core.withColumnRenamed("a", "b"), "b").select("a", "b")
    roots = components(of_cores.unionByName(within).unionByName(across))
    cored = core.join(roots.withColumnRenamed("node", "a"), "a", "left").select("a", F.coalesce("root", "a").alias("root"))
    cored = written(cored, "cored")
    border = sparse.select("a", "b").join(core, "a", "left_anti").join(cored.withColumnRenamed("a", "b"), "b").groupBy("a").agg(F.min_by("root", "b").alias("root"))
    member = cored.unionByName(border)
    # places of the least cores in order, from the counts of partitions that are sorted by range
    named = written(cored.select("root").distinct().repartitionByRange("root").sortWithinPartitions("root").withColumn("at", F.monotonically_increasing_id()), "roots")
    counts = sorted((r["p"], r["count"]) for r in named.groupBy(F.shiftright("at", 33).alias("p")).count().collect())
    before, offsets = 0, []
    for p, n in counts:
        offsets.append((p, before))
        before += n
    table = points.sparkSession.createDataFrame(offsets, "p long, before long")
    numbered = named.withColumn("p", F.shiftright("at", 33)).join(F.broadcast(table), "p").select("root", (F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).cast("int").alias("cluster"))
    found = member.join(numbered, "root").select(F.col("a").alias("_node"), "cluster")
    return points.select(key).join(found, F.col(key).cast("long") == F.col("_node"), "left").select(key, "cluster")


def _linked(rows: DataFrame, pairs: DataFrame, size: float, eps: float, few: float) -> DataFrame:
    """head and head_b of the pairs of cells (head, head_b, with n and m rows) of which a row of one is within ``eps`` of one of the other.

    Cells are cut into sub-cells with tight boxes, finer from round to round. A pair of sub-cells whose boxes are farther apart than the
    radius is dropped; one of whose rows a known one of each is near links its cells, which then need no others. What
    stays open is cut again until no more than ``few`` pairs of rows are left, and these are compared.
    """
    work = pairs.agg(F.sum(F.col("n") * F.col("m"))).first()[0] or 0
    place = rows.select("head", "ax", "ay", (F.col("ax") / size - F.col("cx")).alias("u"), (F.col("ay") / size - F.col("cy")).alias("v")).distinct()
    at = lambda p, level: F.floor(F.col(p) * F.lit(float(1 << level))).cast("long")
    links, level, left = [], 0, pairs.select("head", "head_b", *(F.lit(0).cast("long").alias(c) for c in "ijkl"))
    if work > few:
        place = written(place, "places")
    while work > few and level < LAST:
        level += 2
        up = lambda p: F.floor(F.col(p) / 4).cast("long")
        box = place.groupBy("head", at("u", level).alias("i"), at("v", level).alias("j")).agg(F.count("*").cast("double").alias("n"), F.min("ax").alias("x0"), F.max("ax").alias("x1"), F.min("ay").alias("y0"), F.max("ay").alias("y1"), F.min(F.struct("ax", "ay")).alias("p"))
        box = written(box.withColumn("up_i", up("i")).withColumn("up_j", up("j")), "boxes")
        one = box.select("head", F.col("up_i").alias("i"), F.col("up_j").alias("j"), F.struct("i", "j", "n", "x0", "x1", "y0", "y1", "p").alias("s"))
        two = box.select(F.col("head").alias("head_b"), F.col("up_i").alias("k"), F.col("up_j").alias("l"), F.struct("i", "j", "n", "x0", "x1", "y0", "y1", "p").alias("t"))
        gap = lambda c: F.greatest(F.lit(0.0), F.col(f"s.{c}0") - F.col(f"t.{c}1"), F.col(f"t.{c}0") - F.col(f"s.{c}1"))
        square = lambda dx, dy: F.pow(dx, 2) + F.pow(dy, 2)
        linked = square(F.col("s.p.ax") - F.col("t.p.ax"), F.col("s.p.ay") - F.col("t.p.ay")) <= eps * eps
        tested = left.join(one, ["head", "i", "j"]).join(two, ["head_b", "k", "l"]).where(square(gap("x"), gap("y")) <= eps * eps)
        tested = written(tested.select("head", "head_b", F.col("s.i").alias("i"), F.col("s.j").alias("j"), F.col("t.i").alias("k"), F.col("t.j").alias("l"), (F.col("s.n") * F.col("t.n")).alias("work"), linked.alias("linked")), "tested")
        links.append(tested.where("linked").select("head", "head_b").distinct())
        left = written(tested.join(links[-1], ["head", "head_b"], "left_anti"), "open")
        work = left.agg(F.sum("work")).first()[0] or 0
        left = left.select("head", "head_b", *"ijkl")
    if work:
        one = place.select("head", at("u", level).alias("i"), at("v", level).alias("j"), "ax", "ay")
        two = place.select(F.col("head").alias("head_b"), at("u", level).alias("k"), at("v", level).alias("l"), F.col("ax").alias("bx"), F.col("ay").alias("by"))
        near: Column = F.pow(F.col("ax") - F.col("bx"), 2) + F.pow(F.col("ay") - F.col("by"), 2) <= eps * eps
        links.append(left.join(one, ["head", "i", "j"]).join(two, ["head_b", "k", "l"]).where(near).select("head", "head_b").distinct())
    return reduce(DataFrame.unionByName, links) if links else pairs.select("head", "head_b").limit(0)
