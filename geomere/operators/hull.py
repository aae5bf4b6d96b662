"""Convex hulls of groups: hulls of batches before the shuffle, of shares of a group after it, then of what is left of the group.

The corners of a hull of several sets are corners of the sets' own hulls, so each step only passes on corners, and no group is gathered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.shape import GEO
from ..session import written

#: Shares that a group's corners are put in before they come together.
SHARES = 64


def _corners(x: np.ndarray, y: np.ndarray) -> list[int]:
    """Rows of the corners of some places, clockwise from the lowest (of these the leftmost); places between corners are none."""
    order = np.lexsort((y, x))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(x[order]) != 0) | (np.diff(y[order]) != 0)
    order = order[new].tolist()
    if len(order) < 3:
        return order

    def chain(rows: list[int]) -> list[int]:
        out: list[int] = []
        for r in rows:
            while len(out) > 1 and (x[out[-1]] - x[out[-2]]) * (y[r] - y[out[-2]]) - (y[out[-1]] - y[out[-2]]) * (x[r] - x[out[-2]]) >= 0:
                out.pop()
            out.append(r)
        return out[:-1]

    ring = chain(order) + chain(order[::-1])
    low = min(range(len(ring)), key=lambda k: (y[ring[k]], x[ring[k]]))
    return ring[low:] + ring[:low]


def _thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each batch the corners of each group."""
    for batch in batches:
        pid, x, y = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("pid", "x", "y"))
        order = np.argsort(pid, kind="stable")
        kept = []
        for rows in np.split(order, np.flatnonzero(np.diff(pid[order])) + 1):
            if len(rows):
                kept.append(rows[_corners(x[rows], y[rows])])
        yield batch.take(pa.array(np.concatenate(kept) if kept else np.zeros(0, np.int64)))


def _share(table: pa.Table) -> pa.Table:
    at = _corners(*(table.column(n).to_numpy() for n in ("x", "y")))
    return table.select(["pid", "x", "y"]).take(pa.array(at, pa.int64()))


def _ring(table: pa.Table) -> pa.Table:
    """The corners of a group in order, as one list."""
    x, y = (table.column(n).to_numpy() for n in ("x", "y"))
    spots = [{"x": float(x[k]), "y": float(y[k])} for k in _corners(x, y)]
    return pa.table({"pid": table.column("pid").slice(0, 1), "ring": pa.array([spots], pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))})


def hull(df: DataFrame, by: list[str], column: str, name: str = "hull") -> DataFrame:
    """``by`` and the convex hull of all places of a group's geographies: a polygon, or a line or point where there are no three corners.

    Null groups count as groups. A group without a place (nulls, empty geographies) has null.
    """
    taken = {"pid", "ring"} & {c.lower() for c in by}
    if taken:
        raise ValueError(f"columns may not be called {', '.join(sorted(taken))}")
    groups = written(df.select(*by).distinct().withColumn("pid", F.monotonically_increasing_id()), "groups")
    place = F.explode(F.flatten(F.flatten(F.transform(F.col(column)["parts"], lambda p: p["rings"]))))
    spots = df.select(*by, place.alias("_p")).join(groups.select("pid", *(F.col(c).alias(f"_{n}") for n, c in enumerate(by))), _keys(by)).select("pid", F.col("_p.x").alias("x"), F.col("_p.y").alias("y"))
    thin = spots.mapInArrow(_thinned, spots.schema).withColumn("share", F.pmod(F.xxhash64("x", "y"), F.lit(SHARES)))
    shared = thin.groupBy("pid", "share").applyInArrow(_share, spots.schema)
    rings = shared.groupBy("pid").applyInArrow(_ring, "pid long, ring array<struct<x: double, y: double>>")
    nothing = F.lit(None).cast("double")
    spot = F.transform("ring", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), nothing.alias("z"), nothing.alias("m")))
    n = F.least(F.size("ring"), F.lit(3))
    outline = F.when(n == 3, F.concat(spot, F.slice(spot, 1, 1))).otherwise(spot)
    made = F.struct(n.alias("kind"), F.lit(4326).alias("srid"), F.lit(0).alias("flags"), F.array(F.struct(n.alias("kind"), F.array(outline).alias("rings"))).alias("parts"))
    return groups.join(rings, "pid", "left").select(*by, F.when(F.col("ring").isNotNull(), made.cast(GEO)).alias(name))


def _keys(by: list[str]):
    same = F.lit(True)
    for n, c in enumerate(by):
        same &= F.col(c).eqNullSafe(F.col(f"_{n}"))
    return same
