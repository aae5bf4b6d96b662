"""Geofencing of streams: points of a stream joined to boxes at rest, and windowed counts with late data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import box_join


def inside_boxes(points: DataFrame, boxes: DataFrame, size: float, x: str = "lon", y: str = "lat") -> DataFrame:
    """Each point of a stream (or table) with each box (xmin, ymin, xmax, ymax) that holds it, borders included. Stateless."""
    placed = points.withColumns({"r_xmin": F.col(x), "r_ymin": F.col(y), "r_xmax": F.col(x), "r_ymax": F.col(y)})
    return box_join(boxes, placed, size).drop("r_xmin", "r_ymin", "r_xmax", "r_ymax")


def counts(inside: DataFrame, key: str, time: str, window: str, late: str) -> DataFrame:
    """Points in each box and window of time; rows later than ``late`` are left out."""
    return inside.withWatermark(time, late).groupBy(F.window(time, window), key).count().select(key, F.col("window.start").alias("start"), "count")
