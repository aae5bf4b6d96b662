"""Aggregates of geographies over groups that Spark pre-aggregates before the shuffle; no group is gathered in one row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import call
from ..sources.geography import with_box


def extent(df: DataFrame, by: list[str], column: str, name: str = "extent") -> DataFrame:
    """The box of all geographies of a group: ``by`` and ``name``; null where a group has no place."""
    boxed = with_box(df.select(*by, column), column, "_")
    ends = boxed.groupBy(*by).agg(*(end(c).alias(c) for end, c in ((F.min, "_xmin"), (F.min, "_ymin"), (F.max, "_xmax"), (F.max, "_ymax"))))
    box = call("st_boundingbox", call("st_makebox", *(F.col(c) for c in ("_xmin", "_ymin", "_xmax", "_ymax"))))
    return ends.select(*by, box.alias(name))


def centroid(df: DataFrame, by: list[str], column: str, name: str = "centroid") -> DataFrame:
    """The centroid of the distinct points of a group: ``by`` and ``name``. Other geographies are an error."""
    parts = F.transform(F.col(column)["parts"], lambda p: F.when(p["kind"] == 1, F.struct(p["rings"][0][0]["x"].alias("x"), p["rings"][0][0]["y"].alias("y"))).otherwise(F.raise_error(F.lit("centroid: only points can be aggregated"))))
    points = df.select(*by, F.explode(parts).alias("_p")).select(*by, F.radians("_p.x").alias("_x"), F.radians("_p.y").alias("_y")).distinct()
    unit = {"_u": F.cos("_y") * F.cos("_x"), "_v": F.cos("_y") * F.sin("_x"), "_w": F.sin("_y")}
    summed = points.select(*by, *(v.alias(c) for c, v in unit.items())).groupBy(*by).agg(*(F.sum(c).alias(c) for c in unit))
    return summed.select(*by, call("st_makepoint", F.degrees(F.atan2("_v", "_u")), F.degrees(F.atan2("_w", F.sqrt(F.col("_u") ** 2 + F.col("_v") ** 2)))).alias(name))
