"""Reading and writing tables of geographies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import call, geography


def read_text(spark: SparkSession, path: str, column: str, form: str = "csv", **options) -> DataFrame:
    """A CSV or JSON table whose ``column`` is text (WKT, GeoJSON or hex WKB), read as a geography."""
    df = spark.read.options(**options).format(form).load(path)
    return df.withColumn(column, geography(F.col(column)))


def read_wkb(spark: SparkSession, path: str, column: str) -> DataFrame:
    """A Parquet table whose ``column`` holds (E)WKB, read as a geography."""
    return spark.read.parquet(path).withColumn(column, call("st_geogfromwkb", F.col(column)))


def with_box(df: DataFrame, column: str, prefix: str = "") -> DataFrame:
    """The rows with xmin, ymin, xmax and ymax of a geography, by whose statistics Parquet files can be skipped."""
    places = F.flatten(F.flatten(F.transform(F.col(column)["parts"], lambda p: p["rings"])))
    ends = {"xmin": (F.array_min, "x"), "ymin": (F.array_min, "y"), "xmax": (F.array_max, "x"), "ymax": (F.array_max, "y")}
    return df.withColumns({prefix + name: end(places[axis]) for name, (end, axis) in ends.items()})


def write_wkb(df: DataFrame, path: str, column: str) -> None:
    """Write a table to Parquet with ``column`` as EWKB, and the box of each row beside it."""
    with_box(df, column).withColumn(column, call("st_asewkb", F.col(column))).write.parquet(path)
