"""What every job needs of its session: code on the executors and a shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_PACKAGE = Path(__file__).resolve().parent


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per Spark context, whatever their PYTHONPATH is."""
    context = spark.sparkContext
    if getattr(context, "_geomere_shipped", False):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="geomere-"), "geomere_code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(_PACKAGE.rglob("*.py")):
            z.write(p, str(p.relative_to(_PACKAGE.parent)))
    context.addPyFile(archive)
    context._geomere_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only on one machine (a local master) a temporary one is set where the session names none; a cluster has to name its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="geomere-shared-")
        spark.sparkContext.setCheckpointDir(named)
    return named


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt evenly to four tasks a core: a table of few or uneven files would leave most cores idle where much is made of each row."""
    return df.repartition(max(32, 4 * df.sparkSession.sparkContext.defaultParallelism))


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage, survives lost executors, and has a known size."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/geomere/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    tables(spark).append(path)
    return spark.read.schema(df.schema).parquet(path)


def tables(spark: SparkSession) -> list[str]:
    """The folders of all tables that :func:`written` has made in this Spark context and :func:`forget` has not deleted."""
    context = spark.sparkContext
    if not hasattr(context, "_geomere_tables"):
        context._geomere_tables = []
    return context._geomere_tables


def forget(spark: SparkSession, keep: list[str] = ()) -> None:
    """Delete the tables of this Spark context but those named. DataFrames that still read the deleted ones are lost."""
    context, known = spark.sparkContext, tables(spark)
    for path in [p for p in known if p not in keep]:
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
        known.remove(path)
