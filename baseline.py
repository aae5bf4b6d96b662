
from __future__ import annotations

import json
import math
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def main() -> None:
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from geomere.functions import call, geography
    from geomere.operators.cluster import dbscan
    from geomere.operators.joins import dwithin_join, nearest_join, sphere_distance
    from geomere.plans import tables as t

    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark = SparkSession.builder.master(f"local[{cpus}]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", cpus).config("spark.checkpoint.dir", scratch).config("spark.local.dir", scratch).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    col, took = F.col, {}
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.monotonically_increasing_id().alias("k"), *(F.expr(x.format(k="l_orderkey")).alias(n) for n, x in (("lon", t.LON), ("lat", t.LAT)))).repartition(int(cpus)).cache()
    rows = lines.count()
    customers = t.customer_pt(spark, sf_dir).select("c_custkey", "lon", "lat").cache()
    suppliers = t.supplier_pt(spark, sf_dir).select("s_suppkey", col("lon").alias("r_lon"), col("lat").alias("r_lat")).cache()
    corners = [(10 * math.cos(k * math.pi / 25), 10 * math.sin(k * math.pi / 25)) for k in range(50)]
    ring = geography("POLYGON((" + ",".join(f"{x:.6f} {y:.6f}" for x, y in [*corners, corners[0]]) + "))")
    place = call("st_makepoint", col("lon"), col("lat"))
    cases = {
        "distance of two points, plain formula": lambda: lines.select(sphere_distance(col("lon"), col("lat"), F.lit(1.0), F.lit(2.0))),
        "distance of two points, st_distance": lambda: lines.select(call("st_distance", place, call("st_makepoint", F.lit(1.0), F.lit(2.0)))),
        "text of points, read and written": lambda: lines.select(call("st_astext", call("st_geogfromtext", F.concat(F.lit("POINT("), col("lon"), F.lit(" "), col("lat"), F.lit(")"))))),
        "binary of points, written and read": lambda: lines.select(call("st_geogfromwkb", call("st_asewkb", place))),
        "point in a polygon of 50 corners": lambda: lines.where(call("st_contains", ring, place)),
        "customers within 800 km of suppliers": lambda: dwithin_join(customers, suppliers, 800_000.0),
        "three nearest suppliers of customers": lambda: nearest_join(customers, suppliers, 3, "c_custkey", "s_suppkey"),
        "density clusters of customers": lambda: dbscan(customers, 1.0 * 6371008.8, 5, "c_custkey"),
    }
    for name, make in cases.items():
        times = []
        for _ in range(RUNS + 1):
            began = time.time()
            make().write.format("noop").mode("overwrite").save()
            times.append(time.time() - began)
        took[name] = round(statistics.median(times[1:]), 2)
        print(name, took[name], file=sys.stderr, flush=True)
    print(json.dumps({"rows": rows, "seconds": took}))
    spark.stop()


if __name__ == "__main__":
    main()
