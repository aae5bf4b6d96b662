"""The driver contract: queries and their SQL on the small tables."""

import math

import duckdb
import pytest

from geomere.plans import catalog


def _norm(v):
    return round(v, 5) if isinstance(v, float) and math.isfinite(v) else v


def test_entry(spark, data):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, data, name):
    found = catalog.QUERIES[name](spark, data)
    rows = found.collect()
    if name not in catalog.ORACLES:
        assert rows
        return
    db = duckdb.connect()
    for t in ("customer", "supplier", "events", "orders", "nation"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    got = db.execute(catalog.ORACLES[name])
    names = [d[0] for d in got.description]
    assert sorted(names) == sorted(found.columns)
    assert sorted(str([_norm(r[n]) for n in names]) for r in rows) == sorted(str([_norm(v) for v in r]) for r in got.fetchall())


#: Orders of one customer that follow on each other at one place: places repeat every 144,000 keys.
_AGAIN = [(7, 1, 0), (144_007, 1, 1), (9, 1, 2), (288_009, 1, 3), (11, 2, 0), (144_011, 2, 0)]


@pytest.mark.parametrize("name", ["makeline_length", "line_ends"])
def test_places_that_repeat_match_sql(spark, tmp_path, name):
    rows = spark.createDataFrame(_AGAIN, "o_orderkey long, o_custkey long, day int")
    rows.selectExpr("o_orderkey", "o_custkey", "CAST(date_add(DATE'2020-01-01', day) AS TIMESTAMP) AS o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    db = duckdb.connect()
    for table, key in (("customer", "c_custkey"), ("supplier", "s_suppkey"), ("events", "event_id"), ("nation", "n_nationkey")):
        db.execute(f"CREATE TABLE {table} ({key} BIGINT, c_nationkey INTEGER)")
    db.execute(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet/*.parquet'")
    got = [tuple(r) for r in catalog.QUERIES[name](spark, str(tmp_path)).orderBy("o_custkey").collect()]
    assert got == db.execute(f"SELECT * FROM ({catalog.ORACLES[name]}) ORDER BY o_custkey").fetchall()


#: Orders without a date, without a key, without either or a customer; one customer's only order has no place.
_LACKING = [(7, 1, None), (8, 1, 3), (9, 1, 1), (None, 1, 1), (10, 1, 1), (None, 2, 0), (11, 2, 1), (12, 2, 2), (13, 3, 0), (14, 3, 1), (None, 3, None), (15, 3, None), (16, 4, 0), (None, 4, 1), (17, 4, 2), (None, 5, 0), (18, None, None), (19, None, 0)]
#: Keys of 32 bits whose places need 64.
_LARGE = [(30_000_000, 1, 0), (60_000_001, 1, 1), (2_000_000_000, 1, 2), (2_000_000_001, 2, 0)]


@pytest.mark.parametrize(("rows", "key"), [(_LACKING, "long"), (_LARGE, "int")])
@pytest.mark.parametrize("name", ["line_ends", "makeline_length"])
def test_odd_orders_match_sql(spark, tmp_path, name, rows, key):
    orders = spark.createDataFrame(rows, f"o_orderkey {key}, o_custkey long, day int")
    orders.selectExpr("o_orderkey", "o_custkey", "CAST(date_add(DATE'2020-01-01', day) AS TIMESTAMP) AS o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    db = duckdb.connect()
    for table, column in (("customer", "c_custkey"), ("supplier", "s_suppkey"), ("events", "event_id"), ("nation", "n_nationkey")):
        db.execute(f"CREATE TABLE {table} ({column} BIGINT, c_nationkey INTEGER)")
    db.execute(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet/*.parquet'")
    got = [tuple(r) for r in catalog.QUERIES[name](spark, str(tmp_path)).orderBy("o_custkey").collect()]
    assert got == db.execute(f"SELECT * FROM ({catalog.ORACLES[name]}) ORDER BY o_custkey NULLS FIRST").fetchall()


@pytest.mark.parametrize("name", ["fromgeohash", "intersection"])
def test_customers_are_dealt_to_many_tasks(spark, data, name):
    """A small file of many customers is one task or two otherwise, however many cores there are."""
    assert catalog.QUERIES[name](spark, data).rdd.getNumPartitions() >= 32
