"""The ``st_*`` functions: ``register(spark)`` once, then use them in SQL or by :func:`call`."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .definitions import FUNCTIONS
from .shape import GEO

#: Spark has functions of its own by these names that a SQL function can't replace.
ALIASES = {"st_asbinary": "st_aswkb", "st_geogfromwkb": "st_geogfrombinary", "st_geomfromwkb": "st_geomfrombinary"}


#: Overlays nest deeper than Spark's analyser follows by default; a session that uses them is set to this many rounds.
ROUNDS = 1000
_DEEP = {"st_intersection_any", "st_difference_any", "st_union_any"}


def register(spark: SparkSession, *names: str) -> None:
    """Make ``st_*`` functions known to a session: those named, or all but the overlays of any pair. Spark analyses each one once.

    For overlays of any pair ``spark.sql.analyzer.maxIterations`` is raised in the session.
    """
    limit = "spark.sql.analyzer.maxIterations"
    if _DEEP & set(names) and int(spark.conf.get(limit, "100")) < ROUNDS:
        spark.conf.set(limit, ROUNDS)
    known = spark.__dict__.setdefault("_geomere_known", set())
    for fn in names or [n for n in FUNCTIONS if n not in _DEEP]:
        if fn in known:
            continue
        args, returns, body = FUNCTIONS[fn]
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {fn}({args}) RETURNS {returns} RETURN {body}")
        known.add(fn)


def call(name: str, *args) -> Column:
    """A function over columns, registered if it is not yet; a text argument is a literal geography, other values are literals."""
    spark, name = SparkSession.active(), ALIASES.get(name, name)
    register(spark, name)
    return F.call_function(name, *(geography(a) if isinstance(a, str) else a if isinstance(a, Column) else F.lit(a) for a in args))


def geography(value: str | Column) -> Column:
    """A geography of hex (E)WKB, GeoJSON or (E)WKT, whichever its first letter says."""
    form = "st_geogfrom"
    if isinstance(value, str):  # a literal needs only the one form's expression
        form = "st_geogfrombinary" if value[:1] == "0" else "st_geogfromgeojson" if value[:1] == "{" else "st_geogfromtext"
    register(SparkSession.active(), form)
    if isinstance(value, str):
        return F.call_function(form, F.unhex(F.lit(value)) if form == "st_geogfrombinary" else F.lit(value))
    return F.call_function(form, value)


__all__ = ["FUNCTIONS", "GEO", "call", "geography", "register"]
