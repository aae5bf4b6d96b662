"""The geography type and the SQL snippets that the ``st_*`` functions are made of.

A geography is a nested column that Catalyst sees through: its kind (1 point, 2 line, 3
polygon, 4 to 6 their multiples, 7 collection, 0 nothing at all), SRID, dimension flags (1 for
Z, 2 for M) and parts, each a point, a line or a polygon with its rings. Functions over it
are plain SQL expressions, so they take part in pruning and need no Python. Spark compiles them but for
the functions of arrays, whose lambdas it interprets. A null is a null; an empty geography has no parts.
"""

from __future__ import annotations

from itertools import count

POINT = "STRUCT<x: DOUBLE, y: DOUBLE, z: DOUBLE, m: DOUBLE>"
RING = f"ARRAY<{POINT}>"
PART = f"STRUCT<kind: INT, rings: ARRAY<{RING}>>"
PARTS = f"ARRAY<{PART}>"
GEO = f"STRUCT<kind: INT, srid: INT, flags: INT, parts: {PARTS}>"

#: Fixed values of WGS-84: half axes, flattening, mean radius; and the radius that clustering uses.
A, F_ = 6378137.0, 1 / 298.257223563
B = A - A * F_
R = (2 * A + B) / 3
CLUSTER_R = 6371008.8

_names = count()


def name() -> str:
    """A lambda variable that no other snippet uses."""
    return f"v{next(_names)}"


def let(value: str, use) -> str:
    """``use(variable)`` with ``value`` bound once to a variable."""
    v = name()
    return f"transform(array({value}), {v} -> {use(v)})[0]"


def each(array: str, use) -> str:
    v = name()
    return f"transform({array}, {v} -> {use(v)})"


def keep(array: str, test) -> str:
    v = name()
    return f"filter({array}, {v} -> {test(v)})"


def some(array: str, test) -> str:
    v = name()
    return f"exists({array}, {v} -> {test(v)})"


def every(array: str, test) -> str:
    v = name()
    return f"forall({array}, {v} -> {test(v)})"


def total(array: str, use=lambda v: v, zero: str = "0D") -> str:
    a, v = name(), name()
    return f"aggregate({array}, {zero}, ({a}, {v}) -> {a} + {use(v)})"


def rings(g: str) -> str:
    return f"flatten({each(f'{g}.parts', lambda p: f'{p}.rings')})"


def points(g: str) -> str:
    return f"flatten({rings(g)})"


def edges(ring: str) -> str:
    """The edges (a, b) of a ring or line, which must be a variable or column."""
    b, i = name(), name()
    return f"transform(slice({ring}, 2, greatest(size({ring}) - 1, 0)), ({b}, {i}) -> named_struct('a', {ring}[{i}], 'b', {b}))"


def all_edges(g: str) -> str:
    return f"flatten({each(rings(g), edges)})"


def segments(g: str) -> str:
    """All edges, and every point part as an edge of no length."""
    single = each(keep(f"flatten({each(keep(f'{g}.parts', lambda p: f'{p}.kind = 1'), lambda p: f'flatten({p}.rings)')})", lambda p: "true"), lambda p: f"named_struct('a', {p}, 'b', {p})")
    return f"concat({single}, {all_edges(g)})"


def point(x: str, y: str, z: str = "NULL", m: str = "NULL") -> str:
    return f"named_struct('x', CAST({x} AS DOUBLE), 'y', CAST({y} AS DOUBLE), 'z', CAST({z} AS DOUBLE), 'm', CAST({m} AS DOUBLE))"


def part(kind: str, rings_: str) -> str:
    return f"named_struct('kind', CAST({kind} AS INT), 'rings', {rings_})"


def geo(kind: str, parts: str, srid: str = "4326", flags: str = "0") -> str:
    return f"named_struct('kind', CAST({kind} AS INT), 'srid', CAST({srid} AS INT), 'flags', CAST({flags} AS INT), 'parts', CAST({parts} AS {PARTS}))"


NONE = f"CAST(array() AS {PARTS})"


def of_points(pts: str, srid: str = "4326", flags: str = "0") -> str:
    """The least kind of geography that holds some points."""
    one = each(pts, lambda p: part("1", f"array(array({p}))"))
    return geo(f"CASE WHEN size({pts}) = 1 THEN 1 ELSE 4 END", one, srid, flags)


def error(text: str) -> str:
    return f"raise_error('{text}')"


def same_point(a: str, b: str) -> str:
    return f"({a}.x = {b}.x AND {a}.y = {b}.y)"


def box(g: str) -> str:
    """xmin, ymin, xmax, ymax of a geography that is not empty."""
    return let(points(g), lambda p: f"named_struct('xmin', array_min({each(p, lambda v: f'{v}.x')}), 'ymin', array_min({each(p, lambda v: f'{v}.y')}), 'xmax', array_max({each(p, lambda v: f'{v}.x')}), 'ymax', array_max({each(p, lambda v: f'{v}.y')}))")


def empty(g: str) -> str:
    return f"(size({points(g)}) = 0)"
