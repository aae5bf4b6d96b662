"""Every ``st_*`` function as a SQL function: its arguments, its type and its expression."""

from __future__ import annotations

import re

from . import binary, overlay, plane, sphere, text, wkb
from .shape import (
    GEO,
    NONE,
    PARTS,
    POINT,
    R,
    all_edges,
    box,
    each,
    edges,
    empty,
    error,
    every,
    geo,
    keep,
    let,
    name,
    part,
    point,
    points,
    rings,
    same_point,
    segments,
    some,
    total,
)

Definition = tuple[str, str, str]
FUNCTIONS: dict[str, Definition] = {}


#: Longer bodies bind their geographies to variables, so that an argument that the optimiser puts in their place is computed once.
_LONG = 800


def _renamed(body: str, old: str, new: str) -> str:
    """``body`` with an argument by another name; texts in quotes and fields of that name stay."""
    return re.sub(rf"('[^']*')|(?<![\w.]){old}(?!\w)", lambda m: m[1] or new, body)


def define(fn: str, args: str, returns: str, body: str, short: tuple[str, str] | None = None) -> None:
    """``short``: a condition on the arguments as they are, and the short body that serves there."""
    if len(body) > _LONG:
        for g in re.findall(rf"(\w+) (?={re.escape(GEO)}|ARRAY<{re.escape(GEO)})", args):
            v = name()
            body = f"transform(array({g}), {v} -> {_renamed(body, g, v)})[0]"
    FUNCTIONS[fn] = (args, returns, f"CASE WHEN {short[0]} THEN {short[1]} ELSE {body} END" if short else body)


_NOTHING = geo("0", NONE)
_same_srid = lambda a, b, body: f"CASE WHEN {a} IS NULL OR {b} IS NULL THEN NULL WHEN {a}.kind > 0 AND {b}.kind > 0 AND {a}.srid <> {b}.srid THEN {error('Operation on mixed SRID geometries')} ELSE {body} END"
_first = lambda g: f"{g}.parts[0].rings[0][0]"
_is_point = lambda g: f"({g}.kind = 1 AND size({g}.parts) = 1)"
_one_line = lambda pts, srid, flags="0": geo("2", f"array({part('2', f'array({pts})')})", srid, flags)
_dot = lambda p, srid="4326", flags="0": geo("1", f"array({part('1', f'array(array({p}))')})", srid, flags)
_xy = lambda p: point(f"{p}.x", f"{p}.y")

# --- corners and boxes ------------------------------------------------------------------


def _corner_of(g: str, k: int) -> str:
    return f"get(get(get({g}.parts, 0).rings, 0), {k})"


def _upright(g: str) -> str:
    """Whether an area is a box with upright sides; no index raises an error, so Spark may look at terms in any order."""
    p = [_corner_of(g, k) for k in range(5)]
    way = lambda u, v: f"({p[0]}.{u} = {p[1]}.{u} AND {p[1]}.{v} = {p[2]}.{v} AND {p[2]}.{u} = {p[3]}.{u} AND {p[3]}.{v} = {p[0]}.{v})"
    sound = f"{same_point(p[0], p[4])} AND {p[0]}.x <> {p[2]}.x AND {p[0]}.y <> {p[2]}.y"
    return f"({g}.kind = 3 AND size({g}.parts) = 1 AND size(get({g}.parts, 0).rings) = 1 AND size(get(get({g}.parts, 0).rings, 0)) = 5 AND {sound} AND ({way('x', 'y')} OR {way('y', 'x')}))"


#: Two boxes with upright sides: no variables, so that Spark compiles the comparisons.
_two_boxes = f"{_upright('a')} AND {_upright('b')} AND a.srid = b.srid"
_low = lambda g, c: f"least({_corner_of(g, 0)}.{c}, {_corner_of(g, 2)}.{c})"
_high = lambda g, c: f"greatest({_corner_of(g, 0)}.{c}, {_corner_of(g, 2)}.{c})"
_meet = lambda than: "(" + " AND ".join(f"{_low(g, c)} {than} {_high(h, c)}" for c in "xy" for g, h in ("ab", "ba")) + ")"
_holds = lambda g, h: "(" + " AND ".join(f"{_low(g, c)} <= {_low(h, c)} AND {_high(g, c)} >= {_high(h, c)}" for c in "xy") + ")"

# --- constructors -----------------------------------------------------------------------

define("st_makepoint", "x DOUBLE, y DOUBLE, z DOUBLE DEFAULT NULL", GEO, f"CASE WHEN x IS NULL OR y IS NULL THEN NULL WHEN abs(x) <= 180.0000000001D AND abs(y) <= 90.0000000001D THEN {_dot(point('greatest(-180D, least(180D, x))', 'greatest(-90D, least(90D, y))', 'z'), flags='IF(z IS NULL, 0, 1)')} ELSE {error('Coordinate values were coerced into range')} END")
define("st_geogpoint", "x DOUBLE, y DOUBLE, z DOUBLE DEFAULT NULL", GEO, FUNCTIONS["st_makepoint"][2])


def _line_of(gs: str) -> str:
    """A line through the points and lines of an array. Where a line begins or ends, a place that repeats there is taken once; points that repeat are all kept."""
    v, i = name(), name()
    usable = keep(gs, lambda g: f"{g} IS NOT NULL AND {g}.kind IN (1, 2, 4)")
    runs = keep(each(usable, lambda g: f"named_struct('line', {g}.kind = 2, 'p', {points(g)})"), lambda m: f"size({m}.p) > 0")
    # only the first place of a member can repeat the last one of the member before
    before = lambda m: f"{m}[{i} - 1]"
    joined = lambda m: f"flatten(transform({m}, ({v}, {i}) -> CASE WHEN {i} = 0 THEN {v}.p WHEN ({v}.line OR {before(m)}.line) AND {before(m)}.p[size({before(m)}.p) - 1] = {v}.p[0] THEN slice({v}.p, 2, size({v}.p) - 1) ELSE {v}.p END))"
    flags = f"coalesce(array_max({each(usable, lambda g: f'{g}.flags')}), 0)"
    srid = f"coalesce({usable}[0].srid, 4326)"
    return let(runs, lambda m: f"CASE WHEN size({m}) = 0 THEN {geo('2', NONE)} ELSE {_one_line(joined(m), srid, flags)} END")


_bad_member = lambda g: f"{g}.kind NOT IN (0, 1, 2)"
define("st_makeline", f"a {GEO}, b {GEO}", GEO, _same_srid("a", "b", f"CASE WHEN a.kind = 0 OR b.kind = 0 THEN {_NOTHING} WHEN {_bad_member('a')} OR {_bad_member('b')} THEN {error('ST_MakeLine: only points and lines')} ELSE {_line_of('array(a, b)')} END"))
define("st_makeline_list", f"gs ARRAY<{GEO}>", GEO, f"CASE WHEN gs IS NULL THEN NULL ELSE {_line_of('gs')} END")
_ring_ok = lambda g: f"{g}.kind = 2 AND size({g}.parts) = 1 AND size({g}.parts[0].rings[0]) >= 4 AND {same_point(f'{g}.parts[0].rings[0][0]', f'{g}.parts[0].rings[0][size({g}.parts[0].rings[0]) - 1]')}"
define("st_makepolygon", f"shell {GEO}, holes ARRAY<{GEO}> DEFAULT array()", GEO, f"CASE WHEN shell IS NULL OR holes IS NULL THEN NULL WHEN shell.kind = 0 THEN {_NOTHING} WHEN NOT ({_ring_ok('shell')}) OR {some('holes', lambda h: f'NOT ({_ring_ok(h)})')} THEN {error('shell and holes must be closed lines of four points at least')} ELSE {geo('3', f'array({part("3", f"concat(array(shell.parts[0].rings[0]), {each('holes', lambda h: f'{h}.parts[0].rings[0]')})")})', 'shell.srid', 'shell.flags')} END")

# --- formatters and parsers -------------------------------------------------------------

define("st_asewkb", f"g {GEO}", "BINARY", binary.as_binary("g", True))
define("st_aswkb", f"g {GEO}, form STRING DEFAULT 'ndr'", "BINARY", f"CASE WHEN g IS NULL OR form IS NULL THEN NULL WHEN form = '' THEN {binary.as_binary('g', True)} ELSE {binary.as_binary('g', False, "lower(form) LIKE 'xdr%'")} END")
define("st_astext", f"g {GEO}, digits INT DEFAULT 15", "STRING", f"CASE WHEN g IS NULL THEN NULL ELSE {text.as_text('g', 'digits')} END")
define("st_asgeojson", f"g {GEO}, digits INT DEFAULT 15", "STRING", f"CASE WHEN g IS NULL THEN NULL ELSE {text.as_json('g', 'digits')} END")


def _hash(g: str, precision: str) -> str:
    def of(b: str) -> str:
        x, y = f"(({b}.xmin + {b}.xmax) / 2)", f"(({b}.ymin + {b}.ymax) / 2)"
        letters = f"CASE WHEN {b}.xmin = {b}.xmax AND {b}.ymin = {b}.ymax THEN 20 ELSE {text.shared_letters(b)} END"
        return let(f"named_struct('n', IF({precision} <= 0, {letters}, {precision}), 'x', {x}, 'y', {y})", lambda k: text.geohash(f"{k}.x", f"{k}.y", f"{k}.n"))

    return f"CASE WHEN {g} IS NULL THEN NULL WHEN {empty(g)} THEN '' ELSE {let(box(g), of)} END"


#: A point and a number of letters: no variables, so that Spark compiles the letters.
_at = [f"{_corner_of('g', 0)}.{c}" for c in "xy"]
define("st_geohash", f"g {GEO}, digits INT DEFAULT 0", "STRING", _hash("g", "digits"), (f"g.kind = 1 AND size(g.parts) = 1 AND {text.short_geohash(*_at, 'digits')}", text.letters_of(*_at, "digits")))
_parsed = lambda t, body: f"CASE WHEN {t} IS NULL THEN NULL WHEN {t} = '' THEN {_NOTHING} ELSE {body} END"
define("st_geogfromtext", "t STRING", GEO, _parsed("t", let("t", text.from_text)))
_from_bytes = lambda b: f"CASE WHEN {b} IS NULL THEN NULL WHEN length({b}) = 0 THEN {_NOTHING} ELSE {let(f'hex({b})', wkb.from_hex)} END"
define("st_geogfrombinary", "b BINARY", GEO, _from_bytes("b"))
define("st_geomfrombinary", "b BINARY", GEO, _from_bytes("b"))
define("st_geogfrom", "t STRING", GEO, _parsed("t", f"CASE substr(t, 1, 1) WHEN '0' THEN {let('upper(t)', wkb.from_hex)} WHEN '{{' THEN {let('t', text.from_json)} ELSE {let('t', text.from_text)} END"))
define("st_geomfromtext", "t STRING", GEO, FUNCTIONS["st_geogfromtext"][2])
define("st_geogfromgeojson", "t STRING", GEO, _parsed("t", let("t", text.from_json)))
define("st_geomfromgeojson", "t STRING", GEO, FUNCTIONS["st_geogfromgeojson"][2])


def _cell(h: str, precision: str) -> str:
    def polygon(c: str) -> str:
        corner = lambda x, y: point(f"{c}.{x}", f"{c}.{y}")
        return geo("3", f"array({part('3', f'array(array({corner("a", "c")}, {corner("a", "d")}, {corner("b", "d")}, {corner("b", "c")}, {corner("a", "c")}))')})", "0")

    return f"CASE WHEN {h} IS NULL THEN NULL WHEN {h} = '' THEN {_NOTHING} ELSE {let(text.geohash_box(h, precision), polygon)} END"


define("st_geomfromgeohash", "h STRING, digits INT DEFAULT -1", GEO, _cell("h", "digits"))
define("st_geogpointfromgeohash", "h STRING, digits INT DEFAULT -1", GEO, f"CASE WHEN h IS NULL THEN NULL WHEN h = '' THEN {_NOTHING} ELSE {let(text.geohash_box('h', 'digits'), lambda c: _dot(point(f'({c}.a + {c}.b) / 2', f'({c}.c + {c}.d) / 2')))} END")

# --- accessors --------------------------------------------------------------------------

define("st_dimension", f"g {GEO}", "INT", f"CASE WHEN g IS NULL THEN NULL WHEN g.kind = 7 THEN coalesce(array_max({each('g.parts', lambda p: f'{p}.kind - 1')}), 0) ELSE array(-1, 0, 1, 2, 0, 1, 2)[g.kind] END")
_as_geo = lambda p, g: geo(f"{p}.kind", f"array({p})", f"{g}.srid", f"{g}.flags")
define("st_dump", f"g {GEO}", f"ARRAY<{GEO}>", f"CASE WHEN g IS NULL THEN NULL ELSE {each('g.parts', lambda p: _as_geo(p, 'g'))} END")
for fn, place in (("st_startpoint", "g.parts[0].rings[0][0]"), ("st_endpoint", "g.parts[0].rings[0][size(g.parts[0].rings[0]) - 1]")):
    define(fn, f"g {GEO}", GEO, f"CASE WHEN g.kind = 0 THEN {_NOTHING} WHEN g.kind = 2 AND size(g.parts) = 1 THEN {_dot(place, 'g.srid', 'g.flags')} END")
define("st_geometrytype", f"g {GEO}", "STRING", f"CASE WHEN g IS NULL THEN NULL WHEN g.kind = 0 THEN '' ELSE concat('ST_', array({', '.join(repr(k) for k in text.KIND_NAMES)})[g.kind]) END")
_closed = lambda r: f"({r}[0].x = {r}[size({r}) - 1].x AND {r}[0].y = {r}[size({r}) - 1].y AND {r}[0].z <=> {r}[size({r}) - 1].z)"
define("st_isclosed", f"g {GEO}", "BOOLEAN", f"CASE WHEN g IS NULL THEN NULL WHEN {empty('g')} THEN false ELSE {every(rings('g'), _closed)} END")
define("st_iscollection", f"g {GEO}", "BOOLEAN", "g.kind >= 4")
define("st_isempty", f"g {GEO}", "BOOLEAN", f"CASE WHEN g IS NULL THEN NULL ELSE {empty('g')} END")
define("st_isring", f"g {GEO}", "BOOLEAN", f"CASE WHEN g IS NULL THEN NULL WHEN g.kind = 0 THEN true WHEN g.kind <> 2 OR size(g.parts) = 0 THEN false ELSE {let('g.parts[0].rings[0]', lambda r: f'({_closed(r)} AND NOT {plane.self_crossing(r)})')} END")
define("st_npoints", f"g {GEO}", "INT", f"CASE WHEN g IS NULL THEN NULL ELSE size({points('g')}) END")
define("st_numgeometries", f"g {GEO}", "INT", f"CASE WHEN g IS NULL THEN NULL ELSE size(g.parts) END")
define("st_numpoints", f"g {GEO}", "INT", f"CASE WHEN g IS NULL THEN NULL WHEN g.kind = 2 THEN size({points('g')}) ELSE 0 END")
define("st_pointn", f"g {GEO}, n INT", GEO, f"CASE WHEN g IS NULL OR n IS NULL THEN NULL WHEN g.kind = 0 THEN {_NOTHING} WHEN g.kind = 2 AND size(g.parts) = 1 THEN {let('IF(n > 0, n, n + size(g.parts[0].rings[0]) + 1)', lambda k: f'IF({k} BETWEEN 1 AND size(g.parts[0].rings[0]), {_dot(f"g.parts[0].rings[0][{k} - 1]", "g.srid", "g.flags")}, NULL)')} END")
for fn, axis in (("st_x", "x"), ("st_y", "y")):
    define(fn, f"g {GEO}", "DOUBLE", f"CASE WHEN g IS NULL THEN NULL WHEN g.kind = 0 THEN 0D WHEN g.kind <> 1 THEN {error('Argument to ST_X and ST_Y must be a point')} WHEN {_corner_of('g', 0)} IS NULL THEN 0D ELSE {_corner_of('g', 0)}.{axis} END")

# --- measures ---------------------------------------------------------------------------

_apart = lambda p, q, on: f"IF({on}, {sphere.spheroid(p, q)}, {sphere.hav(p, q)})"


def _distance(a: str, b: str, on: str) -> str:
    inside = f"(({plane.solid(a)} AND {some(points(b), lambda p: f'{plane.where(p, a)} > 0')}) OR ({plane.solid(b)} AND {some(points(a), lambda p: f'{plane.where(p, b)} > 0')}))"
    general = f"CASE WHEN {inside} OR {sphere.crossing(a, b)} THEN 0D ELSE {let(sphere.nearest_pair(a, b), lambda k: _apart(f'{k}.p', f'{k}.q', on))} END"
    return f"CASE WHEN {a}.kind = 0 OR {b}.kind = 0 THEN 0D WHEN {empty(a)} OR {empty(b)} THEN {error('NULL VALUE')} WHEN {_is_point(a)} AND {_is_point(b)} THEN {_apart(_first(a), _first(b), on)} ELSE {general} END"


#: Two points on the sphere: no variables, so that Spark compiles the formula.
_two_points = f"{_is_point('a')} AND {_is_point('b')} AND a.srid = b.srid AND NOT use_spheroid"
_sphere = sphere.hav(_first("a"), _first("b"))
define("st_distance", f"a {GEO}, b {GEO}, use_spheroid BOOLEAN DEFAULT false", "DOUBLE", _same_srid("a", "b", let(_distance("a", "b", "use_spheroid"), sphere.rounded)), (_two_points, sphere.rounded(_sphere)))
define("st_dwithin", f"a {GEO}, b {GEO}, d DOUBLE, use_spheroid BOOLEAN DEFAULT false", "BOOLEAN", _same_srid("a", "b", f"CASE WHEN d IS NULL THEN NULL WHEN a.kind = 0 AND b.kind = 0 THEN true WHEN {empty('a')} OR {empty('b')} THEN false ELSE {_distance('a', 'b', 'use_spheroid')} <= d END"), (f"{_two_points} AND d IS NOT NULL", f"{_sphere} <= d"))
define("st_maxdistance", f"a {GEO}, b {GEO}, use_spheroid BOOLEAN DEFAULT true", "DOUBLE", _same_srid("a", "b", f"CASE WHEN a.kind = 0 OR b.kind = 0 THEN 0D WHEN {empty('a')} OR {empty('b')} THEN {error('NULL VALUE')} ELSE {let(sphere.farthest('a', 'b'), sphere.rounded)} END"))
_lines = lambda g, on, kinds: total(keep(f"{g}.parts", lambda p: f"{p}.kind IN ({kinds})"), lambda p: total(f"{p}.rings", lambda r: sphere.line_length(r, on, f"{g}.flags")))
define("st_length", f"g {GEO}, use_spheroid BOOLEAN DEFAULT false", "DOUBLE", f"CASE WHEN g IS NULL THEN NULL WHEN g.kind IN (2, 5) THEN {_lines('g', 'use_spheroid', '2')} WHEN g.kind = 7 THEN {_lines('g', 'use_spheroid', '2, 3')} ELSE 0D END")
define("st_perimeter", f"g {GEO}, use_spheroid BOOLEAN DEFAULT false", "DOUBLE", f"CASE WHEN g IS NULL THEN NULL WHEN g.kind IN (3, 6, 7) THEN {_lines('g', 'use_spheroid', '2, 3')} ELSE 0D END")
_ring_sum = lambda p, area: let(f"{p}.rings", lambda rs: f"{let(f'{rs}[0]', area)} - {total(f'slice({rs}, 2, greatest(size({rs}) - 1, 0))', area)}")
_areas = lambda area: total(keep("g.parts", lambda p: f"{p}.kind = 3"), lambda p: _ring_sum(p, area))
define("st_area", f"g {GEO}, use_spheroid BOOLEAN DEFAULT false", "DOUBLE", f"CASE WHEN g IS NULL THEN NULL WHEN use_spheroid THEN {_areas(sphere.authalic_area)} ELSE {_areas(sphere.ring_area)} END")
define("st_azimuth", f"a {GEO}, b {GEO}", "DOUBLE", _same_srid("a", "b", f"CASE WHEN a.kind = 0 OR b.kind = 0 THEN 0D WHEN {_is_point('a')} AND {_is_point('b')} THEN {sphere.azimuth(_first('a'), _first('b'))} END"))
_bearing = lambda p, q: f"atan2({q}.x - {p}.x, {q}.y - {p}.y)"
_turn = lambda u, v: let(f"{v} - {u}", lambda d: f"pmod({d}, 2 * pi())")
_same = lambda p, q: same_point(p, q)
_end = lambda g: f"{g}.parts[0].rings[0][size({g}.parts[0].rings[0]) - 1]"
define("st_angle", f"a {GEO}, b {GEO}, c {GEO} DEFAULT NULL, d {GEO} DEFAULT NULL", "DOUBLE", (
    f"CASE WHEN a IS NULL OR b IS NULL THEN NULL WHEN a.kind = 0 OR b.kind = 0 THEN 0D "
    f"WHEN c IS NULL AND a.kind = 2 AND b.kind = 2 AND size(a.parts) = 1 AND size(b.parts) = 1 THEN IF({_same(_first('a'), _end('a'))} OR {_same(_first('b'), _end('b'))}, 0D, {_turn(_bearing(_first('a'), _end('a')), _bearing(_first('b'), _end('b')))}) "
    f"WHEN NOT ({_is_point('a')} AND {_is_point('b')} AND {_is_point('c')}) THEN {error('ST_Angle: points or two lines are asked for')} "
    f"WHEN d IS NULL OR size(d.parts) = 0 THEN IF({_same(_first('a'), _first('b'))} OR {_same(_first('b'), _first('c'))}, 0D, {_turn(_bearing(_first('b'), _first('a')), _bearing(_first('b'), _first('c')))}) "
    f"ELSE IF({_same(_first('a'), _first('b'))} OR {_same(_first('c'), _first('d'))}, 0D, {_turn(_bearing(_first('a'), _first('b')), _bearing(_first('c'), _first('d')))}) END"
))


def _envelope(g: str) -> str:
    def of(b: str) -> str:
        corner = lambda x, y: point(f"{b}.{x}", f"{b}.{y}")
        ring = f"array({corner('xmin', 'ymin')}, {corner('xmin', 'ymax')}, {corner('xmax', 'ymax')}, {corner('xmax', 'ymin')}, {corner('xmin', 'ymin')})"
        return f"CASE WHEN {b}.xmin = {b}.xmax AND {b}.ymin = {b}.ymax THEN {_dot(corner('xmin', 'ymin'), f'{g}.srid')} WHEN {b}.xmin = {b}.xmax OR {b}.ymin = {b}.ymax THEN {_one_line(f'array({corner("xmin", "ymin")}, {corner("xmax", "ymax")})', f'{g}.srid')} ELSE {geo('3', f'array({part("3", f"array({ring})")})', f'{g}.srid')} END"

    return f"CASE WHEN {g} IS NULL THEN NULL WHEN {empty(g)} THEN {g} ELSE {let(box(g), of)} END"


define("st_boundingbox", f"g {GEO}", GEO, _envelope("g"))
define("st_envelope", f"g {GEO}", GEO, _envelope("g"))
define("st_makebox", "xmin DOUBLE, ymin DOUBLE, xmax DOUBLE, ymax DOUBLE", GEO, f"CASE WHEN xmin IS NULL OR ymin IS NULL OR xmax IS NULL OR ymax IS NULL THEN NULL ELSE {geo('3', f'array({part("3", f"array(array({point('xmin', 'ymin')}, {point('xmin', 'ymax')}, {point('xmax', 'ymax')}, {point('xmax', 'ymin')}, {point('xmin', 'ymin')}))")})')} END")
_all = lambda gs: let(keep(gs, lambda g: f"{g} IS NOT NULL AND {g}.kind > 0"), lambda u: f"CASE WHEN size({u}) = 0 THEN {_NOTHING} ELSE {geo('7', f'flatten({each(u, lambda g: f"{g}.parts")})', f'{u}[0].srid')} END")
define("st_extent", f"gs ARRAY<{GEO}>", GEO, f"CASE WHEN gs IS NULL THEN NULL ELSE {let(_all('gs'), _envelope)} END")

# --- transformations --------------------------------------------------------------------


def _boundary(g: str) -> str:
    outline = each(rings(g), lambda r: part("2", f"array({r})"))
    ends = f"flatten({each(keep(f'{g}.parts', lambda p: f'NOT {_closed(f"{p}.rings[0]")}'), lambda p: f'array({p}.rings[0][0], {p}.rings[0][size({p}.rings[0]) - 1])')})"
    odd = lambda e: let(e, lambda v: keep(f"array_distinct({v})", lambda p: f"size({keep(v, lambda q: f'{q}.x = {p}.x AND {q}.y = {p}.y')}) % 2 = 1"))
    dots = let(odd(ends), lambda o: geo("4", each(o, lambda p: part("1", f"array(array({p}))")), f"{g}.srid", f"{g}.flags"))
    return f"CASE WHEN {g} IS NULL THEN NULL WHEN {g}.kind = 0 THEN {_NOTHING} WHEN {empty(g)} THEN {error('boundary of nothing')} WHEN {g}.kind IN (1, 4) THEN {geo('7', NONE, f'{g}.srid')} WHEN {g}.kind IN (2, 5) THEN {dots} WHEN {g}.kind IN (3, 6) THEN {let(outline, lambda o: geo(f'IF(size({o}) = 1, 2, 5)', o, f'{g}.srid', f'{g}.flags'))} ELSE {error('boundary of a collection')} END"


define("st_boundary", f"g {GEO}", GEO, _boundary("g"))
define("st_centroid", f"g {GEO}, use_spheroid BOOLEAN DEFAULT true", GEO, f"CASE WHEN g IS NULL THEN NULL WHEN g.kind = 0 THEN {_NOTHING} WHEN {empty('g')} THEN {geo('7', NONE)} WHEN g.kind = 7 THEN {error('centroid of a collection')} WHEN g.kind = 1 THEN g ELSE {let(sphere.centroid('g'), lambda c: _dot(_xy(c), 'g.srid'))} END")


def _closest(a: str, b: str) -> str:
    """The first point of a part of one in the area of the other, which is common to both; else the nearest point of a's edges."""
    firsts = lambda g, area: f"IF({plane.solid(area)}, {keep(each(f'{g}.parts', lambda p: f'{p}.rings[0][0]'), lambda p: f'{plane.where(p, area)} > 0')}, CAST(array() AS ARRAY<{POINT}>))"
    nearest = let(plane.closest(a, b, segments(a), segments(b)), lambda k: _dot(_xy(f"{k}.p"), f"{a}.srid"))
    return let(f"concat({firsts(a, b)}, {firsts(b, a)})", lambda c: f"CASE WHEN size({c}) > 0 THEN {_dot(_xy(f'{c}[0]'), f'{a}.srid')} ELSE {nearest} END")


define("st_closestpoint", f"a {GEO}, b {GEO}", GEO, _same_srid("a", "b", f"CASE WHEN a.kind = 0 OR b.kind = 0 THEN {_NOTHING} WHEN {empty('a')} OR {empty('b')} THEN NULL ELSE {_closest('a', 'b')} END"))
define("st_convexhull", f"g {GEO}", GEO, f"CASE WHEN g IS NULL THEN NULL WHEN {empty('g')} THEN {_NOTHING} ELSE {let(plane.hull(points('g')), lambda h: let(each(h, _xy), lambda ps: f'CASE size({ps}) WHEN 1 THEN {_dot(f"{ps}[0]", "g.srid")} WHEN 2 THEN {_one_line(ps, "g.srid")} ELSE {geo("3", f"array({part('3', f'array({ps})')})", "g.srid")} END'))} END")
_thin = lambda p, r: let(plane.simplified(r, "tolerance"), lambda s: s)
_simple_part = lambda p: part(f"{p}.kind", f"CASE {p}.kind WHEN 1 THEN {p}.rings WHEN 2 THEN {each(f'{p}.rings', lambda r: _thin(p, r))} ELSE {keep(each(f'{p}.rings', lambda r: _thin(p, r)), lambda r: f'size({r}) >= 4')} END")
define("st_simplify", f"g {GEO}, tolerance DOUBLE", GEO, f"CASE WHEN g IS NULL OR tolerance IS NULL THEN NULL WHEN g.kind IN (0, 1, 4) THEN g ELSE {let(keep(each('g.parts', _simple_part), lambda p: f'size({p}.rings) > 0'), lambda ps: f'CASE WHEN size({ps}) = 0 THEN {_NOTHING} ELSE {geo("g.kind", ps, "g.srid", "g.flags")} END')} END")


def _snapped(g: str, size: str) -> str:
    snap = lambda p: point(f"rint({p}.x / {size}) * {size}", f"rint({p}.y / {size}) * {size}", f"{p}.z", f"{p}.m")

    def ring(r: str) -> str:
        b, i = name(), name()
        return let(each(r, snap), lambda s: f"concat(slice({s}, 1, 1), filter(slice({s}, 2, greatest(size({s}) - 1, 0)), ({b}, {i}) -> {b}.x <> {s}[{i}].x OR {b}.y <> {s}[{i}].y OR NOT ({b}.z <=> {s}[{i}].z)))")

    least = lambda p: f"CASE {p}.kind WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 4 END"
    parts = keep(each(f"{g}.parts", lambda p: part(f"{p}.kind", keep(each(f"{p}.rings", ring), lambda r: f"size({r}) >= {least(p)}"))), lambda p: f"size({p}.rings) > 0")
    return f"CASE WHEN {g} IS NULL OR {size} IS NULL THEN NULL WHEN {g}.kind = 0 OR {size} = 0 THEN {g} ELSE {geo(f'{g}.kind', parts, f'{g}.srid', f'{g}.flags')} END"


define("st_snaptogrid", f"g {GEO}, size DOUBLE", GEO, _snapped("g", "size"))
_circle = lambda p, n: each(f"sequence(0, 4 * {n})", lambda k: point(f"{p}.x + radius * cos(-pi() * ({k} % (4 * {n})) / (2 * {n}))", f"{p}.y + radius * sin(-pi() * ({k} % (4 * {n})) / (2 * {n}))"))
_corner = lambda p, i, j: point(f"{p}.x {i} radius", f"{p}.y {j} radius")
_square = lambda p: f"array({', '.join(_corner(p, i, j) for i, j in ('++', '+-', '--', '-+', '++'))})"
#: The parameters of a buffer, or a number of segments alone.
_STYLE = "^ *([0-9]+|((quad_segs=[0-9]+|join=(round|mitre|miter|bevel)|endcap=(round|flat|butt|square)|mit(re|er)_limit=[0-9.]+|side=(both|left|right))( +|$))*)$"
_segs = "coalesce(try_cast(style AS INT), try_cast(regexp_extract(style, 'quad_segs=([0-9]+)', 1) AS INT), 8)"
_around = lambda p: f"IF(contains(style, 'endcap=square'), {_square(p)}, {let(_segs, lambda n: _circle(p, n))})"
define("st_buffer", f"g {GEO}, radius DOUBLE, style STRING DEFAULT ''", GEO, f"CASE WHEN g IS NULL OR radius IS NULL OR style IS NULL THEN NULL WHEN NOT style RLIKE '{_STYLE}' THEN {error('parameters of a buffer that are not known')} WHEN g.kind = 0 THEN {_NOTHING} WHEN {empty('g')} OR (g.kind = 1 AND (radius <= 0 OR style RLIKE 'endcap=(flat|butt)')) THEN {geo('3', NONE, 'g.srid')} WHEN {_is_point('g')} THEN {geo('3', f'array({part("3", f"array({_around(_first('g'))})")})', 'g.srid')} ELSE {error('st_buffer takes points: use operators.buffer for lines, areas and more points than one')} END")


def _sifted(inside: bool) -> str:
    """Points and lines of ``a`` inside (or outside) of ``b``."""
    sign = ">" if inside else "="
    dots = keep("a.parts", lambda p: f"{p}.kind = 1 AND {plane.where(f'{p}.rings[0][0]', 'b')} {sign} 0")
    runs = each(keep(plane.pieces("a", "b"), lambda s: f"{s}.w {sign} 0"), lambda s: part("2", f"array(array({s}.p, {s}.q))"))
    point_kind = lambda ps: geo(f"CASE size({ps}) WHEN 1 THEN 1 WHEN 0 THEN IF(a.kind = 1, 1, 7) ELSE 4 END", ps, "a.srid")
    line_kind = lambda ps: geo(f"CASE size({ps}) WHEN 1 THEN 2 WHEN 0 THEN 2 ELSE 5 END", ps, "a.srid")
    close = lambda p, q: f"(abs({p}.x - {q}.x) <= 1e-9D AND abs({p}.y - {q}.y) <= 1e-9D)"

    def touched(k: str) -> str:
        """The places in common that no piece in common has: ends of pieces outside of ``b`` that were cut there or lie on it, and points of ``b``."""
        ends = keep(f"array_distinct(flatten({each(f'{k}.out', lambda s: f'array({_xy(f"{s}.p")}, {_xy(f"{s}.q")})')}))", lambda e: f"(NOT {some(points('a'), lambda v: f'{v}.x = {e}.x AND {v}.y = {e}.y')} OR {plane.where(e, 'b')} > 0)")
        spots = keep(each(keep("b.parts", lambda p: f"{p}.kind = 1"), lambda p: _xy(f"{p}.rings[0][0]")), lambda p: f"{plane.where(p, 'a')} > 0")
        alone = keep(f"concat({spots}, {ends})", lambda e: f"NOT {some(f'{k}.held', lambda s: f'({close(f"{s}.p", e)} OR {close(f"{s}.q", e)})')}")
        p, i = name(), name()
        return let(alone, lambda d: f"filter({d}, ({p}, {i}) -> NOT {some(f'slice({d}, 1, {i})', lambda q: close(p, q))})")

    def common(k: str) -> str:
        lines = each(f"{k}.held", lambda s: part("2", f"array(array({s}.p, {s}.q))"))
        both = lambda m: f"CASE WHEN size({m}.dots) = 0 THEN {line_kind(f'{m}.lines')} WHEN size({m}.lines) = 0 THEN {point_kind(f'{m}.dots')} ELSE {geo('7', f'concat({m}.dots, {m}.lines)', 'a.srid')} END"
        return let(f"named_struct('lines', CAST({lines} AS {PARTS}), 'dots', CAST({each(touched(k), lambda p: part('1', f'array(array({p}))'))} AS {PARTS}))", both)

    held = let(plane.pieces("a", "b"), lambda s: let(f"named_struct('held', {keep(s, lambda v: f'{v}.w > 0')}, 'out', {keep(s, lambda v: f'{v}.w = 0')})", common))
    return f"CASE WHEN {plane.only_points('a')} THEN {let(f'array_distinct({dots})', point_kind)} ELSE {held if inside else let(runs, line_kind)} END"


def _clipped() -> str:
    """A polygon cut by the edges of a convex one, one after the other."""
    ring, e = name(), name()

    def clip(r: str, c: str) -> str:
        side = lambda p: f"({plane.cross(f'{c}.a', f'{c}.b', p)} * sign_)"

        def step(u: str) -> str:
            hit = lambda d: point(f"{u}.a.x + ({u}.b.x - {u}.a.x) * {d}", f"{u}.a.y + ({u}.b.y - {u}.a.y) * {d}")
            sa, sb = side(f"{u}.a").replace(" * sign_", f" * {c}.s"), side(f"{u}.b").replace(" * sign_", f" * {c}.s")
            at = f"({sa} / ({sa} - {sb}))"
            return f"CASE WHEN {sa} >= 0 AND {sb} >= 0 THEN array({_xy(f'{u}.b')}) WHEN {sa} >= 0 THEN array({hit(at)}) WHEN {sb} >= 0 THEN array({hit(at)}, {_xy(f'{u}.b')}) ELSE CAST(array() AS ARRAY<{POINT}>) END"

        made = f"flatten({each(edges(r), step)})"
        return let(made, lambda m: f"IF(size({m}) = 0, {m}, concat({m}, array({m}[0])))")

    turn = lambda r: f"signum({total(edges(r), lambda s: f'({s}.a.x * {s}.b.y - {s}.b.x * {s}.a.y)')})"
    cutters = let("b.parts[0].rings[0]", lambda r: let(turn(r), lambda s: each(edges(r), lambda q: f"named_struct('a', {q}.a, 'b', {q}.b, 's', {s})")))
    run = let("a.parts[0].rings[0]", lambda r: f"aggregate({cutters}, {each(r, _xy)}, ({ring}, {e}) -> {clip(ring, e)})")
    tidy = lambda r: f"filter({r}, (p9, i9) -> i9 = 0 OR p9.x <> {r}[i9 - 1].x OR p9.y <> {r}[i9 - 1].y)"

    def made(t: str) -> str:
        """What is left: an area, the line or point of two borders that merely meet, or nothing."""
        low, high = f"array_min({t})", f"array_max({t})"
        flat = lambda k: every(t, lambda p: f"{plane.cross(f'{k}.p', f'{k}.q', p)} = 0")
        kinds = lambda k: f"CASE WHEN {k}.p.x = {k}.q.x AND {k}.p.y = {k}.q.y THEN {_dot(_xy(f'{k}.p'), 'a.srid')} WHEN {flat(k)} THEN {_one_line(f'array({_xy(f"{k}.p")}, {_xy(f"{k}.q")})', 'a.srid')} ELSE {geo('3', f'array({part("3", f"array({t})")})', 'a.srid')} END"
        return f"IF(size({t}) = 0, {geo('3', NONE, 'a.srid')}, {let(f"named_struct('p', {low}, 'q', {high})", kinds)})"

    return let(run, lambda r: let(tidy(r), made))


_convex = lambda g: let(f"{g}.parts[0].rings[0]", lambda r: let(edges(r), lambda es: f"abs({total(f'transform({es}, (e8, i8) -> signum((e8.b.x - e8.a.x) * ({es}[(i8 + 1) % size({es})].b.y - e8.b.y) - (e8.b.y - e8.a.y) * ({es}[(i8 + 1) % size({es})].b.x - e8.b.x)))')}) = size({es})"))
_plain = lambda g: f"({g}.kind = 3 AND size({g}.parts[0].rings) = 1)"
_open = error("this pair of areas can not be overlaid yet")


def _shared_box() -> str:
    """What two boxes with upright sides share: the first one's corners moved into the other, the line or point of borders that merely meet, or nothing."""
    sides = ", ".join(f"'{c}0', greatest({_low('a', c)}, {_low('b', c)}), '{c}1', least({_high('a', c)}, {_high('b', c)})" for c in "xy")

    def of(k: str) -> str:
        moved = lambda p: point(*(f"greatest({k}.{c}0, least({k}.{c}1, {p}.{c}))" for c in "xy"))
        p, q = point(f"{k}.x0", f"{k}.y0"), point(f"{k}.x1", f"{k}.y1")
        area = geo("3", f"array({part('3', f'array({each("get(get(a.parts, 0).rings, 0)", moved)})')})", "a.srid")
        return f"CASE WHEN {k}.x0 > {k}.x1 OR {k}.y0 > {k}.y1 THEN {geo('3', NONE, 'a.srid')} WHEN {k}.x0 < {k}.x1 AND {k}.y0 < {k}.y1 THEN {area} WHEN {k}.x0 = {k}.x1 AND {k}.y0 = {k}.y1 THEN {_dot(p, 'a.srid')} ELSE {_one_line(f'array({p}, {q})', 'a.srid')} END"

    return let(f"named_struct({sides})", of)


define("st_intersection", f"a {GEO}, b {GEO}", GEO, _same_srid("a", "b", f"CASE WHEN a.kind = 0 OR b.kind = 0 THEN {_NOTHING} WHEN {empty('a')} THEN a WHEN {empty('b')} THEN b WHEN NOT {plane.solid('a')} AND (a.kind <> 7) THEN {_sifted(True)} WHEN {_plain('a')} AND {_plain('b')} AND {_convex('b')} AND {_convex('a')} THEN {_clipped()} WHEN {plane.covers('b', 'a')} THEN a WHEN {plane.covers('a', 'b')} THEN b ELSE {_open} END"), (_two_boxes, _shared_box()))
define("st_difference", f"a {GEO}, b {GEO}", GEO, _same_srid("a", "b", f"CASE WHEN a.kind = 0 THEN b WHEN b.kind = 0 THEN a WHEN {empty('a')} OR {empty('b')} THEN a WHEN NOT {plane.solid('a')} AND (a.kind <> 7) THEN {_sifted(False)} WHEN NOT {plane.solid('b')} OR NOT {plane.intersects('a', 'b')} THEN a WHEN {plane.covers('b', 'a')} THEN {geo('3', NONE, 'a.srid')} ELSE {_open} END"))


def _union(gs: str) -> str:
    kind = lambda ps: f"CASE WHEN {every(ps, lambda p: f'{p}.kind = 1')} THEN IF(size({ps}) = 1, 1, 4) WHEN {every(ps, lambda p: f'{p}.kind = 2')} THEN IF(size({ps}) = 1, 2, 5) WHEN {every(ps, lambda p: f'{p}.kind = 3')} THEN IF(size({ps}) = 1, 3, 6) ELSE 7 END"
    return let(f"array_distinct(flatten({each(gs, lambda g: f'{g}.parts')}))", lambda ps: geo(kind(ps), ps, f"{gs}[0].srid"))


define("st_union", f"a {GEO}, b {GEO}", GEO, _same_srid("a", "b", f"CASE WHEN a.kind = 0 OR b.kind = 0 THEN {_NOTHING} WHEN {empty('a')} THEN b WHEN {empty('b')} THEN a WHEN {plane.only_points('a')} AND {plane.only_points('b')} OR NOT {plane.intersects('a', 'b')} THEN {let('array(a, b)', _union)} WHEN {plane.covers('a', 'b')} THEN a WHEN {plane.covers('b', 'a')} THEN b ELSE {_open} END"))
define("st_union_list", f"gs ARRAY<{GEO}>", GEO, f"CASE WHEN gs IS NULL THEN NULL ELSE {let(keep('gs', lambda g: f'{g} IS NOT NULL AND {g}.kind > 0'), lambda u: f'CASE size({u}) WHEN 0 THEN {_NOTHING} WHEN 1 THEN {u}[0] ELSE IF({every(u, plane.only_points)}, {_union(u)}, {_open}) END')} END")

def _overlay(fn: str, nothing: str, a_empty: str, b_empty: str, body: str) -> None:
    mixed = lambda g: f"({g}.kind = 7 AND size(array_distinct({each(f'{g}.parts', lambda p: f'{p}.kind')})) > 1)"
    open_ = error("a collection of points, lines and areas can not be overlaid")
    define(fn, f"a {GEO}, b {GEO}", GEO, _same_srid("a", "b", f"CASE {nothing} WHEN {empty('a')} THEN {a_empty} WHEN {empty('b')} THEN {b_empty} WHEN {mixed('a')} OR {mixed('b')} THEN {open_} ELSE {body} END"))


#: Overlays of any pair, apart from the common ones above, as Spark takes long to analyse them.
_either = f"WHEN a.kind = 0 OR b.kind = 0 THEN {_NOTHING}"
_overlay("st_intersection_any", _either, "a", "b", overlay.intersection("a", "b"))
_overlay("st_difference_any", "WHEN a.kind = 0 THEN b WHEN b.kind = 0 THEN a", "a", "a", overlay.difference("a", "b"))
_overlay("st_union_any", _either, "b", "a", overlay.union("a", "b"))

# --- predicates -------------------------------------------------------------------------


_OF_BOXES = {
    "st_intersects": _meet("<="),
    "st_disjoint": f"NOT {_meet('<=')}",
    "st_covers": _holds("a", "b"),
    "st_coveredby": _holds("b", "a"),
    "st_contains": _holds("a", "b"),
    "st_within": _holds("b", "a"),
    "st_touches": f"({_meet('<=')} AND NOT {_meet('<')})",
    "st_equals": f"({_holds('a', 'b')} AND {_holds('b', 'a')})",
}


def predicate(fn: str, body: str, when_empty: str = "false") -> None:
    define(fn, f"a {GEO}, b {GEO}", "BOOLEAN", _same_srid("a", "b", f"CASE WHEN a.kind = 0 AND b.kind = 0 THEN true WHEN a.kind = 0 OR b.kind = 0 THEN false WHEN {empty('a')} OR {empty('b')} THEN {when_empty} ELSE {body} END"), (_two_boxes, _OF_BOXES[fn]))


def _by_points(of_point: str, general: str, ways: tuple[tuple[str, str], ...]) -> str:
    """A predicate with a short way where one of ``ways`` (point, other) has a single point first: ``of_point`` over where it lies in the other."""
    cases = " ".join(f"WHEN {_is_point(p)} THEN named_struct('p', {_first(p)}, 'g', {g})" for p, g in ways)
    return let(f"CASE {cases} END", lambda k: f"CASE WHEN {k} IS NULL THEN {general} ELSE {plane.where(f'{k}.p', f'{k}.g')} {of_point} END")


_EITHER = (("b", "a"), ("a", "b"))
predicate("st_intersects", _by_points("> 0", plane.intersects("a", "b"), _EITHER))
predicate("st_disjoint", f"NOT {_by_points('> 0', plane.intersects('a', 'b'), _EITHER)}", "true")
predicate("st_covers", _by_points("> 0", plane.covers("a", "b"), _EITHER[:1]))
predicate("st_coveredby", _by_points("> 0", plane.covers("b", "a"), _EITHER[1:]))
predicate("st_contains", _by_points("= 2", plane.contains("a", "b"), _EITHER[:1]))
predicate("st_within", _by_points("= 2", plane.contains("b", "a"), _EITHER[1:]))
predicate("st_touches", _by_points("= 1", plane.touches("a", "b"), _EITHER))
predicate("st_equals", f"IF(a.parts = b.parts, true, {plane.equals('a', 'b')})", f"({empty('a')} AND {empty('b')})")

__all__ = ["FUNCTIONS", "PARTS", "R", "all_edges"]
