"""Text, GeoJSON and geohash forms, as SQL expressions."""

from __future__ import annotations

from .shape import GEO, NONE, PARTS, each, error, geo, keep, let, name, part, point, some

KIND_NAMES = ("", "Point", "LineString", "Polygon", "MultiPoint", "MultiLineString", "MultiPolygon", "GeometryCollection")
#: The letters of a geohash, a fixed value.
BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"
_BIG, _SMALL = 1e15, 1e-8


def number(x: str, digits: str) -> str:
    """The shortest text of a double, with so many decimals at most."""
    plain = f"trim(TRAILING '.' FROM trim(TRAILING '0' FROM CAST(CAST(IF({digits} >= 15, {x}, rint({x} * pow(10, {digits})) / pow(10, {digits})) AS DECIMAL(38, 15)) AS STRING)))"
    power = f"regexp_replace(regexp_replace(lower(CAST({x} AS STRING)), '\\\\.0e', 'e'), 'e([0-9])', 'e+$1')"
    return f"CASE WHEN {x} = 0 THEN '0' WHEN abs({x}) <= {_SMALL}D OR abs({x}) >= {_BIG}D THEN {power} ELSE {plain} END"


def _coords(p: str, flags: str, sep: str, digits: str, m: bool = True) -> str:
    more = f", CASE WHEN {flags} & 2 = 2 THEN {number(f'{p}.m', digits)} END" if m else ""
    return f"concat_ws('{sep}', {number(f'{p}.x', digits)}, {number(f'{p}.y', digits)}, CASE WHEN {flags} & 1 = 1 THEN {number(f'{p}.z', digits)} END{more})"


def _joined(items: str, open_: str = "(", close: str = ")") -> str:
    return f"concat('{open_}', array_join({items}, ','), '{close}')"


def as_text(g: str, digits: str) -> str:
    line = lambda r: _joined(each(r, lambda p: _coords(p, f"{g}.flags", " ", digits)))
    rings = lambda p: _joined(each(f"{p}.rings", line))
    dims = f"CASE {g}.flags WHEN 1 THEN ' Z ' WHEN 2 THEN ' M ' WHEN 3 THEN ' ZM ' ELSE '' END"
    tag = lambda kind: f"concat(upper(array({', '.join(repr(k) for k in KIND_NAMES)})[{kind}]), {dims})"
    body = lambda p: f"CASE {p}.kind WHEN 3 THEN {rings(p)} ELSE {line(f'{p}.rings[0]')} END"
    bare = lambda p: _coords(f"{p}.rings[0][0]", f"{g}.flags", " ", digits)
    member = lambda p: f"CASE WHEN size(flatten({p}.rings)) = 0 THEN concat(trim({tag(f'{p}.kind')}), ' EMPTY') ELSE concat({tag(f'{p}.kind')}, {body(p)}) END"
    return (
        f"CASE WHEN {g}.kind = 0 THEN '' WHEN size({g}.parts) = 0 THEN concat(trim({tag(f'{g}.kind')}), ' EMPTY') "
        f"WHEN {g}.kind <= 3 THEN {let(f'{g}.parts[0]', lambda p: f'concat({tag(f"{g}.kind")}, {body(p)})')} "
        f"WHEN {g}.kind = 4 THEN concat({tag(f'{g}.kind')}, {_joined(each(f'{g}.parts', bare))}) "
        f"WHEN {g}.kind <= 6 THEN concat({tag(f'{g}.kind')}, {_joined(each(f'{g}.parts', body))}) "
        f"ELSE concat({tag(f'{g}.kind')}, {_joined(each(f'{g}.parts', member))}) END"
    )


def as_json(g: str, digits: str) -> str:
    xy = lambda p: f"concat('[', {_coords(p, f'{g}.flags', ',', digits, m=False)}, ']')"
    line = lambda r: _joined(each(r, xy), "[", "]")
    rings = lambda p: _joined(each(f"{p}.rings", line), "[", "]")
    names = f"array({', '.join(repr(k) for k in KIND_NAMES)})"
    body = lambda p: f"CASE {p}.kind WHEN 1 THEN {xy(f'{p}.rings[0][0]')} WHEN 2 THEN {line(f'{p}.rings[0]')} ELSE {rings(p)} END"
    object_ = lambda kind, what: f"""concat('{{"type":"', {names}[{kind}], '","coordinates":', {what}, '}}')"""
    member = lambda p: object_(f"{p}.kind", body(p))
    return (
        f"CASE WHEN {g}.kind = 0 THEN '' "
        f"WHEN {g}.kind = 7 THEN concat('{{\"type\":\"GeometryCollection\",\"geometries\":', {_joined(each(f'{g}.parts', member), '[', ']')}, '}}') "
        f"WHEN size({g}.parts) = 0 THEN {object_(f'{g}.kind', repr('[]'))} "
        f"WHEN {g}.kind <= 3 THEN {let(f'{g}.parts[0]', lambda p: object_(f'{g}.kind', body(p)))} "
        f"ELSE {object_(f'{g}.kind', _joined(each(f'{g}.parts', body), '[', ']'))} END"
    )


def _nested(kind: str, json: str) -> str:
    """Parts of coordinates (JSON, as GeoJSON nests them; a point may be in one more list)."""
    p = lambda c: point(f"{c}[0]", f"{c}[1]", f"get({c}, 2)", f"get({c}, 3)")
    ring = lambda r: each(r, p)
    flat = f"from_json({json}, 'array<array<double>>')"
    two = f"from_json({json}, 'array<array<array<double>>>')"
    three = f"from_json({json}, 'array<array<array<array<double>>>>')"
    solid = lambda rs: part("3", keep(each(rs, ring), lambda r: f"size({r}) > 0"))
    return (
        f"CASE WHEN {kind} IN (1, 4) THEN {each(keep(flat, lambda c: f'size({c}) > 0'), lambda c: part('1', f'array(array({p(c)}))'))} "
        f"WHEN {kind} = 2 THEN {let(flat, lambda cs: f'IF(size({cs}) = 0, {NONE}, array({part("2", f"array({ring(cs)})")}))')} "
        f"WHEN {kind} = 3 THEN {let(two, lambda rs: f'IF(size({rs}) = 0 OR size({rs}[0]) = 0, {NONE}, array({solid(rs)}))')} "
        f"WHEN {kind} = 5 THEN {each(keep(two, lambda c: f'size({c}) > 0'), lambda cs: part('2', f'array({ring(cs)})'))} "
        f"ELSE {each(keep(three, lambda c: f'size({c}) > 0'), solid)} END"
    )


def _kind(word: str, collection: bool = True) -> str:
    cases = " ".join(f"WHEN '{k.upper()}' THEN {i}" for i, k in enumerate(KIND_NAMES) if i and (collection or i < 7))
    return f"CASE upper({word}) {cases} END"


def checked(g: str, what: str = "text") -> str:
    """A parsed geography, or an error: bad numbers, too few points, open rings, places outside of the globe."""
    bad_line = some(f"{g}.parts", lambda p: f"{p}.kind = 2 AND size({p}.rings[0]) < 2")
    bad_ring = some(f"{g}.parts", lambda p: f"{p}.kind = 3 AND {some(f'{p}.rings', lambda r: f'size({r}) < 4 OR {r}[0].x <> {r}[size({r}) - 1].x OR {r}[0].y <> {r}[size({r}) - 1].y')}")
    outside = some(f"{g}.parts", lambda p: some(f"flatten({p}.rings)", lambda v: f"{v}.x IS NULL OR {v}.y IS NULL OR abs({v}.x) > 180.0000000001D OR abs({v}.y) > 90.0000000001D"))
    return f"CASE WHEN {g} IS NULL OR {g}.kind IS NULL OR {g}.parts IS NULL THEN {error(f'invalid {what}')} WHEN {bad_line} THEN {error('geometry requires more points')} WHEN {bad_ring} THEN {error('geometry contains non-closed rings')} WHEN {outside} THEN {error('Coordinate values were coerced into range')} ELSE {g} END"


def _flags(json: str, dims: str) -> str:
    """Dimension flags by the numbers of the first place and the letters behind the tag."""
    n = f"size(split(regexp_extract({json}, '([^\\\\[\\\\]]+)', 1), ','))"
    return f"CASE WHEN {dims} = 'ZM' OR {n} >= 4 THEN 3 WHEN {dims} = 'M' THEN 2 WHEN {dims} = 'Z' OR {n} = 3 THEN 1 ELSE 0 END"


_LEVEL = r"\\([^()A-Z]*\\)"
_BALANCED = rf"\\((?:[^()A-Z]|\\((?:[^()A-Z]|{_LEVEL})*\\))*\\)"
_TAGGED = rf"(?:(?!GEOMETRYC)[A-Z]+)\\s*(?:EMPTY|{_BALANCED})"


def _wkt_json(body: str, kind: str) -> str:
    """The bracketed coordinates of a tag's body."""
    empty = f"CASE WHEN {body} = 'EMPTY' THEN '()' ELSE {body} END"
    bare = f"CASE WHEN {kind} = 4 THEN concat('(', regexp_replace({empty}, '[()]', ''), ')') ELSE {empty} END"
    tidy = f"regexp_replace(regexp_replace({bare}, '\\\\s*([(),])\\\\s*', '$1'), '(?<![0-9])\\\\.', '0.')"
    tuples = f"regexp_replace({tidy}, '([^(),]+)', '[$1]')"
    return f"translate(regexp_replace({tuples}, '\\\\s+', ','), '()', '[]')"


def from_text(t: str) -> str:
    """A geography of WKT or EWKT, which must be a variable."""
    tag, dims, body = (f"regexp_extract({{0}}, '^([A-Z]+?)\\\\s*(ZM|Z|M)?\\\\s*(EMPTY|\\\\(.*\\\\))$', {k})" for k in (1, 2, 3))
    clean = f"regexp_replace(upper(trim(regexp_replace({t}, '(?i)^\\\\s*SRID\\\\s*=\\\\s*[0-9]+\\\\s*;', ''))), '(?<=[0-9.])E(?=[-+0-9])', 'e')"
    srid = f"coalesce(CAST(nullif(regexp_extract({t}, '(?i)^\\\\s*SRID\\\\s*=\\\\s*([0-9]+)', 1), '') AS INT), 4326)"

    def one(w: str, use) -> str:
        return let(f"named_struct('kind', {_kind(tag.format(w))}, 'dims', {dims.format(w)}, 'body', {body.format(w)})", lambda s: let(f"named_struct('kind', {s}.kind, 'dims', {s}.dims, 'json', {_wkt_json(f'{s}.body', f'{s}.kind')})", use))

    single = lambda w: one(w, lambda s: geo(f"{s}.kind", f"CASE WHEN {s}.kind IS NULL THEN NULL ELSE {_nested(f'{s}.kind', f'{s}.json')} END", srid, _flags(f"{s}.json", f"{s}.dims")))
    members = lambda w: f"regexp_extract_all(regexp_replace(regexp_replace({w}, '([A-Z])\\\\s*(ZM|Z|M)\\\\s*(?=[(E])', '$1'), '^GEOMETRYCOLLECTION', ''), '({_TAGGED})', 1)"
    inner = lambda w: f"flatten({each(members(w), lambda x: one(x, lambda s: _nested(f'{s}.kind', f'{s}.json')))})"
    deep = lambda w: let(f"regexp_extract({members(w)}[0], '([^()A-Z,]+)', 1)", lambda c: f"CASE WHEN size(split(trim({c}), '\\\\s+')) >= 3 THEN 1 ELSE 0 END")
    collected = lambda w: f"CASE WHEN {w} RLIKE '^GEOMETRYCOLLECTION *(ZM|Z|M)? *(EMPTY|\\\\(.*\\\\))$' THEN {geo('7', inner(w), srid, f'coalesce({deep(w)}, 0)')} END"
    return let(clean, lambda w: let(f"CASE WHEN {w} LIKE 'GEOMETRYCOLLECTION%' THEN {collected(w)} ELSE {single(w)} END", checked))


def from_json(t: str) -> str:
    """A geography of a GeoJSON geometry."""
    raw = f"from_json({t}, 'type STRING, coordinates STRING, geometries ARRAY<STRUCT<type: STRING, coordinates: STRING>>')"
    lift = lambda kind, c: f"CASE WHEN {kind} = 1 AND {c} NOT LIKE '[[%' THEN concat('[', {c}, ']') ELSE {c} END"

    def whole(j: str) -> str:
        parts = lambda k, c: _nested(k, lift(k, c))
        member = lambda m: let(_kind(f"{m}.type", False), lambda k: parts(k, f"{m}.coordinates"))
        single = let(_kind(f"{j}.type"), lambda k: geo(k, f"CASE WHEN {k} IS NULL OR {j}.coordinates IS NULL THEN NULL ELSE {parts(k, f'{j}.coordinates')} END", "4326", _flags(f"{j}.coordinates", "''")))
        return f"CASE WHEN upper({j}.type) = 'GEOMETRYCOLLECTION' THEN {geo('7', f'flatten({each(f"{j}.geometries", member)})')} ELSE {single} END"

    return let(let(raw, whole), lambda g: checked(g, "GeoJSON"))


def _bisect(n_bits: str, x: str, y: str) -> str:
    """The first bits of a place, longitude first, as text."""
    s, i, mid = name(), name(), name()
    start = "named_struct('a', -180D, 'b', 180D, 'c', -90D, 'd', 90D, 'bits', '')"
    lon = f"transform(array(({s}.a + {s}.b) / 2), {mid} -> IF({x} >= {mid}, named_struct('a', {mid}, 'b', {s}.b, 'c', {s}.c, 'd', {s}.d, 'bits', concat({s}.bits, '1')), named_struct('a', {s}.a, 'b', {mid}, 'c', {s}.c, 'd', {s}.d, 'bits', concat({s}.bits, '0'))))[0]"
    lat = f"transform(array(({s}.c + {s}.d) / 2), {mid} -> IF({y} >= {mid}, named_struct('a', {s}.a, 'b', {s}.b, 'c', {mid}, 'd', {s}.d, 'bits', concat({s}.bits, '1')), named_struct('a', {s}.a, 'b', {s}.b, 'c', {s}.c, 'd', {mid}, 'bits', concat({s}.bits, '0'))))[0]"
    return f"aggregate(sequence(0, {n_bits} - 1), {start}, ({s}, {i}) -> IF({i} % 2 = 0, {lon}, {lat})).bits"


def geohash(x: str, y: str, precision: str) -> str:
    letters = lambda bits: f"array_join({each(f'sequence(0, {precision} - 1)', lambda k: f'substr({BASE32!r}, CAST(conv(substr({bits}, {k} * 5 + 1, 5), 2, 10) AS INT) + 1, 1)')}, '')"
    return f"CASE WHEN {precision} <= 0 THEN '' ELSE {let(_bisect(f'({precision}) * 5', x, y), letters)} END"


#: Digits of a number to base 32, and the most letters whose bits one number holds.
_DIGITS, _SHORT = "0123456789ABCDEFGHIJKLMNOPQRSTUV", 12


def short_geohash(x: str, y: str, precision: str) -> str:
    """Whether :func:`letters_of` serves a place."""
    return f"({precision} BETWEEN 1 AND {_SHORT} AND {x} BETWEEN -180D AND 180D AND {y} BETWEEN -90D AND 90D)"


def letters_of(x: str, y: str, precision: str) -> str:
    """The geohash of a place by arithmetic on the numbers of its column and row of cells, as halving finds them: borders of cells are exact doubles."""
    cells = lambda odd: f"shiftleft(1L, shiftright(5 * {precision} + {odd}, 1))"

    def cell(v: str, lo: str, n: str) -> str:
        span = f"(-2 * {lo})"
        guess = f"least(CAST(floor(({v} - {lo}) / {span} * {n}) AS BIGINT), {n} - 1)"
        border = lambda k: f"({lo} + {span} * {k} / {n})"
        # rounding may miss by one beside a border
        return f"({guess} + CASE WHEN {v} < {border(guess)} THEN -1 WHEN {guess} < {n} - 1 AND {v} >= {border(f'({guess} + 1)')} THEN 1 ELSE 0 END)"

    # bits read as digits to base 4 leave a place between each two
    apart = lambda k: f"CAST(conv(bin({k}), 4, 10) AS BIGINT)"
    column, row = apart(cell(x, "-180D", cells(1))), apart(cell(y, "-90D", cells(0)))
    whole = f"{column} * IF({precision} % 2 = 0, 2, 1) + {row} * IF({precision} % 2 = 0, 1, 2)"
    return f"translate(lpad(conv(CAST({whole} AS STRING), 10, 32), {precision}, '0'), '{_DIGITS}', '{BASE32}')"


def shared_letters(b: str) -> str:
    """How many letters of a geohash hold a whole box (xmin, ymin, xmax, ymax)."""
    s, i, mid = name(), name(), name()

    def halve(lo: str, hi: str, least: str, most: str) -> str:
        new = lambda **at: "named_struct(" + ", ".join(f"'{k}', {at.get(k, f'{s}.{k}')}" for k in ("a", "b", "c", "d", "n", "done")) + ")"
        n = f"{s}.n + 1"
        return f"transform(array(({s}.{lo} + {s}.{hi}) / 2), {mid} -> CASE WHEN {least} > {mid} THEN {new(**{lo: mid, 'n': n})} WHEN {most} < {mid} THEN {new(**{hi: mid, 'n': n})} ELSE {new(done='true')} END)[0]"

    start = "named_struct('a', -180D, 'b', 180D, 'c', -90D, 'd', 90D, 'n', 0, 'done', false)"
    step = f"CASE WHEN {s}.done THEN {s} WHEN {i} % 2 = 0 THEN {halve('a', 'b', f'{b}.xmin', f'{b}.xmax')} ELSE {halve('c', 'd', f'{b}.ymin', f'{b}.ymax')} END"
    return f"CAST(floor(aggregate(sequence(0, 99), {start}, ({s}, {i}) -> {step}).n / 5) AS INT)"


def geohash_box(h: str, precision: str) -> str:
    """The cell (a, b, c, d: longitudes and latitudes) of a geohash; an unknown letter is an error."""
    used = f"named_struct('n', CASE WHEN {precision} < 0 OR {precision} > length({h}) THEN length({h}) ELSE {precision} END, 'h', lower(substr({h}, 1, {_SHORT})))"

    def arithmetic(u: str) -> str:
        # digits to base 4 hold a bit of a column and one of a row each, the last of which is a column's if the bits are odd
        pairs = f"conv(translate(substr({u}.h, 1, {u}.n), '{BASE32}', '{_DIGITS}'), 32, 4)"
        bits = lambda q, ones: f"CAST(conv(translate({q}, '0123', '{ones}'), 2, 10) AS BIGINT)"
        cell = lambda q: f"IF({u}.n % 2 = 0, named_struct('x', {bits(q, '0011')}, 'y', {bits(q, '0101')}), named_struct('x', {bits(q, '0101')}, 'y', {bits(q, '0011')}))"
        wide, high = f"360D / shiftleft(1L, shiftright(5 * {u}.n + 1, 1))", f"180D / shiftleft(1L, shiftright(5 * {u}.n, 1))"
        sides = lambda k: f"named_struct('a', -180D + {k}.x * ({wide}), 'b', -180D + ({k}.x + 1) * ({wide}), 'c', -90D + {k}.y * ({high}), 'd', -90D + ({k}.y + 1) * ({high}))"
        return let(let(pairs, cell), sides)

    plain = lambda u: f"{u}.n BETWEEN 1 AND {_SHORT} AND translate({u}.h, '{BASE32}', '') = ''"
    return let(used, lambda u: f"CASE WHEN {plain(u)} THEN {arithmetic(u)} ELSE {_halved(h, precision)} END")


def _halved(h: str, precision: str) -> str:
    """:func:`geohash_box` by halving, for any number of letters."""
    n = f"CASE WHEN {precision} < 0 OR {precision} > length({h}) THEN length({h}) ELSE {precision} END"
    s, i, v, mid, k = name(), name(), name(), name(), name()
    bit = f"(shiftright({v}, 4 - {k} % 5) & 1)"
    lon = f"transform(array(({s}.a + {s}.b) / 2), {mid} -> named_struct('a', IF({bit} = 1, {mid}, {s}.a), 'b', IF({bit} = 1, {s}.b, {mid}), 'c', {s}.c, 'd', {s}.d))[0]"
    lat = f"transform(array(({s}.c + {s}.d) / 2), {mid} -> named_struct('a', {s}.a, 'b', {s}.b, 'c', IF({bit} = 1, {mid}, {s}.c), 'd', IF({bit} = 1, {s}.d, {mid})))[0]"
    letter = f"transform(array(instr('{BASE32}', lower(substr({h}, CAST(floor({k} / 5) AS INT) + 1, 1))) - 1), {i} -> IF({i} < 0, CAST({error('bad geohash')} AS INT), {i}))[0]"
    step = f"transform(array({letter}), {v} -> IF({k} % 2 = 0, {lon}, {lat}))[0]"
    start = "named_struct('a', -180D, 'b', 180D, 'c', -90D, 'd', 90D)"
    return f"aggregate(IF(({n}) = 0, CAST(array() AS ARRAY<INT>), sequence(0, ({n}) * 5 - 1)), {start}, ({s}, {k}) -> {step})"


__all__ = ["GEO", "PARTS", "as_json", "as_text", "checked", "from_json", "from_text", "geohash", "geohash_box", "letters_of", "short_geohash"]
