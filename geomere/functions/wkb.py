"""Reading well-known binary, as a SQL expression over its hex digits: folds over members and rings carry the place that is read next."""

from __future__ import annotations

from .shape import NONE, PART, PARTS, RING, error, geo, let, name
from .text import checked

#: Hex digits of a byte, of a count and of a double.
_BYTE, _COUNT, _DOUBLE = 2, 8, 16


def _ordered(h: str, at: str, digits: int, big: str) -> str:
    """Hex digits from a place on (counted from 1), the highest byte first."""
    turned = ", ".join(f"substr({h}, {at} + {k}, 2)" for k in range(digits - 2, -1, -2))
    return f"IF({big}, substr({h}, {at}, {digits}), concat({turned}))"


def _count(h: str, at: str, big: str) -> str:
    """An unsigned number of four bytes that can't be more than there are bytes."""
    return let(f"CAST(conv({_ordered(h, at, _COUNT, big)}, 16, 10) AS BIGINT)", lambda n: f"IF({n} * 2 > length({h}), CAST({error('invalid WKB')} AS BIGINT), {n})")


def _number(h: str, at: str, big: str) -> str:
    """A double: its fraction times a power of two, which is exact. Not a number, and no digits at all, are null."""

    def value(k: str) -> str:
        power = f"({k}.e & 2047)"
        size = f"IF({power} = 0, {k}.m * pow(2D, -1074), (1 + {k}.m / 4503599627370496D) * pow(2D, {power} - 1023))"
        return f"CASE WHEN {power} = 2047 THEN NULL ELSE IF({k}.e >= 2048, -1, 1) * {size} END"

    return let(_ordered(h, at, _DOUBLE, big), lambda d: let(f"named_struct('e', CAST(conv(substr({d}, 1, 3), 16, 10) AS INT), 'm', CAST(conv(substr({d}, 4, 13), 16, 10) AS BIGINT))", value))


def _header(h: str, at: str, use) -> str:
    """``use(head)`` of the geometry at a place: byte order, kind, flags, SRID and where its body begins."""
    big = f"(substr({h}, {at}, {_BYTE}) = '00')"
    code = f"CAST(conv({_ordered(h, f'{at} + {_BYTE}', _COUNT, big)}, 16, 10) AS BIGINT)"

    def parsed(c: str) -> str:
        extended = f"CAST(shiftright({c}.code, 31) & 1 | (shiftright({c}.code, 30) & 1) * 2 AS INT)"
        flags = f"IF({extended} > 0, {extended}, CAST(floor(({c}.code & 65535) / 1000) AS INT) % 4)"
        named = f"(shiftright({c}.code, 29) & 1 = 1)"
        srid = f"IF({named}, CAST(conv({_ordered(h, f'{c}.at + {_BYTE + _COUNT}', _COUNT, f'{c}.big')}, 16, 10) AS INT), 0)"
        return let(f"named_struct('big', {c}.big, 'kind', CAST(({c}.code & 65535) % 1000 AS INT), 'flags', {flags}, 'srid', {srid}, 'from', {c}.at, 'at', {c}.at + {_BYTE + _COUNT} + IF({named}, {_COUNT}, 0))", use)

    return let(f"named_struct('big', {big}, 'code', {code}, 'at', {at})", parsed)


def _fold(n: str, start: str, step) -> str:
    """``step(state, number)`` from ``start`` on, n times."""
    s, i = name(), name()
    return f"aggregate(IF({n} > 0, sequence(1L, {n}), CAST(array() AS ARRAY<BIGINT>)), {start}, ({s}, {i}) -> {step(s)})"


def _places(h: str, at: str, n: str, head: str) -> str:
    i, z, m = name(), f"({head}.flags & 1 = 1)", f"({head}.flags & 2 = 2)"
    width = f"({_DOUBLE} * (2 + ({head}.flags & 1) + shiftright({head}.flags, 1)))"

    def place(p: str) -> str:
        read = lambda k: _number(h, f"{p} + {_DOUBLE} * {k}", f"{head}.big")
        return f"named_struct('x', {read('0')}, 'y', {read('1')}, 'z', IF({z}, {read('2')}, NULL), 'm', IF({m}, {read(f'(2 + ({head}.flags & 1))')}, NULL))"

    return f"IF({n} > 0, transform(sequence(0L, {n} - 1), {i} -> {let(f'CAST({at} + {i} * {width} AS INT)', place)}), CAST(array() AS {RING}))"


def _simple(h: str, head: str) -> str:
    """(at, parts) of a point, line or polygon: its rings, each with a count before it, but for a point's."""
    width = f"({_DOUBLE} * (2 + ({head}.flags & 1) + shiftright({head}.flags, 1)))"
    several = f"IF({head}.kind = 3, {_count(h, f'{head}.at', f'{head}.big')}, 1L)"
    start = f"named_struct('at', {head}.at + IF({head}.kind = 3, {_COUNT}, 0), 'rings', CAST(array() AS ARRAY<{RING}>))"

    def ring(s: str) -> str:
        n = f"IF({head}.kind = 1, 1L, {_count(h, f'{s}.at', f'{head}.big')})"
        first = f"{s}.at + IF({head}.kind = 1, 0, {_COUNT})"
        return let(n, lambda k: f"named_struct('at', CAST({first} + {k} * {width} AS INT), 'rings', concat({s}.rings, array({_places(h, first, k, head)})))")

    def kept(r: str) -> str:
        nothing = f"size(flatten({r}.rings)) = 0 OR ({head}.kind = 1 AND {r}.rings[0][0].x IS NULL AND {r}.at <= length({h}) + 1)"
        part = f"CAST(named_struct('kind', {head}.kind, 'rings', {r}.rings) AS {PART})"
        return f"named_struct('at', {r}.at, 'parts', IF({nothing}, {NONE}, array({part})))"

    return f"CASE WHEN {head}.kind BETWEEN 1 AND 3 THEN {let(_fold(several, start, ring), kept)} ELSE {error('unknown geometry type')} END"


def _members(h: str, head: str, kinds: str, one) -> str:
    """(at, parts) of the members of a geometry of one of some kinds; of another, of itself alone. ``one`` reads what is at a place."""
    n = f"IF({head}.kind IN ({kinds}), {_count(h, f'{head}.at', f'{head}.big')}, 1L)"
    start = f"named_struct('at', IF({head}.kind IN ({kinds}), {head}.at + {_COUNT}, {head}.from), 'parts', {NONE})"
    return _fold(n, start, lambda s: _header(h, f"{s}.at", lambda m: let(one(m), lambda r: f"named_struct('at', {r}.at, 'parts', concat({s}.parts, {r}.parts))")))


def from_hex(h: str) -> str:
    """A geography of hex WKB or EWKB in upper case, which must be a variable."""
    flat = lambda head: _members(h, head, "4, 5, 6", lambda m: _simple(h, m))

    def whole(head: str) -> str:
        found = let(_members(h, head, "7", flat), lambda r: f"IF({r}.at <> length({h}) + 1, CAST({error('invalid WKB')} AS {PARTS}), {r}.parts)")
        made = geo(f"{head}.kind", found, f"IF({head}.srid > 0, {head}.srid, 4326)", f"{head}.flags")
        return let(made, lambda g: checked(g, "WKB"))

    return f"CASE WHEN NOT {h} RLIKE '^0[01]([0-9A-F][0-9A-F])+$' THEN {error('invalid WKB')} ELSE {_header(h, '1', whole)} END"


__all__ = ["from_hex"]
