"""Well-known binary of a geography as a SQL expression: the bits of a double by exact arithmetic, bytes as hex digits."""

from __future__ import annotations

from .shape import each, let

_NAN = "7FF8000000000000"


def _ordered(digits: str, n: int, big: str) -> str:
    """``n`` bytes of hex digits in the order that is asked for."""
    return let(digits, lambda h: f"IF({big}, {h}, concat({', '.join(f'substr({h}, {2 * k - 1}, 2)' for k in range(n, 0, -1))}))")


def number(x: str, big: str) -> str:
    """The bytes of a double. Scaling by powers of two loses nothing; the exponent is set right where the logarithm rounds."""
    bits = let(
        f"named_struct('x', {x}, 'a', abs({x}), 'g', CAST(floor(log2(abs({x}))) AS INT))",
        lambda k: let(
            f"{k}.g + CASE WHEN {k}.a / pow(2D, {k}.g) >= 2 THEN 1 WHEN {k}.a / pow(2D, {k}.g) < 1 THEN -1 ELSE 0 END",
            lambda e: f"(IF({k}.x < 0, shiftleft(1L, 63), 0L) | shiftleft(CAST({e} + 1023 AS BIGINT), 52) | CAST(({k}.a / pow(2D, {e}) - 1) * 4503599627370496D AS BIGINT))",
        ),
    )
    digits = f"CASE WHEN {x} IS NULL OR isnan({x}) THEN '{_NAN}' WHEN {x} = 0 THEN '0000000000000000' ELSE lpad(hex({bits}), 16, '0') END"
    return _ordered(digits, 8, big)


def count(n: str, big: str) -> str:
    return _ordered(f"lpad(hex(CAST({n} AS BIGINT)), 8, '0')", 4, big)


def as_binary(g: str, extended: bool, big: str = "false") -> str:
    """EWKB (with SRID) or ISO WKB; no bytes for nothing."""
    z, m = f"({g}.flags & 1 = 1)", f"({g}.flags & 2 = 2)"
    mark = f"IF({big}, '00', '01')"
    place = lambda p: f"concat({number(f'{p}.x', big)}, {number(f'{p}.y', big)}, IF({z}, {number(f'{p}.z', big)}, ''), IF({m}, {number(f'{p}.m', big)}, ''))"
    line = lambda r: f"concat({count(f'size({r})', big)}, array_join({each(r, place)}, ''))"
    body = lambda p: f"CASE {p}.kind WHEN 1 THEN {place(f'{p}.rings[0][0]')} WHEN 2 THEN {line(f'{p}.rings[0]')} ELSE concat({count(f'size({p}.rings)', big)}, array_join({each(f'{p}.rings', line)}, '')) END"
    dims = f"IF({z}, 2147483648L, 0L) + IF({m}, 1073741824L, 0L)"
    inner = lambda kind: f"concat({mark}, {count(f'{kind} + {dims}' if extended else f'{kind} + 1000 * {g}.flags', big)})"
    outer = f"concat({mark}, {count(f'{g}.kind + {dims} + 536870912L', big)}, {count(f'{g}.srid', big)})" if extended else inner(f"{g}.kind")
    nan = _ordered(f"'{_NAN}'", 8, big)
    nothing = f"IF({g}.kind = 1, repeat({nan}, 2 + ({g}.flags & 1) + IF({m}, 1, 0)), '00000000')"
    members = f"concat({count(f'size({g}.parts)', big)}, array_join({each(f'{g}.parts', lambda p: f'concat({inner(f"{p}.kind")}, {body(p)})')}, ''))"
    whole = f"CASE WHEN {g}.kind > 3 THEN {members} WHEN size({g}.parts) = 0 THEN {nothing} ELSE {let(f'{g}.parts[0]', body)} END"
    return f"CASE WHEN {g} IS NULL THEN NULL WHEN {g}.kind = 0 THEN X'' ELSE unhex(concat({outer}, {whole})) END"
