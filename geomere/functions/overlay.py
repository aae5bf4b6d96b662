"""Intersection, difference and union as SQL snippets: borders cut where they meet, the pieces of the result kept and joined to rings.

Areas are turned so that their inside is to the right of every edge. Of the pieces of both
borders those bound the result that lie inside (or outside) of the other area; where borders run
together, the side of the insides decides. Every piece is used once, so a walk has as many steps as there are pieces.
"""

from __future__ import annotations

from .plane import beside, cuts, near_edge, only_points, pieces, solid, where
from .shape import NONE, PARTS, POINT, all_edges, each, edges, error, every, geo, keep, let, name, part, points, some, total

_PTS = f"CAST(array() AS ARRAY<{POINT}>)"
_RINGS = f"CAST(array() AS ARRAY<ARRAY<{POINT}>>)"


def _near(p: str, q: str) -> str:
    """The same place but for rounding (a tenth of a millimetre)."""
    return f"(abs({p}.x - {q}.x) <= 1e-9D AND abs({p}.y - {q}.y) <= 1e-9D)"


def _of_kind(g: str, kind: int) -> str:
    return keep(f"{g}.parts", lambda p: f"{p}.kind = {kind}")


def _signed(ring: str) -> str:
    """Twice the signed area of a ring: above zero if it runs against the clock."""
    return total(edges(ring), lambda s: f"({s}.a.x * {s}.b.y - {s}.b.x * {s}.a.y)")


def _directed(g: str) -> str:
    """The areas of a geography, their insides to the right of every edge."""
    r, i = name(), name()
    turned = lambda p: f"transform({p}.rings, ({r}, {i}) -> IF({_signed(r)} * IF({i} = 0, 1, -1) > 0, reverse({r}), {r}))"
    return geo("6", each(_of_kind(g, 3), lambda p: part("3", turned(p))))


def _walk(segments: str) -> str:
    """Rings of directed segments (p, q). Where several go on, that which turns most to the right does; a place met again closes a ring."""
    s, i, u, k, c = name(), name(), name(), name(), name()
    last, before = f"element_at({s}.cur, -1)", f"element_at({s}.cur, -2)"
    turn = f"pmod(atan2({u}.q.y - {u}.p.y, {u}.q.x - {u}.p.x) - atan2({before}.y - {last}.y, {before}.x - {last}.x) - 1e-12D, 2 * pi())"
    options = f"array_min(filter(transform({s}.left, ({u}, {k}) -> IF({_near(f'{u}.p', last)}, named_struct('t', {turn}, 'k', {k}), NULL)), {c} -> {c} IS NOT NULL))"
    state = lambda left, cur, rings: f"named_struct('left', {left}, 'cur', {cur}, 'rings', {rings})"

    def go_on(o: str) -> str:
        rest = f"filter({s}.left, ({u}, {k}) -> {k} <> {o}.k)"
        q = f"{s}.left[{o}.k].q"
        seen = let(q, lambda v: f"CAST(array_position({each(f'{s}.cur', lambda p: _near(p, v))}, true) AS INT)")
        ring = lambda at: f"concat(slice({s}.cur, {at}, size({s}.cur) - {at} + 1), array({s}.cur[{at} - 1]))"
        moved = let(seen, lambda at: f"IF({at} = 0, {state(rest, f'concat({s}.cur, array({q}))', f'{s}.rings')}, {state(rest, f'slice({s}.cur, 1, IF({at} = 1, 0, {at}))', f'concat({s}.rings, array({ring(at)}))')})")
        return f"CASE WHEN {o} IS NULL THEN {error('borders that do not close')} ELSE {moved} END"

    start = state(f"slice({s}.left, 2, size({s}.left) - 1)", f"array({s}.left[0].p, {s}.left[0].q)", f"{s}.rings")
    zero = lambda all_: state(all_, _PTS, _RINGS)
    run = let(segments, lambda v: f"IF(size({v}) = 0, {zero(v)}, aggregate(sequence(1, size({v})), {zero(v)}, ({s}, {i}) -> IF(size({s}.cur) = 0, {start}, {let(options, go_on)})))")
    return let(run, lambda e: f"IF(size({e}.cur) > 0, {error('borders that do not close')}, {e}.rings)")


def _areas(rings: str) -> str:
    """Parts of rings: those with the clock are shells, the others holes of the least shell around them."""
    k, s = name(), name()
    sized = keep(each(keep(rings, lambda r: f"size({r}) >= 4"), lambda r: f"named_struct('r', {r}, 'area', {_signed(r)})"), lambda r: f"{r}.area <> 0")
    middle = lambda h: f"named_struct('x', ({h}.r[0].x + {h}.r[1].x) / 2, 'y', ({h}.r[0].y + {h}.r[1].y) / 2)"
    around = lambda h, t: let(middle(h), lambda m: let(geo("3", f"array({part('3', f'array({t}.r)')})"), lambda g: f"{where(m, g, exact=False)} = 2"))

    def first(r: str) -> str:
        """A ring from its least place on."""
        open_ = f"slice({r}, 1, size({r}) - 1)"
        xy = lambda v: each(v, lambda p: f"named_struct('x', {p}.x, 'y', {p}.y)")
        at = let(xy(open_), lambda v: f"CAST(array_position({v}, array_min({v})) AS INT)")
        return let(at, lambda n: f"concat(slice({r}, {n}, size({r}) - {n}), slice({r}, 1, {n}))")

    def parts(z: str) -> str:
        shells = f"transform({keep(z, lambda r: f'{r}.area < 0')}, ({s}, {k}) -> named_struct('r', {s}.r, 'area', {s}.area, 'k', {k}))"

        def assigned(v: str) -> str:
            owner = lambda h: f"array_min({each(keep(v, lambda t: around(h, t)), lambda t: f'named_struct("a", -{t}.area, "k", {t}.k)')}).k"
            holes = each(keep(z, lambda r: f"{r}.area > 0"), lambda h: f"named_struct('r', {h}.r, 'of', {owner(h)})")
            made = lambda hs: each(v, lambda t: part("3", f"concat(array({first(f'{t}.r')}), {each(keep(hs, lambda h: f'{h}.of = {t}.k'), lambda h: first(f'{h}.r'))})"))
            return let(holes, lambda hs: f"IF({some(hs, lambda h: f'{h}.of IS NULL')}, {error('a hole without a shell')}, array_sort({made(hs)}))")

        return let(shells, assigned)

    return let(sized, parts)


def _border(a: str, b: str, op: str) -> str:
    """The directed pieces that bound the result of two directed areas."""
    right = lambda s: let(f"{beside(s)}[0]", lambda m: f"{where(m, b)} = 2")
    of_a = {"intersection": lambda s: f"({s}.w = 2 OR ({s}.w = 1 AND {right(s)}))", "union": lambda s: f"({s}.w = 0 OR ({s}.w = 1 AND {right(s)}))", "difference": lambda s: f"({s}.w = 0 OR ({s}.w = 1 AND NOT {right(s)}))"}[op]
    wanted = 0 if op == "union" else 2
    corners = f"concat({points(a)}, {points(b)})"
    # a place that was computed gives way to the corner that it stands for
    exact = lambda p, v: f"coalesce(get({keep(v, lambda c: _near(c, p))}, 0), {p})"
    flat = lambda p: f"named_struct('x', {p}.x, 'y', {p}.y, 'z', CAST(NULL AS DOUBLE), 'm', CAST(NULL AS DOUBLE))"
    seg = lambda p, q, v: f"named_struct('p', {let(exact(p, v), flat)}, 'q', {let(exact(q, v), flat)})"
    ends = ("q", "p") if op == "difference" else ("p", "q")
    kept = lambda v: f"concat({each(keep(pieces(a, b), of_a), lambda s: seg(f'{s}.p', f'{s}.q', v))}, {each(keep(pieces(b, a), lambda s: f'{s}.w = {wanted}'), lambda s: seg(f'{s}.{ends[0]}', f'{s}.{ends[1]}', v))})"
    return let(corners, lambda v: keep(kept(v), lambda s: f"NOT {_near(f'{s}.p', f'{s}.q')}"))


def _on_edges(p: str, g: str) -> str:
    return some(all_edges(g), lambda e: near_edge(p, e))


def _runs(a: str, b: str, test) -> str:
    """Line parts of those pieces of the lines of ``a`` that pass, joined but where ``b`` meets them."""
    acc, s = name(), name()
    end = f"element_at(element_at({acc}, -1), -1)"
    joined = f"IF(size({acc}) > 0 AND {end}.x = {s}.p.x AND {end}.y = {s}.p.y AND NOT {_on_edges(f'{s}.p', b)}, concat(slice({acc}, 1, size({acc}) - 1), array(concat(element_at({acc}, -1), array({s}.q)))), concat({acc}, array(array({s}.p, {s}.q))))"
    one = lambda p: let(geo("2", f"array({p})"), lambda g: f"aggregate({keep(pieces(g, b), test)}, {_RINGS}, ({acc}, {s}) -> {joined})")
    return each(f"flatten({each(_of_kind(a, 2), one)})", lambda r: part("2", f"array({r})"))


def _dots(places: str) -> str:
    """Point parts, each place once."""
    acc, p = name(), name()
    once = f"aggregate({places}, {_PTS}, ({acc}, {p}) -> IF({some(acc, lambda q: _near(q, p))}, {acc}, concat({acc}, array({p}))))"
    return each(once, lambda v: part("1", f"array(array({v}))"))


def _places(g: str) -> str:
    return each(_of_kind(g, 1), lambda p: f"{p}.rings[0][0]")


def _geography(parts: str, srid: str, none: str) -> str:
    """The least kind that holds some parts."""
    all_ = lambda ps, kind: every(ps, lambda p: f"{p}.kind = {kind}")
    kind = lambda ps: f"CASE WHEN size({ps}) = 0 THEN {none} " + " ".join(f"WHEN {all_(ps, k)} THEN IF(size({ps}) = 1, {k}, {k + 3})" for k in (1, 2, 3)) + " ELSE 7 END"
    return let(parts, lambda ps: geo(kind(ps), ps, srid))


def _dimension(g: str) -> str:
    return f"coalesce(array_max({each(f'{g}.parts', lambda p: f'{p}.kind')}), 1)"


def _with_areas(a: str, b: str, use) -> str:
    return let(_directed(a), lambda x: let(_directed(b), lambda y: use(x, y)))


def _result(a: str, lines: str, dots, areas: str, none: str) -> str:
    """Lines, then points that are on no line or area of the result, then areas."""
    bare = lambda g: lambda p: f"{where(p, g, exact=False)} = 0"

    def whole(m: str) -> str:
        held = geo("7", f"concat({m}.lines, {m}.areas)")
        return let(held, lambda g: _geography(f"concat({m}.lines, {_dots(keep(dots, bare(g)))}, {m}.areas)", f"{a}.srid", none))

    return let(f"named_struct('lines', CAST({lines} AS {PARTS}), 'areas', CAST({areas} AS {PARTS}))", whole)


def _both(x: str, y: str) -> str:
    return f"size({x}.parts) > 0 AND size({y}.parts) > 0"


def intersection(a: str, b: str) -> str:
    def of(x: str, y: str) -> str:
        areas = f"IF({_both(x, y)}, {_areas(_walk(_border(x, y, 'intersection')))}, {NONE})"
        # borders that run together with the insides on either side are lines of the result
        facing = each(keep(pieces(x, y), lambda s: f"{s}.w = 1 AND NOT {let(f'{beside(s)}[0]', lambda m: f'{where(m, y)} = 2')}"), lambda s: part("2", f"array(array({s}.p, {s}.q))"))
        lines = f"concat({_runs(a, b, lambda s: f'{s}.w > 0')}, IF({solid(a)}, {_runs(b, x, lambda s: f'{s}.w > 0')}, {NONE}), IF({_both(x, y)}, {facing}, {NONE}))"
        at = lambda e, t: f"named_struct('x', IF({t} = 1, {e}.b.x, {e}.a.x + ({e}.b.x - {e}.a.x) * {t}), 'y', IF({t} = 1, {e}.b.y, {e}.a.y + ({e}.b.y - {e}.a.y) * {t}), 'z', CAST(NULL AS DOUBLE), 'm', CAST(NULL AS DOUBLE))"
        met = f"flatten({each(all_edges(a), lambda e: each(cuts(e, b), lambda t: at(e, t)))})"
        dots = f"concat({keep(_places(a), lambda p: f'{where(p, b)} > 0')}, {keep(_places(b), lambda p: f'{where(p, a)} > 0')}, {met})"
        none = f"CASE least({_dimension(a)}, {_dimension(b)}) WHEN 1 THEN IF({a}.kind = 1 OR {b}.kind = 1, 1, 7) WHEN 2 THEN 2 ELSE 3 END"
        return _result(a, lines, dots, areas, none)

    return _with_areas(a, b, of)


def difference(a: str, b: str) -> str:
    def of(x: str, y: str) -> str:
        areas = f"IF({_both(x, y)}, {_areas(_walk(_border(x, y, 'difference')))}, {_of_kind(a, 3)})"
        lines = f"IF({only_points(b)}, {_of_kind(a, 2)}, {_runs(a, b, lambda s: f'{s}.w = 0')})"
        none = f"CASE {_dimension(a)} WHEN 1 THEN IF({a}.kind = 1, 1, 7) WHEN 2 THEN 2 ELSE 3 END"
        return _result(a, lines, keep(_places(a), lambda p: f"{where(p, b)} = 0"), areas, none)

    return _with_areas(a, b, of)


def union(a: str, b: str) -> str:
    def of(x: str, y: str) -> str:
        areas = f"IF({_both(x, y)}, {_areas(_walk(_border(x, y, 'union')))}, concat({_of_kind(a, 3)}, {_of_kind(b, 3)}))"
        lines = f"concat({_runs(a, b, lambda s: f'({s}.w = 0 OR NOT {solid(b)})')}, {_runs(b, a, lambda s: f'{s}.w = 0')})"
        return _result(a, lines, f"concat({_places(a)}, {_places(b)})", areas, "7")

    return _with_areas(a, b, of)
