"""Planar snippets in degree space: where points lie, how edges meet, and what predicates follow."""

from __future__ import annotations

from .shape import all_edges, box, each, edges, every, keep, let, name, points, rings, some

INSIDE, BORDER, OUTSIDE = 2, 1, 0


def cross(o: str, a: str, b: str) -> str:
    return f"(({a}.x - {o}.x) * ({b}.y - {o}.y) - ({a}.y - {o}.y) * ({b}.x - {o}.x))"


def on_edge(p: str, e: str) -> str:
    return f"({cross(f'{e}.a', f'{e}.b', p)} = 0 AND {p}.x BETWEEN least({e}.a.x, {e}.b.x) AND greatest({e}.a.x, {e}.b.x) AND {p}.y BETWEEN least({e}.a.y, {e}.b.y) AND greatest({e}.a.y, {e}.b.y))"


def near_edge(p: str, e: str) -> str:
    """On an edge but for rounding: for places that were computed."""
    size = f"(abs({e}.b.x - {e}.a.x) + abs({e}.b.y - {e}.a.y))"
    return f"(abs({cross(f'{e}.a', f'{e}.b', p)}) <= 1e-12D * {size} * ({size} + 1) AND {p}.x BETWEEN least({e}.a.x, {e}.b.x) - 1e-12D AND greatest({e}.a.x, {e}.b.x) + 1e-12D AND {p}.y BETWEEN least({e}.a.y, {e}.b.y) - 1e-12D AND greatest({e}.a.y, {e}.b.y) + 1e-12D)"


def where(place: str, g: str, exact: bool = True) -> str:
    """2 if a point is inside of a geography, 1 on its border, 0 outside. A computed place (not ``exact``) is on no point."""
    return let(f"named_struct('x', {place}.x, 'y', {place}.y)", lambda p: _where(p, g, exact))


def _where(p: str, g: str, exact: bool) -> str:
    on = on_edge if exact else near_edge
    ray = lambda e: f"(({e}.a.y > {p}.y) <> ({e}.b.y > {p}.y) AND {p}.x < ({e}.b.x - {e}.a.x) * ({p}.y - {e}.a.y) / ({e}.b.y - {e}.a.y) + {e}.a.x)"

    # of a ring or line: 1 on it, 2 inside, 0 outside
    ringed = lambda r: let(edges(r), lambda es: f"CASE WHEN {some(es, lambda e: on(p, e))} THEN {BORDER} WHEN size({keep(es, ray)}) % 2 = 1 THEN {INSIDE} ELSE {OUTSIDE} END")

    def drawn(q: str) -> str:
        holes = lambda w: f"slice({w}, 2, greatest(size({w}) - 1, 0))"
        solid = lambda w: f"CASE WHEN {w}[0] < {INSIDE} THEN {w}[0] WHEN array_contains({holes(w)}, {BORDER}) THEN {BORDER} WHEN array_contains({holes(w)}, {INSIDE}) THEN {OUTSIDE} ELSE {INSIDE} END"
        return let(each(f"{q}.rings", ringed), lambda w: f"IF({q}.kind = 2, IF({w}[0] = {BORDER}, {INSIDE}, {OUTSIDE}), {solid(w)})")

    close = (lambda a: f"({a}.x = {p}.x AND {a}.y = {p}.y)") if exact else (lambda a: f"(abs({a}.x - {p}.x) <= 1e-12D AND abs({a}.y - {p}.y) <= 1e-12D)")
    dot = (lambda q: f"IF({close(f'{q}.rings[0][0]')}, {INSIDE}, {OUTSIDE})") if exact else (lambda q: str(OUTSIDE))
    ends = keep(f"flatten({each(keep(f'{g}.parts', lambda q: f'{q}.kind = 2'), lambda q: f'array({q}.rings[0][0], {q}.rings[0][size({q}.rings[0]) - 1])')})", close)
    raw = f"coalesce(array_max({each(f'{g}.parts', lambda q: f'IF({q}.kind = 1, {dot(q)}, {drawn(q)})')}), {OUTSIDE})"
    return let(raw, lambda w: f"CASE WHEN {w} = {INSIDE} AND {some(f'{g}.parts', lambda q: f'{q}.kind = 2')} AND size({ends}) % 2 = 1 THEN {BORDER} ELSE {w} END")


def edges_meet(e: str, f: str) -> str:
    """Whether two edges share a point."""
    sides = f"named_struct('a', signum({cross(f'{e}.a', f'{e}.b', f'{f}.a')}), 'b', signum({cross(f'{e}.a', f'{e}.b', f'{f}.b')}), 'c', signum({cross(f'{f}.a', f'{f}.b', f'{e}.a')}), 'd', signum({cross(f'{f}.a', f'{f}.b', f'{e}.b')}))"
    touch = f"({on_edge(f'{f}.a', e)} OR {on_edge(f'{f}.b', e)} OR {on_edge(f'{e}.a', f)} OR {on_edge(f'{e}.b', f)})"
    return let(sides, lambda s: f"(({s}.a * {s}.b < 0 AND {s}.c * {s}.d < 0) OR {touch})")


def cuts(e: str, g: str) -> str:
    """Where along an edge (0 to 1) the edges and points of a geography meet it."""

    def by(f: str) -> str:
        r = f"named_struct('x', {e}.b.x - {e}.a.x, 'y', {e}.b.y - {e}.a.y)"
        s = f"named_struct('x', {f}.b.x - {f}.a.x, 'y', {f}.b.y - {f}.a.y)"
        w = f"named_struct('x', {f}.a.x - {e}.a.x, 'y', {f}.a.y - {e}.a.y)"

        def meet(k: str) -> str:
            d = f"({k}.r.x * {k}.s.y - {k}.r.y * {k}.s.x)"
            t = f"(({k}.w.x * {k}.s.y - {k}.w.y * {k}.s.x) / {d})"
            u = f"(({k}.w.x * {k}.r.y - {k}.w.y * {k}.r.x) / {d})"
            rr = f"({k}.r.x * {k}.r.x + {k}.r.y * {k}.r.y)"
            t0 = f"(({k}.w.x * {k}.r.x + {k}.w.y * {k}.r.y) / {rr})"
            t1 = f"((({k}.w.x + {k}.s.x) * {k}.r.x + ({k}.w.y + {k}.s.y) * {k}.r.y) / {rr})"
            return f"CASE WHEN {d} <> 0 THEN IF({t} BETWEEN 0 AND 1 AND {u} BETWEEN -1e-12D AND 1 + 1e-12D, array({t}), CAST(array() AS ARRAY<DOUBLE>)) WHEN {rr} > 0 AND {k}.w.x * {k}.r.y = {k}.w.y * {k}.r.x THEN {keep(f'array({t0}, {t1})', lambda v: f'{v} BETWEEN 0 AND 1')} ELSE CAST(array() AS ARRAY<DOUBLE>) END"

        return let(f"named_struct('r', {r}, 's', {s}, 'w', {w})", meet)

    return f"flatten({each(all_edges(g), by)})"


def pieces(a: str, b: str) -> str:
    """The edges of ``a``, cut where they meet ``b``: (p, q, w), w being where the middle lies in b."""

    def cut(e: str) -> str:
        at = lambda t: f"named_struct('x', IF({t} = 1, {e}.b.x, {e}.a.x + ({e}.b.x - {e}.a.x) * {t}), 'y', IF({t} = 1, {e}.b.y, {e}.a.y + ({e}.b.y - {e}.a.y) * {t}), 'z', CAST(NULL AS DOUBLE), 'm', CAST(NULL AS DOUBLE))"
        ts = f"array_sort(array_distinct(concat(array(0D, 1D), {cuts(e, b)})))"

        def spans(v: str) -> str:
            t, i = name(), name()
            pairs = f"transform(slice({v}, 2, size({v}) - 1), ({t}, {i}) -> named_struct('s', {v}[{i}], 't', {t}))"
            long = keep(pairs, lambda s: f"{s}.t - {s}.s > 1e-12D")
            return each(long, lambda s: let(at(f"(({s}.s + {s}.t) / 2)"), lambda m: f"named_struct('p', {at(f'{s}.s')}, 'q', {at(f'{s}.t')}, 'w', {where(m, b, exact=False)})"))

        return let(ts, spans)

    return f"flatten({each(keep(all_edges(a), lambda e: f'{e}.a.x <> {e}.b.x OR {e}.a.y <> {e}.b.y'), cut)})"


def solid(g: str) -> str:
    return some(f"{g}.parts", lambda p: f"{p}.kind = 3")


def only_points(g: str) -> str:
    return every(f"{g}.parts", lambda p: f"{p}.kind = 1")


def boxes_meet(a: str, b: str) -> str:
    return let(each(f"array({a}, {b})", box), lambda k: f"({k}[0].xmin <= {k}[1].xmax AND {k}[1].xmin <= {k}[0].xmax AND {k}[0].ymin <= {k}[1].ymax AND {k}[1].ymin <= {k}[0].ymax)")


def mirrored(a: str, b: str, use) -> str:
    """``use(k)`` with ``a`` as k.g and ``b`` as k.h, and the other way round: written once, so that no two like terms read unlike variables."""
    return each(f"array(named_struct('g', {a}, 'h', {b}), named_struct('g', {b}, 'h', {a}))", use)


def crossing(a: str, b: str) -> str:
    """Whether two of their edges meet."""
    return some(all_edges(a), lambda e: some(all_edges(b), lambda f: edges_meet(e, f)))


def intersects(a: str, b: str) -> str:
    on = mirrored(a, b, lambda k: some(points(f"{k}.g"), lambda p: f"{where(p, f'{k}.h')} > 0"))
    # the dearer test only where the other fails
    return f"CASE WHEN NOT {boxes_meet(a, b)} THEN false WHEN array_contains({on}, true) THEN true ELSE {crossing(a, b)} END"


def beside(s: str) -> str:
    """Two places beside the middle of a piece, one on either side."""
    place = lambda k: f"named_struct('x', ({s}.p.x + {s}.q.x) / 2 + {k} * ({s}.q.y - {s}.p.y), 'y', ({s}.p.y + {s}.q.y) / 2 - {k} * ({s}.q.x - {s}.p.x))"
    return f"array({place('1e-6D')}, {place('-1e-6D')})"


def _side(k: str) -> str:
    """What there is to know of k.g as to k.h, as flags.

    ``meets``: a corner of it is on the other; ``out``: part of it is outside of the other; ``run``: an edge of it has a piece in the other's inside;
    ``dot``: so has one of its points; ``both``: beside a border that they share, or where lines cross, is the inside of both.
    """
    g, h = f"{k}.g", f"{k}.h"
    placed = each(f"{g}.parts", lambda q: f"named_struct('kind', {q}.kind, 'w', {each(f'flatten({q}.rings)', lambda p: where(p, h))})")
    xy = lambda p: f"named_struct('x', {p}.x, 'y', {p}.y)"
    nowhere = "CAST(array() AS ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>)"

    def told(s: str) -> str:
        asked = f"CASE WHEN {s}.w = 1 AND {solid(g)} THEN {beside(s)} WHEN NOT ({solid(g)} OR {solid(h)}) THEN array({xy(f'{s}.p')}, {xy(f'{s}.q')}) ELSE {nowhere} END"
        lie = each(asked, lambda m: each(f"array({g}, {h})", lambda x: where(m, x, exact=False)))
        return f"named_struct('w', {s}.w, 'lie', {lie})"

    def flags(at: str, ps: str) -> str:
        all_at = f"flatten({each(at, lambda q: f'{q}.w')})"
        gone = some(ps, lambda s: f"{s}.w = 1 AND array_contains({s}.lie, array(2, 0))")
        out = f"array_contains(array(array_contains({all_at}, 0), array_contains({each(ps, lambda s: f'{s}.w')}, 0), {gone}), true)"
        return (
            f"named_struct('solid', {solid(g)}, 'meets', coalesce(array_max({all_at}), 0) > 0, 'out', {out}, 'run', array_contains({each(ps, lambda s: f'{s}.w')}, 2), "
            f"'dot', {some(at, lambda q: f'{q}.kind = 1 AND {q}.w[0] = 2')}, 'both', {some(ps, lambda s: f'array_contains({s}.lie, array(2, 2))')})"
        )

    return let(placed, lambda at: let(each(pieces(g, h), told), lambda ps: flags(at, ps)))


def related(a: str, b: str, use) -> str:
    """``use(x, y)`` with the flags of ``a`` as to ``b`` and of ``b`` as to ``a``; false where their boxes are apart."""
    return f"CASE WHEN NOT {boxes_meet(a, b)} THEN false ELSE {let(mirrored(a, b, _side), lambda k: use(f'{k}[0]', f'{k}[1]'))} END"


def _covers(x: str, y: str) -> str:
    """No point of the second is outside of the first. Where an area's border runs along that of the other, its inside has to be on the same side."""
    return f"(NOT {y}.out AND (NOT {y}.solid OR ({x}.solid AND NOT {x}.run)))"


def covers(a: str, b: str) -> str:
    return related(a, b, _covers)


def contains(a: str, b: str) -> str:
    """Covers, and some point of b's inside is inside of a."""
    return related(a, b, lambda x, y: f"({_covers(x, y)} AND ({y}.dot OR {y}.run OR {y}.solid))")


def touches(a: str, b: str) -> str:
    """They meet, but their insides do not; a line's piece along an area's border is no meeting of insides."""
    # a line's piece inside of an area or along the inside of a line, or an area's border inside of an area
    runs = lambda x, y: f"((NOT {x}.solid OR {y}.solid) AND {x}.run)"
    inner = lambda x, y: f"({x}.dot OR {y}.dot OR {runs(x, y)} OR {runs(y, x)} OR ({x}.solid = {y}.solid AND {x}.both))"
    return related(a, b, lambda x, y: f"IF({inner(x, y)}, false, IF({x}.meets OR {y}.meets, true, {crossing(a, b)}))")


def equals(a: str, b: str) -> str:
    return related(a, b, lambda x, y: f"({_covers(x, y)} AND {_covers(y, x)})")


def nearest_on_edge(p: str, e: str) -> str:
    """The place on an edge that is nearest to a point, in the plane."""
    rr = f"(pow({e}.b.x - {e}.a.x, 2) + pow({e}.b.y - {e}.a.y, 2))"
    t = f"IF({rr} = 0, 0D, least(1D, greatest(0D, (({p}.x - {e}.a.x) * ({e}.b.x - {e}.a.x) + ({p}.y - {e}.a.y) * ({e}.b.y - {e}.a.y)) / {rr})))"
    return let(t, lambda k: f"named_struct('x', {e}.a.x + ({e}.b.x - {e}.a.x) * {k}, 'y', {e}.a.y + ({e}.b.y - {e}.a.y) * {k})")


def closest(g: str, h: str, segments_g: str, segments_h: str) -> str:
    """The point of g nearest to h in the plane, as (d, p)."""
    far = lambda p, q: f"(pow({p}.x - {q}.x, 2) + pow({p}.y - {q}.y, 2))"
    xy = lambda p: f"named_struct('x', {p}.x, 'y', {p}.y)"

    def pair(s: str, t: str) -> str:
        onto_g = [let(nearest_on_edge(q, s), lambda f, q=q: f"named_struct('d', {far(f, q)}, 'p', {f})") for q in (f"{t}.a", f"{t}.b")]
        onto_h = [let(nearest_on_edge(p, t), lambda f, p=p: f"named_struct('d', {far(f, p)}, 'p', {xy(p)})") for p in (f"{s}.a", f"{s}.b")]
        den = f"(({s}.b.x - {s}.a.x) * ({t}.b.y - {t}.a.y) - ({s}.b.y - {s}.a.y) * ({t}.b.x - {t}.a.x))"
        u = f"((({t}.a.x - {s}.a.x) * ({t}.b.y - {t}.a.y) - ({t}.a.y - {s}.a.y) * ({t}.b.x - {t}.a.x)) / {den})"
        meet = f"CASE WHEN {den} <> 0 AND {edges_meet(s, t)} THEN named_struct('d', 0D, 'p', named_struct('x', {s}.a.x + ({s}.b.x - {s}.a.x) * {u}, 'y', {s}.a.y + ({s}.b.y - {s}.a.y) * {u})) END"
        return f"array_min(filter(array({', '.join([*onto_g, *onto_h, meet])}), c -> c IS NOT NULL))"

    s, t = name(), name()
    return f"array_min(flatten(transform({segments_g}, {s} -> transform({segments_h}, {t} -> {pair(s, t)}))))"


def hull(pts: str) -> str:
    """The convex hull of points as a closed ring, clockwise from its lowest point; fewer than three corners as they are."""
    o = "CAST(array() AS ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>)"

    def chain(order: str) -> str:
        acc, p, k, j = name(), name(), name(), name()
        # how many of the last corners to drop: the first count at which the turn is right
        turn = lambda h: f"aggregate(sequence(1, greatest(size({h}) - 1, 1)), size({h}), ({k}, {j}) -> IF({k} >= 2 AND (({h}[{k} - 1].x - {h}[{k} - 2].x) * ({p}.y - {h}[{k} - 2].y) - ({h}[{k} - 1].y - {h}[{k} - 2].y) * ({p}.x - {h}[{k} - 2].x)) >= 0, {k} - 1, {k}))"
        return f"aggregate({order}, {o}, ({acc}, {p}) -> concat(slice({acc}, 1, {turn(acc)}), array({p})))"

    sorted_ = f"array_sort(array_distinct({each(pts, lambda v: f'named_struct("x", {v}.x, "y", {v}.y)')}))"

    def both(s: str) -> str:
        upper, lower = chain(s), chain(f"reverse({s})")
        joined = let(f"named_struct('u', {upper}, 'l', {lower})", lambda c: f"concat(slice({c}.u, 1, size({c}.u) - 1), slice({c}.l, 1, size({c}.l) - 1))")

        def turned(r: str) -> str:
            low = f"array_min({each(r, lambda v: f'named_struct("y", {v}.y, "x", {v}.x)')})"
            at = let(low, lambda m: f"array_position({r}, named_struct('x', {m}.x, 'y', {m}.y))")
            return let(at, lambda k: f"concat(slice({r}, CAST({k} AS INT), size({r})), slice({r}, 1, CAST({k} AS INT)))")

        return f"IF(size({s}) < 3, {s}, {let(joined, lambda r: f'IF(size({r}) < 3, {r}, {turned(r)})')})"

    return let(sorted_, both)


def simplified(ring: str, tolerance: str) -> str:
    """Douglas-Peucker: the places that are kept, found level by level."""
    kept, i, k, j, v = name(), name(), name(), name(), name()
    last = f"(size({ring}) - 1)"

    def split(a: str, b: str) -> str:
        e = f"named_struct('a', {ring}[{a}], 'b', {ring}[{b}])"
        far = let(e, lambda s: f"array_max(transform(sequence({a} + 1, {b} - 1), {v} -> named_struct('d', {let(nearest_on_edge(f'{ring}[{v}]', s), lambda f: f'pow({ring}[{v}].x - {f}.x, 2) + pow({ring}[{v}].y - {f}.y, 2)')}, 'i', -{v})))")
        return f"IF({b} - {a} < 2, CAST(array() AS ARRAY<INT>), {let(far, lambda m: f'IF({m}.d > pow({tolerance}, 2), array(-{m}.i), CAST(array() AS ARRAY<INT>))')})"

    level = f"flatten(transform(slice({kept}.at, 2, size({kept}.at) - 1), ({k}, {j}) -> {split(f'{kept}.at[{j}]', k)}))"
    grow = let(level, lambda n: f"IF(size({n}) = 0, named_struct('at', {kept}.at, 'done', true), named_struct('at', array_sort(concat({kept}.at, {n})), 'done', false))")
    run = f"aggregate(sequence(1, greatest({last}, 1)), named_struct('at', array(0, {last}), 'done', false), ({kept}, {i}) -> IF({kept}.done, {kept}, {grow}))"
    return f"IF(size({ring}) < 3, {ring}, {let(run, lambda r: each(f'{r}.at', lambda k2: f'{ring}[{k2}]'))})"


def self_crossing(ring: str) -> str:
    """Whether a line meets itself other than at its closing point."""
    es = f"transform({edges(ring)}, (e0, i0) -> named_struct('a', e0.a, 'b', e0.b, 'i', i0))"

    def pair(e: str, f: str, n: str) -> str:
        apart = f"({f}.i - {e}.i > 1 AND NOT ({e}.i = 0 AND {f}.i = {n} - 1 AND {e}.a.x = {f}.b.x AND {e}.a.y = {f}.b.y))"
        folded = f"({f}.i - {e}.i = 1 AND {on_edge(f'{f}.b', e)})"
        return f"(({apart} AND {edges_meet(e, f)}) OR {folded})"

    return let(es, lambda v: some(v, lambda e: some(v, lambda f: pair(e, f, f"size({v})"))))


__all__ = ["rings"]
