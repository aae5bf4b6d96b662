"""Geodesic snippets: the sphere, the spheroid, and planar angles."""

from __future__ import annotations

import math

from .shape import A, B, F_, R, all_edges, each, edges, empty, every, keep, let, name, points, rings, same_point, segments, some, total


def hav(a: str, b: str, radius: float = R) -> str:
    """Distance of two points on the sphere."""
    dl = f"radians({b}.x - {a}.x)"
    u, v = f"radians({a}.y)", f"radians({b}.y)"
    return (
        f"({radius!r}D * atan2(sqrt(pow(cos({v}) * sin({dl}), 2) + pow(cos({u}) * sin({v}) - sin({u}) * cos({v}) * cos({dl}), 2)), "
        f"sin({u}) * sin({v}) + cos({u}) * cos({v}) * cos({dl})))"
    )


def rounded(d: str) -> str:
    """Metres to a tenth of a micrometre."""
    return f"(rint({d} * 1e7) / 1e7)"


def vincenty(a: str, b: str, use) -> str:
    """``use(s)`` with the inverse solution on the spheroid: s.d metres, s.az the bearing from a to b."""
    s, i = name(), name()
    u = lambda p: f"atan({1 - F_!r}D * tan(radians({p}.y)))"

    def solved(c: str) -> str:
        l = f"{c}.l"  # noqa: E741

        def values(lam: str, then) -> str:
            ss = f"sqrt(pow({c}.cv * sin({lam}), 2) + pow({c}.cu * {c}.sv - {c}.su * {c}.cv * cos({lam}), 2))"
            cs = f"({c}.su * {c}.sv + {c}.cu * {c}.cv * cos({lam}))"
            return let(f"named_struct('ss', {ss}, 'cs', {cs})", lambda k: let(f"named_struct('ss', {k}.ss, 'cs', {k}.cs, 'sg', atan2({k}.ss, {k}.cs), 'sa', IF({k}.ss = 0, 0D, {c}.cu * {c}.cv * sin({lam}) / {k}.ss))", lambda k2: let(f"named_struct('ss', {k2}.ss, 'cs', {k2}.cs, 'sg', {k2}.sg, 'sa', {k2}.sa, 'c2', 1 - {k2}.sa * {k2}.sa, 'cm', IF(1 - {k2}.sa * {k2}.sa = 0, 0D, {k2}.cs - 2 * {c}.su * {c}.sv / (1 - {k2}.sa * {k2}.sa)))", then)))

        def next_(k: str) -> str:
            cc = f"({F_ / 16!r}D * {k}.c2 * (4 + {F_!r}D * (4 - 3 * {k}.c2)))"
            return let(cc, lambda q: f"{l} + (1 - {q}) * {F_!r}D * {k}.sa * ({k}.sg + {q} * {k}.ss * ({k}.cm + {q} * {k}.cs * (-1 + 2 * {k}.cm * {k}.cm)))")

        lam = f"aggregate(sequence(1, 40), {l}, ({s}, {i}) -> {values(s, next_)})"

        def finish(w: str) -> str:
            def out(k: str) -> str:
                u2 = f"({k}.c2 * {(A * A - B * B) / (B * B)!r}D)"
                big = lambda x: f"(1 + {x} / 16384 * (4096 + {x} * (-768 + {x} * (320 - 175 * {x}))))"
                small = lambda x: f"({x} / 1024 * (256 + {x} * (-128 + {x} * (74 - 47 * {x}))))"
                ds = lambda q: f"({q} * {k}.ss * ({k}.cm + {q} / 4 * ({k}.cs * (-1 + 2 * {k}.cm * {k}.cm) - {q} / 6 * {k}.cm * (-3 + 4 * {k}.ss * {k}.ss) * (-3 + 4 * {k}.cm * {k}.cm))))"
                d = let(u2, lambda x: let(small(x), lambda q: f"{B!r}D * {big(x)} * ({k}.sg - {ds(q)})"))
                az = f"atan2({c}.cv * sin({w}), {c}.cu * {c}.sv - {c}.su * {c}.cv * cos({w}))"
                return let(f"named_struct('d', {d}, 'az', {az})", use)

            return values(w, out)

        return let(lam, finish)

    start = let(f"named_struct('u', {u(a)}, 'v', {u(b)})", lambda t: let(f"named_struct('l', radians({b}.x - {a}.x), 'su', sin({t}.u), 'cu', cos({t}.u), 'sv', sin({t}.v), 'cv', cos({t}.v))", solved))
    return start


def spheroid(a: str, b: str) -> str:
    return f"IF({same_point(a, b)}, 0D, {vincenty(a, b, lambda s: f'{s}.d')})"


def unit(p: str) -> str:
    return f"named_struct('x', cos(radians({p}.y)) * cos(radians({p}.x)), 'y', cos(radians({p}.y)) * sin(radians({p}.x)), 'z', sin(radians({p}.y)))"


def _cross(a: str, b: str) -> str:
    return f"named_struct('x', {a}.y * {b}.z - {a}.z * {b}.y, 'y', {a}.z * {b}.x - {a}.x * {b}.z, 'z', {a}.x * {b}.y - {a}.y * {b}.x)"


def _dot(a: str, b: str) -> str:
    return f"({a}.x * {b}.x + {a}.y * {b}.y + {a}.z * {b}.z)"


def nearest_on(p: str, a: str, b: str) -> str:
    """The place on the arc from a to b that is nearest to p."""

    def arc(v: str) -> str:
        n = _cross(f"{v}.a", f"{v}.b")

        def foot(k: str) -> str:
            inside = f"{_dot(f'{k}.q', f'{k}.na')} > 0 AND {_dot(f'{k}.q', f'{k}.bn')} > 0 AND {_dot(f'{k}.n', f'{k}.n')} > 1e-30D"
            t = f"({_dot(f'{k}.q', f'{k}.n')} / {_dot(f'{k}.n', f'{k}.n')})"
            on = let(f"named_struct('x', {k}.q.x - {t} * {k}.n.x, 'y', {k}.q.y - {t} * {k}.n.y, 'z', {k}.q.z - {t} * {k}.n.z)", lambda c: f"named_struct('x', degrees(atan2({c}.y, {c}.x)), 'y', degrees(atan2({c}.z, sqrt({c}.x * {c}.x + {c}.y * {c}.y))))")
            end = lambda e: f"named_struct('x', {e}.x, 'y', {e}.y)"
            return f"CASE WHEN {inside} THEN {on} WHEN {hav(p, a)} <= {hav(p, b)} THEN {end(a)} ELSE {end(b)} END"

        return let(n, lambda m: let(f"named_struct('q', {v}.p, 'n', {m}, 'na', {_cross(m, f'{v}.a')}, 'bn', {_cross(f'{v}.b', m)})", foot))

    return let(f"named_struct('p', {unit(p)}, 'a', {unit(a)}, 'b', {unit(b)})", arc)


def arcs_cross(s: str, t: str) -> str:
    """Whether two arcs cross in their insides."""
    side = lambda n, p: _dot(n, p)
    return let(
        f"named_struct('a', {unit(f'{s}.a')}, 'b', {unit(f'{s}.b')}, 'c', {unit(f'{t}.a')}, 'd', {unit(f'{t}.b')})",
        lambda u: let(
            f"named_struct('m', {_cross(f'{u}.a', f'{u}.b')}, 'n', {_cross(f'{u}.c', f'{u}.d')})",
            lambda k: f"({side(f'{k}.m', f'{u}.c')} * {side(f'{k}.m', f'{u}.d')} < 0 AND {side(f'{k}.n', f'{u}.a')} * {side(f'{k}.n', f'{u}.b')} < 0 AND {side(f'{u}.a', f'{u}.c')} + {side(f'{u}.a', f'{u}.d')} > 0)",
        ),
    )


def nearest_pair(g: str, h: str) -> str:
    """Of all edges' ends and their feet on the other's edges, the pair (p, q) with the least sphere distance; p is on g."""

    def pairs(s: str, t: str) -> str:
        ends = [(f"{t}.a", s, False), (f"{t}.b", s, False), (f"{s}.a", t, True), (f"{s}.b", t, True)]
        made = []
        for p, e, own in ends:
            foot = nearest_on(p, f"{e}.a", f"{e}.b")
            far = f"named_struct('x', {p}.x, 'y', {p}.y)"
            made.append(let(foot, lambda f, far=far, own=own, p=p: f"named_struct('d', {hav(p, f)}, 'p', {far if own else f}, 'q', {f if own else far})"))
        return f"array_min(array({', '.join(made)}))"

    s, t = name(), name()
    return f"array_min(flatten(transform({segments(g)}, {s} -> transform({segments(h)}, {t} -> {pairs(s, t)}))))"


def crossing(g: str, h: str) -> str:
    return some(all_edges(g), lambda s: some(all_edges(h), lambda t: arcs_cross(s, t)))


def farthest(g: str, h: str) -> str:
    """The greatest spheroid distance of their vertices."""
    return f"array_max(flatten({each(points(g), lambda p: each(points(h), lambda q: spheroid(p, q)))}))"


def line_length(ring: str, on_spheroid: str, flags: str) -> str:
    def leg(e: str) -> str:
        flat = f"IF({on_spheroid}, {spheroid(f'{e}.a', f'{e}.b')}, {hav(f'{e}.a', f'{e}.b')})"
        # a leg from or to a place without coordinates adds nothing
        return f"coalesce(IF({flags} & 1 = 1, sqrt(pow({flat}, 2) + pow({e}.b.z - {e}.a.z, 2)), {flat}), 0D)"

    return total(edges(ring), leg)


def ring_area(ring: str, radius: str = repr(R)) -> str:
    """Area of a ring on the sphere: signed triangles from its first point, by the tangent formula of their excess."""

    def triangle(e: str) -> str:
        abc = [f"{e}.o", f"{e}.a", f"{e}.b"]
        triple = _dot(abc[0], f"{e}.n")
        return f"2 * atan2({triple}, 1 + {_dot(abc[0], abc[1])} + {_dot(abc[1], abc[2])} + {_dot(abc[2], abc[0])})"

    vectors = each(ring, unit)
    legs = lambda vs: each(edges(vs), lambda e: let(_cross(f"{e}.a", f"{e}.b"), lambda n: f"named_struct('o', {vs}[0], 'a', {e}.a, 'b', {e}.b, 'n', {n})"))
    return f"(abs({let(vectors, lambda vs: total(legs(vs), triangle))}) * {radius}D * {radius}D)"


_E2 = (A * A - B * B) / (A * A)
_E = math.sqrt(_E2)
_q = lambda s: (1 - _E2) * (s / (1 - _E2 * s * s) - math.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))
_QP = _q(1.0)


def authalic_area(ring: str) -> str:
    """Area on the spheroid: that of the ring on the sphere of the same surface, each latitude moved to where it bounds the same area."""

    def moved(p: str) -> str:
        s = f"sin(radians({p}.y))"
        q = let(s, lambda v: f"({1 - _E2!r}D * ({v} / (1 - {_E2!r}D * {v} * {v}) - ln((1 - {_E!r}D * {v}) / (1 + {_E!r}D * {v})) / {2 * _E!r}D))")
        return f"named_struct('x', {p}.x, 'y', degrees(asin(greatest(-1D, least(1D, {q} / {_QP!r}D)))))"

    return let(each(ring, moved), lambda r: ring_area(r, repr(A * math.sqrt(_QP / 2))))


def centroid(g: str) -> str:
    """The unit vectors' mean: points alike, edges by length, polygons by the area of triangles from their first point."""
    scaled = lambda v, w: f"named_struct('x', {v}.x * {w}, 'y', {v}.y * {w}, 'z', {v}.z * {w})"
    single = each(keep(points(g), lambda p: "true"), unit)
    leg = lambda e: let(f"named_struct('a', {unit(f'{e}.a')}, 'b', {unit(f'{e}.b')}, 'w', {hav(f'{e}.a', f'{e}.b')})", lambda u: f"named_struct('x', ({u}.a.x + {u}.b.x) * {u}.w, 'y', ({u}.a.y + {u}.b.y) * {u}.w, 'z', ({u}.a.z + {u}.b.z) * {u}.w)")
    line = each(all_edges(g), leg)

    def area(r: str) -> str:
        def tri(o: str, e: str) -> str:
            return let(f"named_struct('o', {unit(o)}, 'a', {unit(f'{e}.a')}, 'b', {unit(f'{e}.b')})", lambda u: let(f"abs(2 * atan2({let(_cross(f'{u}.a', f'{u}.b'), lambda n: _dot(f'{u}.o', n))}, 1 + {_dot(f'{u}.o', f'{u}.a')} + {_dot(f'{u}.a', f'{u}.b')} + {_dot(f'{u}.b', f'{u}.o')}))", lambda w: let(f"named_struct('x', {u}.o.x + {u}.a.x + {u}.b.x, 'y', {u}.o.y + {u}.a.y + {u}.b.y, 'z', {u}.o.z + {u}.a.z + {u}.b.z)", lambda v: scaled(v, w))))

        return each(edges(r), lambda e: tri(f"{r}[0]", e))

    solid = f"flatten({each(rings(g), area)})"
    vectors = f"CASE WHEN {g}.kind IN (1, 4) THEN {single} WHEN {g}.kind IN (2, 5) THEN {line} ELSE {solid} END"
    summed = lambda vs: f"named_struct('x', {total(vs, lambda v: f'{v}.x')}, 'y', {total(vs, lambda v: f'{v}.y')}, 'z', {total(vs, lambda v: f'{v}.z')})"
    return let(vectors, lambda vs: let(summed(vs), lambda c: f"named_struct('x', degrees(atan2({c}.y, {c}.x)), 'y', degrees(atan2({c}.z, sqrt({c}.x * {c}.x + {c}.y * {c}.y))))"))


def azimuth(a: str, b: str) -> str:
    """Bearing on the spheroid, from 0 to a full turn; due north is half a turn, as the results to match have it."""
    turned = vincenty(a, b, lambda s: f"CASE WHEN {s}.az > 0 THEN {s}.az ELSE IF({s}.az = 0, pi(), 2 * pi() + {s}.az) END")
    return f"CASE WHEN abs({a}.x - {b}.x) <= 1e-12D AND abs({a}.y - {b}.y) <= 1e-12D THEN NULL ELSE {turned} END"


__all__ = ["every", "empty"]
