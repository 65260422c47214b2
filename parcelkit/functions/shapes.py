"""Validity of parsed polygons (S13): rings that do not meet themselves, holes
inside their shell, parts whose interiors are apart.

Edges are straight lines in longitude and latitude, as the text format defines
them.  Positions within ``EPS`` degrees (about a micrometre) of a line are on it.

* A ring has three edges or more once repeated neighbouring positions are taken
  as one.  Edges that are not neighbours share no point, neighbours share their
  common end only: no crossing, no touching, no edge folded back.
* Rings of one polygon, and of two parts, may touch in points.  No edge crosses
  another or runs along it.
* No piece of a hole's edges (cut where the other ring's positions lie on it) is
  outside the shell, none is inside another hole, and none of a part's shell is in
  another part's interior.  A part may lie in another one's hole.

That the interior is in one piece is not checked.  The test is one expression over
one row.  Edges lie in groups of about the square root of their number, each with
its box; two edges are compared only if their groups' boxes and their own meet.

The helpers here give SQL text, which Spark parses once: the expression has some
thousand nodes, too many to put together one by one from Python.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-11
_EPS = f"{EPS!r}D"
_names = count()

Text = Callable[..., str]


def _fn(name: str, items: str, body: Text, index: bool = False) -> str:
    """``name(items, v -> body(v))`` with a variable name of its own."""
    v = f"v{next(_names)}"
    if index:
        return f"{name}({items}, ({v}, {v}i) -> {body(v, v + 'i')})"
    return f"{name}({items}, {v} -> {body(v)})"


def _let(value: str, body: Text) -> str:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return f"element_at({_fn('transform', f'array({value})', body)}, 1)"


def _span(items: str) -> str:
    """Fields w, e, s, n around some boxes."""
    return ", ".join(f"array_{a}({_fn('transform', items, lambda b, f=f: f'{b}.{f}')}) AS {f}"
                     for f, a in (("w", "min"), ("e", "max"), ("s", "min"), ("n", "max")))


def _edge(p: str, q: str, i: str) -> str:
    return (f"struct({i} AS i, {p}[0] AS x1, {p}[1] AS y1, {q}[0] AS x2, {q}[1] AS y2, least({p}[0], {q}[0]) AS w, "
            f"greatest({p}[0], {q}[0]) AS e, least({p}[1], {q}[1]) AS s, greatest({p}[1], {q}[1]) AS n)")


def _edges(ring: str) -> str:
    """Edges of a ring's positions; a position that repeats the one before it makes none."""
    apart = _fn("filter", ring, lambda p, i: f"{i} = 0 OR {p}[0] <> get({ring}, {i} - 1)[0] OR {p}[1] <> get({ring}, {i} - 1)[1]",
                index=True)

    def joined(pts: str) -> str:
        numbers = _fn("filter", f"sequence(1, greatest(size({pts}), 1))", lambda k: f"{k} < size({pts})")
        return _fn("transform", numbers, lambda k: _let(f"get({pts}, {k} - 1)", lambda p: _let(
            f"get({pts}, {k})", lambda q: _edge(p, q, k))))
    return _let(apart, joined)


def _ring(edges: str) -> str:
    """struct(count, groups of neighbouring edges with their boxes, the ring's box)."""
    def group(k: str, each: str) -> str:
        return _let(f"slice({edges}, {k} * {each} + 1, {each})", lambda part: f"struct({k} AS k, {part} AS edges, {_span(part)})")

    def groups(each: str) -> str:
        last = f"greatest(CAST(floor((size({edges}) - 1) / {each}) AS INT), 0)"
        return _fn("transform", f"sequence(0, {last})", lambda k: group(k, each))

    grouped = _let(f"greatest(CAST(ceil(sqrt(size({edges}))) AS INT), 8)", groups)
    return _let(grouped, lambda g: f"struct(size({edges}) AS count, {g} AS groups, {_span(g)})")


def _boxes_meet(a: str, b: str) -> str:
    return f"({a}.w <= {b}.e + {_EPS} AND {b}.w <= {a}.e + {_EPS} AND {a}.s <= {b}.n + {_EPS} AND {b}.s <= {a}.n + {_EPS})"


def _cross(a: str, x: str, y: str) -> str:
    return f"(({a}.x2 - {a}.x1) * ({y} - {a}.y1) - ({a}.y2 - {a}.y1) * ({x} - {a}.x1))"


def _side(a: str, x: str, y: str) -> str:
    """1 left of the edge's line, -1 right of it, 0 on it."""
    near = f"{_EPS} * greatest(abs({a}.x2 - {a}.x1), abs({a}.y2 - {a}.y1))"
    return f"IF(abs({_cross(a, x, y)}) > {near}, sign({_cross(a, x, y)}), 0D)"


def _on(a: str, x: str, y: str) -> str:
    """Whether a position lies on the edge."""
    return (f"({x} BETWEEN {a}.w - {_EPS} AND {a}.e + {_EPS} AND {y} BETWEEN {a}.s - {_EPS} AND {a}.n + {_EPS} "
            f"AND {_side(a, x, y)} = 0)")


def _sides(a: str, b: str, body: Text) -> str:
    """``body`` of the sides of b's ends at a and of a's ends at b."""
    four = ", ".join([_side(a, f"{b}.x1", f"{b}.y1"), _side(a, f"{b}.x2", f"{b}.y2"),
                      _side(b, f"{a}.x1", f"{a}.y1"), _side(b, f"{a}.x2", f"{a}.y2")])
    return _let(f"array({four})", lambda o: f"({body(*(f'{o}[{i}]' for i in range(4)))})")


def _share_a_point(a: str, b: str) -> str:
    return _sides(a, b, lambda p, q, r, s: f"{p} * {q} <= 0 AND {r} * {s} <= 0")


def _cross_or_run_along(a: str, b: str) -> str:
    along = (f"(least({a}.e, {b}.e) - greatest({a}.w, {b}.w) > {_EPS} OR least({a}.n, {b}.n) - greatest({a}.s, {b}.s) > {_EPS})")
    return _sides(a, b, lambda p, q, r, s: f"({p} * {q} < 0 AND {r} * {s} < 0) OR ({p} = 0 AND {q} = 0 AND {along})")


def _any_pair(a: str, b: str, test: Text, once: bool = False) -> str:
    """Whether two edges of the rings with meeting boxes pass ``test``; ``once``: each pair of one ring's edges."""
    def edges(x: str, y: str) -> str:
        return f"{f'{y}.i > {x}.i AND ' if once else ''}{_boxes_meet(x, y)} AND {test(x, y)}"

    def groups(g: str, h: str) -> str:
        found = _fn("exists", f"{g}.edges", lambda x: f"{_boxes_meet(x, h)} AND " + _fn("exists", f"{h}.edges", lambda y: edges(x, y)))
        return f"{f'{h}.k >= {g}.k AND ' if once else ''}{_boxes_meet(g, h)} AND {found}"
    return _fn("exists", f"{a}.groups", lambda g: _fn("exists", f"{b}.groups", lambda h: groups(g, h)))


def _any(flags: str) -> str:
    return _fn("exists", flags, lambda f: f)


def _any_two(items: str, test: Text) -> str:
    """Whether two items pass ``test``, the earlier one first."""
    return _any(_fn("transform", items, lambda a, i: _any(_fn(
        "transform", items, lambda b, j: f"{j} > {i} AND {test(a, b)}", index=True)), index=True))


def _ring_is_simple(ring: str) -> str:
    def bad(a: str, b: str) -> str:
        # Neighbours share an end: they meet elsewhere only if one folds back along the other.
        next_, closing = f"{b}.i = {a}.i + 1", f"({a}.i = 1 AND {b}.i = {ring}.count)"
        back = f"({a}.x2 - {a}.x1) * ({b}.x2 - {b}.x1) + ({a}.y2 - {a}.y1) * ({b}.y2 - {b}.y1) < 0"
        far = _side(a, f"IF({next_}, {b}.x2, {b}.x1)", f"IF({next_}, {b}.y2, {b}.y1)")
        return f"IF({next_} OR {closing}, {back} AND {far} = 0, {_share_a_point(a, b)})"
    return f"({ring}.count >= 3 AND NOT {_any_pair(ring, ring, bad, once=True)})"


def _on_ring(ring: str, x: str, y: str) -> str:
    return _fn("exists", f"{ring}.groups", lambda g: _fn("exists", f"{g}.edges", lambda e: _on(e, x, y)))


def _in_ring(ring: str, x: str, y: str) -> str:
    """Inside by the number of edges that a ray to the east crosses; not meant for positions on the ring."""
    def crossed(e: str) -> str:
        return f"({e}.y1 > {y}) <> ({e}.y2 > {y}) AND ({_cross(e, x, y)} > 0) = ({e}.y2 > {e}.y1)"
    each = _fn("transform", f"{ring}.groups", lambda g: f"IF({y} BETWEEN {g}.s AND {g}.n, "
               f"size({_fn('filter', f'{g}.edges', crossed)}), 0)")
    return f"(aggregate({each}, 0, (n, c) -> n + c) % 2 = 1)"


def _pieces(a: str, rings: str) -> str:
    """Middles of the pieces into which the rings' positions cut an edge."""
    def share(e: str) -> str:
        return (f"IF(abs({a}.x2 - {a}.x1) >= abs({a}.y2 - {a}.y1), try_divide({e}.x1 - {a}.x1, {a}.x2 - {a}.x1), "
                f"try_divide({e}.y1 - {a}.y1, {a}.y2 - {a}.y1))")

    def cuts(ring: str) -> str:
        near = _fn("filter", f"{ring}.groups", lambda g: _boxes_meet(a, g))
        return "flatten(" + _fn("transform", near, lambda g: _fn(
            "transform", _fn("filter", f"{g}.edges", lambda e: _on(a, f"{e}.x1", f"{e}.y1")), share)) + ")"

    def middle(t: str) -> str:
        return f"struct({a}.x1 + {t} * ({a}.x2 - {a}.x1) AS x, {a}.y1 + {t} * ({a}.y2 - {a}.y1) AS y)"

    at = f"array_sort(concat(array(0D, 1D), flatten({_fn('transform', rings, cuts)})))"
    return _let(at, lambda t: _fn("transform", f"sequence(1, size({t}) - 1)",
                                  lambda k: _let(f"(get({t}, {k} - 1) + get({t}, {k})) / 2", middle)))


def _any_piece(ring: str, others: str, test: Text) -> str:
    """Whether the middle of a piece of the ring's edges passes ``test``."""
    return _fn("exists", f"{ring}.groups", lambda g: _fn("exists", f"{g}.edges", lambda a: _fn(
        "exists", _pieces(a, others), lambda m: test(f"{m}.x", f"{m}.y"))))


def _holes_stay_inside(rings: str) -> str:
    """Shell first, then its holes; each ring is simple."""
    def leaves(hole: str) -> str:
        shell = f"{rings}[0]"
        outside = _any_piece(hole, f"array({shell})", lambda x, y: f"NOT {_in_ring(shell, x, y)} AND NOT {_on_ring(shell, x, y)}")
        return f"({_any_pair(shell, hole, _cross_or_run_along)} OR {outside})"
    return f"(size({rings}) = 1 OR NOT {_fn('exists', f'slice({rings}, 2, size({rings}))', leaves)})"


def _are_apart(parts: str) -> str:
    """Whether no two polygons (shell and holes each) share more than points."""
    def interior(part: str, x: str, y: str) -> str:
        on = _fn("exists", part, lambda r: _on_ring(r, x, y))
        rings = _fn("transform", part, lambda r: _in_ring(r, x, y))
        return _let(rings, lambda i: f"{i}[0] AND NOT {on} AND NOT exists(slice({i}, 2, size({i})), h -> h)")

    def enters(pair: str) -> str:
        return _any_piece(f"{pair}.a[0]", f"{pair}.b", lambda x, y: interior(f"{pair}.b", x, y))

    def clash(a: str, b: str) -> str:
        met = _fn("exists", a, lambda r: _fn("exists", b, lambda s: (
            f"{_boxes_meet(r, s)} AND {_any_pair(r, s, _cross_or_run_along)}")))
        both = f"array(struct({a} AS a, {b} AS b), struct({b} AS a, {a} AS b))"
        return f"({_boxes_meet(f'{a}[0]', f'{b}[0]')} AND ({met} OR {_fn('exists', both, enters)}))"

    return f"(size({parts}) < 2 OR NOT {_any_two(parts, clash)})"


def _valid(polys: str) -> str:
    parts = _fn("transform", polys, lambda p: _fn("transform", p, lambda ring: _let(_edges(ring), _ring)))
    # Holes of one polygon must be apart as parts must be: each hole counts as a polygon.
    holes = lambda q: _fn("transform", q, lambda p: f"transform(slice({p}, 2, size({p})), h -> array(h))")
    return _let(parts, lambda q: " AND ".join([
        _fn("forall", q, lambda p: _fn("forall", p, _ring_is_simple)), _fn("forall", q, _holes_stay_inside),
        _fn("forall", f"concat(array({q}), {holes(q)})", _are_apart)]))


def valid_only(shapes: Column) -> Column:
    """Of an array of parsed shapes (each polygons -> rings -> positions, every ring closed), those that keep the rules."""
    return F.call_function("filter", shapes, F.expr(f"shape -> {_valid('shape')}"))
