"""Polygon validity against a brute-force version in exact fractions."""

import json
import random
from fractions import Fraction as Fr

import pytest

from parcelkit.functions import geo


def edges(ring):
    pts = [p for i, p in enumerate(ring) if i == 0 or p != ring[i - 1]]
    return list(zip(pts, pts[1:], strict=False))


def side(a, b, c):
    d = (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
    return (d > 0) - (d < 0)


def on(e, p):
    (a, b) = e
    return (side(a, b, p) == 0 and min(a[0], b[0]) <= p[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= p[1] <= max(a[1], b[1]))


def common(e, f):
    """'no', 'point', 'cross' or 'line'."""
    o = [side(*e, f[0]), side(*e, f[1]), side(*f, e[0]), side(*f, e[1])]
    if o[0] == o[1] == 0:
        ends = {p for p in e if on(f, p)} | {p for p in f if on(e, p)}
        return "no" if not ends else "point" if len(ends) == 1 else "line"
    if o[0] * o[1] < 0 and o[2] * o[3] < 0:
        return "cross"
    return "point" if any(on(e, p) for p in f) or any(on(f, p) for p in e) else "no"


def where(ring, p):
    """1 inside, 0 on, -1 outside."""
    inside = False
    for a, b in edges(ring):
        if on((a, b), p):
            return 0
        if (a[1] > p[1]) != (b[1] > p[1]) and a[0] + Fr(p[1] - a[1]) / (b[1] - a[1]) * (b[0] - a[0]) > p[0]:
            inside = not inside
    return 1 if inside else -1


def simple(ring):
    es = edges(ring)
    n = len(es)
    if n < 3:
        return False
    for i in range(n):
        for j in range(i + 1, n):
            got = common(es[i], es[j])
            if j == i + 1 or (i == 0 and j == n - 1):
                if got in ("line", "cross"):
                    return False
            elif got != "no":
                return False
    return True


def middles(ring, others):
    out = []
    for a, b in edges(ring):
        cut = {a, b} | {p for r in others for e in edges(r) for p in e if on((a, b), p)}
        cut = sorted(cut, key=lambda p: (p[0] - a[0]) * (b[0] - a[0]) + (p[1] - a[1]) * (b[1] - a[1]))
        out += [((p[0] + q[0]) / Fr(2), (p[1] + q[1]) / Fr(2)) for p, q in zip(cut, cut[1:], strict=False)]
    return out


def meet_badly(r, s):
    return any(common(e, f) in ("cross", "line") for e in edges(r) for f in edges(s))


def valid(polys):
    for p in polys:
        if not all(simple(r) for r in p):
            return False
        shell, holes = p[0], p[1:]
        for i, h in enumerate(holes):
            if meet_badly(shell, h) or any(where(shell, m) < 0 for m in middles(h, [shell])):
                return False
            for g in holes[:i]:
                if meet_badly(h, g) or any(where(g, m) > 0 for m in middles(h, [g])) or any(
                        where(h, m) > 0 for m in middles(g, [h])):
                    return False

    def inner(p, m):
        return where(p[0], m) > 0 and all(where(h, m) < 0 for h in p[1:])
    for i, p in enumerate(polys):
        for q in polys[:i]:
            if any(meet_badly(r, s) for r in p for s in q):
                return False
            if any(inner(q, m) for m in middles(p[0], q)) or any(inner(p, m) for m in middles(q[0], p)):
                return False
    return True


def ring(pts, step=0.0001, lon=-75.28, lat=39.87):
    pts = [*pts, pts[0]]
    return pts, [[round(lon + x * step, 6), round(lat + y * step, 6)] for x, y in pts]


def rows_of(shapes):
    out = []
    for k, polys in enumerate(shapes):
        text = [[ring(r)[1] for r in p] for p in polys]
        g = {"type": "Polygon", "coordinates": text[0]} if len(text) == 1 else {"type": "MultiPolygon", "coordinates": text}
        out.append((k, json.dumps(g)))
    return out


def check(spark, shapes):
    df = spark.createDataFrame(rows_of(shapes), "k long, g string").repartition(8)
    got = {r.k: r.ok for r in df.select("k", geo.geojson_polygons("g").isNotNull().alias("ok")).collect()}
    want = {k: valid([[ring(r)[0] for r in p] for p in polys]) for k, polys in enumerate(shapes)}
    assert {k: shapes[k] for k in want if got[k] != want[k]} == {}
    return want


def square(x, y, n):
    return [(x, y), (x + n, y), (x + n, y + n), (x, y + n)]


NAMED = {
    "square": ([[square(0, 0, 4)]], True),
    "bow tie": ([[[(0, 0), (4, 4), (4, 0), (0, 4)]]], False),
    "spike": ([[[(0, 0), (4, 0), (4, 4), (4, 8), (4, 4), (0, 4)]]], False),
    "touches itself in a corner": ([[[(0, 0), (4, 0), (2, 2), (4, 4), (0, 4), (2, 2)]]], False),
    "touches its own edge": ([[[(0, 0), (6, 0), (6, 6), (3, 0), (0, 6)]]], False),
    "a position twice in a row": ([[[(0, 0), (4, 0), (4, 0), (4, 4), (0, 4)]]], True),
    "a straight corner": ([[[(0, 0), (2, 0), (4, 0), (4, 4), (0, 4)]]], True),
    "flat": ([[[(0, 0), (4, 0), (2, 0)]]], False),
    "hole": ([[square(0, 0, 6), square(2, 2, 2)]], True),
    "hole that touches in a point": ([[square(0, 0, 6), [(0, 3), (2, 2), (2, 4)]]], True),
    "hole along the shell": ([[square(0, 0, 6), square(0, 2, 2)]], False),
    "hole outside": ([[square(0, 0, 4), square(6, 0, 2)]], False),
    "hole outside that touches": ([[square(0, 0, 4), [(4, 2), (6, 1), (6, 3)]]], False),
    "hole across": ([[square(0, 0, 4), square(3, 1, 3)]], False),
    "hole out through corners": ([[[(0, 0), (8, 0), (8, 8), (4, 4), (0, 8)], [(2, 2), (6, 2), (6, 6), (2, 6)]]], False),
    "hole around": ([[square(2, 2, 2), square(0, 0, 6)]], False),
    "hole that is the shell": ([[square(0, 0, 4), square(0, 0, 4)]], False),
    "two holes": ([[square(0, 0, 9), square(1, 1, 2), square(5, 5, 2)]], True),
    "holes that meet in a corner": ([[square(0, 0, 9), square(1, 1, 2), square(3, 3, 2)]], True),
    "holes that overlap": ([[square(0, 0, 9), square(1, 1, 4), square(3, 3, 4)]], False),
    "hole in a hole": ([[square(0, 0, 9), square(1, 1, 6), square(3, 3, 2)]], False),
    "parts": ([[square(0, 0, 3)], [square(5, 0, 3)]], True),
    "parts that meet in a corner": ([[square(0, 0, 3)], [square(3, 3, 3)]], True),
    "parts that share an edge": ([[square(0, 0, 3)], [square(3, 0, 3)]], False),
    "parts that overlap": ([[square(0, 0, 3)], [square(2, 2, 3)]], False),
    "part in a part": ([[square(0, 0, 6)], [square(2, 2, 2)]], False),
    "island in a lake": ([[square(0, 0, 9), square(2, 2, 5)], [square(4, 4, 1)]], True),
    "island that touches the shore": ([[square(0, 0, 9), square(2, 2, 5)], [[(2, 4), (4, 3), (4, 5)]]], True),
    "island over the shore": ([[square(0, 0, 9), square(2, 2, 5)], [square(1, 4, 2)]], False),
    "equal parts": ([[square(0, 0, 3)], [square(0, 0, 3)]], False),
    "star of two": ([[[(0, 0), (6, 0), (3, 6)]], [[(0, 4), (6, 4), (3, -2)]]], False),
    "cross through corners": ([[[(0, 0), (4, 4), (0, 8)]], [[(2, 2), (6, 4), (2, 6)]]], False),
}


def test_named_shapes(spark):
    want = check(spark, [s for s, _ in NAMED.values()])
    assert dict(zip(NAMED, want.values(), strict=True)) == {k: v for k, (_, v) in NAMED.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_shapes_equal_brute_force(spark, seed):
    rng = random.Random(seed)

    def around(cx, cy, radius, n, jitter):
        corner = [(round(cx + radius * c), round(cy + radius * s)) for c, s in
                  [(1, 0), (.7, .7), (0, 1), (-.7, .7), (-1, 0), (-.7, -.7), (0, -1), (.7, -.7)]]
        picked = sorted(rng.sample(range(8), n))
        return [(corner[i][0] + rng.randint(-jitter, jitter), corner[i][1] + rng.randint(-jitter, jitter)) for i in picked]
    shapes = []
    for _ in range(500):
        polys = [[around(0, 0, 8, rng.randint(3, 8), rng.choice([0, 1, 2, 5]))]]
        for _ in range(rng.choice([0, 1, 1, 2])):
            polys[0].append(around(rng.randint(-4, 4), rng.randint(-4, 4), rng.choice([1, 2, 3]), rng.randint(3, 5), rng.choice([0, 1])))
        if rng.random() < 0.4:
            polys.append([around(rng.choice([0, 8, 12, 14]), rng.randint(-3, 3), rng.choice([1, 4]), rng.randint(3, 6), 1)])
        shapes.append(polys)
    shapes += [[[[(rng.randint(0, 4), rng.randint(0, 4)) for _ in range(rng.randint(3, 6))]]] for _ in range(300)]
    want = check(spark, shapes)
    assert 0.15 < sum(want.values()) / len(want) < 0.85


def test_long_ring(spark):
    """A comb of some thousand teeth, and the same with two teeth that cross."""
    teeth = [p for i in range(1500) for p in ((2 * i, 9), (2 * i + 1, 1))]
    comb = [*teeth, (3000, 0), (0, 0)]
    bad = [*comb]
    bad[2001] = (2004, 3)
    text = [json.dumps({"type": "Polygon", "coordinates": [ring(r, 0.000001)[1]]}) for r in (comb, bad)]
    df = spark.createDataFrame([(0, text[0]), (1, text[1])], "k long, g string")
    got = {r.k: r.ok for r in df.select("k", geo.geojson_polygons("g").isNotNull().alias("ok")).collect()}
    assert got == {0: True, 1: False}
