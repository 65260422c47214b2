"""Exact tile cover and the byte budget against brute force."""

import gzip
import hashlib
import json
import math
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from parcelkit.functions import geo
from parcelkit.operators import tiles as T


def unit(p):
    lat = math.radians(max(min(p[1], geo.MERCATOR_LIMIT), -geo.MERCATOR_LIMIT))
    y = (1 - math.log(math.tan(lat) + 1 / math.cos(lat)) / math.pi) / 2
    return min(max((p[0] + 180) / 360, 0), 1 - 2**-53), min(max(y, 0), 1 - 2**-53)


def cover(polys, z):
    """Every tile of the feature's box, tested by itself."""
    rings = [[unit(p) for p in r] for poly in polys for r in poly]
    n = 2**z
    edges = [(a, b) for r in rings for a, b in zip(r, r[1:], strict=False)]
    xs, ys = [p[0] for r in rings for p in r], [p[1] for r in rings for p in r]

    def turn(e, p):
        return (e[1][0] - e[0][0]) * (p[1] - e[0][1]) - (e[1][1] - e[0][1]) * (p[0] - e[0][0])
    out = set()
    for x in range(int(min(xs) * n), int(max(xs) * n) + 1):
        for y in range(int(min(ys) * n), int(max(ys) * n) + 1):
            x0, x1, y0, y1 = x / n, (x + 1) / n, y / n, (y + 1) / n
            mid = ((x0 + x1) / 2, (y0 + y1) / 2)
            hit = inside = False
            for e in edges:
                (ax, ay), (bx, by) = e
                if min(ax, bx) < x1 and max(ax, bx) >= x0 and min(ay, by) < y1 and max(ay, by) >= y0:
                    t = [turn(e, (u, v)) for u in (x0, x1) for v in (y0, y1)]
                    hit |= min(t) <= 0 <= max(t)
                if (ay > mid[1]) != (by > mid[1]) and ax + (mid[1] - ay) / (by - ay) * (bx - ax) < mid[0]:
                    inside = not inside
            if hit or inside:
                out.add((z, x, y))
    return out


def ring(rng, cx, cy, radius, n):
    pts = []
    for i in range(n):
        a, r = 2 * math.pi * (i + rng.random() * 0.8) / n, radius * rng.uniform(0.4, 1)
        pts.append([cx + r * math.cos(a), cy + r * math.sin(a)])
    return [*pts, pts[0]]


def text(polys):
    return json.dumps({"type": "MultiPolygon", "coordinates": polys})


def frame(spark, shapes):
    df = spark.createDataFrame([(str(i), text(s)) for i, s in enumerate(shapes)], "property_id string, g string")
    return geo.with_polygons(df, "g", check_shapes=False)


def test_cover_equals_testing_every_tile_of_the_box(spark):
    rng = random.Random(6)
    shapes = []
    for i in range(60):
        cx, cy = (-75.2 + rng.uniform(-0.3, 0.3), 39.95 + rng.uniform(-0.2, 0.2)) if i % 3 else (
            rng.uniform(-179, 179), rng.uniform(-84, 84))
        size = 10 ** rng.uniform(-4, -1.2)
        polys = [[ring(rng, cx, cy, size, rng.randint(3, 12))]]
        if i % 2:
            polys[0].append(ring(rng, cx, cy, size * 0.3, rng.randint(3, 6)))
        if i % 5 == 0:
            polys.append([ring(rng, cx + 3 * size, cy, size, rng.randint(3, 6))])
        shapes.append(polys)
    shapes.append([[[[-75.5, 40.2], [-75.0, 40.2], [-75.0, 40.201], [-75.499, 40.201], [-75.499, 40.7], [-75.5, 40.7],
                     [-75.5, 40.2]]]])        # an L whose box is mostly empty
    got = {}
    for r in T.tile_assign(frame(spark, shapes), min_zoom=9, max_zoom=14).collect():
        assert (r.z, r.x, r.y) not in got.setdefault(int(r.property_id), set())
        got[int(r.property_id)].add((r.z, r.x, r.y))
    for i, s in enumerate(shapes):
        assert got[i] == set().union(*(cover(s, z) for z in range(9, 15))), i


def test_cover_crosses_tile_borders_and_map_borders(spark):
    def box(w, s, e, n):
        return [[[[w, s], [e, s], [e, n], [w, n], [w, s]]]]
    shapes = [box(-0.001, -0.001, 0.001, 0.001), box(0, 0, 0.0001, 0.0001), box(179.9, -85.2, 180, -84.9),
              box(-180, 84.9, -179.9, 89), [*box(-179.9, 0.1, -179.8, 0.2), *box(179.8, 0.1, 179.9, 0.2)]]
    got = {}
    for r in T.tile_assign(frame(spark, shapes), min_zoom=3, max_zoom=10).collect():
        got.setdefault(int(r.property_id), set()).add((r.z, r.x, r.y))
    for i, s in enumerate(shapes):
        assert got[i] == set().union(*(cover(s, z) for z in range(3, 11))), i
    assert len(got[4]) < 60      # far parts do not span the map between them


def budget(rows, cap):
    """(z, x, y) -> kept keys, by sorting each tile's rows."""
    by = {}
    for t, key, size, band in rows:
        by.setdefault(t, {}).setdefault((-band, hashlib.md5(key.encode()).hexdigest()), []).append((key, size))
    out = {}
    for t, ranks in by.items():
        total, out[t] = 0, []
        for _, peers in sorted(ranks.items()):
            total += sum(s for _, s in peers)
            if total > cap:
                break
            out[t] += [k for k, _ in peers]
        out[t].sort()
    return out


@pytest.mark.parametrize("cap", [1, 40, 333, 5000, 10**9])
def test_budget_equals_sorting_each_tile(spark, cap):
    rng = random.Random(cap)
    rows = [((1, rng.randint(0, 2), rng.choice([0, 0, 0, 1])), f"k{rng.randint(0, 900)}", rng.randint(1, 30),
             rng.choice([-5, -5, -5, 3, 7])) for _ in range(2000)]
    rows = list({(t, k): (t, k, s, b) for t, k, s, b in rows}.values())
    rows += [((1, 0, 0), "twice", 9, 3)] * 2                     # rows of one key stay or go together
    df = spark.createDataFrame([(*t, k, s, b, hashlib.md5(k.encode()).hexdigest()) for t, k, s, b in rows],
                               "z int, x long, y long, property_id string, _bytes long, _band int, _rank string").cache()
    cuts = T.tile_cuts(df, cap)
    want = budget(rows, cap)
    got = {t: [] for t in want}
    for r in T.capped(df, cuts).collect():
        got[r.z, r.x, r.y].append(r.property_id)
    assert {t: sorted(v) for t, v in got.items()} == want
    report = {(r.z, r.x, r.y): r for r in T.tile_report(df, cuts).collect()}
    assert report.keys() == want.keys()
    for t, r in report.items():
        here = [(k, s) for u, k, s, _ in rows if u == t]
        assert (r.feature_count, r.kept_count, r.dropped_count) == (len(here), len(want[t]), len(here) - len(want[t]))
        assert r.kept_bytes <= cap and r.tile_bytes == sum(s for _, s in here)


def test_one_object_for_each_tile(spark, tmp_path):
    rng = random.Random(2)
    shapes = [[[ring(rng, -75.2 + rng.uniform(-0.02, 0.02), 39.95 + rng.uniform(-0.02, 0.02), 0.002, 5)]] for _ in range(80)]
    df = frame(spark, shapes).selectExpr("property_id", "polygons", "g AS feature").repartition(7)
    report = T.write_tiles(df, str(tmp_path / "t"), cap=3000)
    found = {}
    for d, _, names in os.walk(tmp_path / "t"):
        for n in names:
            z, x, y = map(int, re.fullmatch(r".*/(\d+)/(\d+)/(\d+)[.]jsonl[.]gz", os.path.join(d, n)).groups())
            found[z, x, y] = os.path.join(d, n)
    kept = {(r.z, r.x, r.y): r for r in report.collect()}
    assert found.keys() == {t for t, r in kept.items() if r.kept_count} == {t for t, r in kept.items() if r.object}
    for t, name in found.items():
        assert kept[t].object_bytes == os.path.getsize(name) and len(gzip.open(name).readlines()) == kept[t].kept_count
    lines = T.read_tiles(spark, str(tmp_path / "t")).groupBy("z", "x", "y").agg(F.count("value").alias("n")).collect()
    assert {(r.z, r.x, r.y): r.n for r in lines} == {t: r.kept_count for t, r in kept.items() if r.kept_count}
    assert max(r.kept_bytes for r in kept.values()) <= 3000 < max(r.tile_bytes for r in kept.values())
