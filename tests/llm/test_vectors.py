import numpy as np
import pytest

from parcelkit.llm import embed_dedup as ed
from parcelkit.llm import pivot_topk as pt
from tests.conftest import SF_SMALL
from tests.llm.test_simhash import roots

SCHEMA = "vec_id long, embedding array<float>, label int, score string, cells int"


def clustered(seed, n=700, d=16):
    rng = np.random.default_rng(seed)
    rows, base = [], rng.normal(size=(12, d))
    for i in range(n):
        x = rng.normal(size=d)
        if i % 2 == 0:
            x = base[i % 12] + rng.normal(size=d) * rng.choice([0.02, 0.12, 0.3])
        rows.append((i, [float(np.float32(c)) for c in x], int(rng.integers(0, 3)) if i % 3 else 0, "s", i))
    hot = rng.normal(size=d)
    rows += [(1000 + i, [float(np.float32(c)) for c in hot + rng.normal(size=d) * 0.05], 1, None, 0) for i in range(400)]
    rows += [(2000 + i, rows[5][1], 0, "x", 0) for i in range(20)]
    rows += [(3000, None, 1, "a", 1), (3050, [], 1, "a", 1), (3100, [0.0] * d, 1, "a", 1), (3150, rows[4][1], None, "a", 1),
             (3200, [1.0, None] + [0.5] * (d - 2), 1, "a", 1), (3250, [float("nan")] * d, 1, "a", 1),
             (3300, [float("inf")] * d, 1, "a", 1), (3350, [1.0, 2.0], 1, "a", 1), (3400, [1.0, 2.0], 1, "a", 1),
             (None, rows[5][1], 0, "x", 0), (7, rows[7][1], rows[7][2], "again", 9)]
    return rows


def good(v):
    return v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v)


def brute_links(rows, t=0.93):
    ok = [i for i, r in enumerate(rows) if r[0] is not None and r[2] is not None and good(r[1]) and any(r[1])]
    pairs = []
    for x, i in enumerate(ok):
        for j in ok[:x]:
            a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
            if rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= t:
                pairs.append((i, j))
    n = np.bincount(np.array(pairs).ravel(), minlength=len(rows)) if pairs else np.zeros(len(rows), int)
    root = roots(len(rows), pairs)
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None]
        c = r[0] if not n[i] else min(ids)
        out.append((r[0], int(n[i]), c, r[0] is not None and r[0] == c))
    return sorted(out, key=str), len(pairs)


@pytest.mark.parametrize("cell,shard", [(1024, 2048), (64, 100)])
def test_near_duplicates_against_brute_force(spark, monkeypatch, cell, shard):
    monkeypatch.setattr(ed, "CELL_ROWS", cell)
    monkeypatch.setattr(ed, "SHARD_ROWS", shard)
    rows = clustered(cell)
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, ed.near_duplicates(df).collect()), key=str)
    want, pairs = brute_links(rows)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(g[1] for g in got) >= 0.98 * 2 * pairs
    assert sum(g[2:] == w[2:] for g, w in zip(got, want)) >= 0.99 * len(want)


def test_near_duplicates_tables(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = [tuple(r) for r in df.select("vec_id", "embedding", "label").collect()]
    out = ed.near_duplicates(df)
    assert sorted(map(tuple, out.collect()), key=str) == brute_links(rows)[0]
    assert ed.near_duplicates(df.limit(0)).count() == 0
    dense = df.unionAll(df.selectExpr("vec_id + 10000", "transform(embedding, c -> cast(c * 1.01 as float))", "label"))
    found, true = ed.audit_recall(dense, ed.near_duplicates(dense), every=10)
    assert true == 100 and found >= 0.97 * true


def brute_top(rows, k=5):
    use = [(r[0], [int(np.floor(256 * float(c))) for c in r[1]]) for r in rows if r[0] is not None and good(r[1])]
    out = []
    for q in sorted({i for i, _ in use if i % 50 == 0}):
        best = []
        for x in {tuple(v) for i, v in use if i == q}:
            best += [(-sum(a * b for a, b in zip(x, v)), i) for i, v in use if i != q and len(v) == len(x)]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(best)[:k])]
    return out


@pytest.mark.parametrize("group", [8192, 100])
def test_top_k_equals_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(pt, "GROUP_ROWS", group)
    monkeypatch.setattr(pt, "QUERY_ROWS", 16 if group == 100 else 2048)
    rows = clustered(group)
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, pt.top_k(df).collect())) == sorted(brute_top(rows))
    assert pt.top_k(df.limit(0)).count() == 0


def test_bounds_stop_early():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(20, 32)) * 400
    x = np.floor(centres[rng.integers(0, 20, 4000)] + rng.normal(size=(4000, 32)) * 20)
    q, r, s, computed = pt.search(x[:100], np.arange(100), x, np.arange(4000), x[:16], 5)
    full = x[:100] @ x.T
    full[np.arange(100), np.arange(100)] = -np.inf
    for i in range(100):
        want = np.lexsort((np.arange(4000), -full[i]))[:5]
        assert r[q == i].tolist() == want.tolist()
    assert computed < 0.5 * 100 * 4000
