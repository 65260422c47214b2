import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from parcelkit.llm import anchor_simhash as sh
from parcelkit.llm.components import connected_components, local_roots
from tests.conftest import SF_SMALL

U = np.uint64


def plain(text, k=3):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([b" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hs) > len(hs))


def roots(n, pairs):
    up = list(range(n))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return [find(i) for i in range(n)]


def brute(rows, t=2):
    fps = [plain(x) for _, x in rows]
    root = roots(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= t])
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None]
        c = min(ids, default=None)
        out.append((d, f"{fps[i]:016x}", c, d is not None and d == c))
    return sorted(out, key=str)


def test_fingerprints_equal_spark_hash(spark):
    from pyspark.sql import functions as F
    h = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0]
    assert h % 2**64 == xxhash.xxh64_intdigest(b"a b c", seed=42)
    for t in ("", " ", "One", "one TWO", "A b\tc d e", "x " * 5000):
        assert sh.fingerprint(t, 3) == plain(t)


@pytest.mark.parametrize("t", [1, 2])
def test_anchors_miss_no_pair(t):
    rng = np.random.default_rng(t)
    base = rng.integers(0, 2**63, 3000, dtype=np.int64).view(U)
    other = base.copy()
    for _ in range(t):
        other ^= U(1) << rng.integers(0, 64, 3000).astype(U)
    ra, a = sh.anchors(base)
    rb, b = sh.anchors(other)
    sa, sb = [set() for _ in base], [set() for _ in base]
    for r, x in zip(ra, a):
        sa[r].add(int(x))
    for r, x in zip(rb, b):
        sb[r].add(int(x))
    assert all(x & y for x, y in zip(sa, sb)) and max(map(len, sa)) <= 16


def test_large_groups_link_like_small_ones():
    rng = np.random.default_rng(3)
    f = np.zeros(400, U)
    for i in range(400):
        for b in rng.integers(0, 64, rng.integers(0, 6)):
            f[i] ^= U(1) << U(b)
    f = np.unique(f)
    for t in (1, 2):
        a, b = sh.near_links(np.zeros(len(f), U), f, t)
        assert (np.bitwise_count(f[a] ^ f[b]) <= t).all()
        got = np.arange(len(f))
        if len(a):
            node, root = local_roots(a, b)
            got[node] = root
        want = roots(len(f), [(i, j) for i in range(len(f)) for j in range(i) if int(f[i] ^ f[j]).bit_count() <= t])
        assert got.tolist() == want


def test_query_equals_brute_force(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    near = docs.selectExpr("doc_id + 1000 as doc_id", "concat(text, ' tail') as text")
    for df in (odd_docs.select("doc_id", "text", "ids"), docs.select("doc_id", "text").unionAll(near)):
        rows = [(r.doc_id, r.text) for r in df.collect()]
        assert sorted(map(tuple, sh.simhash_components(df).collect()), key=str) == brute(rows)
    kept = sh.drop_near_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [0, 1, 4, 4, 5]
    assert sh.simhash_components(no_docs).count() == 0
    assert sh.drop_near_copies(no_docs).count() == 0


def test_components(spark):
    rng = np.random.default_rng(9)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(1000, 1080)]
    links = spark.createDataFrame([*pairs, *pairs[:5], (7, None), (None, None)], "src long, dst long")
    want = roots(1200, pairs)
    linked = {x for p in pairs if p[0] != p[1] for x in p}
    got = {r.node: r.component for r in connected_components(links).collect()}
    assert got == {i: want[i] for i in linked}
    assert connected_components(links.limit(0)).count() == 0


def test_links_through_rows_without_id_and_ids_of_two_texts(spark):
    words = [f"word{i}" for i in range(40)]
    texts = [" ".join([*words[:k], f"other{j}", *words[k + 1:]]) for k in (0, 20, 39) for j in range(60)]
    fps = [sh.fingerprint(t, 3) for t in texts]
    near = [[j for j, y in enumerate(fps) if 0 < (x ^ y).bit_count() <= 2] for x in fps]
    a, b, c = next((texts[i], texts[j], texts[k]) for j in range(len(fps)) for i in near[j] for k in near[j]
                   if (fps[i] ^ fps[k]).bit_count() > 2)
    apart = "some quite other text about boats and the sea"
    rows = [(9, a), (None, b), (5, c), (None, apart + " far away"), (7, apart), (7, a), (8, apart + " in winter time")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, sh.simhash_components(df).collect()), key=str)
    assert got == brute(rows)
    assert {r[2] for r in got if r[0] in (5, 9)} == {5}
    kept = [tuple(r) for r in sh.drop_near_copies(df).collect()]
    assert sorted(kept, key=str) == sorted([r for r in rows if r[0] is None or r[0] in (5, 8) or r == (7, apart)], key=str)


def test_clashing_names_and_rows_without_fingerprint_are_dealt_apart(spark, odd_docs):
    odd = odd_docs.withColumnsRenamed({"n_tokens": "_id", "ids": "_own"}).withColumns({c: F.lit(1) for c in ("_some", "_fp", "whole", "kept")})
    got = sh.drop_near_copies(odd)
    assert got.columns == odd.columns
    assert sorted(r.doc_id for r in got.collect() if r.doc_id is not None) == [0, 1, 4, 4, 5]
    assert sum(r.doc_id is None for r in got.collect()) == 1
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "coalesce" in plan.split("LeftAnti")[1].split("\n")[0]
