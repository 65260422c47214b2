import hashlib
import re
import zlib

import numpy as np
import pytest

from parcelkit.llm import periodic_runs as pr
from parcelkit.llm.queries import op11_periodic_runs
from tests.conftest import SF_SMALL

WORD = re.compile("[^\\x20\\x09-\\x0D]+")


def brute_runs(w, least=6, power=4):
    """Every stretch of every period, kept if no smaller period fits it."""
    found, n = [], len(w)
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            e = i
            while e + q < n and w[e] == w[e + q]:
                e += 1
            length = e + q - i
            if length >= max(least, power * q) and not any(
                    all(w[x] == w[x + d] for x in range(i, e + q - d)) for d in range(1, q)):
                found.append((i, length, q))
            i = e
    return sorted(found)


def brute_row(doc, text):
    w = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc).encode()) if doc is not None else 1, len(w)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (
        "".join(f"{s},{n},{q}\n" for s, n, q in runs), " ".join(x for i, x in enumerate(w) if i not in gone))]
    return (doc, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *sha)


def smaller_suffix(w):
    """Longest Lyndon words: the distance to the next smaller suffix."""
    n = len(w)
    return [next((j for j in range(i + 1, n) if w[j:] < w[i:]), n) - i for i in range(n)]


@pytest.mark.parametrize("letters", [1, 2, 3, 9])
def test_lyndon_arrays_of_both_orders(letters):
    rng = np.random.default_rng(letters)
    texts = [rng.integers(0, letters, n).tolist() for n in [1, 2, 3, *rng.integers(1, 60, 60)]]
    rank = np.array([x for t in texts for x in [*t, -1]])
    for order in (rank, np.where(rank < 0, -1, letters - 1 - rank)):
        got, at = pr.lyndon_lengths(order, letters).tolist(), 0
        for t in texts:
            assert got[at:at + len(t)] == smaller_suffix(order[at:at + len(t)].tolist())
            at += len(t) + 1


@pytest.mark.parametrize("least,power", [(6, 4), (2, 2), (3, 3), (5, 5), (1, 2)])
def test_runs_equal_brute_force(least, power):
    rng = np.random.default_rng(least)
    texts = []
    for _ in range(150):
        t = rng.integers(0, int(rng.integers(1, 5)), int(rng.integers(0, 70))).tolist()
        if len(t) > 5:                        # planted repeats
            a = int(rng.integers(0, len(t) - 3))
            t = t[:a] + t[a:a + int(rng.integers(1, 9))] * int(rng.integers(2, 8)) + t[a:]
        texts.append([str(x).encode() for x in t])
    got = pr.runs_of(texts, least, power).tolist()
    want = [[i, *r] for i, t in enumerate(texts) for r in brute_runs(t, least, power)]
    assert got == want


def test_runs_survive_collisions_of_hashes(monkeypatch):
    texts = [list("abababababxbabababab"), list("aaaaaaabaaaaaaa"), list("xabcabcabcabcabdabcabcabcabc")]
    texts = [[x.encode() for x in t] for t in texts]
    want = [[i, *r] for i, t in enumerate(texts) for r in brute_runs(t)]
    monkeypatch.setattr(pr, "mixed", lambda h: h * np.uint64(0))
    monkeypatch.setattr(pr, "live", lambda word, *_: np.ones(len(word), bool))
    assert pr.runs_of(texts, 6, 4).tolist() == want


def test_long_text_and_long_run():
    w = [b"%d" % (i * i % 1009) for i in range(40_000)]
    w[5000:5000] = [b"x"] * 30_000
    runs = {tuple(r) for r in pr.runs_of([w], 6, 4)[:, 1:].tolist()}
    assert (5000, 30_000, 1) in runs and (35_000, 35_000, 1009) in runs


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = op11_periodic_runs(spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                           "collapsed_sha256"]
    assert [t for _, t in got.dtypes] == ["bigint"] * 6 + ["string"] * 2
    rows = sorted(map(tuple, got.collect()), key=str)
    assert rows == sorted((brute_row(r.doc_id, r.text) for r in docs), key=str)
    assert sum(r[1] for r in rows) > 10


def test_odd_rows(spark, odd_docs, no_docs):
    # 30 is an id whose words are repeated; \x1c and a no-break blank part no words.
    more = spark.createDataFrame([(i, t, "x", 1) for i in range(30, 60) for t in (
        "a b\x1cc d e f g  h\n i j k l m n o p q r s t u v w x y z", "one", "", " ", None, "no no no no no no " * 40)],
        odd_docs.schema)
    for df in (odd_docs, more):
        df = df.withColumnsRenamed({"n_tokens": "runs", "ids": "h"})
        got = pr.digests(pr.periodic_runs(pr.with_periodic_tails(df)))
        short = [r for r in df.collect() if len(r.text or "") < 20_000]
        rows = sorted((tuple(r) for r in got.collect() if r.doc_id != 4), key=str)
        assert rows == sorted((brute_row(r.doc_id, r.text) for r in short), key=str)
    long = [tuple(r)[:6] for r in pr.digests(pr.periodic_runs(odd_docs)).filter("doc_id = 4").collect()]
    assert long == [(4, 1, 0, 9000, 1, 9_000_000)] * 2
    assert pr.periodic_runs(no_docs).count() == 0
    with pytest.raises(ValueError):
        pr.periodic_runs(odd_docs, power=1)
