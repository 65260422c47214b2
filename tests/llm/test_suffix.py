import hashlib
import random

import numpy as np
import pytest

from parcelkit.llm import suffix_dedup as sd
from tests.conftest import SF_SMALL


def brute(rows, length=100):
    first = {}
    data = [((2**63 - 1) if i is None else i, (t or "").encode()) for i, t in rows]
    for i, t in data:
        for s in range(len(t) - length + 1):
            w = t[s:s + length]
            first[w] = min(first.get(w, (i, s)), (i, s))
    out = []
    for (raw, _), (i, t) in zip(rows, data):
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - length + 1):
            if first[t[s:s + length]] < (i, s):
                gone[s:s + length] = True
        runs = int((gone & ~np.concatenate(([False], gone[:-1]))).sum())
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((raw, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df, **kw):
    out = sd.suffix_dedup(df, **kw).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted(map(tuple, out.collect()), key=str)


def made(rng, n, words):
    passages = [" ".join(rng.choices(words, k=30)) for _ in range(6)]
    out = []
    for i in range(n):
        t = " ".join(rng.choices(words, k=rng.randint(0, 80)))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            cut = rng.randint(0, 60)
            t += rng.choice(["", " "]) + p[cut:cut + rng.randint(80, 200)] + " ".join(rng.choices(words, k=9))
        if rng.random() < 0.2 and out:
            t = rng.choice(out)[1] or ""
            if rng.random() < 0.6:
                at = rng.randint(0, max(0, len(t) - 1))
                t = t[:at] + "#" + t[at + 1:]
        out.append((i, t))
    return out + [(n, "ab" * 700), (n + 1, "a" * 450), (n + 2, None), (n + 3, ""), (None, out[0][1]), (None, "z" * 150),
                  (n + 4, "é" * 120), (n + 4, "é" * 120), (3, out[5][1])]


@pytest.mark.parametrize("hot", [4096, 3])
def test_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(sd, "HOT", hot)
    rng = random.Random(hot)
    rows = made(rng, 120, ["alpha", "be", "gamma", "deltas", "e", "zeta", "ünter", "theta1"])
    rng.shuffle(rows)
    find = sd._find_repeats

    def with_hot(t):
        sd.HOT = hot
        return find(t)
    monkeypatch.setattr(sd, "_find_repeats", with_hot)
    df = spark.createDataFrame([(i, t, "x", k) for k, (i, t) in enumerate(rows)],
                               "doc_id long, text string, kept string, _x long")
    assert result(df) == brute(rows)


def test_query_table(spark, odd_docs, no_docs):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert result(df) == brute(rows)
    odd = odd_docs.where("length(text) < 40000 or text is null").unionByName(
        spark.createDataFrame([(9, "wor" * 4000, None, None)], odd_docs.schema))
    assert result(odd) == brute([(r.doc_id, r.text) for r in odd.collect()])
    assert result(no_docs) == []
    kept = sd.drop_repeats(df)
    want = {r.doc_id: r.kept_sha256 for r in sd.suffix_dedup(df).where("n_removed = 0").collect()}
    rows = kept.collect()
    assert kept.schema == df.schema and len(rows) == df.count()
    for r in rows:
        if r.doc_id in want:
            assert hashlib.sha256(r.text.encode()).hexdigest() == want[r.doc_id]
        assert r.n_chars == len(r.text)


def test_forced_collision_is_caught():
    """Regions that hash alike but differ are told apart by their bytes."""
    data = np.frombuffer(b"x" * 100 + b"x" * 99 + b"y", np.uint8)
    keep = sd.Hashes.of
    try:
        sd.Hashes.of = lambda self, start, size: np.zeros(len(start), sd.U64)
        m, f, t = sd.decide(np.array([7, 7], sd.U64), np.array([0, 1]), np.array([0, 0]), np.array([0, 0]), data,
                            np.array([0, 100]), 100)
        assert len(m) == 0
    finally:
        sd.Hashes.of = keep


def test_grams_shared_without_a_shared_window(spark):
    """Regions that share a gram but no window: nothing to mark, alone and beside a gram with equal windows."""
    rng = random.Random(5)

    def text(n):
        return "".join(rng.choices("abcdefghijklmnop", k=n))

    short = text(90)
    rows = [(i, text(200) + short + text(200)) for i in range(4)]
    data = np.frombuffer("".join(t for _, t in rows).encode(), np.uint8)
    assert np.bincount(np.unique(sd.grams(data, np.arange(4) * 490, 100)[4], return_inverse=True)[1]).max() > 1
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(df) == brute(rows) and sum(r[2] for r in result(df)) == 0
    rows += [(i, text(150) + 2 * (short + "q" * 30) + text(150)) for i in range(7, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(df) == brute(rows) and sum(r[2] for r in result(df)) > 0


def test_suffix_sort():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    start = rng.integers(0, 2900, 400)
    size = rng.integers(1, 100, 400)
    group = np.sort(rng.integers(0, 9, 400))
    h = sd.Hashes(data)

    def compare(a, b):
        most = np.minimum(size[a], size[b])
        same = h.extension(start[a], start[b], most)
        over = same >= most
        x, y = data[np.where(over, 0, start[a] + same)], data[np.where(over, 0, start[b] + same)]
        return np.where(over, np.sign(size[a] - size[b]), np.sign(x.astype(int) - y.astype(int)))

    got = sd.sort_suffixes(np.arange(400), group, compare)
    text = [bytes(data[s:s + n]) for s, n in zip(start, size)]
    want = sorted(range(400), key=lambda i: (group[i], text[i]))
    assert [(group[i], text[i]) for i in got] == [(group[i], text[i]) for i in want]
