import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from parcelkit.llm import ngram_trie as nt
from parcelkit.llm import queries
from tests.conftest import SF_SMALL

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(rows):
    texts = [(i, [*WORD.findall((t or "").encode().lower()), None]) for i, t in rows]
    learn = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2 for i, _ in texts]
    c = Counter(w for (_, ws), l in zip(texts, learn) if l for w in ws)
    n, v = sum(c.values()), len(c)
    pairs, after = Counter(), Counter()
    for (_, ws), l in zip(texts, learn):
        if l:
            for a, b in zip([0, *ws], ws):
                pairs[a, b] += 1
                after[a] += 1
    out = []
    for (i, ws), l in zip(texts, learn):
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)
        score = 0.0
        for a, b in zip([0, *ws], ws):
            k = after[a] if a is not None else 0
            score += math.log10(pairs[a, b] / (k + nt.MU) + nt.MU / (k + nt.MU) * (c[b] + 1) / (n + v + 1))
        out.append((i, not l, len(ws), sum(c[w] > 0 for w in ws), n, base, score))
    return sorted(out, key=lambda r: (str(r[0]), r[2]))


def same(df, rows):
    got = sorted((tuple(r) for r in df.collect()), key=lambda r: (str(r[0]), r[2]))
    want = brute(rows)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9)
        assert abs(g[6] - w[6]) <= 0.5 * nt.STEP * w[2] + 1e-6
    return got


@pytest.mark.parametrize("hot", [64, 3])
def test_scores_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(nt, "HOT_WORDS", hot)
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = same(nt.score_texts(df), [(r.doc_id, r.text) for r in df.collect()])
    assert sum(g[6] for g in got) > sum(g[5] for g in got)


def test_odd_rows(spark, odd_docs, no_docs):
    same(nt.score_texts(odd_docs), [(r.doc_id, r.text) for r in odd_docs.collect()])
    assert nt.score_texts(no_docs).count() == 0
    blank = odd_docs.where("doc_id in (1, 2, 3)")
    same(nt.score_texts(blank), [(r.doc_id, r.text) for r in blank.collect()])


@pytest.mark.parametrize("values", [[], [0], [5, 5, 5], [0, 1, 2, 3], "wide", "dense"])
def test_elias_fano(values):
    rng = np.random.default_rng(4)
    if values == "wide":
        values = np.sort(rng.integers(0, 2**61, 5000))
    elif values == "dense":
        values = np.sort(rng.integers(0, 9000, 5000))
    values = np.asarray(values, np.int64)
    arrays, n, width = nt.EliasFano.encode(values)
    ef = nt.EliasFano(arrays, n, width)
    assert ef.at(np.arange(n)).tolist() == values.tolist()
    top = int(values.max(initial=0))
    x = np.concatenate([values, values + 1, rng.integers(0, top + 3, 500)]).astype(np.int64)
    assert ef.successor(x).tolist() == np.searchsorted(values, x, "left").tolist()
    known = set(values.tolist())
    assert [(i >= 0) for i in ef.find(x)] == [int(v) in known for v in x]


def test_trie_codes():
    rng = np.random.default_rng(5)
    contexts = np.unique(rng.integers(0, 2**63, 300).astype(nt.U64) * nt.U64(2))
    of, follower = rng.integers(0, len(contexts), 4000), rng.integers(0, 2**40, 60)[rng.integers(0, 60, 4000)]
    key = np.unique(of << 40 | follower)
    of, follower = key >> 40, key & (2**40 - 1)
    share = rng.random(len(key))
    trie = nt.Trie(contexts, of, follower, share)
    codes = trie.look_up(contexts[of], follower)
    assert (np.abs(nt.LOWEST + nt.STEP * codes - np.log10(share)) <= nt.STEP / 2 + 1e-9).all()
    assert not trie.look_up(contexts[:50], np.full(50, 12345)).any()
    assert not trie.look_up(np.array([3, 5], nt.U64), follower[:2]).any()


def brute_3(rows):
    """Scores of order 3 by id and number of tokens."""
    texts = [(i, ["<s>", *WORD.findall((t or "").encode().lower()), None]) for i, t in rows]
    learn = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2 for i, _ in texts]
    counts, after = Counter(), Counter()
    for (_, ws), l in zip(texts, learn):
        for k in range(1, len(ws)) if l else ():
            for n in range(min(k, 2) + 1):
                counts[tuple(ws[k - n:k + 1])] += 1
                after[tuple(ws[k - n:k])] += 1
    words = sum(len(k) == 1 for k in counts)
    out = []
    for i, ws in texts:
        score = 0.0
        for k in range(1, len(ws)):
            p = (counts[(ws[k],)] + 1) / (after[()] + words + 1)
            for n in range(1, min(k, 2) + 1):
                c = tuple(ws[k - n:k])
                p = (counts[(*c, ws[k])] + nt.MU * p) / (after[c] + nt.MU)
            score += math.log10(p)
        out.append((str(i), len(ws) - 1, score))
    return sorted(out)


@pytest.mark.parametrize("hot", [64, 3])
def test_order_3_equals_brute_force(spark, odd_docs, no_docs, monkeypatch, hot):
    monkeypatch.setattr(nt, "HOT_WORDS", hot)
    for df in (spark.read.parquet(f"{SF_SMALL}/documents.parquet"), odd_docs):
        got = sorted((str(r.doc_id), r.n_tokens, r.score) for r in nt.score_texts(df, order=3).collect())
        want = brute_3([(r.doc_id, r.text) for r in df.collect()])
        assert len(got) == len(want)
        for g, w in zip(got, want):
            assert g[:2] == w[:2] and abs(g[2] - w[2]) <= 0.5 * nt.STEP * w[1] + 1e-6
    assert nt.score_texts(no_docs, order=3).count() == 0


def test_query_is_of_order_3(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    two, three = (sum(r.score for r in x.where("held_out").collect())
                  for x in (nt.score_texts(df), queries.op7_ngram_scores(spark, SF_SMALL)))
    print("held-out log10 probability", two, three)
    assert abs(two - three) > 1
    assert three == pytest.approx(sum(r.score for r in nt.score_texts(df, order=3).where("held_out").collect()))


def test_trigrams_of_frequent_bigrams_are_split(spark, monkeypatch):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plain = {r.doc_id: r.score for r in nt.score_texts(df, order=3).collect()}
    monkeypatch.setattr(nt, "COPIES", 400.0)
    monkeypatch.setattr(nt, "PAIR_STEP", 3)
    split = {r.doc_id: r.score for r in nt.score_texts(df, order=3).collect()}
    assert split.keys() == plain.keys()
    assert all(split[k] == pytest.approx(plain[k], rel=1e-12) for k in plain)


def test_a_block_splits_and_names_its_trigrams():
    words = [b"a b c%d" % k for k in range(300)]
    a, b = nt.tokens([b"a b"])[0][:2]
    hot = nt.Hot(np.array([nt.START]), np.array([1]), np.array([nt.pair_hash(a, b)]), np.array([5]))
    block = nt.Block(words, np.ones(300, bool), hot, 8, 3)
    mine = np.flatnonzero((block.words[block.left] == a) & (block.words[block.right] == b))
    assert len(mine) == 5 == len(set(block.pair_bucket[mine].tolist()))
    assert block.seen[mine].tolist() == [300] * 5 and (block.pair_tris[mine] > 0).all()
    assert block.pair_tris[mine].sum() == 300
    got = [(n, nt.Request(data, hot)) for n, data in block.requests()]
    assert sum(len(r.third) for _, r in got) == len(block.tri_pair) == sum(int(r.tris.sum()) for _, r in got)
    assert sum(int(r.tri_seen.sum()) for _, r in got) == 900
    assert sum(int(r.count.sum()) for _, r in got) == 1200


def test_trie_leads_from_bigrams_to_trigrams():
    rng = np.random.default_rng(6)
    contexts = np.unique(rng.integers(0, 2**62, 40).astype(nt.U64) * nt.U64(4))
    words = np.unique(rng.integers(0, 2**40, 50))
    two = np.unique(rng.integers(0, len(contexts) * len(words), 500))
    three = np.unique(rng.integers(0, len(two) * len(words), 3000))
    share = rng.random(len(three))
    trie = nt.Trie(contexts, two // len(words), words[two % len(words)], np.ones(len(two)),
                   three // len(words), words[three % len(words)], share)
    number = trie.vocabulary.find(words)
    place = trie.bigrams(contexts, two // len(words), number[two % len(words)])
    assert place.tolist() == list(range(len(two)))
    every = np.arange(len(two) * len(words))
    at = trie.trigrams(place, every // len(words), number[every % len(words)])
    assert every[at >= 0].tolist() == three.tolist()
    codes = nt.code_at(trie.third_codes, at)
    assert (np.abs(nt.LOWEST + nt.STEP * codes[at >= 0] - np.log10(share)) <= nt.STEP / 2 + 1e-9).all()
    assert not codes[at < 0].any()
    assert (trie.trigrams(np.full(5, -1), np.arange(5), number[:5]) == -1).all()
    assert (trie.trigrams(place, np.arange(5), np.full(5, -1)) == -1).all()


def test_counts_of_any_size():
    v = np.array([0, 1, 254, 255, 256, 2**40])
    assert nt.large(*nt.small(v)).tolist() == v.tolist()


def test_followers_named_by_rank():
    rng = np.random.default_rng(7)
    words = rng.integers(0, 2**63, 400).astype(nt.U64)
    hot = nt.Hot(words[:3], np.ones(3), np.zeros(0, nt.U64), np.zeros(0, np.int64), words[:100])
    followers = (words >> nt.U64(24)).astype(np.int64)[rng.integers(0, 400, 5000)]
    code = hot.code(followers)
    rest = followers[code == 0xFFFF]
    named = (words[:100] >> nt.U64(24)).astype(np.int64)
    assert (code == 0xFFFF).tolist() == (~np.isin(followers, named)).tolist() and 0 < len(rest) < 5000
    got = hot.unname(code, (rest & 0xFFFFFFFF).astype(np.uint32), (rest >> 32).astype(np.uint8))
    assert got.tolist() == followers.tolist()
    assert len(hot.code(followers[:0])) == 0


@pytest.mark.parametrize("top", [3, 1000, 2**62])
def test_ranked_is_unique(top):
    for n in (0, 1, 700):
        x = np.random.default_rng(n).integers(0, top, n)
        keys, number = nt.ranked(x)
        want, of = np.unique(x, return_inverse=True)
        assert keys.tolist() == want.tolist() and number.tolist() == of.tolist()
