import math
import re
from collections import Counter

import numpy as np
import pytest

from parcelkit.llm import lexical_bpa as bpa
from tests.conftest import SF_SMALL

TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return [t.translate(UPPER) for t in TERM.findall(text or "")]


def brute(docs, items, k=20):
    """docs, items: (id, text).  Every document scored for every item."""
    held = [(i, Counter(words(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    w = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * f + 1))) for t, f in df.items()}
    out = []
    for item, text in items:
        asked, found = words(text), []
        for d, c in held:
            m = 75 + 25 * sum(c.values()) * n // total
            s = sum(w[t] * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m)) for t in asked if t in c)
            if s > 0:
                found.append((-s, d is None, d or 0, d))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(found, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def got(docs, items, **kw):
    return sorted(map(tuple, bpa.rank_documents(docs, items, **kw).collect()), key=str)


def test_terms_are_the_pattern_s():
    for t in ("", "a-b_c", "Éa ÉİxK K9z\x00y\x7fz", " x　y", "don't [stop] {now} A1b2"):
        assert [x.decode() for x in bpa.terms(t.encode())] == words(t)


def test_query_equals_brute_force(spark):
    docs, items = (spark.read.parquet(f"{SF_SMALL}/{n}.parquet") for n in ("documents", "benchmark"))
    d = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    q = [(r.item_id, r.text) for r in items.collect()]
    assert got(docs, items) == brute(d, q)


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame(
        [(1, "The FOX, the dog"), (1, "The FOX, the dog"), (2, None), (3, ""), (4, "nothing there"), (None, "word x"),
         (5, "é́ İx 12345"), (6, "no id at all the"), (7, "word " * 3000)], "item_id long, text string")
    d = [(r.doc_id, r.text) for r in odd_docs.collect()]
    q = [(r.item_id, r.text) for r in items.collect()]
    clash = odd_docs.withColumnsRenamed({"n_tokens": "score", "ids": "item_id"})
    assert got(clash, items, k=3) == brute(d, q, 3)
    # Several passes over the items, several blocks of documents a task.
    assert got(clash, items, k=3, query_bytes=5000) == brute(d, q, 3)
    assert got(no_docs, items) == got(odd_docs, items.limit(0)) == []
    assert got(odd_docs.select("doc_id", "text").filter("doc_id = 2"), items) == []


def blocks(docs, items, size):
    """The operator's steps without Spark, for blocks of ``size`` documents."""
    code = {t: i for i, t in enumerate(sorted({w.encode() for _, t in items for w in words(t)}))}
    names = [x.split()[0] for x in bpa.INDEX.split(", ")]
    rows = []
    for at in range(0, len(docs), size):
        b = bpa.Builder(code)
        for i, t in docs[at:at + size]:
            b.add(i, (t or "").encode())
        rows.append(dict(zip(names, b.row(), strict=True)))
    n, total = sum(r["n_docs"] for r in rows), sum(r["n_terms"] for r in rows)
    weights, df = np.zeros(len(code), np.int64), Counter()
    for r in rows:
        df.update(dict(zip(r["terms"], r["document_counts"], strict=True)))
    for t, f in df.items():
        weights[t] = bpa.weight(n, f)
    asked = [Counter(code[w.encode()] for w in words(t)) for _, t in items]
    wanted = [(np.array(sorted(c)), np.array([c[x] for x in sorted(c)])) for c in asked]
    return [bpa.Block(r, weights, n, total) for r in rows], wanted


@pytest.mark.parametrize("size", [1, 7, 500])
def test_ties_and_blocks_and_stopping(size):
    rng = np.random.default_rng(size)
    common = [f"w{i}" for i in range(40)]
    docs = [(int(i), " ".join(rng.choice(common, rng.integers(1, 30), p=np.arange(40, 0, -1) / 820)))
            for i in rng.permutation(300)]
    docs += [(1000 + i, docs[i % 3][1]) for i in range(60)]                    # ties
    docs = [docs[i] for i in rng.permutation(len(docs))]
    items = [(j, " ".join(rng.choice(common, 6))) for j in range(12)]
    found, wanted = blocks(docs, items, size)
    best, read, scored = bpa.Best(len(items), 20), 0, 0
    for b in found:
        for j, (want, times) in enumerate(wanted):
            doc, score, entries, met = bpa.best_positions(b, *b.lists(want, times), 20, best.bar(j))
            best.add(j, b, doc, score)
            read, scored = read + entries, scored + met
    rows = [(items[j][0], r, d, -s) for j, top in enumerate(best.top) for r, (s, _, d) in enumerate(top, 1)]
    assert sorted(rows, key=str) == brute(docs, items)


def test_search_stops_before_the_lists_end():
    rng = np.random.default_rng(5)
    docs = [(i, " ".join(rng.choice([f"c{x}" for x in range(30)], 40)) + (f" rare{i % 50} rare{i % 50}" if i < 400 else ""))
            for i in range(4000)]
    items = [(j, f"c1 c2 rare{j} rare{j + 1} rare{j + 2}") for j in range(5)]
    (block,), wanted = blocks(docs, items, len(docs))
    for want, times in wanted:
        lists = block.lists(want, times)
        doc, _, read, met = bpa.best_positions(block, *lists, 20, 0)
        assert len(doc) >= 20 and read < 0.25 * block.size[lists[0]].sum() and met < 1000
