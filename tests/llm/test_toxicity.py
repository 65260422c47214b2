import itertools

import numpy as np
from parcelkit.llm import toxicity as tox


def kernel(s, t):
    def occ(w):
        return [(w[i] + w[i + a] + w[i + a + b], tox.DECAY ** (a + b + 1)) for i in range(len(w))
                for a, b in itertools.product(range(1, tox.GAP + 1), repeat=2) if i + a + b < len(w)]
    x, y = occ(s), occ(t)
    norm = np.sqrt(sum(d * d for _, d in x) * sum(d * d for _, d in y))
    return sum(d * e for k, d in x for l, e in y if k == l) / norm if norm else 0.0


def test_similarities_equal_the_plain_kernel():
    marks = tox.Landmarks(["idiot", "worthless", "abab", "èrépa"])
    words = ["idiot", "idxiot", "idiiot", "worthles", "xyz", "ab", "", "ababab", "èrépale", "w0rthless"]
    near, got = marks.similar(words, 0.0)
    full = np.zeros((len(words), 4))
    full[near] = got
    want = np.array([[kernel(w, l) for l in marks.words] for w in words])
    assert np.allclose(full, want)
    some, _ = marks.similar(words, tox.FLOOR)
    assert set(np.flatnonzero(want.max(axis=1) >= tox.FLOOR)) <= set(some)
    assert kernel("idxiot", "idiot") > 0.5 > kernel("italic", "idiot")


def test_words():
    assert "idiot" in tox.words_of("you i d i o t !!") and tox.letters("i.d-i.o.t!") == "idiot"
    assert tox.words_of("") == set()


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = tox.train(docs, labels)
    rows = tox.score(docs, model).where("held_out").join(labels.where("toxic is not null"), "doc_id").collect()
    hit = sum(r.predicted == r.toxic for r in rows)
    found = [r.predicted for r in rows if r.toxic == 1]
    print(hit, len(rows), sum(found), len(found), sum(r.predicted for r in rows if r.toxic == 0))
    # about one toxic document in seven of this table holds none of the words that mark the others
    assert hit >= 0.97 * len(rows) and sum(found) >= 0.8 * len(found)
    assert sum(r.predicted for r in rows if r.toxic == 0) <= 0.01 * len(rows)
    odd = spark.createDataFrame([(0, "What an idxiot you are, sc.um", 1), (1, None, 2), (2, "", 3), (None, "calm words", 4),
                                 (3, "such a s t u p i d and worthlless one", 5), (4, "the " * 30000, 6)],
                                "doc_id long, text string, score int")
    got = {r.doc_id: r.predicted for r in tox.score(odd, model).collect()}
    assert got == {0: 1, 1: 0, 2: 0, None: 0, 3: 1, 4: 0}
    kept = tox.drop_toxic(odd, model)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {1, 2, None, 4}


def test_without_labels_or_with_one_class(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    for labels, want in ((none, 0.0), (spark.createDataFrame([(i, 0) for i in range(20)], none.schema), 0.0),
                         (spark.createDataFrame([(i, 1) for i in range(20)] + [(2, None), (None, 1)], none.schema), 1.0)):
        model = tox.train(odd_docs, labels)
        assert {r.score for r in tox.score(odd_docs, model).collect()} == {want}
        assert tox.score(no_docs, model).count() == 0


def test_more_distinct_words_than_the_cache_holds(monkeypatch):
    marks = tox.Landmarks(["idiot", "worthless"])
    calm = [f"w{i}q" for i in range(300)]
    texts = ["calm idxiot words", " ".join(["calm", *calm[:90], "idiot"]), " ".join([*calm, "worthles", "calm", "idiot"]),
             " ".join(f"{w * 30}idiot{w * 30}" for w in calm[:70]), "", "calm words"]
    want = tox.Scorer(marks).features(texts)
    assert want[2].min() > 0 and not want[4:].any()
    for cache in (40, 90, 100):
        monkeypatch.setattr(tox, "CACHE", cache)
        scorer = tox.Scorer(marks)
        scorer.features(["calm and idiot"])
        for _ in range(2):
            assert np.allclose(scorer.features(texts), want)


def test_landmarks_of_any_alphabet():
    latin = [chr(97 + i) + chr(97 + j) + "xidiot" for i in range(26) for j in range(3)]
    for first, n in ((0x430, 60), (0x4E00, 300)):
        rare = ["".join(chr(first + i + k) for k in range(4)) for i in range(0, n, 4)]
        marks = tox.Landmarks([*latin, *rare])
        words = [*rare, "".join((rare[0][:2], "x", rare[0][2:])), "idxiot", "calm"]
        near, got = marks.similar(words, 0.0)
        full = np.zeros((len(words), len(marks.words)))
        full[near] = got
        assert np.allclose(full, [[kernel(w, l) for l in marks.words] for w in words], atol=1e-6)


def test_held_out_misses(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = tox.score(docs, tox.train(docs, labels)).where("held_out").join(labels.where("toxic in (0, 1)"), "doc_id").collect()
    missed = sum(r.toxic == 1 and r.predicted == 0 for r in rows)
    alarms = sum(r.toxic == 0 and r.predicted == 1 for r in rows)
    print(missed, alarms, len(rows))
    assert (sum(r.toxic for r in rows), len(rows)) == (97, 825)
    assert missed <= 18 and alarms <= 5
    assert (tox.FLOOR, tox.LANDMARKS) == (0.4, 256)     # chosen by recall within the training rows, see the README
