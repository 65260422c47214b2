import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest

from parcelkit.llm import byte_bpe, packing, queries, token_counts
from tests.conftest import SF_SMALL

WORD, BYTE = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(WORD)


@pytest.fixture(scope="module")
def tik():
    import tiktoken
    return tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(BYTE), special_tokens={})


def texts(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


def small(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def test_token_counts_equal_the_library(spark, odd_docs, no_docs, library):
    for df in (odd_docs, small(spark)):
        want = sorted(((i, len(t.encode()), n := len(library.encode(t, add_special_tokens=False).ids), n > 2048)
                       for i, t in texts(df)), key=str)
        assert sorted(map(tuple, token_counts.token_counts(df, WORD).collect()), key=str) == want
    assert token_counts.token_counts(no_docs, WORD).count() == 0
    assert queries.op6_token_counts(spark, SF_SMALL).count() == small(spark).count()


def test_token_counts_sentencepiece(odd_docs):
    import sentencepiece
    path = P.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    want = sorted(((i, len(model.encode(t))) for i, t in texts(odd_docs)), key=str)
    got = token_counts.token_counts(odd_docs, path).select("doc_id", "n_tokens").collect()
    assert sorted(map(tuple, got), key=str) == want


def test_merge_equals_tiktoken(tik):
    ranks = byte_bpe.read_ranks(BYTE)
    rng = random.Random(5)
    cases = ["a" * 5000, "ab" * 777, "=" * 333, "the" * 400, "é" * 50]
    cases += ["".join(rng.choices("etaoin shrdluéß#1", k=rng.randint(1, 60))) for _ in range(400)]
    for c in cases:
        e = byte_bpe.Encoder(BYTE, P.PATTERN) if c is cases[0] else e
        assert e.encode([c])[0] == tik.encode_ordinary(c)
        assert e.decode(e.encode([c])[0]) == c.encode()
    assert e.encode(cases) == [tik.encode_ordinary(c) for c in cases]
    assert byte_bpe.merge([b"\xff\xfe" * 40], byte_bpe.Pairs(ranks))


def test_latin_split_equals_the_pattern():
    import regex
    e = byte_bpe.Encoder(BYTE, P.PATTERN)
    rng = random.Random(8)
    letters = "aZé ß'st\n\t\r  12²¾.,-_«»µªÿ¡|"
    for _ in range(3000):
        t = "".join(rng.choices(letters, k=rng.randint(0, 30)))
        assert e.latin(t) and e.split(t) == regex.findall(P.PATTERN, t)
    for t in ("a\x85b", "x\x1c y", "\u3000a", "日本 語"):
        assert not e.latin(t) and e.split(t) == regex.findall(P.PATTERN, t)
    assert byte_bpe.latin_pattern(r"\p{Lu}+") is None


def test_byte_bpe_query(spark, odd_docs, no_docs, tik):
    for df in (odd_docs, small(spark)):
        want = []
        for i, t in texts(df):
            ids = tik.encode_ordinary(t)
            want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256(t.encode()).hexdigest()))
        assert sorted(map(tuple, byte_bpe.digests(df, BYTE, P.PATTERN).collect()), key=str) == sorted(want, key=str)
    e = byte_bpe.encode(odd_docs, BYTE, P.PATTERN)
    got = [(r.doc_id, bytes(r.data).decode()) for r in byte_bpe.decode(e, BYTE, P.PATTERN).collect()]
    assert sorted(got, key=str) == sorted(texts(odd_docs), key=str)
    assert byte_bpe.digests(no_docs, BYTE, P.PATTERN).count() == 0


def check_packed(rows, docs, library, close=packing.CLOSE):
    want = defaultdict(list)
    for i, t in docs:
        want[i].append(np.array([*library.encode(t, add_special_tokens=False).ids, 1], dtype="<u4"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert pieces.keys() == want.keys()
    for i, ids in want.items():
        assert sum(r.length for r in pieces[i]) == sum(map(len, ids))
        if len(ids) == 1:
            at = 0
            for r in sorted(pieces[i], key=lambda r: r.start):
                assert (r.start, r.doc_tokens) == (at, len(ids[0])) and r.length > 0
                assert r.ids_crc32 == zlib.crc32(ids[0][at:at + r.length].tobytes())
                at += r.length
    padding = total = 0
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048 and len({r.step_group for r in s}) == len({r.tier for r in s}) == 1
        padding += 0 if at & (at - 1) == 0 else 2048 - at
        total += at
    steps = defaultdict(int)
    for s in sequences.values():
        steps[s[0].step_group] += s[0].tier
    assert max(steps.values()) <= packing.STEP_TOKENS
    return padding, total


def test_packing(spark, odd_docs, no_docs, library):
    check_packed(packing.pack(odd_docs, WORD).collect(), texts(odd_docs), library)
    df = small(spark)
    padding, total = check_packed(queries.op5_packing(spark, SF_SMALL).collect(), texts(df), library)
    assert padding < 0.02 * total
    assert packing.pack(no_docs, WORD).count() == 0


def test_packer_cuts_the_last_window_into_powers_of_two():
    p = packing.Packer(3)
    p.add(1, packing.id_bytes(list(range(77))))
    p.finish()
    sizes = defaultdict(int)
    for r in p.rows:
        sizes[r[5]] += r[2]
    assert sorted(sizes.values()) == [13, 64]
