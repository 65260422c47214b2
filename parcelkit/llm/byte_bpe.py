"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token's bytes form a doubly linked list of parts.  Every adjacent pair
that the vocabulary can merge sits in the bucket of its merge rank; a bitmap
over the ranks, with a summary level above its words, tells the lowest rank
that has a bucket by two find-first-set steps.  A popped
position is checked against the parts that are there now: entries that an
earlier merge made stale are skipped.  Each merge touches two neighbours, so
a pre-token of n bytes costs O(n log n) however long it is (the log only
orders equal ranks from left to right).  The pre-tokens of many texts that
the cache misses share one queue.

Texts are split by the vocabulary's pattern; encodings of short pre-tokens
are kept in a bounded cache per worker.  Null texts are empty: no tokens.
Repeated rows are encoded each; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelkit.llm.common import prepare, steady

CACHE = 500_000          # pre-tokens in each of a worker's two cache generations
LONG_PIECE = 64          # longer pre-tokens (characters) are not cached
TURN_CHARS = 1 << 21     # text that is encoded in one turn
TURN_PIECES = 2048       # pre-tokens that share a queue: its lists stay in the processor's cache
SHIFT = 8                # ranks are mapped in words of 2**SHIFT bits
MASK = (1 << SHIFT) - 1
_WORKER: dict = {}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


class Pairs:
    """Merge tables: rank of two adjacent tokens by ``left << 16 | right``, and of two bytes as an array."""

    def __init__(self, ranks: dict[bytes, int]):
        self.rank: dict[int, int] = {}
        get = ranks.get
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = get(token[:i]), get(token[i:])
                if left is not None and right is not None:
                    self.rank[left << 16 | right] = rank
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.first = np.full(1 << 16, -1, np.int64)
        for token, rank in ranks.items():
            if len(token) == 2:
                self.first[token[0] << 8 | token[1]] = rank


def merge(pieces: list[bytes], pairs: Pairs) -> list[list[int]]:
    """Ids of each of some pre-tokens (none empty), merged in one queue.

    ``buckets`` maps a rank to positions, ``low`` holds a bitmap of the ranks
    with a bucket in words of ``2**SHIFT`` bits and ``top`` a bitmap of the
    words that are not zero.  Pre-tokens do not touch (``edge``), so each sees
    its lowest rank first and equal ranks from left to right.  A merge never
    makes a pair of its own rank, so a bucket is complete when it is popped.
    """
    get = pairs.rank.get
    data = np.frombuffer(b"".join(pieces), np.uint8)
    n = len(data)
    ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
    edges = np.zeros(n + 1, np.uint8)
    edges[0] = 1
    edges[ends] = 1
    edge = edges.tobytes()
    token = pairs.byte[data].tolist()     # token of the part that starts here
    first = np.where(edges[1:n] == 0, pairs.first[data[:-1].astype(np.int64) << 8 | data[1:]], -1)
    order = np.argsort(first, kind="stable")
    order = order[np.searchsorted(first[order], 0):]
    values, start = np.unique(first[order], return_index=True)
    positions, cuts = order.tolist(), [*start.tolist(), len(order)]
    buckets: dict[int, list[int]] = {}
    low: dict[int, int] = {}
    top = 0
    for k, rank in enumerate(values.tolist()):
        buckets[rank] = positions[cuts[k]:cuts[k + 1]]
        a = rank >> SHIFT
        low[a] = low.get(a, 0) | 1 << (rank & MASK)
        top |= 1 << a
    stop = list(range(1, n + 1))          # end of the part that starts here, 0 once it is merged away
    before = list(range(-1, n - 1))
    while top:
        a = (top & -top).bit_length() - 1
        word = low[a]
        bit = word & -word
        rank = a << SHIFT | bit.bit_length() - 1
        low[a] = word = word ^ bit
        if not word:
            top &= top - 1
        bucket = buckets.pop(rank)
        bucket.sort()
        for i in bucket:
            mid = stop[i]
            if not mid or edge[mid] or get(token[i] << 16 | token[mid]) != rank:
                continue
            end = stop[mid]
            stop[i], stop[mid], token[i] = end, 0, rank
            if not edge[end]:
                before[end] = i
                fresh = get(rank << 16 | token[end])
                if fresh is not None:
                    if fresh in buckets:
                        buckets[fresh].append(i)
                    else:
                        buckets[fresh] = [i]
                        a = fresh >> SHIFT
                        low[a] = low.get(a, 0) | 1 << (fresh & MASK)
                        top |= 1 << a
            if not edge[i]:
                left = before[i]
                fresh = get(token[left] << 16 | rank)
                if fresh is not None:
                    if fresh in buckets:
                        buckets[fresh].append(left)
                    else:
                        buckets[fresh] = [left]
                        a = fresh >> SHIFT
                        low[a] = low.get(a, 0) | 1 << (fresh & MASK)
                        top |= 1 << a
    live = np.flatnonzero(np.array(stop))
    tokens = np.array(token)[live].tolist()
    cuts = np.searchsorted(live, ends).tolist()
    return [tokens[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]


def latin_pattern(pattern: str) -> str | None:
    """The pattern with its letter and number classes spelled out for Latin-1, None if it has other classes:
    the standard library's matcher takes it, at half the time."""
    spelled = {r"\p{L}": "", r"\p{N}": ""}
    for code in range(256):
        name = r"\p{%s}" % unicodedata.category(chr(code))[0]
        if name in spelled:
            spelled[name] += re.escape(chr(code))
    out, inside = "", False
    for part in re.findall(r"\\p\{\w+\}|\\.|.", pattern, re.S | re.I):
        if part.lower().startswith("\\p"):
            if part not in spelled:
                return None
            out += spelled[part] if inside else f"[{spelled[part]}]"
            continue
        inside = part == "[" or inside and part != "]"
        out += part
    return out


class Encoder:
    """Vocabulary, pattern and a bounded cache of short pre-tokens."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.ranks = read_ranks(path)
        self.pairs = Pairs(self.ranks)
        self.bytes_of = {v: k for k, v in self.ranks.items()}
        self.decimal = {v: str(v) for v in self.bytes_of}
        self.any_split = regex.compile(pattern).findall
        plain = latin_pattern(pattern)
        self.latin_split = re.compile(plain).findall if plain else self.any_split
        self.latin = re.compile("[\t\n\r -~\u00a1-\u00ff]*").fullmatch
        self.new: dict[str, list[int]] = {}
        self.old: dict[str, list[int]] = {}

    def split(self, text: str) -> list[str]:
        return self.latin_split(text) if self.latin(text) else self.any_split(text)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text; what the cache misses is merged together."""
        split, get, old = [self.split(t) for t in texts], self.new.get, self.old
        found = [list(map(get, pieces)) for pieces in split]
        lost = dict.fromkeys(p for pieces, ids in zip(split, found, strict=True) if None in ids
                             for p, v in zip(pieces, ids, strict=True) if v is None)
        if lost:
            missed = [p for p in lost if p not in old]
            made = {p: old[p] for p in lost if p in old}
            if missed:
                made.update((p, [self.ranks[p.encode()]]) for p in missed if p.encode() in self.ranks)
                missed = [p for p in missed if p not in made]
                for start in range(0, len(missed), TURN_PIECES):
                    turn = missed[start:start + TURN_PIECES]
                    made.update(zip(turn, merge([p.encode() for p in turn], self.pairs), strict=True))
            found = [[made[p] if v is None else v for p, v in zip(pieces, ids, strict=True)] if None in ids else ids
                     for pieces, ids in zip(split, found, strict=True)]
            if len(self.new) + len(made) > CACHE:
                self.old, self.new = self.new, {}
            self.new.update((p, ids) for p, ids in made.items() if len(p) <= LONG_PIECE)
        return [list(chain.from_iterable(ids)) for ids in found]

    def encode_batches(self, texts: list[str]) -> Iterator[list[int]]:
        """``encode`` in turns of bounded text."""
        turn, held = [], 0
        for t in texts:
            turn.append(t)
            held += len(t)
            if held > TURN_CHARS:
                yield from self.encode(turn)
                turn, held = [], 0
        yield from self.encode(turn)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def encoder(path: str, pattern: str) -> Encoder:
    key = (path, pattern)
    if key not in _WORKER:
        _WORKER[key] = Encoder(path, pattern)
    return _WORKER[key]


def encode(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of every text."""
    prepare(docs.sparkSession)

    @steady
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, pattern)
        for batch in batches:
            ids = pa.array(list(e.encode_batches(batch.column(1).to_pylist())), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["doc_id", "ids"])

    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
            .mapInArrow(run, "doc_id long, ids array<int>"))


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the decoded bytes (binary) of rows with ``ids``."""

    @steady
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, pattern)
        for batch in batches:
            data = pa.array([e.decode(x or []) for x in batch.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), data], names=["doc_id", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")


def digests(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by a blank) and
    decoded_sha256 of every text: encode and decode in one pass, nothing but
    the digests leaves the worker."""
    prepare(docs.sparkSession)

    @steady
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, pattern)
        for batch in batches:
            n, a, b = [], [], []
            for ids in e.encode_batches(batch.column(1).to_pylist()):
                n.append(len(ids))
                a.append(hashlib.sha256(" ".join(map(e.decimal.__getitem__, ids)).encode()).hexdigest())
                b.append(hashlib.sha256(e.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
            .mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"))
