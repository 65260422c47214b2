"""Language-model scores from Elias-Fano n-gram tries.

Model: interpolated bigrams, or trigrams above them, over words and one end token,
``p(w | c) = n(c, w) / (n(c) + MU) + MU / (n(c) + MU) * p0(w)`` with the
add-one base ``p0(w) = (n(w) + 1) / (N + V + 1)``.  Of order 3 a word after two others (the first may be
the text's start) scores ``n(b, c, w) / (n(b, c) + MU) + MU / (n(b, c) + MU) * p(w | c)``.

Trie: bigrams are dealt to buckets by hash of their context, trigrams go to the bucket of the bigram that they
begin with.  A bucket holds its part of the trie in compact levels that are written to a file and memory-mapped
(in the task's own temporary folder, without a name, gone with the task): context hashes, follower vocabulary,
pointers from each context to its bigrams, the bigrams, pointers from each bigram to its trigrams, and the
trigrams, all monotone sequences in Elias-Fano coding, and beside each bigram and trigram one byte, the quantised
logarithm of its smoothed share ``n(c, w) / (n(c) + MU)`` or ``n(b, c, w) / (n(b, c) + MU)``.  Followers are
numbered relative to what they follow (its number times vocabulary size plus rank), so that one sequence is
monotone; an n-gram is looked up by a successor search in the range that its context's pointers give.

Work: blocks of documents (see ``common``) send the words, bigrams and trigrams that they hold to the buckets, each
once, with its count in the block's training documents; a trigram names its bigram by the bigram's place in the
same message, so no context but single words is ever sent, and followers among the ``HOT_WORDS`` most frequent words
are named by rank in two bytes, others by hash in five.  Buckets sum the counts, build their trie and answer each
block in the order asked; blocks add up their documents' scores.  Texts and messages travel as zstandard frames.
Nothing is broadcast but N, V and two lists of at most ``HOT_WORDS`` entries:

* The most frequent words, which a first pass counts.  Bigrams of those that hold more than a quarter of a bucket's
  share of all tokens are dealt by the hash of both words, so no bucket gets all that follows a word like "the".
* Bigrams that hold more than a bucket's share: their trigrams are split over several
  buckets by the third word, and the bigram itself is sent to each of these.  That pass estimates them from every
  ``PAIR_STEP``-th token of all training texts; the list decides only where trigrams are counted, no count or score.

Words are 64-bit hashes (followers 40 bits of it); counts of words are exact
but for hash collisions.  Null texts are empty: one end token.  A null id
counts as the empty text in the split into folds.  Repeated rows count each;
an empty table gives an empty result; other columns are not read.  One text is one task's memory.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelkit.llm.common import (
    U64, frugal, mixed, pack, parts, prepare, shuffle_partitions, spans, steady, stored,
    text_bytes, unpack, word_bounds, word_hashes)

MU = 2.0
HOT_WORDS = (1 << 16) - 1  # most entries of either list of frequent words and bigrams
HOT_EACH = 4096           # of these, from one bucket
LEAST = 1 << 22           # a word is looked at for that list if it holds more than one token in so many
DEAL_BYTES = 32 << 20     # text that is dealt to blocks at a time
PAIR_STEP = 64            # every how manieth token is looked at for frequent bigrams
COPIES = 1.0              # buckets that a frequent bigram's trigrams get for each bucket's share of tokens
LM_BLOCK = 16 << 20       # text bytes per block
LM_BUCKET = 16 << 20      # corpus bytes per bucket
HELD_WORDS = 4_000_000    # word counts that a task of the first pass holds
TURN_BYTES = 1 << 20      # text that is hashed at a time
LM_BLOCK_3 = 4 << 20      # both for order 3, which holds about twice as many n-grams
LM_BUCKET_3 = 3 << 20
START, END = U64(0x5BD1E9955BD1E995), U64(0x27D4EB2F165667C5)
STEP, LOWEST = 0.04, -10.0   # quantisation: code k >= 1 stands for 10 ** (LOWEST + STEP * k)


class EliasFano:
    """A non-decreasing sequence below 2**62: low bits packed, high parts in unary."""

    def __init__(self, arrays: tuple[np.ndarray, ...], size: int, width: int):
        self.low, self.high, self.rank = arrays
        self.size, self.width = size, width

    @staticmethod
    def encode(values: np.ndarray) -> tuple[tuple[np.ndarray, ...], int, int]:
        n = len(values)
        top = int(values[-1]) if n else 0
        width = max(0, (top // max(n, 1)).bit_length() - 1)
        bits = np.zeros(64 * (-(-n * width // 64) + 1), np.uint8)
        if width:
            at = np.arange(n, dtype=np.int64) * width
            for b in range(width):
                bits[at + b] = values >> b & 1
        low = np.packbits(bits, bitorder="little").view(U64)
        bits = np.zeros(64 * (-(-(n + (top >> width) + 2) // 64)), np.uint8)
        bits[(values >> width) + np.arange(n)] = 1
        high = np.packbits(bits, bitorder="little").view(U64)
        rank = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)])
        return (low, high, rank), n, width

    def lows(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), np.int64)
        at = i * self.width
        word, shift = at >> 6, (at & 63).astype(U64)
        value = self.low[word] >> shift
        carry = np.where(shift > 0, self.low[word + 1] << (U64(64) - np.maximum(shift, U64(1))), U64(0))
        return ((value | carry) & U64((1 << self.width) - 1)).astype(np.int64)

    def _select(self, k: np.ndarray, zero: bool) -> np.ndarray:
        """Position of the k-th (from 0) set, or clear, bit."""
        before = 64 * np.arange(len(self.rank)) - self.rank if zero else self.rank
        out = np.empty(len(k), np.int64)
        for start in range(0, len(k), 1 << 15):
            s = slice(start, start + (1 << 15))
            word = np.searchsorted(before, k[s], "right") - 1
            bits = ~self.high[word] if zero else self.high[word]
            left, place = k[s] - before[word], word.astype(np.int64) << 6
            for half in (32, 16, 8, 4, 2, 1):
                count = np.bitwise_count(bits & U64((1 << half) - 1))
                above = left >= count
                left -= count * above
                step = above * U64(half)
                bits >>= step
                place += step.view(np.int64)
            out[s] = place
        return out

    def at(self, i: np.ndarray) -> np.ndarray:
        return (self._select(i, False) - i) << self.width | self.lows(i)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Number of the first value that is at least x (``size`` if there is none)."""
        high = x >> self.width
        most = 64 * len(self.high) - self.size - 1
        inside = high <= most
        h = np.where(inside, high, 0)
        first = np.where(h > 0, self._select(np.maximum(h - 1, 0), True) - (h - 1), 0)
        last = self._select(h, True) - h
        low = x & ((1 << self.width) - 1)
        while len(on := np.flatnonzero(first < last)):
            mid = (first[on] + last[on]) >> 1
            less = self.lows(mid) < low[on]
            first[on] = np.where(less, mid + 1, first[on])
            last[on] = np.where(less, last[on], mid)
        return np.where(inside, first, self.size)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Number of the value x, -1 where it is not in the sequence."""
        i = self.successor(x)
        ok = i < self.size
        ok[ok] = self.at(i[ok]) == x[ok]
        return np.where(ok, i, -1)


class Trie:
    """A bucket's contexts, bigrams and trigrams with quantised shares, in one memory-mapped file."""

    def __init__(self, contexts: np.ndarray, context_of: np.ndarray, follower: np.ndarray, share: np.ndarray,
                 bigram_of: np.ndarray | None = None, third: np.ndarray | None = None,
                 third_share: np.ndarray | None = None):
        """``contexts``: sorted hashes; then one entry per bigram, sorted by (context_of, follower); then one per
        trigram, sorted by (bigram_of, third), ``bigram_of`` being the place of its bigram."""
        if bigram_of is None:
            bigram_of, third, third_share = (np.zeros(0, t) for t in (np.int64, np.int64, float))
        words, rank = ranked(np.concatenate([follower, third]))
        self.words = max(len(words), 1)
        levels = [EliasFano.encode(x) for x in (
            (contexts >> U64(2)).astype(np.int64), words,
            np.searchsorted(context_of, np.arange(len(contexts) + 1)), context_of * self.words + rank[:len(follower)],
            np.searchsorted(bigram_of, np.arange(len(follower) + 1)), bigram_of * self.words + rank[len(follower):])]
        codes = [np.clip(np.round((np.log10(x) - LOWEST) / STEP), 1, 255).astype(np.uint8)
                 for x in (share, third_share)]
        arrays = [a for level, _, _ in levels for a in level]
        mapped = _mapped([*arrays, *codes])
        self.contexts, self.vocabulary, self.to_bigrams, self.bigram, self.to_trigrams, self.trigram = (
            EliasFano(tuple(mapped[3 * i:3 * i + 3]), n, width) for i, (_, n, width) in enumerate(levels))
        self.codes, self.third_codes = mapped[-2:]

    def _below(self, pointers: EliasFano, level: EliasFano, parents: np.ndarray, of: np.ndarray,
               word: np.ndarray) -> np.ndarray:
        """Places in ``level`` of the words (numbers in the vocabulary, -1: unknown) below ``parents[of]`` (-1:
        unknown), -1 for those that were not learned."""
        known = np.maximum(parents, 0)
        some = min(pointers.size, 2) == 2
        begin, end = (pointers.at(known + k) if some else known * 0 for k in (0, 1))
        out = np.full(len(of), -1, np.int64)
        for start in range(0, len(of), 1 << 17):
            s = slice(start, start + (1 << 17))
            on = np.flatnonzero((parents[of[s]] >= 0) & (word[s] >= 0))
            up = of[s][on]
            want = parents[up] * self.words + word[s][on]
            i = level.successor(want)
            ok = (i >= begin[up]) & (i < end[up])
            ok[ok] = level.at(i[ok]) == want[ok]
            out[start + on[ok]] = i[ok]
        return out

    def bigrams(self, contexts: np.ndarray, of: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Places of the bigrams of ``contexts[of]`` and words of the vocabulary, -1 for those not learned."""
        parents = self.contexts.find((contexts >> U64(2)).astype(np.int64))
        return self._below(self.to_bigrams, self.bigram, parents, of, word)

    def trigrams(self, bigrams: np.ndarray, of: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Places of the trigrams that begin with the bigrams at places ``bigrams[of]``, -1 for those not learned."""
        return self._below(self.to_trigrams, self.trigram, bigrams, of, word)

    def look_up(self, context: np.ndarray, follower: np.ndarray) -> np.ndarray:
        """Codes of bigrams, 0 for those that were not learned."""
        return code_at(self.codes, self.bigrams(context, np.arange(len(context)), self.vocabulary.find(follower)))


def code_at(codes: np.ndarray, place: np.ndarray) -> np.ndarray:
    out = np.zeros(len(place), np.uint8)
    on = place >= 0
    out[on] = codes[place[on]]
    return out


def _mapped(arrays: list[np.ndarray]) -> list[np.ndarray]:
    """The arrays as views of one memory-mapped file; its name is gone at once, its space with the last view."""
    with tempfile.NamedTemporaryFile(delete=False) as f:
        starts = []
        for a in arrays:
            f.write(b"\0" * (-f.tell() % 64))
            starts.append(f.tell())
            f.write(a.tobytes())
        f.write(b"\0" * 64)
    data = np.memmap(f.name, np.uint8, "r")
    os.unlink(f.name)
    return [data[s:s + a.nbytes].view(a.dtype) for s, a in zip(starts, arrays, strict=True)]


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of the texts, each ended by ``END``, and the number of tokens of each."""
    hashes, counts = [], []
    start = 0
    while start < len(texts):
        stop, held = start, 0
        while stop < len(texts) and (stop == start or held + len(texts[stop]) < TURN_BYTES):
            held += len(texts[stop])
            stop += 1
        data = np.frombuffer(b" ".join(t.lower() for t in texts[start:stop]), np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts[start:stop]])
        a, b = word_bounds(data)
        per = np.diff(np.concatenate([[0], np.searchsorted(a, ends)]))
        out = np.full(len(a) + len(per), END, U64)
        place = np.arange(len(a)) + np.repeat(np.arange(len(per)), per)
        out[place] = word_hashes(data, a, b)
        hashes.append(out)
        counts.append(per + 1)
        start = stop
    if not hashes:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(counts)


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(a * U64(0x9E3779B97F4A7C15) + b)


def places(sorted_keys: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Place of each x among the keys, -1 where it is none of them."""
    i = np.searchsorted(sorted_keys, x)
    ok = i < len(sorted_keys)
    ok[ok] = sorted_keys[i[ok]] == x[ok]
    return np.where(ok, i, -1)


def ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys (none negative), sorted, and each key's number among them: one sort of key and place
    together where both fit into a word."""
    shift = len(keys).bit_length()
    if int(keys.max(initial=0)).bit_length() + shift > 63:
        return np.unique(keys, return_inverse=True)
    both = np.sort(keys << shift | np.arange(len(keys)))
    at = both & ((1 << shift) - 1)
    both >>= shift
    new = np.concatenate(([True], both[1:] != both[:-1]))[:len(both)]
    number = np.empty(len(keys), np.int64)
    number[at] = np.cumsum(new) - 1
    return both[new], number


def small(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts as bytes; those of 255 and more also as places and values."""
    many = np.flatnonzero(values >= 255)
    return np.minimum(values, 255).astype(np.uint8), many.astype(np.uint32), values[many].astype(U64)


def large(codes: np.ndarray, many: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = codes.astype(np.int64)
    out[many] = values
    return out


def frame(*arrays: np.ndarray) -> bytes:
    """The arrays as one zstandard frame after its full length."""
    data = pack(*arrays)
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def unframe(data: bytes, *kinds: str) -> list[np.ndarray]:
    return unpack(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True), *kinds)


def distinct(x: np.ndarray) -> np.ndarray:
    """The distinct values of a sorted array."""
    return x[np.concatenate(([True], x[1:] != x[:-1]))[:len(x)]]


class Hot:
    """Frequent words with their counts as contexts, frequent bigrams with the buckets that each is split over, and
    the words whose 40 bits are named by rank."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, pairs: np.ndarray, copies: np.ndarray,
                 named: np.ndarray | None = None):
        by, of = np.argsort(words), np.argsort(pairs)
        self.words, self.counts, self.pairs, self.copies = words[by], counts[by], pairs[of], copies[of]
        self.named = ((np.zeros(0, U64) if named is None else named) >> U64(24)).astype(np.int64)
        self.rank = np.argsort(self.named, kind="stable")

    def code(self, followers: np.ndarray) -> np.ndarray:
        """Ranks of followers, ``0xFFFF`` for those without one."""
        place = places(self.named[self.rank], followers)
        out = np.full(len(followers), 0xFFFF, np.uint16)
        out[place >= 0] = self.rank[place[place >= 0]]
        return out

    def unname(self, code: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        out, rest = np.empty(len(code), np.int64), code == 0xFFFF
        out[~rest] = self.named[code[~rest]]
        out[rest] = low | high.astype(np.int64) << 32
        return out

    def followed(self, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """How often each word was followed in training; ``counts`` hold it for words that are not frequent."""
        place = places(self.words, words)
        out = counts.copy()
        out[place >= 0] = self.counts[place[place >= 0]]
        return out


class Block:
    """Words, bigrams and, of order 3, trigrams of a block, in the order in which buckets are asked."""

    def __init__(self, texts: list[bytes], train: np.ndarray, hot: Hot, buckets: int, order: int = 2):
        h, self.per = tokens(texts)
        begin = np.cumsum(self.per) - self.per
        self.words, ids = np.unique(np.concatenate([h, np.array([START, END])]), return_inverse=True)
        self.ids, start = ids[:-2], ids[-2]
        learned = np.repeat(train, self.per)
        n = len(self.words)
        self.count = np.bincount(self.ids[learned], minlength=n)
        context = np.empty(len(h), np.int64)
        context[1:] = self.ids[:-1]
        context[begin] = start
        pairs, of = ranked(context * n + self.ids)
        left, right = np.divmod(pairs, n)
        self.home = (self.words % U64(buckets)).astype(np.int64)
        both = pair_hash(self.words[left], self.words[right])
        to = self.home[left]
        split = (places(hot.words, self.words) >= 0)[left]
        to[split] = both[split] % U64(buckets)
        # a frequent bigram stands in several buckets, its first place counts; bigrams by bucket, context, follower
        copies = np.ones(len(pairs), np.int64)
        if order == 3:
            place = places(hot.pairs, both)
            copies[place >= 0] = hot.copies[place[place >= 0]]
        first = np.cumsum(copies) - copies
        pair = np.repeat(np.arange(len(pairs)), copies)
        bucket = (to[pair] + spans(np.zeros(len(copies), np.int64), copies)) % buckets
        by = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
        place = np.empty_like(by)
        place[by] = np.arange(len(by))
        self.pair_of = place[first][of]
        self.pair_bucket, self.left, self.right = bucket[by], left[pair[by]], right[pair[by]]
        self.seen = np.bincount(of[learned], minlength=len(pairs))[pair[by]]
        of_pair = self.pair_bucket * n + self.left
        entry = distinct(np.sort(np.concatenate([self.home * n + np.arange(n), distinct(of_pair)])))
        self.entry_bucket, self.entry_word = np.divmod(entry, n)
        self.entry_pairs = np.diff(np.searchsorted(of_pair, np.append(entry, np.iinfo(np.int64).max)))
        self.is_home = self.entry_bucket == self.home[self.entry_word]
        # trigrams by the place of their bigram, then follower
        self.inner = np.delete(np.arange(len(h)), begin) if order == 3 else np.zeros(0, np.int64)
        bigram, third = of[self.inner - 1], self.ids[self.inner]
        share = (self.words >> U64(24)).astype(np.int64)
        at = place[first[bigram] + share[third] % copies[bigram]]
        tris, self.tri_of = ranked(at * n + third)
        self.tri_pair, third = np.divmod(tris, n)
        self.tri_seen = np.bincount(self.tri_of[learned[self.inner]], minlength=len(tris))
        self.pair_tris = np.bincount(self.tri_pair, minlength=len(self.left))
        self.follower, self.third = share[self.right], share[third]
        code = hot.code(share)
        self.follower_code, self.third_code = code[self.right], code[third]

    def slices(self, buckets: np.ndarray) -> list[tuple[slice, slice, slice]]:
        """Entries, bigrams and trigrams of each bucket."""
        e, p = ([np.searchsorted(x, buckets, side) for side in ("left", "right")]
                for x in (self.entry_bucket, self.pair_bucket))
        t = [np.searchsorted(self.tri_pair, x) for x in p]
        return [tuple(slice(int(a[k]), int(b[k])) for a, b in (e, p, t)) for k in range(len(buckets))]

    def requests(self):
        """(bucket, payload) of each bucket."""
        count = np.where(self.is_home, self.count[self.entry_word], 0)
        buckets = distinct(self.entry_bucket)
        for b, (i, j, k) in zip(buckets.tolist(), self.slices(buckets), strict=True):
            code = np.concatenate([self.follower_code[j], self.third_code[k]])
            rest = np.concatenate([self.follower[j], self.third[k]])[code == 0xFFFF]
            yield b, frame(self.words[self.entry_word[i]], *small(np.concatenate([
                count[i], self.entry_pairs[i], self.seen[j], self.pair_tris[j], self.tri_seen[k]])),
                code, (rest & 0xFFFFFFFF).astype(np.uint32), (rest >> 32).astype(np.uint8))


class Request:
    """A block's message to a bucket."""

    def __init__(self, data: bytes, hot: Hot):
        self.words, *rest = unframe(data, "u8", "u1", "u4", "u8", "u2", "u4", "u1")
        numbers, follower = large(*rest[:3]), hot.unname(*rest[3:])
        n = len(self.words)
        m = int(numbers[n:2 * n].sum())
        self.count, self.pairs, self.seen, self.tris, self.tri_seen = np.split(
            numbers, [n, 2 * n, 2 * n + m, 2 * n + 2 * m])
        self.follower, self.third = follower[:m], follower[m:]


ROWS = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("data", pa.binary())])
ROWS_DDL = "bucket int, block int, data binary"
SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                    ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
SCORES_DDL = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
              "score double")


def _table(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


@steady
def _deal(batches):
    """Rows of each block that is met, as one compressed payload for each ``DEAL_BYTES`` of text."""

    def out(held):
        t = pa.Table.from_batches(held)
        t = t.take(pa.compute.sort_indices(t["block"])).combine_chunks()
        block = t["block"].to_numpy()
        cut = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1], [True])))
        rows = []
        for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            sink = pa.BufferOutputStream()
            part = t.slice(i, j - i).drop_columns(["block"])
            with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as f:
                f.write_table(part)
            rows.append((int(block[i]), sink.getvalue().to_pybytes()))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, x) for c, x in zip(zip(*rows, strict=True), (pa.int32(), pa.binary()), strict=True)],
            names=["block", "data"])

    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size > DEAL_BYTES:
            yield out(held)
            held, size = [], 0
    if held:
        yield out(held)


def _block(t: pa.Table, hot: Hot, buckets: int, order: int) -> Block:
    t = pa.concat_tables([pa.ipc.open_stream(x.as_py()).read_all() for x in t["data"]])
    t = t.take(pa.compute.sort_indices(t, [("rowkey", "ascending")]))
    block = Block(t["data"].to_pylist(), t["train"].to_numpy(), hot, buckets, order)
    block.rows = t
    return block


def _ask(t: pa.Table, hot: Hot, buckets: int, order: int) -> pa.Table:
    number = t["block"][0].as_py()
    return _table(ROWS, [(b, number, data) for b, data in _block(t, hot, buckets, order).requests()])


def _answer(t: pa.Table, hot: Hot) -> pa.Table:
    """Sum a bucket's counts, build its trie, and answer each block in its own order."""
    got = [Request(x.as_py(), hot) for x in t["data"]]

    def all_(name: str) -> np.ndarray:
        return np.concatenate([getattr(g, name) for g in got])

    sizes = [(len(g.words), len(g.follower), len(g.third)) for g in got]
    contexts, of_entry = np.unique(all_("words"), return_inverse=True)
    count = np.zeros(len(contexts), np.int64)
    np.add.at(count, of_entry, all_("count"))
    n = len(all_("follower"))
    words, rank = ranked(np.concatenate([all_("follower"), all_("third")]))
    key, of_pair = ranked(np.repeat(of_entry, all_("pairs")) * len(words) + rank[:n])
    context, follower = np.divmod(key, max(len(words), 1))
    total = np.zeros(len(key), np.int64)
    np.add.at(total, of_pair, all_("seen"))
    asks = all_("tris")
    key, of_tri = ranked(np.repeat(of_pair, asks) * len(words) + rank[n:])
    bigram, third = np.divmod(key, max(len(words), 1))
    tri_total = np.zeros(len(key), np.int64)
    np.add.at(tri_total, of_tri, all_("tri_seen"))
    del got, key, rank
    weight = hot.followed(contexts, count)
    on, tri_on = total > 0, tri_total > 0
    trie = Trie(contexts, context[on], words[follower[on]], total[on] / (weight[context[on]] + MU),
                (np.cumsum(on) - 1)[bigram[tri_on]], words[third[tri_on]],
                tri_total[tri_on] / (total[bigram[tri_on]] + MU))
    word = trie.vocabulary.find(words)
    place = trie.bigrams(contexts, context, word[follower])
    codes = code_at(trie.codes, place)[of_pair]
    tri_codes = code_at(trie.third_codes, trie.trigrams(place, bigram, word[third]))[of_tri]
    out, e, p, k = [], 0, 0, 0
    for number, (n, m, l) in zip(t["block"].to_pylist(), sizes, strict=True):
        numbers = np.concatenate([count[of_entry[e:e + n]], total[of_pair[p:p + m][asks[p:p + m] > 0]]])
        out.append((t["bucket"][0].as_py(), number,
                    frame(*small(numbers), np.concatenate([codes[p:p + m], tri_codes[k:k + l]]))))
        e, p, k = e + n, p + m, k + l
    return _table(ROWS, out)


def _score(t: pa.Table, answers: pa.Table, hot: Hot, buckets: int, order: int, n_train: int, n_words: int) -> pa.Table:
    """Add up the documents' scores from the answers of all buckets."""
    if not t.num_rows:
        return SCORES.empty_table()
    block = _block(t, hot, buckets, order)
    total, followed = np.zeros(len(block.words), np.int64), np.zeros(len(block.left), np.int64)
    code, tri_code = np.zeros(len(block.left), np.uint8), np.zeros(len(block.tri_pair), np.uint8)
    for (i, j, k), data in zip(block.slices(answers["bucket"].to_numpy()), answers["data"], strict=True):
        *numbers, codes = unframe(data.as_py(), "u1", "u4", "u8", "u1")
        numbers, home = large(*numbers), block.is_home[i]
        n, m = i.stop - i.start, j.stop - j.start
        total[block.entry_word[i][home]] = numbers[:n][home]
        code[j], tri_code[k] = codes[:m], codes[m:]
        followed[j.start + np.flatnonzero(block.pair_tris[j])] = numbers[n:]
    p0 = (total + 1) / (n_train + n_words + 1)
    levels = np.where(np.arange(256) > 0, 10.0 ** (LOWEST + STEP * np.arange(256)), 0)
    rest = MU / (hot.followed(block.words, total) + MU)
    p = (levels[code] + rest[block.left] * p0[block.right])[block.pair_of]     # of each token after one word
    share, left = levels[tri_code], MU / (followed[block.tri_pair] + MU)
    p[block.inner] = share[block.tri_of] + left[block.tri_of] * p[block.inner]
    first = np.cumsum(block.per) - block.per
    score = np.add.reduceat(np.log10(p), first)
    base = np.add.reduceat(np.log10(p0)[block.ids], first)
    known = np.add.reduceat((total > 0)[block.ids].astype(np.int64), first)
    rows = block.rows
    return pa.table([rows["doc_id"], rows["held_out"], pa.array(block.per), pa.array(known),
                     pa.array(np.full(len(first), n_train, np.int64)), pa.array(base), pa.array(score)], schema=SCORES)


def _vocabulary(train: DataFrame, buckets: int) -> tuple[int, int, Hot]:
    """N, V, and the frequent words (with the text start) and bigrams."""
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())

    def summed(keys, counts):
        key, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(key), np.int64)
        np.add.at(total, at, np.concatenate(counts))
        return key, total

    @steady
    def words(batches):
        def out(found, docs):
            (key, count), (pair, seen) = (summed(*zip(*f, strict=True)) for f in found)
            of, at = ((x % U64(buckets)).astype(np.int64) for x in (key, pair))
            by, to = np.argsort(of, kind="stable"), np.argsort(at, kind="stable")
            cuts = [np.searchsorted(x, np.arange(buckets + 1)) for x in (of[by], at[to])]
            rows = []
            for b in np.union1d(of, at).tolist():
                i, j = by[cuts[0][b]:cuts[0][b + 1]], to[cuts[1][b]:cuts[1][b + 1]]
                rows.append((b, 0 if rows else docs, 0 if rows else int(seen.sum()),
                             pack(key[i], count[i].astype(np.uint32), pair[j], seen[j].astype(np.uint32))))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, x) for c, x in zip(zip(*rows, strict=True), kinds, strict=True)],
                names=["bucket", "docs", "looked", "data"])

        found, docs, held = ([], []), 0, 0
        for batch in batches:
            h, _ = tokens(batch.column(0).to_pylist())
            if len(h):
                at = np.arange(docs % PAIR_STEP, len(h), PAIR_STEP)
                left = np.where(at > 0, h[at - 1], END)
                pairs = pair_hash(np.where(left == END, START, left), h[at])
                for f, x in zip(found, (h, pairs), strict=True):
                    f.append(np.unique(x, return_counts=True))
                docs, held = docs + batch.num_rows, held + len(found[0][-1][0])
            if held > HELD_WORDS:
                yield out(found, docs)
                found, docs, held = ([], []), 0, 0
        if docs:
            yield out(found, docs)

    def total(t: pa.Table) -> pa.Table:
        got = [unpack(x.as_py(), "u8", "u4", "u8", "u4") for x in t["data"]]
        (key, n), (pair, seen) = (summed([g[i] for g in got], [g[i + 1] for g in got]) for i in (0, 2))
        top, most = (np.argsort(-x, kind="stable")[:HOT_EACH] for x in (n, seen))
        longs = pa.list_(pa.int64())
        return pa.table([pa.array([int(n.sum())]), pa.array([len(key)]),
                         *(pa.array([sum(t[c].to_pylist())]) for c in ("docs", "looked")),
                         *(pa.array([x.astype(np.int64)], longs) for x in (n[top], key[top], seen[most], pair[most]))],
                        names=["n", "v", "docs", "looked", "top_n", "top_h", "pair_n", "pair_h"])

    per = train.select("data").mapInArrow(words, "bucket int, docs long, looked long, data binary").groupBy(
        "bucket").applyInArrow(total, "n long, v long, docs long, looked long, top_n array<long>, top_h array<long>, "
                                      "pair_n array<long>, pair_h array<long>")
    per = stored(per, "vocabulary")
    row = per.agg(*(F.sum(c).alias(c) for c in ("n", "v", "docs", "looked"))).first()

    def frequent(number: str, name: str, least: float) -> tuple[np.ndarray, np.ndarray]:
        found = per.select(F.explode(F.arrays_zip(F.col(number).alias("n"), F.col(name).alias("h"))).alias("t")).select(
            "t.n", "t.h").where(F.col("n") > least).orderBy(F.desc("n"), "h").limit(HOT_WORDS).collect()
        return np.array([r.h for r in found], np.int64).astype(U64), np.array([r.n for r in found], np.int64)

    word, count = frequent("top_n", "top_h", (row.n or 0) / LEAST)      # fewer than LEAST words, whatever the corpus
    pair, seen = frequent("pair_n", "pair_h", (row.looked or 0) / (COPIES * buckets))
    split = (count > (row.n or 0) / (4 * buckets)) & (word != END)
    copies = np.clip(np.ceil(seen / max(row.looked or 0, 1) * COPIES * buckets), 1, buckets).astype(np.int64)
    return row.n or 0, row.v or 0, Hot(
        np.append(word[split], START), np.append(count[split], row.docs or 0), pair, copies, word)


def score_texts(docs: DataFrame, folds: int = 7, held_out: int = 2, doc_id: str = "doc_id", text: str = "text",
                order: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs``; the
    model, of ``order`` 2 or 3, learns from the rows whose crc32 of the id does not leave ``held_out`` modulo
    ``folds``."""
    if order not in (2, 3):
        raise ValueError(f"order {order}: 2 or 3")
    spark = docs.sparkSession
    prepare(spark)
    size, tasks = text_bytes(docs, text), shuffle_partitions(spark)
    per_block, per_bucket = (LM_BLOCK, LM_BUCKET) if order == 2 else (LM_BLOCK_3, LM_BUCKET_3)
    blocks, buckets = parts(size, per_block, tasks), parts(size, per_bucket, tasks)
    fold = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), (fold == held_out).alias("held_out"),
                       (fold != held_out).alias("train"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("data"))
    rows = rows.withColumn("rowkey", F.xxhash64("doc_id", "data"))
    n_train, n_words, hot = _vocabulary(rows.where("train"), buckets)
    rows = rows.withColumn("block", F.pmod("rowkey", F.lit(blocks)).cast("int"))
    grouped = rows.select("block", "doc_id", "held_out", "train", "rowkey", "data").mapInArrow(
        _deal, "block int, data binary").groupBy("block")
    answers = (grouped.applyInArrow(lambda t: frugal(_ask)(t, hot, buckets, order), ROWS_DDL)
               .groupBy("bucket").applyInArrow(lambda t: frugal(_answer)(t, hot), ROWS_DDL))
    return grouped.cogroup(answers.groupBy("block")).applyInArrow(
        lambda a, b: frugal(_score)(a, b, hot, buckets, order, n_train, n_words), SCORES_DDL)
