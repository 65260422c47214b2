"""Exact substring dedup by a hash-compared suffix sort.

A byte goes if a string of ``length`` bytes that covers it also starts
earlier: in a document with a smaller id, or earlier in the same one.

1. Documents with the same text collapse to the one with the smallest id
   (map-side minimum per SHA-256); the others go whole.
2. Each window of ``length`` bytes picks the ``K``-gram in it with the
   smallest hash, the leftmost if equal.  Equal windows pick equal grams at
   equal offsets, so only the picked grams (one in 35 bytes) are shuffled, and
   first only their hashes, aggregated per block, to learn which occur twice.
3. The text around each repeated gram (every window that picked it) goes to
   the gram's bucket.  Equal regions collapse to the earliest.  What is left
   of a gram is sorted there as suffixes from the gram on: a mergesort whose
   comparisons find the common extension of two suffixes by binary search on
   prefix polynomial hashes.  For each offset, runs in suffix order that
   share the right part and hash alike to the left are the classes of equal
   windows; all but the earliest of a class are marked, after a byte-by-byte
   comparison with it.
4. Marks return to their blocks, where spans are merged and cut out.

A gram with more than ``HOT`` occurrences is not gathered in one bucket: its
windows go to buckets by 128-bit window hashes, each at most once per block.
Texts are read by blocks (see ``common``); no step holds more than a block or
a bucket, and buckets follow the corpus size.

Null texts are empty.  Rows with a null id count as one document after all
others.  Rows repeated with the same id and text are the same place: none of
them is earlier.  Texts shorter than ``length`` keep all bytes.  Empty tables
give empty results.  The input's columns are passed through; those named like
a result column are replaced by it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from parcelkit.llm.common import (
    BYTE_CODE, U64, frugal, mixed, pack, parts, prepare, shuffle_partitions, spans, split_by, text_bytes, unpack)

K = 32                    # bytes of a gram
HOT = 4096                # occurrences of a gram that one bucket sorts
CHUNK_BYTES = 1 << 19     # text that is hashed at a time
TURN_BYTES = 1 << 20      # region bytes that are sorted at a time
BLOCK_BYTES = 4 << 20     # text bytes per block
BUCKET_TEXT = 12 << 20    # corpus bytes per bucket
LAST = (1 << 63) - 1
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
RESULT = {"n_bytes": T.LongType(), "n_removed": T.LongType(), "n_spans": T.LongType(),
          "kept_sha256": T.StringType(), "kept": T.BinaryType()}


class Hashes:
    """Prefix polynomial hashes modulo 2**64 of substituted bytes; any substring's hash in O(1)."""

    def __init__(self, data: np.ndarray, base: int = BASES[0]):
        with np.errstate(over="ignore"):
            n = len(data) + 1
            up = np.full(n, base, U64)
            up[0] = 1
            up = np.multiply.accumulate(up)
            down = np.full(n, pow(base, -1, 1 << 64), U64)
            down[0] = 1
            self.down = np.multiply.accumulate(down)
            self.sums = np.concatenate([np.zeros(1, U64), np.cumsum(BYTE_CODE[data] * up[:-1], dtype=U64)])

    def of(self, start: np.ndarray, size) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[start + size] - self.sums[start]) * self.down[start]

    def extension(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the common extension of the suffixes at a and b, at most ``most``: binary search."""
        low, high = np.zeros(len(a), np.int64), most.astype(np.int64)
        while len(on := np.flatnonzero(low < high)):
            mid = (low[on] + high[on] + 1) >> 1
            same = self.of(a[on], mid) == self.of(b[on], mid)
            low[on] = np.where(same, mid, low[on])
            high[on] = np.where(same, high[on], mid - 1)
        return low


def grams(data: np.ndarray, begin: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Picked grams of the documents that start at ``begin`` in ``data``: document, position, offsets of the
    first and last window that picked it (relative to the gram), and its hash."""
    n, w = len(data), length - K + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none, none.astype(U64)
    hashes = Hashes(data)
    with np.errstate(over="ignore"):
        key = mixed((hashes.sums[K:] - hashes.sums[:-K]) * hashes.down[:-K])
    low = key & U64(0xFFFFFFFF00000000) | np.arange(len(key), dtype=U64)
    span = 1
    while 2 * span <= w:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if w > span:
        low = np.minimum(low[:len(low) - (w - span)], low[w - span:])
    at = (low & U64(0xFFFFFFFF)).astype(np.int64)
    end = np.append(begin[1:], n)
    doc = np.repeat(np.arange(len(begin)), end - begin)
    first = np.arange(len(at))
    valid = first + length <= end[doc[:len(at)]]
    new = valid.copy()
    new[1:] &= (at[1:] != at[:-1]) | (doc[1:len(at)] != doc[:len(at) - 1]) | ~valid[:-1]
    i = np.flatnonzero(new)
    stop = valid.copy()
    stop[:-1] &= ~valid[1:] | new[1:]
    j = np.flatnonzero(stop)
    return doc[i], at[i], i - at[i], j - at[i], key[at[i]]


def sort_suffixes(order: np.ndarray, group: np.ndarray, compare) -> np.ndarray:
    """Mergesort of ``order`` inside equal runs of ``group``: all runs of a width merge at once, each
    element finding its place in the sibling run by binary search with ``compare(a, b)`` (sign of a - b)."""
    n = len(order)
    edge = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    size = np.diff(np.append(edge, n))
    begin, count = np.repeat(edge, size), np.repeat(size, size)
    width = 1
    while width < size.max(initial=0):
        on = np.flatnonzero(count > width)
        inside = on - begin[on]
        run = inside // width
        other = begin[on] + (run ^ 1) * width
        stop = np.minimum(other + width, begin[on] + count[on])
        left = run % 2 == 0
        low, high = np.minimum(other, stop), stop.copy()
        base = low.copy()
        while len(act := np.flatnonzero(low < high)):
            mid = (low[act] + high[act]) >> 1
            sign = compare(order[mid], order[on[act]])
            after = np.where(left[act], sign < 0, sign <= 0)
            low[act] = np.where(after, mid + 1, low[act])
            high[act] = np.where(after, high[act], mid)
        place = begin[on] + (run // 2) * 2 * width + (inside - run * width) + (low - base)
        merged = order.copy()
        merged[place] = order[on]
        order = merged
        width *= 2
    return order


def equal_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` bytes at a and at b are the same (the collision check)."""
    out = np.ones(len(a), bool)
    for start in range(0, len(a), 8192):
        s = slice(start, start + 8192)
        differ = data[spans(a[s], size[s])] != data[spans(b[s], size[s])]
        if differ.any():
            out[np.repeat(np.arange(start, start + len(a[s])), size[s])[differ]] = False
    return out


def decide(key, order_of, lo, hi, data, begin, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Members and the first and last offset of their windows that also start earlier.

    ``order_of`` ranks members by (id, position), equal for equal places;
    a member's region lies at ``begin`` in ``data``.
    """
    hashes = Hashes(data)
    size = hi - lo + length
    marks: list[tuple] = []

    def mark(member, partner, first, last) -> None:
        ok = equal_bytes(data, begin[member] + first - lo[member], begin[partner] + first - lo[partner],
                         last - first + length)
        marks.append((member[ok], first[ok], last[ok]))
        for m, p, f, t in zip(member[~ok], partner[~ok], first[~ok], last[~ok], strict=True):
            one = np.arange(f, t + 1)          # hashes collided: window by window
            each = equal_bytes(data, begin[m] + one - lo[m], begin[p] + one - lo[p], np.full(len(one), length))
            marks.append((np.full(each.sum(), m), one[each], one[each]))

    # equal regions of a gram: all but the earliest are covered whole
    with np.errstate(over="ignore"):
        region = mixed(hashes.of(begin, size) ^ mixed(key + (lo * 1024 + hi).astype(U64)))
    by = np.lexsort((order_of, region))
    new = np.concatenate(([True], region[by][1:] != region[by][:-1]))
    first = by[np.flatnonzero(new)][np.cumsum(new) - 1]
    later = np.flatnonzero(order_of[by] > order_of[first])
    mark(by[later], first[later], lo[by[later]], hi[by[later]])
    alone = by[new | (order_of[by] == order_of[first])]

    # distinct regions: suffix sort from the gram on
    alone = alone[np.lexsort((order_of[alone], key[alone]))]
    group = key[alone]
    many = np.concatenate(([False], group[1:] == group[:-1]))
    many[:-1] |= many[1:]
    order, group = alone[many], group[many]
    if len(order):
        anchor, right = begin - lo, hi + length

        def compare(a, b):
            most = np.minimum(right[a], right[b])
            same = hashes.extension(anchor[a], anchor[b], most)
            over = same >= most
            x = data[np.where(over, 0, anchor[a] + same)].astype(np.int64)
            y = data[np.where(over, 0, anchor[b] + same)].astype(np.int64)
            return np.where(over, np.sign(right[a] - right[b]), np.sign(x - y))

        order = sort_suffixes(order, group, compare)
        common = np.zeros(len(order), np.int64)
        a, b = order[:-1], order[1:]
        near = np.flatnonzero(group[1:] == group[:-1])
        common[1:][near] = hashes.extension(anchor[a[near]], anchor[b[near]], np.minimum(right[a[near]], right[b[near]]))
        found: list[tuple] = []
        for o in range(int(lo[order].min()), int(hi[order].max()) + 1):
            run = np.cumsum(common < length + o)
            on = np.flatnonzero((lo[order] <= o) & (hi[order] >= o))
            if not len(on):
                continue
            members = order[on]
            with np.errstate(over="ignore"):
                cls = mixed(hashes.of(anchor[members] + o, -o) + mixed(run[on].astype(U64) + U64(1)))
            by = np.lexsort((order_of[members], cls))
            members, cls = members[by], cls[by]
            new = np.concatenate(([True], cls[1:] != cls[:-1]))
            first = members[np.flatnonzero(new)][np.cumsum(new) - 1]
            later = order_of[members] > order_of[first]
            found.append((members[later], first[later], np.full(later.sum(), o)))
        member, partner, offset = (np.concatenate(x) for x in zip(*found, strict=True))
        by = np.lexsort((offset, partner, member))
        member, partner, offset = member[by], partner[by], offset[by]
        new = np.concatenate(([True], (member[1:] != member[:-1]) | (partner[1:] != partner[:-1])
                              | (offset[1:] != offset[:-1] + 1)))[:len(member)]
        start = np.flatnonzero(new)
        stop = np.append(start, len(member))[1:] - 1      # none if no window is shared
        mark(member[start], partner[start], offset[start], offset[stop])
    return tuple(np.concatenate(x) for x in zip(*marks, strict=True))


def _chunks(sizes: np.ndarray) -> list[tuple[int, int]]:
    """Runs of documents of about ``CHUNK_BYTES``."""
    out, start, held = [], 0, 0
    for i, n in enumerate(sizes.tolist()):
        if held and held + n > CHUNK_BYTES:
            out.append((start, i))
            start, held = i, 0
        held += n
    return [*out, (start, len(sizes))] if len(sizes) else out


class Block:
    """The documents of a block that are nobody's copies, in chunks of concatenated bytes."""

    def __init__(self, left: pa.Table, right: pa.Table | None):
        self.rowkey = left["_rowkey"].to_numpy()
        self.id = left["_id"].to_numpy()
        copies = right["rowkey"].drop_null().to_numpy() if right is not None else self.rowkey[:0]
        self.copy = np.isin(self.rowkey, copies)
        self.text = left["_text"]

    def chunks(self):
        own = np.flatnonzero(~self.copy)
        texts = [self.text[i].as_py() for i in own.tolist()]
        sizes = np.array([len(t) for t in texts], np.int64)
        for a, b in _chunks(sizes):
            begin = np.cumsum(sizes[a:b]) - sizes[a:b]
            yield own[a:b], np.frombuffer(b"".join(texts[a:b]), np.uint8), begin


def _rows(schema: pa.Schema, columns: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, t) for c, t in
                                 zip(zip(*columns, strict=True) if columns else [()] * len(schema.types),
                                     schema.types, strict=True)], schema=schema)


KEYS = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("data", pa.binary())])
ANSWERS = pa.schema([("block", pa.int32()), ("rowkey", pa.int64()), ("data", pa.binary())])
REGIONS = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("block", pa.int32()), ("data", pa.binary())])
KEYS_DDL = "bucket int, block int, data binary"
ANSWERS_DDL = "block int, rowkey long, data binary"
REGIONS_DDL = "bucket int, kind int, block int, data binary"
SORTED, HASHED, MARKED = 0, 1, 2


def _send_keys(left: pa.Table, right: pa.Table, length: int, buckets: int) -> pa.Table:
    """Hashes of a block's grams with their counts, by bucket."""
    if not left.num_rows:
        return _rows(KEYS, [])
    found = [grams(data, begin, length)[4] for _, data, begin in Block(left, right).chunks()]
    key, count = np.unique(np.concatenate(found) if found else np.zeros(0, U64), return_counts=True)
    block = left["_block"][0].as_py()
    return _rows(KEYS, [(b, block, pack(key[i], count[i].astype(np.uint32)))
                        for b, i in split_by((key % U64(buckets)).astype(np.int64), buckets)])


def _find_repeats(rows: pa.Table) -> pa.Table:
    """To each block, which of its grams occur more than once, and which more than ``HOT`` times."""
    got = [unpack(x.as_py(), "u8", "u4") for x in rows["data"]]
    key, at = np.unique(np.concatenate([k for k, _ in got]), return_inverse=True)
    total = np.bincount(at, np.concatenate([c for _, c in got]), len(key))
    out, start = [], 0
    for block, (k, _) in zip(rows["block"].to_pylist(), got, strict=True):
        n = total[at[start:start + len(k)]]
        start += len(k)
        if (n > 1).any():
            out.append((block, None, pack(k[n > 1], (n[n > 1] > HOT).astype(np.uint8))))
    return _rows(ANSWERS, out)


def _send_regions(left: pa.Table, right: pa.Table, length: int, buckets: int) -> pa.Table:
    """The regions of a block's repeated grams by bucket; windows of hot grams by their own hashes."""
    if not left.num_rows or right["data"].null_count == right.num_rows:
        return _rows(REGIONS, [])
    got = [unpack(x.as_py(), "u8", "u1") for x in right["data"] if x.is_valid]
    repeated, hot = np.concatenate([k for k, _ in got]), np.concatenate([h for _, h in got])
    by = np.argsort(repeated)
    repeated, hot = repeated[by], hot[by]
    block, number = Block(left, right), left["_block"][0].as_py()
    out, windows = [], []
    for docs, data, begin in block.chunks():
        doc, at, lo, hi, key = grams(data, begin, length)
        i = np.minimum(np.searchsorted(repeated, key), len(repeated) - 1)
        twice = repeated[i] == key
        many = twice & (hot[i] > 0)
        if many.any():
            size = (hi - lo + 1)[many]
            start = spans((at + lo)[many], size)
            d = np.repeat(doc[many], size)
            windows.append((mixed(Hashes(data).of(start, length)), mixed(Hashes(data, BASES[1]).of(start, length)),
                            docs[d], start - begin[d]))
        on = np.flatnonzero(twice & ~many)
        for b, part in split_by((key[on] % U64(buckets)).astype(np.int64), buckets):
            j = on[part]
            used, place = np.unique(docs[doc[j]], return_inverse=True)
            size = hi[j] - lo[j] + length
            out.append((b, SORTED, number, pack(
                block.rowkey[used], block.id[used], place.astype(np.uint32), (at[j] - begin[doc[j]]).astype(np.int32),
                lo[j].astype(np.int16), hi[j].astype(np.int16), key[j], data[spans(at[j] + lo[j], size)])))
    if windows:
        h1, h2, row, pos = (np.concatenate(x) for x in zip(*windows, strict=True))
        marked, first = _earliest(h1, h2, block.id[row], pos)
        out.append((number % buckets, MARKED, number, _marks(block.rowkey[row[marked]], pos[marked], pos[marked] + length)))
        for b, j in split_by((h1[first] % U64(buckets)).astype(np.int64), buckets):
            j = first[j]
            out.append((b, HASHED, number, pack(h1[j], h2[j], block.id[row[j]], block.rowkey[row[j]],
                                                pos[j].astype(np.int32))))
    return _rows(REGIONS, out)


def _earliest(h1, h2, ids, pos) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose window also starts earlier, and the earliest rows of each window."""
    by = np.lexsort((pos, ids, h2, h1))
    new = np.concatenate(([True], (h1[by][1:] != h1[by][:-1]) | (h2[by][1:] != h2[by][:-1])))[:len(by)]
    first = by[np.flatnonzero(new)][np.cumsum(new) - 1]
    later = (ids[by] > ids[first]) | (pos[by] > pos[first])
    return by[later], by[~later]


def _marks(rowkey, start, stop) -> bytes:
    """Marked spans, those of a document that touch joined."""
    if not len(rowkey):
        return pack(rowkey.astype(np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32))
    by = np.lexsort((start, rowkey))
    k, s, e = rowkey[by], start[by], stop[by]
    reach = e.copy()
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (s[1:] > reach[:-1])
    first = np.flatnonzero(new)
    return pack(k[first].astype(np.int64), s[first].astype(np.int32),
                np.maximum.reduceat(reach, first).astype(np.int32))


def _sort_bucket(rows: pa.Table, length: int) -> pa.Table:
    """Decide a bucket's windows; marks go back to their blocks."""
    out = []
    kinds, blocks = rows["kind"].to_numpy(), rows["block"].to_numpy()
    for i in np.flatnonzero(kinds == MARKED).tolist():
        out.append((int(blocks[i]), None, rows["data"][i].as_py()))
    hashed = np.flatnonzero(kinds == HASHED)
    if len(hashed):
        got = [unpack(rows["data"][i].as_py(), "u8", "u8", "i8", "i8", "i4") for i in hashed.tolist()]
        h1, h2, ids, rowkey, pos = (np.concatenate(x) for x in zip(*got, strict=True))
        block = np.repeat(blocks[hashed], [len(g[0]) for g in got])
        later, _ = _earliest(h1, h2, ids, pos)
        out += _by_block(block[later], rowkey[later], pos[later], pos[later] + length)
    sort = np.flatnonzero(kinds == SORTED)
    if len(sort):
        names = ("i8", "i8", "u4", "i4", "i2", "i2", "u8", "u1")
        got = [unpack(rows["data"][i].as_py(), *names) for i in sort.tolist()]
        rowkey = np.concatenate([g[0][g[2]] for g in got])
        ids = np.concatenate([g[1][g[2]] for g in got])
        pos, lo, hi = (np.concatenate([g[c] for g in got]).astype(np.int64) for c in (3, 4, 5))
        key, data = np.concatenate([g[6] for g in got]), np.concatenate([g[7] for g in got])
        block = np.repeat(blocks[sort], [len(g[2]) for g in got])
        del got
        size = hi - lo + length
        begin = np.cumsum(size) - size
        by = np.argsort(key, kind="stable")
        edge = np.flatnonzero(np.concatenate(([True], key[by][1:] != key[by][:-1])))
        filled = np.cumsum(size[by])
        start = 0
        while start < len(by):
            # whole groups of about TURN_BYTES
            stop = int(np.searchsorted(filled, (filled[start - 1] if start else 0) + TURN_BYTES, "right"))
            after = edge[np.searchsorted(edge, max(stop, start + 1)):]
            stop = int(after[0]) if len(after) else len(by)
            j = by[start:stop]
            start = stop
            own = data[spans(begin[j], size[j])]
            at = np.cumsum(size[j]) - size[j]
            place = np.lexsort((pos[j], ids[j]))
            p, q = ids[j][place], pos[j][place]
            rank = np.empty(len(j), np.int64)
            rank[place] = np.cumsum(np.concatenate(([0], (p[1:] != p[:-1]) | (q[1:] != q[:-1]))))
            m, first, last = decide(key[j], rank, lo[j], hi[j], own, at, length)
            m_pos = pos[j][m]
            out += _by_block(block[j][m], rowkey[j][m], m_pos + first, m_pos + last + length)
    return _rows(ANSWERS, out)


def _by_block(block, rowkey, start, stop) -> list[tuple]:
    order = np.argsort(block, kind="stable")
    values, cut = np.unique(block[order], return_index=True)
    return [(int(b), None, _marks(rowkey[i], start[i], stop[i]))
            for b, i in zip(values, np.split(order, cut[1:]), strict=False)]


def _kept(left: pa.Table, right: pa.Table):
    """For each row of a block: bytes removed, spans removed, bytes kept."""
    block = Block(left, right)
    got = [unpack(x.as_py(), "i8", "i4", "i4") for x in right["data"] if x.is_valid]
    key, start, stop = ((np.concatenate(x) for x in zip(*got, strict=True)) if got
                        else (np.zeros(0, np.int64),) * 3)
    by = np.argsort(key, kind="stable")
    key, start, stop = key[by], start[by], stop[by]
    for i, row in enumerate(block.rowkey):
        text = block.text[i].as_py()
        a, b = np.searchsorted(key, row), np.searchsorted(key, row, "right")
        if block.copy[i]:
            yield len(text), 1, b""
        elif b > a:
            cover = np.zeros(len(text) + 1, np.int64)
            np.add.at(cover, start[a:b], 1)
            np.add.at(cover, stop[a:b], -1)
            gone = np.cumsum(cover)[:-1] > 0
            spans_gone = int((gone & ~np.concatenate(([False], gone[:-1]))).sum())
            yield int(gone.sum()), spans_gone, np.frombuffer(text, np.uint8)[~gone].tobytes()
        else:
            yield 0, 0, text


def _cut(left: pa.Table, right: pa.Table, names: list[str], types: list) -> pa.Table:
    """A block's rows with the result columns."""
    result = {n: [] for n in RESULT}
    for removed, n_spans, kept in _kept(left, right):
        values = (removed + len(kept), removed, n_spans, hashlib.sha256(kept).hexdigest(), kept)
        for n, v in zip(RESULT, values, strict=True):
            if n in names:
                result[n].append(v)
    return pa.Table.from_arrays([pa.array(result[n], t) if n in RESULT else left[n].cast(t)
                                 for n, t in zip(names, types, strict=True)], names=names)


def _rewrite(left: pa.Table, right: pa.Table, names: list[str], types: list, text: str) -> pa.Table:
    """A block's rows with the text cut (and ``n_chars``, if there is one, set anew)."""
    new = {text: left[text].to_pylist()}
    if "n_chars" in names and text != "n_chars":
        new["n_chars"] = left["n_chars"].to_pylist()
    for i, (removed, _, kept) in enumerate(_kept(left, right)):
        if removed:
            new[text][i] = kept.decode("utf-8", "ignore")
            if "n_chars" in new:
                new["n_chars"][i] = len(new[text][i])
    return pa.Table.from_arrays([pa.array(new[n], t) if n in new else left[n].cast(t)
                                 for n, t in zip(names, types, strict=True)], names=names)


def one(group):
    run = frugal(group)
    return lambda t: run(t)


def two(group):
    run = frugal(group)
    return lambda a, b: run(a, b)


def _marked(docs: DataFrame, passed: list[str], length: int, doc_id: str, text: str):
    """The documents by block, and beside them their copies and marks."""
    spark = docs.sparkSession
    prepare(spark)
    total = text_bytes(docs, text)
    tasks = shuffle_partitions(spark)
    blocks, buckets = parts(total, BLOCK_BYTES, tasks), parts(total, BUCKET_TEXT, tasks)
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    base = docs.select(*passed, F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("_id"), data.alias("_text"))
    base = base.withColumn("_rowkey", F.xxhash64("_id", "_text"))
    base = base.withColumn("_block", F.pmod("_rowkey", F.lit(blocks)).cast("int"))

    digest = base.where(F.octet_length("_text") >= length).select("_block", "_rowkey", "_id", F.sha2("_text", 256).alias("s"))
    earliest = digest.groupBy("s").agg(F.min("_id").alias("e"), F.max("_id").alias("m")).where("m > e").select("s", "e")
    copies = digest.join(earliest, "s").where("_id > e").select(
        F.col("_block").alias("block"), F.col("_rowkey").alias("rowkey"), F.lit(None).cast("binary").alias("data"))

    grouped = base.groupBy("_block")

    def beside(answers: DataFrame):
        return grouped.cogroup(answers.groupBy("block"))

    keys = beside(copies).applyInArrow(two(lambda a, b: _send_keys(a, b, length, buckets)), KEYS_DDL)
    repeats = keys.groupBy("bucket").applyInArrow(_find_repeats, ANSWERS_DDL)
    regions = beside(copies.unionAll(repeats)).applyInArrow(two(lambda a, b: _send_regions(a, b, length, buckets)), REGIONS_DDL)
    marks = regions.groupBy("bucket").applyInArrow(one(lambda t: _sort_bucket(t, length)), ANSWERS_DDL)
    return beside(copies.unionAll(marks))


def _arrow(schema: T.StructType) -> tuple[list[str], list]:
    return schema.names, [to_arrow_type(f.dataType) for f in schema]


def suffix_dedup(docs: DataFrame, length: int = 100, doc_id: str = "doc_id", text: str = "text",
                 with_bytes: bool = True) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans, kept_sha256 and, if wanted, kept (the remaining bytes)."""
    passed = [c for c in docs.columns if c not in RESULT and (with_bytes or c != text)]
    fields = [docs.schema[c] for c in passed]
    fields += [T.StructField(n, t) for n, t in RESULT.items() if with_bytes or n != "kept"]
    schema = T.StructType(fields)
    names, types = _arrow(schema)
    return _marked(docs, passed, length, doc_id, text).applyInArrow(
        two(lambda a, b: _cut(a, b, names, types)), schema)


def drop_repeats(docs: DataFrame, length: int = 100, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs``, same columns, with the repeated bytes cut out of the text (a character that is cut in part
    goes whole) and, if there is an ``n_chars``, that column set anew where the text changed."""
    names, types = _arrow(docs.schema)
    return _marked(docs, docs.columns, length, doc_id, text).applyInArrow(
        two(lambda a, b: _rewrite(a, b, names, types, text)), docs.schema)
