"""Periodic runs of words, by Lyndon arrays from the grouping phase of a suffix sorter.

A run is a stretch of consecutive words with smallest period q, of at least
``least`` words and ``power`` periods, that no neighbouring word extends.

1. *Grouping.*  Baier's suffix sorter groups the suffixes by a context that
   grows; groups are taken from the highest to the lowest.  Each suffix of the
   group at hand is appended to the context of the nearest one before it that
   is still open and lower; those extended by the same group, equally
   often, move together to a new group just above their old one.  At the end of
   this phase a suffix's context is its longest Lyndon prefix: the Lyndon array,
   without a suffix array.  It runs twice, once under an order of the words and
   once under the reverse order (``lyndon_lengths``).
2. *Roots.*  Every run's root is the longest Lyndon word at some position under
   one of the two orders.  A root (if a run has three periods, one that is
   followed by itself) is extended to both sides by longest common extensions (prefix hashes and binary search).
3. *Check.*  Each run's words are compared with those a period later, and its
   neighbours; after a collision of hashes its roots are extended word by word.

Before that, stretches that cannot hold a run are passed over: of a run's
grams of three words each occurs at least ``power - 1`` times in the text (``live``).
Words are compared themselves, by numbers that a task gives them.

The work is one scan without a shuffle.  A text is one task's memory, about
200 bytes for each of its words.  A null text has no words.  Each row is judged by itself, repeats
and null ids included; an empty table gives an empty result.  Columns that are
not named are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelkit.llm.common import U64, mixed, powers, prepare, spans, steady

TURN_BYTES = 2 << 20     # texts are handled together up to this size
RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def lyndon_lengths(rank: np.ndarray, ranks: int) -> np.ndarray:
    """Length of the longest Lyndon word at each position, in the order of the ranks.  Rank -1 is a wall
    that no word crosses; the last position is one."""
    n = len(rank)
    wall = np.flatnonzero(rank < 0)
    before = np.arange(-1, n - 1)
    before[wall[:-1] + 1] = -1
    order = np.argsort(rank, kind="stable")[len(wall):]
    members = [x.tolist() for x in np.split(order, np.searchsorted(rank[order], np.arange(1, ranks)))]
    # Open positions form a list: a position's context reaches to the next open one.
    left, right, group, length = before.tolist(), list(range(1, n + 1)), rank.tolist(), [0] * n
    lower, upper, top = list(range(-1, ranks - 1)), [*range(1, ranks), -1], ranks - 1
    while top >= 0:
        times: dict[int, int] = {}
        for i in members[top]:
            if group[i] == top:
                p, r = left[i], right[i]
                length[i] = r - i
                left[r] = p
                if p >= 0:
                    right[p] = r
                    times[p] = times.get(p, 0) + 1
        members[top] = ()
        top = lower[top]
        if top >= 0:
            upper[top] = -1
        moved: dict[tuple[int, int], list[int]] = {}
        for p, k in times.items():
            moved.setdefault((group[p], k), []).append(p)
        under: dict[int, int] = {}
        for old, k in sorted(moved):
            new, below = len(members), under.get(old, old)
            members.append(moved[old, k])
            for p in moved[old, k]:
                group[p] = new
            above = upper[below]
            lower.append(below)
            upper.append(above)
            upper[below] = new
            if above >= 0:
                lower[above] = new
            else:
                top = new
            under[old] = new
    return np.array(length, np.int64)


class Extension:
    """Longest common extensions of a text of numbers, by prefix hashes."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.up, self.down = powers(len(words) + 1)
        with np.errstate(over="ignore"):
            code = mixed(words.astype(U64) + U64(0x9E3779B97F4A7C15)) * self.up[:-1]
            self.sums = np.concatenate([np.zeros(1, U64), np.cumsum(code, dtype=U64)])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[end] - self.sums[start]) * self.down[start]

    def common(self, at: np.ndarray, by: np.ndarray, forward: bool) -> np.ndarray:
        """Length of the longest common part of the text from ``at`` and from ``at + by`` on, or before both."""
        low = np.zeros(len(at), np.int64)
        high = len(self.words) - at - by if forward else at.copy()
        while (low < high).any():
            half = (low + high + 1) >> 1
            start, end = (at, at + half) if forward else (at - half, at)
            same = self.hash(start, end) == self.hash(start + by, end + by)
            low, high = np.where(same, half, low), np.where(same, high, half - 1)
        return low

    def plain(self, at: int, by: int) -> tuple[int, int]:
        """The stretch of period ``by`` around ``at``, word by word."""
        words, start, end = self.words, at, at
        while end + by < len(words) and words[end] == words[end + by]:
            end += 1
        while start and words[start - 1] == words[start - 1 + by]:
            start -= 1
        return start, end + by


def holds(words: np.ndarray, run: np.ndarray) -> np.ndarray:
    """Which rows (start, end, period) of ``run`` are periodic and cannot be extended."""
    start, end, by = run.T
    size = end - start - by
    at = spans(start, size)
    bad = np.concatenate([[0], np.cumsum(words[at] != words[at + np.repeat(by, size)])])
    last = np.cumsum(size)
    edge = np.ones(len(run), bool)
    inner = start > 0
    edge[inner] &= words[start[inner] - 1] != words[start[inner] - 1 + by[inner]]
    inner = end < len(words)
    edge[inner] &= words[end[inner]] != words[end[inner] - by[inner]]
    return (bad[last] == bad[last - size]) & edge


def find_runs(rank: np.ndarray, ranks: int, least: int, power: int) -> np.ndarray:
    """(start, end, period) of every run in words 0..ranks-1; -1 is a wall, the last word is one."""
    n = len(rank)
    wall = np.flatnonzero(rank < 0)
    words = rank.astype(np.int64)
    words[wall] = ranks + np.arange(len(wall))      # a wall equals no other
    reach = Extension(words)
    found = []
    for order in (rank, np.where(rank < 0, -1, ranks - 1 - rank)):
        by = lyndon_lengths(order, ranks)
        copies = 1 if power > 2 else 0      # of the root, right behind its first place in a run
        at = np.flatnonzero((by > 0) & (np.arange(n) + (1 + copies) * by <= n))
        by = by[at]
        if copies:
            twice = reach.hash(at, at + by) == reach.hash(at + by, at + 2 * by)
            at, by = at[twice], by[twice]
        start = at - reach.common(at, by, forward=False)
        end = at + by + reach.common(at, by, forward=True)
        found.append(np.stack([start, end, by, at], axis=1))
    both = np.concatenate(found)
    run, which = np.unique(both[:, :3], axis=0, return_inverse=True)
    right = holds(words, run)
    if not right.all():
        again = both[~right[which.ravel()], 2:]
        plain = [(*reach.plain(at, by), by) for by, at in again.tolist()]
        run = np.unique(np.concatenate([run[right], np.array(plain, np.int64)]), axis=0)
    size = run[:, 1] - run[:, 0]
    return run[(size >= least) & (size >= power * run[:, 2])]


def live(word: np.ndarray, text: np.ndarray, least: int, power: int) -> np.ndarray:
    """Which words may lie in a run.  A run of period q has at least floor((length - k + 1) / q) grams of k words
    in each class of positions modulo q: with k = 3, ``power - 1`` if it has three periods and ``power + 1`` words at
    least; with k = 1, ``power``.  All of them are equal, so rarer grams lie in no run."""
    k, times = (3, power - 1) if power >= 3 and least > power else (1, power)
    if len(word) < k * times:
        return np.zeros(len(word), bool)
    with np.errstate(over="ignore"):
        key = mixed(text.astype(U64))
        for j in range(k):
            key = key[:len(word) - j] if j else key
            key = mixed(key * U64(3) + word[j:].astype(U64))
    key = key[text[:len(key)] == text[k - 1:]] if k > 1 else key
    at = np.flatnonzero(text[:len(text) - k + 1] == text[k - 1:])
    ordered = np.sort(key)
    often = ordered[times - 1:][ordered[times - 1:] == ordered[:len(ordered) - times + 1]]
    out = np.zeros(len(word), bool)
    if len(often):
        often = np.unique(often)
        place = np.minimum(np.searchsorted(often, key), len(often) - 1)
        at = at[often[place] == key]
        for j in range(k):
            out[at + j] = True
    return out


def runs_of(words: list[list[bytes]], least: int, power: int) -> np.ndarray:
    """(text, start, length, period) of the runs of some texts, in this order."""
    code: defaultdict[bytes, int] = defaultdict(count().__next__)
    size = np.array([len(x) for x in words], np.int64)
    word = np.fromiter(map(code.__getitem__, chain.from_iterable(words)), np.int64, int(size.sum()))
    text = np.repeat(np.arange(len(words)), size)
    first = np.cumsum(size) - size
    may = live(word, text, least, power)
    # Maximal stretches of such words within a text.
    edge = np.ones(len(word) + 1, bool)
    edge[1:-1] = (may[1:] != may[:-1]) | (text[1:] != text[:-1])
    cut = np.flatnonzero(edge)
    begin, length = cut[:-1], np.diff(cut)
    kept = may[begin] & (length >= least) if len(begin) else np.zeros(0, bool)
    begin, length = begin[kept], length[kept]
    if not len(begin):
        return np.zeros((0, 4), np.int64)
    source = spans(begin, length + 1)            # one place more for the wall behind a stretch
    wall = np.cumsum(length + 1) - 1
    source[wall] = -1
    inside = source >= 0
    known, rank = np.unique(word[source[inside]], return_inverse=True)
    ranks = np.full(len(source), -1, np.int64)
    ranks[inside] = rank
    run = find_runs(ranks, len(known), least, power)
    at = source[run[:, 0]]
    out = np.stack([text[at], at - first[text[at]], run[:, 1] - run[:, 0], run[:, 2]], axis=1)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words of a text joined by blanks, without those that a run repeats."""
    if len(runs):
        step = np.zeros(len(words) + 1, np.int64)
        np.add.at(step, runs[:, 0] + runs[:, 2], 1)
        np.add.at(step, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0).tolist()]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, least: int = 6, power: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, the runs by start and period, and the text with each run cut back to its first period."""
    if power < 2 or least < 1:
        raise ValueError("a run has two periods and one word at least")
    prepare(docs.sparkSession)
    names = ["doc_id", "n_words", "runs", "collapsed"]

    def turn(ids: list, words: list[list[bytes]]) -> pa.RecordBatch:
        runs = runs_of(words, least, power)
        cut = np.searchsorted(runs[:, 0], np.arange(len(words) + 1))
        fields = pa.StructArray.from_arrays([pa.array(runs[:, j]) for j in (1, 2, 3)], fields=list(_RUN))
        kept = [collapse(w, runs[a:b, 1:]) for w, a, b in zip(words, cut[:-1], cut[1:], strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([len(w) for w in words], pa.int64()),
             pa.ListArray.from_arrays(pa.array(cut, pa.int32()), fields), pa.array(kept, pa.binary())], names)

    @steady
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, words, size = [], [], 0
            for doc, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(doc)
                data = t.as_py()
                words.append(data.split())      # of bytes: at blanks, tabs and line breaks only
                size += len(data)
                if size >= TURN_BYTES:
                    yield turn(ids, words)
                    ids, words, size = [], [], 0
            if ids:
                yield turn(ids, words)

    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                        F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"))
            .mapInArrow(run, RUNS))


def with_periodic_tails(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The input that the registered query's contract asks for: in about one text of ten the words from a
    place on are replaced by the first of them, again and again."""
    h = F.crc32(F.col(doc_id).cast("string"))
    g = F.expr("h div 10")
    words = F.filter(F.split("t", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    a = F.pmod(F.col("g"), F.expr("nullif(n, 0)")).cast("int")
    p = F.expr("1 + cast((n - a) div (3 + g % 8) as int)")
    tail = F.flatten(F.array_repeat(F.slice(words, F.col("a") + 1, F.col("p")), F.expr("cast(ceil((n - a) / p) as int)")))
    made = F.array_join(F.concat(F.slice(words, F.lit(1), F.col("a")), F.slice(tail, F.lit(1), F.expr("n - a"))), " ")
    chosen = (F.col("h") % 10 == 0) & (F.col("n") > 0)
    return (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t"), h.alias("h"))
            .withColumn("g", g).withColumn("n", F.when(F.col("h") % 10 == 0, F.size(words)).otherwise(0))
            .withColumn("a", a).withColumn("p", p)
            .select("doc_id", F.when(chosen, made).otherwise(F.col("t")).alias("text")))


def digests(found: DataFrame) -> DataFrame:
    """The runs' number, the longest run (ties: smallest start, then period) and digests of runs and collapsed text."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return (found.withColumn("longest", longest)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"),
                    F.col("longest.length").alias("length"), (-F.col("longest.period")).alias("period"),
                    F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
                    F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                    F.sha2("collapsed", 256).alias("collapsed_sha256")))
