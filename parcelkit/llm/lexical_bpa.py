"""Ranked lexical search by the Best Position Algorithm.

Terms are the maximal runs of ASCII letters and digits and of characters beyond
ASCII; only A-Z are put in lower case.  A document's score for an item is the
sum, over the item's terms with repeats, of a term weight times a saturated
term frequency, all in 64-bit integers (``weight``, ``saturated``).

1. *Index.*  One scan of the documents packs blocks of about ``BLOCK_TEXT``
   bytes of text: ids, lengths, and the postings of the terms that some item
   holds.  The index is a written table, one row a block; nothing is shuffled.
2. *Statistics.*  Documents, terms and document frequencies are summed over all
   blocks of the index.
3. *Search.*  A block's postings become impact lists (one a term, greatest
   impact first).  For each item its lists are read in parallel, in rounds of
   doubling depth.  A document met for the first time is scored at once by
   direct accesses to all lists of the item; each access marks the position
   where it found the document.  The best position of a list is the last one
   before its first position not yet seen, by either way.  The impacts there
   add up to a bound on every document not met, and an item's search in the
   block ends when that bound is strictly below its k-th score, so ties
   are settled by id among all that tie.  A task carries its best k from block
   to block; tasks send k rows an item, which are merged in two levels.

Items are carried to the tasks: at most ``QUERY_BYTES`` of their text at once, in as
many passes as that takes.

A null text has no term.  Documents without a term count nowhere.  Each row is a
document and each row of the items an item, repeats included; a null doc_id comes
after all others of an equal score.  An empty table, or an item without a term that
some document holds, gives no rows.  Columns that are not named are not read.
A text is one task's memory.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelkit.llm.common import parts, prepare, spans, steady, stored, text_bytes

BLOCK_TEXT = 8 << 20     # bytes of text in a block of the index
QUERY_BYTES = 8 << 20    # bytes of item text that one pass carries to the tasks
FIRST_DEPTH = 16         # positions of each list read in the first round
MERGE_SALTS = 64         # parts of an item's candidates in the first level of the merge

INDEX = ("n_docs long, n_terms long, doc_ids binary, id_null binary, lengths binary, terms array<int>, "
         "document_counts array<int>, docs binary, counts binary")
HITS = "item int, item_id long, doc_id long, score long"
RESULT = "item_id long, rank int, doc_id long, score long"

_FOLD = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)).lower()


def terms(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text."""
    return text.translate(_FOLD).split()


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def damping(lengths: list[int], n: int, total: int) -> np.ndarray:
    """The length term of each document; Python's integers, so that no product overflows."""
    return np.array([75 + 25 * x * n // total for x in lengths], np.int64)


def saturated(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


class Builder:
    """Collects one block of the index."""

    def __init__(self, code: dict[bytes, int]):
        self.code, self.size = code, 0
        self.ids: list = []
        self.lengths: list[int] = []
        self.found: list[np.ndarray] = []

    def add(self, doc, text: bytes) -> None:
        words = terms(text)
        self.size += len(text)
        if words:
            code = np.fromiter(map(self.code.get, words, repeat(-1)), np.int64, len(words))
            self.ids.append(doc)
            self.lengths.append(len(words))
            self.found.append(code[code >= 0])

    def row(self) -> tuple:
        n = len(self.ids)
        code = np.concatenate([*self.found, np.zeros(0, np.int64)])
        at = np.repeat(np.arange(n), [len(x) for x in self.found])
        key, count = np.unique(code * n + at, return_counts=True)
        term, df = np.unique(key // max(n, 1), return_counts=True)
        null = np.array([x is None for x in self.ids], bool)
        ids = np.array([x or 0 for x in self.ids], np.int64)
        return (n, sum(self.lengths), ids.tobytes(), null.tobytes(), np.array(self.lengths, np.int64).tobytes(),
                term.tolist(), df.tolist(), (key % max(n, 1)).astype(np.int32).tobytes(), count.astype(np.int32).tobytes())


class Block:
    """Impact lists of one block, in two orders: by impact for sorted access, by document for direct access."""

    def __init__(self, row: dict, weights: np.ndarray, n: int, total: int):
        lengths = np.frombuffer(row["lengths"], np.int64)
        self.ids = np.frombuffer(row["doc_ids"], np.int64)
        self.null = np.frombuffer(row["id_null"], bool)
        self.term = np.array(row["terms"], np.int64)
        self.size = np.array(row["document_counts"], np.int64)
        self.start = np.cumsum(self.size) - self.size
        doc = np.frombuffer(row["docs"], np.int32).astype(np.int64)
        tf = np.frombuffer(row["counts"], np.int32).astype(np.int64)
        of = np.repeat(np.arange(len(self.term)), self.size)
        self.impact = weights[self.term[of]] * saturated(tf, damping(lengths.tolist(), n, total)[doc])
        self.key = of * len(lengths) + doc
        order = np.lexsort((-self.impact, of))
        self.listed, self.listed_impact = doc[order], self.impact[order]
        self.place = np.empty(len(order), np.int64)     # of a posting in its impact list, from 0
        self.place[order] = np.arange(len(order)) - self.start[of]

    def lists(self, want: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the block's lists for an item's terms, and the terms' repeats in the item."""
        at = np.searchsorted(self.term, want)
        here = at < len(self.term)
        here[here] = self.term[at[here]] == want[here]
        return at[here], times[here]


def best_positions(block: Block, lists: np.ndarray, times: np.ndarray, k: int, bar: int) -> tuple:
    """Documents of the block that may be among an item's best k, with their scores; the entries read by
    sorted access and the documents scored.  Scores below ``bar`` are not wanted, equal ones are."""
    size, start, n = block.size[lists], block.start[lists], len(block.ids)
    offset = np.cumsum(size) - size
    position = np.arange(int(size.sum())) - np.repeat(offset, size)
    seen = np.zeros(len(position), bool)
    met = np.zeros(n, bool)
    docs, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    depth, upto, kth = 0, FIRST_DEPTH, bar
    while len(lists):
        low, high = np.minimum(depth, size), np.minimum(upto, size)
        reached = np.zeros(n, bool)
        reached[block.listed[spans(start + low, high - low)]] = True
        new = np.flatnonzero(reached & ~met)
        met[new] = True
        # Direct accesses: the new documents in every list of the item.
        key = (lists[:, None] * n + new).ravel()
        at = np.minimum(np.searchsorted(block.key, key), len(block.key) - 1)
        hit = block.key[at] == key
        which = np.repeat(np.arange(len(lists)), len(new))
        seen[offset[which[hit]] + block.place[at[hit]]] = True
        docs.append(new)
        scores.append((times[:, None] * np.where(hit, block.impact[at], 0).reshape(len(lists), len(new))).sum(axis=0))
        # The best position of each list, and the bound on documents not met.
        gap = np.minimum.reduceat(np.where(seen, np.repeat(size, size), position), offset)
        there = block.listed_impact[start + np.maximum(gap - 1, 0)]
        bound = int((times * np.where(gap < size, there, 0)).sum())
        if sum(map(len, scores)) >= k:
            found = np.concatenate(scores)
            kth = max(bar, int(np.partition(found, len(found) - k)[len(found) - k]))
            docs, scores = [np.concatenate(docs)], [found]
        if bound < kth or not bound:
            break
        depth, upto = upto, 2 * upto
    doc, score = np.concatenate(docs), np.concatenate(scores)
    kept = (score > 0) & (score >= kth)
    return doc[kept], score[kept], int(np.minimum(upto, size).sum()) if len(lists) else 0, int(met.sum())


class Best:
    """The best k (score, null id, id) of each item so far."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.top: list[list[tuple]] = [[] for _ in range(items)]

    def bar(self, item: int) -> int:
        top = self.top[item]
        return -top[-1][0] if len(top) == self.k else 0

    def add(self, item: int, block: Block, doc: np.ndarray, score: np.ndarray) -> None:
        if len(doc):
            more = zip((-score).tolist(), block.null[doc].tolist(), block.ids[doc].tolist(), strict=True)
            self.top[item] = sorted([*self.top[item], *more])[:self.k]


def _pass(docs: DataFrame, items: list[tuple], k: int) -> DataFrame:
    """Search for the collected items of one pass, (item_id, text) each."""
    spark = docs.sparkSession
    counted = [Counter(terms(t or b"")) for _, t in items]
    vocabulary = sorted(set().union(*counted))
    code = {t: i for i, t in enumerate(vocabulary)}
    wanted = []
    for c in counted:
        at = np.array(sorted(code[t] for t in c), np.int64)
        wanted.append((at, np.array([c[vocabulary[i]] for i in at.tolist()], np.int64)))
    known = spark.sparkContext.broadcast(vocabulary)

    @steady
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = {t: i for i, t in enumerate(known.value)}
        names = [x.split()[0] for x in INDEX.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()),
                 pa.binary(), pa.binary()]

        def packed(block: Builder) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(block.row(), kinds, strict=True)], names)

        block = Builder(code)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                block.add(doc, text.as_py())
                if block.size >= BLOCK_TEXT:
                    yield packed(block)
                    block = Builder(code)
        if block.ids:
            yield packed(block)

    blocks = stored(docs.mapInArrow(index, INDEX), "impact-index")
    sums = blocks.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("total")).first()
    if not sums.n:
        return spark.createDataFrame([], HITS)
    n, total = int(sums.n), int(sums.total)
    pairs = F.explode(F.arrays_zip("terms", "document_counts")).alias("p")
    counts = blocks.select(pairs).groupBy(F.col("p.terms").alias("term")).agg(F.sum("p.document_counts").alias("df"))
    weights = np.zeros(len(vocabulary), np.int64)
    for r in counts.collect():      # at most one row a term of the pass's items
        weights[r.term] = weight(n, int(r.df))
    task = spark.sparkContext.broadcast(([i for i, _ in items], wanted, weights))

    @steady
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item_ids, wanted, weights = task.value
        best = Best(len(wanted), k)
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(batch.slice(i, 1).to_pylist()[0], weights, n, total)
                for j, (want, times) in enumerate(wanted):
                    doc, score, _, _ = best_positions(block, *block.lists(want, times), k, best.bar(j))
                    best.add(j, block, doc, score)
        rows = [(j, item_ids[j], None if null else doc, -score) for j, top in enumerate(best.top)
                for score, null, doc in top]
        item, item_id, doc, score = zip(*rows, strict=True) if rows else ((),) * 4
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(item_id, pa.int64()), pa.array(doc, pa.int64()),
                                          pa.array(score, pa.int64())], ["item", "item_id", "doc_id", "score"])

    return blocks.mapInArrow(search, HITS)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 20, doc_id: str = "doc_id", text: str = "text",
                   item_id: str = "item_id", item_text: str = "text", query_bytes: int = QUERY_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the best k documents of each item with a score above 0, ties by smaller doc_id."""
    spark = docs.sparkSession
    prepare(spark)
    texts = docs.select(F.col(doc_id).cast("long"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")))
    asked = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("binary").alias("text"))
    passes = parts(text_bytes(asked), query_bytes)
    result = spark.createDataFrame([], RESULT)
    for i in range(passes):
        # One pass's share of the items: about query_bytes of text, a stated bound.
        share = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == i) if passes > 1 else asked
        rows = [(r.item_id, bytes(r.text) if r.text is not None else None) for r in share.collect()]
        if not rows:
            continue
        order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        hits = _pass(texts, rows, k).withColumn("part", F.pmod(F.xxhash64("doc_id", "score"), F.lit(MERGE_SALTS)))
        for by in (["item", "part"], ["item"]):
            ranked = Window.partitionBy(*by).orderBy(*order)
            hits = hits.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
        result = result.unionByName(hits.select("item_id", "rank", "doc_id", "score"))
    return result
