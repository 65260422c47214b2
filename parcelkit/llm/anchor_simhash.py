"""SimHash near-dedup by anchor-point covering.

Anchors are the words of a covering code: the 64 bits are three blocks of
22, 21 and 21, each completed with zeros to the perfect binary Golay code of
length 23, whose covering radius is 3.  Two fingerprints within the threshold
have a midpoint at most ``reach = ceil(threshold / 2)`` bits from each, and
the midpoint's anchor lies within covering radius plus ``reach`` of both.  So a
fingerprint is replicated to the anchors of all points of its reach ball (16
at most for a threshold of 2: flips change the anchor only where a block is
already 3 bits off its code word), and fingerprints are compared only where
they share an anchor.  No pair within the threshold is missed.

Equal fingerprints are collapsed to one row first (map-side minimum), so
copies cost nothing however many there are.  Inside an anchor group small
groups are compared by shifted XOR; a large one is linked through shared
midpoints, which is linear in its rows.  Only the links to each local root
leave a task, never the pairs of a group.

Null texts are empty; texts without words have fingerprint zero and link like
any other.  Rows with a null id get a fingerprint; their component is the
smallest id of their group, or null.  Repeated rows give repeated results;
empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelkit.llm.common import U64, parts, prepare, shuffle_partitions, steady, stored
from parcelkit.llm.components import connected_components, local_roots

SEED = 42
GOLAY = 0xC75            # generator polynomial of the [23, 12] code
LENGTH, CHECK = 23, 11
BLOCKS = (22, 21, 21)
SMALL_GROUP = 48
BUCKET_ROWS = 400_000


def fingerprint(text: str, shingle: int) -> int:
    """Bit i is set if it is set in over half of the shingles' hashes."""
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return 0
    width = min(shingle, len(words))
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    end = np.cumsum(size) - 1
    start = end - size + 1
    hashes = [xxhash.xxh64_intdigest(joined[a:b], SEED)
              for a, b in zip(start[:len(words) - width + 1].tolist(), end[width - 1:].tolist(), strict=True)]
    bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int.from_bytes(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(hashes), bitorder="little"), "little")


def fingerprints(docs: DataFrame, shingle: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and fp (the 64 bits as a signed long)."""
    prepare(docs.sparkSession)

    @steady
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], dtype=U64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
            .mapInArrow(run, "doc_id long, fp long"))


def _remainder(v: int) -> int:
    for i in range(LENGTH - 1, CHECK - 1, -1):
        if v >> i & 1:
            v ^= GOLAY << (i - CHECK)
    return v


@lru_cache(maxsize=1)
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the single bits, of all values by low and high part, and each syndrome's nearest error."""
    single = np.array([_remainder(1 << i) for i in range(LENGTH)], dtype=np.int64)
    syndrome = np.zeros(1 << 12, np.int64), np.zeros(1 << 11, np.int64)
    for part, at in ((0, 0), (1, 12)):
        for i in range(12 - part):
            syndrome[part][1 << i:2 << i] = syndrome[part][:1 << i] ^ single[at + i]
    error = np.zeros(1 << CHECK, np.int64)
    bits = range(LENGTH)
    for a in bits:
        error[single[a]] = 1 << a
        for b in range(a):
            error[single[a] ^ single[b]] = 1 << a | 1 << b
            for c in range(b):
                error[single[a] ^ single[b] ^ single[c]] = 1 << a | 1 << b | 1 << c
    return single, np.concatenate(syndrome), error


def anchors(fp: np.ndarray, reach: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of ``fp`` and the anchors they are replicated to, each pair once."""
    single, table, error = _golay()
    points = fp[:, None]
    for _ in range(reach):
        flips = np.concatenate([np.zeros(1, U64), U64(1) << np.arange(64, dtype=U64)])
        points = (points[:, :, None] ^ flips).reshape(len(fp), -1)
    anchor, at = np.zeros(points.shape, U64), 0
    for width in BLOCKS:
        v = (points >> U64(at) & U64((1 << width) - 1)).astype(np.int64)
        syndrome = table[v & 4095] ^ table[4096 + (v >> 12)]
        word = v ^ error[syndrome]
        anchor = anchor << U64(12) | (word >> CHECK).astype(U64)
        at += width
    anchor.sort(axis=1)
    new = np.ones(anchor.shape, bool)
    new[:, 1:] = anchor[:, 1:] != anchor[:, :-1]
    row, column = np.nonzero(new)
    return row, anchor[row, column]


def near_links(anchor: np.ndarray, fp: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that join all fingerprints within ``threshold`` bits in each anchor group."""
    order = np.argsort(anchor, kind="stable")
    key, f = anchor[order], fp[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.append(first, len(key)))
    of = np.repeat(size, size)
    a, b = [], []
    for s in range(1, min(int(size.max(initial=0)), SMALL_GROUP)):
        i = np.flatnonzero((key[s:] == key[:-s]) & (of[s:] <= SMALL_GROUP))
        i = i[np.bitwise_count(f[i] ^ f[i + s]) <= threshold]
        a.append(i)
        b.append(i + s)
    for start, n in zip(first[size > SMALL_GROUP].tolist(), size[size > SMALL_GROUP].tolist(), strict=True):
        x = f[start:start + n]
        if threshold == 2:
            flips = np.concatenate([np.zeros(1, U64), U64(1) << np.arange(64, dtype=U64)])
            z = (x[:, None] ^ flips).ravel()
            who = np.repeat(np.arange(n), 65)
            by = np.argsort(z, kind="stable")
            same = np.flatnonzero(z[by][1:] == z[by][:-1])
            a.append(start + who[by[same]])
            b.append(start + who[by[same + 1]])
        else:
            for i in range(n - 1):
                j = i + 1 + np.flatnonzero(np.bitwise_count(x[i + 1:] ^ x[i]) <= threshold)
                a.append(np.full(len(j), start + i))
                b.append(start + j)
    if not a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return order[np.concatenate(a)], order[np.concatenate(b)]


def links(classes: DataFrame, threshold: int) -> DataFrame:
    """src, dst: links that join the fingerprints ``fp`` within ``threshold`` bits."""
    spark = classes.sparkSession
    reach = (threshold + 1) // 2
    buckets = parts(classes.count() * 16 ** reach, BUCKET_ROWS, shuffle_partitions(spark))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(U64)
            row, anchor = anchors(fp, reach)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.view(np.int64)), pa.array(fp[row].view(np.int64))], names=["anchor", "fp"])

    def join(t: pd.DataFrame) -> pd.DataFrame:
        fp = t["fp"].to_numpy()
        a, b = near_links(t["anchor"].to_numpy().view(U64), fp.view(U64), threshold)
        node, root = local_roots(fp[a], fp[b]) if len(a) else (np.zeros(0, np.int64),) * 2
        return pd.DataFrame({"src": node, "dst": root})

    return (classes.select("fp").mapInArrow(spread, "anchor long, fp long")
            .withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets)).cast("int"))
            .repartition(buckets, "bucket").groupBy("bucket").applyInPandas(join, "src long, dst long"))


def simhash_components(docs: DataFrame, shingle: int = 3, max_bits: int = 2, doc_id: str = "doc_id",
                       text: str = "text") -> DataFrame:
    """doc_id, fingerprint (hex), component_id and kept of every row of ``docs``."""
    fps = stored(fingerprints(docs, shingle, doc_id, text), "fingerprints")
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    found = connected_components(links(classes, max_bits))
    of_class = stored(classes.join(found, classes.fp == found.node, "left").select(
        "fp", "rep", F.coalesce("component", "fp").alias("component")), "classes")
    least = of_class.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_class = of_class.join(least, "component").select("fp", "component_id")
    return (fps.join(of_class, "fp", "left")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
                    F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept")))


def drop_near_copies(docs: DataFrame, shingle: int = 3, max_bits: int = 2, doc_id: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """``docs`` without the rows whose id is not the smallest of their component.  Rows with a null id stay; of an
    id with several texts each row is judged by its own text."""
    rows = simhash_components(docs, shingle, max_bits, doc_id, text).where("doc_id is not null")
    taken = {c.lower() for c in docs.columns}
    id_, some, gone_id, gone_fp, own_fp = (f"_{'x' * max(map(len, taken))}{c}" for c in "abcde")    # longer than any column's name
    ids = (rows.groupBy(F.col("doc_id").alias(id_)).agg(F.bool_or("kept").alias(some), F.bool_and("kept").alias("whole"))
           .where("not whole").select(id_, some))
    gone = rows.where("not kept").select(F.col("doc_id").alias(gone_id), F.col("fingerprint").alias(gone_fp)).distinct()

    @F.pandas_udf("string")
    def hexes(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else f"{fingerprint(t, shingle):016x}")

    own = F.col(doc_id).cast("long")
    left = docs.join(ids, own == F.col(id_), "left").where(F.col(some).isNull() | F.col(some))
    left = left.withColumn(own_fp, hexes(F.when(F.col(some), F.coalesce(text, F.lit("")))))
    # Nearly all rows have no fingerprint here: they match nothing, and are dealt by id, or by text without an id.
    apart = (F.coalesce(own_fp, F.lit("")) == F.col(gone_fp)) & (F.coalesce(own, F.xxhash64(text)) == F.col(gone_id))
    return left.join(gone, apart, "left_anti").select(*docs.columns)
