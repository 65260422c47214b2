"""Helpers shared by the training-data operators.

Blocks
    Operators that need a text more than once deal the documents into
    blocks by a hash of ``doc_id``.  A block holds about ``BLOCK_BYTES`` of
    text whatever the corpus size, so per-block memory is constant and the
    number of blocks grows with the input.  Blocks talk to key-owning
    buckets through packed binary payloads (sorted numpy arrays), one row
    per (block, bucket): keys are aggregated inside the block before they
    are shuffled, so a key that is present in every document reaches its
    bucket once per block.
"""

from __future__ import annotations

import gc
import math
import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelkit.session import ensure_checkpoint_dir

BLOCK_BYTES = 8 << 20
BUCKET_BYTES = 16 << 20
ARROW_ROWS = 512
U64 = np.uint64

_WS = np.zeros(256, dtype=bool)
_WS[[0x20, *range(0x09, 0x0E)]] = True


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the executors, once per application: their Python finds it wherever
    the driver was started.  The archive is a file of the driver, from which Spark itself distributes it."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp(prefix="parcelkit-")
    archive = os.path.join(folder, f"{root.name}.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, path.relative_to(root.parent))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def prepare(spark: SparkSession) -> None:
    """Make the package known to the executors, and bound the rows of an Arrow batch, so that a batch of
    long texts stays small."""
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: later uses
    neither recompute it nor depend on the executors that made it."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def no_cycle_search():
    """Python's cycle collector is off meanwhile: large caches of strings hold no cycles, but cost it its scans."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def frugal(group):
    """Run a function of one group, then give freed memory back to the system: idle workers stay small."""
    def wrapped(*tables):
        import ctypes

        import pyarrow as pa
        out = group(*tables)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):     # another C library
            pass
        return out
    return wrapped


def steady(run):
    """Run a batch function without cycle searches."""
    def wrapped(batches):
        with no_cycle_search():
            yield from run(batches)
    return wrapped


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Total UTF-8 bytes of a column (one scan, map-side sums)."""
    row = docs.select(F.sum(F.octet_length(F.col(text)).cast("long")).alias("n")).first()
    return int(row.n or 0)


def parts(total: float, each: float, least: int = 1) -> int:
    return max(least, int(math.ceil(total / each)))


def mixed(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64 constants)."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> U64(30))
        h = h * U64(0xBF58476D1CE4E5B9)
        h = h ^ (h >> U64(27))
        h = h * U64(0x94D049BB133111EB)
        return h ^ (h >> U64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit values."""
    with np.errstate(over="ignore"):
        return mixed((np.arange(1, n + 1, dtype=U64) + U64(seed)) * U64(0x9E3779B97F4A7C15))


BYTE_CODE = stream(101, 256)


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of non-white-space bytes."""
    solid = np.concatenate(([False], ~_WS[data], [False]))
    edge = np.flatnonzero(solid[1:] != solid[:-1])
    return edge[0::2], edge[1::2]


HASH_BASE = 0xD1342543DE82EF95
_POWERS = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse modulo 2**64 (kept, and grown as needed)."""
    if len(_POWERS[0]) < n:
        with np.errstate(over="ignore"):
            for i, base in enumerate((HASH_BASE, pow(HASH_BASE, -1, 1 << 64))):
                all_ = np.full(max(n, 2 * len(_POWERS[i])), base, U64)
                all_[0] = 1
                _POWERS[i] = np.multiply.accumulate(all_)
    return _POWERS[0][:n], _POWERS[1][:n]


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: prefix polynomial sums of substituted bytes, taken relative to the word."""
    if not len(start):
        return np.zeros(0, U64)
    up, down = powers(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(BYTE_CODE[data] * up[:-1], dtype=U64)])
        value = (sums[end] - sums[start]) * down[start]
        return mixed(value + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one binary value: their byte lengths, then their bytes."""
    sizes = np.array([len(arrays), *(a.nbytes for a in arrays)], dtype=np.int64)
    return b"".join([sizes.tobytes(), *(a.tobytes() for a in arrays)])


def unpack(data: bytes, *kinds: str) -> list[np.ndarray]:
    sizes = np.frombuffer(data, np.int64, len(kinds) + 1)[1:]
    ends = np.cumsum(sizes) + 8 * (len(kinds) + 1)
    return [np.frombuffer(data[e - s:e], k) for k, s, e in zip(kinds, sizes.tolist(), ends.tolist(), strict=True)]


def split_by(bucket: np.ndarray, buckets: int) -> list[tuple[int, np.ndarray]]:
    """(bucket, index array) of each bucket that occurs, indices in their given order."""
    order = np.argsort(bucket, kind="stable")
    cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
    return [(b, order[cut[b]:cut[b + 1]]) for b in range(buckets) if cut[b + 1] > cut[b]]


def spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices start[0] .. start[0]+size[0]-1, start[1] .. and so on."""
    total = np.cumsum(size)
    return np.arange(int(total[-1]) if len(total) else 0) + np.repeat(start - total + size, size)
