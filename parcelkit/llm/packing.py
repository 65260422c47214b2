"""Hierarchical multi-length packing.

Each document (its ids, then the end id) is cut into whole windows of the
longest tier and one rest.  The rest is routed to the largest context-size
tier that it fills at least once; what it leaves below the smallest tier is a
short piece.  Every tier is packed by itself: a tier piece is a whole window
of a power of two, so it needs no padding.  Short pieces then fill long
windows end to end, cut where a window is full; the one window that is still
open when a task ends is cut back along the tiers down to ``CLOSE``, so a
task pads less than ``CLOSE`` tokens.  Windows are put in step groups of equal
token budget, tier by tier, so that every step of a group does equal work.

The work is one scan.  A task packs the rows of its own input split and
numbers its windows from its partition id, so a recomputed task gives the
same rows and nothing is gathered anywhere.

Null texts are empty (the end id alone is packed); repeated rows are packed
each; an empty table gives no sequences; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from struct import pack as packed

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from parcelkit.llm.common import prepare, steady
from parcelkit.llm.token_counts import Cache

TIERS = (2048, 1024, 512, 256)
CLOSE = 32               # windows below this are padded instead of cut further
STEP_TOKENS = 16 * 2048  # token budget of a step group
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, tier long, step_group long")


def id_bytes(ids: list[int]) -> bytes:
    return packed(f"<{len(ids)}I", *ids)


_WORKER: dict = {}


def id_cache(path: str) -> Cache:
    """The worker's cache of chunk -> id bytes."""
    if path not in _WORKER:
        _WORKER[path] = Cache(path, id_bytes)
    return _WORKER[path]


def route(n: int, tiers: tuple[int, ...]) -> tuple[list[int], int]:
    """Lengths of a document's tier windows, and of its short piece."""
    out = []
    for t in tiers:
        out += [t] * (n // t)
        n %= t
    return out, n


class Packer:
    """Packs the documents of one task."""

    def __init__(self, task: int, tiers: tuple[int, ...] = TIERS, close: int = CLOSE,
                 step_tokens: int = STEP_TOKENS):
        self.tiers, self.close, self.step_tokens = tuple(sorted(tiers, reverse=True)), close, step_tokens
        self.base, self.made = task << 36, 0
        self.steps: dict[int, list[int]] = {}
        self.groups = 0
        self.open: list[tuple] = []      # short pieces in the open window: (doc, start, data, doc tokens)
        self.fill = 0
        self.rows: list[tuple] = []

    def step(self, tier: int) -> int:
        """A group closes when windows of its tier use up its token budget."""
        now = self.steps.get(tier)
        if now is None or now[1] + tier > self.step_tokens:
            now = self.steps[tier] = [self.base + self.groups, 0]
            self.groups += 1
        now[1] += tier
        return now[0]

    def emit(self, pieces: list[tuple], tier: int) -> None:
        sequence, group, offset = self.base + self.made, self.step(tier), 0
        self.made += 1
        for doc, start, data, total in pieces:
            n = len(data) // 4
            self.rows.append((doc, start, n, zlib.crc32(data), total, sequence, offset, tier, group))
            offset += n

    def add(self, doc: int | None, data: bytes) -> None:
        total = len(data) // 4
        windows, rest = route(total, self.tiers)
        at = 0
        for n in windows:
            self.emit([(doc, at, data[4 * at:4 * (at + n)], total)], n)
            at += n
        longest = self.tiers[0]
        while rest:
            n = min(rest, longest - self.fill)
            self.open.append((doc, at, data[4 * at:4 * (at + n)], total))
            self.fill, at, rest = self.fill + n, at + n, rest - n
            if self.fill == longest:
                self.emit(self.open, longest)
                self.open, self.fill = [], 0

    def finish(self) -> None:
        """Cut the open window back to powers of two; pad below ``close`` only."""
        while self.fill:
            size = 1 << (self.fill.bit_length() - 1)
            if size < self.close:
                size = self.fill
            taken, room = [], size
            while room:
                doc, start, data, total = self.open.pop(0)
                n = min(room, len(data) // 4)
                taken.append((doc, start, data[:4 * n], total))
                if 4 * n < len(data):
                    self.open.insert(0, (doc, start + n, data[4 * n:], total))
                room -= n
            self.fill -= size
            self.emit(taken, size if size >= self.close else self.tiers[0])


def pack(docs: DataFrame, path: str, end_id: int = 1, tiers: tuple[int, ...] = TIERS, close: int = CLOSE,
         step_tokens: int = STEP_TOKENS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: which part of which document lies where in which
    sequence, with the sequence's tier and step group."""
    prepare(docs.sparkSession)

    @steady
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = id_cache(path)
        packer, end = Packer(TaskContext.get().partitionId(), tiers, close, step_tokens), id_bytes([end_id])

        def flush() -> pa.RecordBatch:
            columns = list(zip(*packer.rows, strict=True)) or [()] * 9
            packer.rows = []
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier",
                       "step_group"])

        for batch in batches:
            for doc, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                packer.add(doc, b"".join([*cache.of(t), end]))
            yield flush()
        packer.finish()
        yield flush()

    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
            .mapInArrow(run, SCHEMA))
