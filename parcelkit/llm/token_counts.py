"""Token counts by map-side two-tier lookup.

Tier one is a compact table of the token counts of frequent pre-tokens
(white-space chunks), fitted on a bounded sample of documents and broadcast
(at most ``FREQUENT`` entries).  Tier two is a bounded cache in each Python
worker that encodes what tier one misses with the tokenizer itself.  Nothing
is shuffled: the job is one scan, and the sample only decides which tier
answers, never the answer.

A chunk may be looked up on its own because the tokenizer drops white space:
no normaliser step or split pattern of it reaches across a blank, tab or line
break.  Other white space stays inside a chunk and is left to the tokenizer.
For a sentencepiece model, whose pieces span blanks, whole texts are encoded.

Null texts count as empty; repeated rows are counted each; an empty table
gives an empty result.  Columns of the input other than the id and text are
not read, so clashing names do no harm.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelkit.llm.common import prepare, steady

SAMPLE_DOCS = 512       # documents that tier one is fitted on
FREQUENT = 32_768       # entries of the broadcast table
CACHE = 400_000         # entries of one generation of a worker's cache
LONG_CHUNK = 256        # chunks of more characters are not cached

_WORKER: dict = {}
# Latin letters whose case, normal form and class every Unicode version agrees on.
_LATIN = "a-z\u00df-\u00f6\u00f8-\u00ff"
_PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch
_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LATIN}]+|[0-9]|[^{_LATIN}0-9]+").findall
_MARKS_MEET = re.compile(f"[^{_LATIN}0-9\\s][.,] ").search


def chunks(text: str, fold: bool = True) -> list[str]:
    """White-space chunks.  With ``fold``, those of a Latin text are put in lower case, and a full stop or
    comma at a word's end becomes a chunk of its own, unless another mark touches it somewhere in the text:
    neither changes a token, and fewer chunks differ."""
    text = text.replace("\n", " ").replace("\t", " ").replace("\r", " ")
    if fold and "<" not in text:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            pass
        else:
            low = text.lower()
            text = low if _MARKS_MEET(low) else low.replace(". ", " . ").replace(", ", " , ")
    return [c for c in text.split(" ") if c]


def tokenizer(path: str):
    """The tokenizer at ``path``, loaded once per worker, single-threaded."""
    key = ("tokenizer", path)
    if key not in _WORKER:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        _WORKER[key] = Tokenizer.from_file(path)
    return _WORKER[key]


def piece_model(path: str):
    key = ("pieces", path)
    if key not in _WORKER:
        import sentencepiece
        _WORKER[key] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _WORKER[key]


@lru_cache(maxsize=1)
def byte_letters() -> dict[int, str]:
    """Printable stand-ins of the bytes in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class ChunkEncoder:
    """Ids of chunks.  A chunk of plain Latin text is split into its pre-tokens,
    which the model merges one by one; all others, and those that may hold a special string, go through the whole tokenizer.
    ``split`` says whether the file's steps are the ones that the split assumes."""

    def __init__(self, path: str):
        self.tokenizer = tokenizer(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = json.dumps([spec["normalizer"], spec["pre_tokenizer"]["pretokenizers"]])
        self.split = (all(x in steps for x in ("NFC", "Lowercase", "ByteLevel", "'s|'t|'re|'ve|'m|'ll|'d|"))
                      and all("<" in x["content"] for x in spec["added_tokens"]))
    def piece(self, p: str) -> list[int]:
        shown = p if p.isascii() else p.encode().decode("latin-1").translate(byte_letters())
        return [t.id for t in self.tokenizer.model.tokenize(shown)]

    def encode(self, items: list[str]) -> list[list[int]]:
        out: list = [None] * len(items)
        hard, piece = [], self.piece
        for i, w in enumerate(items):
            if self.split and "<" not in w and _PLAIN(w):
                low = w.lower()
                out[i] = piece(low) if low.isalpha() else [x for p in _SPLIT(low) for x in piece(p)]
            else:
                hard.append(i)
        if hard:
            found = self.tokenizer.encode_batch_fast([items[i] for i in hard], add_special_tokens=False)
            for i, e in zip(hard, found, strict=True):
                out[i] = e.ids
        return out


def chunk_encoder(path: str) -> ChunkEncoder:
    key = ("chunks", path)
    if key not in _WORKER:
        _WORKER[key] = ChunkEncoder(path)
    return _WORKER[key]


class Cache:
    """chunk -> value.  ``tier`` is never dropped; the rest lives in two
    generations of at most ``CACHE`` chunks, so what recurs stays."""

    def __init__(self, path: str, value, tier: dict | None = None):
        self.path, self.value, self.tier = path, value, tier or {}
        self.fold = chunk_encoder(path).split
        self.new, self.old = dict(self.tier), {}

    def of(self, text: str) -> list:
        words = chunks(text, self.fold)
        out = list(map(self.new.get, words))
        if None in out:
            lost = dict.fromkeys(w for w, v in zip(words, out, strict=True) if v is None)
            old = self.old
            found = {w: old[w] for w in lost if w in old}
            missed = [w for w in lost if w not in found]
            found.update(zip(missed, map(self.value, chunk_encoder(self.path).encode(missed)), strict=True))
            out = [found[w] if v is None else v for w, v in zip(words, out, strict=True)]
            if len(self.new) + len(found) > len(self.tier) + CACHE:
                self.old, self.new = self.new, dict(self.tier)
            self.new.update((w, v) for w, v in found.items() if len(w) <= LONG_CHUNK)
        return out


def length_cache(path: str, words: bytes, counts: bytes) -> Cache:
    """The worker's two tiers for a broadcast table; built once."""
    key = ("lengths", path, hash(words))
    if key not in _WORKER:
        tier = dict(zip(words.decode().split("\n"), counts, strict=True)) if counts else {}
        _WORKER[key] = Cache(path, len, tier)
    return _WORKER[key]


def frequent_table(docs: DataFrame, path: str, text: str = "text", sample_docs: int = SAMPLE_DOCS,
                   size: int = FREQUENT) -> tuple[bytes, bytes]:
    """The compact table: frequent chunks of the first documents that the scan
    yields, joined by line breaks, and one byte of token count for each
    (chunks of over 255 tokens are left to tier two)."""
    seen: Counter = Counter()
    for row in docs.select(F.coalesce(text, F.lit("")).alias("text")).limit(sample_docs).collect():
        seen.update(chunks(row.text, chunk_encoder(path).split))
    words = [w for w, _ in seen.most_common(size) if len(w) <= LONG_CHUNK]
    kept = [(w, len(x)) for w, x in zip(words, chunk_encoder(path).encode(words), strict=True) if len(x) < 256]
    return "\n".join(w for w, _ in kept).encode(), bytes(n for _, n in kept)


def token_counts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
                 limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs``."""
    spark = docs.sparkSession
    prepare(spark)
    pieces = path.endswith(".model")
    near = spark.sparkContext.broadcast(None if pieces else frequent_table(docs, path, text))

    @steady
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            if pieces:
                model = piece_model(path)
                n = [len(model.encode(t)) for t in texts]
            else:
                cache = length_cache(path, *near.value)
                n = [sum(cache.of(t)) for t in texts]
            size = [len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(n, pa.int64()),
                 pa.array(np.asarray(n, dtype=np.int64) > limit, pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
            .mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"))
