"""Secret scan: fixed patterns, and strings in sensitive context that zstandard cannot predict.

Base spans are the matches of three patterns (``assign``, ``access``, ``hex``),
leftmost and non-overlapping for each kind; too short ones are dropped.  The
method adds ``novel`` spans:

1. *Identifier dictionary.*  All documents are scanned once for words (runs of
   letters, in lower case); those that most documents hold, at most
   ``DICTIONARY_WORDS``, become the content of a zstandard dictionary: all down to a number of
   documents, in bands of about 1/16, so that no ties are cut and no task ranks them.  Tasks count before
   the shuffle; only the dictionary, bounded by ``DICTIONARY_WORDS`` times ``WORD_BYTES``,
   passes through the driver.  Values with digits, signs or capital letters
   never stand in it as they are, however many copies of a document hold them.
2. *Candidates.*  Maximal runs of ``VALUE`` characters with a word of ``SENSITIVE``
   among the ``NEAR`` characters before them.
3. *Novelty.*  A candidate's marginal bytes: the compressed size of its
   surroundings with it, less their size without it, both with the compressor
   primed by the dictionary.  The surroundings are ``AROUND`` characters
   on each side, without other copies of the candidate, so that a secret that
   stands there twice does not predict itself.  A candidate is reported if it costs
   ``LEAST_BYTES`` and ``LEAST_SHARE`` of a byte for each of its bytes, and does not lie
   within a base span.

The scan shuffles nothing but the word counts.  A text is one task's memory.  A
null text is empty and has no spans.  Each row is scanned by itself, repeats and null ids included; an
empty table gives an empty result.  Columns that are not named are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelkit.llm.common import prepare, steady, stored

KINDS = ("assign", "access", "hex", "novel")
DICTIONARY_WORDS = 16_384  # words of the identifier dictionary
WORD_BYTES = 32           # longer words do not enter it
COUNTED = 500_000         # words that a task counts before it passes them on
LEVEL = 9                 # of the compressor
AROUND = 512              # characters of surroundings on each side of a candidate
NEAR = 48                 # characters before a candidate that make its context
LEAST_BYTES = 12
LEAST_SHARE = 0.7

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
# Greedy runs, so a bound on the length drops the same matches as a test afterwards.
ACCESS = re.compile("AKIA[A-Z0-9]{16,}")
HEX = re.compile("[0-9a-f]{24,}")
VALUE = re.compile("[A-Za-z0-9+/_.~-]{12,}={0,2}")
SENSITIVE = re.compile("pass|pwd|secret|token|credential|bearer|authori[sz]ation|signature|session.?id|client.?id"
                       "|(?:api|access|private|signing|encryption|account).?key", re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
SENSITIVE_WORDS = ("pass", "pwd", "secret", "token", "credential", "bearer", "authori", "signature", "session", "client",
                   "key")
SPANS = ("doc_id long, spans array<struct<kind: string, start: int, end: int, bytes: int>>")
_SPAN = [pa.field("kind", pa.string()), pa.field("start", pa.int32()), pa.field("end", pa.int32()),
         pa.field("bytes", pa.int32())]

# Bands of counts, about 1/16 wide (their bit length and first five bits): some 2,000 whatever the corpus.
BAND = "length(bin(n)) * 32 + shiftright(n, greatest(length(bin(n)) - 5, 0))"
_LETTERS = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256)).lower()


def identifier_words(docs: DataFrame, words: int = DICTIONARY_WORDS, text: str = "text") -> list[bytes]:
    """Words of five bytes and more that most documents hold, the commonest last."""

    @steady
    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def counts() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
                                              names=["word", "n"])

        for batch in batches:
            for t in batch.column(0):
                seen.update(w for w in set(t.as_py().translate(_LETTERS).split()) if 5 <= len(w) <= WORD_BYTES)
                if len(seen) > COUNTED:
                    yield counts()
                    seen.clear()
        yield counts()

    counts = stored(docs.select(F.col(text).cast("binary").alias("text")).filter("text is not null")
                    .mapInArrow(held, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
                    .withColumn("band", F.expr(BAND)), "word-counts")
    # The lowest band that leaves at most ``words``: a band more would be too many.
    sizes, total, lowest = counts.groupBy("band").count().collect(), 0, 1 << 20
    for r in sorted(sizes, reverse=True):
        total += r["count"]
        if total > words:
            break
        lowest = r.band
    found = counts.filter(F.col("band") >= lowest).select("n", "word").collect()
    return [w for _, w in sorted(((r.n, bytes(r.word)) for r in found), key=lambda x: (x[0], x[1]))]


class Novelty:
    """Marginal compressed bytes with a dictionary of words."""

    def __init__(self, words: list[bytes]):
        import zstandard
        content = b" ".join(words)
        primed = None
        if len(content) >= 8:           # the least that the library takes
            primed = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            primed.precompute_compress(level=LEVEL)
        self.compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=primed, write_content_size=False,
                                                 write_checksum=False, write_dict_id=False).compress

    def cost(self, text: str, start: int, end: int) -> int:
        value = text[start:end]
        before = text[max(0, start - AROUND):start].replace(value, "")
        after = text[end:end + AROUND].replace(value, "")
        return len(self.compress((before + value + after).encode())) - len(self.compress((before + after).encode()))


def base_spans(text: str, low: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns' matches; ``low`` is the text in lower case."""
    out = []
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return out


def candidates(text: str, low: str) -> list[tuple[int, int]]:
    """Values with a sensitive word shortly before them."""
    if not any(w in low for w in SENSITIVE_WORDS):
        return []
    return [m.span() for m in VALUE.finditer(text) if SENSITIVE.search(text, max(0, m.start() - NEAR), m.start())]


def scan_text(text: str, novelty: Novelty) -> list[tuple[str, int, int, int | None]]:
    """All spans (kind, start, end, marginal bytes of novel ones) by start, then kind; code points, end exclusive."""
    low = text.lower()
    base = base_spans(text, low)
    found = [(s, k, e, None) for s, k, e in base]
    base.sort()
    starts, reach = [s for s, _, _ in base], list(accumulate((e for _, _, e in base), max))
    for s, e in candidates(text, low):
        before = bisect_right(starts, s)
        if before and e <= reach[before - 1]:
            continue
        cost = novelty.cost(text, s, e)
        if cost >= max(LEAST_BYTES, LEAST_SHARE * (e - s)):
            found.append((s, 3, e, cost))
    return [(KINDS[k], s, e, c) for s, k, e, c in sorted(found, key=lambda x: x[:3])]


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the spans of every row."""
    spark = docs.sparkSession
    prepare(spark)
    words = spark.sparkContext.broadcast(identifier_words(docs, text=text))

    @steady
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(words.value)
        for batch in batches:
            found = [scan_text(t, novelty) for t in batch.column(1).to_pylist()]
            cut = [0]
            for x in found:
                cut.append(cut[-1] + len(x))
            flat = [y for x in found for y in x]
            parts = [pa.array([y[j] for y in flat], f.type) for j, f in enumerate(_SPAN)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(cut, pa.int32()),
                                                           pa.StructArray.from_arrays(parts, fields=_SPAN))],
                names=["doc_id", "spans"])

    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
            .mapInArrow(run, SPANS))


def digests(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans as text."""

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "novel")
    return found.select("doc_id", *map(number, KINDS[:3]), F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"), number("novel"))
