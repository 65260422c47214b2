"""Toxicity by a subsequence string kernel, Nystroem landmarks and a linear SVM.

Kernel
    Two words compare by the subsequences of three letters that they share,
    each letter up to ``GAP`` places after the one before, an occurrence
    weighing ``DECAY`` to the power of its span.  An inserted, dropped or
    doubled letter so only damps the shared subsequences (``idxiot``).
    Punctuation inside a word is dropped and runs of three or more single
    letters are joined (``i.d.i.o.t``, ``i d i o t``).  Occurrences are scaled
    by the word's own weight, a function of its length alone, which keeps the
    kernel positive definite; its ``POWER`` is the word kernel.
Sentences and documents
    A sentence's similarity to a landmark is that of its closest word, a
    document's that of its closest sentence (the multiple-instance maximum);
    similarities below ``FLOOR`` count as none, above 1 as 1.  An upper bound from one table lookup per
    subsequence drops the words that reach no landmark; it is exact.
Training
    Labels come only from rows whose crc32 of the id leaves a remainder other
    than 0 modulo 5, at most ``TRAIN_DOCS`` of them in hash order.  Landmarks
    are the words whose document frequencies differ most between the classes.
    Similarities are whitened by the landmarks' own kernel matrix, and a
    squared-hinge linear SVM with a logistic link is fitted on that bounded
    sample.  Scoring is one scan of all documents.

Null and empty texts are scored like a text without words.  Rows with a null
id are held out.  With no label, or one class only, the score is the toxic
share of the training rows (0 if none).  Repeated labels of an id count once,
toxic if any is.  Repeated rows are scored each; columns but id and text are
never read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from parcelkit.llm.common import prepare, steady, stored

GAP = 3                 # places from one letter of a subsequence to the next, at most
DECAY = 0.7
FLOOR = 0.4             # similarities below this count as none
LANDMARKS = 256
POWER = 3               # the word kernel is this power of the scaled subsequence kernel
TRAIN_DOCS = 20_000     # labelled rows that are learned from, at most
LEAST_DOCS = 2          # toxic documents a landmark is found in, at least
PENALTY = 0.01
CACHE = 300_000         # words in a worker's cache
LEARN_WORDS = 1 << 15   # words that are looked up in the landmarks' table at a time
TURN_WORDS = 1024       # words whose similarities are computed at a time
TABLE_BITS = 7          # letter codes up to this size find their triples in a table
LONG_WORD = 64          # longer words are compared in overlapping windows of this length
STEPS = [(a, b, DECAY ** (a + b + 1)) for a in range(1, GAP + 1) for b in range(1, GAP + 1)]


def words_of(text: str) -> set[str]:
    """Distinct words, and the words that runs of single letters spell."""
    words = text.lower().split()
    out = set(words)
    singles = bytes([len(w) == 1 for w in words])
    if b"\1\1\1" in singles:
        at = singles.find(b"\1\1\1")
        while at >= 0:
            end = singles.find(b"\0", at)
            end = len(words) if end < 0 else end
            out.add("".join(words[at:end]))
            at = singles.find(b"\1\1\1", end)
    return out


def letters(word: str) -> str:
    return word if word.isalnum() else "".join(filter(str.isalnum, word))


def weight(n: np.ndarray) -> np.ndarray:
    """Norm of a word of n letters."""
    return np.sqrt(sum(np.maximum(0, n - a - b) * d * d for a, b, d in STEPS))


def occurrences(words: list[str], code: dict[str, int], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each step pair: word numbers, codes of the letter triple, weight of the span."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    get = code.get
    flat = np.fromiter((get(c, 0) for w in words for c in w), np.int64, int(size.sum()))
    of = np.repeat(np.arange(len(words)), size)
    for a, b, d in STEPS:
        n = len(flat) - a - b
        if n <= 0:
            continue
        i = np.flatnonzero((of[:n] == of[a + b:]) & (flat[:n] > 0) & (flat[a:a + n] > 0) & (flat[a + b:] > 0))
        yield of[i], flat[i] << 2 * bits | flat[i + a] << bits | flat[i + a + b], d


@dataclass
class Landmarks:
    """Landmark words as rows of a triple -> weight table; triples of no landmark share an empty row."""

    words: list[str]
    code: dict[str, int] = field(init=False)
    bits: int = field(init=False)               # of a letter's code: every letter of the landmarks has one
    keys: np.ndarray = field(init=False)
    row_of: np.ndarray | None = field(init=False)
    rows: np.ndarray = field(init=False)
    best: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.code = {c: i + 1 for i, c in enumerate(sorted({c for w in self.words for c in w}))}
        self.bits = len(self.code).bit_length()
        found = list(occurrences(self.words, self.code, self.bits))
        keys = self.keys = np.unique(np.concatenate([k for _, k, _ in found])) if found else np.zeros(0, np.int64)
        self.row_of = None
        if self.bits <= TABLE_BITS:
            self.row_of = np.zeros(1 << 3 * self.bits, np.int64)
            self.row_of[keys] = np.arange(1, len(keys) + 1)
        self.rows = np.zeros((len(keys) + 1, len(self.words)))
        own = weight(np.array([len(w) for w in self.words]))
        for of, k, d in found:
            np.add.at(self.rows, (self.row(k), of), d / own[of])
        self.best = self.rows.max(axis=1, initial=0)
        self.rows = self.rows.astype(np.float32)

    def row(self, k: np.ndarray) -> np.ndarray:
        """Rows of triples, 0 for those of no landmark: a table for small alphabets, else a binary search."""
        if self.row_of is not None:
            return self.row_of[k]
        if not len(self.keys):
            return np.zeros(len(k), np.int64)
        i = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
        return np.where(self.keys[i] == k, i + 1, 0)

    def similar(self, words: list[str], floor: float) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words that may reach ``floor``, and their similarities to the landmarks."""
        own = weight(np.fromiter(map(len, words), np.int64, len(words)))
        bound = np.zeros(len(words))
        kept = []
        for of, k, d in occurrences(words, self.code, self.bits):
            row = self.row(k)
            hit = np.flatnonzero(row)
            of, row = of[hit], row[hit]
            bound += np.bincount(of, self.best[row] * d, len(words))
            kept.append((of, row, d))
        near = np.flatnonzero((own > 0) & (bound >= floor * own))
        place = np.full(len(words), -1)
        place[near] = np.arange(len(near))
        at = np.concatenate([place[of] for of, _, _ in kept]) if kept else place[:0]
        row = np.concatenate([r for _, r, _ in kept]) if kept else place[:0]
        d = np.concatenate([np.full(len(r), x) for _, r, x in kept]) if kept else np.zeros(0)
        order = np.argsort(at, kind="stable")
        at, row, d = at[order], row[order], d[order]
        width, out = len(self.rows), np.zeros((len(near), len(self.words)), np.float32)
        for start in range(0, len(near), TURN_WORDS):
            stop = min(start + TURN_WORDS, len(near))
            i, j = np.searchsorted(at, [start, stop])
            counts = np.bincount((at[i:j] - start) * width + row[i:j], d[i:j], (stop - start) * width)
            out[start:stop] = counts.reshape(-1, width).astype(np.float32) @ self.rows
        return near, out / own[near][:, None].astype(np.float32)


class Scorer:
    """Closest-word similarities of texts, with a bounded cache of words."""

    def __init__(self, landmarks: Landmarks):
        self.landmarks = landmarks
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.used, self.rows = 0, np.zeros((1024, len(self.landmarks.words)), np.float32)

    def learn(self, words: list[str]) -> None:
        """Place of each word's row, -1 for a word that reaches no landmark."""
        place, parts = self.place, {}
        for w in words:
            s = letters(w)
            parts[w] = [s] if len(s) <= LONG_WORD else [
                s[a:a + LONG_WORD] for a in range(0, len(s) - LONG_WORD // 2, LONG_WORD // 2)]
        fresh = list({p for ps in parts.values() for p in ps if p not in place})
        for start in range(0, len(fresh), LEARN_WORDS):
            some = fresh[start:start + LEARN_WORDS]
            near, sims = self.landmarks.similar(some, FLOOR)
            kept = np.flatnonzero(sims.max(axis=1, initial=0) >= FLOOR)
            self.grow(len(kept))
            place.update(dict.fromkeys(some, -1))
            place.update(zip([some[i] for i in near[kept].tolist()], range(self.used, self.used + len(kept)), strict=True))
            sims = sims[kept]
            self.rows[self.used:self.used + len(kept)] = np.where(sims >= FLOOR, sims, 0)
            self.used += len(kept)
        for w, ps in parts.items():
            at = {place[p] for p in ps} - {-1}
            if len(at) > 1:
                self.grow(1)
                self.rows[self.used] = self.rows[list(at)].max(axis=0)
                at = {self.used}
                self.used += 1
            place[w] = at.pop() if at else -1

    def grow(self, more: int) -> None:
        while self.used + more > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])

    def turns(self, texts: list[str]) -> Iterator[list[tuple[int, set[str]]]]:
        """Words of the texts by number, in turns of at most CACHE words; a text of more words is in several."""
        turn, held = [], 0
        for i, t in enumerate(texts):
            words = words_of(t)
            cuts = [words]
            if len(words) > CACHE:
                every = list(words)
                cuts = [set(every[a:a + CACHE]) for a in range(0, len(every), CACHE)]
            for s in cuts:
                if turn and (len(turn) == 64 or held + len(s) > CACHE):
                    yield turn
                    turn, held = [], 0
                turn.append((i, s))
                held += len(s)
        if turn:
            yield turn

    def features(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.landmarks.words)))
        for turn in self.turns(texts):
            every = set().union(*(s for _, s in turn))
            lost = every.difference(self.place)
            if lost and len(self.place) + len(lost) > CACHE:
                self.clear()
                lost = every
            if lost:
                self.learn(list(lost))
            get = self.place.get
            for i, s in turn:
                at = set(map(get, s))
                at.discard(-1)
                if at:
                    out[i] = np.maximum(out[i], self.rows[list(at)].max(axis=0))
        return np.minimum(out, 1) ** POWER


@dataclass
class Model:
    landmarks: Landmarks
    coef: np.ndarray
    bias: float
    slope: float
    shift: float
    constant: float | None = None

    def score(self, features: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(features), self.constant)
        margin = features @ self.coef + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -60, 60)))


def remainder(doc_id: str, k: int):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % k


def _landmark_words(train: DataFrame, toxic: int, clean: int, m: int) -> list[str]:
    """The m words with the largest contrast of document frequencies between the classes."""

    @steady
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[y].update({s for w in words_of(t) if 3 <= len(s := letters(w)) <= LONG_WORD})
            words = list(seen[0] | seen[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array([seen[1][w] for w in words], pa.int64()),
                 pa.array([seen[0][w] for w in words], pa.int64())], names=["word", "t", "c"])

    t, c = (F.col("t") + 0.5) / (toxic + 1), (F.col("c") + 0.5) / (clean + 1)
    rows = (train.select("text", "toxic").mapInArrow(count, "word string, t long, c long")
            .groupBy("word").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
            .where(F.col("t") >= LEAST_DOCS).select("word", (F.col("t") * F.log(t / c)).alias("s"))
            .where("s > 0").orderBy(F.desc("s"), "word").limit(m).collect())
    return [r.word for r in rows]


def _svm(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared-hinge linear SVM by Newton steps; classes weigh alike; the last coefficient is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    share = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y < 0).sum())
    ridge = np.full(x.shape[1], PENALTY)
    ridge[-1] = 1e-6
    w = np.zeros(x.shape[1])

    def loss(v):
        return 0.5 * (ridge * v * v).sum() + (share * np.maximum(0, 1 - y * (x @ v)) ** 2).sum()

    for _ in range(60):
        slack = 1 - y * (x @ w)
        on = slack > 0
        grad = ridge * w - 2 * x[on].T @ (share[on] * y[on] * slack[on])
        step = np.linalg.solve(np.diag(ridge) + 2 * (x[on] * share[on][:, None]).T @ x[on], grad)
        rate, now = 1.0, loss(w)
        while rate > 1e-4 and loss(w - rate * step) > now:
            rate /= 2
        w = w - rate * step
        if np.abs(rate * step).max() < 1e-8:
            break
    return w


def _link(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic link, on smoothed targets."""
    n1, n0 = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margin, np.ones(len(margin))], axis=1)
    v = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        grad = x.T @ (p - target) + 1e-6 * v
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-6 * np.eye(2), grad)
        v = v - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(v[0]), float(v[1])


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, train_docs: int = TRAIN_DOCS, m: int = LANDMARKS,
          doc_id: str = "doc_id", text: str = "text") -> Model:
    """Fit on the labelled documents whose id's remainder is not 0."""
    prepare(docs.sparkSession)
    chosen = (labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
              .where("id is not null and toxic in (0, 1)").where(remainder("id", folds) != 0)
              .groupBy("id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("id"), "id").limit(train_docs))
    texts = (docs.where(F.col(doc_id).isNotNull())
             .select(F.col(doc_id).cast("long").alias("id"), F.coalesce(text, F.lit("")).alias("text")))
    rows = stored(texts.join(F.broadcast(chosen), "id").select("id", "text", "toxic"), "toxic-train")
    counts = dict(rows.groupBy("toxic").count().collect())
    toxic, clean = counts.get(1, 0), counts.get(0, 0)
    words = _landmark_words(rows, toxic, clean, m) if toxic and clean else []
    landmarks = Landmarks(words)
    if not words:
        return Model(landmarks, np.zeros(0), 0.0, 0.0, 0.0, toxic / (toxic + clean) if toxic + clean else 0.0)

    @steady
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(landmarks)
        for batch in batches:
            x = scorer.features(batch.column(0).to_pylist()).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.tobytes() for r in x], pa.binary()), batch.column(1), batch.column(2)],
                names=["x", "toxic", "id"])

    got: list[Row] = rows.select("text", "toxic", "id").mapInArrow(
        features, "x binary, toxic int, id long").orderBy("id").collect()
    x = np.stack([np.frombuffer(r.x, np.float32) for r in got]).astype(float)
    y = np.array([1.0 if r.toxic else -1.0 for r in got])
    gram = np.minimum(landmarks.similar(words, 0.0)[1].astype(float), 1) ** POWER
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    whiten = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 0.05))) @ vectors.T
    w = _svm(x @ whiten, y)
    coef, bias = whiten @ w[:-1], float(w[-1])
    return Model(landmarks, coef, bias, *_link(x @ coef + bias, y))


def score(docs: DataFrame, model: Model, folds: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``."""
    prepare(docs.sparkSession)

    @steady
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.landmarks)
        for batch in batches:
            s = model.score(scorer.features(batch.column(2).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), (remainder(doc_id, folds) == 0).alias("held_out"),
                        F.coalesce(text, F.lit("")).alias("text"))
            .mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int"))


def drop_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores below 0.5."""
    prepare(docs.sparkSession)
    at = docs.columns.index(text)

    @steady
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.landmarks)
        for batch in batches:
            s = model.score(scorer.features([t or "" for t in batch.column(at).to_pylist()]))
            yield batch.filter(pa.array(s < 0.5))

    return docs.mapInArrow(run, docs.schema)
