"""Exact top-k inner products by pivot-table elimination.

The distances of every vector to some pivots are computed beforehand.  For a
query q and a candidate v the triangle inequality gives
``|q - v| >= max over pivots p of abs(|q - p| - |v - p|)``, and since
``2 <q, v> = |q|^2 + |v|^2 - |q - v|^2`` a lower bound of the distance is an
upper bound of the score.  Candidates are evaluated in the order of that
bound, in growing turns, and a query stops for good once its k-th score
exceeds the next bound: nothing that comes later can enter, ties included.

Candidates are dealt by a hash of their id into groups of about
``GROUP_ROWS``; the queries (a stated subset) are sent to every group as
blocks of ``QUERY_ROWS`` and each (group, query block) is one task's work.
Each keeps its k best per query; the k best of those are the answer.  Pivots
are the ``PIVOTS`` rows with the smallest id hashes, a fixed number.

Components become ``floor(scale * x)`` in double precision.  Vectors that are
null or empty, or hold null or non-finite components, take no part.  Vectors
of different lengths are not compared.  Repeated rows are
candidates each; a query leaves out all rows of its own id; queries of one id
share one answer; a null id takes no part.
Other columns are not read.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelkit.llm.common import parts, prepare

PIVOTS = 16
GROUP_ROWS = 8192
QUERY_ROWS = 2048
TURN = 64                # candidates of a query's first turn; turns double
OUT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def scaled(vectors: DataFrame, scale: int, vec_id: str, vector: str) -> DataFrame:
    """id, v (integral doubles) and dim of the vectors that take part."""
    x = F.col(vector)
    whole = x.isNotNull() & (F.size(x) > 0) & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (vectors.where(F.col(vec_id).isNotNull() & F.coalesce(whole, F.lit(False)))
            .select(F.col(vec_id).cast("long").alias("id"),
                    F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("double")).alias("v"))
            .withColumn("dim", F.size("v")))


def matrix(table: pa.Table) -> np.ndarray:
    return np.asarray(table["v"].combine_chunks().flatten()).reshape(table.num_rows, -1)


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The pivot table: distances of each row to each pivot."""
    return np.stack([np.sqrt(((x - p) ** 2).sum(axis=1)) for p in pivots], axis=1)


def search(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, pivots: np.ndarray,
           k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Query number, row number and score of each query's k best rows, and how many scores were computed.

    Bounds of all queries and rows are rounded up by a relative slack, so they stay bounds in floating point.
    """
    near_q, near_r = distances(queries, pivots), distances(rows, pivots)
    norm_q, norm_r = (queries ** 2).sum(axis=1), (rows ** 2).sum(axis=1)
    out: list[tuple] = []
    computed = 0
    for start in range(0, len(queries), 128):
        s = slice(start, start + 128)
        low = np.zeros((len(queries[s]), len(rows)))
        for p in range(len(pivots)):
            np.maximum(low, np.abs(near_q[s, p, None] - near_r[None, :, p]), out=low)
        total = norm_q[s, None] + norm_r[None, :]
        bound = (total - low * low) / 2 + total * 1e-9 + 1e-6
        bound[query_ids[s, None] == ids[None, :]] = -np.inf
        order = np.argsort(-bound, axis=1, kind="stable")
        for i in range(len(order)):
            q, turn, at = queries[start + i], TURN, 0
            best, found = np.zeros(0, np.int64), np.zeros(0)
            line = bound[i]
            while at < len(rows):
                part = order[i, at:at + turn]
                part = part[line[part] > -np.inf]
                if not len(part):
                    break
                if len(best) == k and found[-1] > line[part[0]]:
                    break
                best, found = np.concatenate([best, part]), np.concatenate([found, rows[part] @ q])
                computed += len(part)
                top = np.lexsort((ids[best], -found))[:k]
                best, found = best[top], found[top]
                at, turn = at + turn, 2 * turn
            out.append((np.full(len(best), start + i), best, found))
    q, r, score = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3
    return q, r, score, computed


def top_k(vectors: DataFrame, k: int = 5, scale: int = 256, every: int = 50, pivots: int = PIVOTS,
          vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k rows with the highest inner products for each row whose id is
    divisible by ``every``, ties to the smaller id."""
    prepare(vectors.sparkSession)
    rows = scaled(vectors, scale, vec_id, vector)
    n, near = rows.count(), {}
    for r in rows.select("dim").distinct().collect():
        first = rows.where(F.col("dim") == r.dim).select("v").orderBy(F.xxhash64("id"), "id").limit(pivots).collect()
        near[r.dim] = np.array([x.v for x in first])
    groups = parts(n, GROUP_ROWS)
    ask = rows.where(F.col("id") % every == 0).distinct()
    blocks = parts(ask.count(), QUERY_ROWS)
    left = rows.withColumn("group", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int"))
    right = (ask.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int"))
             .withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))))
    left = left.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return OUT.empty_table()
        ids, asked = a["id"].to_numpy(), b["id"].to_numpy()
        q, r, score, _ = search(matrix(b), asked, matrix(a), ids, near[a["dim"][0].as_py()], k)
        return pa.table([asked[q], ids[r], score.astype(np.int64)], schema=OUT)

    keys = ("dim", "group", "block")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        run, "query_id long, vec_id long, score long")
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
