"""Near-duplicate vectors by robust-pruned flat graphs on overlapping shards.

1. Equal vectors of a label collapse to one class (map-side aggregate).
2. Cell centres are a bounded hash sample of the classes, thinned out where
   they crowd; every class joins
   the ``OVERLAP`` nearest cells of its label.  A cell of more than
   ``SHARD_ROWS`` classes is split by hash into blocks, and every pair of its
   blocks is a shard, so a shard is bounded and no pair of a cell is lost.
3. Each shard builds a flat graph: nearest candidates, robust pruning (a
   candidate is dropped when a kept neighbour is closer to it by the factor
   ``ALPHA``), reverse edges, and a few long edges.
4. The adjacency lists of a class from all its shards are united.
5. Each shard runs, for its rows, a greedy beam search on the united lists
   from the shard's medoid and the row's own node, and then expands the range:
   all nodes within ``SLACK`` of the threshold are expanded until none is new.
   What is found is verified by the cosine in double precision.
6. A pair that two shards hold counts in one of them only (the smallest common
   cell).  Only counts and the links to each local root leave a shard.

``audit_recall`` measures the share of true links that were found, by brute
force over a stated set of rows.

Vectors of different length or label are not compared.  Null, empty and zero
vectors, those with null or non-finite components, and those without a label
link with nothing.  Rows repeated with one id are vectors each.  A null id
gives a row without links.  Other columns are not read; an empty table gives
an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelkit.llm.common import prepare, stored
from parcelkit.llm.components import connected_components, local_roots

CELL_ROWS = 640          # classes per cell, about
MAX_CENTRES = 4096
APART = 0.7               # centres of a label are less alike than this, so a dense group has one cell
OVERLAP = 2
SHARD_ROWS = 3072         # a larger cell is split into blocks of half of this
DEGREE = 16
CANDIDATES = 48
LONG_EDGES = 2
ALPHA = 1.2
BEAM = 16
SLACK = 0.03
TURN = 128                # queries that are searched at a time

GRAPH = pa.schema([("rep", pa.int64()), ("near", pa.list_(pa.int64()))])
FOUND = pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def unit(x: np.ndarray) -> np.ndarray:
    peak = np.abs(x).max(axis=1, keepdims=True)     # keeps the squares of very large or small values finite
    x = x / peak
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(t: pa.Table) -> np.ndarray:
    return np.asarray(t["v"].combine_chunks().flatten(), dtype=np.float64).reshape(t.num_rows, -1)


def build(x: np.ndarray) -> list[np.ndarray]:
    """Adjacency lists of a shard's graph."""
    n = len(x)
    sims = (x @ x.T).astype(np.float32)
    np.fill_diagonal(sims, -2)
    width = min(CANDIDATES, n - 1)
    if width < 1:
        return [np.zeros(0, np.int64)] * n
    near = np.argpartition(-sims, width - 1, axis=1)[:, :width]
    line = np.take_along_axis(sims, near, axis=1)
    by = np.argsort(-line, axis=1, kind="stable")
    near, line = np.take_along_axis(near, by, axis=1), np.take_along_axis(line, by, axis=1)
    far = np.sqrt(np.maximum(0, 2 - 2 * line))
    alive = np.ones(near.shape, bool)
    kept = np.zeros(near.shape, bool)
    row = np.arange(n)
    for _ in range(DEGREE):
        pick = alive.argmax(axis=1)
        on = alive[row, pick]
        if not on.any():
            break
        kept[row[on], pick[on]] = True
        node = near[row, pick]
        between = np.sqrt(np.maximum(0, 2 - 2 * sims[node[:, None], near]))
        alive &= ~(ALPHA * between <= far) | ~on[:, None]
        alive[row, pick] = False
    a, c = np.nonzero(kept)
    b = near[a, c]
    spread = (np.arange(n)[:, None] * 7919 + 104729 * np.arange(1, LONG_EDGES + 1)) % n
    src = np.concatenate([a, b, np.repeat(np.arange(n), LONG_EDGES)])
    dst = np.concatenate([b, a, spread.ravel()])
    edge = np.unique(src[src != dst] * n + dst[src != dst])
    src, dst = edge // n, edge % n
    return np.split(dst, np.searchsorted(src, np.arange(1, n)))


def padded(lists: list[np.ndarray]) -> np.ndarray:
    width = max((len(x) for x in lists), default=0)
    out = np.full((len(lists), max(width, 1)), -1)
    for i, x in enumerate(lists):
        out[i, :len(x)] = x
    return out


def range_search(x: np.ndarray, graph: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row, other row) of cosine at least ``threshold`` that the searches of all rows find."""
    n, low = len(x), threshold - SLACK
    medoid = int((x @ x.mean(axis=0)).argmax())
    found_q, found_v = [], []
    for start in range(0, n, TURN):
        q = np.arange(start, min(start + TURN, n))
        own = np.arange(len(q))
        seen = np.zeros((len(q), n), bool)
        beam = np.full((len(q), BEAM), -1)
        sims = np.full((len(q), BEAM), -np.inf)
        done = np.ones((len(q), BEAM), bool)
        beam[:, 0], beam[:, 1] = medoid, q
        sims[:, 0], sims[:, 1] = x[q] @ x[medoid], 1.0
        done[:, :2] = False
        done[q == medoid, 0] = True
        seen[:, medoid] = True
        seen[own, q] = True
        hits = [(own[sims[:, 0] >= low], np.full((sims[:, 0] >= low).sum(), medoid)), (own, q)]
        while True:
            line = np.where(done, -np.inf, sims)
            pick = line.argmax(axis=1)
            on = np.flatnonzero(line[own, pick] > -np.inf)
            if not len(on):
                break
            done[on, pick[on]] = True
            near = graph[beam[on, pick[on]]]
            fresh = (near >= 0) & ~seen[on[:, None], near]
            i, j = np.nonzero(fresh)
            node = near[i, j]
            seen[on[i], node] = True
            value = np.full(near.shape, -np.inf)
            value[i, j] = np.einsum("ij,ij->i", x[q[on[i]]], x[node])
            hot = value[i, j] >= low
            hits.append((on[i[hot]], node[hot]))
            both = np.concatenate([sims[on], value], axis=1)
            ids = np.concatenate([beam[on], near], axis=1)
            ended = np.concatenate([done[on], np.zeros(near.shape, bool)], axis=1)
            top = np.argpartition(-both, BEAM - 1, axis=1)[:, :BEAM]
            beam[on], sims[on], done[on] = (np.take_along_axis(z, top, axis=1) for z in (ids, both, ended))
            done[on] |= sims[on] == -np.inf
        front_q, front_v = (np.concatenate(z) for z in zip(*hits, strict=True))
        while len(front_q):
            found_q.append(q[front_q])
            found_v.append(front_v)
            next_q, next_v = [], []
            for a in range(0, len(front_q), 1 << 15):
                fq, near = front_q[a:a + (1 << 15)], graph[front_v[a:a + (1 << 15)]]
                i, j = np.nonzero((near >= 0) & ~seen[fq[:, None], near])
                pair = np.unique(fq[i] * n + near[i, j])
                pq, pv = pair // n, pair % n
                seen[pq, pv] = True
                for b in range(0, len(pq), 1 << 15):
                    s = slice(b, b + (1 << 15))
                    ok = np.einsum("ij,ij->i", x[q[pq[s]]], x[pv[s]]) >= low
                    next_q.append(pq[s][ok])
                    next_v.append(pv[s][ok])
            front_q = np.concatenate(next_q) if next_q else front_q[:0]
            front_v = np.concatenate(next_v) if next_v else front_v[:0]
    a, b = np.concatenate(found_q), np.concatenate(found_v)
    pair = np.unique(np.minimum(a, b) * n + np.maximum(a, b))
    a, b = pair // n, pair % n
    a, b = a[a != b], b[a != b]
    ok = np.zeros(len(a), bool)
    for s in range(0, len(a), 1 << 15):
        t = slice(s, s + (1 << 15))
        ok[t] = np.einsum("ij,ij->i", x[a[t]], x[b[t]]) >= threshold
    return a[ok], b[ok]


def usable(vectors: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """id, label and v (doubles) of the vectors that may link."""
    x = F.col(vector)
    whole = x.isNotNull() & F.col(label).isNotNull() & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))) & F.exists(x, lambda c: c != 0)
    return vectors.where(F.col(vec_id).isNotNull() & F.coalesce(whole, F.lit(False))).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"),
        F.transform(x, lambda c: c.cast("double")).alias("v"))


def _shards(classes: DataFrame) -> DataFrame:
    """rep, v, copies, cells (sorted), and one row per shard: cell, i, j, and the class's block b."""
    n = classes.count()
    rate = max(CELL_ROWS, -(-n // MAX_CENTRES))
    centres: dict[tuple, tuple] = {}
    chosen = (classes.where(F.pmod(F.xxhash64("rep", F.lit(7)), F.lit(rate)) == 0)
              .orderBy("rep").limit(MAX_CENTRES).select("label", "v").collect())
    for number, r in enumerate(chosen):
        numbers, kept = centres.setdefault((r.label, len(r.v)), ([], []))
        x = unit(np.array([r.v], dtype=float))[0]
        if not kept or (np.array(kept) @ x).max() < APART:
            numbers.append(number)
            kept.append(x)
    near = classes.sparkSession.sparkContext.broadcast(
        {k: (np.array(a), np.array(b)) for k, (a, b) in centres.items()})

    def assign(batches):
        for batch in batches:
            cells: list = []
            for label, v in zip(batch["label"].to_pylist(), batch["v"], strict=True):
                x = np.asarray(v.values, dtype=float)[None]
                numbers, c = near.value.get((label, x.shape[1]), (None, None))
                if numbers is None:
                    cells.append([-1])
                    continue
                s = (c @ unit(x)[0])
                top = np.argsort(-s, kind="stable")[:OVERLAP]
                cells.append(sorted(numbers[top].tolist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.list_(pa.int32()))],
                                             names=[*batch.schema.names, "cells"])

    rows = classes.withColumn("dim", F.size("v")).select("label", "dim", "v", "rep", "copies").mapInArrow(
        assign, "label string, dim int, v array<double>, rep long, copies long, cells array<int>")
    rows = stored(rows, "cells")
    member = rows.withColumn("cell", F.explode("cells"))
    sizes = member.groupBy("label", "dim", "cell").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(SHARD_ROWS)).cast("int").alias("half"))
    sizes = sizes.withColumn("nb", F.when(F.col("half") > 1, F.col("half") * 2).otherwise(1)).drop("half")
    member = member.join(sizes, ["label", "dim", "cell"]).withColumn(
        "b", F.pmod(F.xxhash64("rep", F.lit(3)), "nb").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("nb") - 1))
    return (member.withColumn("o", other).withColumn("i", F.least("b", "o")).withColumn("j", F.greatest("b", "o"))
            .select("label", "dim", "cell", "i", "j", "b", "rep", "copies", "cells", "v"))


SHARD = ("label", "dim", "cell", "i", "j")


def _build_shard(t: pa.Table) -> pa.Table:
    rep = t["rep"].to_numpy()
    order = np.argsort(rep)
    lists = build(unit(_matrix(t)[order]))
    return pa.table([rep[order], pa.array([rep[order][x] for x in lists], pa.list_(pa.int64()))], schema=GRAPH)


def _search_shard(t: pa.Table, threshold: float) -> pa.Table:
    order = np.argsort(t["rep"].to_numpy())
    t = t.take(pa.array(order))
    rep, copies, block = (t[c].to_numpy() for c in ("rep", "copies", "b"))
    cell, i, j = (t[c][0].as_py() for c in ("cell", "i", "j"))
    lists = []
    for near in t["near"]:
        ids = np.asarray(near.values)
        at = np.minimum(np.searchsorted(rep, ids), len(rep) - 1)
        lists.append(at[rep[at] == ids])
    a, b = range_search(unit(_matrix(t)), padded(lists), threshold)
    cells = padded([np.asarray(c.values) for c in t["cells"]])
    shared = (cells[a][:, :, None] == cells[b][:, None, :]) & (cells[a][:, :, None] != -1) if len(a) else None
    if len(a):
        smallest = np.where(shared.any(axis=2), cells[a], np.iinfo(np.int64).max).min(axis=1)
        mine = ((smallest == cell) | (cell == -1)) & (
            np.minimum(block[a], block[b]) == i) & (np.maximum(block[a], block[b]) == j)
        a, b = a[mine], b[mine]
    links = np.bincount(a, copies[b], len(rep)) + np.bincount(b, copies[a], len(rep))
    root = rep.copy()
    if len(a):
        node, low = local_roots(rep[a], rep[b])
        root[np.searchsorted(rep, node)] = low
    on = links > 0
    return pa.table([rep[on], links[on].astype(np.int64), root[on]], schema=FOUND)


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, vec_id: str = "vec_id",
                    vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors``."""
    prepare(vectors.sparkSession)
    rows = usable(vectors, vec_id, vector, label)
    classes = stored(rows.groupBy("label", "v").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "classes")
    shards = _shards(classes)
    graph = (shards.groupBy(*SHARD).applyInArrow(_build_shard, "rep long, near array<long>")
             .groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")))
    found = stored(shards.join(graph, "rep").groupBy(*SHARD).applyInArrow(
        lambda t: _search_shard(t, threshold), "rep long, links long, root long"), "found")
    components = connected_components(found.select(F.col("rep").alias("src"), F.col("root").alias("dst")))
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    of_class = (classes.join(counts, "rep", "left")
                .join(components.withColumnRenamed("node", "rep"), "rep", "left")
                .select("label", "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                        F.coalesce("component", "rep").alias("component_id")))
    linked = rows.join(of_class, ["label", "v"]).select("vec_id", "n_links", "component_id")
    rest = usable(vectors, vec_id, vector, label).select("vec_id")
    alone = vectors.select(F.col(vec_id).cast("long").alias("vec_id")).exceptAll(rest).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionAll(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def audit_recall(vectors: DataFrame, result: DataFrame, threshold: float = 0.93, every: int = 50,
                 vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> tuple[int, int]:
    """Links found and true links of the rows whose id is divisible by ``every``, by brute force in SQL."""
    rows = usable(vectors, vec_id, vector, label)
    dot = F.aggregate(F.zip_with("v", "w", lambda a, b: a * b), F.lit(0.0), lambda s, c: s + c)

    def norm(c):
        return F.sqrt(F.aggregate(F.transform(c, lambda a: a * a), F.lit(0.0), lambda s, a: s + a))

    ask = rows.where(F.col("vec_id") % every == 0)
    other = rows.select(F.col("vec_id").alias("other"), "label", F.col("v").alias("w"))
    true = ask.join(other, "label").where((F.col("vec_id") != F.col("other")) & (F.size("v") == F.size("w"))).where(
        dot / (norm("v") * norm("w")) >= threshold).count()
    found = result.where(F.col("vec_id") % every == 0).agg(F.sum("n_links")).first()[0]
    return int(found or 0), true
