"""Registered queries of the training-data operators.

Each applies its operator with production parameters to its whole table.
``ORACLE`` holds DuckDB SQL where SQL can express the result; the others are
tested against brute force in tests/llm.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from parcelkit.llm import (
    anchor_simhash, byte_bpe, embed_dedup, lexical_bpa, ngram_trie, packing, periodic_runs, pivot_topk, secret_novelty,
    suffix_dedup, token_counts, toxicity, warc)
from parcelkit.llm.common import prepare, table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_topk.top_k(table(spark, sf_dir, "embeddings"), k=5, scale=256, every=50)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.suffix_dedup(docs, length=100, with_bytes=False)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(table(spark, sf_dir, "documents"), BYTE_BPE, public_tokenizers.PATTERN)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), WORD_BPE, end_id=1)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), WORD_BPE, limit=2048)


def op7_ngram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_trie.score_texts(table(spark, sf_dir, "documents"), folds=7, held_out=2, order=3)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchor_simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.build(warc.responses(table(spark, sf_dir, "pages")))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_periodic_tails(table(spark, sf_dir, "documents"))
    return periodic_runs.digests(periodic_runs.periodic_runs(docs, least=6, power=4))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_novelty.digests(secret_novelty.scan(table(spark, sf_dir, "documents")))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_bpa.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


REGISTRY = {f.__name__: f for f in (
    op1_embedding_dedup, op2_exact_topk, op3_suffix_dedup, op4_byte_bpe, op5_packing, op6_token_counts, op7_ngram_scores,
    op8_simhash, op9_warc, op10_toxicity, op11_periodic_runs, op12_secret_scan, op13_lexical_search)}

# Brute force: every label's pairs, and the links' closure by a recursive query.
_OP1_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
n AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS s FROM v),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id
        AND len(a.e) = len(b.e)
      WHERE list_dot_product(a.e, b.e) / (a.s * b.s) >= 0.93),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
d AS (SELECT a, count(*) AS n_links FROM p GROUP BY a)
SELECT e.vec_id, CAST(coalesce(d.n_links, 0) AS BIGINT) AS n_links, c.component_id,
       e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c ON c.a = e.vec_id LEFT JOIN d ON d.a = e.vec_id
"""

_OP2_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
             vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

_OP13_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM documents),
tf AS (SELECT row, doc_id, term, count(*) AS tf FROM d GROUP BY row, doc_id, term),
len AS (SELECT row, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY row),
tot AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM len),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM tf, tot GROUP BY term),
m AS (SELECT row, 75 + (25 * n * docs) // terms AS m FROM len, tot),
q AS (SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
s AS (SELECT item, item_id, row, doc_id,
             CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
      FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (row) GROUP BY item, item_id, row, doc_id),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
             doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""

ORACLE: dict[str, str] = {"op1_embedding_dedup": _OP1_SQL, "op2_exact_topk": _OP2_SQL, "op13_lexical_search": _OP13_SQL}


def queries() -> dict:
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        return run
    return {k: wrap(v) for k, v in REGISTRY.items()}
