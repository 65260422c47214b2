"""Corpus pipeline: stages over ``documents``, each written before the next reads it."""

from __future__ import annotations

from parcelkit.llm import anchor_simhash, packing, suffix_dedup, toxicity
from parcelkit.llm.common import prepare, stored, table
from parcelkit.llm.queries import WORD_BPE


def reject_toxic(spark, docs, sf_dir):
    """Drop the documents that the toxicity model rejects; it learns from the labelled ones among them."""
    prepare(spark)
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark, docs, sf_dir):
    """One document of each SimHash component stays, the one with the smallest id."""
    prepare(spark)
    return anchor_simhash.drop_near_copies(docs, shingle=3, max_bits=2)


def cut_repeats(spark, docs, sf_dir):
    """Cut strings of 100 bytes that also start earlier out of the texts."""
    prepare(spark)
    return suffix_dedup.drop_repeats(docs, length=100)


def pack(spark, docs, sf_dir):
    """Pack the documents' tokens into sequences."""
    prepare(spark)
    return packing.pack(docs, WORD_BPE, end_id=1)


STAGES = [("toxicity", reject_toxic), ("simhash_near_dedup", drop_near_copies), ("suffix_array_dedup", cut_repeats),
          ("packing", pack)]

#: No stage but the cuts can be said in SQL; tests/llm/test_pipeline.py compares with a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply the stages in order to the documents of ``sf_dir``."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
