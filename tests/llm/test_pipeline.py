import hashlib

import corpus_pipeline
from parcelkit.llm import queries, toxicity
from tests.conftest import SF_SMALL
from tests.llm.test_simhash import brute as near
from tests.llm.test_suffix import brute as cut


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "suffix_array_dedup", "packing"]
    columns = docs.columns
    clean = corpus_pipeline.reject_toxic(spark, docs, SF_SMALL).cache()
    model = toxicity.train(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    want = {r.doc_id for r in toxicity.score(docs, model).where("predicted = 0").collect()}
    assert clean.columns == columns and {r.doc_id for r in clean.collect()} == want

    single = corpus_pipeline.drop_near_copies(spark, clean, SF_SMALL).cache()
    rows = [(r.doc_id, r.text) for r in clean.collect()]
    assert single.columns == columns
    assert {r.doc_id for r in single.collect()} == {d for d, _, c, _ in near(rows) if d == c}

    short = corpus_pipeline.cut_repeats(spark, single, SF_SMALL).cache()
    rows = [(r.doc_id, r.text) for r in single.collect()]
    got = {r.doc_id: r for r in short.collect()}
    assert short.schema == docs.schema and len(got) == len(rows)
    whole = {d: r[-1] for d, *r in cut(rows) if r[1] == 0}
    for d, r in got.items():
        if d in whole:
            assert hashlib.sha256(r.text.encode()).hexdigest() == whole[d]

    packed = corpus_pipeline.pack(spark, short, SF_SMALL)
    counted = queries.token_counts.token_counts(short, queries.WORD_BPE).selectExpr("sum(n_tokens + 1)").first()[0]
    assert packed.selectExpr("sum(length)").first()[0] == counted
    ran = corpus_pipeline.run(spark, SF_SMALL)
    assert ran.columns == packed.columns and ran.selectExpr("sum(length)").first()[0] == counted


def test_empty_documents(spark, tmp_path):
    spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF_SMALL}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
