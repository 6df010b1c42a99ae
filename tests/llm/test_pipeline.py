"""Every stage of the pipeline on its own input, and the whole."""

import corpus_pipeline as P
from corpusloom.llm import exact, simhash

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    for name, stage in P.STAGES[:-1]:
        kept = stage(spark, docs, SF_DIR)
        assert kept.columns == columns
        ids, had = [r[0] for r in kept.select("doc_id").collect()], {r[0] for r in docs.select("doc_id").collect()}
        assert len(ids) == len(set(ids)) and set(ids) <= had
        if name == "language_id":
            assert len(ids) >= 0.99 * len(had)
        if name == "exact_dedup":
            assert set(ids) == {r[0] for r in exact.exact_groups(docs).where("kept").select("doc_id").collect()}
        if name == "simhash_near_dedup":
            assert set(ids) == {r[0] for r in simhash.simhash_groups(docs).select("component_id").distinct().collect()}
        docs = spark.createDataFrame(kept.collect(), kept.schema)
    pieces = P.STAGES[-1][1](spark, docs, SF_DIR)
    assert {r[0] for r in pieces.select("doc_id").distinct().collect()} == {r[0] for r in docs.select("doc_id").collect()}
    assert sorted(map(repr, pieces.drop("sequence_id", "offset").collect())) == sorted(map(repr, P.run(spark, SF_DIR).drop("sequence_id", "offset").collect()))


def test_empty(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, docs, SF_DIR).count() == 0
