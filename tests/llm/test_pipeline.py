import corpus_pipeline
from reelrank.llm.common import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_on_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "simhash_dedup", "suffix_dedup", "decontamination", "best_fit_packing"]
    ids = [{r.doc_id for r in docs.select("doc_id").collect()}]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf), "test-stage")
        assert docs.columns == COLUMNS
        ids.append({r.doc_id for r in docs.select("doc_id").collect()})
        assert ids[-1] <= ids[-2] and docs.count() == len(ids[-1])
    packed = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in packed} == ids[-1]


def test_edges_pass_every_stage(spark, sf, edge_docs, no_docs):
    for start in (edge_docs, no_docs):
        docs = start
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = materialise(stage(spark, docs, sf), "test-stage")
            assert docs.columns == start.columns
        corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
