import corpus_pipeline
from cleanroll.llm import near, quality


def test_stages_and_run(spark):
    sf = "/root/testdata/sf0.001"
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near", "lines", "mix", "pack"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    first = corpus_pipeline.keep_good(spark, docs, sf)
    assert first.columns == docs.columns
    kept = quality.assess(docs, spark.read.parquet(f"{sf}/labels.parquet")).where("kept")
    assert {r.doc_id for r in first.collect()} == {r.doc_id for r in kept.collect()}
    second = corpus_pipeline.keep_one_of_a_class(spark, first, sf)
    assert second.columns == docs.columns
    assert second.count() == near.classes(first).select("class_id").distinct().count()
    packed = corpus_pipeline.run(spark, sf)
    assert packed.count() > 0 and {r.doc_id for r in packed.select("doc_id").distinct().collect()} <= {r.doc_id for r in second.collect()}
