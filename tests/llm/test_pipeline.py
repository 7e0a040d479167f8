"""The pipeline's stages over a small table, each on what the one before kept."""

import corpus_pipeline


def test_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns and 0 < docs.count() <= n
            n = docs.count()
    assert docs.select("doc_id").distinct().count() == n
