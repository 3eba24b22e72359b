import corpus_pipeline


def test_stages(spark, tmp_path):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, d).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == columns and docs.count() > 0.3 * n
    got = corpus_pipeline.STAGES[-1][1](spark, docs, d)
    assert got.agg({"length": "sum"}).first()[0] > 0
    assert corpus_pipeline.run(spark, d).count() > 0
