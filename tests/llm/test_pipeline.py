"""The pipeline's stages take effect on what the stage before kept."""

import corpus_pipeline
from pyspark.sql import functions as F

from quotelake.session import scratch_path


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs.count()
    seen = [before]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == columns
        seen.append(docs.count())
    # Copies have lost their lines before near copies are looked for.
    assert seen[4] <= seen[3] <= seen[2] == seen[1] < seen[0]
    out = corpus_pipeline.encode(spark, docs, sf_dir)
    assert out.count() == seen[-1]
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.n_tokens == len(r.ids) for r in out.collect())
    assert set(texts) == {r.doc_id for r in out.collect()}


def test_labelled_clean_documents_stay(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    clean = {r.doc_id for r in labels.where("quality = 1 AND toxic = 0").collect()}
    low = {r.doc_id for r in labels.where("quality = 0").collect()}
    kept = {r.doc_id for r in corpus_pipeline.reject_low_quality(spark, docs, sf_dir).collect()}
    assert len(clean & kept) >= 0.97 * len(clean) and len(low & kept) <= 0.1 * len(low)


def test_mixing_stage_passes_a_column_named_copies(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("copies", F.lit("own"))
    path = scratch_path(spark, "mixed")
    corpus_pipeline.mix_domains(spark, docs, sf_dir).write.parquet(path)
    mixed = spark.read.parquet(path)
    assert mixed.columns == docs.columns
    assert {r.copies for r in mixed.collect()} == {"own"}
