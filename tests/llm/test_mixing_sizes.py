"""Operator 10 and the mixing stage where ``n_chars`` is missing."""

from pyspark.sql import functions as F

import corpus_pipeline
from quillspark.llm.queries import op10_poisson_mixture


def test_mixing_counts_texts(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    some = docs.first().source
    mix = lambda x: sorted(r.doc_id for r in corpus_pipeline.mixing(spark, x, folder).collect())
    gone = docs.withColumn("n_chars", F.when(F.col("source") != some, F.col("n_chars")))
    assert mix(gone) == mix(docs)
    bare = docs.withColumn("text", F.when(F.col("source") != some, F.col("text")))
    kept, n = corpus_pipeline.mixing(spark, bare, folder).where(F.col("source") == some).count(), docs.where(F.col("source") == some).count()
    assert abs(kept - n) <= 5 * n**0.5 and kept


def test_query_moves_whole_rows(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs.withColumn("n_chars", F.lit(None).cast(docs.schema["n_chars"].dataType)).write.parquet(f"{tmp_path}/documents.parquet")
    rows = lambda at: sorted(map(tuple, op10_poisson_mixture(spark, str(at)).collect()))
    assert rows(tmp_path) == rows(folder)
