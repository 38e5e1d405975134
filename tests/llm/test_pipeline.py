"""The pipeline against plain versions of its stages."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from quillspark.llm.common import stash
from quillspark.llm.mixing import source_rates
from quillspark.llm.toxicity import score_toxicity
from test_lines_and_windows import windows_brute
from test_near_dup import brute


def test_stages_one_by_one(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("_bad", F.lit(1)).withColumn("_gone", F.lit(2))
    columns, seen = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        out = stash(stage(spark, seen, folder), name)
        before = {r.doc_id: r for r in seen.collect()}
        after = [r.doc_id for r in out.collect()]
        if name != "sharding":
            assert out.columns == columns
        if name == "toxicity":
            bad = {r.doc_id for r in score_toxicity(seen, spark.read.parquet(f"{folder}/labels.parquet")).where("predicted = 1").collect()}
            assert sorted(after) == sorted(set(before) - bad) and bad
        elif name == "near_dedup":
            owner = brute([(k, r.text) for k, r in before.items()], 5)
            assert sorted(after) == sorted(k for k, c in owner.items() if k == c) and len(after) < len(before)
        elif name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
            hit = {d for d, _ in windows_brute([(k, r.text) for k, r in before.items()], items)}
            assert sorted(after) == sorted(set(before) - hit) and hit
        elif name == "mixing":
            rates = {r.source: r.rate for r in source_rates(seen, size=F.col("n_chars")).collect()}
            want = sum(rates[r.source] for r in before.values())
            assert abs(len(after) - want) < 5 * want**0.5 and set(after) <= set(before)
        else:
            assert out.columns == [*columns, "shard"] and len(after) == seen.count()
            assert {r.shard for r in out.collect()} <= set(range(40))
            assert out.groupBy("doc_id").agg(F.countDistinct("shard").alias("n")).where("n > 1").count() == 0
        seen = out


def test_run(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == [*spark.read.parquet(f"{folder}/documents.parquet").columns, "shard"] and out.count() > 50


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """A folder whose documents have null and repeated ids, null, blank and very long texts, and columns named like those of the stages."""
    folder = tmp_path_factory.mktemp("odd")
    names = " ".join(f"w{k}" for k in range(30))
    rows = [
        (1, names, "a"), (1, names, "a"), (2, names + " more", "a"), (3, None, "a"), (4, "", "b"), (5, " \n ", "b"), (None, names, "b"), (None, None, None),
        (6, "x " * 120_000, "c"), (7, "y " * 120_000 + "the question asks how many of the birds can fly over the lake", "c"), (8, "short", None),
        (9, "idiot moron scum trash pathetic loser", "a"), (10, "a clean text of a few words", "d"),
    ]
    docs = spark.createDataFrame([(i, t, "en", s, 7) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("copy", "shuffle_key", "_bad", "_gone", "gone", "component_id", "kept", "score", "predicted", "_source", "_count", "_part", "id", "item"):
        docs = docs.withColumn(name, F.lit(f"own {name}"))
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 0, 1), (99, 1, None)], "doc_id long, quality int, toxic int").where("false").write.parquet(f"{folder}/labels.parquet")
    bench = [(1, "the question asks how many of the birds can fly over the lake"), (2, None), (3, " "), (None, names)]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_stages_on_odd_rows(spark, odd):
    seen = spark.read.parquet(f"{odd}/documents.parquet")
    columns, ids = seen.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stash(stage(spark, seen, odd), name)
        ids[name] = sorted((r.doc_id for r in out.collect()), key=str)
        if name != "sharding":
            assert out.columns == columns
            assert all(r[c] == f"own {c}" for r in out.select("copy", "shuffle_key", "_bad", "gone", "kept", "score", "_part").collect() for c in r.asDict())
            assert stage(spark, seen.limit(0), odd).count() == 0
            seen = out
        else:
            assert out.columns == [*columns, "shard"] and all(0 <= r.shard < 40 for r in out.collect()) and stage(spark, seen.limit(0), odd).count() == 0
    # Without labels the fixed lexicons reject the abuse alone; null ids stay wherever a stage drops by id.
    assert ids["toxicity"] == sorted([1, 1, 2, 3, 4, 5, None, None, 6, 7, 8, 10], key=str)
    assert ids["near_dedup"] == sorted([1, 1, 3, 4, 5, None, None, 6, 7, 8, 10], key=str)
    assert ids["decontamination"] == sorted([1, 1, 3, 4, 5, None, None, 6, 8, 10], key=str)
    assert set(ids["mixing"]) <= set(ids["decontamination"]) and ids["mixing"].count(1) % 2 == 0
    assert ids["sharding"] == ids["mixing"]


def test_shares_after_mixing(spark):
    """A source without any text keeps its documents on average; n_chars counts for nothing."""
    rows = [(k, "word " * 50, "big", None) for k in range(900)] + [(k, "word " * 50, "small", 10**9) for k in range(900, 1000)] + [(k, None, "bare", 5) for k in range(1000, 1400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    counts = {r.source: r["count"] for r in corpus_pipeline.mixing(spark, docs, "").groupBy("source").count().collect()}
    # Sizes 9 : 1, so shares 3 : 1 of the same whole.
    assert abs(counts["big"] - 750) < 5 * 750**0.5 and abs(counts["small"] - 250) < 5 * 250**0.5 and abs(counts["bare"] - 400) < 100
