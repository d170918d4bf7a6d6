import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tableferry.llm import leaks, near_duplicates, surrogates

pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.01"


def test_stages(spark):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    docs, seen = source, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).persist()
        seen[name] = docs
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == source.columns and docs.schema == source.schema
    told, alone, clean, private, last = seen.values()
    assert told.count() > 0.99 * source.count()
    classes = near_duplicates.report(told)
    assert sorted(r[0] for r in alone.select("doc_id").collect()) == sorted(r[0] for r in classes.where("kept").select("doc_id").collect())
    bad = leaks.report(alone, spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated").select("doc_id")
    assert bad.count() and clean.count() == alone.count() - bad.count() and clean.join(bad, "doc_id").isEmpty()
    real = {(x.kind, x.entity) for r in clean.collect() for x in surrogates.find(r.text)}
    after = private.collect()
    assert real and not real & {(x.kind, x.entity) for r in after for x in surrogates.find(r.text)}
    assert all(r.n_chars == len(r.text) for r in after)
    assert sorted(r[0] for r in last.select("doc_id").collect()) == sorted(r.doc_id for r in after)
    assert last.where(F.size("ids") == 0).isEmpty()
    for frame in seen.values():
        frame.unpersist()


def test_run_is_the_stages(spark, odd, none, tables):
    benchmark = spark.createDataFrame([(1, "nothing of this is in any of the documents of this small test, as it should be")], "item_id long, text string")
    folder = tables(documents=odd.drop("n_chars").withColumn("n_chars", F.lit(0).cast("long")), benchmark=benchmark)
    rows = corpus_pipeline.run(spark, folder).collect()
    assert rows and {r.doc_id for r in rows} <= {r.doc_id for r in odd.collect()}


def test_empty(spark, none, tables):
    folder = tables(documents=none, benchmark=spark.createDataFrame([], "item_id long, text string"))
    assert corpus_pipeline.run(spark, folder).collect() == []
