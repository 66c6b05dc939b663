from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from lakestar.llm.exact_dedup import normalised

SF = "/root/testdata/sf0.001"


def test_stages_in_order(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(k)))
        seen[name] = docs
        if k < 4:
            assert docs.columns == columns
            assert docs.join(before, columns, "left_anti").count() == 0  # rows of the stage before
    assert list(seen) == ["quality classifier", "exact dedup", "n-gram Jaccard join", "mixing sources to target weights",
                          "best-fit packing"]
    graded, exact, near, mixed, packed = seen.values()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert graded.join(labels.where("quality = 1"), "doc_id").count() >= 0.97 * labels.where("quality = 1").count()
    # exact: the largest id of each text
    best = graded.groupBy(normalised(F.col("text")).alias("t")).agg(F.max("doc_id").alias("doc_id"))
    assert sorted(r.doc_id for r in exact.collect()) == sorted(r.doc_id for r in best.collect())
    assert exact.count() > near.count() > 0
    assert max(Counter(r.doc_id for r in mixed.collect()).values()) <= 3
    pieces = packed.groupBy("doc_id").agg(F.countDistinct("piece").alias("kinds"))
    assert sorted(r.doc_id for r in pieces.collect()) == sorted({r.doc_id for r in mixed.select("doc_id").collect()})


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0
