"""The pipeline's stages against their operators, and the whole on a small table."""

from __future__ import annotations

import corpus_pipeline
from labelloom.llm import jaccard, leaks, mixture, quality

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    columns, ids = docs.columns, lambda df: sorted(r["doc_id"] for r in df.collect())
    good = corpus_pipeline.quality(spark, docs, SF)
    scores = quality.quality_scores(docs, labels)
    assert good.columns == columns and ids(good) == ids(scores.filter("predicted = 1"))
    single = corpus_pipeline.near_duplicates(spark, good, SF)
    classes = jaccard.jaccard_classes(good)
    assert single.columns == columns and ids(single) == ids(classes.filter("doc_id = component_id"))
    clean = corpus_pipeline.decontamination(spark, single, SF)
    found = {r["doc_id"] for r in leaks.leaks(single, items).collect()}
    assert clean.columns == columns and ids(clean) == [i for i in ids(single) if i not in found]
    mixed = corpus_pipeline.mixture(spark, clean, SF)
    copies = {r["doc_id"]: r["copies"] for r in mixture.mixture(clean, labels).collect()}
    assert mixed.columns == columns and ids(mixed) == sorted(i for i, n in copies.items() for _ in range(n))
    dealt = corpus_pipeline.sharding(spark, mixed, SF)
    assert ids(dealt) == ids(mixed)


def test_run(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixture", "sharding"]
    assert corpus_pipeline.run(spark, SF).count() > 100
