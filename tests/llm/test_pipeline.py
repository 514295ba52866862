"""The pipeline's stages on their own input, and on ugly rows."""

import corpus_pipeline
from pyspark.sql import functions as F

from caseloom.llm import mixing, quality, substring_dedup
from caseloom.session import cut_lineage
from test_texts import brute_cleaned, brute_components, wanted


def test_stages_equal_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, held = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = cut_lineage(stage(spark, docs, small), name)
        held[name] = (before, {r.doc_id: r for r in docs.collect()})
        if name != "bpe":
            assert docs.columns == columns
    before, after = held["quality"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    gone = set(before) - set(after)
    assert gone and sum(labels.get(i) == 1 for i in gone) <= 0.02 * len(before)
    before, after = held["near_dedup"]
    groups = brute_components({i: r.text for i, r in before.items()}, 80)
    assert set(after) == {i for i, (_, c) in groups.items() if c == i}
    before, after = held["substring_dedup"]
    assert {i: r.text for i, r in after.items()} == brute_cleaned({i: r.text for i, r in before.items()}, substring_dedup.RUN, substring_dedup.MIN_WORDS)
    assert all(r.n_chars == len(r.text) for r in after.values())
    before, after = held["mixing"]
    assert set(after) < set(before) and all(after[i] == before[i] for i in after)
    before, after = held["bpe"]
    assert set(after) == set(before) and all(r.decoded == r.text and len(r.ids) == wanted(r.text)[0] for r in after.values())


def test_run_and_ugly_rows(spark, small, ugly):
    assert corpus_pipeline.run(spark, small).count() > 0
    named = ugly.select("doc_id", "text", "lang", "source", "n_chars", F.col("score").alias("extra"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, named, small)
        assert out.columns[: len(named.columns)] == named.columns
        assert stage(spark, named.limit(0), small).count() == 0, name
        named = out if name != "bpe" else named
    assert quality.THRESHOLD == 0.3 and mixing.Mix().max_epochs == 2.0
