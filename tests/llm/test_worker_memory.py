"""What a worker holds of texts: one copy, worked on in small chunks."""

import contextlib
import io
import tracemalloc

import pyarrow as pa

from caseloom.llm import bpe, quality
from caseloom.llm.queries import tokenizer_file


def plan(df):
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain()
    return out.getvalue()


def test_a_text_goes_to_a_worker_once(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    judged = plan(quality.accepted(docs, labels))
    assert "MapInArrow" not in judged and judged.count("ArrowEvalPython") == 1
    sent = plan(bpe.encoded(docs, tokenizer_file("byte_bpe_50k.json")))
    assert "MapInArrow" in sent and "whole_text" not in sent


def test_features_hold_little_beside_the_texts():
    column = pa.array(["some words of a Text, said 12 times over. " * 40] * 2500)  # 4 MB
    tracemalloc.start()
    assert sum(1 for _ in quality.features(column)) == 2500
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6
