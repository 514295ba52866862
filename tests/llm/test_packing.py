"""Packing: pieces tile their documents, sequences are gapless and nearly full."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import tokenizers

from caseloom.llm import packing
from caseloom.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


def wanted(text):
    library = tokenizers.Tokenizer.from_file(PATH)
    library.no_truncation()
    library.no_padding()
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def checked(rows, ids_of, capacity=2048):
    """Padding of all sequences, after every piece is found where it belongs."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(docs) == set(ids_of)
    for doc_id, pieces in docs.items():
        at, ids = 0, ids_of[doc_id]
        for p in sorted(pieces, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids) and p["length"] > 0
            assert p["ids_crc32"] == zlib.crc32(np.array(ids[at : at + p["length"]], dtype="<u4").tobytes())
            at += p["length"]
        assert at == len(ids)
    padding = 0
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding


def test_query_tiles_documents_with_little_padding(spark, small, texts):
    rows = [r.asDict() for r in QUERIES["op11_harmonic_packing"](spark, small).collect()]
    library = tokenizers.Tokenizer.from_file(PATH)
    library.no_truncation()
    library.no_padding()
    names = list(texts)
    ids = {i: [*e.ids, 1] for i, e in zip(names, library.encode_batch([texts[i] or "" for i in names], add_special_tokens=False), strict=True)}
    assert checked(rows, ids) <= 0.002 * sum(map(len, ids.values()))


def test_fixed_counts_and_cheapest_cuts():
    capacity = 64
    first = packing.cuts(capacity, 1.0)

    def cost(n):
        k = capacity // n
        return (0 if n & (n - 1) == 0 else (capacity - k * n) / k) + 1

    best = [0.0]
    for n in range(1, capacity):
        best.append(min(cost(a) + best[n - a] for a in range(1, n + 1)))
        assert abs(sum(cost(a) for a in packing.lengths(n, first)) - best[n]) < 1e-9
    assert packing.lengths(3 * capacity + 1, first) == [64, 64, 64, 1]
    assert packing.lengths(0, first) == []


def test_ugly_rows_and_long_white_space(spark, ugly):
    rows = [(20, " " * 400_000), (21, "x" * 100_000), (22, "日本語" * 20_000), (23, "<|endoftext|> a<|endoftext|>"), (24, None), (25, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [r.asDict() for r in packing.digests(packing.packed(docs, PATH)).collect()]
    checked(got, {i: wanted(t) for i, t in rows})
    assert packing.digests(packing.packed(docs.limit(0), PATH)).count() == 0
    whole = packing.digests(packing.packed(ugly, PATH))
    assert whole.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    each = ugly.collect()
    total = sum(len(wanted(r.text)) for r in each)
    out = whole.collect()
    assert sum(r.length for r in out) == total and {r.doc_id for r in out} == {r.doc_id for r in each}


def test_every_code_point_has_the_ids_of_the_library():
    tokens = packing.Tokens(open(PATH, encoding="utf-8").read())
    library = tokenizers.Tokenizer.from_file(PATH)
    assert tokens.ranked is not None
    chars = [chr(c) for c in range(0x33500) if not 0xD800 <= c < 0xE000]
    texts = [f"a {''.join(chars[i : i + 1])}1" for i in range(0, len(chars), 7)] + [c + " \n" + c for c in chars[:3000]]
    for text, held in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert tokens.ids(text).tolist() == held.ids
