"""Quality, near-dedup, substring dedup, BPE and token counts against brute force, libraries and held-out labels."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from caseloom.llm import bpe, near_dedup, quality, queries, substring_dedup, token_counts
from caseloom.llm.lexicon import Lexicon, compile_words

BPE_FILE = public_tokenizers.path("byte_bpe_50k.json")


# quality -----------------------------------------------------------------------------------------------------------


def test_quality_on_held_out_labels(spark, small):
    sf = small.replace("sf0.001", "sf0.01")
    rows = queries.QUERIES["op1_quality_classifier"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    seen = rows.join(labels, "doc_id").where("held_out").select("quality", "predicted", "score").collect()
    assert len(seen) > 50
    assert sum(r.quality == r.predicted for r in seen) / len(seen) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in seen)


def test_quality_never_learns_held_out_labels(spark, small):
    docs, labels = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.learnt(docs, labels), quality.learnt(docs, turned)
    assert np.array_equal(a.weight, b.weight) and (a.bias, a.slope, a.offset) == (b.bias, b.slope, b.offset)


def test_dual_descent_separates_and_is_optimal():
    rng = np.random.default_rng(0)
    labels = np.array([0, 1] * 60)
    rows = [np.unique(np.r_[rng.integers(0, 40, 5), 100 + y]) for y in labels]
    model = quality.fit(rows, labels, prior=0.5)
    margins = np.array([model.margin(r) for r in rows])
    assert ((margins > 0) == (labels == 1)).all()


def test_quality_cases(spark, ugly):
    nothing = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (2, None, None)], nothing.schema)
    for labels in (nothing, one):
        model = quality.learnt(ugly, labels)
        out = quality.scored(ugly, model, "judged")
        assert out.columns == [*ugly.columns, "judged"] and out.count() == ugly.count()
        assert quality.accepted(ugly, labels).columns == ugly.columns
    empty = ugly.limit(0)
    assert quality.accepted(empty, one).count() == 0


# near-dedup --------------------------------------------------------------------------------------------------------


def shingles(text, n=5):
    text = re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())


def brute_components(texts, percent):
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(list)
    for i, s in sorted(sets.items()):
        common = Counter(j for x in s for j in holders[x])
        for j, both in common.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
        for x in s:
            holders[x].append(i)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_near_dedup_equals_brute_force(spark, small, texts):
    want = brute_components(texts, 85)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.QUERIES["op8_minhash_near_dedup"](spark, small).collect()}
    assert got == want


def edited(words, rng, n):
    words = list(words)
    for k in rng.choice(len(words), n, replace=False):
        words[k] = f"new{rng.integers(1 << 40)}"
    return " ".join(words)


def test_near_dedup_finds_links_a_star_misses(spark):
    """Members that resemble one another but not the smallest member of their buckets."""
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(400)]
    texts = {0: edited(base, rng, 22)}
    for k in range(1, 40):  # 40 copies, each some edits from the base: pairs lie on both sides of the threshold
        texts[k] = edited(base, rng, int(rng.integers(1, 14)))
    far = edited(base, rng, 30).split()
    texts |= {100 + k: edited(far, rng, 2) for k in range(6)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for percent in (80, 85):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(frame, percent).collect()}
        assert got == brute_components(texts, percent)


def test_near_dedup_cases(spark, ugly):
    rows = near_dedup.near_duplicates(ugly)
    got = sorted(((r.doc_id or -1), r.n_shingles, r.component_id, r.kept) for r in rows.collect())
    assert [g for g in got if g[0] in (-1, 1, 2, 3, 4)] == [
        (-1, 3, None, True), (1, 3, 1, True), (1, 3, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True)]
    assert {(g[0], g[2], g[3]) for g in got if g[0] in (5, 6)} == {(5, 5, True), (6, 5, False)}
    once = near_dedup.one_of_each(ugly)
    assert once.columns == ugly.columns
    assert sorted((r.doc_id or -1) for r in once.collect()) == [-1, 1, 2, 3, 4, 5, 7]
    assert near_dedup.near_duplicates(ugly.limit(0)).count() == 0


def test_texts_of_one_id_are_one_vertex(spark):
    a, b, c = (" ".join(f"{tag}{k}" for k in range(30)) for tag in "abc")
    rows = [(1, a), (5, a), (5, b), (2, b), (5, " "), (7, c), (7, c), (9, "")]
    out = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in out) == [
        (1, 1, True), (2, 1, False), (5, 1, False), (5, 1, False), (5, 1, False), (7, 7, True), (7, 7, True), (9, 9, True)]


def test_one_of_each_decides_by_row(spark):
    a, b, c = (" ".join(f"{tag}{k}" for k in range(30)) for tag in "abc")
    rows = [(1, a, "u"), (5, a, "u"), (5, b, "v"), (9, c, "w"), (9, b + " x", "w"), (9, c, "w"), (4, "", "z"), (4, "", "z"), (4, " ", "z")]
    out = near_dedup.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, node string"))
    assert sorted(out.collect()) == [(1, a, "u"), (4, "", "z"), (4, " ", "z"), (5, b, "v"), (9, c, "w")]


def test_words_that_collide_in_a_polynomial_hash_stay_apart(spark):
    """Two words of 4,096 letters, one the other's twin: equal under any odd base modulo 2^64."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(4096))
    twin = word.translate(str.maketrans("ab", "ba"))
    out = near_dedup.near_duplicates(spark.createDataFrame([(1, word), (2, twin), (3, f"{word} x y z v")], "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in out) == [(1, 1, True), (2, 2, True), (3, 3, True)]


def test_signature_of_few_shingles_fills_all_bins():
    for n in (1, 2, 7, 500):
        s = np.unique(np.random.default_rng(n).integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        assert np.isin(near_dedup.signature(s), s).all()


# substring dedup ---------------------------------------------------------------------------------------------------


def brute_cleaned(texts, run, min_words):
    places = defaultdict(list)
    for i, t in texts.items():
        parts = [" ".join(t[a:b].lower().split()) for a, b in substring_dedup.sentences(t)]
        for k in range(len(parts) - run + 1):
            places[tuple(parts[k : k + run])].append((i, k))
    later = defaultdict(list)
    for at in places.values():
        for i, k in set(at) - {min(at)}:
            later[i].append(k)
    out = {}
    for i, t in texts.items():
        cut = substring_dedup.repeated(t, later[i], run, min_words)
        for a, b, _ in reversed(cut):
            t = t[:a] + t[b:]
        out[i] = t
    return out


def test_substring_dedup_equals_brute_force(spark, small, texts):
    got = {r.doc_id: r.text for r in queries.QUERIES["op3_substring_dedup"](spark, small).collect()}
    assert got == brute_cleaned(texts, substring_dedup.RUN, substring_dedup.MIN_WORDS)


def test_substring_dedup_takes_the_passage_and_leaves_the_rest(spark):
    passage = " ".join(f"Sentence {k} of the passage goes on for some ten words here." for k in range(6)) + " "
    docs = {i: f"Text {i} begins alone here. Own part {i} follows now. {passage if i % 2 else ''}And {i} ends with words of its own." for i in range(20)}
    out = {r.doc_id: r for r in substring_dedup.cleaned(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()}
    for i, text in docs.items():
        assert out[i].text == (text if i == 1 else text.replace(passage, ""))
        assert [text[s.start : s.end] for s in out[i].removed_spans] == ([passage] if i % 2 and i > 1 else [])


def test_substring_dedup_cases(spark, ugly):
    clash = ugly.withColumn("removed_spans", F.lit(1)).withColumn("doc_key", F.lit(2))
    out = substring_dedup.cleaned(clash)
    assert out.columns == [*clash.columns, "removed_spans_", "removed_sentences"]
    rows = {(r.doc_id, r.source): r.text for r in out.collect()}
    assert rows[1, "a"] == "One small text. It has two sentences." and rows[3, None] is None and rows[2, "a"] == ""
    assert substring_dedup.without_repeats(ugly).columns == ugly.columns
    assert substring_dedup.cleaned(ugly.limit(0)).count() == 0


def test_sentences_cover_the_text():
    for t in ("", "a", " a. b! c?\n\nd", "...", "\n\n", "x. \n y", "no end", "A.) B.' C"):
        spans = substring_dedup.sentences(t)
        assert "".join(t[a:b] for a, b in spans) == t


def kept_twice(texts, n=50):
    """Ids of the texts that still hold n words which an earlier place holds."""
    seen, found = set(), set()
    for i in sorted(texts):
        words = re.findall(r"[^ \t\n\v\f\r]+", texts[i].translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})))
        for k in range(len(words) - n + 1):
            run = tuple(words[k : k + n])
            if run in seen:
                found.add(i)
            seen.add(run)
    return found


def test_no_passage_of_50_words_stays_twice(spark, small, texts):
    rule = {r.doc_id: r.text for r in queries.QUERIES["op3_substring_dedup"](spark, small).collect()}
    out = {r.doc_id: r for r in queries.QUERIES["op3_repeated_passages"](spark, small).collect()}
    assert kept_twice(rule) and not kept_twice({i: r.text for i, r in out.items()})
    for i, text in texts.items():
        spans = [(0, 0), *[(s.start, s.end) for s in out[i].removed_spans], (len(text), len(text))]
        assert out[i].text == "".join(text[b:a] for (_, b), (a, _) in zip(spans, spans[1:], strict=False))
        assert len(out[i].text) <= len(rule[i])


def test_passages_without_whole_sentences(spark):
    def says(tag, n):
        return " ".join(f"{tag}{k}" for k in range(n))

    one, bare = says("long", 60) + ".", says("bare", 200)
    broken = f"{says('a', 19)}. {says('b', 12)}. {says('c', 19)}"  # one whole sentence between broken ones, 50 words
    docs = {
        1: f"First. {one} It goes on.", 2: one, 3: bare, 4: bare, 5: f"Own start {broken} own end.",
        6: f"Another begin {broken} another finish.", 7: f"{says('x', 30)} {bare} {says('y', 30)}", 8: says("once", 100), 9: says("long", 24),
    }
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r.doc_id: r.text for r in substring_dedup.cleaned(frame, passage=50).collect()}
    assert kept_twice(docs) == {2, 4, 6, 7} and not kept_twice(got)
    assert all(got[i] == docs[i] for i in (1, 3, 5, 8, 9))
    assert "x29" in got[7] and "y0" in got[7] and got[6].startswith("Another begin") and got[6].endswith("another finish.")


# BPE ---------------------------------------------------------------------------------------------------------------


def wanted(text):
    tok = Tokenizer.from_file(BPE_FILE)
    ids = tok.encode(text or "", add_special_tokens=False).ids
    back = tok.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


def test_bpe_equals_the_library(spark, small, texts):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.QUERIES["op4_bpe"](spark, small).collect()}
    assert got == {i: wanted(t) for i, t in texts.items()}


def test_bpe_cases(spark, ugly):
    out = bpe.encoded(ugly, BPE_FILE, n=3)
    assert out.columns == [*ugly.columns, "ids_", "decoded_"]
    tok = Tokenizer.from_file(BPE_FILE)
    for r in out.collect():
        assert r.ids_ == tok.encode(r.text or "", add_special_tokens=False).ids and r.decoded_ == (r.text or "")
    assert bpe.encoded(ugly.limit(0), BPE_FILE).count() == 0


def test_files_of_one_name_are_told_apart(spark, tmp_path):
    import json

    spec = json.loads(open(BPE_FILE, encoding="utf-8").read())
    docs = spark.createDataFrame([(1, "unseen qzx words here")], "doc_id long, text string")
    for folder, keep in (("a", len(spec["model"]["merges"])), ("b", 40)):
        (tmp_path / folder).mkdir()
        path = tmp_path / folder / "file.json"
        spec["model"]["merges"] = spec["model"]["merges"][:keep]
        path.write_text(json.dumps(spec), encoding="utf-8")
        row = bpe.encoded(docs, str(path)).first()
        assert row["ids"] == Tokenizer.from_file(str(path)).encode("unseen qzx words here", add_special_tokens=False).ids


def test_bpe_merges_words_of_any_length():
    merges, tok = bpe.Merges(BPE_FILE), Tokenizer.from_file(BPE_FILE)
    for word in ("ab" * 700, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "thethethe" * 9, "é" * 60, "x"):
        assert merges.merge(word.encode()) == tok.encode(word, add_special_tokens=False).ids


def test_lexicon_is_minimal_and_ranks_its_words():
    words = sorted(w.encode() for w in ("tap", "taps", "top", "tops", "stop", "stops", "a"))
    lexicon = Lexicon(compile_words(words))
    assert lexicon.ranks(words).tolist() == list(range(len(words)))
    assert lexicon.ranks([b"", b"t", b"tapss", b"st"]).tolist() == [-1] * 4
    endings = {(w[k:], w[:k]) for w in words for k in range(len(w) + 1)}
    classes = {frozenset(end for end, begin in endings if begin == b) for _, b in endings}
    assert lexicon.states == len(classes)  # one state for each set of endings, no more
    assert Lexicon(compile_words([])).ranks([b"a"]).tolist() == [-1]


# token counts ------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    return token_counts.from_sentencepiece(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def unigram(vocabulary):
    names = [p for p, _ in vocabulary.pieces]
    tok = Tokenizer(models.Unigram(list(vocabulary.pieces), unk_id=names.index(vocabulary.unknown), byte_fallback=True))
    tok.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return tok


def test_token_counts_equal_the_library(spark, small, texts, unigram):
    got = {r.doc_id: r.n_tokens for r in queries.QUERIES["op5_token_counts"](spark, small).collect()}
    assert got == {i: len(unigram.encode(t, add_special_tokens=False).ids) for i, t in texts.items()}


def test_token_counts_of_odd_texts(vocabulary, unigram):
    rng, letters = np.random.default_rng(3), ["a", "b", " ", "é", "\n", "▁", "<unk>", "<s>", "日", "😀", "the", "\x00"]
    counter = token_counts.Counter(vocabulary)
    for _ in range(2000):
        text = "".join(rng.choice(letters, rng.integers(0, 12)))
        assert counter.text(text)[0] == len(unigram.encode(text, add_special_tokens=False).ids), text


def test_ties_and_unknowns_without_fallback():
    vocabulary = token_counts.Vocabulary((("<unk>", 0.0), ("▁", -1.0), ("a", -2.0), ("b", -2.0), ("ab", -4.0), ("▁a", -3.0)))
    tok = Tokenizer(models.Unigram(list(vocabulary.pieces), unk_id=0, byte_fallback=False))
    tok.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    counter = token_counts.Counter(vocabulary)
    for text in ("ab", "a b", "abab", "xyz", "axxb", "<unk>", "x<unk>y", "aab ba"):
        assert counter.text(text)[0] == len(tok.encode(text, add_special_tokens=False).ids), text


def test_token_count_cases(spark, ugly, vocabulary, unigram):
    out = token_counts.counted(ugly.withColumn("n_tokens", F.lit(0)), vocabulary)
    assert out.columns == [*ugly.columns, "n_tokens", "n_tokens_", "best_score"]
    for r in out.collect():
        assert r.n_tokens_ == len(unigram.encode(r.text or "", add_special_tokens=False).ids)
    assert token_counts.counted(ugly.limit(0), vocabulary).count() == 0
