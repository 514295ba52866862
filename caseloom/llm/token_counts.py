"""Token counts of a unigram tokenizer without its tokens: a count-only Viterbi over Aho-Corasick matches.

A text is cut as the tokenizer's white-space marker does it: blanks become the marker, a marker leads the text, and a
word is a marker with what follows up to the next one. An Aho-Corasick automaton over the vocabulary lists all pieces in
a word; dynamic programming over their ends carries the best score and the number of pieces on the best path. Tie rules
are the tokenizer's: of equal scores the piece that starts first stays; a character without a piece of its own counts as
unknown at ten below the least score. Neighbouring unknowns are one piece, or one piece a byte with byte fallback.

A worker keeps the results of recent words, up to `RECENT`; every text is counted whole.

Defined cases. Null text counts as empty: no pieces, score 0. Null doc_id, repeated rows and other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.llm.frames import free_name

MARK = "▁"
UNKNOWN_PENALTY = 10.0
RECENT = 200_000


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with their scores; `unknown` is one of them. Byte fallback needs all pieces <0x00> to <0xFF>."""

    pieces: tuple[tuple[str, float], ...]
    unknown: str = "<unk>"

    @property
    def falls_back(self) -> bool:
        named = {p for p, _ in self.pieces}
        return all(f"<0x{b:02X}>" in named for b in range(256))


def from_sentencepiece(path: str) -> Vocabulary:
    """Pieces and scores of a sentencepiece file, read as a unigram vocabulary."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return Vocabulary(tuple((model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())), model.id_to_piece(model.unk_id()))


class Counter:
    _made: tuple[Vocabulary, Counter] | None = None  # the worker's last one

    def __init__(self, vocabulary: Vocabulary):
        self.unknown, self.fallback = vocabulary.unknown, vocabulary.falls_back
        scores = dict(vocabulary.pieces)
        self.unknown_score = min(scores.values()) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, score in scores.items():
            self.automaton.add_word(piece, (len(piece), score, piece == self.unknown))
        self.automaton.make_automaton()
        self.single = {p for p in scores if len(p) == 1}
        self.recent: dict[str, tuple[int, float]] = {}

    @classmethod
    def of(cls, shared) -> Counter:
        if cls._made is None or cls._made[0] is not shared.value:
            cls._made = (shared.value, cls(shared.value))
        return cls._made[1]

    def word(self, word: str) -> tuple[int, float]:
        """(pieces, score) of the best path through one word."""
        ends: list[list[tuple[int, float, bool]]] = [[] for _ in word]
        for end, match in self.automaton.iter(word):
            ends[end].append(match)
        best, count, run = [0.0], [0], [0]  # run: 0 no unknown at the end, 1 the unknown piece by its name, 2 a run of unknowns
        for end, matches in enumerate(ends):
            matches.sort(reverse=True)  # the longest starts first
            score, pieces, tail = None, 0, 0
            for length, value, is_unknown in matches:
                at = end + 1 - length
                if score is None or best[at] + value > score:
                    score = best[at] + value
                    pieces, tail = self._unknown(count[at], run[at], word[at : end + 1], True) if is_unknown else (count[at] + 1, 0)
            if word[end] not in self.single and (score is None or best[end] + self.unknown_score > score):
                score = best[end] + self.unknown_score
                pieces, tail = self._unknown(count[end], run[end], word[end], False)
            best.append(score)
            count.append(pieces)
            run.append(tail)
        return count[-1], best[-1]

    def _unknown(self, count: int, run: int, part: str, named: bool) -> tuple[int, int]:
        """Pieces after one more unknown, given the run that it follows."""
        if named and run == 0:
            return count + 1, 1
        if not self.fallback:
            return count + (run == 0), 2
        return count + len(part.encode()) + (len(self.unknown.encode()) - 1 if run == 1 else 0), 2

    def text(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        text = text.replace(" ", MARK)
        words = (text if text.startswith(MARK) else MARK + text).split(MARK)[1:]
        known = self.recent
        new = [w for w in set(words) if w not in known]
        if new:
            if len(known) + len(new) > RECENT:
                known.clear()
                new = set(words)
            for w in new:
                known[w] = self.word(MARK + w)
        pieces, score = 0, 0.0
        for w in words:
            n, s = known[w]
            pieces += n
            score += s
        return pieces, score


def _counted(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """The last column holds the text; it gives way to the count and the score."""
    counter = Counter.of(shared)
    for batch in batches:
        found = [counter.text(t.as_py() or "") for t in batch.column(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array([n for n, _ in found], pa.int64()), pa.array([s for _, s in found], pa.float64())],
            names=[*batch.schema.names[:-1], "pieces_counted", "path_score"])


def counted(docs: DataFrame, vocabulary: Vocabulary, pieces: str = "n_tokens", score: str = "best_score") -> DataFrame:
    """docs with two more columns: the number of pieces of `text` and the score of its best path."""
    pieces, score = free_name(docs, pieces), free_name(docs, score)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # as large as the tokenizer's file
    schema = T.StructType([*docs.schema.fields, T.StructField(pieces, T.LongType()), T.StructField(score, T.DoubleType())])
    held = docs.withColumn(free_name(docs, "whole_text"), F.col("text").cast("string"))
    return held.mapInArrow(partial(_counted, shared=shared), schema)
