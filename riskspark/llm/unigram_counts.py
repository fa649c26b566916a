"""Token counts under a unigram vocabulary: Viterbi that carries score and piece count only.

An Aho-Corasick automaton over the pieces enumerates all matches by their
end; the best score of each prefix and the number of pieces on its path are
all that is kept, so no path is traced back. Tie rule of unigram tokenizers: a
later candidate must score strictly more, and candidates come in the order of
their start, so on a tie the longest piece wins. A character that is no
piece by itself may be unknown, at the lowest score less ``UNK_PENALTY``, and
comes after the pieces that start with it; it counts as its UTF-8 bytes
where the vocabulary falls back to bytes, else a run of unknown characters
counts once.

Text is prepared as the vocabulary's tokenizer does: a space mark in front,
spaces turned into marks. Where no piece has a mark inside, the best path
never crosses from a character to a mark, and all scores are whole
numbers, so words are counted apart and their counts cached by worker;
otherwise texts are counted whole. Scores add up in double precision.

Edge cases. Null or empty text has no tokens and score 0. Repeated rows are
counted each. Nothing is shuffled or collected.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import ship_package

MARK = "▁"
UNK_PENALTY = 10.0
CACHED_WORDS = 400_000
_RUNS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


@dataclass(frozen=True)
class Vocabulary:
    """Pieces that match text, with scores; control and byte pieces are left out."""

    pieces: tuple[tuple[str, float], ...]
    byte_fallback: bool


def load_vocabulary(model_file: str) -> Vocabulary:
    """The text pieces of a sentencepiece model file."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    ids = range(sp.get_piece_size())
    pieces = tuple((sp.id_to_piece(i), sp.get_score(i)) for i in ids
                   if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_unused(i) or sp.is_byte(i)))
    return Vocabulary(pieces, any(sp.is_byte(i) for i in ids))


class Counter:
    def __init__(self, vocabulary: Vocabulary):
        self.automaton, self.single = ahocorasick.Automaton(), set()
        for piece, score in vocabulary.pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
                if len(piece) == 1:
                    self.single.add(piece)
        if len(self.automaton):
            self.automaton.make_automaton()
        self.unknown = min((s for _, s in vocabulary.pieces), default=0.0) - UNK_PENALTY
        self.bytes = vocabulary.byte_fallback
        self.apart = self.bytes and all(
            MARK not in p.lstrip(MARK) and s == math.floor(s) for p, s in vocabulary.pieces)
        self.cache: dict[str, tuple[int, float]] = {}

    def best(self, text: str) -> tuple[int, float]:
        """(pieces, score) of the best path through a prepared text."""
        n = len(text)
        score, count = [0.0] + [-math.inf] * n, [0] * (n + 1)
        run = [False] * (n + 1)        # whether the best path ends in an unknown character
        matches = self.automaton.iter(text) if len(self.automaton) else iter(())
        end, value = next(matches, (n, None))
        for at in range(n):
            best, pieces = -math.inf, 0
            while end == at:           # longest first, that is, by start
                size, s = value
                s += score[at + 1 - size]
                if s > best:
                    best, pieces = s, count[at + 1 - size] + 1
                end, value = next(matches, (n, None))
            c = text[at]
            if c not in self.single:
                s = score[at] + self.unknown
                if s > best:
                    best, run[at + 1] = s, True
                    pieces = count[at] + (len(c.encode("utf-8", "surrogatepass")) if self.bytes else 1 - run[at])
            score[at + 1], count[at + 1] = best, pieces
        return count[n], score[n]

    def count(self, text: str | None) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        prepared = MARK + text.replace(" ", MARK)
        if not self.apart:
            return self.best(prepared)
        if len(self.cache) > CACHED_WORDS:
            self.cache.clear()
        cache, n, total = self.cache, 0, 0.0
        for word in _RUNS.findall(prepared):
            found = cache.get(word)
            if found is None:
                found = self.best(word)
                if len(word) <= 64:
                    cache[word] = found
            n += found[0]
            total += found[1]
        return n, total


@lru_cache(maxsize=2)
def counter(model_file: str) -> Counter:
    """One counter per Python worker and vocabulary."""
    return Counter(load_vocabulary(model_file))


def count_tokens(docs: DataFrame, model_file: str, text: str = "text") -> DataFrame:
    """(row, n_tokens, score): ``row`` holds the columns of ``docs`` other than the text; the path to the vocabulary is as on the workers."""
    ship_package(docs.sparkSession)
    carried = [F.col(f"`{c}`") for c in docs.columns if c != text]
    rows = docs.select(F.struct(*carried).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = rows.select("row").schema.add("n_tokens", "long").add("score", "double")

    def run(batches):
        count = counter(model_file).count
        for batch in batches:
            found = [count(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array([n for n, _ in found], pa.int64()),
                                              pa.array([s for _, s in found], pa.float64())], names=["row", "n_tokens", "score"])

    return rows.mapInArrow(run, schema)
