"""Token counts by count-only Viterbi over a unigram vocabulary.

The pieces of a tokenizer file and their scores are read as a unigram model: a text is cut into pieces so that the sum
of scores is greatest. An Aho-Corasick automaton enumerates the pieces that end at each place; the dynamic programme
carries the best score and its number of pieces only. Of equal scores the first start wins, that is the longest last
piece, as in the tokenizer library; a character without a piece of its own costs ten below the least score and counts
as its UTF-8 bytes.

No piece holds a line feed or, after another character, the mark that stands for a space. So words are counted apart
and remembered; a text's count is the sum.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from seasonlens.llm.arrow import with_columns

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: words of a generation that a Python worker remembers; it holds two
WORDS_KEPT = 400_000

_RUNS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")


def pieces_of(model_path: str) -> dict[str, float]:
    """The pieces that text can match, with their scores: no control, unknown or byte pieces."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_path)
    return {
        model.id_to_piece(i): float(model.get_score(i))
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    }


class UnigramCounter:
    """Number of pieces and score of the best segmentation."""

    def __init__(self, pieces: dict[str, float]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = frozenset(piece for piece in pieces if len(piece) == 1)
        self.unknown = min(pieces.values(), default=0.0) - UNKNOWN_PENALTY
        # whether words and lines are independent
        self.apart = not any("\n" in piece or SPACE in piece.lstrip(SPACE) for piece in pieces)
        #: words seen since the last change of generations, and those of the generation before
        self.known: dict[str, tuple[int, float]] = {}
        self.older: dict[str, tuple[int, float]] = {}

    def best(self, text: str) -> tuple[int, float]:
        """Pieces and score of ``text``, in which marks stand for spaces."""
        size, single = len(text), self.single
        worst = float("-inf")
        score, count = [worst] * (size + 1), [0] * (size + 1)
        score[0] = 0.0
        done = 0  # ends up to here are final
        for last, (length, value) in self.automaton.iter(text):
            end = last + 1
            while done < end - 1:
                done += 1
                if text[done - 1] not in single:
                    self._unknown(text, done, score, count)
            found = score[end - length] + value
            # matches of one end come longest first
            if found > score[end]:
                score[end], count[end] = found, count[end - length] + 1
        while done < size:
            done += 1
            if text[done - 1] not in single:
                self._unknown(text, done, score, count)
        return count[size], score[size]

    def _unknown(self, text: str, end: int, score: list[float], count: list[int]) -> None:
        found = score[end - 1] + self.unknown
        if found > score[end]:
            score[end], count[end] = found, count[end - 1] + len(text[end - 1].encode("utf-8", "surrogatepass"))

    def __call__(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        whole = SPACE + text.replace(" ", SPACE)
        if not self.apart:
            return self.best(whole)
        if len(self.known) > WORDS_KEPT:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        words = _RUNS.findall(whole)
        for word in set(words).difference(known):
            known[word] = older[word] if word in older else self.best(word)
        found = [known[word] for word in words]
        return sum([n for n, _ in found]), sum([s for _, s in found])


@lru_cache(maxsize=1)
def counter(model_path: str) -> UnigramCounter:
    """The counter of a Python worker, which later tasks of the worker find with its words."""
    return UnigramCounter(pieces_of(model_path))


MADE = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("score", T.DoubleType())])


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens and score (of the best segmentation) of every whole text.

    Spaces become marks and one mark is put in front, as the tokenizer does; nothing else is normalised. An empty or
    null text has no tokens and score 0. Repeated rows are counted each; other columns are ignored.
    """
    return with_columns(docs, text_col, MADE, lambda: counter(model_path), [id_col])
