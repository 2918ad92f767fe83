"""Token counts by count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton gives all vocabulary pieces that end at a character;
dynamic programming carries the best score and its number of pieces, no path.
The rules are those of the ``tokenizers`` unigram model with byte fallback:
white space becomes a mark that starts each word, among equal scores the piece
that starts first (the longest) stays, a character that is no piece scores ten
below the lowest score and counts as its UTF-8 bytes.

No unigram vocabulary is at hand, so the default takes the pieces and scores of
the public piece model as one; counts equal those of the ``tokenizers`` model
built from the same list.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: What an unknown character scores below the lowest piece.
PENALTY = 10.0
#: Words whose counts a worker remembers, and their length at most.
REMEMBERED, LONGEST = 500_000, 48


def piece_scores(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a SentencePiece file, in order of id."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter:
    """Counts the tokens of texts; ``vocabulary`` has all 256 byte pieces."""

    def __init__(self, vocabulary: Sequence[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in vocabulary) - PENALTY
        self.span = 1 + max(len(piece) for piece, _ in vocabulary)
        self.counts: dict[str, int] = {}

    def words(self, text: str) -> list[str]:
        marked = text.replace(" ", MARK)
        return marked.removeprefix(MARK).split(MARK) if marked else []

    def count(self, text: str) -> int:
        total = 0
        for word in self.words(text):
            known = self.counts.get(word)
            if known is None:
                known = self.viterbi(MARK + word)
                if len(word) <= LONGEST:
                    if len(self.counts) >= REMEMBERED:
                        self.counts = {}
                    self.counts[word] = known
            total += known
        return total

    def viterbi(self, text: str) -> int:
        """Number of pieces on the best path; only the last ``span`` places are held."""
        span, unknown = self.span, self.unknown
        scores, counts = [0.0] * span, [0] * span
        found = self.automaton.iter(text)
        match = next(found, None)
        for end in range(len(text)):
            best, pieces, longest, single = None, 0, 0, False
            while match is not None and match[0] == end:
                length, score = match[1]
                at = (end + 1 - length) % span
                score += scores[at]
                single |= length == 1
                if best is None or score > best or score == best and length > longest:
                    best, pieces, longest = score, counts[at] + 1, length
                match = next(found, None)
            if not single:
                at = end % span
                score = unknown + scores[at]
                if best is None or score > best:
                    best, pieces = score, counts[at] + len(text[end].encode())
            scores[(end + 1) % span], counts[(end + 1) % span] = best, pieces
        return counts[len(text) % span]


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(piece_scores(path))


def token_counts(text: Column, vocabulary: str) -> Column:
    """Tokens of each whole text; 0 for null and empty texts. ``vocabulary`` is the model file."""

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = counter(vocabulary).count
        for texts in batches:
            yield pd.Series([count(t) if t else 0 for t in texts], dtype="int64")

    return counted(text)


def count_tokens(docs: DataFrame, vocabulary: str, output: str = "n_tokens") -> DataFrame:
    """Add ``output`` to ``docs``; a column of that name is replaced. Rows stay where they are.

    A document counts by itself, so repeated rows and documents alike have equal
    counts, and an empty table gives no rows.
    """
    return docs.withColumn(output, token_counts(F.col("text"), vocabulary))
