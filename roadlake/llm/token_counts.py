"""Token counts under a unigram vocabulary, without producing tokens.

An Aho-Corasick automaton lists every piece that ends at each character of a word; dynamic programming
carries, per end, the best score and the number of pieces on the way there. Ties follow the
tokenizer: a later way replaces an earlier one only with a strictly higher score, and of the ways into one
end those from smaller starts come first. A character that no piece covers alone costs the lowest
score less ten and counts as its UTF-8 bytes.

Words do not depend on each other, so each distinct word is solved once per worker while it is remembered.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from roadlake.llm.common import kept

#: What the tokenizer writes for a space, and takes off the lowest score for a character without a piece.
SPACE, UNKNOWN_PENALTY = "▁", 10.0
#: Words a worker remembers.
REMEMBERED = 1_000_000


def zipf_scores(pieces: list[str]) -> list[tuple[str, float]]:
    """A score per piece of a vocabulary that is ordered by frequency: the log of one over its rank."""
    return [(p, -math.log(rank)) for rank, p in enumerate(pieces, start=1)]


def piece_counter(scored: list[tuple[str, float]]) -> Callable[[str], int]:
    """Function that counts the pieces of the best segmentation of one word."""
    automaton = ahocorasick.Automaton()
    for piece, score in reversed(scored):  # of equal pieces the first one counts
        automaton.add_word(piece, (len(piece), score))
    automaton.make_automaton()
    unknown = min(score for _, score in scored) - UNKNOWN_PENALTY

    def count(word: str) -> int:
        best, pieces = [0.0] + [None] * len(word), [0] * (len(word) + 1)
        ways = automaton.iter(word)
        way = next(ways, None)
        for end in range(1, len(word) + 1):
            covered = False
            top = None
            n = 0
            # Pieces with this end come longest first, that is by rising start.
            while way is not None and way[0] == end - 1:
                size, score = way[1]
                total = score + best[end - size]
                if top is None or total > top:
                    top, n = total, pieces[end - size] + 1
                covered = covered or size == 1
                way = next(ways, None)
            if not covered:
                total = unknown + best[end - 1]
                if top is None or total > top:
                    top, n = total, pieces[end - 1] + len(word[end - 1].encode("utf-8", "surrogatepass"))
            best[end], pieces[end] = top, n
        return pieces[-1]

    return count


class _Counts(dict):
    """Counts of words, filled on demand."""

    def __init__(self, count: Callable[[str], int]):
        super().__init__()
        self.count = count

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        n = self.count(SPACE + word)
        if len(word) < 64:
            self[word] = n
        return n

    def of_text(self, text: str | None) -> int:
        """Words start at spaces; a text that starts with none is read as if it did."""
        if not text:
            return 0
        text = text.replace(SPACE, " ")
        return sum(map(self.__getitem__, (text[1:] if text[0] == " " else text).split(" ")))


def count_tokens(
    docs: DataFrame, scored: list[tuple[str, float]], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col`` and ``n_tokens`` of every row, in one pass without a shuffle.

    ``scored`` is the vocabulary, pieces with log scores. Null and empty texts have 0 tokens; ids, null ones and repeated
    ones too, are passed through. A text is taken whole, however long it is.
    """
    if not scored:
        raise ValueError("the vocabulary is empty")
    spark: SparkSession = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(scored)
    name = zlib.crc32(repr(scored).encode())

    @F.pandas_udf("long")
    def n_tokens(texts: pd.Series) -> pd.Series:
        counts = kept(("counts", name), lambda: _Counts(piece_counter(vocabulary.value)))
        return pd.Series([counts.of_text(t) for t in texts], dtype="int64")

    return docs.select(F.col(id_col).alias("row_id"), F.col(text_col).alias("row_text")).select(
        F.col("row_id").alias(id_col), n_tokens("row_text").alias("n_tokens")
    )
