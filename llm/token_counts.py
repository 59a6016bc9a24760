"""Token counts by a count-only Viterbi search (operator 6).

Pieces of a unigram vocabulary are found by an Aho-Corasick automaton. Dynamic
programming carries the best score and the number of pieces to every position, and
nothing else: no path is kept or followed back. Equal scores are settled as unigram
tokenizers do, in favour of the piece that starts first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from llm.common import as_bytes, slices, table

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"  # fixed value: the character that stands for a space in pieces
UNKNOWN_PENALTY = 10.0  # fixed value: below the lowest score of a piece
REMEMBERED = 300_000  # different stretches a task remembers before it starts anew


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with their scores; ``fallback``: unknown characters become their bytes."""

    pieces: tuple[tuple[str, float], ...]
    fallback: bool

    @property
    def unknown(self) -> float:
        return min((score for _, score in self.pieces), default=0.0) - UNKNOWN_PENALTY


@lru_cache(maxsize=2)
def load_vocabulary(path: str) -> Vocabulary:
    """The ordinary pieces of a model file; its scores are used as they stand."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ordinary, byte_pieces = [], 0
    for at in range(model.get_piece_size()):
        if model.is_byte(at):
            byte_pieces += 1
        elif not (model.is_unknown(at) or model.is_control(at) or model.is_unused(at)):
            ordinary.append((model.id_to_piece(at), model.get_score(at)))
    return Vocabulary(tuple(ordinary), byte_pieces == 256)


class Counter:
    def __init__(self, vocabulary: Vocabulary):
        self.unknown = vocabulary.unknown
        self.fallback = vocabulary.fallback
        self.single = {piece for piece, _ in vocabulary.pieces if len(piece) == 1}
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            self.automaton.add_word(piece, (len(piece), score))
        if vocabulary.pieces:
            self.automaton.make_automaton()
        # Where a space can only begin a piece or follow spaces, and no run of unknown
        # characters can reach over it, texts are cut before it.
        self.cut = not any(SPACE in piece.lstrip(SPACE) for piece, _ in vocabulary.pieces)
        self.cut = self.cut and (self.fallback or SPACE in self.single)
        self.known: dict[str, int] = {}

    def pieces_of(self, text: str) -> int:
        """Pieces on the best path through ``text``."""
        size = len(text)
        best: list[float | None] = [None] * (size + 1)
        count = [0] * (size + 1)
        broken = bytearray(size + 1)  # the best path there ends with an unknown character
        best[0] = 0.0
        matches: Iterator = self.automaton.iter(text) if len(self.automaton) else iter(())
        following = next(matches, None)
        for end in range(1, size + 1):
            top, pieces, last = None, 0, 0
            # Matches with one end come longest first, that is by start.
            while following is not None and following[0] == end - 1:
                length, score = following[1]
                score += best[end - length]
                if top is None or score > top:
                    top, pieces = score, count[end - length] + 1
                following = next(matches, None)
            character = text[end - 1]
            if character not in self.single:
                score = best[end - 1] + self.unknown
                if top is None or score > top:
                    top, last = score, 1
                    if self.fallback:
                        pieces = count[end - 1] + len(character.encode("utf-8", "replace"))
                    else:
                        pieces = count[end - 1] + (not broken[end - 1])
            best[end], count[end], broken[end] = top, pieces, last
        return count[size]

    def count(self, text: str) -> int:
        """Pieces of a text with a space put before it; none for an empty text."""
        if not text:
            return 0
        if not self.cut:
            return self.pieces_of(SPACE + text.replace(" ", SPACE))
        if len(self.known) > REMEMBERED:
            self.known.clear()
        total, known, lead = 0, self.known, SPACE
        for part in text.replace(SPACE, " ").split(" "):
            if not part:
                lead += SPACE
                continue
            stretch = lead + part
            pieces = known.get(stretch)
            if pieces is None:
                pieces = known[stretch] = self.pieces_of(stretch)
            total += pieces
            lead = SPACE
        # Spaces behind the last word.
        if len(lead) > 1:
            total += self.pieces_of(lead[1:])
        return total


def count_tokens(
    df: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_tokens) for every row.

    A null text counts as an empty one and has no tokens. Rows are counted one by one,
    so repeated rows, null ids and an empty table need nothing; other columns are not
    read. A text of any length is counted whole.
    """
    kind = df.schema[id_col].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(load_vocabulary(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)

        def count(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [counter.count(text.decode("utf-8", "replace")) for text in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.int64())], names=[id_col, "n_tokens"]
            )

        for batch in batches:
            yield from slices(batch, count)

    rows = df.select(id_col, as_bytes(text_col).alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_tokens long")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
