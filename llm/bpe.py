"""Byte-level BPE encoding and decoding through a shuffle of distinct words (operator 1).

Texts are split into pre-tokens, and each pre-token keeps its position in its text.
Every distinct pre-token of the corpus is encoded once, in the task that its shuffle
brings it to; the ids go back to the blocks of texts that hold it and are put in order
by position. Decoding joins the table of token bytes, whose size the vocabulary fixes.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BinaryType, StructField, StructType

from llm import blocks
from llm.common import as_bytes, freed, slices, table
from skuweave.session import cut_lineage

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge the adjacent pair of lowest rank, the leftmost of equal ones, until none is left."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    return _merge_short(word, ranks) if len(word) <= 100 else _merge_long(word, ranks)


def _merge_short(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    none = len(ranks) + 1
    get = ranks.get
    cuts = list(range(len(word) + 1))
    pairs = [get(word[at : at + 2], none) for at in range(len(word) - 1)]
    while pairs:
        lowest = min(pairs)
        if lowest == none:
            break
        at = pairs.index(lowest)
        del cuts[at + 1], pairs[at]
        if at < len(pairs):
            pairs[at] = get(word[cuts[at] : cuts[at + 2]], none)
        if at:
            pairs[at - 1] = get(word[cuts[at - 1] : cuts[at + 1]], none)
    return [ranks[word[start:end]] for start, end in zip(cuts, cuts[1:])]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a queue of pairs, so that the time grows little faster than the word."""
    size = len(word)
    after = list(range(1, size + 1))
    before = list(range(-1, size - 1))
    ends = list(range(1, size + 1))
    queue = []
    for at in range(size - 1):
        rank = ranks.get(word[at : at + 2])
        if rank is not None:
            queue.append((rank, at, at + 1, at + 2))
    heapq.heapify(queue)
    gone = bytearray(size)
    while queue:
        _, left, right, end = heapq.heappop(queue)
        # An entry is stale once one of its two parts was merged into another.
        if gone[left] or right >= size or gone[right] or ends[left] != right or ends[right] != end:
            continue
        gone[right] = 1
        ends[left] = end
        after[left] = after[right]
        if after[left] < size:
            before[after[left]] = left
        near = before[left]
        if near >= 0:
            rank = ranks.get(word[near:end])
            if rank is not None:
                heapq.heappush(queue, (rank, near, left, end))
        far = after[left]
        if far < size:
            rank = ranks.get(word[left : ends[far]])
            if rank is not None:
                heapq.heappush(queue, (rank, left, far, ends[far]))
    return [ranks[word[at : ends[at]]] for at in range(size) if not gone[at]]


def splitter(pattern: str):
    """Makes functions that split a text into the numbers of its pre-tokens.

    ``pattern`` is one like the default: letters and what is neither letter, digit nor
    space form pre-tokens of their own kind, with one space before them.

    Where single spaces stand between other characters, no pre-token reaches over a
    space from its left, so such stretches are split once and remembered. A text with
    any other white space next to a space is split as a whole.
    """

    def new() -> blocks.Splitter:
        find = regex.compile(pattern).findall
        known: dict[str, tuple[int, ...] | None] = {}

        def stretch_of(text: str, words: dict) -> tuple[int, ...]:
            """Pre-tokens of a space and ``text``; the plainest kinds without the pattern."""
            if text.isascii():
                if text.isalpha():
                    return (words.setdefault(" " + text, len(words)),)
                if text[-1] in ".,;:!?" and text[:-1].isalpha():
                    word = words.setdefault(" " + text[:-1], len(words))
                    return (word, words.setdefault(text[-1], len(words)))
            return numbers(find(" " + text), words)

        def numbers(pieces: list[str], words: dict) -> tuple[int, ...]:
            return tuple([words.setdefault(piece, len(words)) for piece in pieces])

        def split(text: bytes, words: dict) -> np.ndarray:
            whole = text.decode("utf-8", "replace")
            first, *rest = whole.split(" ")
            if first and (first[0].isspace() or first[-1].isspace()):
                return np.array(numbers(find(whole), words), np.uint32)
            every: list[int] = list(numbers(find(first), words)) if first else []
            add = every.extend
            for stretch in rest:
                codes = known.get(stretch, 0)
                if codes == 0:
                    clean = stretch and not stretch[0].isspace() and not stretch[-1].isspace()
                    codes = stretch_of(stretch, words) if clean else None
                    known[stretch] = codes
                if codes is None:
                    return np.array(numbers(find(whole), words), np.uint32)
                add(codes)
            return np.array(every, np.uint32)

        return split

    return new


def encode(
    df: DataFrame,
    vocabulary: str = VOCABULARY,
    pattern: str = public_tokenizers.PATTERN,
    id_col: str = "doc_id",
    text_col: str = "text",
    written: bool = False,
) -> DataFrame:
    """(id, ids): the token ids of every text, as the tiktoken library gives them.

    A null text is empty and has no ids. Every row is encoded for itself, so repeated
    rows, equal and null ids are all kept; an empty table gives no rows; other columns
    are not read. A text of any length is one row. The texts are read twice and must
    come in the same order both times: pass ``written=True`` if ``df`` reads files,
    otherwise id and text are written to the shared folder first.
    """
    spark = df.sparkSession
    kind = df.schema[id_col].dataType
    rows = df.select(F.col(id_col).alias("id"), as_bytes(text_col).alias("text"))
    rows = rows if written else cut_lineage(rows)
    ranks = spark.sparkContext.broadcast(load_ranks(vocabulary))
    new = splitter(pattern)

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks.make_blocks(batches, new):
            words = [word.encode() for word in block.words]
            yield from pa.Table.from_arrays(
                [
                    pa.array(words, pa.binary()),
                    pa.array(np.full(len(words), block.number, np.int64)),
                    pa.array(np.arange(len(words), dtype=np.int32)),
                ],
                names=["word", "block", "code"],
            ).to_batches(max_chunksize=50_000)

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks.make_blocks(batches, new):
            words = [word.encode() for word in block.words]
            check = blocks.checksum(words, range(len(words)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block.number], pa.int64()),
                    pa.array([[row[0] for row in block.rows]], pa.list_(ids_type)),
                    pa.array([blocks.packed(np.array([len(c) for c in block.codes]))], pa.binary()),
                    pa.array([blocks.packed(np.concatenate(block.codes))], pa.binary()),
                    pa.array([len(words)], pa.int64()),
                    pa.array(np.array([check], np.uint64).view(np.int64)),
                ],
                names=["block", "id", "lengths", "codes", "words", "sum"],
            )

    def solver():
        known = ranks.value
        return lambda word, _: encode_word(word, known)

    def assemble(texts: pa.Table, answers: pa.Table) -> pa.Table:
        parts = []
        for row in texts.to_pylist():
            check = row["sum"] & blocks._MASK
            starts, flat = blocks.join_answers(row["words"], check, answers)
            codes = blocks.unpacked(row["codes"])
            lengths = blocks.unpacked(row["lengths"]).astype(np.int64)
            reached = np.zeros(len(codes) + 1, np.int32)
            np.cumsum(np.diff(starts).astype(np.int32)[codes], out=reached[1:])
            offsets = reached[np.concatenate([[0], np.cumsum(lengths)])]
            # The gather goes over a bounded number of positions at a time.
            ids = np.empty(int(reached[-1]), np.int32)
            for at in range(0, len(codes), 500_000):
                piece = codes[at : at + 500_000].astype(np.int64)
                ids[reached[at] : reached[at + len(piece)]] = blocks.gathered(starts, flat, piece)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
            parts.append(pa.Table.from_arrays([pa.array(row["id"], ids_type), lists], names=[id_col, "ids"]))
        return pa.concat_tables(parts) if parts else empty

    ids_type = to_arrow_type(kind)
    empty = pa.table({id_col: pa.array([], ids_type), "ids": pa.array([], pa.list_(pa.int32()))})
    answers = blocks.answered(rows.mapInArrow(freed(entries), "word binary, block long, code int"), solver)
    sequence = rows.mapInArrow(
        freed(sequences),
        f"block long, id array<{kind.simpleString()}>, lengths binary, codes binary, words long, sum long",
    )
    return (
        sequence.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(assemble, f"`{id_col}` {kind.simpleString()}, ids array<int>")
    )


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes of its ids; null or empty ids give no bytes.

    The vocabulary's token bytes, about 50,000 rows, are joined by gathering. An id
    outside the vocabulary is an error.
    """
    tokens = sorted(load_ranks(vocabulary).items(), key=lambda item: item[1])
    if [rank for _, rank in tokens] != list(range(len(tokens))):
        raise ValueError("the vocabulary's ids have gaps")
    shared = encoded.sparkSession.sparkContext.broadcast(pa.array([t for t, _ in tokens], pa.binary()))
    schema = StructType([*encoded.schema.fields, StructField(out, BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value

        def join(batch: pa.RecordBatch) -> pa.RecordBatch:
            lists = batch.column(batch.schema.get_field_index(ids_col)).fill_null([])
            # Tokens taken in order lie one behind another: a row's bytes are one stretch.
            found = tokens.take(lists.flatten())
            ends = np.frombuffer(found.buffers()[1], np.int32, len(found) + 1 + found.offset)[found.offset :]
            sizes = pc.list_value_length(lists).to_numpy()
            cuts = ends[np.concatenate([[0], np.cumsum(sizes)])].astype(np.int32)
            rows = pa.BinaryArray.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(cuts), found.buffers()[2]])
            return batch.append_column(out, rows)

        for batch in batches:
            yield from slices(batch, join)

    return encoded.mapInArrow(freed(run), schema)


def digests(encoded: DataFrame) -> DataFrame:
    """The decoded rows of ``encode`` with the contract's hashes."""
    return decode(encoded).withColumns(
        {
            "n_tokens": F.size("ids").cast("long"),
            "ids_sha256": F.sha2(F.array_join("ids", ",").cast("binary"), 256),
            "decoded_sha256": F.sha2("decoded", 256),
        }
    )


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode(table(spark, sf_dir, "documents"), written=True)
    return digests(encoded).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
