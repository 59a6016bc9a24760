"""Words of many texts, each distinct one answered once, and joined back by position.

Texts are packed into blocks. A block numbers its distinct words and keeps every text
as the sequence of those numbers, so that a block names a word once, however often it
occurs. The words of all blocks are then shuffled by word, answered, and shuffled back
to their blocks, where the positions are filled. A word has at most one row per block
on that way, which bounds the share of the most frequent one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from llm.common import freed

# A block ends with the text that brings it over either bound.
BLOCK_BYTES = 32_000_000
BLOCK_WORDS = 400_000
_MASK = (1 << 64) - 1


@dataclass
class Block:
    number: int
    rows: list[tuple] = field(default_factory=list)
    codes: list[np.ndarray] = field(default_factory=list)
    words: dict[Any, int] = field(default_factory=dict)
    size: int = 0


Splitter = Callable[[bytes, dict], np.ndarray]


def packed(values: np.ndarray) -> bytes:
    """Whole numbers below 2**32 as compressed planes of their bytes."""
    planes = np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


def make_blocks(batches: Iterator[pa.RecordBatch], new_splitter: Callable[[], Splitter]) -> Iterator[Block]:
    """Blocks of the partition's texts; the last column holds the text, the rest is kept.

    The same partition gives the same blocks with the same numbers.
    """
    first = TaskContext.get().partitionId() << 24
    block, split = Block(first), new_splitter()
    for batch in batches:
        kept = [column.to_pylist() for column in batch.columns[:-1]]
        texts = batch.columns[-1].to_numpy(zero_copy_only=False)
        for at in range(batch.num_rows):
            text = texts[at] or b""
            block.rows.append(tuple(column[at] for column in kept))
            block.codes.append(split(text, block.words))
            block.size += len(text)
            if block.size >= BLOCK_BYTES or len(block.words) >= BLOCK_WORDS:
                yield block
                block, split = Block(block.number + 1), new_splitter()
    if block.rows:
        yield block


def checksum(words: Sequence[bytes], codes: Sequence[int]) -> int:
    total = 0
    for word, code in zip(words, codes):
        total += xxhash.xxh64_intdigest(word) * (code + 1)
    return total & _MASK


def as_word(word: str | bytes) -> bytes:
    return word.encode() if isinstance(word, str) else word


def answered(
    entries: DataFrame, answer: Callable[[], Callable[[bytes, list], Sequence[int]]]
) -> DataFrame:
    """Answer each distinct word once; (block, codes, sizes, values, checksum) rows.

    ``entries`` has (word, block, code, ...). The function that ``answer`` makes is
    called once per word with the word's extra values of all blocks and returns whole
    numbers, which go to each of its blocks. Answers of a task are gathered per block,
    in bounded amounts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solve = answer()
        waiting: dict[int, tuple[list, list, list]] = {}
        sums: dict[int, int] = {}
        amount = 0

        def settle(word: bytes, holders: list) -> int:
            values = solve(word, [h[2] for h in holders])
            hashed = xxhash.xxh64_intdigest(word)
            for block, code, _ in holders:
                codes, sizes, every = waiting.setdefault(block, ([], [], []))
                codes.append(code)
                sizes.append(len(values))
                every.extend(values)
                sums[block] = (sums.get(block, 0) + hashed * (code + 1)) & _MASK
            return len(holders) * (2 + len(values))

        def emit() -> pa.RecordBatch:
            rows = [
                (block, packed(np.array(c)), packed(np.array(s)), packed(np.array(v)), sums[block])
                for block, (c, s, v) in waiting.items()
            ]
            waiting.clear()
            sums.clear()
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.int64()),
                    *(pa.array(column, pa.binary()) for column in columns[1:4]),
                    pa.array(np.array(columns[4], np.uint64).view(np.int64)),
                ],
                names=["block", "codes", "sizes", "values", "sum"],
            )

        word, holders = None, []
        for batch in batches:
            columns = [column.to_numpy(zero_copy_only=False).tolist() for column in batch.columns]
            if len(columns) < 4:
                columns.append([0] * batch.num_rows)
            for new, block, code, value in zip(*columns):
                if new != word:
                    if holders:
                        amount += settle(word, holders)
                        if amount > 750_000:
                            yield emit()
                            amount = 0
                    word, holders = new, []
                holders.append((block, code, value))
        if holders:
            settle(word, holders)
            yield emit()

    ordered = entries.repartition("word").sortWithinPartitions("word")
    return ordered.mapInArrow(freed(run), "block long, codes binary, sizes binary, values binary, sum long")


def join_answers(words: int, check: int, answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(starts, values): the answer of code c is values[starts[c]:starts[c + 1]].

    Raises where the answers are not those of the block's own words, which happens
    only if the texts came in another order the second time.
    """
    codes = [unpacked(part) for part in answers.column("codes").to_pylist()]
    sizes = [unpacked(part) for part in answers.column("sizes").to_pylist()]
    values = [unpacked(part) for part in answers.column("values").to_pylist()]
    found = sum(answers.column("sum").to_pylist()) & _MASK
    every = np.concatenate(codes) if codes else np.zeros(0, np.uint32)
    if len(every) != words or found != check:
        raise RuntimeError("the texts of a block changed between two reads; write them to a table first")
    length = np.zeros(words, np.int64)
    each = np.concatenate(sizes).astype(np.int64) if sizes else np.zeros(0, np.int64)
    length[every] = each
    starts = np.zeros(words + 1, np.int64)
    np.cumsum(length, out=starts[1:])
    flat = np.concatenate(values).astype(np.int32) if values else np.zeros(0, np.int32)
    return starts, gathered_to(starts[every], each, flat, int(starts[-1]))


def gathered_to(starts: np.ndarray, lengths: np.ndarray, flat: np.ndarray, total: int) -> np.ndarray:
    out = np.empty(total, flat.dtype)
    begin = np.cumsum(lengths) - lengths
    out[np.repeat(starts - begin, lengths) + np.arange(len(flat))] = flat
    return out


def gathered(starts: np.ndarray, flat: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The answers of ``codes`` one after another."""
    lengths = starts[codes + 1] - starts[codes]
    begin = np.cumsum(lengths) - lengths
    return flat[np.repeat(starts[codes] - begin, lengths) + np.arange(int(lengths.sum()))]
