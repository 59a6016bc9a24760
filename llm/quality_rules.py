"""Quality rules with compression bands (operator 9).

Repetitive text compresses far better than prose of its length, random text far
worse. Whole documents and fixed chunks of them are compressed with zstandard; each
length has its own band of ratios, and a text outside its band is rejected, as is one
with more than a tenth of its chunks outside theirs. Texts of any length are judged. The
limits stand clear of what clean texts of that length reach, a tenth or more below the
lowest ratios and 2 % or more above the highest. Below some 200
bytes the frame and the table of letters weigh so much that random letters and prose have
the same ratios; there only what is far outside is told apart.

The word and line counts that accompany the verdict are taken over whole texts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession

from llm.common import as_bytes, map_batches, table, windows, word_codes

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\r\x0b\x0c"


@dataclass(frozen=True)
class Bands:
    """Limits of compressed size over size, by the number of bytes compressed.

    ``edges`` are the upper byte lengths of all but the last band. A ratio below
    ``low`` is repetitive, one above ``high`` incompressible. ``frame`` bytes, which any
    compressed text has, are not counted. Texts of two chunks and more are cut into the
    largest of ``chunks``, with limits of their own.
    """

    frame: int = 9
    edges: Sequence[int] = (100, 200, 400, 800, 1_600, 3_200, 12_800, 51_200)
    low: Sequence[float] = (0.40, 0.40, 0.38, 0.36, 0.34, 0.32, 0.30, 0.28, 0.25)
    high: Sequence[float] = (1.25, 1.10, 0.86, 0.74, 0.66, 0.58, 0.54, 0.50, 0.50)
    chunks: Sequence[int] = (512, 1_024)
    chunk_low: Sequence[float] = (0.34, 0.31)
    chunk_high: Sequence[float] = (0.75, 0.66)
    chunk_share: float = 0.1
    level: int = 3

    def limits(self, size: int) -> tuple[float, float]:
        band = int(np.searchsorted(self.edges, size, "left"))
        return self.low[band], self.high[band]


@dataclass
class _Counter:
    """Counts of texts, with the word numbers of the batch kept between texts."""

    bands: Bands
    packer: zstandard.ZstdCompressor = field(init=False)

    def __post_init__(self) -> None:
        self.packer = zstandard.ZstdCompressor(level=self.bands.level)

    def ratio(self, data: bytes) -> float:
        return max(0, len(self.packer.compress(data)) - self.bands.frame) / len(data)

    def judge(self, text: bytes) -> tuple[float | None, float, bool]:
        """Whole ratio, share of chunks outside their band, verdict; an empty text is inside."""
        size, bands = len(text), self.bands
        if not size:
            return None, 0.0, True
        whole = self.ratio(text)
        low, high = bands.limits(size)
        kind = int(np.searchsorted(bands.chunks, size // 2, "right")) - 1
        share = 0.0
        if kind >= 0:
            chunk, least, most = bands.chunks[kind], bands.chunk_low[kind], bands.chunk_high[kind]
            starts = list(range(0, size - chunk + 1, chunk))
            # What is left behind the last full chunk is judged with the end of the text.
            if size % chunk:
                starts.append(size - chunk)
            share = sum(not least <= self.ratio(text[at : at + chunk]) <= most for at in starts) / len(starts)
        return whole, share, low <= whole <= high and share <= bands.chunk_share


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line of the text."""
    if b"\n" not in text:
        return 0
    seen: set[bytes] = set()
    found = 0
    for line in text.split(b"\n"):
        if not line.strip(BLANKS):
            continue
        if line in seen:
            found += 1
        else:
            seen.add(line)
    return found


def repeated_words(texts: list[bytes], size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Words per text, and those of them in a window that its text holds twice or more."""
    known: dict[bytes, int] = {}
    codes, lengths = word_codes(texts, known)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in known), np.uint64, len(known))
    rolled, counts = windows(hashes[codes], lengths, size)
    repeated = np.zeros(len(texts), np.int64)
    start = 0
    for at, count in enumerate(counts):
        if count > 1:
            own = rolled[start : start + count]
            ordered = np.sort(own)
            twice = ordered[1:][ordered[1:] == ordered[:-1]]
            if len(twice):
                steps = np.zeros(count + size, np.int64)
                hit = np.flatnonzero(np.isin(own, twice))
                np.add.at(steps, hit, 1)
                np.add.at(steps, hit + size, -1)
                repeated[at] = np.count_nonzero(np.cumsum(steps))
        start += count
    return lengths, repeated


def apply_rules(
    df: DataFrame, bands: Bands = Bands(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Counts and verdict per row: (id, n_words, ..., base_failed, kept, ratios).

    A null text counts as an empty one: no words, hence ``base_failed``. Rows are
    judged one by one, so repeated rows and ids, null ids and an empty table need no
    special case; other columns are not read. Long texts are compressed whole and in
    chunks, never cut.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        counter = _Counter(bands)
        texts = batch.column(1).to_pylist()
        n_words, repeated = repeated_words(texts)
        whole, share, inside = zip(*(counter.judge(text) for text in texts))
        failed = (n_words < 10) | (100 * repeated > 20 * n_words)
        characters = [
            len(t.decode("utf-8", "replace")) - len(t) + len(t.translate(None, BLANKS))
            for t in texts
        ]
        symbols = [len(t) - len(t.translate(None, SYMBOLS)) for t in texts]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(n_words),
                pa.array(characters, pa.int64()),
                pa.array(symbols, pa.int64()),
                pa.array([duplicate_lines(t) for t in texts], pa.int64()),
                pa.array(repeated),
                pa.array(failed),
                pa.array(~failed & np.array(inside)),
                pa.array(whole, pa.float64()),
                pa.array(share, pa.float64()),
            ],
            names=[
                id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines",
                "n_repeat_words", "base_failed", "kept", "zstd_ratio", "odd_chunks",
            ],
        )

    schema = (
        f"`{id_col}` {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean, kept boolean, zstd_ratio double, "
        "odd_chunks double"
    )
    return map_batches(df.select(id_col, as_bytes(text_col).alias("text")), count, schema)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "documents"))
