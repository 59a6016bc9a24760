"""Benchmark decontamination: BM25 over an inverted index of test items (operator 3).

The index holds the test items. Every passage of every training text is a query:
overlapping windows of words that together cover the whole text. Retrieval is exact
for the threshold: upper bounds of single terms rule out most windows, upper bounds of
blocks of items most of the rest (block-max WAND), and what is left is scored. A
retrieved pair counts as a leak if the item's question and its answer both appear in
the passage word for word, to the shares asked for.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import as_bytes, freed, slices, table

_DROPPED = bytes(c for c in range(128) if not (chr(c).isalnum() or c <= 32))
SLICE = 1_000_000  # bytes of text that are queries at a time
_SENTENCE = re.compile(rb"[.!?\n]+\s*")


@dataclass(frozen=True)
class Limits:
    """What is retrieved and what is a leak.

    ``score`` is the share of an item's own BM25 score that a passage must reach,
    ``question`` and ``answer`` the shares of their words that runs of ``run`` words
    common to item and passage must cover. ``shard`` items are indexed, and sent to
    every task, at a time; more items mean more passes over the texts.
    """

    k1: float = 1.2
    b: float = 0.75
    score: float = 0.4
    question: float = 0.5
    answer: float = 0.5
    run: int = 5
    block: int = 8
    shard: int = 20_000


def words_of(text: bytes) -> list[bytes]:
    """Words in lower case without ASCII punctuation."""
    return text.lower().translate(None, _DROPPED).split()


def parts_of(text: bytes) -> tuple[list[bytes], int]:
    """An item's words, and the number of them that are its question.

    The answer is the last sentence. Where there is only one sentence, or the last is
    shorter than three words, it is the second half of the words.
    """
    every = words_of(text)
    pieces = [p for p in (words_of(s) for s in _SENTENCE.split(text)) if p]
    last = len(pieces[-1]) if len(pieces) > 1 else 0
    if last < 3 or sum(map(len, pieces)) != len(every):
        last = len(every) - len(every) // 2
    return every, len(every) - last


class Index:
    """Inverted index of items, with the largest score per term and block of items."""

    def __init__(self, items: list[tuple[int, bytes]], limits: Limits, counts: dict[bytes, int], total: int, average: float):
        self.limits = limits
        split = [(item, *parts_of(text)) for item, text in items]
        # Items of similar length make blocks whose bounds are close to their scores.
        split = sorted((s for s in split if s[1]), key=lambda s: (len(s[1]), s[0]))
        self.items = [s[0] for s in split]
        self.words = [s[1] for s in split]
        self.questions = [s[2] for s in split]
        longest = max(map(len, self.words), default=1)
        self.stride = max(longest, 32)
        self.terms: dict[bytes, int] = {}
        rows, columns, scores = [], [], []
        for at, words in enumerate(self.words):
            seen: dict[bytes, int] = {}
            for word in words:
                seen[word] = seen.get(word, 0) + 1
            norm = limits.k1 * (1 - limits.b + limits.b * len(words) / average)
            for word, often in seen.items():
                held = counts[word]
                idf = math.log(1 + (total - held + 0.5) / (held + 0.5))
                rows.append(self.terms.setdefault(word, len(self.terms)))
                columns.append(at)
                scores.append(idf * often * (limits.k1 + 1) / (often + norm))
        order = np.lexsort((columns, rows))
        self.doc = np.array(columns, np.int64)[order]
        self.score = np.array(scores)[order]
        self.starts = np.searchsorted(np.array(rows, np.int64)[order], np.arange(len(self.terms) + 1))
        own = np.bincount(self.doc, self.score, len(self.items))
        self.needed = limits.score * own - 1e-9
        # Postings of blocks: the best score of a term in each block that has it.
        block = self.doc // limits.block
        term = np.repeat(np.arange(len(self.terms)), np.diff(self.starts))
        blocks = -(-len(self.items) // limits.block) or 1
        key, place = np.unique(term * blocks + block, return_inverse=True)
        best = np.zeros(len(key))
        np.maximum.at(best, place, self.score)
        self.block_of, self.block_best = key % blocks, best
        self.block_starts = np.searchsorted(key // blocks, np.arange(len(self.terms) + 1))
        self.block_needed = np.full(blocks, np.inf)
        np.minimum.at(self.block_needed, np.arange(len(self.items)) // limits.block, self.needed)
        self.top = np.zeros(len(self.terms) + 1)
        np.maximum.at(self.top, term, self.score)
        self.least = float(self.needed.min()) if len(self.items) else math.inf

    def windows(self, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of windows of all texts, among the words of all in a row.

        Windows are two strides long and begin a stride apart, so that a stretch of up
        to a stride, and with it every item, lies whole in one of them.
        """
        count = np.maximum(-(-lengths // self.stride) - 1, lengths > 0)
        owner = np.repeat(np.arange(len(lengths)), count)
        place = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        offset = (np.cumsum(lengths) - lengths)[owner]
        begins = place * self.stride
        return offset + begins, offset + np.minimum(begins + 2 * self.stride, lengths[owner])

    def retrieve(self, codes: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, float]]:
        """(window, item, score) of every window and item at or above the item's
        threshold. ``codes`` are the words' terms, -1 where no item has the word."""
        if not self.items or not len(begins):
            return []
        # Each term of a window once.
        at = ranges(begins, ends)
        owner = np.repeat(np.arange(len(begins)), ends - begins)[codes[at] >= 0]
        at = at[codes[at] >= 0]
        pairs = np.unique(owner * len(self.terms) + codes[at])
        window, term = np.divmod(pairs, len(self.terms))
        # The best scores of a window's terms, whatever items they belong to.
        reach = np.bincount(window, self.top[term], len(begins))
        keep = reach[window] >= self.least
        window, term = window[keep], term[keep]
        if not len(window):
            return []
        # Whole windows go on in groups that bound the postings held at once.
        count = np.diff(self.block_starts)[term]
        firsts = np.flatnonzero(np.concatenate([[True], window[1:] != window[:-1]]))
        group = (np.cumsum(count) - count)[firsts] // 2_000_000
        cuts = firsts[np.flatnonzero(np.diff(group)) + 1]
        found: list[tuple[int, int, float]] = []
        for part in np.split(np.arange(len(term)), cuts):
            found += self._score(window[part], term[part])
        return found

    def _score(self, window: np.ndarray, term: np.ndarray) -> list[tuple[int, int, float]]:
        base = int(window[0])
        local = window - base
        size = int(local[-1]) + 1
        blocks = len(self.block_needed)
        rows = ranges(self.block_starts[term], self.block_starts[term + 1])
        owner = np.repeat(local, np.diff(self.block_starts)[term])
        # Bounds of blocks: what the best item of a block could get from each term.
        key = owner * blocks + self.block_of[rows]
        if size * blocks <= 4 * len(key):
            reach = np.bincount(key, self.block_best[rows], size * blocks)
            alive = np.flatnonzero(reach >= np.tile(self.block_needed, size))
        else:
            held, place = np.unique(key, return_inverse=True)
            reach = np.bincount(place, self.block_best[rows], len(held))
            alive = held[reach >= self.block_needed[held % blocks]]
        if not len(alive):
            return []
        use = np.isin(local, np.unique(alive // blocks))
        local, term = local[use], term[use]
        rows = ranges(self.starts[term], self.starts[term + 1])
        owner = np.repeat(local, np.diff(self.starts)[term])
        use = np.isin(owner * blocks + self.doc[rows] // self.limits.block, alive)
        key = owner[use] * len(self.items) + self.doc[rows[use]]
        held, place = np.unique(key, return_inverse=True)
        scores = np.bincount(place, self.score[rows[use]], len(held))
        right = scores >= self.needed[held % len(self.items)]
        return [
            (base + int(k // len(self.items)), int(k % len(self.items)), float(v))
            for k, v in zip(held[right], scores[right])
        ]

    def overlap(self, item: int, passage: list[bytes]) -> tuple[float, float]:
        """Shares of the question's and the answer's words in common runs of words."""
        words, cut = self.words[item], self.questions[item]
        run = min(self.limits.run, len(words))
        held = {tuple(passage[at : at + run]) for at in range(len(passage) - run + 1)}
        covered = np.zeros(len(words), bool)
        for at in range(len(words) - run + 1):
            if tuple(words[at : at + run]) in held:
                covered[at : at + run] = True
        question = covered[:cut].mean() if cut else 1.0
        return float(question), float(covered[cut:].mean()) if cut < len(words) else 1.0

    def leaks(self, texts: list[bytes]) -> list[dict[int, tuple[float, float, float]]]:
        """Per text: item -> (score, question share, answer share) of verified items."""
        split = [words_of(text) for text in texts]
        lengths = np.array([len(words) for words in split], np.int64)
        every = [word for words in split for word in words]
        get = self.terms.get
        codes = np.array([get(word, -1) for word in every], np.int64)
        begins, ends = self.windows(lengths)
        stops = np.cumsum(lengths)
        best: list[dict[int, tuple[float, float, float]]] = [{} for _ in texts]
        for window, item, score in self.retrieve(codes, begins, ends):
            begin, end = int(begins[window]), int(ends[window])
            question, answer = self.overlap(item, every[begin:end])
            if question >= self.limits.question and answer >= self.limits.answer:
                own = best[int(np.searchsorted(stops, begin, "right"))]
                name = self.items[item]
                own[name] = max(own.get(name, (0.0, 0.0, 0.0)), (score, question, answer))
        return best


def ranges(starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """The whole numbers of all half-open ranges, one range after another."""
    lengths = stops - starts
    begin = np.cumsum(lengths) - lengths
    return np.repeat(starts - begin, lengths) + np.arange(int(lengths.sum()))


def indexes(items: DataFrame, limits: Limits, id_col: str, text_col: str) -> list:
    """Broadcast indexes of at most ``shard`` items each, with the statistics of all.

    Items are the small side: the test set, not the corpus. Shards keep what a task
    holds bounded whatever their number. Null ids and wordless items are left out.
    """
    spark = items.sparkSession
    rows = (
        items.filter(F.col(id_col).isNotNull())
        .select(F.col(id_col).cast("long").alias("item"), as_bytes(text_col).alias("text"))
        .distinct()
        .orderBy("item", "text")
    )
    counts: dict[bytes, int] = {}
    shards: list[list[tuple[int, bytes]]] = [[]]
    total = length = 0
    for row in rows.toLocalIterator():
        words = words_of(bytes(row["text"]))
        if not words:
            continue
        total, length = total + 1, length + len(words)
        for word in set(words):
            counts[word] = counts.get(word, 0) + 1
        if len(shards[-1]) == limits.shard:
            shards.append([])
        shards[-1].append((row["item"], bytes(row["text"])))
    average = length / total if total else 1.0
    return [spark.sparkContext.broadcast(Index(s, limits, counts, total, average)) for s in shards if s]


def find_leaks(
    documents: DataFrame,
    items: DataFrame,
    limits: Limits = Limits(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, item_id, score, question_overlap, answer_overlap) for every leak.

    A document without a leak has no row; null texts and empty ones never do. Rows are
    searched one by one, so repeated rows repeat their leaks and null ids keep theirs;
    no items or no documents give no rows; other columns are not read. A long text is
    searched to its end. An item in several passages is listed once, at its best score.
    """
    kind = documents.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, item_id long, score double, question_overlap double, answer_overlap double"
    rows = documents.select(id_col, as_bytes(text_col).alias("text"))
    results = [_search(rows, index, schema, id_col) for index in indexes(items, limits, "item_id", "text")]
    if not results:
        return documents.sparkSession.createDataFrame([], schema)
    found = results[0]
    for more in results[1:]:
        found = found.unionAll(more)
    return found


def _search(rows: DataFrame, index, schema: str, id_col: str) -> DataFrame:
    def run(batches):
        known = index.value

        def search(batch: pa.RecordBatch) -> pa.RecordBatch:
            at, found = [], []
            for place, leaks in enumerate(known.leaks(batch.column(1).to_pylist())):
                for item, values in sorted(leaks.items()):
                    at.append(place)
                    found.append((item, *values))
            columns = list(zip(*found)) or [(), (), (), ()]
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at, pa.int64())),
                    pa.array(columns[0], pa.int64()),
                    *(pa.array(column, pa.float64()) for column in columns[1:]),
                ],
                names=[id_col, "item_id", "score", "question_overlap", "answer_overlap"],
            )

        for batch in batches:
            yield from slices(batch, search, SLICE)

    return rows.mapInArrow(freed(run), schema)


def without_leaks(
    documents: DataFrame, items: DataFrame, limits: Limits = Limits(), text_col: str = "text"
) -> DataFrame:
    """The rows in which no item was found, with all their columns; nothing is shuffled.

    Items count whatever their ids, null or repeated ones too; wordless items never match.
    A null or empty text holds no item and stays. Rows are searched one by one, so repeated
    rows and ids need nothing; an empty table on either side leaves the rows as they are;
    columns of any name or type are passed on. A long text is searched to its end.
    """
    items = items.select(F.xxhash64("text").alias("item_id"), "text")
    for index in indexes(items, limits, "item_id", "text"):
        documents = _clean(documents, index, text_col)
    return documents


def _clean(documents: DataFrame, index, text_col: str) -> DataFrame:
    def run(batches):
        known = index.value
        for batch in batches:
            at = batch.schema.get_field_index(text_col)

            def choose(part: pa.RecordBatch) -> pa.RecordBatch:
                texts = [(t or "").encode() for t in part.column(at).to_pylist()]
                return part.filter(pa.array([not found for found in known.leaks(texts)], pa.bool_()))

            yield from slices(batch, choose, SLICE)

    return documents.mapInArrow(freed(run), documents.schema)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
