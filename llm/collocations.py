"""Phrase collocation mining with counting quotient filters (operator 13).

Words are numbered over the whole corpus, so that an n-gram is a number of n times as many
bits. An invertible permutation spreads these numbers evenly; the upper bits, the quotient,
are kept as run lengths over all quotients, the rest in full. Such a filter counts without
loss: what stands in it can be turned back into the words. Every block of texts makes one
sorted filter, cut by ranges of the quotient; the pieces of a range meet in one task, which
merges them. Since the permutation is even, no range is hot, however frequent a phrase is.

A phrase is a candidate with ``least`` occurrences, and then all its parts have as many.
So words are counted first, pairs only of frequent words, and triples only where both
pairs are frequent: each merge answers every block with one bit per pair that it sent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.blocks import packed, unpacked
from llm.common import as_bytes, freed, mix, table, with_small
from skuweave.session import cut_lineage

# Fixed value: what ends a piece of text.
SEPARATORS = b".,;:!?\x0a\x0b\x0c\x0d"
#: A byte that UTF-8 does not have stands for the end of a piece.
_END = b"\xff"
_TABLE = bytes.maketrans(SEPARATORS, _END * len(SEPARATORS))

# A block ends with the text that brings it over either bound.
BLOCK_BYTES = 12_000_000
BLOCK_WORDS = 200_000
#: Words of a row of the written blocks.
ROW_WORDS = 4_000
#: N-grams that meet in one range of the quotient.
RANGE = 1_000_000
#: Bits of the quotient below a range: the runs of one piece of a filter.
SLOTS = 9
#: Parts in which a language is ranked before it is ranked as a whole.
SALTS = 64


class _Numbers(dict):
    """Numbers for the words of a language, in the order of the block's first occurrences."""

    def __init__(self, lang: str, block: _Block):
        super().__init__()
        self.lang, self.block, self.total = lang, block, 0
        self[_END] = 0

    def __missing__(self, word: bytes) -> int:
        self.block.words.append(word)
        self.block.langs.append(self.lang)
        number = self[word] = len(self.block.words)
        return number


class _Block:
    """Texts of a block as numbers of words, 0 behind every piece."""

    def __init__(self, number: int):
        self.number, self.size = number, 0
        self.words: list[bytes] = []
        self.langs: list[str] = []
        self.codes: list[np.ndarray] = []
        self.by_lang: dict[str, _Numbers] = {}

    def add(self, text: bytes, lang: str) -> None:
        words = text.lower().translate(_TABLE).replace(_END, b" \xff ").split()
        words.append(_END)
        numbers = self.by_lang.get(lang) or self.by_lang.setdefault(lang, _Numbers(lang, self))
        self.codes.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))
        self.size += len(text)

    def records(self) -> Iterator[pa.RecordBatch]:
        """A row with the codes, and rows with so many words each that none is large."""
        codes = np.concatenate(self.codes)
        counts = np.bincount(codes, minlength=len(self.words) + 1)[1:]

        def row(data: bytes | None, start: int, stop: int) -> pa.RecordBatch:
            one = lambda values, kind: pa.ListArray.from_arrays([0, stop - start], pa.array(values[start:stop], kind))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([self.number], pa.int64()),
                    pa.array([data], pa.binary()),
                    pa.array([start + 1], pa.int32()),
                    one(self.langs, pa.string()),
                    one(self.words, pa.binary()),
                    one(counts, pa.int64()),
                ],
                names=["block", "codes", "first", "langs", "words", "counts"],
            )

        yield row(packed(codes), 0, 0)
        for start in range(0, len(self.words), ROW_WORDS):
            yield row(None, start, min(start + ROW_WORDS, len(self.words)))


def corpus_blocks(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """Blocks with their texts as codes and their distinct words with counts, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block(TaskContext.get().partitionId() << 32)
        for batch in batches:
            texts = batch.column(1).to_numpy(zero_copy_only=False)
            for lang, text in zip(batch.column(0).to_pylist(), texts):
                block.add(text, lang)
                if block.size >= BLOCK_BYTES or len(block.words) >= BLOCK_WORDS:
                    yield from block.records()
                    block = _Block(block.number + 1)
        if block.codes:
            yield from block.records()

    rows = df.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), as_bytes(text_col).alias("text"))
    schema = "block long, codes binary, first int, langs array<string>, words array<binary>, counts array<long>"
    return cut_lineage(rows.mapInArrow(freed(run), schema))


def numbered_words(entries: DataFrame, least: int) -> DataFrame:
    """(lang, word, n, id) of the words with ``least`` occurrences; ids run from 1."""
    words = entries.groupBy("lang", "word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    words = cut_lineage(words.withColumn("at", F.monotonically_increasing_id()))
    # Within a partition the numbers have no gaps; the partitions are set one behind another.
    part = F.shiftright("at", 33)
    sizes = words.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    reached, base = 1, []
    for size in sizes:
        base.append((size["part"], reached))
        reached += size["n"]
    bases = words.sparkSession.createDataFrame(base, "part long, base long")
    place = F.col("at").bitwiseAND((1 << 33) - 1)
    numbered = words.withColumn("part", part).join(with_small(bases, len(base)), "part")
    return numbered.select("lang", "word", "n", (F.col("base") + place).alias("id"))


def numbered_blocks(given: DataFrame, entries: DataFrame, words: DataFrame) -> DataFrame:
    """(block, ids): the texts of each block as ids of frequent words, 0 for all others."""
    answers = entries.join(words.select("lang", "word", "id"), ["lang", "word"]).select(F.col("block").alias("home"), "code", "id")

    def number(texts: pa.Table, answers: pa.Table) -> pa.Table:
        blocks, ids = [], []
        codes, found = answers.column("code").to_numpy(), answers.column("id").to_numpy()
        for block, data in zip(texts.column("block").to_pylist(), texts.column("codes").to_pylist()):
            here = unpacked(data)
            of = np.zeros(max(int(here.max(initial=0)), int(codes.max(initial=0))) + 1, np.uint32)
            of[codes] = found
            blocks.append(block)
            ids.append(packed(of[here]))
        return pa.table({"block": pa.array(blocks, pa.int64()), "ids": pa.array(ids, pa.binary())})

    coded = given.filter("codes is not null").select("block", "codes").groupBy("block").cogroup(answers.groupBy("home"))
    return cut_lineage(coded.applyInArrow(number, "block long, ids binary"))


@dataclass(frozen=True)
class Layout:
    """Sizes of the filters of n-grams: ``bits`` of a word id, ``ranges`` bits of a range.

    An n-gram has two halves of ``half`` bits. The quotient is the upper part of the left
    one; the remainder is all the rest.
    """

    n: int
    bits: int
    ranges: int

    @property
    def half(self) -> int:
        return -(-self.n * self.bits // 2)

    @property
    def quotient(self) -> int:
        # What is left of the left half has 32 bits at most.
        return min(self.half, max(self.ranges + SLOTS, self.half - 32))

    def of(self, words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The permuted halves of n-grams, given as their words' ids."""
        half, bits = np.uint64(self.half), np.uint64(self.bits)
        low = (words[-2].astype(np.uint64) << bits) | words[-1].astype(np.uint64)
        left, right = low >> half, low & self._mask()
        if self.n == 3:
            left |= words[0].astype(np.uint64) << np.uint64(2 * self.bits - self.half)
        for turn in range(4):
            left, right = right, left ^ self._draw(right, turn)
        return left, right

    def words(self, left: np.ndarray, right: np.ndarray) -> list[np.ndarray]:
        """The words' ids of permuted halves."""
        for turn in reversed(range(4)):
            left, right = right ^ self._draw(left, turn), left
        shift = np.uint64(2 * self.bits - self.half)
        low = right | (left & ((np.uint64(1) << shift) - np.uint64(1))) << np.uint64(self.half)
        mask = np.uint64((1 << self.bits) - 1)
        first = [left >> shift] if self.n == 3 else []
        return [part.astype(np.int64) for part in (*first, low >> np.uint64(self.bits), low & mask)]

    def _mask(self) -> np.uint64:
        return np.uint64((1 << self.half) - 1)

    def _draw(self, half: np.ndarray, turn: int) -> np.ndarray:
        return mix(half + np.uint64(0x9E3779B97F4A7C15 * (turn + 1) & (1 << 64) - 1)) & self._mask()

    def sorted(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """An order by both halves, and where in that order a new n-gram begins."""
        if 2 * self.half <= 64:
            key = left << np.uint64(self.half) | right
            order = np.argsort(key, kind="stable")
            key = key[order]
            new = key[1:] != key[:-1]
        else:
            order = np.lexsort((right, left))
            new = (left[order][1:] != left[order][:-1]) | (right[order][1:] != right[order][:-1])
        return order, np.concatenate([[True], new]) if len(order) else np.zeros(0, bool)


def pieces(left: np.ndarray, right: np.ndarray, counts: np.ndarray, layout: Layout) -> Iterator[tuple]:
    """A filter of sorted n-grams in its pieces: (range, n, runs, left, right, high, counts)."""
    rest = np.uint64(layout.half - layout.quotient)
    slots = layout.quotient - min(layout.ranges, layout.quotient)
    quotient = (left >> rest).astype(np.int64)
    owner = quotient >> slots
    starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else []
    for start, stop in zip(starts, [*starts[1:], len(owner)]):
        here, own = slice(start, stop), int(owner[start])
        runs = np.bincount(quotient[here] - (own << slots), minlength=1 << slots)
        low = left[here] & ((np.uint64(1) << rest) - np.uint64(1))
        high = right[here] >> np.uint64(32)
        yield own, int(stop - start), *(packed(x) for x in (runs, low, right[here] & np.uint64(0xFFFFFFFF), high, counts[here]))


def opened(own: int, runs: bytes, low: bytes, right: bytes, high: bytes, layout: Layout) -> tuple[np.ndarray, np.ndarray]:
    """The halves of a piece's n-grams, in order."""
    slots = layout.quotient - min(layout.ranges, layout.quotient)
    runs = unpacked(runs)
    quotient = np.repeat(np.arange(len(runs), dtype=np.uint64), runs) + np.uint64(own << slots)
    left = quotient << np.uint64(layout.half - layout.quotient) | unpacked(low).astype(np.uint64)
    return left, unpacked(right).astype(np.uint64) | unpacked(high).astype(np.uint64) << np.uint64(32)


_PIECE = "block long, range long, n int, runs binary, low binary, right binary, high binary, counts binary"
_MERGED = "block long, range long, n int, bits binary, left binary, right binary, counts binary"


def _filter_rows(block: int, left: np.ndarray, right: np.ndarray, layout: Layout) -> list[tuple]:
    order, new = layout.sorted(left, right)
    starts = np.flatnonzero(new)
    counts = np.diff(starts, append=len(order))
    first = order[starts]
    return [(block, *piece) for piece in pieces(left[first], right[first], counts, layout)]


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [field.split() for field in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.table([pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields)], names=[name for name, _ in fields])


def _runs(ids: np.ndarray, n: int) -> np.ndarray:
    """Where n frequent words of one piece of text begin."""
    good = ids > 0
    found = good[: len(ids) - n + 1].copy()
    for step in range(1, n):
        found &= good[step : len(ids) - n + 1 + step]
    return np.flatnonzero(found)


def merged(least: int, layout: Layout) -> Callable:
    """Merges the pieces of a range: a row with the n-grams that reach ``least``, and for
    every piece a row with a bit per n-gram that says whether it did."""

    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        halves = [opened(r["range"], r["runs"], r["low"], r["right"], r["high"], layout) for r in rows]
        left, right = (np.concatenate([h[at] for h in halves]) for at in (0, 1))
        counts = np.concatenate([unpacked(r["counts"]) for r in rows]).astype(np.int64)
        order, new = layout.sorted(left, right)
        starts = np.flatnonzero(new)
        total = np.add.reduceat(counts[order], starts)
        enough = total >= least
        kept = np.empty(len(order), bool)
        kept[order] = np.repeat(enough, np.diff(starts, append=len(order)))
        first = order[starts[enough]]
        own = rows[0]["range"]
        out = [(None, own, int(enough.sum()), None, left[first].tobytes(), right[first].tobytes(), total[enough].tobytes())]
        at = 0
        for r in rows:
            bits = np.packbits(kept[at : at + r["n"]]).tobytes()
            out.append((r["block"], own, r["n"], bits, None, None, None))
            at += r["n"]
        return _table(out, _MERGED)

    return run


def grams(found: DataFrame, layout: Layout) -> DataFrame:
    """(w1, ..., wn, n): the n-grams that merges kept, back as the ids of their words."""
    names = [f"w{at + 1}" for at in range(layout.n)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right, counts in zip(*(batch.column(at).to_pylist() for at in range(3))):
                words = layout.words(np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, words), pa.array(np.frombuffer(counts, np.int64))], names=[*names, "n"]
                )

    kept = found.filter("block is null and n > 0").select("left", "right", "counts")
    return kept.mapInArrow(freed(run), ", ".join(f"{name} long" for name in [*names, "n"]))


def frequent_grams(texts: DataFrame, least: int, bits: int, tokens: int, size: int = RANGE) -> tuple[DataFrame, DataFrame]:
    """The pairs and the triples with ``least`` occurrences, written."""
    ranges = max(0, (-(-tokens // size) - 1).bit_length())
    two, three = Layout(2, bits, ranges), Layout(3, bits, ranges)
    if max(two.ranges, bits) > 32:
        raise ValueError("more than 2**32 frequent words or ranges")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = unpacked(data)
                at = _runs(ids, 2)
                yield from _table(_filter_rows(block, *two.of([ids[at], ids[at + 1]]), two), _PIECE).to_batches()

    def triples(own: pa.Table, answers: pa.Table) -> pa.Table:
        answers = answers.sort_by("range")
        rows = []
        for block, data in zip(own.column("block").to_pylist(), own.column("ids").to_pylist()):
            ids = unpacked(data)
            at = _runs(ids, 2)
            order, new = two.sorted(*two.of([ids[at], ids[at + 1]]))
            bits = [
                np.unpackbits(np.frombuffer(part, np.uint8), count=n)
                for part, n in zip(answers.column("bits").to_pylist(), answers.column("n").to_pylist())
            ]
            kept = np.concatenate([*bits, np.zeros(0, np.uint8)]).astype(bool)
            if len(kept) != np.count_nonzero(new):
                raise RuntimeError("a block's pairs were not all answered")
            good = np.zeros(len(ids) + 1, bool)
            good[at[order]] = kept[np.cumsum(new) - 1]
            at = np.flatnonzero(good[:-1] & good[1:])
            rows += _filter_rows(block, *three.of([ids[at], ids[at + 1], ids[at + 2]]), three)
        return _table(rows, _PIECE)

    found = cut_lineage(texts.mapInArrow(freed(pairs), _PIECE).groupBy("range").applyInArrow(merged(least, two), _MERGED))
    answers = found.filter("block is not null").select("block", "range", "n", "bits")
    sent = texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(triples, _PIECE)
    more = sent.groupBy("range").applyInArrow(merged(least, three), _MERGED).filter("block is null")
    return cut_lineage(grams(found, two)), cut_lineage(grams(more, three))


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exactly."""
    wide = lambda column: column.cast("decimal(18,0)")
    top = F.lit(1_000_000).cast("decimal(7,0)") * wide(a) * a.cast("decimal(13,0)")
    return F.call_function("div", top, wide(left) * wide(right))


def collocations(
    df: DataFrame, least: int = 10, first: int = 2_000, text_col: str = "text", lang_col: str = "lang", size: int = RANGE
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``first`` phrases.

    Phrases have two or three words within a piece of text. ``n`` counts all words of the
    language, ``a`` the phrase, ``l`` and ``r`` the two parts of its lowest-scoring cut;
    of equal cuts the one behind fewer words counts. A pair is left out if a triple that
    holds it has at least half as many occurrences. A null language is ``und``, a null or
    empty text has no words; repeated rows count each; a language without candidates and
    an empty table give no rows; ids and other columns are not read. Equal scores and
    counts are ranked by the phrase's bytes. Texts of any length are counted whole.
    """
    given = corpus_blocks(df, text_col, lang_col)
    entry = F.posexplode(F.arrays_zip("langs", "words", "counts")).alias("at", "entry")
    entries = given.filter("codes is null").select("block", "first", entry).select(
        "block", (F.col("first") + F.col("at")).alias("code"), F.col("entry.langs").alias("lang"), F.col("entry.words").alias("word"), F.col("entry.counts").alias("n")
    )
    totals = cut_lineage(entries.groupBy("lang").agg(F.sum("n").alias("total")))
    words = cut_lineage(numbered_words(entries, least))
    known = words.agg(F.coalesce(F.max("id"), F.lit(0)).alias("id"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    texts = numbered_blocks(given, entries, words)
    pairs, triples = frequent_grams(texts, least, max(1, int(known["id"]).bit_length()), int(known["n"]), size)

    def named(at: int) -> DataFrame:
        return words.select(F.col("id").alias(f"w{at}"), F.col("word").alias(f"word{at}"), F.col("n").alias(f"n{at}"), F.col("lang").alias(f"lang{at}"))

    of = lambda *at: pairs.select(F.col("w1").alias(f"w{at[0]}"), F.col("w2").alias(f"w{at[1]}"), F.col("n").alias(f"n{at[0]}{at[1]}"))
    longer = (
        triples.select("w1", "w2", "n")
        .union(triples.select("w2", "w3", "n"))
        .groupBy("w1", "w2")
        .agg(F.max("n").alias("longer"))
    )
    two = (
        pairs.join(longer, ["w1", "w2"], "left")
        .filter("longer is null or 100 * longer < 50 * n")
        .join(named(1), "w1")
        .join(named(2), "w2")
        .select(
            F.col("lang1").alias("lang"), F.array("word1", "word2").alias("words"), F.col("n").alias("a"),
            F.array(F.struct(_score(F.col("n"), F.col("n1"), F.col("n2")).alias("score"), F.lit(1).alias("k"), F.col("n1").alias("l"), F.col("n2").alias("r"))).alias("cuts"),
        )
    )
    three = (
        triples.join(of(1, 2), ["w1", "w2"])
        .join(of(2, 3), ["w2", "w3"])
        .join(named(1), "w1")
        .join(named(2), "w2")
        .join(named(3), "w3")
        .select(
            F.col("lang1").alias("lang"), F.array("word1", "word2", "word3").alias("words"), F.col("n").alias("a"),
            F.array(
                F.struct(_score(F.col("n"), F.col("n1"), F.col("n23")).alias("score"), F.lit(1).alias("k"), F.col("n1").alias("l"), F.col("n23").alias("r")),
                F.struct(_score(F.col("n"), F.col("n12"), F.col("n3")).alias("score"), F.lit(2).alias("k"), F.col("n12").alias("l"), F.col("n3").alias("r")),
            ).alias("cuts"),
        )
    )
    scored = two.unionByName(three).select(
        "lang", F.array_join(F.transform("words", lambda w: w.cast("string")), " ").alias("phrase"), "a", F.array_min("cuts").alias("cut")
    ).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    best = [F.desc("score"), F.desc("a"), "phrase"]
    # A language may hold most candidates: its parts are ranked first, and only their best meet.
    part = Window.partitionBy("lang", "salt").orderBy(*best)
    scored = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    scored = scored.withColumn("place", F.row_number().over(part)).filter(F.col("place") <= first)
    whole = Window.partitionBy("lang").orderBy(*best)
    ranked = scored.withColumn("rank", F.row_number().over(whole).cast("long")).filter(F.col("rank") <= first)
    return ranked.join(F.broadcast(totals) if totals.count() < 100_000 else totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
grams AS (SELECT lang, 1 AS k, unnest(list_transform(w, lambda x: [x])) AS g FROM words
    UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i:i + 1])) FROM words
    UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) FROM words),
counted AS (SELECT lang, k, g, count(*) AS f FROM grams GROUP BY lang, k, g),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE k = 1 GROUP BY lang),
candidates AS (SELECT * FROM counted WHERE k > 1 AND f >= 10),
cuts AS (SELECT c.lang, c.g, c.f AS a, cut, x.f AS l, y.f AS r,
    (1000000::HUGEINT * c.f * c.f // (x.f::HUGEINT * y.f))::BIGINT AS score
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
    JOIN counted x ON x.lang = c.lang AND x.g = c.g[1:cut] JOIN counted y ON y.lang = c.lang AND y.g = c.g[cut + 1:c.k]),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
longer AS (SELECT lang, part, max(f) AS f FROM (SELECT lang, f, unnest([g[1:2], g[2:3]]) AS part FROM candidates WHERE k = 3) GROUP BY lang, part),
kept AS (SELECT lowest.* FROM lowest LEFT JOIN longer ON longer.lang = lowest.lang AND part = g WHERE longer.f IS NULL OR 100 * longer.f < 50 * a),
ranked AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score FROM kept)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM ranked JOIN totals USING (lang) QUALIFY rank <= 2000
"""
