"""Filter interaction audit: an incremental, retracting count of filter masks (operator 12).

All files of the documents go through a streaming query in available-now micro-batches.
Four filters look at one text; the fifth asks whether a smaller id has the same text, so
its answer can change as files arrive. State keyed by the text's digest holds the smallest
id so far and what the rows at that id were counted under; a
row of the state store holds the few hundred texts whose digests hash alike. When a smaller
id comes, those rows are taken back from the counters of their old mask and counted under
the new one.
Before the state, every partition sums up its rows of the same text, so a text that a
third of all rows share sends a few rows per partition. The deltas go to a file sink; their
sum is, for every part, the number of documents under each mask, from which the effect of
every filter in every order follows.
"""

from __future__ import annotations

import hashlib
import itertools
import pickle
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from llm.common import as_bytes, slices, table
from skuweave.session import new_folder

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
# Fixed value: the characters that filter D looks for.
_SYMBOLS = b"#$%&*|"

#: Micro-batches that the present files are dealt to.
ROUNDS = 4
#: Texts that share a row of the state store, if all rows had different texts.
TEXTS = 256
#: Rows that a task sums up at a time.
CHUNK = 200_000

_JUDGED = "id long, part string, flags int, key binary, mask int"
_SUMMED = "key binary, part string, numbers array<long>"
_DELTAS = "part string, mask int, flags int, n long"
_STATE = "texts binary"


def text_mask(text: bytes, points: int) -> int:
    """Bits of the filters A to D that a text fails."""
    words = text.split()
    return (
        (len(words) < 50)
        | (100 * len(set(words)) < 65 * len(words)) << 1
        | (100 * (len(text) - len(text.translate(None, _UPPER))) > 5 * points) << 2
        | (len(text.translate(None, _SYMBOLS)) < len(text)) << 3
    )


def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, part, flags, text) as (id, part, flags, digest of the text, mask)."""

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        points = pc.utf8_length(batch.column(3)).to_pylist()
        texts = batch.column(3).cast(pa.binary()).to_numpy(zero_copy_only=False)
        keys = [hashlib.sha256(text).digest() for text in texts]
        masks = [text_mask(text, n) for text, n in zip(texts, points)]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(keys, pa.binary()), pa.array(masks, pa.int32())],
            names=["id", "part", "flags", "key", "mask"],
        )

    for batch in batches:
        yield from slices(batch, judge)


def summed_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per text, part and flags of a chunk.

    ``numbers`` holds mask, flags, whether there is an id, the smallest id, the rows that
    have it, the rows with larger ids, and the rows without id.
    """

    def emit(found: dict) -> Iterator[pa.RecordBatch]:
        rows = list(found.items())
        for at in range(0, len(rows), 10_000):
            some = rows[at : at + 10_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([key for (key, _, _), _ in some], pa.binary()),
                    pa.array([part for (_, part, _), _ in some], pa.string()),
                    pa.array([numbers for _, numbers in some], pa.list_(pa.int64())),
                ],
                names=["key", "part", "numbers"],
            )

    found: dict[tuple, list] = {}
    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("key", "part", "flags", "id", "mask")]
        for key, part, flags, id_, mask in zip(*columns):
            numbers = found.setdefault((key, part, flags), [mask, flags, 0, 0, 0, 0, 0])
            if id_ is None:
                numbers[6] += 1
            elif not numbers[2]:
                numbers[2:5] = 1, id_, 1
            elif id_ < numbers[3]:
                numbers[5] += numbers[4]
                numbers[3:5] = id_, 1
            elif id_ == numbers[3]:
                numbers[4] += 1
            else:
                numbers[5] += 1
        if len(found) >= CHUNK:
            yield from emit(found)
            found = {}
    yield from emit(found)


def revise(low: int | None, holders: dict, arrived: Iterable[tuple]) -> tuple[int | None, dict, dict]:
    """The new smallest id of a text, the rows that hold it, and the deltas of the counters.

    ``holders`` maps (part, flags) to the rows at the smallest id, ``arrived`` has (part,
    numbers) rows as ``summed_up`` gives them. Deltas map (part, mask, flags) to a number.
    """
    deltas: dict[tuple, int] = defaultdict(int)
    for part, (mask, flags, has_id, least, at_least, more, without) in arrived:
        mask, flags = int(mask), int(flags)
        deltas[part, mask, flags] += without
        deltas[part, mask | COPY, flags] += more
        if not has_id:
            continue
        if low is None or least < low:
            for (old_part, old_flags), n in holders.items():
                deltas[old_part, mask, old_flags] -= n
                deltas[old_part, mask | COPY, old_flags] += n
            low, holders = int(least), {}
        if least == low:
            deltas[part, mask, flags] += at_least
            holders[part, flags] = holders.get((part, flags), 0) + int(at_least)
        else:
            deltas[part, mask | COPY, flags] += at_least
    return low, holders, {key: int(n) for key, n in deltas.items() if n}


def retract(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Revise the texts of a state row that have arrived again or first, and emit the deltas.

    The state maps digests to the smallest id and its holders.
    """
    texts = pickle.loads(state.get[0]) if state.exists else {}
    arrived = defaultdict(list)
    for frame in frames:
        for digest, part, numbers in zip(frame["key"], frame["part"], frame["numbers"]):
            arrived[bytes(digest)].append((part, numbers.tolist()))
    total: dict[tuple, int] = defaultdict(int)
    for digest, rows in arrived.items():
        low, holders, deltas = revise(*texts.get(digest, (None, {})), rows)
        if low is not None:
            texts[digest] = low, holders
        for what, n in deltas.items():
            total[what] += n
    state.update((pickle.dumps(texts),))
    found = [(*what, n) for what, n in total.items() if n]
    if found:
        yield pd.DataFrame(found, columns=["part", "mask", "flags", "n"])


def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum the deltas of a task before they are written."""
    total: dict[tuple, int] = defaultdict(int)
    for batch in batches:
        for part, mask, flags, n in zip(*(column.to_pylist() for column in batch.columns)):
            total[part, mask, flags] += n
    rows = [(*key, n) for key, n in total.items() if n]
    for at in range(0, len(rows), 50_000):
        columns = list(zip(*rows[at : at + 50_000]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), *(pa.array(c, k) for c, k in zip(columns[1:], (pa.int32(), pa.int32(), pa.int64())))],
            names=["part", "mask", "flags", "n"],
        )


def flagged(labels: DataFrame) -> DataFrame:
    """(id, flags): bit 0 where some label row has quality 1, bit 1 where one has toxic 1."""
    bit = lambda name, value: F.max(F.when(F.col(name) == 1, F.lit(value)).otherwise(F.lit(0)))
    return (
        labels.filter("doc_id is not null")
        .groupBy(F.col("doc_id").alias("id"))
        .agg((bit("quality", 1) + bit("toxic", 2)).alias("flags"))
    )


def mask_counts(
    spark: SparkSession,
    path: str,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
    rounds: int = ROUNDS,
    folder: str | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """(part, mask, flags, n): the documents below ``path`` under each mask.

    Bit i of a mask is set where filter i fails. A null text is empty, a null part is the
    empty string. A row without id is no copy of a smaller one and makes no other row a
    copy; equal ids with equal texts are not copies of each other; repeated rows count
    each. Empty tables give no rows; other columns are not read. ``folder`` holds state,
    progress and deltas: files that arrive later are counted by another call with the
    same folder, and a call that broke off is resumed by one. Such calls pass the same
    ``buckets``, the rows of the state store, by default one for 256 of the present rows.
    """
    folder = folder or new_folder(spark)
    given = spark.read.parquet(path)
    files = len(given.inputFiles())
    buckets = buckets or -(-given.count() // TEXTS) or 1
    # A table may be one file or a folder of files; a pattern takes either.
    stream = (
        spark.readStream.schema(given.schema)
        .option("maxFilesPerTrigger", max(1, -(-files // rounds)))
        .parquet(f"{path[:-1]}[{path[-1]}]")
    )
    rows = stream.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    rows = rows.select("id", "part", F.lit(0).alias("flags"), "text").mapInArrow(judged, _JUDGED).drop("flags")
    rows = rows.join(flagged(labels), "id", "left").select(
        "id", "part", F.coalesce("flags", F.lit(0)).alias("flags"), "key", "mask"
    )
    deltas = (
        rows.mapInArrow(summed_up, _SUMMED)
        .withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
        .groupBy("bucket")
        .applyInPandasWithState(retract, _DELTAS, _STATE, "append", GroupStateTimeout.NoTimeout)
        .mapInArrow(merged, _DELTAS)
    )
    query = (
        deltas.writeStream.format("parquet")
        .option("path", f"{folder}/deltas")
        .option("checkpointLocation", f"{folder}/progress")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    found = spark.read.schema(_DELTAS).parquet(f"{folder}/deltas")
    return found.groupBy("part", "mask", "flags").agg(F.sum("n").alias("n")).filter("n <> 0")


def steps() -> list[tuple[str, int, str]]:
    """(order, step, its filter) of all orders."""
    orders = ("".join(order) for order in itertools.permutations(FILTERS))
    return [(order, at, letter) for order in orders for at, letter in enumerate(order, 1)]


def _bits(letters: str) -> int:
    return sum(1 << FILTERS.index(letter) for letter in letters)


def interactions(counts: DataFrame) -> DataFrame:
    """One row per part, order and step from (part, mask, flags, n).

    A part has 32 counters, so what every order does to it is a sum over them.
    """
    size = 1 << len(FILTERS)
    counter = lambda condition: F.array(
        *(F.coalesce(F.sum(F.when((F.col("mask") == m) & condition, F.col("n"))), F.lit(0)) for m in range(size))
    )
    parts = counts.groupBy("part").agg(
        counter(F.lit(True)).alias("n"),
        counter(F.col("flags").bitwiseAND(1) > 0).alias("good"),
        counter(F.col("flags").bitwiseAND(2) > 0).alias("toxic"),
    )
    every = F.array(
        *(
            F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(_bits(f)).alias("own"), F.lit(_bits(o[: s - 1])).alias("before"))
            for o, s, f in steps()
        )
    )
    rows = parts.select("*", F.explode(every).alias("at")).select("part", "n", "good", "toxic", "at.*")
    own, before = F.col("own"), F.col("before")

    def total(counter: str, holds) -> Column:
        masks = F.sequence(F.lit(0), F.lit(size - 1))
        add = lambda sum_, m: sum_ + F.when(holds(m), F.element_at(counter, m + 1)).otherwise(F.lit(0))
        return F.aggregate(masks, F.lit(0).cast("long"), add)

    removed = lambda m: (m.bitwiseAND(own) != 0) & (m.bitwiseAND(before) == 0)
    share = lambda m: F.lit(len(steps()) // len(FILTERS)) / F.bit_count(m)
    return rows.select(
        "part",
        "filter_order",
        "step",
        total("n", lambda m: m.bitwiseAND(own.bitwiseOR(before)) == 0).alias("kept"),
        total("n", removed).alias("removed"),
        total("n", lambda m: (m.bitwiseAND(own) != 0) & (m.bitwiseAND(before) != 0)).alias("redundant"),
        F.element_at("n", own + 1).alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"),
        # A document that fails k filters is removed by each of them in a k-th of the orders.
        F.aggregate(
            F.sequence(F.lit(0), F.lit(size - 1)),
            F.lit(0).cast("long"),
            lambda sum_, m: sum_
            + F.when(m.bitwiseAND(own) != 0, F.element_at("n", m + 1) * share(m).cast("long")).otherwise(F.lit(0)),
        ).alias("shapley"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions(mask_counts(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels")))


_WORDS = r"list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '')"

ORACLE_SQL = rf"""
WITH docs AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
words AS (SELECT *, {_WORDS} AS words, min(doc_id) OVER (PARTITION BY text) AS low FROM docs),
flags AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
    max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
judged AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, [
    len(words) < 50,
    100 * len(list_distinct(words)) < 65 * len(words),
    100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text),
    regexp_matches(text, '[#$%&*|]'),
    coalesce(low < doc_id, false)] AS fails
    FROM words LEFT JOIN flags USING (doc_id)),
counted AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY part, fails),
letters AS (SELECT unnest([1, 2, 3, 4, 5]) AS f),
orders AS (SELECT [a.f, b.f, c.f, d.f, e.f] AS o FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (SELECT o, s, o[s] AS f, o[1:s - 1] AS before FROM orders, (SELECT unnest([1, 2, 3, 4, 5])::INT AS s)),
told AS (SELECT part, array_to_string(list_transform(o, lambda x: substr('ABCDE', x, 1)), '') AS filter_order, s AS step, f, n, good, toxic,
    fails[f] AS own, len(list_filter(before, lambda x: fails[x])) > 0 AS gone,
    len(list_filter(fails, lambda x: x)) AS failed FROM steps, counted),
report AS (SELECT part, filter_order, step, any_value(f) AS f,
    sum(CASE WHEN NOT own AND NOT gone THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN own AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN own AND gone THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN own AND failed = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN own AND NOT gone THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN own AND NOT gone THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
    FROM told GROUP BY part, filter_order, step)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM report
"""
