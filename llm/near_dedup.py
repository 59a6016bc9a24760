"""MinHash near-dedup with sequential Bayesian verification (operator 2).

Documents with equal sets of word shingles are one class. MinHash signatures of the
classes are cut into bands; classes that agree in a band are candidates. Candidates
are compared signature batch by signature batch: a pair is given up as soon as the
posterior probability that its similarity reaches the threshold falls below the
chosen miss probability. What survives is verified on the full sets.

Inside a bucket of a band, members are compared with one leader first. Only members
that this leaves in different components are compared with each other afterwards, by
longer signatures and in bounded cells of a task, so that a large group of copies
costs a verification per member and band, not per pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import as_bytes, freed, map_batches, mix, table, windows, with_small, word_codes
from skuweave.session import cut_lineage


@dataclass(frozen=True)
class Likeness:
    """What counts as near. A pair at the threshold shares no band with probability
    ``(1 - threshold ** rows) ** bands``, which is 2e-6 here, and is pruned wrongly
    with probability ``miss`` in each comparison of a batch."""

    words: int = 5
    percent: int = 75
    bands: int = 48
    rows: int = 5
    batch: int = 48
    miss: float = 1e-7
    seed: int = 11
    # Hashes, of one byte each, that further tell apart the members of a bucket whose
    # leader did not settle it, and rows of a bucket that meet in one task.
    more: int = 720
    cell: int = 4_096

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


def least_matches(how: Likeness, stages: Sequence[int] | None = None) -> list[tuple[int, int]]:
    """(hashes compared, matches needed) after each batch.

    With a uniform prior, ``m`` matches among ``n`` leave a posterior of
    Beta(m + 1, n - m + 1), which exceeds t with the probability that a binomial of
    n + 1 trials with chance t gives at most m.
    """
    limits = []
    yes, no = math.log(how.percent / 100), math.log(1 - how.percent / 100)
    for seen in stages or range(how.batch, how.hashes + 1, how.batch):
        total = 0.0
        for m in range(seen + 1):
            ways = math.lgamma(seen + 2) - math.lgamma(m + 1) - math.lgamma(seen + 2 - m)
            total += math.exp(ways + m * yes + (seen + 1 - m) * no)
            if total >= how.miss:
                limits.append((seen, m))
                break
    return limits


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's word shingles, A-Z in lower case.

    A text with fewer words has its whole sequence as the one shingle.
    """
    known: dict[bytes, int] = {}
    codes, lengths = word_codes([text.lower() for text in texts], known)
    hashes = np.fromiter((xxhash.xxh64_intdigest(word) for word in known), np.uint64, len(known))
    flat = hashes[codes]
    rolled, counts = windows(flat, lengths, size)
    sets, at, word = [], 0, 0
    for count, length in zip(counts, lengths):
        if length == 0:
            sets.append(np.zeros(0, np.uint64))
        elif length < size:
            short = np.full(1, length, np.uint64)
            for value in flat[word : word + length]:
                short = short * np.uint64(0x9E3779B97F4A7C15) + value
            sets.append(mix(short))
        else:
            sets.append(np.unique(rolled[at : at + count]))
        at += count
        word += length
    return sets


def set_key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh128_digest(shingles.tobytes())


def signatures(sets: list[np.ndarray], count: int, seed: int) -> np.ndarray:
    """MinHash signatures, the low 16 bits of every minimum: (sets, count)."""
    draw = np.random.default_rng(seed)
    first = draw.integers(0, 1 << 32, count, np.uint32) | np.uint32(1)
    second = draw.integers(0, 1 << 32, count, np.uint32) | np.uint32(1)
    lengths = np.array([len(s) for s in sets])
    starts = np.cumsum(lengths) - lengths
    flat = np.concatenate(sets)
    high, low = (flat >> np.uint64(32)).astype(np.uint32), flat.astype(np.uint32)
    out = np.empty((len(sets), count), np.uint16)
    for at in range(count):
        out[:, at] = np.minimum.reduceat((high * first[at]) ^ (low * second[at]), starts)
    return out


def describe(df: DataFrame, how: Likeness, id_col: str, text_col: str) -> DataFrame:
    """(id, n, key, sig) per row; key and sig are null for an empty set."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column(1).to_pylist(), how.words)
        full = [at for at, s in enumerate(sets) if len(s)]
        keys: list[bytes | None] = [None] * len(sets)
        signs: list[bytes | None] = [None] * len(sets)
        if full:
            for at, row in zip(full, signatures([sets[at] for at in full], how.hashes, how.seed)):
                keys[at], signs[at] = set_key(sets[at]), row.tobytes()
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(keys, pa.binary()),
                pa.array(signs, pa.binary()),
            ],
            names=["id", "n", "key", "sig"],
        )

    rows = df.select(F.col(id_col).alias("id"), as_bytes(text_col).alias("text"))
    return map_batches(rows, run, f"id {kind}, n long, key binary, sig binary")


def buckets(classes: DataFrame, how: Likeness) -> DataFrame:
    """(bucket, band, node, n, leader) for the members of all buckets with two or more."""
    width = 2 * how.rows
    band = F.explode(F.sequence(F.lit(0), F.lit(how.bands - 1)))
    placed = classes.select("node", "n", "sig", band.alias("band")).select(
        F.xxhash64("band", F.expr(f"substring(sig, band * {width} + 1, {width})")).alias("bucket"),
        "band",
        "node",
        "n",
    )
    shared = (
        placed.groupBy("bucket")
        .agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("members"))
        .filter("members > 1")
        .select("bucket", "leader")
    )
    return placed.join(shared, "bucket")


def parts_for(rows: int, each: int) -> int:
    return max(1, -(-rows // each))


def near_in_size(a: str | Column, b: str | Column, how: Likeness) -> Column:
    """No set pair with sizes further apart reaches the threshold."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * how.percent


def survivors(pairs: DataFrame, classes: DataFrame, how: Likeness) -> DataFrame:
    """The pairs (a, b) that no batch of their signatures rules out."""
    limits = least_matches(how)
    signs = classes.select("node", "sig")
    joined = (
        pairs.join(signs.withColumnsRenamed({"node": "a", "sig": "sig_a"}), "a")
        .join(signs.withColumnsRenamed({"node": "b", "sig": "sig_b"}), "b")
        .select("a", "b", "sig_a", "sig_b")
    )

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        left, right = (
            np.frombuffer(b"".join(batch.column(at).to_pylist()), np.uint16).reshape(-1, how.hashes)
            for at in (2, 3)
        )
        alive = np.arange(batch.num_rows)
        matches = np.zeros(batch.num_rows, np.int64)
        start = 0
        for seen, needed in limits:
            matches[alive] += (left[alive, start:seen] == right[alive, start:seen]).sum(1)
            alive = alive[matches[alive] >= needed]
            start = seen
        return batch.select(["a", "b"]).take(pa.array(alive))

    return map_batches(joined, run, "a long, b long")


def texts_of(
    nodes: DataFrame, classes: DataFrame, df: DataFrame, how: Likeness, id_col: str, text_col: str, files: int
) -> DataFrame:
    """(node, text) for the classes in ``nodes``, one text for each, in ``files`` files.

    Only their texts are fetched; where the number of nodes allows it, their ids are
    broadcast so that no other text is shuffled.
    """
    keyed = cut_lineage(nodes.distinct().join(classes.select("node", "holder", "key"), "node").coalesce(files))
    wanted = with_small(keyed, 4 * keyed.count())
    rows = df.select(F.col(id_col).alias("id"), as_bytes(text_col).alias("text"))
    texts = rows.join(wanted, rows["id"].eqNullSafe(wanted["holder"])).select("node", "key", "text")

    # Rows that repeat an id hold other texts or the same one again.
    def own(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = [set_key(s) for s in shingle_sets(batch.column(2).to_pylist(), how.words)]
        right = [a == b for a, b in zip(keys, batch.column(1).to_pylist())]
        return batch.filter(pa.array(right, pa.bool_())).select(["node", "text"])

    return cut_lineage(map_batches(texts, own, "node long, text binary").dropDuplicates(["node"]).coalesce(files))


def confirmed(pairs: DataFrame, texts: DataFrame, how: Likeness) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold."""
    joined = (
        pairs.join(texts.withColumnsRenamed({"node": "a", "text": "text_a"}), "a")
        .join(texts.withColumnsRenamed({"node": "b", "text": "text_b"}), "b")
        .select("a", "b", "text_a", "text_b")
    )

    def check(batch: pa.RecordBatch) -> pa.RecordBatch:
        left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        different = list({*left, *right})
        sets = dict(zip(different, shingle_sets(different, how.words)))
        linked = []
        for a, b in zip(left, right):
            both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            linked.append(100 * both >= how.percent * (len(sets[a]) + len(sets[b]) - both))
        return batch.filter(pa.array(linked, pa.bool_())).select(["a", "b"])

    return map_batches(joined, check, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of an edge; label is the smallest node reachable.

    In each round every node with a smaller neighbour is merged into the smallest one,
    these merges are followed to their ends, and the edges are drawn anew between what
    is left. Edges and nodes shrink from round to round; each round is written to the
    shared folder, in as many files as the number of edges calls for.
    """
    edges = edges.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
    edges = cut_lineage(edges.filter("high > low").distinct())
    files = parts_for(edges.count(), 100_000)
    labels = edges.select(F.explode(F.array("high", "low")).alias("node")).distinct()
    labels = cut_lineage(labels.withColumn("label", F.col("node")).coalesce(files))
    while not edges.isEmpty():
        merged = cut_lineage(edges.groupBy("high").agg(F.min("low").alias("to")).coalesce(files))
        while True:
            further = merged.select(F.col("high").alias("to"), F.col("to").alias("end"))
            if merged.join(further, "to", "left_semi").isEmpty():
                break
            followed = merged.join(further, "to", "left").select("high", F.coalesce("end", "to").alias("to"))
            merged = cut_lineage(followed.coalesce(files))
        ends = merged.select(F.col("high").alias("low"), F.col("to").alias("low_to"))
        left = (
            edges.join(merged, "high")
            .join(ends, "low", "left")
            .select(F.col("to").alias("a"), F.coalesce("low_to", "low").alias("b"))
            .filter("a <> b")
            .select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
            .distinct()
        )
        edges = cut_lineage(left.coalesce(files))
        moved = merged.select(F.col("high").alias("label"), "to")
        labels = cut_lineage(
            labels.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label")).coalesce(files)
        )
    return labels


def joined_components(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """The labels after further edges, which are drawn between labels first."""
    named = labels.withColumnRenamed("label", "own")
    ends = edges
    for end in ("a", "b"):
        known = named.select(F.col("node").alias(end), F.col("own").alias(f"{end}_own"))
        ends = ends.join(known, end, "left").withColumn(f"{end}_own", F.coalesce(f"{end}_own", end))
    ends = cut_lineage(ends)
    new = components(ends.select(F.col("a_own").alias("a"), F.col("b_own").alias("b")))
    # Nodes that had no edge before have their own number as label.
    alone = ends.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(named, "node", "left_anti")
    every = named.unionByName(alone.withColumn("own", F.col("node")))
    moved = new.select(F.col("node").alias("own"), "label")
    return cut_lineage(every.join(moved, "own", "left").select("node", F.coalesce("label", "own").alias("label")))


def unsettled(members: DataFrame, labels: DataFrame, files: int) -> DataFrame:
    """Members of the buckets that hold more than one component.

    With each comes its component's label, whether that is the bucket's largest
    component, and how many rows the bucket has in all and beside the largest one.
    """
    named = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    split = (
        named.groupBy("bucket")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .filter("low <> high")
        .select("bucket")
    )
    rows = cut_lineage(named.join(split, "bucket", "left_semi").coalesce(files))
    most = (
        rows.groupBy("bucket", "label")
        .count()
        .groupBy("bucket")
        .agg(
            F.max_by("label", F.struct("count", "label")).alias("main"),
            F.sum("count").alias("size"),
            (F.sum("count") - F.max("count")).alias("minors"),
        )
    )
    return rows.join(most, "bucket").withColumn("minor", F.col("label") != F.col("main"))


def unmatched(rows: DataFrame, signs: DataFrame, how: Likeness) -> DataFrame:
    """Pairs within a bucket, of different components, that no signature rules out.

    Members beside the bucket's largest component are compared with all its members,
    in tasks that hold at most ``cell`` rows of either side, so that a bucket of any
    size is dealt out. A pair that shares several buckets is looked at in the first.
    """
    signed = rows.join(signs, "node")
    columns = ("bucket", "band", "leader", "node", "n", "label", "sig", "more")
    one = F.lit(0).alias("i"), F.lit(0).alias("j")
    cells = lambda rows: F.sequence(F.lit(0), F.floor((F.col(rows) - 1) / how.cell).cast("int"))
    deal = lambda rows: F.pmod(F.xxhash64("node"), F.floor((F.col(rows) - 1) / how.cell).cast("int") + 1).cast("int")
    small = signed.filter(F.col("size") <= how.cell).select(*columns, *one, "minor", F.lit(True).alias("other"))
    large = signed.filter(F.col("size") > how.cell)
    left = large.filter("minor").select(
        *columns, deal("minors").alias("i"), F.explode(cells("size")).alias("j"), F.lit(True), F.lit(False)
    )
    right = large.select(
        *columns, F.explode(cells("minors")).alias("i"), deal("size").alias("j"), F.lit(False), F.lit(True)
    )
    met = small.unionAll(left).unionAll(right)
    cell = ["bucket", "i", "j"]
    seen = list(range(how.batch, how.hashes + 1, how.batch))
    seen += list(range(how.hashes + how.more // 4, how.hashes + how.more + 1, how.more // 4))
    limits = least_matches(how, seen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in cell], 1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            for start, stop in zip([0, *cuts], [*cuts, len(keys)]):
                key = tuple(keys[start])
                if key != last and held:
                    yield _pairs_of(pa.Table.from_batches(held), limits, how)
                    held = []
                last = key
                held.append(batch.slice(start, stop - start))
        if held:
            yield _pairs_of(pa.Table.from_batches(held), limits, how)

    return met.repartition(*cell).sortWithinPartitions(*cell).mapInArrow(freed(run), "a long, b long").distinct()


def _pairs_of(rows: pa.Table, limits: list[tuple[int, int]], how: Likeness) -> pa.RecordBatch:
    node, n, label = (rows.column(c).to_numpy() for c in ("node", "n", "label"))
    leader, band = rows.column("leader")[0].as_py(), rows.column("band")[0].as_py()
    sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint16).reshape(-1, how.hashes)
    more = np.frombuffer(b"".join(rows.column("more").to_pylist()), np.uint8).reshape(-1, how.more)
    minor = rows.column("minor").to_numpy()
    minors = np.flatnonzero(minor & (node != leader))
    others = np.flatnonzero(rows.column("other").to_numpy() & (node != leader))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for start in range(0, len(minors), 64):
        a, b = (x.ravel() for x in np.meshgrid(minors[start : start + 64], others, indexing="ij"))
        near = np.minimum(n[a], n[b]) * 100 >= np.maximum(n[a], n[b]) * how.percent
        # Two minor members meet twice where both are on both sides.
        once = ~minor[b] | (node[a] < node[b])
        keep = near & once & (label[a] != label[b])
        a, b = a[keep], b[keep]
        matches = np.zeros(len(a), np.int64)
        before = 0
        for seen, needed in limits:
            if seen <= how.hashes:
                matches = matches + (sig[a, before:seen] == sig[b, before:seen]).sum(1)
            else:
                span = slice(max(before - how.hashes, 0), seen - how.hashes)
                matches = matches + (more[a, span] == more[b, span]).sum(1)
            keep = matches >= needed
            a, b, matches, before = a[keep], b[keep], matches[keep], seen
        same = (sig[a] == sig[b]).reshape(len(a), how.bands, how.rows).all(2)
        first = same.argmax(1) == band
        found.append((node[a[first]], node[b[first]]))
    a = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64)
    b = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def longer_signatures(texts: DataFrame, how: Likeness) -> DataFrame:
    """(node, more): further MinHashes of full sets, one byte of each."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column(1).to_pylist(), how.words)
        more = signatures(sets, how.more, how.seed + 1).astype(np.uint8)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([row.tobytes() for row in more], pa.binary())], names=["node", "more"]
        )

    return map_batches(texts, run, "node long, more binary")


def with_set_key(df: DataFrame, name: str, how: Likeness = Likeness(), text_col: str = "text") -> DataFrame:
    """``df`` with the key of each text's shingle set, null for an empty set."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column(batch.num_columns - 1).to_pylist(), how.words)
        keys = pa.array([set_key(s) if len(s) else None for s in sets], pa.binary())
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], keys], names=[*batch.schema.names[:-1], name])

    kinds = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in df.schema)
    return map_batches(df.select("*", as_bytes(text_col).alias(name)), run, f"{kinds}, `{name}` binary")


def group_near(
    df: DataFrame, how: Likeness = Likeness(), id_col: str = "doc_id", text_col: str = "text", key_col: str | None = None
) -> DataFrame:
    """(id, n_shingles, component_id, kept, n_links) for every row.

    ``component_id`` is the smallest id reachable over confirmed links, the row's own
    included, and ``kept`` says that the row has it. ``n_links`` counts the confirmed
    links of the row's class to other classes that were needed to find the component.
    A null or wordless text has no shingles and is linked with nothing. Rows that
    repeat a text are one class; rows that repeat an id with another text each go by
    their own text. A null id is never the smallest and never kept, but links. An
    empty table gives no rows; other columns are not read; long texts enter whole.
    ``key_col`` names a further column for the key of the row's shingle set.
    """
    sets = cut_lineage(describe(df, how, id_col, text_col))
    # Tables of classes and pairs are written in files of so many classes.
    files = parts_for(sets.count(), 10_000)
    classes = cut_lineage(
        sets.filter("n > 0")
        .groupBy("key")
        .agg(F.min("id").alias("holder"), F.first("n").alias("n"), F.first("sig").alias("sig"))
        .coalesce(files)
        .withColumn("node", F.monotonically_increasing_id())
    )
    members = cut_lineage(buckets(classes, how).coalesce(files))
    leaders = members.select(F.col("node").alias("leader"), F.col("n").alias("n_leader")).filter("node = leader").distinct()
    first = (
        members.filter("node <> leader")
        .select(F.col("leader").alias("a"), F.col("node").alias("b"), "n")
        .distinct()
        .join(leaders.withColumnRenamed("leader", "a"), "a")
        .filter(near_in_size("n", "n_leader", how))
        .select("a", "b")
    )
    alive = cut_lineage(survivors(first, classes, how).coalesce(files))
    ends = F.explode(F.array("a", "b")).alias("node")
    texts = texts_of(alive.select(ends), classes, df, how, id_col, text_col, files)
    edges = cut_lineage(confirmed(alive, texts, how).coalesce(files))
    labels = components(edges)
    rows = cut_lineage(unsettled(members, labels, files))
    texts = texts_of(rows.select("node"), classes, df, how, id_col, text_col, files)
    signs = classes.select("node", "sig").join(longer_signatures(texts, how), "node")
    second = unmatched(rows, cut_lineage(signs.coalesce(files)), how)
    second = cut_lineage(second.coalesce(files))
    more = cut_lineage(confirmed(second, texts, how).coalesce(files))
    labels = joined_components(labels, more)
    edges = edges.union(more)
    links = edges.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    grouped = (
        classes.select("node", "key", "holder")
        .join(labels, "node", "left")
        .join(links, "node", "left")
        .select("key", "holder", F.coalesce("label", "node").alias("label"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    )
    roots = grouped.groupBy("label").agg(F.min("holder").alias("root"))
    final = cut_lineage(grouped.join(roots, "label").select("key", "root", "n_links").coalesce(files))
    return (
        sets.select("id", "n", "key")
        .join(final, "key", "left")
        .select(
            F.col("id").alias(id_col),
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("root")).otherwise(F.col("id")).alias("component_id"),
            F.coalesce(F.when(F.col("n") > 0, F.col("id") == F.col("root")).otherwise(F.col("id").isNotNull()), F.lit(False)).alias("kept"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            *([F.col("key").alias(key_col)] if key_col else []),
        )
    )


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_near(table(spark, sf_dir, "documents"))
