"""Quality classifier: a byte-level convolutional network in numpy (operator 5).

A text is cut into chunks that overlap by the filters' width, so that every window of
the whole document is seen once. Learned filters run over the embedded bytes of each
chunk and are max-pooled per chunk; the mean and the maximum over all chunks go
through one logistic unit and give the probability of label 1.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import as_bytes, fold, freed, map_batches, slices, table

WIDTH = 8  # bytes a filter sees
STEP = 1  # bytes between two windows
CHUNK = 256  # bytes a chunk adds; it also reads the OVERLAP bytes before it
OVERLAP = WIDTH - STEP
EMBED = 6
FILTERS = 24
CUT = 0.3  # scores from here on are predicted as label 1


@dataclass(frozen=True)
class Training:
    """Bounds of what the model is fitted on, and how."""

    per_label: int = 1_500  # labelled documents of each label, at most
    part: int = 16 * CHUNK  # a longer training text is taught by as many bytes at a time
    epochs: int = 12
    batch: int = 32
    rate: float = 0.01
    decay: float = 1e-4
    seed: int = 5


@dataclass
class Network:
    embed: np.ndarray  # 256 x EMBED
    filters: np.ndarray  # WIDTH * EMBED x FILTERS
    shift: np.ndarray  # FILTERS
    weights: np.ndarray  # 2 * FILTERS
    bias: np.ndarray  # 1
    # A text with nothing in it gets the share of label 1 among the training rows.
    prior: float = 0.5

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.shift, self.weights, self.bias]

    @classmethod
    def random(cls, seed: int) -> Network:
        draw = np.random.default_rng(seed)
        return cls(
            draw.normal(0, 0.5, (256, EMBED)).astype(np.float32),
            draw.normal(0, (WIDTH * EMBED) ** -0.5, (WIDTH * EMBED, FILTERS)).astype(np.float32),
            np.zeros(FILTERS, np.float32),
            draw.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
            np.zeros(1, np.float32),
        )


def chunked(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' bytes in one array, each padded to whole chunks; chunks per text.

    A chunk's windows begin OVERLAP bytes before it. So many zeros at least stand
    behind each text, so that no window reads from two texts.
    """
    chunks = np.array([-(-(len(text) + OVERLAP) // CHUNK) for text in texts], np.int64)
    padded = b"".join(text.ljust(n * CHUNK, b"\0") for text, n in zip(texts, chunks))
    return np.frombuffer(bytes(OVERLAP) + padded, np.uint8), chunks


def windows_of(network: Network, data: np.ndarray, rows: int) -> np.ndarray:
    """Embedded windows of ``rows`` chunks: (rows * CHUNK / STEP, WIDTH * EMBED)."""
    embedded = network.embed[data].ravel()
    count = rows * CHUNK // STEP
    size = embedded.itemsize
    view = np.lib.stride_tricks.as_strided(
        embedded, (count, WIDTH * EMBED), (STEP * EMBED * size, size), writeable=False
    )
    return np.ascontiguousarray(view)


def pooled(network: Network, data: np.ndarray, rows: int, most: int = 256) -> np.ndarray:
    """Filter responses, max-pooled per chunk, a bounded number of chunks at a time."""
    out = np.empty((rows, FILTERS), np.float32)
    for start in range(0, rows, most):
        stop = min(start + most, rows)
        part = data[start * CHUNK : stop * CHUNK + OVERLAP]
        response = windows_of(network, part, stop - start) @ network.filters
        out[start:stop] = response.reshape(stop - start, CHUNK // STEP, FILTERS).max(1)
    return np.maximum(out + network.shift, 0)


def combined(peaks: np.ndarray, chunks: np.ndarray) -> np.ndarray:
    """Mean and maximum over each text's chunks; every text has one chunk at least."""
    starts = np.cumsum(chunks) - chunks
    means = np.add.reduceat(peaks, starts) / chunks[:, None]
    return np.hstack([means, np.maximum.reduceat(peaks, starts)]).astype(np.float32)


def probabilities(network: Network, texts: list[bytes]) -> np.ndarray:
    scores = np.full(len(texts), network.prior)
    full = [at for at, text in enumerate(texts) if text]
    if full:
        data, chunks = chunked([texts[at] for at in full])
        inputs = combined(pooled(network, data, int(chunks.sum())), chunks)
        logits = (inputs @ network.weights + network.bias[0]).astype(np.float64)
        scores[full] = 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
    return scores


def gradients(network: Network, texts: list[bytes], labels: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """Gradient of the weighted log loss by backpropagation through both poolings."""
    data, chunks = chunked(texts)
    rows = int(chunks.sum())
    inside = windows_of(network, data, rows)
    response = (inside @ network.filters).reshape(rows, CHUNK // STEP, FILTERS)
    best = response.argmax(1)
    raw = np.take_along_axis(response, best[:, None, :], 1)[:, 0, :] + network.shift
    peaks = np.maximum(raw, 0)
    inputs = combined(peaks, chunks)
    error = 1 / (1 + np.exp(-np.clip(inputs @ network.weights + network.bias[0], -30, 30))) - labels
    error = (error * weight / len(texts)).astype(np.float32)
    owner = np.repeat(np.arange(len(texts)), chunks)
    back = error[:, None] * network.weights[None, :]
    mean_part = back[owner, :FILTERS] / chunks[owner, None]
    starts = np.cumsum(chunks) - chunks
    top = np.zeros(peaks.shape, bool)
    for start, count in zip(starts, chunks):  # the first of chunks that tie
        top[start + peaks[start : start + count].argmax(0), np.arange(FILTERS)] = True
    slope = (mean_part + back[owner, FILTERS:] * top) * (raw > 0)
    # Only the window with the largest response of each chunk and filter gets a share.
    place = np.arange(rows)[:, None] * (CHUNK // STEP) + best
    picked = inside[place]  # rows x FILTERS x WIDTH * EMBED
    filters = np.einsum("rf,rfw->wf", slope, picked)
    to_bytes = (slope[:, :, None] * network.filters.T[None]).reshape(-1, EMBED)
    positions = (place[:, :, None] * STEP + np.arange(WIDTH)).reshape(-1)
    codes = data[positions]
    embed = np.empty_like(network.embed)
    for column in range(EMBED):
        embed[:, column] = np.bincount(codes, to_bytes[:, column], 256)
    return [embed, filters, slope.sum(0), inputs.T @ error, np.array([error.sum()], np.float32)]


def train(texts: list[bytes], labels: list[int], how: Training = Training()) -> Network:
    """Fit by Adam. Both labels weigh the same; the prior is put back at the end."""
    network = Network.random(how.seed)
    pairs = [(text, label) for text, label in zip(texts, labels) if text]
    ones = sum(label for _, label in pairs)
    if ones in (0, len(pairs)):
        network.weights[:] = 0
        network.prior = float(ones > 0) if pairs else 0.5
        network.bias[:] = np.log((network.prior + 1e-3) / (1 - network.prior + 1e-3))
        return network
    network.prior = ones / len(pairs)
    # Long texts are taught in parts that together hold every byte of them.
    parts = [
        (text[start : start + how.part], label, len(text[start : start + how.part]) / len(text))
        for text, label in pairs
        for start in range(0, len(text), how.part)
    ]
    balance = np.array([len(pairs) / (2 * (len(pairs) - ones)), len(pairs) / (2 * ones)])
    draw = np.random.default_rng(how.seed)
    first = [np.zeros_like(p) for p in network.parameters()]
    second = [np.zeros_like(p) for p in network.parameters()]
    step = 0
    for epoch in range(how.epochs):
        rate = how.rate * (1 - epoch / how.epochs)
        order = draw.permutation(len(parts))
        for start in range(0, len(order), how.batch):
            chosen = [parts[at] for at in order[start : start + how.batch]]
            label = np.array([c[1] for c in chosen])
            weight = balance[label] * np.array([c[2] for c in chosen])
            step += 1
            found = gradients(network, [c[0] for c in chosen], label, weight)
            for value, slope, mean, square in zip(network.parameters(), found, first, second):
                slope = slope + how.decay * value
                mean += 0.1 * (slope - mean)
                square += 0.001 * (slope * slope - square)
                value -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-7)
    return network


def sample(documents: DataFrame, labels: DataFrame, how: Training, id_col: str, text_col: str) -> DataFrame:
    """(text, label): at most ``per_label`` labelled rows of each label.

    The rows are those whose hashed id is smallest, so the choice does not depend on
    partitions; held-out rows are never among them. Ids with several labels take the
    smallest label, ids that repeat are one row.
    """
    marked = (
        labels.filter(F.col("quality").isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.min("quality").alias("label"))
        .filter(fold("id", 5) > 0)
        .withColumn("order", F.xxhash64(F.lit(how.seed), "id"))
    )
    chosen = [
        marked.filter(F.col("label") == label).orderBy("order", "id").limit(2 * how.per_label)
        for label in (0, 1)
    ]
    # Labels may name documents that are not there, hence twice the number.
    keys = F.broadcast(chosen[0].union(chosen[1]))
    rows = documents.select(F.col(id_col).alias("id"), as_bytes(text_col).alias("text")).join(keys, "id")
    return rows.dropDuplicates(["id"]).orderBy("order", "id")


def fit(
    documents: DataFrame,
    labels: DataFrame,
    how: Training = Training(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Network:
    """A network from a bounded sample of labelled rows, in one task."""

    def learn(batches):
        texts: list[bytes] = []
        marks: list[int] = []
        for batch in batches:
            texts += batch.column(0).to_pylist()
            marks += batch.column(1).to_pylist()
        kept = {0: 0, 1: 0}
        rows = []
        for text, mark in zip(texts, marks):
            mark = int(mark > 0)
            if kept[mark] < how.per_label:
                kept[mark] += 1
                rows.append((text, mark))
        network = train([r[0] for r in rows], [r[1] for r in rows], how)
        yield pa.RecordBatch.from_arrays(
            [pa.array([p.astype(np.float32).tobytes() for p in network.parameters()] + [np.float64(network.prior).tobytes()])],
            names=["part"],
        )

    chosen = sample(documents, labels, how, id_col, text_col).select("text", "label").coalesce(1)
    parts = [bytes(row["part"]) for row in chosen.mapInArrow(freed(learn), "part binary").collect()]
    network = Network.random(how.seed)
    if not parts:
        return train([], [], how)
    for value, part in zip(network.parameters(), parts):
        value[...] = np.frombuffer(part, np.float32).reshape(value.shape)
    network.prior = float(np.frombuffer(parts[-1], np.float64)[0])
    return network


def score(documents: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) for every row.

    A null or empty text gets the training rows' share of label 1. Rows are scored one
    by one, so repeated rows, null ids, empty tables and other columns need nothing;
    texts of any length are read to their end, a bounded number of chunks at a time.
    """
    kind = documents.schema[id_col].dataType.simpleString()

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = probabilities(network, batch.column(2).to_pylist())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found), pa.array((found >= CUT).astype(np.int32))],
            names=[id_col, "held_out", "score", "predicted"],
        )

    rows = documents.select(id_col, (fold(id_col, 5) == 0).alias("held_out"), as_bytes(text_col).alias("text"))
    return map_batches(rows, judge, f"`{id_col}` {kind}, held_out boolean, score double, predicted int")


def accepted(documents: DataFrame, network: Network, text_col: str = "text") -> DataFrame:
    """The rows predicted as label 1, with all their columns.

    A null or empty text gets the training rows' share of label 1, as in ``score``. Rows
    are judged one by one: repeated rows and null or equal ids stay or go by their texts,
    an empty table stays empty, and columns of any name or type are passed on.
    """

    def keep(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text_col)

            def choose(part: pa.RecordBatch) -> pa.RecordBatch:
                texts = [(t or "").encode() for t in part.column(at).to_pylist()]
                return part.filter(pa.array(probabilities(network, texts) >= CUT))

            yield from slices(batch, choose, 1_000_000)

    return documents.mapInArrow(freed(keep), documents.schema)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return score(documents, fit(documents, table(spark, sf_dir, "labels")))
