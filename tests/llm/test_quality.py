from __future__ import annotations

import base64
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard

from llm.quality_model import CHUNK, OVERLAP, Network, Training, accepted, chunked, combined, fit, gradients, pooled, probabilities, score, train
from llm.quality_rules import Bands, _Counter, apply_rules, duplicate_lines, repeated_words

from prose_texts import prose


def test_gradients_are_those_of_the_loss():
    network = Network.random(1)
    for name in ("embed", "filters", "shift", "weights", "bias"):
        setattr(network, name, getattr(network, name).astype(np.float64))
    texts = [prose(60, 1).encode(), prose(150, 2).encode() + b"!!", b"short"]
    labels, weight = np.array([1, 0, 1]), np.array([1.0, 2.0, 0.5])

    def loss():
        data, chunks = chunked(texts)
        rows = int(chunks.sum())
        from llm.quality_model import FILTERS, STEP, windows_of

        response = (windows_of(network, data, rows) @ network.filters).reshape(rows, CHUNK // STEP, FILTERS).max(1)
        peaks = np.maximum(response + network.shift, 0)
        starts = np.cumsum(chunks) - chunks
        inputs = np.hstack([np.add.reduceat(peaks, starts) / chunks[:, None], np.maximum.reduceat(peaks, starts)])
        p = 1 / (1 + np.exp(-(inputs @ network.weights + network.bias[0])))
        return float((-weight * np.log(np.where(labels == 1, p, 1 - p))).mean())

    found = gradients(network, texts, labels, weight)
    draw = np.random.default_rng(2)
    for value, slope in zip(network.parameters(), found):
        flat, slopes = value.reshape(-1), np.asarray(slope).reshape(-1)
        for at in draw.choice(np.flatnonzero(np.abs(slopes) > 1e-4), 3):
            before, step = flat[at], 1e-5
            flat[at] = before + step
            high = loss()
            flat[at] = before - step
            low = loss()
            flat[at] = before
            assert (high - low) / (2 * step) == pytest.approx(slopes[at], rel=0.02, abs=1e-4)


def test_the_whole_text_counts():
    network = Network.random(3)
    text = prose(900, 1).encode()
    data, chunks = chunked([text])
    assert chunks[0] * CHUNK >= len(text) and len(data) == chunks[0] * CHUNK + OVERLAP
    at_once = pooled(network, data, int(chunks[0]))
    in_parts = pooled(network, data, int(chunks[0]), most=3)
    assert np.allclose(at_once, in_parts, atol=1e-5)
    alone = probabilities(network, [text])
    assert np.allclose(probabilities(network, [b"", text, b"x"])[1], alone)
    assert combined(at_once, chunks).shape[1] == 2 * at_once.shape[1]


def junk(seed: int) -> str:
    return " ".join(word.upper() + "!!" for word in prose(80, seed).split())


@pytest.fixture(scope="module")
def labelled(spark):
    texts = [(key, prose(80, key) if key % 3 else junk(key)) for key in range(300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame(
        [(key, int(key % 3 > 0)) for key in range(300)] + [(None, 1), (999, 0), (5, None)], "doc_id long, quality int"
    )
    return docs, labels


def test_held_out_rows_are_judged_right(labelled, odd, nothing):
    docs, labels = labelled
    network = fit(docs, labels, Training(epochs=6))
    rows = {r["doc_id"]: r for r in score(docs, network).collect()}
    for key, row in rows.items():
        assert row["held_out"] == (zlib.crc32(str(key).encode()) % 5 == 0)
        assert row["predicted"] == int(row["score"] >= 0.3)
    right = [r["predicted"] == int(k % 3 > 0) for k, r in rows.items() if r["held_out"]]
    assert np.mean(right) > 0.95
    kept = accepted(docs, network)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {k for k, r in rows.items() if r["predicted"]}
    every = score(odd, network).collect()
    assert len(every) == odd.count() and all(0 <= r["score"] <= 1 for r in every)
    assert {r["held_out"] for r in every if r["doc_id"] is None} == {False}
    assert score(nothing, network).count() == 0
    assert accepted(odd, network).columns == odd.columns


def test_held_out_labels_are_not_learned(labelled):
    docs, labels = labelled
    turned = labels.selectExpr(
        "doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - quality else quality end as quality"
    )
    how = Training(epochs=1)
    first, second = fit(docs, labels, how), fit(docs, turned, how)
    assert all(np.array_equal(a, b) for a, b in zip(first.parameters(), second.parameters()))


def test_one_label_or_none(labelled, nothing):
    docs, labels = labelled
    assert (probabilities(train([b"a", b"b"], [1, 1]), [b"a"]) > 0.9).all()
    network = fit(docs, labels.limit(0))
    assert 0 <= probabilities(network, [b"text"])[0] <= 1


def brute(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    blanks = " \t\n\r\x0b\x0c"
    words = [w for w in "".join(" " if c in blanks else c for c in text).split(" ") if w]
    grams = [tuple(words[at : at + 5]) for at in range(len(words) - 4)]
    twice = {g for g, n in Counter(grams).items() if n > 1}
    covered = {at + step for at, gram in enumerate(grams) if gram in twice for step in range(5)}
    seen, lines = set(), 0
    for line in text.split("\n"):
        if any(c not in blanks for c in line):
            lines += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), lines, len(covered)


def test_counts_as_brute_force(spark, odd, odd_rows, nothing):
    texts = [
        "a b c d e f a b c d e f g", "x " * 30, "l1 #\n\nl1 #\n \n \nl1 #", "one\x1ctwo three four", "a\tb\x0bc\x0cd\re",
        prose(12, 3) + "\n" + prose(12, 3), "<b>*$%&|</b>",
    ]
    rows = [(at, text) for at, text in enumerate(texts, 100)] + odd_rows
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    found = apply_rules(docs).collect()
    assert Counter((r["doc_id"], *(r[n] for n in names)) for r in found) == Counter((k, *brute(t)) for k, t in rows)
    for row in found:
        failed = row["n_words"] < 10 or 100 * row["n_repeat_words"] > 20 * row["n_words"]
        assert row["base_failed"] == failed and not (failed and row["kept"])
    assert apply_rules(nothing).count() == 0 and apply_rules(odd).count() == odd.count()


def noise(size: int, seed: int) -> str:
    return base64.b64encode(random.Random(seed).randbytes(size)).decode()[:size]


def test_default_bands_reject_repetitive_and_random_texts(spark):
    """With the production limits: each kind at each length, and inside a text."""
    rows, wanted = [], {}

    def add(text: str, kept: bool) -> None:
        wanted[len(rows)] = kept
        rows.append((len(rows), text))

    for words in (12, 20, 40, 90, 200, 400, 900, 3_000, 12_000):
        add(prose(words, words), True)
    for size in (400, 900, 1_700, 4_000, 20_000, 90_000):
        add(" ".join(noise(size, size)[at : at + 60] for at in range(0, size, 60)) + " a b c d e f g h i j", False)
        add(" ".join(f"{prose(8, 4)} {at}" for at in range(size // 40)), False)
    # A third of a text, and a stretch of a long one.
    add(prose(650, 5) + " " + noise(2_000, 1) + " " + prose(100, 6), False)
    add(prose(4_000, 5) + " " + noise(9_000, 2) + " " + prose(4_000, 6), False)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in apply_rules(docs).collect()}
    bad = {key: (len(rows[key][1]), found[key]) for key, kept in wanted.items() if (found[key]["kept"] or found[key]["base_failed"]) != (kept or found[key]["base_failed"])}
    assert bad == {}


def test_verdicts_as_brute_force(odd_rows):
    """Whole ratios and chunks by their definition, over every byte of every text."""
    bands, packer = Bands(), zstandard.ZstdCompressor(level=3)
    counter = _Counter(bands)
    ratio = lambda data: max(0, len(packer.compress(data)) - 9) / len(data)
    texts = [text for _, text in odd_rows if text]
    texts += [prose(n, n) for n in range(5, 900, 45)] + [noise(n, n) for n in (1, 99, 1_023, 1_024, 2_047, 2_048, 2_049, 5_000)]
    for text in texts:
        data = text.encode()
        band = sum(len(data) > edge for edge in bands.edges)
        inside = bands.low[band] <= ratio(data) <= bands.high[band]
        odd = chunks = 0
        for size, low, high in zip(bands.chunks, bands.chunk_low, bands.chunk_high):
            if len(data) >= 2 * size:
                parts = [data[at : at + size] for at in range(0, len(data) // size * size, size)]
                parts += [data[-size:]] if len(data) % size else []
                odd, chunks = sum(not low <= ratio(part) <= high for part in parts), len(parts)
        share = odd / chunks if chunks else 0.0
        assert counter.judge(data) == (ratio(data), share, inside and share <= 0.1)


def test_forward_pass_as_brute_force():
    """Every window of a text at every byte, chunk by chunk, in plain loops."""
    network = Network.random(7)
    network.shift += np.linspace(-1, 1, len(network.shift)).astype(np.float32)
    for text in (b"x", b"seven 7", b"eight..8", prose(30, 1).encode(), prose(120, 2).encode(), b"\xff\x00" * 300):
        # Zeros stand before the first chunk, as many as a window reads back, and behind the last.
        chunks = -(-(len(text) + 7) // 256)
        padded = bytes(7) + text.ljust(chunks * 256, b"\0")
        peaks = []
        for chunk in range(chunks):
            best = np.full(24, -np.inf)
            for at in range(chunk * 256, chunk * 256 + 256):
                window = np.concatenate([network.embed[code] for code in padded[at : at + 8]])
                best = np.maximum(best, window.astype(np.float64) @ network.filters)
            peaks.append(np.maximum(best + network.shift, 0))
        logit = np.concatenate([np.mean(peaks, 0), np.max(peaks, 0)]) @ network.weights + network.bias[0]
        assert probabilities(network, [text])[0] == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-4)


def test_windows_do_not_cross_texts():
    words, repeated = repeated_words([b"a b c d e", b"a b c d e", b"", b"a b c d e a b c d e"])
    assert words.tolist() == [5, 5, 0, 10] and repeated.tolist() == [0, 0, 0, 10]
    assert duplicate_lines(b"a\r\na\na") == 1
