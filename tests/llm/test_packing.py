from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from llm import packing
from prose_texts import prose


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(packing.VOCABULARY)


def library_ids(library, text) -> list[int]:
    return [*library.encode(text or "", add_special_tokens=False).ids, 2]


def check_pieces(library, given: list[tuple], rows: list, window: int) -> None:
    """Every id of every document once, sequences without gaps, their lengths as allowed."""
    by_document = defaultdict(list)
    for text_id, text in given:
        by_document[text_id].append(library_ids(library, text))
    pieces = defaultdict(list)
    for row in rows:
        pieces[row.doc_id].append(row)
    assert set(pieces) == set(by_document)
    for id_, documents in by_document.items():
        wanted = sorted(ids for ids in documents)
        left = sorted(pieces[id_], key=lambda r: (r.doc_tokens, r.start))
        assert sum(r.length for r in left) == sum(map(len, wanted))
        for r in left:
            parts = [ids[r.start : r.start + r.length] for ids in wanted if len(ids) == r.doc_tokens]
            assert any(len(p) == r.length and zlib.crc32(np.array(p, "<u4").tobytes()) == r.ids_crc32 for p in parts)
        if len(wanted) == 1:
            assert [r.start for r in left] == [0, *np.cumsum([r.length for r in left])[:-1]]
    sequences = defaultdict(list)
    for row in rows:
        sequences[row.sequence_id].append((row.offset, row.length))
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at and length > 0
            at += length
        assert at <= window and at & (at - 1) == 0


def test_letters_up_to_ff_go_to_the_merges(library, monkeypatch):
    with open(packing.VOCABULARY, encoding="utf-8") as file:
        encoder = packing.Encoder(file.read())
    letters = [c for c in map(chr, range(0x80, 0x100)) if c.isalpha()]
    words = [f"{before}{c}{after}" for c in letters for before in ("", "a", "Zürich") for after in ("", "n", "ÉÀ")]
    asked = []
    monkeypatch.setattr(packing.Encoder, "pieces", lambda self, stems: asked.extend(stems) or [])
    (found,) = encoder.texts([" ".join(words).encode()])
    assert np.frombuffer(found, encoder.kind).tolist() == library.encode(" ".join(words), add_special_tokens=False).ids
    assert not asked


def test_marks_behind_letters_are_encoded_once_per_run(library, monkeypatch):
    with open(packing.VOCABULARY, encoding="utf-8") as file:
        encoder = packing.Encoder(file.read())
    runs = [".", "!!", "###", ",$$$", "%%%", '."', "(&*)", "\\_^`~[]{}-+=/@"]
    stems = sorted({*prose(300, 3).replace(".", "").split(), "naïve", "Straße", "ΑΣ", "日本語"})
    text = " ".join(f"{stem}{run}" for run in runs for stem in stems)
    calls = []
    monkeypatch.setattr(packing.Encoder, "alone", lambda self, word, alone=packing.Encoder.alone: calls.append(word) or alone(self, word))
    (found,) = encoder.texts([text.encode()])
    assert np.frombuffer(found, encoder.kind).tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(calls) <= len(runs) + 20 < len(stems) * len(runs)
    for other in ["it's.", "it's'", "'s..", "x'", "x.'s", "a<|endoftext|>", "a.<|endoftext|>.", "a<|endoftext|", "a|.", "a<.", "...", "é.́", "a.≠"]:
        (found,) = encoder.texts([other.encode()])
        assert np.frombuffer(found, encoder.kind).tolist() == library.encode(other, add_special_tokens=False).ids, other


def test_encoder_is_the_library(library):
    with open(packing.VOCABULARY, encoding="utf-8") as file:
        encoder = packing.Encoder(file.read())
    texts = [
        "Hello, World! it's DON'T we'll 'Re 12,345.67 foo_bar", "", " \t\n", "naïve É é ́x Ångström ǅ İstanbul ß ΑΣ ﬁ",
        "a b c\x1cd\x85e　f", "<|endoftext|> x<|startoftext|>y <|ENDOFTEXT|> word<|endoftext|>,", "中文 日本語 😀👩‍👩‍👧 ️", "x" * 5000,
        "(a) b! c? d; e: f. .g ,h!? ...", "\x00\x01 \x7f", "word\x0bword\x0cword\rword", prose(500, 1), prose(500, 1).upper(),
    ]
    for _ in range(3):
        for text, found in zip(texts, encoder.texts([text.encode() for text in texts])):
            ids = np.frombuffer(found, encoder.kind).tolist()
            assert ids == library.encode(text, add_special_tokens=False).ids
        # Known from the generation before, then not at all.
        encoder.old, encoder.young = encoder.young, {}


def test_every_id_once(spark, library, odd, odd_rows, nothing):
    rows = packing.pack(odd).collect()
    check_pieces(library, odd_rows, rows, packing.WINDOW)
    small = packing.pack(odd, window=64, shard=4, most=6).collect()
    check_pieces(library, odd_rows, small, 64)
    assert packing.pack(nothing).count() == 0
    with pytest.raises(ValueError, match="power of two"):
        packing.pack(odd, window=100)


def test_a_bucket_of_copies_is_split(spark, library):
    given = [(n, prose(20, 3)) for n in range(300)] + [(n, prose(15, n)) for n in range(300, 340)]
    rows = packing.pack(spark.createDataFrame(given, "doc_id long, text string"), window=256, shard=20, most=30).collect()
    check_pieces(library, given, rows, 256)


def words_of(subject: int, n: int) -> str:
    draw = np.random.default_rng(n)
    return " ".join(f"{'bcdfghjklmnp'[subject] * 3}{chr(97 + w % 20)}o{chr(97 + w // 20)}" for w in draw.integers(0, 40, 60))


def test_neighbours_are_those_of_bm25_by_hand(library):
    with open(packing.VOCABULARY, encoding="utf-8") as file:
        encoder = packing.Encoder(file.read())
    texts = [prose(50 + 7 * n, n % 4 + 20) for n in range(12)] + [words_of(n % 3, n) for n in range(12)]
    ids = [np.frombuffer(found, encoder.kind) for found in encoder.texts([t.encode() for t in texts])]
    lengths = np.array([len(i) for i in ids])
    holding = defaultdict(set)
    for n, own in enumerate(ids):
        for token in own.tolist():
            holding[token].add(n)
    df = np.zeros(len(encoder.ends), np.int64)
    for token, own in holding.items():
        df[token] = len(own)
    index = packing.Index(np.concatenate(ids), lengths, packing.Weights(df, len(texts), lengths.mean()))
    pieces = [library.encode(t, add_special_tokens=False).ids for t in texts]
    used: set[int] = set()
    for seed in (0, 13, 5, 20, 7, 16, 2, 3, 4, 22, 23):
        index.use(seed)
        used.add(seed)
        scores = {}
        for n, words in enumerate(pieces):
            score = 0.0
            for word in set(pieces[seed]):
                tf, n_word = words.count(word), len(holding[word])
                idf = max(0, np.log((len(texts) - n_word + 0.5) / (n_word + 0.5)))
                if tf and n_word > 1:
                    room = 1.2 * (1 - 0.75 + 0.75 * lengths[n] / lengths.mean())
                    score += idf * tf * 2.2 / (tf + room)
            if score > 0 and n not in used:
                scores[n] = score
        found = index.neighbours(seed).tolist()
        assert set(found) == set(scores)
        assert np.allclose([scores[n] for n in found], sorted(scores.values(), reverse=True), rtol=1e-4)


def test_windows_hold_one_subject(spark):
    """Rests of a subject share windows far oftener than by chance."""
    given = [(n, words_of(n % 12, n)) for n in range(480)]
    rows = packing.pack(spark.createDataFrame(given, "doc_id long, text string"), window=2048, shard=120, most=180).collect()
    windows = defaultdict(list)
    for row in rows:
        windows[row.sequence_id].append((row.offset, row.doc_id % 12))
    pairs = [(a[1], b[1]) for found in map(sorted, windows.values()) for a, b in zip(found, found[1:])]
    assert sum(a == b for a, b in pairs) > 0.8 * len(pairs)
