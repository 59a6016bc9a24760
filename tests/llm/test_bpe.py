from __future__ import annotations

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import tiktoken

from llm.bpe import VOCABULARY, decode, digests, encode, encode_word, load_ranks, splitter


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(VOCABULARY), special_tokens={}
    )


def test_split_and_merge_as_the_library(library):
    ranks = load_ranks(VOCABULARY)
    draw = random.Random(1)
    spaces = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
    for turn in range(1_500):
        if turn % 2:
            text = "".join(draw.choice("abé ñ 中9٣'s're .!? \n\t" + spaces) for _ in range(draw.randint(0, 60)))
        else:
            text = " ".join(draw.choice(["it's", "a", "b\nc", "x!?", "end.", "  ", "12", "naïve", ""]) for _ in range(20))
        words: dict = {}
        codes = splitter(public_tokenizers.PATTERN)()(text.encode(), words)
        pieces = list(words)
        ids = [i for code in codes for i in encode_word(pieces[code].encode(), ranks)]
        assert ids == library.encode_ordinary(text), text


def test_long_words_merge_alike(library):
    ranks = load_ranks(VOCABULARY)
    for word in ("ab" * 20_000, "x" * 101, "é" * 3_000, "theandtion" * 30):
        assert encode_word(word.encode(), ranks) == library.encode_ordinary(word)


def test_rows_and_round_trip(odd, odd_rows, library):
    rows = digests(encode(odd)).collect()
    want = Counter()
    for key, text in odd_rows:
        ids = library.encode_ordinary(text or "")
        want[key, tuple(ids), (text or "").encode()] += 1
    assert Counter((r["doc_id"], tuple(r["ids"]), bytes(r["decoded"])) for r in rows) == want
    for row in rows:
        joined = ",".join(map(str, row["ids"])).encode()
        assert row["n_tokens"] == len(row["ids"])
        assert row["ids_sha256"] == hashlib.sha256(joined).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(bytes(row["decoded"])).hexdigest()


def test_empty_table_and_null_ids(spark, nothing):
    assert encode(nothing).count() == 0
    ids = spark.createDataFrame([(1, None), (2, []), (3, [0, 1])], "doc_id long, ids array<int>")
    found = {r["doc_id"]: bytes(r["decoded"]) for r in decode(ids).collect()}
    tokens = {rank: token for token, rank in load_ranks(VOCABULARY).items()}
    assert found == {1: b"", 2: b"", 3: tokens[0] + tokens[1]}
