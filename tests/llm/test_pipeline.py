from __future__ import annotations

import hashlib
from collections import Counter

import pytest
import tiktoken
from prose_texts import prose

import corpus_pipeline
import public_tokenizers
from llm.bpe import VOCABULARY, load_ranks


def junk(seed: int) -> str:
    return " ".join(word.upper() + "!!" for word in prose(80, seed).split())


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus of which every stage's part is known."""
    path = str(tmp_path_factory.mktemp("corpus"))
    items = [(at, prose(20, 9_000 + at) + ". " + prose(6, 9_100 + at) + ".") for at in range(5)]
    docs = [(key, prose(80, key) if key % 4 else junk(key)) for key in range(200)]
    near = docs[1][1].split()
    near[40] = "changed"
    docs += [(300, docs[1][1]), (301, " ".join(near)), (302, docs[2][1])]
    docs += [(303, f"{prose(60, 303)} {items[2][1]} {prose(60, 304)}"), (304, prose(50, 305) + ' token = "0123456789abcdef0123" ' + prose(50, 306))]
    rows = [(key, text, "en", "src", len(text)) for key, text in docs] + [(400, None, None, None, None), (401, "", "en", "src", 0)]
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, columns).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    labels = [(key, int(key % 4 > 0), 0) for key in range(200)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows


def test_stages_keep_the_columns_and_take_effect(spark, folder):
    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, path)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
            assert out.schema.simpleString() == docs.schema.simpleString()
        out.write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
        seen.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    quality, near, benchmark, secrets, tokens = seen
    texts = {row[0]: row[1] for row in rows}
    # The classifier keeps the prose, also of held-out documents, and drops the junk.
    assert quality - {400, 401} == {key for key in texts if key >= 300 or key % 4} - {400, 401}
    assert quality - near == {300, 301, 302}
    assert near - benchmark == {303}
    assert benchmark == secrets == tokens
    clean = {r["doc_id"]: r for r in spark.read.parquet(f"{path}/secrets").collect()}
    assert "0123456789abcdef" not in clean[304]["text"] and clean[304]["n_chars"] == len(clean[304]["text"])
    for key in secrets - {304}:
        assert clean[key]["text"] == texts[key]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(VOCABULARY), special_tokens={})
    for row in docs.collect():
        text = clean[row["doc_id"]]["text"] or ""
        ids = library.encode_ordinary(text)
        assert row["ids"] == ids and row["n_tokens"] == len(ids)
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    whole = corpus_pipeline.run(spark, path).select("doc_id", "n_tokens", "ids_sha256").collect()
    assert Counter(whole) == Counter(docs.select("doc_id", "n_tokens", "ids_sha256").collect())


def test_stages_are_the_dealt_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "benchmark", "secrets", "tokens"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_near_duplicates_go_by_id_and_text(spark, odd, odd_rows):
    a, b, c = prose(60, 71), prose(60, 72), prose(60, 73)
    rows = [(3, b), (7, b), (7, a), (9, a), (None, c), (None, c), (11, None), (11, None), (12, c), (12, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = Counter(map(tuple, corpus_pipeline.near_duplicates(spark, docs, "").collect()))
    assert found == Counter([(3, b), (7, a), (None, c), (None, c), (11, None), (12, c), (12, "")])
    kept = corpus_pipeline.near_duplicates(spark, odd.select("doc_id", "text"), "").collect()
    own = (None, 5, 6, 8)
    assert Counter(tuple(r) for r in kept if r["doc_id"] in own) == Counter({row for row in odd_rows if row[0] in (None, 5, 8)})


@pytest.mark.parametrize("others", [[], [(1, "x"), (1, "x")]])
def test_equal_rows_without_an_id_stay(spark, others):
    rows = [(None, prose(30, 74))] * 2
    docs = spark.createDataFrame(rows + others, "doc_id long, text string")
    found = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    assert Counter(found) == Counter(rows + others[:1])
