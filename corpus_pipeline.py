"""A corpus pipeline: each stage is one of the operators of ``llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import bpe, decontaminate, near_dedup, quality_model, secrets
from llm.common import table, with_small
from skuweave.session import cut_lineage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labelled ones."""
    model = quality_model.fit(docs, table(spark, sf_dir, "labels"))
    return quality_model.accepted(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest doc_id.

    What is dropped goes by doc_id and text, since a doc_id may hold several texts.
    Rows without a doc_id cannot be told apart by it and stay. Rows with a doc_id that
    are equal in every column become one.
    """
    key = "near_duplicates_set_key"
    groups = near_dedup.group_near(docs, key_col=key).filter("doc_id is not null")
    groups = cut_lineage(groups.select("doc_id", "kept", key))
    ids = groups.groupBy("doc_id").agg(F.max("kept").alias("some"), F.count(F.lit(1)).alias("rows"))
    gone = cut_lineage(ids.filter("not some").select("doc_id"))
    rows = docs.join(with_small(gone, gone.count()), "doc_id", "left_anti").select(*docs.columns)
    repeated = cut_lineage(ids.filter("some and rows > 1").select("doc_id"))
    count = repeated.count()
    if not count:
        return rows
    repeated = with_small(repeated, count)
    out = groups.filter("not kept").select("doc_id", key).distinct()
    texts = near_dedup.with_set_key(rows.join(repeated, "doc_id", "left_semi").select(*docs.columns), key)
    own = texts.join(out, ["doc_id", key], "left_anti").select(*docs.columns).distinct()
    return rows.join(repeated, "doc_id", "left_anti").select(*docs.columns).union(own)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with what the scan finds taken out of their texts."""
    return secrets.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document and the digests of ids and decoded bytes."""
    found = bpe.digests(bpe.encode(docs, written=True))
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("secrets", secret_scan),
    ("tokens", tokens),
]

# Learned scores and similarity search have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on the written result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
