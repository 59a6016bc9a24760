"""Secret scans with an incremental blob ledger (operator 7).

Every version of a text is addressed by the SHA-256 of its bytes. A ledger in the
shared folder holds, per blob, the rule versions it was scanned with and what they
found. A run scans each blob once, with those rules only that the ledger does not
have for it, and joins the findings back to every path that holds the blob. A span names
the rule and version that found it, so that a reader gets those it asks for and no others.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import as_bytes, map_batches, table, with_small
from skuweave.session import cut_lineage, new_folder


@dataclass(frozen=True)
class Rule:
    """A kind of secret. A match counts if ``group`` has at least ``least`` characters."""

    kind: str
    pattern: bytes
    group: int = 0
    least: int = 0
    any_case: bool = False
    version: int = 1
    # Bytes of which a text must hold one for the pattern to be tried at all.
    hints: tuple[bytes, ...] = ()

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The three base rules, in the order in which equal starts are listed.
BASE = (
    Rule(
        "assign",
        rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=12,
        any_case=True,
    ),
    Rule("access", rb"AKIA[A-Z0-9]+", least=18, hints=(b"AKIA",)),
    Rule("hex", rb"[0-9a-f]+", least=16),
)
# Formats that carry their own marker, so that they name nothing but a secret.
ADDED = (
    Rule(
        "pem",
        rb"-----BEGIN [A-Z ]*PRIVATE KEY-----[\s\S]*?-----END [A-Z ]*PRIVATE KEY-----",
        hints=(b"PRIVATE KEY-----",),
    ),
    Rule("jwt", rb"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", hints=(b"eyJ",)),
)
RULES = BASE + ADDED
_HEX_RUN = re.compile(rb"[0-9a-f]{16,}")
LEDGER = "blob binary, rules array<string>, spans array<struct<rule:string,start:long,end:long>>"
#: Copies of a blob's findings over which the paths that hold the blob are dealt.
SALTS = 16


def spans_of(text: bytes, rules: Sequence[Rule]) -> list[tuple[int, int, str]]:
    """(start, end, rule) in code points, ordered by start, then by the rules' order."""
    found = []
    for place, rule in enumerate(rules):
        if rule.hints and not any(hint in text for hint in rule.hints):
            continue
        pattern = re.compile(rule.pattern, re.IGNORECASE if rule.any_case else 0)
        if rule.pattern == rb"[0-9a-f]+":
            # Maximal runs do not overlap, so asking for the length at once is the same.
            pattern = _HEX_RUN
        for match in pattern.finditer(text):
            if match.end(rule.group) - match.start(rule.group) >= rule.least:
                found.append((match.start(), place, match.end(), rule.name))
    found.sort()
    if text.isascii():
        return [(start, end, name) for start, _, end, name in found]
    # Code points are counted once from end to end, from one place to the next.
    points, before, reached = {}, 0, 0
    for at in sorted({place for start, _, end, _ in found for place in (start, end)}):
        reached += len(text[before:at].decode("utf-8", "replace"))
        points[at] = reached
        before = at
    return [(points[start], points[end], name) for start, _, end, name in found]


def blob_of(column: str) -> Column:
    """The content address: SHA-256 of the text's bytes, null as empty."""
    return F.unhex(F.sha2(as_bytes(column), 256))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """All rows of a ledger; none if the folder does not exist yet."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ledger)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger)


def scan_new(
    versions: DataFrame,
    ledger: str,
    rules: Sequence[Rule] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Scan the pairs of blob and rule version that ``ledger`` lacks and append them.

    Only hashes are grouped and compared to find what is new and which row stands for
    a blob that many rows hold. Each run appends files of its own, so one that fails
    leaves earlier findings as they were. A blob scanned twice is listed twice, which
    readers allow for.
    """
    spark = versions.sparkSession
    names = F.array(*(F.lit(rule.name) for rule in rules))
    none = F.array().cast("array<string>")
    by_name = {rule.name: rule for rule in rules}
    keyed = versions.select(
        blob_of(text_col).alias("blob"), F.col(id_col).alias("holder"), as_bytes(text_col).alias("text")
    )
    done = (
        read_ledger(spark, ledger)
        .groupBy("blob")
        .agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("done"))
    )
    missing = cut_lineage(
        keyed.groupBy("blob")
        .agg(F.min("holder").alias("holder"))
        .join(done, "blob", "left")
        .select("blob", "holder", F.array_except(names, F.coalesce("done", none)).alias("todo"))
        .filter(F.size("todo") > 0)
        .select(F.xxhash64("blob", "holder").alias("key"), "todo")
    )
    # As many different sets of missing rules as the ledger has seen rule sets.
    for todo, count in missing.groupBy("todo").count().collect():
        keys = with_small(missing.filter(F.col("todo") == F.lit(todo)).select("key"), count)
        fresh = keyed.withColumn("key", F.xxhash64("blob", "holder")).join(keys, "key", "left_semi")
        _scan(fresh, [by_name[name] for name in todo]).write.mode("append").parquet(ledger)


def _scan(blobs: DataFrame, rules: list[Rule]) -> DataFrame:
    kind = pa.list_(pa.struct([("rule", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = [
            [{"rule": name, "start": s, "end": e} for s, e, name in spans_of(text, rules)]
            for text in batch.column(1).to_pylist()
        ]
        names = [[rule.name for rule in rules]] * len(spans)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(names, pa.list_(pa.string())), pa.array(spans, kind)],
            names=["blob", "rules", "spans"],
        )

    return map_batches(blobs.select("blob", "text"), scan, LEDGER)


def findings(spark: SparkSession, ledger: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(blob, spans) of the blobs in which these rules, in these versions, found something.

    Spans are in order of their starts, then of the rules.
    """
    names = F.array(*(F.lit(rule.name) for rule in rules))
    kinds = F.array(*(F.lit(rule.kind) for rule in rules))
    place = F.array_position(names, F.col("span.rule")).cast("int")
    rows = (
        read_ledger(spark, ledger)
        .select("blob", F.explode("spans").alias("span"))
        .select("blob", "span", place.alias("place"))
        .filter("place > 0")
        .select("blob", F.struct("span.start", "place", "span.end", F.element_at(kinds, F.col("place")).alias("kind")).alias("span"))
    )
    return rows.groupBy("blob").agg(F.array_sort(F.collect_set("span")).alias("spans"))


def find_secrets(
    versions: DataFrame,
    ledger: str | None = None,
    rules: Sequence[Rule] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, blob, spans) for every row of ``versions``, scanning only what is new.

    Without a ``ledger`` a new one is begun in the shared folder. A null text is the
    empty blob. Repeated rows and ids each get the findings of their own text; null
    ids stay; an empty table gives no rows; other columns are not read. A text of any
    length is one blob and scanned whole.
    """
    spark = versions.sparkSession
    ledger = ledger or new_folder(spark)
    scan_new(versions, ledger, rules, id_col, text_col)
    found = findings(spark, ledger, rules)
    empty = F.array().cast(found.schema["spans"].dataType)
    # The paths of a blob that many hold are dealt over copies of its one row of findings.
    salt = F.pmod(F.xxhash64(id_col), F.lit(SALTS)).cast("int").alias("salt")
    paths = versions.select(F.col(id_col), blob_of(text_col).alias("blob"), salt)
    found = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return paths.join(found, ["blob", "salt"], "left").select(
        id_col, "blob", F.coalesce("spans", empty).alias("spans")
    )


def redact(versions: DataFrame, ledger: str | None = None, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``versions`` with every span that was found replaced by ``[secret]``.

    Spans that overlap are replaced once. ``n_chars``, where there is one, is counted
    anew for texts that change. A null or empty text stays as it is; repeated rows and ids
    are each covered by what their own text holds; null ids stay; an empty table stays
    empty; columns of any name or type are passed on. A long text is covered to its end.
    """
    spark = versions.sparkSession
    ledger = ledger or new_folder(spark)
    scan_new(versions, ledger, RULES, id_col, text_col)
    found = cut_lineage(findings(spark, ledger).select("blob", F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("spans")))
    packed = versions.select(F.struct("*").alias("row"), blob_of(text_col).alias("blob"))

    @F.pandas_udf("string")
    def cover(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([_covered(t, s) for t, s in zip(texts, spans)], dtype=object)

    # Broadcast only if digests and spans together are as small as so many keys.
    sizes = found.agg(F.count(F.lit(1)).alias("blobs"), F.coalesce(F.sum(F.size("spans")), F.lit(0)).alias("spans")).first()
    joined = packed.join(with_small(found, 12 * sizes["blobs"] + 4 * sizes["spans"]), "blob", "left")
    # Python gets the texts that change and no others.
    found_in = F.when(F.col("spans").isNotNull(), F.col(f"row.`{text_col}`"))
    text = F.when(F.col("spans").isNull(), F.col(f"row.`{text_col}`")).otherwise(cover(found_in, "spans"))
    joined = joined.select("row", "spans", text.alias("text"))
    columns = []
    for name in versions.columns:
        column = F.col(f"row.`{name}`")
        if name == text_col:
            column = F.col("text")
        elif name == "n_chars":
            column = F.when(F.col("spans").isNull(), column).otherwise(F.length("text").cast(versions.schema[name].dataType))
        columns.append(column.alias(name))
    return joined.select(*columns)


def _covered(text: str | None, spans) -> str | None:
    if text is None or spans is None:
        return text
    parts, at = [], 0
    for span in spans:
        start, end = span["start"], span["end"]
        if end <= at:
            continue
        if start >= at:
            parts += [text[at:start], "[secret]"]
        at = end
    return "".join([*parts, text[at:]])


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest of every document's findings."""
    kinds = [rule.kind for rule in BASE]
    found = find_secrets(table(spark, sf_dir, "documents"))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in kinds),
        F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(kinds))), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
