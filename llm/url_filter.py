"""URL filters: rules, and gradient-boosted trees on lexical features (operator 4).

Everything is DataFrame code. URLs that a rule decides are the labelled ones; the trees
learn from all of them and judge the rest. Features are put into bins, so that the
labelled rows shrink to one row per vector of bins before boosting starts, and every
level of a tree is one small aggregation over those vectors. A finished model is a
column expression.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import table, with_small
from skuweave.session import cut_lineage

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    """A host with everything below it, and the beginning of a path."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)

# Upper edges of the bins of each feature; one more bin lies above the last edge.
BINS: dict[str, Sequence[float]] = {
    "url_length": (20, 30, 35, 40, 45, 50, 60, 80, 120),
    "host_length": (8, 12, 16, 20, 24, 32),
    "host_labels": (1, 2, 3, 4),
    "host_hyphens": (0, 1, 2),
    "depth": (0, 1, 2, 3, 4, 6),
    "digit_ratio": (0.0, 0.02, 0.05, 0.08, 0.1, 0.15, 0.2, 0.3),
    "entropy": (3.0, 3.5, 3.75, 4.0, 4.1, 4.2, 4.3, 4.5, 4.75),
    "parameters": (0, 1, 2, 4),
    "first_digit": (0, 1, 2, 3, 4, 5, 6, 7, 8, 9),
    "last_length": (0, 1, 2, 3, 4, 6, 10, 20),
    "host_blocked": (0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9),
    "start_blocked": (0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9),
    "end_blocked": (0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9),
}
# Keys whose share of blocked URLs is learned: host suffix, first segment, extension.
SUFFIXES = ("host_suffix", "path_start", "path_end")


@dataclass(frozen=True)
class Boosting:
    trees: int = 10
    depth: int = 3
    rate: float = 0.4
    least: float = 5.0  # weight that each side of a split needs
    ridge: float = 1.0
    prior: float = 10.0  # rows that a key's share of blocked URLs is drawn to the mean by


@dataclass(frozen=True)
class Split:
    feature: str
    bin: int
    low: Split | float
    high: Split | float

    def column(self) -> Column:
        sides = [s.column() if isinstance(s, Split) else F.lit(s) for s in (self.low, self.high)]
        return F.when(F.col(self.feature) <= self.bin, sides[0]).otherwise(sides[1])


@dataclass(frozen=True)
class Model:
    start: float
    trees: tuple[Split | float, ...]

    def margin(self) -> Column:
        parts = [t.column() if isinstance(t, Split) else F.lit(t) for t in self.trees]
        return reduce(lambda a, b: a + b, parts, F.lit(self.start))

    def probability(self) -> Column:
        return 1 / (1 + F.exp(-self.margin()))


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host, path, and what follows the path; all empty for a null or one without ://."""
    place = F.instr(url, "://")
    rest = F.when(place > 0, F.substring(url, place + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, UPPER.lower())
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path, F.regexp_extract(rest, r"^[^?#]*([\s\S]*)$", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Name of the longest rule that fits, null if none does."""
    cases = [
        F.when(
            ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path), F.lit(rule.name)
        )
        for rule in sorted(rules, key=lambda rule: -len(rule.name))
    ]
    return F.coalesce(*cases) if cases else F.lit(None).cast("string")


def lexical(pages: DataFrame, rules: Sequence[Rule], id_col: str, url_col: str) -> DataFrame:
    """id, host, path, rule, the rule's verdict and all lexical features."""
    host, path, tail = url_parts(F.col(url_col))
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(url_col), F.lit("")).alias("url"),
        host.alias("host"),
        path.alias("path"),
        tail.alias("tail"),
    )
    size = F.length("url")
    labels = F.split("host", r"\.")
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    last = F.coalesce(F.try_element_at(segments, F.lit(-1)), F.lit(""))
    shares = F.transform(
        F.array_distinct(F.split("url", "")), lambda c: (size - F.length(F.replace("url", c))) / size
    )
    entropy = F.aggregate(shares, F.lit(0.0), lambda total, p: total - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    verdicts = F.create_map(*(F.lit(x) for rule in rules for x in (rule.name, rule.verdict))) if rules else None
    query = F.regexp_extract("tail", r"^\?([^#]*)", 1)
    rows = rows.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules))
    return rows.select(
        "id",
        "host",
        "path",
        "rule",
        (verdicts[F.col("rule")] if rules else F.lit(None).cast("string")).alias("given"),
        size.alias("url_length"),
        F.length("host").alias("host_length"),
        F.size(F.filter(labels, lambda s: s != "")).alias("host_labels"),
        (F.length("host") - F.length(F.replace("host", F.lit("-")))).alias("host_hyphens"),
        F.size(segments).alias("depth"),
        F.when(size > 0, F.length(F.regexp_replace("url", "[^0-9]", "")) / size).otherwise(0.0).alias("digit_ratio"),
        F.when(size > 0, entropy).otherwise(0.0).alias("entropy"),
        F.size(F.filter(F.split(query, "&"), lambda s: s != "")).alias("parameters"),
        F.coalesce(F.regexp_extract(last, r"^([0-9])", 1).try_cast("int") + 1, F.lit(0)).alias("first_digit"),
        F.length(last).alias("last_length"),
        F.element_at(labels, -1).alias("host_suffix"),
        F.coalesce(F.try_element_at(segments, F.lit(1)), F.lit("")).alias("path_start"),
        F.regexp_extract(last, r"(\.[^.]*)$", 1).alias("path_end"),
    )


def blocked_shares(labelled: DataFrame, how: Boosting) -> list[DataFrame]:
    """Per key: its share of blocked URLs, drawn to the mean of all."""
    mean = labelled.agg(F.avg((F.col("given") == "block").cast("double"))).first()[0] or 0.0
    tables = []
    for key, out in zip(SUFFIXES, ("host_blocked", "start_blocked", "end_blocked")):
        share = (F.sum((F.col("given") == "block").cast("double")) + how.prior * mean) / (F.count(F.lit(1)) + how.prior)
        tables.append(cut_lineage(labelled.groupBy(key).agg(share.alias(out))))
    return tables


def binned(rows: DataFrame, shares: list[DataFrame], keep: Sequence[str]) -> DataFrame:
    """``keep`` and the bin of every feature; an unknown key has the lowest share."""
    for key, known in zip(SUFFIXES, shares):
        rows = rows.join(with_small(known, 4 * known.count()), key, "left")
    bins = []
    for name, edges in BINS.items():
        value = F.coalesce(F.col(name).cast("double"), F.lit(0.0))
        bin_ = sum(((value > float(edge)).cast("int") for edge in edges), F.lit(0))
        bins.append(bin_.alias(name))
    return rows.select(*keep, *bins)


def boost(vectors: DataFrame, how: Boosting) -> Model:
    """Trees by Newton steps on the logistic loss, one aggregation per level.

    ``vectors`` has a row per vector of bins, with ``n`` URLs of which ``blocked`` are
    blocked. Only sums per node, feature and bin come to the driver: at most
    ``2 ** (depth - 1)`` nodes times the bins of ``BINS``.
    """
    totals = vectors.agg(F.sum("n"), F.sum("blocked")).first()
    n, blocked = (float(x or 0) for x in totals)
    start = math.log((blocked + 0.5) / (n - blocked + 0.5)) if n else -math.inf
    if not n or blocked in (0.0, n):
        return Model(max(start, -30.0), ())
    trees: list[Split | float] = []
    places = F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).alias("bin")) for f in BINS)))
    for _ in range(how.trees):
        chance = Model(start, tuple(trees)).probability()
        rows = vectors.withColumn("p", chance).select(
            *BINS, (F.col("blocked") - F.col("n") * F.col("p")).alias("g"), (F.col("n") * F.col("p") * (1 - F.col("p"))).alias("h")
        )
        trees.append(_grow(rows, places, how))
    return Model(start, tuple(trees))


def _grow(rows: DataFrame, places: Column, how: Boosting) -> Split | float:
    """One tree; nodes are numbered as in a heap, 1 being the root."""
    chosen: dict[int, tuple[str, int]] = {}
    values: dict[int, float] = {}
    open_ = [1]
    for level in range(how.depth):
        node = F.lit(1)
        for at in sorted(chosen):
            feature, bin_ = chosen[at]
            side = F.when(F.col(feature) <= bin_, 2 * at).otherwise(2 * at + 1)
            node = F.when(node == at, side).otherwise(node)
        sums = (
            rows.withColumn("node", node)
            .filter(F.col("node").isin(open_))
            .select("node", "g", "h", places.alias("place"))
            .groupBy("node", "place.feature", "place.bin")
            .agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
            .collect()
        )
        following = []
        for at in open_:
            best = (1e-6, "", -1)
            own = [r for r in sums if r["node"] == at]
            for feature in BINS:
                held = sorted((r["bin"], r["g"], r["h"]) for r in own if r["feature"] == feature)
                g, h = sum(r[1] for r in held), sum(r[2] for r in held)
                values.setdefault(at, g / (h + how.ridge))
                left_g = left_h = 0.0
                for bin_, more_g, more_h in held[:-1]:
                    left_g, left_h = left_g + more_g, left_h + more_h
                    if min(left_h, h - left_h) * 4 < how.least:
                        continue
                    gain = (
                        left_g**2 / (left_h + how.ridge)
                        + (g - left_g) ** 2 / (h - left_h + how.ridge)
                        - g**2 / (h + how.ridge)
                    )
                    if round(gain, 6) > best[0]:
                        best = (round(gain, 6), feature, bin_)
                        values[2 * at] = left_g / (left_h + how.ridge)
                        values[2 * at + 1] = (g - left_g) / (h - left_h + how.ridge)
            if best[1]:
                chosen[at] = best[1:]
                following += [2 * at, 2 * at + 1]
        open_ = following
        if not open_:
            break

    def build(at: int) -> Split | float:
        if at not in chosen:
            return how.rate * values.get(at, 0.0)
        return Split(*chosen[at], build(2 * at), build(2 * at + 1))

    return build(1)


def judge(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    how: Boosting = Boosting(),
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """(id, host, path, rule, verdict, block_score) for every row.

    A null url and one without ``://`` have an empty host and path, fit no rule and are
    judged by the trees like any other. Where no rule labels a URL, everything else is
    allowed. Repeated rows are judged alike, and each counts in training; null ids are
    kept; an empty table gives no rows; other columns are not read. Of several longest
    rules the first decides. URLs of any length are read whole.
    """
    rows = lexical(pages, rules, id_col, url_col)
    labelled = rows.filter(F.col("given").isNotNull())
    shares = blocked_shares(labelled, how)
    vectors = cut_lineage(
        binned(labelled, shares, ["given"])
        .groupBy(*BINS)
        .agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("given") == "block").cast("long")).alias("blocked"))
    )
    model = boost(vectors, how)
    scored = binned(rows, shares, ["id", "host", "path", "rule", "given"]).withColumn("block_score", model.probability())
    judged = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    return scored.select(
        F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("given", judged).alias("verdict"), "block_score"
    )


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
