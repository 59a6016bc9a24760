"""Best catalogue names per input name by TF-IDF cosine of character n-grams.

The catalogue decides vocabulary and weights; n-grams it lacks are ignored. All
work is on distinct names, so copies of a name never meet each other. The result is
that of comparing all names with each other, but few pairs are compared:

- n-grams are ordered from the rarest to the most frequent. Let g be the rarest one
  that two names share. Nothing ahead of it counts, so the score is at most the product
  of the lengths of both vectors from g on. A name is therefore placed only under the
  n-grams up to which its own remaining length can still make a match, and the catalogue
  side is placed in bands of that length, of which a query visits those that its own
  remaining length leaves possible. Within a band the product is checked pair by pair.
- An n-gram that only one side has adds to the length of a name and to nothing else. The
  others make up what is compared: of inputs equal in them one asks for all, and of
  catalogue names equal in them only the shortest vectors can be the best.
- The first passes look for good matches only, each for less than the one before. Who has
  found N of them is done; the N-th best score found is the least that a match of that
  query must reach in the next pass.

Names meet in cells of bounded size, keyed by n-gram and band, and each cell returns only
its best matches.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Accumulator, cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from skuweave.functions.text import ngrams, without_noise
from skuweave.operators.cells import CELL_ROWS, PLACE, meet
from skuweave.session import cut_lineage, spread, together

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Room for floating point in the bounds, and decimals that count when ranking.
SLACK = 1e-9
SCORE_DECIMALS = 9

# Lengths of vectors that agree to so many decimals are equal but for floating point.
NORM_DECIMALS = 12

# Passes that look for good matches before the last one, which asks for any.
GOOD_PASSES = 2

# Bands of remaining length in a unit vector.
BANDS = 16

MATCH_SCHEMA = "q long, c long, score double"


def distinct_names(df: DataFrame, column: str) -> DataFrame:
    """``(name, copies)`` of the names present."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("name"))
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def numbered_names(df: DataFrame, column: str) -> DataFrame:
    """``(id, name, copies)``, with ids in the order of the names, fixed by writing them."""
    names = distinct_names(df, column).orderBy("name")
    return spread(cut_lineage(names.withColumn("id", F.monotonically_increasing_id())), "id")


def term_counts(names: DataFrame, n: int = 3, key: str = "name") -> DataFrame:
    """``(key, copies, gram, tf)``: how often each n-gram occurs in each name.

    Names partitioned by the key are not moved by this.
    """
    text = names.select(key, "copies", without_noise(F.col("name")).alias("_text"))
    return (
        text.select(key, "copies", F.explode(ngrams(F.col("_text"), n)).alias("gram"))
        .groupBy(key, "copies", "gram")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def smoothed_idf(df: Column, documents: int) -> Column:
    return F.log(F.lit(1.0 + documents) / (F.lit(1) + df)) + F.lit(1.0)


def fit_vocabulary(names: DataFrame, counts: DataFrame) -> DataFrame:
    """``(gram, df, idf)``: in how many catalogue rows, copies included, and its weight."""
    documents = names.agg(F.sum("copies")).first()[0] or 0
    frequency = counts.groupBy("gram").agg(F.sum("copies").alias("df"))
    return frequency.select("gram", "df", smoothed_idf(F.col("df"), documents).alias("idf"))


def inverse_document_frequency(catalog: DataFrame, column: str, n: int = 3) -> DataFrame:
    names = distinct_names(catalog, column)
    return fit_vocabulary(names, term_counts(names, n))


def vector_norms(catalog: DataFrame, column: str, n: int = 3) -> DataFrame:
    """``(name, norm)``: the length of each catalogue name's weight vector."""
    names = distinct_names(catalog, column)
    counts = term_counts(names, n)
    weight = F.col("tf") * F.col("idf")
    return (
        counts.join(fit_vocabulary(names, counts), "gram")
        .groupBy("name")
        .agg(F.sqrt(F.sum(weight * weight)).alias("norm"))
    )


def _weighted(counts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``(id, grams, weights, norm)``: one row per name, with the length of its vector.

    ``grams`` and ``weights`` run from the rarest n-gram of the catalogue to the most
    frequent, the same order for all names, and hold only n-grams that an input has: no
    other counts in a product. A row holds the n-grams of one name, no more. Sums run
    in that order, so names with equal n-grams have equal numbers.
    """
    term = F.struct("df", "gram_id", (F.col("tf") * F.col("idf")).alias("w"), "asked")
    terms = counts.join(vocabulary, "gram").groupBy("id").agg(F.sort_array(F.collect_list(term)).alias("terms"))
    asked = F.filter("terms", lambda t: t["asked"])
    norm2 = F.aggregate("terms", F.lit(0.0), lambda done, t: done + t["w"] * t["w"])
    weighted = terms.select("id", asked.alias("terms"), F.sqrt(norm2).alias("norm"))
    return cut_lineage(
        weighted.where(F.size("terms") > 0)
        .select("id", F.col("terms.gram_id").alias("grams"), F.col("terms.w").alias("weights"), "norm")
    )


def _alike(rows: DataFrame) -> DataFrame:
    """``rows`` with ``like``, a number that equal vectors share; compared with the vectors it only speeds up."""
    return rows.withColumn("like", F.xxhash64("grams", "weights"))


# What makes two names the same to every name of the other side, but for their length.
SAME = ("like", "grams", "weights")


def _represented(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row of each group of equal vectors, and ``(id, q)``: which row stands for a name."""
    rows = _alike(rows)
    groups = cut_lineage(rows.groupBy(*SAME).agg(F.min("id").alias("q"), F.min("norm").alias("norm")))
    members = cut_lineage(rows.join(groups.select(*SAME, "q"), list(SAME)).select("id", "q"))
    return groups.select(F.col("q").alias("id"), "grams", "weights", "norm"), members


def _possible(rows: DataFrame, top: int, least: float) -> DataFrame:
    """The rows that can be among the ``top`` best of any query.

    Of names with equal weights for all that inputs have, the shortest vectors score best,
    whatever the query. Left out are names behind ``top`` others that are shorter by more
    than rounding can hide, and behind ``top`` others that are as long and sort first.
    """
    rows = _alike(rows)
    long = F.round("norm", NORM_DECIMALS)
    ahead = Window.partitionBy(*SAME, long).orderBy("id")
    rows = rows.withColumn("_n", F.row_number().over(ahead)).where(F.col("_n") <= top).drop("_n")
    if least < 1e-6:
        return rows.drop("like")
    rows = cut_lineage(rows)
    order = Window.partitionBy(*SAME).orderBy("norm", "id")
    reach = (
        rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= top)
        .groupBy(*SAME).agg(F.max("norm").alias("_reach"), F.count(F.lit(1)).alias("_found"))
    )
    near = F.col("norm") <= F.col("_reach") * F.lit(1.0 + 4 * 10.0**-SCORE_DECIMALS / least)
    kept = rows.join(reach, list(SAME)).where(near | (F.col("_found") < top))
    return kept.select("id", "grams", "weights", "norm")


def _vectors(rows: DataFrame, least: float) -> DataFrame:
    """``(id, grams, weights, rests)``: unit vectors, and the length of what is left of
    each from each n-gram on, as far as it reaches ``least``."""
    square = F.aggregate("weights", F.lit(0.0), lambda done, w: done + w * w)
    start = F.struct(square.alias("left"), F.array().cast("array<double>").alias("rests"))
    enough = F.lit(least * least - SLACK) * F.col("norm") * F.col("norm")
    rests = F.aggregate(
        "weights",
        start,
        lambda done, w: F.struct(
            (done["left"] - w * w).alias("left"),
            F.when(
                done["left"] >= enough,
                F.array_append(done["rests"], F.sqrt(F.greatest(F.lit(0.0), done["left"])) / F.col("norm")),
            ).otherwise(done["rests"]).alias("rests"),
        ),
        lambda done: done["rests"],
    )
    unit = F.transform("weights", lambda w: w / F.col("norm"))
    return cut_lineage(rows.select("id", "grams", unit.alias("weights"), rests.alias("rests")))


def _band(rest: Column) -> Column:
    """Which band of remaining length; 0 is that of the whole vector."""
    return F.floor((F.lit(1.0) - rest) * BANDS).cast("int")


def _key(gram: Column, band: Column) -> Column:
    """One number per n-gram and band; where two coincide, more pairs are compared."""
    return F.xxhash64(gram, band)


def _cells(
    queries: DataFrame, catalog: DataFrame, least: float, cell_rows: int
) -> tuple[DataFrame, DataFrame]:
    """Both sides in the cells of the n-grams and bands in which a match can begin.

    ``queries`` has a column ``theta``, what a match of the query must reach, which is
    at least ``least``. A row gains ``keys``: what places it in the cell.
    """
    each = F.posexplode("rests").alias("at", "rest")
    own = catalog.select("id", "grams", each).where(F.col("rest") >= least - SLACK)
    placed_catalog = own.select("id", _key(F.element_at("grams", F.col("at") + 1), _band(F.col("rest"))).alias("key"), "rest")
    asked = queries.select("id", "theta", "grams", each).where(F.col("rest") >= F.col("theta") - SLACK)
    last = _band(F.col("theta") / F.col("rest") - F.lit(SLACK))
    asked = asked.select("id", "rest", F.element_at("grams", F.col("at") + 1).alias("gram"), F.explode(F.sequence(F.lit(0), last)).alias("band"))
    placed_queries = asked.select("id", _key(F.col("gram"), F.col("band")).alias("key"), "rest")
    written = together(lambda: cut_lineage(placed_queries), lambda: cut_lineage(placed_catalog))
    placed = meet(*written, "key", None, cell_rows)

    def gathered(keys: DataFrame, side: DataFrame) -> DataFrame:
        together_ = keys.groupBy("id", *PLACE).agg(F.collect_list(F.struct("key", "rest")).alias("keys"))
        return together_.join(side.drop("rests"), "id")

    return gathered(placed[0], queries), gathered(placed[1], catalog)


def best_in_cell(
    top: int, least: float, compared: Accumulator | None = None, block_pairs: int = 1 << 18
) -> Callable:
    """The kernel of a cell: exact scores of the pairs that can match, the ``top`` best per query.

    A pair is compared where both names have the same key and the product of their
    remaining lengths reaches what the query asks for. Scores are held for about
    ``block_pairs`` pairs at a time. ``compared`` counts the pairs.
    """

    def lists(table: pa.Table, name: str) -> tuple[np.ndarray, pa.Array]:
        column = table[name].combine_chunks()
        return pc.list_value_length(column).to_numpy(), column.flatten()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [np.zeros((0, 3))]
        if len(left) and len(right):
            left, right = left.sort_by("id"), right.sort_by("id")
            q_ids, c_ids = left["id"].to_numpy(), right["id"].to_numpy()
            theta = left["theta"].to_numpy()
            q_size, q_gram = lists(left, "grams")
            c_size, c_gram = lists(right, "grams")
            q_w, c_w = (lists(side, "weights")[1].to_numpy() for side in (left, right))
            terms, c_term = np.unique(c_gram.to_numpy(), return_inverse=True)
            q_gram = q_gram.to_numpy()
            q_term = np.minimum(np.searchsorted(terms, q_gram), len(terms) - 1)
            q_w = np.where(terms[q_term] == q_gram, q_w, 0.0)
            q_stop, c_stop = np.cumsum(q_size), np.cumsum(c_size)

            # The catalogue's entries by key, then by remaining length from long to short:
            # what a query's entry can reach is one stretch of them.
            n, keys = lists(right, "keys")
            c_of, names = np.repeat(np.arange(len(right)), n), keys.field("key").to_numpy()
            known, number = np.unique(names, return_inverse=True)
            place = 2.0 * number + (1.0 - keys.field("rest").to_numpy())
            order = np.argsort(place, kind="stable")
            place, c_of = place[order], c_of[order]
            n, keys = lists(left, "keys")
            q_of, names = np.repeat(np.arange(len(left)), n), keys.field("key").to_numpy()
            number = np.minimum(np.searchsorted(known, names), len(known) - 1)
            mine = known[number] == names
            q_of, number, rest = q_of[mine], number[mine], keys.field("rest").to_numpy()[mine]
            first = np.searchsorted(place, 2.0 * number, "left")
            # 1 + SLACK lies between the keys' stretches, which are two apart.
            far = np.minimum(1.0 + SLACK, 1.0 - theta[q_of] / rest + SLACK)
            width = np.maximum(np.searchsorted(place, 2.0 * number + far, "right") - first, 0)

            most = max(1, 8 * block_pairs // len(terms))
            reached = np.cumsum(width)
            start = 0
            while start < len(q_of):
                before = reached[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(reached, before + block_pairs, "right")))
                # Entries of the same queries stand together, so few queries are in a block.
                stop = min(stop, max(start + 1, int(np.searchsorted(q_of, q_of[start] + most, "left"))))
                times = width[start:stop]
                c_at = np.repeat(first[start:stop] - (np.cumsum(times) - times), times) + np.arange(times.sum())
                pairs = np.unique(np.repeat(q_of[start:stop], times) * len(c_ids) + c_of[c_at])
                start = stop
                if not len(pairs):
                    continue
                if compared is not None:
                    compared.add(len(pairs))
                q, c = pairs // len(c_ids), pairs % len(c_ids)
                low, high = q[0], q[-1] + 1
                dense = np.zeros((high - low, len(terms)))
                own = slice(q_stop[low] - q_size[low], q_stop[high - 1])
                np.add.at(dense, (np.repeat(np.arange(high - low), q_size[low:high]), q_term[own]), q_w[own])
                size = c_size[c]
                at = np.repeat(c_stop[c] - np.cumsum(size), size) + np.arange(size.sum())
                products = dense[np.repeat(q - low, size), c_term[at]] * c_w[at]
                score = np.round(np.add.reduceat(products, np.cumsum(size) - size), SCORE_DECIMALS)
                keep = score > least
                q, c, score = q[keep], c[keep], score[keep]
                order = np.lexsort((c, -score, q))
                q, c, score = q[order], c[order], score[order]
                ahead = np.arange(len(q)) - np.searchsorted(q, q, "left")
                found.append(np.stack([q, c, score], 1)[ahead < top])
        best = np.concatenate(found)
        return pa.table(
            {
                "q": q_ids[best[:, 0].astype(np.int64)] if len(best) else np.zeros(0, np.int64),
                "c": c_ids[best[:, 1].astype(np.int64)] if len(best) else np.zeros(0, np.int64),
                "score": best[:, 2],
            }
        )

    return run


def _levels(good: float, least: float) -> list[float]:
    """What the passes ask for, from ``good`` to ``least``."""
    if least >= good:
        return [least]
    return [good - (good - least) * step / GOOD_PASSES for step in range(GOOD_PASSES)] + [least]


def _best(matches: DataFrame, top: int) -> DataFrame:
    """``(q, c, score, n)``: the ``top`` best of each query; equal scores by catalogue name."""
    order = Window.partitionBy("q").orderBy(F.desc("score"), "c")
    return matches.distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= top)


def tfidf_match(
    catalog: DataFrame,
    inputs: DataFrame,
    catalog_name: str = "sku_title",
    input_name: str = "name",
    n: int = 3,
    top: int = 1,
    lower_bound: float = 0.0,
    min_score: float = 0.5,
    cell_rows: int = CELL_ROWS,
    good: float = 0.8,
    compared: Accumulator | None = None,
) -> DataFrame:
    """``(name_input, name_all_skus, similarity)``: the ``top`` matches of each distinct name.

    Matches score above ``lower_bound`` and ``min_score``; equal scores go to the
    catalogue name that sorts first. ``good`` is what the first pass looks for; it
    changes the work and not the result. ``compared`` counts the pairs that were scored.
    """
    least = max(lower_bound, min_score)
    names, query_names = together(
        lambda: numbered_names(catalog, catalog_name), lambda: numbered_names(inputs, input_name)
    )
    counts = term_counts(names, n, "id")
    query_counts = term_counts(query_names, n, "id")
    asked_grams = query_counts.select("gram").distinct().withColumn("asked", F.lit(True))
    vocabulary = cut_lineage(
        fit_vocabulary(names, counts)
        .join(asked_grams, "gram", "left")
        .withColumns({"asked": F.coalesce("asked", F.lit(False)), "gram_id": F.monotonically_increasing_id()})
    )
    catalog_rows, (query_rows, members) = together(
        lambda: _vectors(_possible(_weighted(counts, vocabulary), top, least), least),
        lambda: _represented(_weighted(query_counts, vocabulary)),
    )
    query_rows = _vectors(query_rows, least)

    def matched(queries: DataFrame, lowest: float) -> DataFrame:
        asked, known = _cells(queries, catalog_rows, lowest, cell_rows)
        pairs = (
            asked.groupBy(*PLACE)
            .cogroup(known.groupBy(*PLACE))
            .applyInArrow(best_in_cell(top, least, compared), MATCH_SCHEMA)
        )
        return cut_lineage(_best(pairs, top))

    # Whoever has N matches as good as a pass asks for has the best; the others ask the
    # next pass for less, but for no less than they have found so far.
    found = []
    asking = query_rows.select("id", F.lit(max(good, least)).alias("theta"))
    for level in _levels(good, least):
        asking = cut_lineage(asking.withColumn("theta", F.greatest("theta", F.lit(level))))
        best = matched(query_rows.join(asking, "id"), level)
        found.append(best.drop("n"))
        if level > least:
            reached = best.where(F.col("n") == top).select(F.col("q").alias("id"), F.col("score").alias("_reached"))
            asking = (
                asking.join(reached, "id", "left")
                .where(F.col("_reached").isNull() | (F.col("_reached") < F.col("theta")))
                .select("id", (F.coalesce("_reached", F.lit(0.0)) - F.lit(10.0**-SCORE_DECIMALS)).alias("theta"))
            )
    best = _best(functools.reduce(DataFrame.unionByName, found), top)
    return (
        best.join(members, "q")
        .join(query_names.select("id", F.col("name").alias("name_input")), "id")
        .join(names.select(F.col("id").alias("c"), F.col("name").alias("name_all_skus")), "c")
        .select("name_input", "name_all_skus", F.col("score").alias("similarity"))
    )


def first_matches(matches: DataFrame, top: int = 0, order: str = "name_input") -> DataFrame:
    """The first ``top`` matches in input order; 0 keeps all."""
    return matches.orderBy(order, F.desc("similarity"), "name_all_skus").limit(top) if top else matches
