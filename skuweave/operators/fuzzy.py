"""Catalogue rows and input rows with similar names and agreeing units.

A pair matches when the edit ratio of the names reaches a minimum and, for each of
the two unit fields, the words of one contain those of the other. Every pair that can
match is compared; what cannot is left out by conditions that cost more and more:

- If the words of one side are within those of the other, so is its rarest word. The
  contained side is placed under that word of one unit field and the other side under
  all its words, so a row has a key for each of its words and two more. The field is the
  one whose words bring fewer pairs together.
- Lengths must be near enough that the common part can reach the minimum.
- Words of both unit fields must agree as far as 64-bit signatures tell.
- Names as sets of characters with their occurrence (the second ``l``): what 64-bit
  signatures of both sets share bounds what the names can have in common.
- The characters that two names have in common bound their common subsequence.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import Accumulator, cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from skuweave.functions.text import common_lengths, one_contains_other, tokens
from skuweave.operators.cells import CELL_ROWS, PLACE, meet
from skuweave.operators.dedup import keep_one
from skuweave.session import cut_lineage, together

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Characters are counted in this many classes for the bound on the ratio.
CLASSES = 64

# Rows that meet at least so many pairs together are compared as a table.
TABLE_PAIRS = 4_096

MATCH_SCHEMA = "q long, c long, name_similarity int"

# The columns of the result, in order.
RESULT_COLUMNS = (
    "name_all_skus",
    "Golden_record",
    "base_unit_content_allskus",
    "no_of_base_units_allskus",
    "gfgh_id",
    "name_gfgh",
    "no_of_base_units_gfgh",
    "base_unit_content_gfgh",
    "structure_packaging_unit_gfgh",
    "name_similarity",
    "base_unit_content_similarity",
    "no_base_units_similarity",
)


def _entries(df: DataFrame, name: str, units: str, content: str) -> DataFrame:
    """``(id, name, units, content, units_words, content_words)``, one per distinct triple.

    A missing name, or a unit without any word, cannot match and is left out.
    """
    distinct = df.select(
        F.col(name).alias("name"),
        F.col(units).cast("string").alias("units"),
        F.col(content).cast("string").alias("content"),
    ).distinct()
    return cut_lineage(
        distinct.withColumns({"units_words": tokens(F.col("units")), "content_words": tokens(F.col("content"))})
        .where(F.col("name").isNotNull() & (F.size("units_words") > 0) & (F.size("content_words") > 0))
        .withColumn("id", F.monotonically_increasing_id())
    )


def _signature(words: Column) -> Column:
    """A bit for each word. What one set holds of another shows in the bits."""
    bit = lambda w: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(w), F.lit(64)).cast("int"))
    return F.aggregate(words, F.lit(0).cast("long"), lambda all_, w: all_.bitwiseOR(bit(w)))


def _words_of(entries: DataFrame, field: str) -> DataFrame:
    return entries.select("id", F.explode(field).alias("word"))


def _met(inputs: DataFrame, catalog: DataFrame, field: str) -> tuple[DataFrame, int]:
    """How many rows have each word, and how many pairs meet under the words alone."""
    counted = [_words_of(side, field).groupBy("word").agg(F.count(F.lit(1)).alias(name)) for side, name in ((inputs, "q"), (catalog, "c"))]
    counts = cut_lineage(counted[0].join(counted[1], "word", "outer").fillna(0, ["q", "c"]))
    return counts, counts.agg(F.sum(F.col("q").cast("double") * F.col("c"))).first()[0] or 0


def _keyed(entries: DataFrame, field: str, counts: DataFrame, own: str) -> DataFrame:
    """``(id, key)``: under all words for where the other side is the contained one, and
    under the rarest for where this one is; ``own`` tells the sides apart.

    One word contains only itself, and such pairs meet where the catalogue is contained.
    """
    words = _words_of(entries, field).join(counts, "word").select("id", "word", (F.col("q") + F.col("c")).alias("n"))
    other = {"q": "c", "c": "q"}[own]
    rarest = words.groupBy("id").agg(F.min(F.struct("n", "word")).alias("first")).select("id", F.concat(F.lit(own), "first.word").alias("key"))
    if own == "c":
        words = words.join(entries.where(F.size(field) > 1).select("id"), "id", "left_semi")
    return rarest.unionByName(words.select("id", F.concat(F.lit(other), "word").alias("key")))


def similar_in_cell(min_ratio: int, compared: Accumulator | None = None, block_pairs: int = 1 << 18) -> Callable:
    """The kernel of a cell: pairs of one key whose edit ratio reaches the minimum.

    Pairs of like keys and possible lengths are enumerated and thinned out
    ``block_pairs`` at a time. ``compared`` counts those whose characters are counted.
    """
    lowest = (min_ratio - 0.5) / 200.0

    def occurrences(codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """For every character of all names: the name, and character and occurrence in one."""
        lengths = np.array([len(c) for c in codes], np.int64)
        row, flat = np.repeat(np.arange(len(codes)), lengths), np.concatenate([*codes, np.zeros(0, "<u4")]).astype(np.int64)
        order = np.lexsort((flat, row))
        row, flat = row[order], flat[order]
        new = np.concatenate([[True], (row[1:] != row[:-1]) | (flat[1:] != flat[:-1])]) if len(row) else np.zeros(0, bool)
        starts = np.flatnonzero(new)
        place = np.arange(len(row)) - np.repeat(starts, np.diff(starts, append=len(row)))
        return row, place * 0x110000 + flat

    def signatures(row: np.ndarray, item: np.ndarray, rank: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """A bit for each item of a name; with few items in a cell, each has its own."""
        bits = np.zeros(len(lengths), np.uint64)
        np.bitwise_or.at(bits, row, np.left_shift(np.uint64(1), (rank[item] % 64).astype(np.uint64)))
        return bits

    def class_counts(codes: list[np.ndarray]) -> np.ndarray:
        lengths = np.array([len(c) for c in codes], np.int64)
        flat = np.concatenate([*codes, np.zeros(0, "<u4")]).astype(np.int64) % CLASSES
        return np.bincount(np.repeat(np.arange(len(codes)), lengths) * CLASSES + flat, minlength=len(codes) * CLASSES).reshape(-1, CLASSES).astype(np.int32)

    def agree(left: pd.DataFrame, right: pd.DataFrame, field: str, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = left[field].to_numpy()[i], right[field].to_numpy()[j]
        both = a & b
        return (both == a) | (both == b)

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"q": np.zeros(0, np.int64), "c": np.zeros(0, np.int64), "name_similarity": np.zeros(0, np.int32)})]
        if not len(left) or not len(right):
            return found[0]
        names = [side["name"].drop_duplicates().reset_index(drop=True) for side in (left, right)]
        at = [side["name"].map(pd.Series(own.index, own)).to_numpy() for side, own in zip((left, right), names)]
        codes = [[np.frombuffer(n.encode("utf-32-le", "surrogatepass"), "<u4") for n in own] for own in names]
        lengths = [np.array([len(c) for c in own], np.int64) for own in codes]
        counts = [class_counts(own) for own in codes]
        rows, items = zip(*(occurrences(own) for own in codes))
        # One number for both sides: the rarest first.
        _, number, times = np.unique(np.concatenate(items), return_inverse=True, return_counts=True)
        rank = np.empty(len(times), np.int64)
        rank[np.argsort(times, kind="stable")] = np.arange(len(times))
        item = np.split(number, [len(items[0])])
        bits = [signatures(rows[k], item[k], rank, lengths[k]) for k in (0, 1)]
        # What a name has beyond its bits, and its part of the least that must be in common.
        spare = [lengths[k] - np.bitwise_count(bits[k]).astype(np.int64) for k in (0, 1)]
        least = [lowest * lengths[k] - 1e-9 for k in (0, 1)]

        # The catalogue's rows by key, then by length: a query's rows meet one stretch.
        known, number = np.unique(right["key"].to_numpy(), return_inverse=True)
        step = int(max(lengths[0].max(), lengths[1].max())) + 2
        place = number * step + lengths[1][at[1]]
        order = np.argsort(place, kind="stable")
        place = place[order]
        number = pd.Series(np.arange(len(known)), known).reindex(left["key"]).to_numpy()
        mine = np.flatnonzero(~np.isnan(number))
        number, own = number[mine].astype(np.int64), lengths[0][at[0][mine]]
        near = np.ceil(own * lowest / (1 - lowest) - 1e-9) if 0 < lowest < 1 else np.zeros(len(own))
        far = np.floor(own * (1 - lowest) / lowest + 1e-9) if 0 < lowest < 1 else np.full(len(own), step)
        first = np.searchsorted(place, number * step + np.minimum(near, step - 1), "left")
        width = np.maximum(np.searchsorted(place, number * step + np.minimum(far, step - 1), "right") - first, 0)

        def possible(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            """Whether the bits that both names have, and what bits do not tell, can be enough."""
            shared = np.bitwise_count(bits[0][a] & bits[1][b])
            enough = shared >= (least[0] - spare[0])[a] + least[1][b]
            return enough & (shared >= least[0][a] + (least[1] - spare[1])[b])

        def stretches() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            """Rows of both sides that may match, a block at a time.

            Rows of one key and length meet the same stretch: where that is long, they are
            compared as a table, else pair by pair.
            """
            like = np.lexsort((width, first))
            starts = np.flatnonzero(np.concatenate([[True], (np.diff(first[like]) != 0) | (np.diff(width[like]) != 0)]))[: len(like)]
            sizes = np.diff(starts, append=len(like))
            wide = sizes * width[like[starts]] >= TABLE_PAIRS
            for start, size in zip(starts[wide], sizes[wide]):
                row, n = like[start], int(width[like[start]])
                for low in range(0, n, block_pairs):
                    own = order[first[row] + low : first[row] + min(n, low + block_pairs)]
                    step = max(1, block_pairs // len(own))
                    for at_row in range(start, start + size, step):
                        asked = mine[like[at_row : min(at_row + step, start + size)]]
                        i, j = np.nonzero(possible(at[0][asked][:, None], at[1][own][None, :]))
                        yield asked[i], own[j]
            rest = np.sort(like[np.repeat(~wide, sizes)])
            reached = np.cumsum(width[rest])
            start = 0
            while start < len(rest):
                before = reached[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(reached, before + block_pairs, "right")))
                n, from_ = width[rest[start:stop]], first[rest[start:stop]]
                i = np.repeat(mine[rest[start:stop]], n)
                j = order[np.repeat(from_ - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
                keep = possible(at[0][i], at[1][j])
                yield i[keep], j[keep]
                start = stop

        for i, j in stretches():
            keep = np.ones(len(i), bool)
            for field in ("units_bits", "content_bits"):
                keep &= agree(left, right, field, i, j)
            i, j = i[keep], j[keep]
            if not len(i):
                continue
            a, b = at[0][i], at[1][j]
            total = lengths[0][a] + lengths[1][b]
            if compared is not None:
                compared.add(len(i))
            bound = np.minimum(counts[0][a], counts[1][b]).sum(1)
            keep = bound >= lowest * total - 1e-9
            i, j, a, b, total = (x[keep] for x in (i, j, a, b, total))
            # Names that meet in several rows are compared once.
            pair, back = np.unique(a * len(names[1]) + b, return_inverse=True)
            common = common_lengths(names[0], names[1], pair // len(names[1]), pair % len(names[1]))[back]
            ratio = np.where(total > 0, np.rint(200.0 * common / np.maximum(total, 1)), 100)
            keep = ratio >= min_ratio
            found.append(
                pd.DataFrame(
                    {
                        "q": left["id"].to_numpy()[i[keep]],
                        "c": right["id"].to_numpy()[j[keep]],
                        "name_similarity": ratio[keep].astype("int32"),
                    }
                )
            )
        return pd.concat(found)

    return run


def matching_entries(
    catalog: DataFrame,
    inputs: DataFrame,
    min_ratio: int = 70,
    cell_rows: int = CELL_ROWS,
    compared: Accumulator | None = None,
) -> DataFrame:
    """``(q, c, name_similarity)`` of the matching entries of both sides."""
    fields = ("units_words", "content_words")
    # The words of one field decide who meets, those that bring fewer pairs together.
    (counts, _), field = min(
        zip(together(*(lambda f=f: _met(inputs, catalog, f) for f in fields)), fields), key=lambda found: found[0][1]
    )
    placed = together(
        lambda: cut_lineage(_keyed(inputs, field, counts, "q")), lambda: cut_lineage(_keyed(catalog, field, counts, "c"))
    )
    queries, known = meet(*placed, "key", None, cell_rows)
    named = [
        keys.join(
            side.select("id", "name", _signature(F.col("units_words")).alias("units_bits"), _signature(F.col("content_words")).alias("content_bits")),
            "id",
        )
        for keys, side in ((queries, inputs), (known, catalog))
    ]
    similar = (
        named[0].groupBy(*PLACE)
        .cogroup(named[1].groupBy(*PLACE))
        .applyInPandas(similar_in_cell(min_ratio, compared), MATCH_SCHEMA)
        .distinct()
    )

    def words(side: DataFrame, id_name: str) -> DataFrame:
        return side.select(
            F.col("id").alias(id_name),
            F.col("units_words").alias(f"{id_name}_units"),
            F.col("content_words").alias(f"{id_name}_content"),
        )

    return (
        similar.join(words(inputs, "q"), "q").join(words(catalog, "c"), "c")
        .where(
            one_contains_other(F.col("q_units"), F.col("c_units"))
            & one_contains_other(F.col("q_content"), F.col("c_content"))
        )
        .select("q", "c", "name_similarity")
    )


def fuzzy_match(
    catalog: DataFrame,
    inputs: DataFrame,
    min_ratio: int = 70,
    cell_rows: int = CELL_ROWS,
    compared: Accumulator | None = None,
) -> DataFrame:
    """Every matching pair of a catalogue row and an input row.

    ``catalog`` has ``identifier, name, base_unit_content, no_of_base_units``;
    ``inputs`` has ``gfgh_id, name, no_of_base_units, base_unit_content,
    structure_packaging_unit``. Pairs equal in names, ids and similarity are kept
    once, the smallest remaining columns first. A missing unit matches nothing.
    """
    fields = ("name", "no_of_base_units", "base_unit_content")
    prepared = together(lambda: _entries(inputs, *fields), lambda: _entries(catalog, *fields))
    entries = dict(zip("qc", prepared))
    # Written before rows are attached: the comparisons are not repeated if executors
    # are lost, and the joins below start from a shuffle, so AQE can split hot entries.
    matches = cut_lineage(
        matching_entries(entries["c"], entries["q"], min_ratio, cell_rows, compared)
    )

    # Copies give the same pairs, so they are dropped before they can multiply.
    catalog = catalog.select("identifier", *fields).distinct()
    inputs = keep_one(
        inputs.select("gfgh_id", *fields, "structure_packaging_unit"), ["gfgh_id", *fields]
    )

    def rows(df: DataFrame, side: str, names: dict[str, str]) -> DataFrame:
        prepared = df.withColumns(
            {c: F.col(c).cast("string") for c in ("no_of_base_units", "base_unit_content")}
        )
        numbered = entries[side].select(
            F.col("id").alias(side), "name",
            F.col("units").alias("no_of_base_units"), F.col("content").alias("base_unit_content"),
        )
        return prepared.join(numbered, list(fields)).select(
            side, *[F.col(old).alias(new) for old, new in names.items()]
        )

    known = rows(catalog, "c", {
        "name": "name_all_skus",
        "identifier": "Golden_record",
        "base_unit_content": "base_unit_content_allskus",
        "no_of_base_units": "no_of_base_units_allskus",
    })
    asked = rows(inputs, "q", {
        "gfgh_id": "gfgh_id",
        "name": "name_gfgh",
        "no_of_base_units": "no_of_base_units_gfgh",
        "base_unit_content": "base_unit_content_gfgh",
        "structure_packaging_unit": "structure_packaging_unit_gfgh",
    })
    pairs = matches.join(known, "c").join(asked, "q").withColumns(
        {"base_unit_content_similarity": F.lit(100), "no_base_units_similarity": F.lit(100)}
    )
    keys = ["name_all_skus", "Golden_record", "gfgh_id", "name_gfgh", "name_similarity"]
    return keep_one(pairs.select(*RESULT_COLUMNS), keys)
