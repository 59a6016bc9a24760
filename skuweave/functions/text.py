"""Text normalisation, n-grams and similarity ratios."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F, types as T

# Ship the function below with the task, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: what is removed from a name before it is cut into n-grams. The
# class is comma to dot (comma, hyphen, dot) and slash.
NOISE = r"[,-./]|\sBD"


def without_noise(column: Column) -> Column:
    return F.regexp_replace(column, NOISE, "")


def ngrams(text: Column, n: int = 3) -> Column:
    """The character n-grams of a text in order, repeats included.

    Upper and lower case differ. A text shorter than ``n`` has none. Pass a plain
    column: an expression would be evaluated once per n-gram.
    """
    starts = F.sequence(F.lit(1), F.length(text) - F.lit(n - 1))
    return F.when(
        F.length(text) >= n, F.transform(starts, lambda i: F.substr(text, i, F.lit(n)))
    ).otherwise(F.array().cast("array<string>"))


def joined_name(*parts: Column) -> Column:
    """Concatenate; a missing part counts as empty text."""
    return F.concat(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def tokens(column: Column) -> Column:
    """The set of lower-case words; everything but letters, digits and ``_`` separates.

    Characters 128 to 255 are dropped first. Null gives null, no word an empty set.
    """
    plain = F.regexp_replace(column.cast("string"), "[\\u0080-\\u00FF]", "")
    words = F.split(F.lower(F.regexp_replace(plain, r"(?U)\W", " ")), " ")
    return F.array_distinct(F.filter(words, lambda w: w != ""))


def one_contains_other(a: Column, b: Column) -> Column:
    """Whether the token-set ratio of two token sets is 100: both non-empty, one in the other."""
    return (
        (F.size(a) > 0)
        & (F.size(b) > 0)
        & ((F.size(F.array_except(a, b)) == 0) | (F.size(F.array_except(b, a)) == 0))
    )


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence, one machine operation per row of the table.

    The table row is a bit vector in one integer (Hyyrö 2004): a cleared bit marks
    a position where the length grows.
    """
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hits = row & masks.get(ch, 0)
        row = ((row + hits) | (row - hits)) & full
    return len(a) - row.bit_count()


# Words of 64 bits that the bit vectors of a block of pairs may take together.
_MASK_WORDS = 4_000_000


def common_lengths(a: Sequence[str], b: Sequence[str], i: np.ndarray, j: np.ndarray, block: int = 65_536) -> np.ndarray:
    """Longest common subsequences of the pairs ``(a[i], b[j])``, a block of pairs at a time.

    As in ``lcs_length`` a cleared bit marks a place where the length grows; here every
    pair has its row of the table in as many words as its ``a`` needs, and the carry of
    the sum goes from word to word. All pairs of a block take a step at a time.
    """
    common = np.zeros(len(i), np.int64)
    a_codes, b_codes = ([np.frombuffer(x.encode("utf-32-le", "surrogatepass"), "<u4") for x in side] for side in (a, b))
    a_len, b_len = (np.array([len(x) for x in side], np.int64) for side in (a_codes, b_codes))
    words = -(-a_len // 64)
    # Pairs of like sizes stand together; an empty name has nothing in common.
    order = np.lexsort((b_len[j], words[i]))
    order = order[(a_len[i[order]] > 0) & (b_len[j[order]] > 0)]
    at = 0
    while at < len(order):
        wide = int(words[i[order[at]]])
        last = int(np.searchsorted(words[i[order]], wide, "right"))
        part = order[at : min(last, at + block)]
        letters = np.unique(np.concatenate([b_codes[k] for k in np.unique(j[part])]))
        part = part[: max(1, _MASK_WORDS // (wide * (len(letters) + 1)))]
        at += len(part)
        common[part] = _common_in_block(a_codes, b_codes, i[part], j[part], wide, letters)
    return common


def _common_in_block(a_codes, b_codes, i, j, wide: int, letters: np.ndarray) -> np.ndarray:
    own_a, i = np.unique(i, return_inverse=True)
    own_b, j = np.unique(j, return_inverse=True)
    # masks[name, letter, word]: where the name has the letter; one letter more has none.
    masks = np.zeros((len(own_a), len(letters) + 1, wide), np.uint64)
    lengths = np.array([len(a_codes[k]) for k in own_a])
    codes = np.concatenate([a_codes[k] for k in own_a])
    row = np.repeat(np.arange(len(own_a)), lengths)
    place = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    number = np.minimum(np.searchsorted(letters, codes), len(letters) - 1)
    known = letters[number] == codes
    bits = np.left_shift(np.uint64(1), (place % 64).astype(np.uint64))
    np.bitwise_or.at(masks, (row[known], number[known], place[known] // 64), bits[known])
    steps = np.array([len(b_codes[k]) for k in own_b])
    said = np.full((len(own_b), int(steps.max())), len(letters))
    for at, k in enumerate(own_b):
        said[at, : steps[at]] = np.searchsorted(letters, b_codes[k])
    table = np.full((wide, len(i)), ~np.uint64(0))
    for step in range(said.shape[1]):
        here = masks[i, said[j, step]]
        carry = np.zeros(len(i), np.uint64)
        for word in range(wide):
            before = table[word]
            hits = before & here[:, word]
            total = before + hits
            over = total < before
            total += carry
            carry = (over | (total < carry)).astype(np.uint64)
            table[word] = total | (before & ~hits)
    # Bits beyond the name stay set: its letters are nowhere there, and carries are kept by | .
    full = np.minimum(np.maximum(lengths[i][None, :] - 64 * np.arange(wide)[:, None], 0), 64)
    inside = np.where(full == 64, ~np.uint64(0), np.left_shift(np.uint64(1), (full % 64).astype(np.uint64)) - np.uint64(1))
    return lengths[i] - np.bitwise_count(table & inside).astype(np.int64).sum(0)


@F.pandas_udf(T.IntegerType())
def lcs(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in batches:
        every = np.arange(len(a))
        yield pd.Series(common_lengths(a.to_list(), b.to_list(), every, every), dtype="int32")


def ratio_of(common: Column, a: Column, b: Column) -> Column:
    """``100 * 2M / (|a| + |b|)`` rounded to an integer; equal texts give 100.

    Halves go to the even neighbour, so 69.5 counts as 70.
    """
    total = F.length(a) + F.length(b)
    percent = F.lit(200.0) * common / F.when(total > 0, total)
    return F.coalesce(F.bround(percent, 0).cast("int"), F.lit(100))


def edit_ratio(a: Column, b: Column) -> Column:
    """The indel similarity of two names, 0 to 100; a missing name gives 0."""
    both = a.isNotNull() & b.isNotNull()
    score = ratio_of(lcs(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))), a, b)
    return F.when(both, score).otherwise(F.lit(0))
