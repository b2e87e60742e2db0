"""Pair similarities. Native where Spark has the means, Arrow UDFs for the rest."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from functools import lru_cache
from math import sqrt
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


#: Below this many characters bits are set one by one, which takes time with the square of the length.
SHORT = 1_000
#: Bits between two texts in one integer: each step carries at most one of them on, so that they are cleared that often.
GUARD = 64
#: Bits of such an integer, unless one text has more.
JOINED = 200_000


def jaccard(a: Column, b: Column) -> Column:
    """Of two token arrays as sets: 1 if both are empty, 0 if one is."""
    common = F.size(F.array_intersect(a, b))
    whole = F.size(F.array_union(a, b))
    return F.when(whole == 0, F.lit(1.0)).otherwise(common / whole)


def _places(a: str) -> dict[str, int]:
    """Of each character of ``a`` an integer with a bit for each of its places."""
    if len(a) < SHORT:
        places: dict[str, int] = {}
        for i, c in enumerate(a):
            places[c] = places.get(c, 0) | 1 << i
        return places
    codes, which = np.unique(np.frombuffer(a.encode("utf-32-le", "surrogatepass"), np.uint32), return_inverse=True)
    return {chr(c): int.from_bytes(np.packbits(which == i, bitorder="little").tobytes(), "little") for i, c in enumerate(codes.tolist())}


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence, a bit of one integer for each character of the longer; what both begin and end with is in it."""
    lead = len(commonprefix((a, b)))
    a, b = a[lead:], b[lead:]
    tail = len(commonprefix((a[::-1], b[::-1])))
    if tail:
        a, b = a[:-tail], b[:-tail]
    if len(a) < len(b):
        a, b = b, a
    if not b:
        return lead + tail
    places = _places(a)
    free = full = (1 << len(a)) - 1
    for c in b:
        if c in places:
            hit = free & places[c]
            free = free + hit | free ^ hit  # a carry beyond the last bit changes no bit before it
    return lead + tail + len(a) - (free & full).bit_count()


@lru_cache(maxsize=2_000)
def ratio(a: str, b: str) -> float:
    """2 LCS / (|a| + |b|); two blanks are alike, a blank and a text are not."""
    return 1.0 if not a and not b else 2.0 * lcs_length(a, b) / (len(a) + len(b))


def _joined_lengths(texts: list[str], places: list[dict[str, int]], b: str) -> list[int]:
    """Longest common subsequences of several texts with ``b``, all texts' bits in one integer."""
    starts, at, full = [], 0, 0
    every: dict[str, int] = {}
    for a, its in zip(texts, places):
        starts.append(at)
        for c, bits in its.items():
            every[c] = every.get(c, 0) | bits << at
        full |= ((1 << len(a)) - 1) << at
        at += len(a) + GUARD
    free, get = full, every.get
    for lo in range(0, len(b), GUARD):
        for c in b[lo : lo + GUARD]:
            if bits := get(c):
                hit = free & bits
                free = free + hit | free ^ hit
        free &= full
    return [len(a) - (free >> start & (1 << len(a)) - 1).bit_count() for a, start in zip(texts, starts)]


def ratios(texts: list[str], b: str, places: Callable[[str], dict[str, int]] = _places) -> list[float]:
    """:func:`ratio` of each text with ``b``: texts of like length, other than near copies, go together."""
    out, together = [0.0] * len(texts), []
    for i, a in enumerate(texts):
        short = min(len(a), len(b))
        ends = len(commonprefix((a, b))) + len(commonprefix((a[: -short - 1 : -1], b[: -short - 1 : -1]))) if short and (a[0] == b[0] or a[-1] == b[-1]) else 0
        if not short or 2 * ends > short or 4 * len(a) < len(b):
            out[i] = ratio(a, b)
        else:
            together.append(i)
    group, bits = [], 0
    for place, i in enumerate(together):
        group.append(i)
        bits += len(texts[i]) + GUARD
        last = place + 1 == len(together)
        if not last and bits + len(texts[together[place + 1]]) <= JOINED:
            continue
        if len(group) == 1:
            out[i] = ratio(texts[i], b)
        else:
            some = [texts[x] for x in group]
            for x, n in zip(group, _joined_lengths(some, [places(a) for a in some], b)):
                out[x] = 2.0 * n / (len(texts[x]) + len(b))
        group, bits = [], 0
    return out


@F.arrow_udf(DoubleType())
def seq_ratio(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([ratio(x or "", y or "") for x, y in zip(a.to_pylist(), b.to_pylist())], pa.float64())


def quick_ratio(a: Column, b: Column) -> Column:
    """The same with the overlap of character counts for the LCS, an upper bound of it. Native."""
    chars = F.array_distinct(F.split(a, ""))

    def count(text: Column, c: Column) -> Column:
        return F.char_length(text) - F.char_length(F.replace(text, c, F.lit("")))

    common = F.aggregate(F.filter(chars, lambda c: c != ""), F.lit(0), lambda s, c: s + F.least(count(a, c), count(b, c)))
    whole = F.char_length(a) + F.char_length(b)
    return F.when(whole == 0, F.lit(1.0)).otherwise(2.0 * common / whole)


@lru_cache(maxsize=50_000)
def _gram_counts(text: str) -> tuple[dict[str, int], float]:
    counts: Counter[str] = Counter()
    for w in text.lower().split():
        w = f" {w} "
        for n in (2, 3, 4):
            counts.update(w[i : i + n] for i in range(len(w) - n + 1))
    return dict(counts), sqrt(sum(v * v for v in counts.values()))


def cosine(a: str, b: str) -> float:
    (x, nx), (y, ny) = _gram_counts(a), _gram_counts(b)
    if not nx or not ny:
        return 0.0
    if len(y) < len(x):
        x, y = y, x
    return sum(v * y.get(g, 0) for g, v in x.items()) / (nx * ny)


@F.arrow_udf(DoubleType())
def gram_cosine(a: pa.Array, b: pa.Array) -> pa.Array:
    """Cosine of the character n-gram counts of two texts."""
    return pa.array([cosine(x or "", y or "") for x, y in zip(a.to_pylist(), b.to_pylist())], pa.float64())


def _entries(keys: pa.ListArray, weights: pa.ListArray, usable: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The row, key and weight of each entry in a usable row."""
    lengths = keys.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(keys)), lengths)
    kept = usable[rows]
    return rows[kept], keys.flatten().filter(pa.array(kept)), weights.flatten().to_numpy(zero_copy_only=False)[kept]


def dots(keys_a: pa.Array, weights_a: pa.Array, keys_b: pa.Array, weights_b: pa.Array) -> np.ndarray:
    """Dot products of a batch of pairs: entries of both sides meet by row and key in one sorted lookup."""
    usable = np.logical_and.reduce([x.is_valid().to_numpy(zero_copy_only=False) for x in (keys_a, weights_a, keys_b, weights_b)])
    ra, ka, wa = _entries(keys_a, weights_a, usable)
    rb, kb, wb = _entries(keys_b, weights_b, usable)
    if not len(ra) or not len(rb):
        return np.zeros(len(keys_a))
    codes = pa.concat_arrays([ka, kb]).dictionary_encode()
    width = len(codes.dictionary)
    code = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    at_a, at_b = ra * width + code[: len(ra)], rb * width + code[len(ra) :]
    order = np.argsort(at_b, kind="stable")
    at_b, wb = at_b[order], wb[order]
    place = np.minimum(np.searchsorted(at_b, at_a), len(at_b) - 1)
    return np.bincount(ra, np.where(at_b[place] == at_a, wa * wb[place], 0.0), len(keys_a))


@F.arrow_udf(DoubleType())
def sparse_dot(keys_a: pa.Array, weights_a: pa.Array, keys_b: pa.Array, weights_b: pa.Array) -> pa.Array:
    """Dot product of vectors given as parallel arrays of distinct keys and weights; 0 where one is null."""
    return pa.array(dots(keys_a, weights_a, keys_b, weights_b), pa.float64())
