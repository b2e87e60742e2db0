"""Tokens and character n-grams as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokens(c: Column) -> Column:
    """Words in order, repeats kept."""
    return F.filter(F.split(c, r"\s+"), lambda t: t != "")


def blocking_tokens(c: Column, min_len: int = 2) -> Column:
    return F.array_distinct(F.filter(tokens(c), lambda t: F.char_length(t) >= min_len))


def first_token(words: Column) -> Column:
    return F.coalesce(F.get(words, F.lit(0)), F.lit(""))


def char_wb(c: Column, lo: int = 2, hi: int = 4) -> Column:
    """Character n-grams inside words padded by a space, as a multiset."""

    def of_word(w: Column) -> Column:
        padded = F.concat(F.lit(" "), w, F.lit(" "))
        size = F.char_length(padded)

        def of_length(n: int) -> Column:
            starts = F.sequence(F.lit(1), F.greatest(size - (n - 1), F.lit(1)))
            return F.when(size >= n, F.transform(starts, lambda i: F.substring(padded, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))

        return F.concat(*[of_length(n) for n in range(lo, hi + 1)])

    return F.flatten(F.transform(tokens(F.lower(c)), of_word))
