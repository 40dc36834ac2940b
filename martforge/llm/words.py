"""Column expressions over the words of a text (no user functions).

``let`` binds an expression to a lambda variable, so an array that is indexed
many times is computed once per row whatever the optimizer inlines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from martforge.llm.common import PUNCT, SPACE

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def plain_words(text: Column) -> Column:
    """Words of the white-space rule, as they stand."""
    return F.array_remove(F.split(text, f"[{SPACE}]+"), "")


def alnum_words(text: Column) -> Column:
    """Lower-cased words of the letters-and-digits rule."""
    return F.array_remove(F.split(ascii_lower(text), f"[{PUNCT}]+"), "")


def upto(n: Column) -> Column:
    """0 .. n - 1 (empty for n <= 0)."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def gram_hashes(words: Column, k: int) -> Column:
    """Hash of every run of k consecutive words, by position."""
    def grams(h: Column) -> Column:
        return F.transform(upto(F.size(h) - F.lit(k - 1)), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)]))
    return let(F.transform(words, lambda w: F.xxhash64(w)), grams)
