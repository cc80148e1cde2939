"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.langs import long_code
from ..functions.text import is_nonblank, is_nonempty


def nonempty(df: DataFrame, text: str = "text") -> DataFrame:
    return df.where(is_nonempty(text))


def nonblank(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols or ("text",):
        df = df.where(is_nonblank(c))
    return df


def length_between(cols: Sequence[str], min_char: int = 0, max_char: int = 10**9) -> Column:
    """All columns have a length in the inclusive range; null never has."""
    ok = F.lit(True)
    for c in cols:
        ok = ok & F.length(c).between(min_char, max_char)
    return F.coalesce(ok, F.lit(False))


def filter_length(
    df: DataFrame,
    cols: Sequence[str] = ("sentence1", "sentence2"),
    min_char: int = 0,
    max_char: int = 10**9,
) -> DataFrame:
    return df.where(length_between(cols, min_char, max_char))


def allow_pairs(df: DataFrame, langs: Sequence[str], pair: str = "pair") -> DataFrame:
    """Pairs of exactly two codes, both in the list once expanded; no list allows all."""
    if not langs:
        return df
    sides = F.split(F.col(pair), "-")
    both = long_code(F.get(sides, 0)).isin(list(langs)) & long_code(F.get(sides, 1)).isin(list(langs))
    return df.where((F.size(sides) == 2) & both)


def select_langs(df: DataFrame, langs: Sequence[str] | None, col: str = "lang") -> DataFrame:
    """Only the named languages; no names means all."""
    return df.where(F.col(col).isin(list(langs))) if langs else df
