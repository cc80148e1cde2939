"""Seeded randomness as plain column expressions.

Every random choice is a function of (seed, row id), so it does not depend on the
partitioning, on retries, or on how often a plan is evaluated. Choices of different kinds
put the name of the kind before the row id, so that equal seeds do not tie them together.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def order_key(seed: int | Column, *ids: str | Column) -> Column:
    """Hex string whose order is a random permutation of the rows."""
    head = seed if isinstance(seed, Column) else F.lit(seed)
    parts = [head.cast("string")]
    parts += [(F.col(c) if isinstance(c, str) else c).cast("string") for c in ids]
    return F.md5(F.concat_ws(":", *parts))


def leading_digits(key: Column, digits: int) -> Column:
    """The first hex digits of an order key as a number; keeps the order of the keys."""
    return F.conv(F.substring(key, 1, digits), 16, 10).cast("bigint")


def uniform(seed: int | Column, *ids: str | Column) -> Column:
    """A number in [0, 1)."""
    return leading_digits(order_key(seed, *ids), 8) / F.lit(4294967296.0)


def choice(seed: int | Column, n: int, *ids: str | Column) -> Column:
    """An index in 0 .. n-1."""
    return F.floor(uniform(seed, *ids) * F.lit(float(n))).cast("int")
