"""Small tables of one row per group, and joining a corpus with them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize

# A group table has a key and a few numbers per row, so this many rows stay far below
# what an executor can hold. Tables with more rows are joined by a shuffle.
MAX_SMALL_ROWS = 100_000
SPREAD = 64


def small_table(df: DataFrame) -> tuple[DataFrame, bool]:
    """Runs `df` once and keeps its result for later plans; tells whether it is small.

    At most MAX_SMALL_ROWS rows are fetched and become a constant of the plans that use
    them: no later job repeats the scan behind them, and Spark knows their exact size. A
    result with more rows is written to the checkpoint folder instead.
    """
    rows = df.limit(MAX_SMALL_ROWS + 1).toArrow()
    if rows.num_rows <= MAX_SMALL_ROWS:
        return df.sparkSession.createDataFrame(rows, df.schema), True
    return materialize(df), False


def counted_table(df: DataFrame) -> tuple[DataFrame, bool]:
    """As `small_table`, for tables that often are large: written once, and never fetched."""
    stored = materialize(df)
    return stored, stored.count() <= MAX_SMALL_ROWS


def attach(
    df: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    fits: bool,
    how: str = "inner",
    spread: Sequence[str | Column] = (),
) -> DataFrame:
    """`df` joined with its row of `small`, a result of `small_table`.

    Within the bound the group table is broadcast and the corpus is not shuffled. Beyond
    it both sides are shuffled; `spread` (columns that differ from row to row) cuts every
    group into SPREAD pieces, so that a hot group does not end up in one task.
    """
    on = list(on)
    if fits:
        return df.join(F.broadcast(small), on, how)
    if not spread:
        return df.join(small, on, how)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(SPREAD)).cast("int"))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")
