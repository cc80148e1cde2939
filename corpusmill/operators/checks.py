"""Step counts of a pipeline, and whether outputs agree with them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def count_steps(
    df: DataFrame, steps: Sequence[tuple[int, str, Column]], by: str = "pair"
) -> DataFrame:
    """(`by`, step_no, step, n_rows): rows for which each step's column is true, in one pass."""
    sums = [F.count_if(kept).alias(f"n{no}") for no, _, kept in steps]
    entries = F.array(*[
        F.struct(F.lit(no).alias("step_no"), F.lit(name).alias("step"), F.col(f"n{no}").alias("n_rows"))
        for no, name, _ in steps
    ])
    return df.groupBy(by).agg(*sums).select(by, F.inline(entries))


def wide_stats(stats: DataFrame, names: Sequence[str], by: str = "pair") -> DataFrame:
    """One row per pair, one column per step name."""
    return stats.groupBy(by).pivot("step", list(names)).agg(F.first("n_rows"))


def validate_outputs(outputs: DataFrame, stats: DataFrame, by: str = "pair") -> DataFrame:
    """Per pair: rows written, rows expected by its latest run, and whether both agree.

    `stats` has `final_samples` and a `run` that grows; nothing expected is never valid.
    """
    written = outputs.groupBy(by).agg(F.count("*").alias("actual"))
    expected = stats.groupBy(by).agg(F.max_by("final_samples", "run").alias("expected"))
    both = written.join(expected, by, "full")
    return both.select(
        by,
        F.coalesce("actual", F.lit(0)).alias("actual"),
        F.coalesce("expected", F.lit(0)).alias("expected"),
        F.coalesce((F.col("actual") == F.col("expected")) & (F.col("expected") > 0), F.lit(False)).alias("valid"),
    )
