"""Sampling, shuffling and repeating with fixed seeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import rand
from ..functions.text import is_nonempty, math_record
from .prefix import digits_for, hash_order, Order, part_numbers, prefix_cut, running_sum, source_order


def take(df: DataFrame, n: int, by: Sequence[str] = (), order: Order | None = None) -> DataFrame:
    """The first n rows of each group (all of a smaller one)."""
    cut = prefix_cut(df, by, order or source_order("ord"), F.lit(1), F.lit(n))
    return cut.keep(df)


def bounded_sample(
    df: DataFrame,
    by: str = "pair",
    max_n: int = 100_000,
    min_n: int = 0,
    seed: int = 42,
    key: Sequence[str] = ("row_id",),
    strategy: str = "uniform",
) -> DataFrame:
    """Brings groups towards a size between two bounds; adds `copy`, 0 for the first.

    More than `max_n` rows: a uniform sample of exactly `max_n`. Fewer than half of
    `min_n`: every row `min_n div n` times. Any other group stays as it is.
    """
    if strategy != "uniform":
        raise ValueError(f"unknown sampling strategy: {strategy}")
    limit = F.when(F.col("_total") > max_n, F.lit(max_n))
    cut = prefix_cut(df, [by], hash_order(seed, by, *key), F.lit(1), limit)
    few = (F.col("_total") <= max_n) & (F.col("_total") < min_n // 2)
    copies = F.when(few, F.expr(f"{int(min_n)} div _total")).otherwise(F.lit(1).cast("bigint"))
    kept = cut.attach(df).where(cut.within).withColumn("_copies", copies)
    return cut.drop(
        kept.withColumn(
            "copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1))
        ).drop("_copies")
    )


def swap_bitext(
    df: DataFrame,
    src: str = "sentence1",
    tgt: str = "sentence2",
    prob: float = 1.0,
    seed: int = 42,
    key: Sequence[str] = ("pair", "row_id"),
) -> DataFrame:
    """Exchanges both sides of a row with probability `prob`; `swapped` tells which."""
    df = df.withColumn("swapped", rand.uniform(seed, F.lit("swap"), *key) < F.lit(prob))
    return df.withColumns({
        src: F.when(F.col("swapped"), F.col(tgt)).otherwise(F.col(src)),
        tgt: F.when(F.col("swapped"), F.col(src)).otherwise(F.col(tgt)),
    })


def shuffle_order(df: DataFrame, seed: int = 42, key: Sequence[str] = ("ord",)) -> DataFrame:
    """All rows in a seeded random order."""
    return df.orderBy(rand.order_key(seed, *key), *key)


def shuffle_position(
    df: DataFrame, seed: int = 42, key: Sequence[str] = ("ord",), name: str = "position"
) -> DataFrame:
    """The place of each row in the order of `shuffle_order`, from 0.

    Buckets are as small for many rows as for few.
    """
    return running_sum(df, [], hash_order(seed, *key, digits=digits_for(df.count())), F.lit(1), name)


def repeat_epochs(
    df: DataFrame,
    times: int = 5,
    seed: int | None = 2025,
    key: Sequence[str] = ("lang", "split", "ord"),
    text: str = "text",
) -> DataFrame:
    """Non-empty rows once per epoch, with the key of each epoch's own shuffle.

    `order_key` orders the rows within (epoch, split). Without a seed it is null, which
    stands for the order of the source.
    """
    out = df.where(is_nonempty(text)).withColumn(
        "epoch", F.explode(F.sequence(F.lit(0), F.lit(times - 1)))
    )
    own = F.lit(None).cast("string") if seed is None else rand.order_key(F.lit(seed) + F.col("epoch"), *key)
    return out.withColumn("order_key", own)


def sample_topics(
    df: DataFrame,
    topics: dict[int, str],
    n: int = 2000,
    min_prob: float = 0.3,
    min_chars: int = 200,
    max_chars: int = 20_000,
    seed: int = 2026,
    key: Sequence[str] = ("ord",),
    text: str = "text",
) -> DataFrame:
    """Up to n random rows of each wanted topic, all topics in one pass; adds `domain`."""
    name = F.create_map(*[F.lit(x) for item in topics.items() for x in item])
    wanted = (
        df.where(F.col("top_choice_prob") >= min_prob)
        .where(F.col("top_choice_index").isin(list(topics)))
        .where(F.length(text).between(min_chars, max_chars))
        .withColumn("domain", name[F.col("top_choice_index").cast("int")])
    )
    return take(wanted, n, ["domain"], hash_order(seed, *key))


def sample_math(
    df: DataFrame, n: int = 2000, seed: int = 2026, key: Sequence[str] = ("ord",)
) -> DataFrame:
    """n random rows as math records; blank ones are dropped after sampling."""
    drawn = take(df, n, order=hash_order(seed, *key))
    text = math_record("problem", "generated_solution")
    return drawn.withColumn("text", text).where(F.col("text").isNotNull())


def assign_parts(
    df: DataFrame, part_size: int, order: Order | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Numbers output parts of `part_size` rows from 1, in order; adds `part_id`. Rows stay where they are."""
    return part_numbers(df, by, order or source_order("ord"), part_size)
