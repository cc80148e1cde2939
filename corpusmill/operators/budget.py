"""Token budgets: prefixes of a corpus, and cyclic mixtures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import count_tokens, is_nonempty
from .lookup import attach, small_table
from .prefix import BLOCK_BITS, GROUP, Order, hash_order, prefix_cut, source_order

RATIO_CHARS = 1_000_000
HEAD_MARGIN = 1.5


def take_token_budget(
    df: DataFrame,
    tokens: Column,
    max_tokens: int | None = None,
    max_samples: int | None = None,
    order: Order | None = None,
    text: str = "text",
    by: Sequence[str] = (),
    key: Sequence[str] = ("ord",),
    seed: int = 42,
) -> DataFrame:
    """The non-empty rows up to a budget, in shuffled (default) or in the given order.

    The row which reaches `max_tokens` is kept. `max_samples` counts all scanned rows,
    empty ones too, and is looked at after each non-empty row only. Null or 0 means no
    limit. With both limits the one met first decides.
    """
    order = order or hash_order(seed, *key)
    nonempty = is_nonempty(text)
    out = df.where(nonempty)
    if max_tokens:
        head = None if by else _expected_head(out, order, tokens, max_tokens)
        out = _up_to(out, by, order, tokens, max_tokens, head)
    if max_samples:
        out = _stop_after_samples(df, out, nonempty, by, order, max_samples)
    return out


def _up_to(
    df: DataFrame, by: Sequence[str], order: Order, tokens: Column, max_tokens: int, head: Column | None
) -> DataFrame:
    """Rows until the budget is met; `head`, a prefix without groups, is tried first."""
    limit = F.lit(max_tokens)
    if head is not None:
        cut = prefix_cut(df.where(head), by, order, tokens, limit)
        met = cut.table.first()
        if met is not None and met["_cut_before"] is not None:
            return cut.keep(df.where(head))
    return prefix_cut(df, by, order, tokens, limit).keep(df)


def _expected_head(df: DataFrame, order: Order, tokens: Column, max_tokens: int) -> Column | None:
    """A prefix that should hold the budget, going by the tokens of the first block.

    Only for a plain source order: then it is a range of the stored position, and the scan
    can skip what lies behind it.
    """
    if order.position is None or len(order.keys) > 1:
        return None
    position = F.col(order.position)
    start = df.agg(F.min(position)).first()[0]
    if start is None:
        return None
    block = 1 << BLOCK_BITS
    first = df.where(position < start + block).agg(F.count("*").alias("n"), F.sum(tokens).alias("t")).first()
    if not first["t"]:
        return None
    rows = int(max_tokens * HEAD_MARGIN * first["n"] / first["t"]) + block
    return position < start + rows


def _stop_after_samples(
    df: DataFrame, out: DataFrame, nonempty: Column, by: Sequence[str], order: Order, n: int
) -> DataFrame:
    """Keeps `out` up to the first non-empty row whose scan number is n or more."""
    by = list(by) or [GROUP]
    if by == [GROUP]:
        df, out = df.withColumn(GROUP, F.lit(0)), out.withColumn(GROUP, F.lit(0))
    passed = df
    if n > 1:
        cut = prefix_cut(df, by, order, F.lit(1), F.lit(n - 1))
        passed = cut.drop(cut.attach(df).where(~cut.within))
        if by == [GROUP]:
            passed = passed.withColumn(GROUP, F.lit(0))
    last, fits = small_table(passed.where(nonempty).groupBy(*by).agg(F.min(order.key).alias("_last")))
    joined = attach(out, last, by, fits, "left", order.keys)
    return joined.where(F.col("_last").isNull() | (order.key <= F.col("_last"))).drop("_last", GROUP)


def token_char_ratio(
    df: DataFrame,
    by: str = "lang",
    order: Order | None = None,
    sample_chars: int = RATIO_CHARS,
    tokens=count_tokens,
    text: str = "text",
) -> DataFrame:
    """Tokens per character over the first `sample_chars` characters of each group.

    The row at the border is cut to the characters that are left. Tokens are counted row
    by row, so none can span two rows. Groups without text get the ratio 0.
    """
    order = order or source_order("ord")
    chars = F.coalesce(F.length(text), F.lit(0))
    cut = prefix_cut(df, [by], order, chars, F.lit(sample_chars))
    room = (F.lit(sample_chars) - F.col("_cut_before")).cast("int")
    head = F.when(cut.last, F.col(text).substr(F.lit(1), room)).otherwise(F.col(text))
    sample = cut.attach(cut.near(df)).where(cut.within).select(by, head.alias("_head"))
    return (
        sample.groupBy(by)
        .agg(
            F.count("*").alias("n_rows"),
            F.sum(F.coalesce(F.length("_head"), F.lit(0))).alias("chars"),
            F.sum(tokens("_head")).alias("tokens"),
        )
        .withColumn(
            "ratio",
            F.when(F.col("chars") > 0, F.col("tokens") / F.col("chars")).otherwise(F.lit(0.0)),
        )
    )


def token_estimate(
    text: str, ratio: Column, precomputed: Column | None = None, tokens=count_tokens
) -> Column:
    """A stored count if there is one, else length x ratio, else (0) the real count."""
    known = F.nullif(precomputed, F.lit(0)) if precomputed is not None else F.lit(None)
    guess = F.nullif(F.floor(F.length(text) * ratio), F.lit(0))
    return F.coalesce(known, guess, tokens(text)).cast("bigint")


def mix_to_budget(
    df: DataFrame,
    targets: DataFrame,
    tokens: Column,
    by: str = "lang",
    order: Order | None = None,
    target: str = "target",
    head: Column | None = None,
    headed: Sequence[str] = (),
) -> DataFrame:
    """Walks each group in order, again and again, until its target is met.

    Gives every row once per visit, with its 0-based `epoch` and its `n_tokens`. `targets`
    has one row per group; groups without one, or with a target of 0, give no rows. The row
    that meets the target is kept, so a group overshoots by less than one row.

    After `full = (target - 1) div total` whole rounds, `(target - 1) mod total + 1` tokens
    are left to fill, between 1 and total: rows up to that cut are visited full + 1 times,
    the others full times.

    For the groups `headed`, `head` selects a prefix. Those that meet their target in it are
    finished from it alone; the rest of them is not read.
    """
    order = order or source_order("ord")
    wanted = targets.where(F.col(target) > 0).select(by, F.col(target).cast("bigint").alias(target))
    if head is None or not headed:
        return _mix_whole(df, wanted, tokens, by, order, target)

    start = df.where(F.col(by).isin(list(headed)) & head)
    met = F.col(target) <= F.col("_total")
    cut = prefix_cut(start, [by], order, tokens, F.when(met, F.col(target)), wanted)
    done = [r[0] for r in cut.table.where(met).select(by).collect()]  # no more than `headed`
    early = cut.drop(
        cut.attach(start).where(met & cut.within)
        .withColumn("n_tokens", tokens).withColumn("epoch", F.lit(0).cast("bigint"))
    )
    left = wanted.where(~F.col(by).isin(done))
    if left.isEmpty():
        return early
    later = df.where(~F.col(by).isin(done))
    return early.unionByName(_mix_whole(later, left, tokens, by, order, target))


def _mix_whole(
    df: DataFrame, wanted: DataFrame, tokens: Column, by: str, order: Order, target: str
) -> DataFrame:
    limit = F.when(F.col("_total") > 0, (F.col(target) - 1) % F.col("_total") + 1)
    cut = prefix_cut(df, [by], order, tokens, limit, wanted)
    visits = F.expr(f"({target} - 1) div _total") + F.when(cut.within, 1).otherwise(0)
    return cut.drop(
        cut.attach(df)
        .where(F.col("_total") > 0)
        .withColumn("_visits", visits)
        .where(F.col("_visits") > 0)
        .withColumn("n_tokens", tokens)
        .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_visits") - 1)))
        .drop("_visits")
    )
