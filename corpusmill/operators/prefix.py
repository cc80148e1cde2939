"""Running sums over huge groups, without sorting a group in one task.

A group is cut into buckets which follow its order: leading digits of a hash key for a
random order, blocks of consecutive positions for the source order. The sums of the buckets
are a tiny table that can be accumulated; only rows of one bucket are ever sorted together.

Most operators need no running sum per row but only the row at which a limit is met
(`prefix_cut`): everything before it is in, everything after it is out. Then the corpus
itself is never shuffled or sorted: one scan makes bucket sums, one scan looks at the one
bucket per group in which the limit falls, and the last scan compares keys with the cut.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import rand
from .lookup import attach, small_table

HASH_DIGITS = 3  # 4096 buckets per group
BUCKET_ROWS = 16_384
BLOCK_BITS = 16  # 65 536 positions per block
MAX_RANGES = 500
GROUP = "_all"


@dataclass(frozen=True)
class Order:
    """`keys` order the rows of a group totally; `buckets` order them in the same way, coarsely.

    `position` names the stored column whose blocks the last bucket counts, if there is one.
    """

    keys: tuple[Column, ...]
    buckets: tuple[Column, ...]
    position: str | None = None

    @property
    def key(self) -> Column:
        return F.struct(*[k.alias(f"k{i}") for i, k in enumerate(self.keys)])


def hash_order(seed: int, *ids: str, digits: int = HASH_DIGITS) -> Order:
    """A seeded random order; `ids` identify a row within its group."""
    key = rand.order_key(seed, *ids)
    return Order((key, *map(F.col, ids)), (rand.leading_digits(key, digits),))


def digits_for(n_rows: int) -> int:
    """Leading digits that cut so many rows into buckets of about BUCKET_ROWS at most."""
    digits = HASH_DIGITS
    while 16**digits * BUCKET_ROWS < n_rows and digits < 8:
        digits += 1
    return digits


def source_order(ord_col: str, *leading: str) -> Order:
    """The order of the files: `leading` columns first, then a bigint position."""
    pos = F.col(ord_col)
    return Order(
        (*map(F.col, leading), pos),
        (*map(F.col, leading), F.shiftright(pos, BLOCK_BITS)),
        ord_col,
    )


@dataclass(frozen=True)
class Cut:
    """One row per group: its columns, `_total`, `_limit`, `_cut0`.. and `_cut_before`.

    The cut is the key of the last row whose sum of earlier rows, `_cut_before`, is below
    the limit. Both are null where the whole group is.
    """

    table: DataFrame
    by: list[str]
    order: Order
    fits: bool

    def attach(self, df: DataFrame, how: str = "inner") -> DataFrame:
        return attach(_grouped(df, self.by), self.table, self.by, self.fits, how, self.order.keys)

    def keep(self, df: DataFrame) -> DataFrame:
        """The rows of `df` up to the cut of their group; groups without a row here are dropped."""
        if self.by == [GROUP]:
            only = self.table.first()
            if only is not None and only["_limit"] is not None and only["_limit"] <= 0:
                return df.where(F.lit(False))
            if only is None or only["_cut_before"] is None:
                return df
            at = F.struct(*[F.lit(only[f"_cut{i}"]).alias(f"k{i}") for i in range(len(self.order.keys))])
            return self.near(df).where(self.order.key <= at)
        return self.drop(self.attach(self.near(df)).where(self.within))

    def near(self, df: DataFrame) -> DataFrame:
        """Leaves out rows after the last cut of all, with a constant that a scan can use."""
        if self.order.position is None:
            return df
        rows = self.table.select("_cut0", "_cut_before").limit(MAX_RANGES + 1).collect()
        if not rows or len(rows) > MAX_RANGES or any(r["_cut_before"] is None for r in rows):
            return df
        return df.where(self.order.keys[0] <= F.lit(max(r["_cut0"] for r in rows)))

    @property
    def last(self) -> Column:
        """True for the row at the cut."""
        return F.col("_cut_before").isNotNull() & (self.order.key == self._key)

    @property
    def within(self) -> Column:
        """True for rows up to the cut."""
        some = F.coalesce(F.col("_limit") > 0, F.lit(True))
        return some & (F.col("_cut_before").isNull() | (self.order.key <= self._key))

    @property
    def _key(self) -> Column:
        return F.struct(*[F.col(f"_cut{i}").alias(f"k{i}") for i in range(len(self.order.keys))])

    def drop(self, df: DataFrame) -> DataFrame:
        extra = [c for c in self.table.columns if c not in self.by]
        return df.drop(*extra, GROUP)


def _grouped(df: DataFrame, by: list[str]) -> DataFrame:
    return df.withColumn(GROUP, F.lit(0)) if by == [GROUP] else df


def _bucket_names(order: Order) -> list[str]:
    return [f"_b{i}" for i in range(len(order.buckets))]


def _bucket_sums(df: DataFrame, by: list[str], order: Order, weight: Column) -> DataFrame:
    """The sum of each bucket and of all earlier buckets of its group.

    A group has 4096 buckets in a random order and one per 65 536 rows in source order.
    """
    names = _bucket_names(order)
    buckets = [b.alias(n) for n, b in zip(names, order.buckets)]
    sums = (
        _grouped(df, by).select(*by, *buckets, weight.cast("bigint").alias("_w"))
        .groupBy(*by, *names).agg(F.sum("_w").alias("_w"))
    )
    return sums.withColumn("_lo", _before(by, *names))


def _before(by: Sequence[str], *order: str) -> Column:
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_w").over(w), F.lit(0))


def _only_blocks(df: DataFrame, edges: DataFrame, order: Order) -> DataFrame:
    """Leaves out what surely lies in no block of `edges`, with constants a scan can use.

    A few blocks only: they become ranges of the stored position, so files and row groups
    outside are skipped. With more blocks, or a random order, nothing is left out.
    """
    if order.position is None:
        return df
    rows = edges.select(_bucket_names(order)[-1]).limit(MAX_RANGES + 1).collect()
    if len(rows) > MAX_RANGES:
        return df
    size = 1 << BLOCK_BITS
    keep = F.lit(False)
    for block in sorted({r[0] for r in rows}):
        keep = keep | F.col(order.position).between(block * size, (block + 1) * size - 1)
    return df.where(keep)


def prefix_cut(
    df: DataFrame,
    by: Sequence[str],
    order: Order,
    weight: Column,
    limit: Column,
    per_group: DataFrame | None = None,
) -> Cut:
    """Where the running sum of `weight` meets `limit` in each group. Runs two jobs.

    `limit` may use `_total` (the sum of the group), the group columns and the columns of
    `per_group`, a small table with one row per group; groups without such a row are left
    out. A null limit is no limit; with one of 0 or less nothing is within the cut.
    """
    by = list(by) or [GROUP]
    names = _bucket_names(order)
    sums = _bucket_sums(df, by, order, weight).withColumn(
        "_total", F.sum("_w").over(Window.partitionBy(*by))
    )
    carried = ["_total"]
    if per_group is not None:
        sums = sums.join(per_group, by)
        carried += [c for c in per_group.columns if c not in by]
    sums = sums.withColumn("_limit", limit.cast("bigint"))
    # At most one bucket per group: it takes the sum from below the limit to the limit.
    crossing = (F.col("_lo") < F.col("_limit")) & (F.col("_limit") <= F.col("_lo") + F.col("_w"))
    groups, fits = small_table(
        sums.groupBy(*by).agg(
            *[F.first(c).alias(c) for c in (*carried, "_limit")],
            *[F.max(F.when(crossing, F.col(c))).alias(c) for c in (*names, "_lo")],
        )
    )

    edges = groups.where("_lo is not null").select(*by, *names, "_limit", "_lo")
    # Keys and weights are made after this join, so only for the rows of those buckets.
    near = _grouped(_only_blocks(df, edges, order), by)
    near = near.withColumns(dict(zip(names, order.buckets)))
    rows = attach(near, edges, [*by, *names], fits).select(
        *by, *names, "_limit", "_lo", order.key.alias("_k"), weight.cast("bigint").alias("_w")
    )
    cut = (
        rows.withColumn("_lo", F.col("_lo") + _before([*by, *names], "_k"))
        .where(F.col("_lo") < F.col("_limit"))
        .groupBy(*by)
        .agg(F.max("_k").alias("_k"), F.max("_lo").alias("_cut_before"))
        .select(*by, "_cut_before", *[F.col(f"_k.k{i}").alias(f"_cut{i}") for i in range(len(order.keys))])
    )
    table, fits = small_table(groups.drop(*names, "_lo").join(cut, by, "left"))
    return Cut(table, by, order, fits)


def running_sum(
    df: DataFrame, by: Sequence[str], order: Order, weight: Column, name: str
) -> DataFrame:
    """Adds the sum of `weight` over the earlier rows of the group.

    For operators which need the number of every row. Rows are shuffled once, by bucket,
    for the join with the sums of earlier buckets and the window alike.
    """
    by = list(by) or [GROUP]
    names = _bucket_names(order)
    offsets = _bucket_sums(df, by, order, weight).drop("_w")
    keyed = _grouped(df, by).withColumns({
        **dict(zip(names, order.buckets)), "_k": order.key, "_w": weight.cast("bigint"),
    })
    out = keyed.join(offsets, [*by, *names]).withColumn(
        name, F.col("_lo") + _before([*by, *names], "_k")
    )
    return out.drop(*names, "_k", "_w", "_lo", GROUP)


def part_numbers(
    df: DataFrame, by: Sequence[str], order: Order, part_size: int, name: str = "part_id"
) -> DataFrame:
    """Adds the number, from 1, of the part of `part_size` rows that a row belongs to in its group.

    One scan counts the rows of each bucket. Most buckets lie within one part. Only of those
    that do not, the keys (no other columns) are sorted, to find the first key of each part.
    Every row then compares its key with the few that begin a part in its bucket; rows
    themselves are neither shuffled nor sorted.
    """
    by = list(by) or [GROUP]
    names = _bucket_names(order)
    size = int(part_size)
    sums, fits = small_table(_bucket_sums(df, by, order, F.lit(1)))
    first, last = F.expr(f"_lo div {size} + 1"), F.expr(f"(_lo + _w - 1) div {size} + 1")
    crossed = sums.where(first != last).select(*by, *names, "_lo")
    keyed = _grouped(df, by).withColumns(dict(zip(names, order.buckets)))
    own = attach(keyed, crossed, [*by, *names], fits, spread=order.keys).select(*by, *names, "_lo", order.key.alias("_k"))
    rank = F.row_number().over(Window.partitionBy(*by, *names).orderBy("_k")) - 1 + F.col("_lo")
    starts = own.withColumn("_rank", rank).where(f"_rank % {size} = 0 AND _rank > _lo")
    starts = starts.groupBy(*by, *names).agg(F.sort_array(F.collect_list("_k")).alias("_starts"))
    parts, fits = small_table(sums.join(starts, [*by, *names], "left").select(*by, *names, first.alias("_first"), "_starts"))
    placed = attach(keyed, parts, [*by, *names], fits, spread=order.keys)
    passed = F.coalesce(F.size(F.filter("_starts", lambda k: k <= order.key)), F.lit(0))
    passed = F.when(F.col("_starts").isNull(), F.lit(0)).otherwise(passed)
    return placed.withColumn(name, F.col("_first") + passed).drop(*names, "_first", "_starts", GROUP)
