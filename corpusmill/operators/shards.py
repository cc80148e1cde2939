"""Shards with a byte budget, and their manifest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from . import prefix
from .lookup import attach, counted_table

BLOCK_ROWS = 65_536
# Up to so many units a source is walked in one expression.
WALKED_UNITS = 4_096
# Beyond that it is cut into segments of so many shards, if a shard has no more units than this.
SEGMENT = 16
SHARD_UNITS = 1_024
CHUNK_UNITS = 4_096
PLACE = ("_at", "_end", "_u")


def row_bytes(cols: Sequence[str]) -> Column:
    """Bytes of the given string columns."""
    total = F.lit(0).cast("bigint")
    for c in cols:
        total = total + F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0))
    return total


def units(
    df: DataFrame, size: Column, source: str = "source", ord_col: str = "row_id",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Blocks of consecutive rows, the smallest thing that is never split."""
    block = F.expr(f"{ord_col} div {int(block_rows)}")
    return df.groupBy(source, block.alias("unit")).agg(
        F.count("*").alias("n_rows"), F.sum(size).alias("n_bytes")
    )


def pack_units(unit_table: DataFrame, target_bytes: int, source: str = "source") -> DataFrame:
    """Adds `shard` (from 1): a unit that would exceed the target opens the next shard.

    Where a shard ends depends on where it began. So every unit points to the one that opens the
    next shard if it opens one itself, which running sums of bytes tell; these pointers are
    followed from the first unit of a source on: one by one, or, where sources have many units,
    segment by segment, or in jumps of doubling length if shards hold very many units. The tables
    have a few numbers per block of rows and stay in the cluster; the rows stay where they are.
    """
    target = int(target_bytes)
    table = materialize(unit_table)
    size = F.least(F.coalesce("n_bytes", F.lit(0)), F.lit(target + 1))
    sources = table.groupBy(source).agg(F.count("*").alias("n"), F.sum(size).alias("bytes"))
    dense = F.col("n") * (target + 1) / F.greatest("bytes", F.lit(target + 1))
    most, total, density = sources.agg(F.max("n"), F.max("bytes"), F.max(dense)).first()
    if (most or 0) > WALKED_UNITS and density <= SHARD_UNITS:
        return _segmented(table, target, total, source)
    in_order = Window.partitionBy(source).orderBy("unit")
    placed = table.withColumns({"_n": F.row_number().over(in_order), "_end": F.sum("n_bytes").over(in_order)})
    placed = placed.withColumn("_at", F.col("_end") - F.col("n_bytes"))
    ahead = Window.partitionBy(source).orderBy("_at").rangeBetween(0, target)
    # the last unit that begins within the target: it does not fit, unless there are no others
    edge = F.max(F.struct("_n", "_end")).over(ahead)
    fits = edge["_end"] <= F.col("_at") + F.lit(target)
    pointers = placed.withColumn("_next", F.when(~fits, F.greatest(edge["_n"], F.col("_n") + 1)))
    pointers = materialize(pointers)
    openers = _walked(pointers, source) if (most or 0) <= WALKED_UNITS else _jumped(pointers, source)
    numbered = pointers.join(openers.withColumn("_opens", F.lit(1)), [source, "_n"], "left")
    return numbered.withColumn("shard", F.count("_opens").over(in_order)).select(*table.columns, "shard")


def _segmented(table: DataFrame, target: int, total: int, source: str) -> DataFrame:
    """`table` with its `shard`, for sources of any number of units and shards of a bounded number.

    A source is cut into segments of SEGMENT times the target. A chain of openers enters a segment
    within its first `target` bytes, so for each unit there, walking the segment tells where the
    chain's last shard begins and how many it opens. These entries are nodes of a table that is
    smaller by about SEGMENT, with which the same is done until a source's nodes can be walked at
    once. Then each segment is told its entry, from the longest segments down to the units. Where
    the last shard reaches into one more segment, which no chain enters, that one is told its number.
    """
    wall = target + 1  # larger units count as so many bytes: they are shards of their own either way
    size = F.least(F.coalesce("n_bytes", F.lit(0)), F.lit(wall))
    named = table.where(F.col(source).isNotNull()).withColumn("_u", F.coalesce("unit", F.lit(-(1 << 62))))
    in_order = prefix.Order((F.col("_u"),), (F.expr(f"_u div {CHUNK_UNITS}"),))
    placed = prefix.running_sum(named.withColumn("_size", size), [source], in_order, F.col("_size"), "_at")
    level = materialize(placed.select(
        source, "_at", (F.col("_at") + F.col("_size")).alias("_end"), "_u", F.col("_at").alias("_last"),
        F.lit(1).cast("long").alias("_count"), F.struct(*table.columns).alias("_row"),
    ))
    lower, span, levels = 0, SEGMENT * wall, []
    while span < total and level.groupBy(source).count().agg(F.max("count")).first()[0] > WALKED_UNITS:
        levels.append((level, lower, span))
        level = materialize(_entries(level, target, lower, span, source))
        lower, span = span, span * SEGMENT
    entered = _nodes(level, max(span, total + 1), source).select(
        source, "_own", F.struct(F.lit(0).alias("_at"), F.col("_own")[0]["_end"].alias("_end"), F.lit(0).cast("long").alias("_before")).alias("_start")
    )
    ends = _visited(entered, target, lower).select(source, F.col("_chain.last").alias("_last"), F.struct(
        *[F.lit(None).cast("long").alias(c) for c in PLACE], F.col("_chain.n").alias("_before")
    ).alias("_start"))
    while levels:
        reached = _visited(entered, target, lower).select(source, F.explode("_chain.out").alias("_v"))
        level, lower, span = levels.pop()
        starts = reached.select(source, F.expr(f"_v._at div {span}").alias("_segment"), F.col("_v").alias("_start"))
        if not levels:
            starts = starts.unionByName(ends.select(source, F.expr(f"_last div {span} + 1").alias("_segment"), "_start"))
        entered = _nodes(level, span, source).join(starts, [source, "_segment"])
    walked = _visited(entered, target, lower).select(
        source, F.col("_chain.out").alias("_visited"), "_start", F.explode("_own").alias("_unit")
    )
    place = F.struct(*[F.col("_unit")[c] for c in PLACE])
    opened = F.size(F.filter("_visited", lambda v: F.struct(*[v[c] for c in PLACE]) <= place))
    shards = walked.select("_unit._row.*", (F.col("_start._before") + opened).alias("shard"))
    # units without a source are in no shard
    return shards.unionByName(table.where(F.col(source).isNull()).withColumn("shard", F.lit(0).cast("long")))


def _nodes(level: DataFrame, span: int, source: str) -> DataFrame:
    """(source, _segment, _own): the nodes of each segment of `span` bytes, in order."""
    columns = [c for c in level.columns if c != source]
    return level.groupBy(source, F.expr(f"_at div {span}").alias("_segment")).agg(
        F.sort_array(F.collect_list(F.struct(*columns))).alias("_own")
    )


def _follows(node: Column, last: Column, at: Column, target: int, lower: int) -> Column:
    """Whether `node` opens the next shard after one that begins at `last`, in a chain that entered a segment of `lower` bytes at `at`."""
    full = node["_end"] > last + F.lit(target)
    return full & (node["_at"] - node["_at"] % lower > at - at % lower) if lower else full


def _entries(level: DataFrame, target: int, lower: int, span: int, source: str) -> DataFrame:
    """The nodes of the next level: where a chain may enter a segment, and what it does there."""
    own = F.col("_own")

    def enters(i: Column) -> Column:
        here, before = F.get(own, i), F.get(own, i - 1)
        same = (here["_at"] == before["_at"]) & (here["_end"] == before["_end"])
        return (here["_at"] - F.col("_segment") * span <= target) & ~F.coalesce(same, F.lit(False))

    spots = F.filter(F.sequence(F.lit(0), F.size(own) - 1), enters)
    entry = _nodes(level, span, source).withColumn("_i", F.explode(spots)).withColumn("_entry", F.get(own, F.col("_i")))
    start = F.struct(*[F.col(f"_entry.{c}").alias(c) for c in ("_last", "_at", "_count")])
    rest = F.slice(own, F.col("_i") + 2, F.size(own))
    walk = F.aggregate(rest, start, lambda done, u: F.when(
        _follows(u, done["_last"], done["_at"], target, lower),
        F.struct(u["_last"].alias("_last"), u["_at"].alias("_at"), (done["_count"] + u["_count"]).alias("_count")),
    ).otherwise(done))
    return entry.withColumn("_walk", walk).select(
        source, "_entry._at", "_entry._end", F.lit(0).cast("long").alias("_u"), "_walk._last", "_walk._count",
    )


def _visited(entered: DataFrame, target: int, lower: int) -> DataFrame:
    """`entered` with `_chain`: `out`, the nodes on the chain from `_start` on and how many shards were opened before
    each; `last`, where the last of these shards begins; `n`, how many were opened in all. A null place is no start."""
    start = F.col("_start")
    kind = "array<struct<_at: bigint, _end: bigint, _u: bigint, _before: bigint>>"
    zero = F.struct(
        F.lit(False).alias("on"), F.lit(0).cast("long").alias("last"), F.lit(0).cast("long").alias("at"),
        start["_before"].alias("n"), F.array().cast(kind).alias("out"),
    )

    def step(done: Column, u: Column) -> Column:
        begins = ~done["on"] & (u["_at"] == start["_at"]) & (u["_end"] == start["_end"])
        here = F.struct(*[u[c].alias(c) for c in PLACE], done["n"].alias("_before"))
        return F.when(
            begins | (done["on"] & _follows(u, done["last"], done["at"], target, lower)),
            F.struct(
                F.lit(True).alias("on"), u["_last"].alias("last"), u["_at"].alias("at"),
                (done["n"] + u["_count"]).alias("n"), F.array_append(done["out"], here).alias("out"),
            ),
        ).otherwise(done)

    return entered.withColumn("_chain", F.aggregate("_own", zero, step))


def _walked(pointers: DataFrame, source: str) -> DataFrame:
    """(source, _n) of the units that open shards, by following the pointers of a source one by one."""
    units = F.sort_array(F.collect_list(F.struct("_n", "_next")))
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<int>").alias("opened"))
    step = F.aggregate(units, start, lambda done, u: F.when(
        u["_n"] == done["at"], F.struct(u["_next"].alias("at"), F.array_append(done["opened"], u["_n"]).alias("opened"))
    ).otherwise(done))
    return pointers.groupBy(source).agg(step.alias("_w")).select(source, F.explode("_w.opened").alias("_n"))


def _jumped(pointers: DataFrame, source: str) -> DataFrame:
    """As `_walked`, for any number of units: jumps that double in length until no further unit is reached."""
    nodes = pointers.select(source, "_n", "_next", (F.col("_n") == 1).alias("_opens"))
    opened, before = 0, -1
    while opened != before:
        jump = nodes.select(source, F.col("_n").alias("_next"), F.col("_next").alias("_then"))
        reached = nodes.where("_opens and _next is not null").select(source, F.col("_next").alias("_n"), F.lit(True).alias("_reached"))
        nodes = materialize(
            nodes.join(jump, [source, "_next"], "left").join(reached, [source, "_n"], "left")
            .select(source, "_n", F.col("_then").alias("_next"), (F.col("_opens") | F.col("_reached").isNotNull()).alias("_opens"))
        )
        opened, before = nodes.where("_opens").count(), opened
    return nodes.where("_opens").select(source, "_n")


def assign_shards(
    df: DataFrame, target_bytes: int, size: Column, source: str = "source",
    ord_col: str = "row_id", block_rows: int = BLOCK_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """The rows with their `shard`, and the manifest of the shards."""
    packed, fits = counted_table(pack_units(units(df, size, source, ord_col, block_rows), target_bytes, source))
    unit = F.expr(f"{ord_col} div {int(block_rows)}")
    rows = attach(
        df.withColumn("unit", unit), packed.select(source, "unit", "shard"),
        [source, "unit"], fits,
    ).drop("unit")
    return rows, manifest(packed, source)


def manifest(packed: DataFrame, source: str = "source") -> DataFrame:
    """One row per shard: its number, file name, rows, units and bytes."""
    return (
        packed.groupBy(source, F.col("shard").alias("index"))
        .agg(
            F.sum("n_rows").alias("num_rows"),
            F.count("*").alias("row_groups"),
            F.sum("n_bytes").alias("estimated_bytes"),
        )
        .withColumn("path", F.concat(F.col(source), F.col("index").cast("string"), F.lit(".parquet")))
    )
