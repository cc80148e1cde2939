"""Reading the tables, and what several operators do with DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..session import materialize


BATCH_ROWS = 2_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str, modulus: int, remainder: int) -> Column:
    """Whether the crc32 of the id as text leaves the remainder; a null id counts as ''."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(modulus)) == remainder


def bounded_batches(spark: SparkSession) -> None:
    """Python workers get few rows at a time, as texts may be long; smaller settings are left."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def per_batch(
    df: DataFrame, make: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table], schema: str | StructType,
) -> DataFrame:
    """`make` over every Arrow batch of `df`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = make(batch)
            yield from out.to_batches() if isinstance(out, pa.Table) else [out]

    bounded_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of `edges` (a, b) is connected to.

    Alternates large and small stars (every node hands its neighbours its smallest
    neighbour), which takes about log n rounds; nodes and links stay in the cluster. The
    rounds are written to the checkpoint folder.
    """

    def star(links: DataFrame, large: bool) -> DataFrame:
        if large:
            near = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            near = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        joined = near.join(least, "a")
        if large:
            moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
                least.select("a", F.col("m").alias("b"))
            )
        return moved.where("a != b").distinct()

    def mark(links: DataFrame) -> tuple:
        return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    links = materialize(edges.select("a", "b").where("a != b").distinct())
    before = mark(links)
    while before[0]:
        links = materialize(star(star(links, True), False))
        after = mark(links)
        if after == before:
            break
        before = after
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(links.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
