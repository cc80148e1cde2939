"""Outputs. These functions run jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from ..operators.joins import pending_work
from ..operators.prefix import Order, source_order
from ..operators.sampling import assign_parts
from ..session import materialize

GIB = 1024**3
LOG = "_commits"  # hidden from readers of the folder
UNIT_ROWS = 1_000_000
JOB_ROWS = 64_000_000
MAX_SPANS = 200


@contextmanager
def _conf(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _rebalanced(df: DataFrame, *by: str) -> DataFrame:
    """Rows of a key together, small keys merged, hot keys split over many tasks (by AQE)."""
    return df.hint("rebalance", *[F.col(c) for c in by])


def write_jsonl(
    df: DataFrame, path: str, by: str = "lang", columns: Sequence[str] = ("text",),
    shard_bytes: int = GIB, mode: str = "overwrite", order: Sequence[str] = (), max_rows: int = 0,
) -> None:
    """JSON lines, one folder `<by>=<value>` per value; replaces the folders it writes.

    With an `order` the files of a folder follow each other in it. Either way a large value
    is spread over many files, of at most `max_rows` rows if that is not 0.
    """
    if order:
        out = df.repartitionByRange(by, *order).sortWithinPartitions(by, *order)
    else:
        out = _rebalanced(df, by)
    with _conf(df.sparkSession, "spark.sql.adaptive.advisoryPartitionSizeInBytes", str(shard_bytes)):
        (out.select(by, *columns).write.mode(mode).option("partitionOverwriteMode", "dynamic")
            .option("ignoreNullFields", "false").option("maxRecordsPerFile", max_rows)
            .partitionBy(by).json(path))


def write_capped(df: DataFrame, path: str, rows: int = 2_000_000, by: Sequence[str] = ()) -> None:
    """JSON lines in files of at most `rows` rows; which file a row goes to does not matter."""
    writer = _rebalanced(df, *by).write if by else df.write
    writer = writer.mode("overwrite").option("maxRecordsPerFile", rows)
    (writer.option("partitionOverwriteMode", "dynamic").partitionBy(*by) if by else writer).json(path)


def write_parts(
    df: DataFrame, path: str, part_size: int = 500_000, order: Order | None = None,
    columns: Sequence[str] = ("text",), fmt: str = "json",
) -> None:
    """JSON lines (or another format) in numbered parts of exactly `part_size` rows (the last may be smaller), in order."""
    order = order or source_order("ord")
    keys = [f"_key{i}" for i in range(len(order.keys))]
    numbered = assign_parts(df, part_size, order).select("part_id", *[k.alias(n) for k, n in zip(order.keys, keys)], *columns)
    ordered = numbered.repartition("part_id").sortWithinPartitions("part_id", *keys).drop(*keys)
    ordered.write.mode("overwrite").partitionBy("part_id").format(fmt).save(path)


def write_corpus(df: DataFrame, root: str, shard_bytes: int = GIB, mode: str = "overwrite") -> None:
    """Parquet by language and split, replacing the folders it writes."""
    with _conf(df.sparkSession, "spark.sql.adaptive.advisoryPartitionSizeInBytes", str(shard_bytes)):
        rows = _rebalanced(df, "lang", "split")
        if "ord" in df.columns:  # row groups of a file then hold ranges of positions
            rows = rows.sortWithinPartitions("lang", "split", "ord")
        (rows.write.mode(mode)
            .option("partitionOverwriteMode", "dynamic").partitionBy("lang", "split").parquet(root))


def write_shards(rows: DataFrame, manifest: DataFrame, path: str, source: str = "source") -> None:
    """Rows by source and shard, and the manifest beside them."""
    (rows.repartition(source, "shard").sortWithinPartitions(source, "shard", "row_id")
        .write.mode("overwrite").partitionBy(source, "shard").parquet(f"{path}/rows"))
    files = list_files(rows.sparkSession, f"{path}/rows").groupBy(
        F.regexp_extract("path", f"/{source}=([^/]+)/", 1).alias(source),
        F.regexp_extract("path", "/shard=([0-9]+)/", 1).cast("bigint").alias("index"),
    ).agg(F.sum("length").alias("file_size"))
    folder = F.concat(F.lit(f"rows/{source}="), F.col(source), F.lit("/shard="), F.col("index").cast("string"))
    written = manifest.withColumn("path", folder).join(files, [source, "index"], "left")
    written.write.mode("overwrite").json(f"{path}/manifest")


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of all files below a folder. Contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))).alias("path"), "length")


def pending_pairs(df: DataFrame, path: str) -> DataFrame:
    """The rows of `df` whose pair has no output at `path` yet."""
    return pending_work(df, finished_keys(df.sparkSession, path, "pair"), ["pair"], ["row_id"])


def write_pairs(df: DataFrame, path: str) -> None:
    """Parquet by pair, beside the pairs that are there already; those are not written again."""
    (pending_pairs(df, path).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("pair").parquet(path))


def append_stats(stats: DataFrame, path: str) -> None:
    """Adds the statistics of a run to those of earlier runs."""
    stats.write.mode("append").parquet(path)


def finished_keys(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Values of a partition column that have files already. Lists names; reads no contents."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        files = files.load(path)
    except AnalysisException:  # nothing was written there yet
        return spark.createDataFrame([], f"{key} string")
    value = F.regexp_extract("path", f"/{key}=([^/]+)/", 1)
    return files.select(value.alias(key)).where(F.col(key) != "").distinct()


def write_pending(df: DataFrame, path: str, by: str = "lang", columns: Sequence[str] = ("text",)) -> None:
    """As `write_jsonl`, for the values which have no output yet."""
    todo = pending_work(df, finished_keys(df.sparkSession, path, by), [by], list(columns))
    write_jsonl(todo, path, by, columns)


def committed_units(spark: SparkSession, path: str, group: str = "pair") -> DataFrame:
    """(group, unit, n_rows) of the units whose output at `path` is complete. Reads the log only."""
    schema = f"{group} string, unit long, n_rows long"
    try:
        return spark.read.schema(schema).json(f"{path}/{LOG}").distinct()
    except AnalysisException:  # nothing was finished yet
        return spark.createDataFrame([], schema)


def write_units(
    rows: DataFrame, make: Callable[[DataFrame], DataFrame], path: str, group: str = "pair", row: str = "row_id",
    unit_rows: int = UNIT_ROWS, job_rows: int = JOB_ROWS,
) -> None:
    """`make(rows)` as Parquet by group and unit, in jobs that can be taken up again.

    A unit is a range of `unit_rows` row numbers of a group. A job writes whole units of about
    `job_rows` rows, which replace what an earlier attempt left of them; then the rows that are
    there are counted and logged. Units in the log are not made again, so a run that was killed
    loses its last job only. Names of a few ranges at a time pass the driver. `make` has to keep
    `group` and `row`, and gives one row for each.
    """
    spark = rows.sparkSession
    unit = F.floor(F.col(row) / F.lit(unit_rows)).cast("bigint").alias("unit")
    wanted = rows.groupBy(group, unit).agg(F.count("*").alias("n_rows"))
    todo = materialize(wanted.join(committed_units(spark, path, group), [group, "unit", "n_rows"], "left_anti"))

    def run(batch: list[Row]) -> None:
        spans: list[list] = []
        for r in batch:
            if spans and spans[-1][0] == r[group] and spans[-1][2] + 1 == r.unit:
                spans[-1][2] = r.unit
            else:
                spans.append([r[group], r.unit, r.unit])
        mine = reduce(Column.__or__, [
            (F.col(group) == g) & F.col(row).between(first * unit_rows, (last + 1) * unit_rows - 1) for g, first, last in spans
        ])
        (make(rows.where(mine)).withColumn("unit", unit).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy(group, "unit").parquet(path))
        there = reduce(Column.__or__, [(F.col(group) == g) & F.col("unit").between(a, b) for g, a, b in spans])
        written = spark.read.parquet(path).where(there).groupBy(group, F.col("unit").cast("bigint").alias("unit")).agg(F.count("*").alias("n_rows"))
        expected = todo.where(there)
        if expected.count() != len(batch) or not expected.join(written, [group, "unit", "n_rows"], "left_anti").isEmpty():
            raise ValueError(f"rows written below {path} are not those that were read")
        expected.coalesce(1).write.mode("append").json(f"{path}/{LOG}")

    batch, n, spans = [], 0, 0
    for r in todo.orderBy(group, "unit").toLocalIterator():
        if batch and (n + r.n_rows > job_rows or spans >= MAX_SPANS):
            run(batch)
            batch, n, spans = [], 0, 0
        spans += not batch or (batch[-1][group], batch[-1].unit + 1) != (r[group], r.unit)
        batch.append(r)
        n += r.n_rows
    if batch:
        run(batch)
