"""Readers for bitext, its scores, and line-aligned files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.text import strip
from ..operators.layout import pair_of, path_stem
from ..operators.lookup import attach, counted_table, small_table
from .lines import read_lines


def _by_pair(spark: SparkSession, root: str) -> DataFrame:
    files = spark.read.option("pathGlobFilter", "*.parquet").parquet(root)
    return files.withColumns({
        "pair": path_stem(F.col("_metadata.file_path")),
        "row_id": F.col("_metadata.row_index"),
    })


def read_bitext(spark: SparkSession, root: str) -> DataFrame:
    """`<root>/<src>-<tgt>.parquet`, each row with its pair and its number in the file."""
    return _by_pair(spark, root)


def read_scores(spark: SparkSession, root: str, score: str = "comet_score") -> DataFrame:
    """Score files with one column of any name, numbered like the bitext they belong to."""
    df = _by_pair(spark, root)
    value = [c for c in df.columns if c not in ("pair", "row_id")]
    if len(value) != 1:
        raise ValueError(f"score files must have one column, not {value}")
    return df.select("pair", "row_id", F.col(value[0]).cast("double").alias(score))


def pair_sizes(src: DataFrame, tgt: DataFrame, scores: DataFrame) -> DataFrame:
    """(pair, n_src, n_tgt, n_scores, n_numbers, aligned): lines of each table (pair, line, value), scores that are numbers.

    A pair is aligned if all numbers agree.
    """
    number = F.expr("try_cast(value AS double)")
    one, two = (df.groupBy("pair").agg(F.count("*").alias(n)) for df, n in ((src, "n_src"), (tgt, "n_tgt")))
    three = scores.groupBy("pair").agg(F.count("*").alias("n_scores"), F.count(number).alias("n_numbers"))
    sizes = one.join(two, "pair", "full").join(three, "pair", "full").na.fill(0)
    same = (F.col("n_src") == F.col("n_tgt")) & (F.col("n_tgt") == F.col("n_scores")) & (F.col("n_scores") == F.col("n_numbers"))
    return sizes.withColumn("aligned", same)


def align_lines(
    src: DataFrame, tgt: DataFrame, scores: DataFrame, report: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """Bitext from three tables (pair, line, value) which belong together line by line.

    A pair is left out when the numbers of lines differ or a score is not a number. `report`
    gets the `pair_sizes` of those left out.
    """
    sizes, fits = small_table(pair_sizes(src, tgt, scores))
    if report is not None:
        report(sizes.where("not aligned").drop("aligned"))
    good = sizes.where("aligned").select("pair")
    scored = scores.select("pair", "line", F.expr("try_cast(value AS double)").alias("score"))
    first = src.select("pair", "line", strip("value").alias("sentence1"))
    second = tgt.select("pair", "line", strip("value").alias("sentence2"))
    first, second, scored = (attach(df, good, ["pair"], fits, spread=["line"]) for df in (first, second, scored))
    return (
        first.join(second, ["pair", "line"]).join(scored, ["pair", "line"])
        .withColumnRenamed("line", "row_id")
    )


def read_moses(spark: SparkSession, root: str, report: Callable[[DataFrame], None] | None = None) -> DataFrame:
    """Bitext from extracted files `*.<src>-<tgt>.<src>`, `*.<src>-<tgt>.<tgt>` and `*.<src>-<tgt>.scores`."""
    parts = F.split(F.element_at(F.split(F.col("_path"), "/"), -1), "\\.")
    pair, kind = F.try_element_at(parts, F.lit(-2)), F.try_element_at(parts, F.lit(-1))
    sides = F.split(pair, "-")
    # each file is read for its own part only
    first, second, scores = (
        read_lines(spark, root, pair, line_sep="\n", name="pair", only=only)
        for only in (kind == F.get(sides, 0), kind == F.get(sides, 1), kind == "scores")
    )
    return align_lines(first, second, scores, report)


def complete_shards(shards: DataFrame, manifest: DataFrame) -> DataFrame:
    """`shards` (pair, index, ..) as they are; any shard whose rows are not those of the manifest fails the job."""
    found = shards.groupBy("pair", "index").agg(F.count("*").alias("_n"))
    both = manifest.select("pair", "index", "num_rows").join(found, ["pair", "index"], "full")
    named = F.concat(
        F.lit("missing scored shard "), F.col("pair"), F.col("index").cast("string"), F.lit(": rows "),
        F.coalesce(F.col("_n"), F.lit(0)).cast("string"), F.lit(", manifest "), F.coalesce(F.col("num_rows").cast("string"), F.lit("none")),
    )
    same = F.coalesce(F.col("_n") == F.col("num_rows"), F.lit(False))
    # counted in the cluster, so that shards, however many, are neither fetched nor joined with their rows once more
    both.agg(F.count_if(F.when(same, F.lit(True)).otherwise(F.raise_error(named).cast("boolean")))).first()
    return shards


def merge_scored_shards(
    shards: DataFrame, manifest: DataFrame, score: str = "comet_score"
) -> DataFrame:
    """Scores of shards as one table, numbered like the rows that were split.

    `shards` has (pair, index, row_id within the shard, score); `manifest` one row per
    expected shard with its `num_rows`. A shard with more or fewer scores, or one that the
    manifest lacks, fails the job.
    """
    shards = complete_shards(shards, manifest)
    before = Window.partitionBy("pair").orderBy("index").rowsBetween(Window.unboundedPreceding, -1)
    offsets = manifest.select("pair", "index", F.coalesce(F.sum("num_rows").over(before), F.lit(0)).alias("_at"))
    offsets, fits = counted_table(offsets)
    numbered = attach(shards, offsets, ["pair", "index"], fits, spread=["row_id"])
    return numbered.select("pair", (F.col("_at") + F.col("row_id")).alias("row_id"), score)


def read_scored_shards(spark: SparkSession, root: str, score: str = "comet_score") -> DataFrame:
    """`<root>/<pair>/<pair><number>.parquet` with one column of scores."""
    df = spark.read.option("pathGlobFilter", "*.parquet").parquet(f"{root}/*/")
    value = df.columns[0]
    stem = path_stem(F.col("_metadata.file_path"))
    return df.select(
        pair_of(stem).alias("pair"),
        F.regexp_extract(stem, "(\\d+)$", 1).cast("bigint").alias("index"),
        F.col("_metadata.row_index").alias("row_id"),
        F.col(value).cast("double").alias(score),
    )
