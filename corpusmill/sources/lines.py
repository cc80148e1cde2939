"""Text files as tables of numbered lines."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..operators.layout import path_lang
from ..operators.lookup import attach, small_table

SPLIT = ["_path", "_start", "_length"]


def _bytes(setting: str) -> int:
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", setting.strip().lower()).groups()
    return int(number) << (10 * " kmgtp".index(unit or " "))


def pinned_session(spark: SparkSession, paths: Sequence[str]) -> SparkSession:
    """A session with the settings of `spark` whose scans of these files always cut them at the same places.

    How Spark cuts files follows from the size of the cluster at that moment and from the sum of
    the files that a plan reads. Here the length of a range is settled once, as Spark would
    choose it now for all files, and neither counts any more. A scan keeps the settings of the
    session that made it.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    total = spark.read.format("binaryFile").load(list(paths)).agg(F.sum("length")).first()[0] or 0
    most, least = (_bytes(spark.conf.get(f"spark.sql.files.{k}")) for k in ("maxPartitionBytes", "openCostInBytes"))
    share = total // max(spark.sparkContext.defaultParallelism, 1) + 1
    own.conf.set("spark.sql.files.maxPartitionBytes", str(min(most, max(least, share))))
    own.conf.set("spark.sql.files.minPartitionNum", "1")
    own.conf.unset("spark.sql.files.maxPartitionNum")
    return own


def split_lines(
    spark: SparkSession, paths: str | Sequence[str], line_sep: str | None = None, only: Column | None = None,
) -> DataFrame:
    """(value, _path, _start, _length, _id): the lines of text files, the byte range each was read with, an id.

    Files and ranges are listed once and are the same in every job over the result. Ids grow by
    one from line to line of a range. `only`, a filter for files, is an expression over `_path`;
    other files are not opened.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = pinned_session(spark, paths).read
    reader = reader.option("lineSep", line_sep) if line_sep else reader
    files = reader.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.col("_metadata.file_block_length").alias("_length"),
    )
    if only is not None:
        files = files.where(only)
    lines = files.withColumn("_id", F.monotonically_increasing_id())
    # a union with nothing belongs to the caller's session, whose settings hold for all that follows the scan
    return spark.createDataFrame([], lines.schema).where(F.lit(False)).union(lines)


def read_lines(
    spark: SparkSession, paths: str | Sequence[str], group: Column | None = None,
    line_sep: str | None = None, name: str = "lang", only: Column | None = None,
    over: Column | None = None,
) -> DataFrame:
    """(group, value, line): the lines of text files (also .gz), numbered from 0 per group.

    The group defaults to the folder of a file. Files of a group follow each other by name.
    `group` and `only`, a filter for files, are expressions over the column `_path`. So is
    `over`, a larger group: with it there is a second number, `ord`, that runs over it.

    The number of a line is the lines of earlier byte ranges plus its place in its own range.
    One job counts the lines of every range; the table that is returned reads the files a
    second time, with exactly those ranges. Lines are neither copied, shuffled nor sorted. A
    line whose range or place is unknown fails the job.
    """
    group = group if group is not None else path_lang(F.col("_path"))
    lines = split_lines(spark, paths, line_sep, only)
    counted = lines.groupBy(*SPLIT).agg(F.count("*").alias("_n"), F.min("_id").alias("_first")).withColumn(name, group)
    offsets = counted.withColumn("_line", _lines_before(F.col(name)))
    numbers = {"line": "_line"}
    if over is not None:
        offsets = offsets.withColumn("_ord", _lines_before(over))
        numbers["ord"] = "_ord"
    offsets, fits = small_table(offsets)
    numbered = attach(lines, offsets, SPLIT, fits, "left")
    place = F.col("_id") - F.col("_first")
    place = F.when(place.between(0, F.col("_n") - 1), place).otherwise(
        F.raise_error(F.concat(F.lit("a line without a number in "), F.col("_path"))).cast("bigint")
    )
    return numbered.select(name, "value", *[(F.col(c) + place).alias(n) for n, c in numbers.items()])


def _lines_before(group: Column) -> Column:
    w = Window.partitionBy(group).orderBy("_path", "_start").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_n").over(w), F.lit(0))
