"""Readers for corpora, mixture configs and mixed input files."""

from __future__ import annotations

import os
import re
from collections.abc import Sequence
from fractions import Fraction
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from ..functions.text import is_nonblank
from ..operators.layout import inventory
from ..operators.lookup import MAX_SMALL_ROWS, attach, small_table
from ..operators.prefix import BLOCK_BITS, source_order
from ..operators.sampling import take
from ..session import materialize
from .lines import read_lines
from .normalize import parse_json_lines

MAX_LISTED = 10_000
LAST_SHARD = 239  # fixed value
CONFIG_COLUMNS = ("subset", "token_count", "split")


def parse_fraction(fraction: str | float) -> float:
    """'1/3', '0.5', 0.5 or 1."""
    return float(Fraction(fraction)) if isinstance(fraction, str) and "/" in fraction else float(fraction)


def parse_mixture_config(
    config: DataFrame, fraction: str | float = "1.0", subsets: Sequence[str] | None = None
) -> DataFrame:
    """(lang, split, split_pos, target) from rows (subset, token_count, comma list of splits).

    A missing count is 0, a missing list is empty; blank split names are skipped.
    """
    missing = [c for c in CONFIG_COLUMNS if c not in config.columns]
    if missing:
        raise ValueError(f"mixture config lacks the columns {missing}")
    rows = config.where(F.col("subset").isin(list(subsets))) if subsets else config
    count = F.coalesce(F.col("token_count").cast("double"), F.lit(0.0)).cast("bigint")
    return (
        rows.select(
            F.col("subset").alias("lang"),
            F.floor(count * F.lit(parse_fraction(fraction))).cast("bigint").alias("target"),
            F.posexplode(F.split(F.coalesce("split", F.lit("")), ",")).alias("split_pos", "_split"),
        )
        .withColumn("split", F.trim("_split"))
        .where(F.col("split") != "")
        .select("lang", "split", "split_pos", "target")
    )


def read_mixture_config(
    spark: SparkSession, path: str, fraction: str | float = "1.0", subsets: Sequence[str] | None = None
) -> DataFrame:
    """A mixture config from a CSV file with a header."""
    return parse_mixture_config(spark.read.option("header", True).csv(path), fraction, subsets)


def with_positions(
    df: DataFrame, by: Sequence[str] = ("lang", "split"), path: str = "_path", row: str = "_row"
) -> DataFrame:
    """Adds `ord`: the place of a row over all files of its group, files following by name."""
    sizes = df.groupBy(*by, path).agg((F.max(row) + 1).alias("_n"))
    before = Window.partitionBy(*by).orderBy(path).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_at", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    offsets, fits = small_table(offsets)
    placed = attach(df, offsets, [*by, path], fits, spread=[row])
    return placed.withColumn("ord", F.col("_at") + F.col(row)).drop("_at", row)


def read_corpus(spark: SparkSession, root: str, where: Column | None = None) -> DataFrame:
    """A corpus by language and split, with an `ord` where it was stored without."""
    df = spark.read.parquet(root)
    if where is not None:
        df = df.where(where)
    if "ord" in df.columns:
        return df
    return with_positions(df.withColumns({
        "_path": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")
    })).drop("_path")


def folder_marks(spark: SparkSession, root: str) -> DataFrame:
    """(lang, split, mark) of the folders of a corpus; a mark changes with the files. Lists names only."""
    place = F.transform(
        F.regexp_extract_all("path", F.lit(r"/(?:lang|split)=([^/]+)"), 1),
        lambda value: F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))),
    )
    name = F.element_at(F.split("path", "/"), -1)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return (
        files.where(F.size(place) == 2)
        .groupBy(place[0].alias("lang"), place[1].alias("split"))
        .agg(F.bit_xor(F.xxhash64(name, "length")).alias("mark"))
    )


def block_sizes(corpus: DataFrame) -> DataFrame:
    """(lang, split, block, n_rows, first, last, chars) of blocks of 65 536 positions."""
    block = F.shiftright("ord", BLOCK_BITS)
    return corpus.groupBy(F.col("lang").cast("string"), F.col("split").cast("string"), block.alias("block")).agg(
        F.count("*").alias("n_rows"), F.min("ord").alias("first"), F.max("ord").alias("last"),
        F.coalesce(F.sum(F.length("text").cast("bigint")), F.lit(0).cast("bigint")).alias("chars"),
    )


def store_block_sizes(spark: SparkSession, root: str) -> None:
    """Adds the sizes of blocks to `<root>/_blocks/sizes` for folders that have none, or have other files by now."""
    marks = folder_marks(spark, root)
    known = _stored_blocks(spark, root)
    if known is not None:
        marks = marks.join(known.select("lang", "split", "mark").distinct(), ["lang", "split", "mark"], "left_anti")
    marks, fits = small_table(marks)
    if marks.isEmpty():
        return
    rows = attach(read_corpus(spark, root), marks.select("lang", "split"), ["lang", "split"], fits, spread=["ord"])
    sizes = attach(block_sizes(rows), marks, ["lang", "split"], fits, spread=["block"])
    folder = Window.partitionBy("lang", "split")
    sizes.withColumn("n_blocks", F.count("*").over(folder)).write.mode("append").parquet(f"{root}/_blocks/sizes")


def _stored_blocks(spark: SparkSession, root: str) -> DataFrame | None:
    """What is stored of folders whose blocks are all there, once."""
    try:
        stored = spark.read.parquet(f"{root}/_blocks/sizes")
    except AnalysisException:
        return None
    whole = F.count("*").over(Window.partitionBy("lang", "split", "mark")) == F.col("n_blocks")
    return stored.withColumn("_whole", whole).where("_whole").drop("_whole")


def read_block_sizes(spark: SparkSession, root: str, config: DataFrame) -> DataFrame | None:
    """The stored sizes of the blocks a config names, or None if a folder's were never stored or its files are others."""
    stored = _stored_blocks(spark, root)
    if stored is None:
        return None
    wanted = config.select("lang", "split").distinct()
    marks, fits = small_table(folder_marks(spark, root).join(wanted, ["lang", "split"], "left_semi"))
    if not marks.join(stored, ["lang", "split", "mark"], "left_anti").isEmpty():
        return None
    return attach(stored, marks, ["lang", "split", "mark"], fits, spread=["block"]).drop("mark", "n_blocks")


def scan_corpus(spark: SparkSession, root: str, config: DataFrame) -> DataFrame:
    """The rows of a corpus that a config names, with their `split_pos`.

    Up to MAX_LISTED (lang, split) pairs become a filter on the partition columns. With more
    the config is joined; Spark prunes the folders by its keys when it runs. Either way other
    folders are not read.
    """
    places = config.select("lang", "split", "split_pos")
    wanted = config.select("lang", "split").distinct().limit(MAX_LISTED + 1).collect()
    if len(wanted) > MAX_LISTED:
        # a filter on a stored dimension, if one that all its rows pass, is what makes Spark prune by it
        places = materialize(places)
        fits = places.count() <= MAX_SMALL_ROWS
        return attach(read_corpus(spark, root), places.where("split_pos >= 0"), ["lang", "split"], fits)
    langs, splits = sorted({r.lang for r in wanted}), sorted({r.split for r in wanted})
    named = F.struct("lang", "split").isin([F.struct(F.lit(r.lang), F.lit(r.split)) for r in wanted])
    rows = read_corpus(spark, root, F.col("lang").isin(langs) & F.col("split").isin(splits) & named)
    return rows.join(F.broadcast(places), ["lang", "split"])


def select_subset(corpus: DataFrame, lang: str, splits: Sequence[str]) -> DataFrame:
    """One language and its named splits, blank names skipped; no names give no rows."""
    names = [s.strip() for s in splits if s.strip()]
    rows = corpus.where((F.col("lang") == lang) & F.col("split").isin(names)) if names else corpus.where(F.lit(False))
    position = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("split")) - 1 if names else F.lit(0)
    return rows.withColumn("split_pos", position.cast("int"))


def read_rows(
    spark: SparkSession, path: str, fmt: str | None = None, text_column: str = "text",
    max_samples: int | None = None, schema: str | StructType | None = None,
) -> DataFrame:
    """Rows with a non-blank text from .parquet, .jsonl, .json (a list or one object) or text lines.

    A given number of first rows is taken in the order of the file. A schema for JSON saves
    the scan that would infer one.
    """
    fmt = fmt or path.rsplit(".", 1)[-1].lower()
    reader = spark.read.schema(schema) if schema else spark.read
    if fmt == "parquet":
        df = reader.parquet(path).withColumns({
            "_file": F.col("_metadata.file_path"), "_ord": F.col("_metadata.row_index")
        })
    elif fmt == "json":
        # a file is one JSON value, so one task has to read it
        df = reader.option("multiLine", True).json(path).withColumns({
            "_file": F.col("_metadata.file_path"), "_ord": F.monotonically_increasing_id()
        })
    else:
        lines = read_lines(spark, path, F.lit(path), name="_file").withColumnRenamed("line", "_ord")
        lines = lines.where(is_nonblank("value"))
        if fmt == "jsonl":
            fields = schema or spark.read.json(path).schema
            parsed = lines.select("_file", "_ord", F.from_json("value", fields).alias("_json"))
            df = parsed.select("_file", "_ord", "_json.*")
        else:
            df = lines.withColumnRenamed("value", "text")
    df = df.where(is_nonblank(F.col(text_column).cast("string")))
    if max_samples:
        df = take(df, max_samples, order=source_order("_ord", "_file"))
    return df.drop("_ord", "_file")


def odd_shard(name: str | Column) -> Column:
    """True for `shard-NNNNN.jsonl.gz` with an odd number up to LAST_SHARD."""
    number = F.regexp_extract(F.col(name) if isinstance(name, str) else name, r"shard-(\d{5})\.jsonl\.gz$", 1)
    number = number.try_cast("int")
    return F.coalesce((number <= LAST_SHARD) & (number % 2 == 1), F.lit(False))


def read_code_shards(spark: SparkSession, root: str) -> DataFrame:
    """(_file, ord, query, document) of the odd-numbered shards; the others are not read."""
    names = "shard-[0-9][0-9][0-9][0-9][13579].jsonl.gz"
    file = relative_path(F.col("_path"), root)
    lines = read_lines(spark, f"{root}/{names}", file, name="_file", only=odd_shard("_path"))
    return parse_json_lines(lines.withColumnRenamed("line", "ord"), ["query", "document"])


def relative_path(path: Column, root: str) -> Column:
    """The part of a file's path below `root`, the same wherever the data lies."""
    plain = root if "://" in root or root.startswith("/") else os.path.abspath(root)
    below = F.split(path, re.escape(quote(plain.rstrip("/"), safe="/:")), 2)
    return F.coalesce(F.try_element_at(below, F.lit(2)), path)


def file_inventory(spark: SparkSession, root: str, languages: Sequence[str] | None = None) -> DataFrame:
    """Files per (lang, split) below `<root>/<lang>/`. Lists names; contents are not read."""
    files = spark.read.format("binaryFile").load(f"{root}/*/*.parquet").select("path")
    found = inventory(files)
    return found.where(F.col("lang").isin(list(languages))) if languages else found
