"""Joins of bitext with its scores, and completeness checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .lookup import attach, small_table

MAX_BITMAPS = 16_384  # 64 MB


def _fingerprint(df: DataFrame, pair: str, row: str, name: str) -> DataFrame:
    """Per pair: the number of rows, and a checksum of the set of row numbers."""
    return df.groupBy(pair).agg(
        F.count("*").alias(f"n_{name}"), F.bit_xor(F.xxhash64(F.col(row))).alias(f"h_{name}")
    )


def score_coverage(
    bitext: DataFrame, scores: DataFrame, pair: str = "pair", row: str = "row_id"
) -> DataFrame:
    """Per pair: rows on both sides and whether they are the same rows. Reads keys only."""
    both = _fingerprint(bitext, pair, row, "bitext").join(
        _fingerprint(scores, pair, row, "scores"), pair, "full"
    )
    aligned = F.coalesce(
        (F.col("n_bitext") == F.col("n_scores")) & (F.col("h_bitext") == F.col("h_scores")),
        F.lit(False),
    )
    return both.select(
        pair,
        F.coalesce("n_bitext", F.lit(0)).alias("n_bitext"),
        F.coalesce("n_scores", F.lit(0)).alias("n_scores"),
        aligned.alias("aligned"),
    )


def join_scores(
    bitext: DataFrame, scores: DataFrame, pair: str = "pair", row: str = "row_id"
) -> DataFrame:
    """Bitext with its scores, row by row.

    Pairs found on one side only are skipped. A pair whose rows differ between the sides
    fails the job. The check goes to the bitext side below the join, so filters and column
    pruning still reach both scans.
    """
    cover = score_coverage(bitext, scores, pair, row)
    both = (F.col("n_bitext") > 0) & (F.col("n_scores") > 0)
    cover, fits = small_table(cover.where(both).select(pair, "aligned"))
    checked = attach(bitext, cover, [pair], fits, spread=[row])
    mismatch = F.raise_error(F.concat(F.lit("bitext and scores differ in length for "), F.col(pair)))
    checked = checked.where(F.when(F.col("aligned"), F.lit(True)).otherwise(mismatch.cast("boolean")))
    return checked.drop("aligned").join(scores, [pair, row])


def missing_scores(bitext: DataFrame, scores: DataFrame, pair: str = "pair") -> DataFrame:
    """Pairs of the bitext that have no scores at all."""
    return bitext.select(pair).distinct().join(scores.select(pair).distinct(), pair, "left_anti")


def missing_splits(config: DataFrame, inventory: DataFrame) -> DataFrame:
    """(lang, split) a mixture asks for, in languages that were found, without files."""
    found = inventory.select("lang", "split").distinct()
    return (
        config.select("lang", "split").distinct()
        .join(found.select("lang").distinct(), "lang", "left_semi")
        .join(found, ["lang", "split"], "left_anti")
    )


def pending_work(
    work: DataFrame, finished: DataFrame, keys: list[str], spread: list[str] | None = None
) -> DataFrame:
    """The part of `work` whose keys are not finished yet: a work list, or the rows themselves.

    `spread` names columns that differ within a key, for more finished keys than a
    broadcast may have.
    """
    done, fits = small_table(finished.select(*keys).distinct())
    return attach(work, done, keys, fits, "left_anti", spread or [])


def discover_splits(
    found: DataFrame, wanted: list[str], fallback: dict[str, list[str]]
) -> DataFrame:
    """(lang, split, split_pos) for each wanted language: the splits found, else a given list."""
    spark = found.sparkSession
    splits = (
        found.select("lang", "split").distinct().where(F.col("lang").isin(wanted))
        .groupBy("lang").agg(F.sort_array(F.collect_set("split")).alias("splits"))
    )
    backup = spark.createDataFrame(
        [(lang, fallback.get(lang)) for lang in wanted], "lang string, backup array<string>"
    )
    return (
        backup.join(splits, "lang", "left")
        .select("lang", F.posexplode(F.coalesce("splits", "backup")).alias("split_pos", "split"))
        .select("lang", "split", "split_pos")
    )


def only_rows(
    df: DataFrame, kept: DataFrame, group: str, row: str, max_bitmaps: int = MAX_BITMAPS
) -> DataFrame:
    """The rows of `df` whose (group, row number) stand in `kept`, without a shuffle of `df`.

    The numbers become bitmaps, one for each 32 768 numbers of a group, which are broadcast:
    4 KB where a shuffle would move that many rows. Up to `max_bitmaps`; with more of them `df`
    comes back as it is, so a join with `kept` has to follow in any case.
    """
    number = F.col(row).cast("bigint")
    bitmaps = materialize(
        kept.select(F.col(group), F.bitmap_bucket_number(number).alias("_bucket"), F.bitmap_bit_position(number).alias("_bit"))
        .groupBy(group, "_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    )
    if bitmaps.limit(max_bitmaps + 1).count() > max_bitmaps:
        return df
    bit = F.bitmap_bit_position(number)
    byte = F.conv(F.hex(F.substring("_bits", F.expr("_bit div 8 + 1").cast("int"), F.lit(1))), 16, 10).cast("int")
    found = df.withColumns({"_bucket": F.bitmap_bucket_number(number), "_bit": bit}).join(F.broadcast(bitmaps), [group, "_bucket"])
    return found.where(F.getbit(byte, (F.col("_bit") % 8).cast("int")) == 1).drop("_bucket", "_bit", "_bits")
