"""Score filters for bitext: absolute, percentile and peak, per language pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .lookup import attach, small_table

BINS = 4096
HISTOGRAM_BINS = 1000


def usable(score: Column) -> Column:
    return score.isNotNull() & ~F.isnan(score)


def _pick_bin(bins: DataFrame, by: str) -> DataFrame:
    """The bin of each group that holds row number `_rank` of those counted.

    Keeps the range of the bin, the rank inside it, and the least score above it.
    """
    w = Window.partitionBy(by).orderBy("_bin")
    return (
        bins.withColumn("_seen", F.sum("_n").over(w))
        .withColumn("_above", F.coalesce(F.lead("_lo").over(w), F.col("_above")))
        .where((F.col("_seen") > F.col("_rank")) & (F.col("_seen") - F.col("_n") <= F.col("_rank")))
        .withColumn("_rank", F.col("_rank") - (F.col("_seen") - F.col("_n")))
        .select(by, "_lo", "_hi", "_above", "_rank", "_frac", "_n")
    )


def score_percentile(df: DataFrame, score: str, t: float, by: str = "pair") -> DataFrame:
    """The exact percentile with linear interpolation, one row (`by`, `cutoff`) per group.

    Finds the two neighbouring scores by narrowing a range twice: counts per bin, the bin
    with the wanted rank, then the distinct scores in it. A group is never sorted or
    gathered as a whole; each step needs counts of at most a few thousand bins per group.
    """
    q = (t * 100) / 100
    x = F.col(score).cast("double")
    scores = df.where(usable(x)).select(by, x.alias("_x"))
    stats = [F.count("*").alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi")]

    # First bins: fixed width over [-1, 2); scores outside share the bins at both ends.
    first = F.floor(F.greatest(F.least(F.col("_x"), F.lit(2.0)), F.lit(-1.0)) * BINS)
    bins = scores.groupBy(by, first.alias("_bin")).agg(*stats)
    rank = (F.sum("_n").over(Window.partitionBy(by)) - 1) * F.lit(q)
    ranked = bins.withColumn("_at", rank).withColumns({
        "_rank": F.floor("_at"),
        "_frac": F.col("_at") - F.floor("_at"),
        "_above": F.lit(None).cast("double"),
    })
    picked, fits = small_table(_pick_bin(ranked, by).drop("_n"))

    def inside(picked: DataFrame) -> DataFrame:
        joined = attach(scores, picked, [by], fits, spread=["_x"])
        return joined.where(F.col("_x").between(F.col("_lo"), F.col("_hi")))

    carried = [F.first(c).alias(c) for c in ("_above", "_rank", "_frac")]
    width = F.col("_hi") - F.col("_lo")
    fine = F.when(width > 0, F.floor((F.col("_x") - F.col("_lo")) / width * BINS)).otherwise(0)
    bins = inside(picked).withColumn("_bin", fine).groupBy(by, "_bin").agg(*stats, *carried)
    picked, fits = small_table(_pick_bin(bins, by).drop("_n"))

    values = (
        inside(picked).groupBy(by, "_x").agg(F.count("*").alias("_n"), *carried)
        .withColumns({"_bin": F.col("_x"), "_lo": F.col("_x"), "_hi": F.col("_x")})
    )
    # The rank is now the place among equal scores: the next row may have the same score.
    ends = _pick_bin(values, by)
    a = F.col("_lo")
    same = (F.col("_frac") == 0) | (F.col("_rank") + 1 < F.col("_n"))
    b = F.when(same, a).otherwise(F.col("_above"))
    step = b - a
    cutoff = F.when(F.col("_frac") >= 0.5, b - step * (1 - F.col("_frac"))).otherwise(a + step * F.col("_frac"))
    return ends.select(by, cutoff.alias("cutoff"))


def histogram_bin(score: str | Column) -> Column:
    """The bin of [0, 1] in 1000 equal bins, with edges k x 0.001; null outside.

    The last bin includes 1.0. floor(x * 1000) can be off by one next to an edge, so the
    edges themselves decide.
    """
    x = (F.col(score) if isinstance(score, str) else score).cast("double")
    edge = F.lit(1.0 / HISTOGRAM_BINS)
    r = F.least(F.floor(x * HISTOGRAM_BINS), F.lit(HISTOGRAM_BINS - 1))
    fixed = (
        F.when(x < r * edge, r - 1)
        .when((r < HISTOGRAM_BINS - 1) & (x >= (r + 1) * edge), r + 1)
        .otherwise(r)
    )
    return F.when((x >= 0) & (x <= 1), fixed)


def score_histogram(df: DataFrame, score: str, by: str = "pair") -> DataFrame:
    """Rows per bin (`by`, `bin`, `n`); empty bins have no row."""
    return (
        df.where(usable(F.col(score)))
        .groupBy(by, histogram_bin(score).alias("bin")).agg(F.count("*").alias("n"))
        .where(F.col("bin").isNotNull())
    )


def score_peak(df: DataFrame, score: str, t: float, by: str = "pair") -> DataFrame:
    """The bound above the fullest bin, one row (`by`, `cutoff`) per group.

    The lowest bin wins a tie; a group with no score in [0, 1] peaks in bin 0.
    """
    in_range = (
        df.where(usable(F.col(score)))
        .groupBy(by, histogram_bin(score).alias("bin")).agg(F.count("*").alias("n"))
        .withColumn("n", F.when(F.col("bin").isNotNull(), F.col("n")).otherwise(F.lit(0)))
    )
    top = in_range.groupBy(by).agg(
        F.max_by(F.coalesce("bin", F.lit(0)), F.struct("n", -F.coalesce("bin", F.lit(0)))).alias("bin")
    )
    edge = F.lit(1.0 / HISTOGRAM_BINS)
    # 1.0 is the exact last edge, as the product would also give
    peak = (F.col("bin") * edge + (F.col("bin") + 1) * edge) / 2
    return top.select(by, (peak + F.lit(1.0 - t) * (1.0 - peak)).alias("cutoff"))


def score_bounds(
    df: DataFrame, score: str, strategy: str = "percentile", threshold: float = 0.7, by: str = "pair"
) -> DataFrame | None:
    """The least score to keep in each group; None for a bound that is the same for all."""
    if strategy == "absolute":
        return None
    if strategy == "percentile":
        return score_percentile(df, score, threshold, by)
    if strategy == "peak_percentile":
        return score_peak(df, score, threshold, by)
    raise ValueError(f"unknown score filter strategy: {strategy}")


def flag_score(
    df: DataFrame,
    score: str,
    flag: str,
    strategy: str = "percentile",
    threshold: float = 0.7,
    by: str = "pair",
    among: Column | None = None,
) -> DataFrame:
    """Adds `flag`, true where the score passes; bounds come from the rows `among` which is true."""
    rows = df if among is None else df.where(among)
    bounds = score_bounds(rows, score, strategy, threshold, by)
    good = usable(F.col(score))
    if bounds is None:
        return df.withColumn(flag, good & (F.col(score) >= F.lit(threshold)))
    bounds, fits = small_table(bounds.withColumnRenamed("cutoff", "_cutoff"))
    joined = attach(df, bounds, [by], fits, "left", [score])
    passed = F.coalesce(good & (F.col(score) >= F.col("_cutoff")), F.lit(False))
    return joined.withColumn(flag, passed).drop("_cutoff")


def filter_score(
    df: DataFrame,
    score: str,
    strategy: str = "percentile",
    threshold: float = 0.7,
    by: str = "pair",
) -> DataFrame:
    """Rows whose score reaches the bound of their group; null and NaN never do."""
    return flag_score(df, score, "_pass", strategy, threshold, by).where("_pass").drop("_pass")
