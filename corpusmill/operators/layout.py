"""File and pair names: what they say about origin, split, languages and direction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

SCORED_LAST = ("en", "fr", "pt")  # fixed values: languages put on the source side for scoring


def _first_match(stem: Column, rules: Sequence[tuple[Column, str]]) -> Column:
    out = F.when(rules[0][0], F.lit(rules[0][1]))
    for condition, value in rules[1:]:
        out = out.when(condition, F.lit(value))
    return out


def infer_origin(stem: str | Column) -> Column:
    """The origin a file name stands for, or null. Differs from `infer_split` in order and names."""
    s = F.lower(F.col(stem) if isinstance(stem, str) else stem)
    has = lambda part: F.contains(s, F.lit(part))
    # Name parts, in order of precedence.
    return _first_match(s, [
        (has("fw2"), "fw2"),
        (has("documentlevel"), "wuraDocumentLevel"),
        (has("fwedu"), "fwedu"),
        (has("ml400"), "madlad400"),
        (has("wura"), "wura"),
        (has("extra"), "extra"),
    ])


def infer_split(lang: str | Column, stem: str | Column) -> Column:
    """The split of the corpus a file belongs to, or null."""
    lang = F.col(lang) if isinstance(lang, str) else lang
    s = F.lower(F.col(stem) if isinstance(stem, str) else stem)
    has = lambda part: F.contains(s, F.lit(part))
    # Name parts, in order of precedence.
    return _first_match(s, [
        (has("documentlevel"), "wura_documentLevel"),
        (has("finedu") | has("fwedu") | has("finewebedu"), "finewebEdu"),
        ((lang == "eng_Latn") & has("fw2"), "finewebEdu"),
        (has("fw2") | has("fineweb2"), "fineweb2"),
        (has("ml400") | has("madlad"), "madlad400"),
        (has("extra"), "extraData"),
        (has("wura"), "wura"),
    ])


def with_origin(df: DataFrame, stem: str = "stem") -> DataFrame:
    """Adds `dataset_origin`; rows of unknown origin are left out, a second call changes nothing."""
    if "dataset_origin" in df.columns:
        return df
    return df.withColumn("dataset_origin", infer_origin(stem)).where(F.col("dataset_origin").isNotNull())


def path_lang(path: Column) -> Column:
    """The folder a file lies in."""
    return F.element_at(F.split(path, "/"), -2)


def path_stem(path: Column) -> Column:
    """The file name without its last extension."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), "\\.[^.]*$", "")


def inventory(files: DataFrame, path: str = "path") -> DataFrame:
    """Files per (lang, split) from a table of paths `<root>/<lang>/<stem>.parquet`."""
    lang, stem = path_lang(F.col(path)), path_stem(F.col(path))
    return (
        files.where(F.endswith(F.col(path), F.lit(".parquet")))
        .select(lang.alias("lang"), infer_split(lang, stem).alias("split"))
        .where(F.col("split").isNotNull())
        .groupBy("lang", "split").agg(F.count("*").alias("n_files"))
    )


def pair_of(stem: str | Column) -> Column:
    """`src-tgt` from a file stem; the number of a shard at its end is dropped."""
    return F.regexp_replace(F.col(stem) if isinstance(stem, str) else stem, "\\d+$", "")


def pair_sides(pair: str | Column) -> tuple[Column, Column]:
    """Both codes, split at the first '-'; nulls where there is none."""
    p = F.col(pair) if isinstance(pair, str) else pair
    at = F.instr(p, "-")
    src = F.when(at > 0, F.substring(p, F.lit(1), at - 1))
    tgt = F.when(at > 0, F.substring(p, at + 1, F.length(p)))
    return src, tgt


def scored_reversed(pair: str | Column) -> Column:
    """True where scoring exchanges both sides, so that en, fr or pt is the source."""
    src, tgt = pair_sides(pair)
    return F.coalesce(tgt.isin(*SCORED_LAST) & ~src.isin("", *SCORED_LAST), F.lit(False))


def score_direction(
    df: DataFrame, src: str = "sentence1", mt: str = "sentence2", pair: str = "pair"
) -> DataFrame:
    """Adds `src` and `mt`, the two sides in the order in which they are scored."""
    flip = scored_reversed(pair)
    return df.withColumns({
        "src": F.when(flip, F.col(mt)).otherwise(F.col(src)),
        "mt": F.when(flip, F.col(src)).otherwise(F.col(mt)),
    })
