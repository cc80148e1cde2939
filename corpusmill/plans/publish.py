"""Raw source folders to one corpus by language and split."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..operators.filters import select_langs
from ..operators.joins import missing_splits
from ..operators.layout import infer_origin, infer_split, path_lang, path_stem
from ..sources.corpus import file_inventory, with_positions
from ..sources.lines import read_lines
from ..sources.normalize import (
    normalize_documents, normalize_extra, normalize_json_lines, normalize_passages,
    normalize_web, parse_json_lines,
)

# File extension and name part of each kind, in order of precedence.
KINDS = [
    ("documents", ".jsonl", "wura"),
    ("web", ".parquet", "fw2"),
    ("passages", ".txt", "wura"),
    ("json_lines", ".jsonl", "ml400"),
    ("json_lines_gz", ".jsonl.gz", "ml400"),
    ("json_lines_chunks", ".jsonl.gz", "_clean_"),
    ("extra", ".jsonl", "extra"),
]
KIND_BITS = 48


def file_kind(path: Column) -> Column:
    """How a raw file is read, or null for an unknown kind."""
    name = F.element_at(F.split(path, "/"), -1)
    out = F.lit(None).cast("string")
    for kind, extension, part in reversed(KINDS):
        fits = F.endswith(name, F.lit(extension)) & F.contains(name, F.lit(part))
        out = F.when(fits, F.lit(kind)).otherwise(out)
    return out


def _whole(path: Column) -> Column:
    """The file that a path is a part of: chunks as published, `<lang>_clean_<number>`, make up one `ml400` file."""
    return F.regexp_replace(path, r"_clean_\d+(?=\.[^/]*$)", "_ml400")


def _read(spark: SparkSession, kind: str, glob: str, seen: Observation | None) -> DataFrame:
    """All files of one kind, normalised, with `split`, `ord` and the `_path` of each row."""
    path = F.col("_path")
    lang, split = path_lang(path), infer_split(path_lang(path), path_stem(_whole(path)))
    keep = ("_path", "split", "ord")
    if kind == "web":
        files = spark.read.option("mergeSchema", True).parquet(glob).withColumns({
            "_path": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")
        })
        placed = with_positions(files.withColumns({"_lang": lang, "split": split}), ("_lang", "split"))
        return normalize_web(placed, "_lang", keep=keep)
    lines = read_lines(
        spark, glob, _whole(path), name="_file", only=file_kind(path) == kind, over=F.concat_ws("/", lang, split)
    )
    lines = lines.withColumnRenamed("_file", "_path").withColumns({"lang": lang, "split": split})
    if kind == "documents":
        return normalize_documents(parse_json_lines(lines, ["text"], seen=seen), keep=keep)
    if kind == "passages":
        return normalize_passages(lines, keep=keep)
    if kind.startswith("json_lines"):
        return normalize_json_lines(lines, keep=keep, seen=seen)
    return normalize_extra(lines, keep=keep, seen=seen)


def normalize_folder(
    spark: SparkSession, root: str, languages: Sequence[str] | None = None,
    seen: dict[str, Observation] | None = None,
) -> DataFrame:
    """(lang, split, ord, text, meta, dataset_origin) of the files `<root>/<lang>/<name>`.

    A file of an unknown kind is not read. All languages are read at once, a kind at a time.
    `seen` gets, for each kind of JSON lines, what the next job counts: `lines` and `skipped`.
    """
    listed = spark.read.format("binaryFile").load(f"{root}/*/*")
    kinds = {r[0] for r in listed.select(file_kind(F.col("path"))).distinct().limit(len(KINDS) + 1).collect()}
    counted = [k for k, *_ in KINDS if k in kinds and k not in ("web", "passages")] if seen is not None else []
    if seen is not None:
        seen.update({k: Observation(f"normalize {k}") for k in counted})
    parts = [
        # files of two kinds may belong to one split: the second kind follows the first
        _read(spark, kind, f"{root}/*/*{part}*{extension}", seen[kind] if kind in counted else None).withColumn("ord", F.col("ord") + (i << KIND_BITS))
        for i, (kind, extension, part) in enumerate(KINDS) if kind in kinds
    ]
    if not parts:
        raise FileNotFoundError(f"no source files of a known kind below {root}")
    rows = reduce(DataFrame.unionByName, parts).where(F.col("split").isNotNull())
    rows = rows.withColumn("dataset_origin", infer_origin(path_stem(F.col("_path")))).drop("_path")
    return select_langs(rows, languages)


def check_splits(
    spark: SparkSession, root: str, config: DataFrame, languages: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Files found per (lang, split), and the splits a mixture config expects but lacks."""
    found = file_inventory(spark, root, languages)
    return found, missing_splits(config, found)
