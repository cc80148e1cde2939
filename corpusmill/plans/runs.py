"""Whole runs: read, prepare, write. One function per command of the command line."""

from __future__ import annotations

import os
import time
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..operators.filters import allow_pairs
from ..operators.formats import TASK_TEMPLATES
from ..operators.inference import Generator, Scorer, score_pairs
from ..operators.joins import missing_scores
from ..operators.prefix import hash_order
from ..operators.shards import assign_shards, row_bytes
from ..sinks import writers
from ..sources import bitext as bitext_source, corpus as corpus_source, normalize
from . import extended, publish, recipes, synthetic
from .bitext import DEFAULT_STEPS, run_bitext, skip_finished
from .mixture import MAX_COUNTED, build_mixture, counted_totals


FILE_KEY = ("_file", "ord")


def mixture_run(
    spark: SparkSession, config_path: str, root: str, output: str, fraction: str = "1.0",
    subsets: Sequence[str] | None = None, precomputed: str | None = None, shuffle_seed: int | None = None,
) -> str:
    """Writes a mixture by language and tells its rows and tokens; gives the folder, named after config and fraction."""
    config = corpus_source.read_mixture_config(spark, config_path, fraction, subsets)
    name = os.path.splitext(os.path.basename(config_path))[0]
    if corpus_source.parse_fraction(fraction) != 1.0:
        name += "_f" + str(fraction).replace("/", "-")
    corpus = corpus_source.scan_corpus(spark, root, config)
    path = f"{output.rstrip('/')}/{name}"
    langs = [r.lang for r in config.select("lang").distinct().orderBy("lang").limit(MAX_COUNTED + 1).collect()]
    blocks = corpus_source.read_block_sizes(spark, root, config)
    mixture = build_mixture(corpus, config, precomputed, shuffle_seed=shuffle_seed, blocks=blocks)
    mixture, totals = counted_totals(mixture, langs)
    writers.write_jsonl(mixture, path)
    for lang, n_rows, n_tokens in totals():
        print(f"{lang or 'total'}: {n_rows} rows, {n_tokens} tokens")
    return path


def normalize_run(
    spark: SparkSession, source: str, root: str, languages: Sequence[str] | None = None
) -> None:
    """Raw source folders to a corpus by language and split; tells which lines were no JSON objects."""
    seen: dict[str, Observation] = {}
    writers.write_corpus(publish.normalize_folder(spark, source, languages, seen), root)
    corpus_source.store_block_sizes(spark, root)
    for kind, counts in seen.items():
        got = counts.get
        if got.get("skipped"):
            print(f"{kind}: skipped {got['skipped']} of {got['lines']} lines")


def align_run(spark: SparkSession, source: str, output: str) -> None:
    """Line-aligned files to bitext by pair; pairs that are there already are left alone. Tells which cannot be aligned."""

    def report(rejected: DataFrame) -> None:
        for r in rejected.orderBy("pair").toLocalIterator():
            print(f"left out {r.pair}: {r.n_src} and {r.n_tgt} lines, {r.n_scores} scores, {r.n_numbers} of them numbers")

    writers.write_pairs(bitext_source.read_moses(spark, source, report), output)


def split_run(spark: SparkSession, source: str, output: str, target_gb: float = 5.0) -> None:
    """Bitext files in shards of a byte budget, with their manifest."""
    rows = _read_pairs(spark, source, bitext_source.read_bitext).withColumnRenamed("pair", "source")
    size = row_bytes(["sentence1", "sentence2"])
    writers.write_shards(*assign_shards(rows, int(target_gb * writers.GIB), size), output)


def score_run(
    spark: SparkSession, source: str, output: str, load: Callable[[], Scorer], batch_rows: int = 256,
    unit_rows: int = writers.UNIT_ROWS, job_rows: int = writers.JOB_ROWS,
) -> None:
    """Scores of bitext by pair, from a caller's model; what was scored before is left alone.

    `source` is what `align` or `split` wrote, or single files by pair. Rows of shards keep
    the number of their shard. Ranges of rows are finished one after the other, so a run that
    was killed goes on where it stopped.
    """
    rows = _read_pairs(spark, source, bitext_source.read_bitext)
    keys = ("pair", "row_id", "shard") if "shard" in rows.columns else ("pair", "row_id")
    writers.write_units(rows, lambda part: score_pairs(part, load, batch_rows, keys), output, unit_rows=unit_rows, job_rows=job_rows)


def merge_run(spark: SparkSession, shards: str, manifest: str, output: str) -> None:
    """Scores of shards as one table per pair, numbered like the bitext.

    `shards` is what `score` wrote for shards, or files `<pair>/<pair><number>.parquet`.
    """
    parts = spark.read.json(manifest).select(F.col("source").alias("pair"), "index", "num_rows")
    scored = spark.read.option("recursiveFileLookup", False).parquet(shards) if _is_table(spark, shards) else None
    if scored is not None and {"pair", "row_id", "shard"} <= set(scored.columns):
        scored = scored.drop("unit").withColumnRenamed("shard", "index")
        merged = bitext_source.complete_shards(scored, parts).drop("index")
    else:
        merged = bitext_source.merge_scored_shards(bitext_source.read_scored_shards(spark, shards), parts)
    writers.write_pairs(merged, output)


def _is_table(spark: SparkSession, root: str) -> bool:
    """Whether parts by pair lie there, as `write_pairs` writes them."""
    return not writers.finished_keys(spark, root, "pair").isEmpty()


def _read_pairs(spark: SparkSession, root: str, read: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """Tables by pair written here carry their keys; single files get them from their place."""
    df = spark.read.parquet(root)
    if {"source", "shard", "row_id"} <= set(df.columns):  # shards
        df = df.withColumnRenamed("source", "pair")
    return df.drop("unit") if {"pair", "row_id"} <= set(df.columns) else read(spark, root)


def bitext_run(
    spark: SparkSession, bitext: str, scores: str, output: str, config: Mapping[str, Any] | None = None,
    names: Mapping[str, str] | None = None, seed: int = 42, compat_labels: bool = False,
) -> DataFrame:
    """Filters, samples and formats bitext; gives the step counts it has added to `<output>_stats`.

    Pairs whose outputs agree with the counts of their latest run are left alone.
    """
    config = config or {}
    texts = allow_pairs(_read_pairs(spark, bitext, bitext_source.read_bitext), config.get("languages", []))
    found = allow_pairs(_read_pairs(spark, scores, bitext_source.read_scores), config.get("languages", []))
    for row in missing_scores(texts, found).toLocalIterator():
        print(f"no scores for {row.pair}")
    if not texts.isEmpty() and texts.select("pair").join(found.select("pair").distinct(), "pair", "left_semi").isEmpty():
        raise ValueError("no pair of the bitext has scores")
    task = config.get("task", "sft")
    stats_path = output.rstrip("/") + "_stats"
    try:
        before = spark.read.text(output), spark.read.parquet(stats_path)
    except AnalysisException:  # the first run
        before = None
    if before:
        texts = skip_finished(texts, *before)
    steps = config.get("pipeline", {}).get("single", DEFAULT_STEPS)
    templates = config.get("task-templates", TASK_TEMPLATES)
    rows, stats = run_bitext(texts, found, steps, task, templates, seed, names, compat_labels)
    columns = ["text"] if task == "pt" else ["conversations", "system"]
    writers.write_jsonl(rows, output, "pair", columns, max_rows=2_000_000)
    final = stats.where("step = 'final'").select(
        "pair", F.lit(time.time_ns()).alias("run"), F.col("n_rows").alias("final_samples")
    )
    writers.append_stats(final, stats_path)
    return stats


def recipe_run(
    spark: SparkSession, recipe: str, source: str, output: str, max_tokens: int | None = None,
    max_samples: int | None = None, part_size: int = 500_000, seed: int = 42,
) -> None:
    """A math or code sample in numbered parts, in its shuffled order."""
    if recipe == "code":
        df, make = corpus_source.read_code_shards(spark, source), recipes.code_sample
    else:
        df, make = _with_file_and_row(spark.read.parquet(source), source), recipes.math_sample
    rows = make(df, max_tokens, max_samples, seed, FILE_KEY)
    writers.write_parts(rows, output, part_size, hash_order(seed, *FILE_KEY))


def web_run(spark: SparkSession, source: str, output: str, max_tokens: int = 1_000_000_000, part_size: int = 100_000) -> None:
    """The first web texts of the Parquet files, by name, up to a token budget, as numbered Parquet parts."""
    rows = spark.read.parquet(source).withColumns({"_path": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})
    placed = corpus_source.with_positions(rows, by=())
    writers.write_parts(recipes.web_sample(placed, max_tokens), output, part_size, fmt="parquet")


def texts_run(spark: SparkSession, kind: str, source: str, output: str) -> None:
    """JSON lines with a `text`: documents from headline and content, or rows of whatever columns.

    The other columns of documents are kept as `hyperparam`.
    """
    rows = spark.read.parquet(source) if source.endswith(".parquet") else spark.read.json(source)
    made = normalize.build_documents(rows).withColumnRenamed("rest", "hyperparam") if kind == "documents" else normalize.text_fallback(rows)
    writers.write_capped(made, output)


def _with_file_and_row(df: DataFrame, root: str) -> DataFrame:
    file = corpus_source.relative_path(F.col("_metadata.file_path"), root)
    return df.withColumns({"_file": file, "ord": F.col("_metadata.row_index")})


def extended_run(
    spark: SparkSession, root: str, output: str, languages: Sequence[str] | None = None,
    times: int = 5, seed: int | None = 2025,
) -> None:
    """Further languages, several times over, by language and in the order of their epochs."""
    rows = extended.repeated_languages(corpus_source.read_corpus(spark, root), languages, times, seed)
    writers.write_jsonl(rows, output, order=["epoch", "split_pos", "order_key", "ord"])


def sources_run(spark: SparkSession, kind: str, source: str, output: str, samples: int = 2000) -> None:
    """Sampled sources for synthetic data, by topic."""
    df = _with_file_and_row(spark.read.parquet(source), source)
    make = synthetic.web_sources if kind == "web" else synthetic.math_sources
    writers.write_jsonl(make(df, samples, key=FILE_KEY), output, "domain", ["text", "source"])


def translate_run(
    spark: SparkSession, source: str, output: str, targets: Sequence[str], load: Callable[[], Generator],
    source_language: str = "eng_Latn", max_samples: int | None = None, text_column: str = "text",
    names: Mapping[str, str] | None = None,
) -> None:
    """Rows of a file in other languages, below a folder of its name and by target.

    Targets that this file has already are left alone.
    """
    rows = corpus_source.read_rows(spark, source, text_column=text_column, max_samples=max_samples)
    stem = os.path.splitext(os.path.basename(source))[0]
    output = f"{output.rstrip('/')}/{stem}"
    finished = writers.finished_keys(spark, output, "target_language").where(F.col("target_language").isin(list(targets)))
    done = {r[0] for r in finished.collect()}  # no more than the targets asked for
    todo = [t for t in targets if t not in done]
    if not todo:
        return
    out = synthetic.translate(rows, todo, load, stem, source_language, names, text_column)
    writers.write_jsonl(out, output, "target_language", ["text", "source_language", "source", "domain"])
