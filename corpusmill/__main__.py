"""Command line: `python -m corpusmill <command> --help`."""

from __future__ import annotations

import argparse
import importlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame

from .functions.langs import read_language_names
from .plans import publish, runs
from .session import build_session
from .sources.corpus import read_mixture_config


def _load(spec: str) -> Callable:
    """`module:function`, a function of the caller that loads a model."""
    module, name = spec.split(":", 1)
    return getattr(importlib.import_module(module), name)


def _config(path: str | None) -> dict:
    if path is None:
        return {}
    with open(path, encoding="utf-8") as f:
        if path.endswith((".yaml", ".yml")):
            import yaml  # optional; JSON needs nothing

            return yaml.safe_load(f)
        return json.load(f)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="corpusmill")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, *paths: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        for p in paths:
            sub.add_argument(f"--{p}", required=True)
        return sub

    p = command("mixture", "config", "corpus", "output")
    p.add_argument("--fraction", default="1.0")
    p.add_argument("--subsets", nargs="+")
    p.add_argument("--precomputed", help="column with stored token counts")
    p.add_argument("--shuffle_seed", type=int)
    p = command("normalize", "input", "output")
    p.add_argument("--languages", nargs="+")
    p = command("check-splits", "input")
    p.add_argument("--mixture_config", nargs="+", required=True)
    command("align", "input", "output")
    p = command("split", "input", "output")
    p.add_argument("--target_gb", type=float, default=5.0)
    p = command("score", "input", "output", "model")
    p.add_argument("--batch_size", type=int, default=256)
    command("merge", "shards", "manifest", "output")
    p = command("bitext", "bitext", "scores", "output")
    p.add_argument("--config", help="JSON or YAML: steps, task, templates, languages")
    p.add_argument("--names", help="CSV with the columns code and name, for further languages")
    p.add_argument("--compat_labels", action="store_true", help="labels of swapped rows follow the pair, not the text")
    p = command("recipe", "input", "output")
    p.add_argument("kind", choices=["math", "code"])
    p.add_argument("--max_tokens", type=int)
    p.add_argument("--max_samples", type=int)
    p.add_argument("--part_size", type=int, default=500_000)
    p.add_argument("--seed", type=int, default=42)
    p = command("web-sample", "input", "output")
    p.add_argument("--max_tokens", type=int, default=1_000_000_000)
    p.add_argument("--part_size", type=int, default=100_000)
    p = command("texts", "input", "output")
    p.add_argument("kind", choices=["documents", "rows"])
    p = command("extended", "corpus", "output")
    p.add_argument("--languages", nargs="+")
    p.add_argument("--sample_times", type=int, default=5)
    p.add_argument("--seed", type=int, default=2025, help="-1 keeps the source order")
    p = command("sources", "input", "output")
    p.add_argument("kind", choices=["web", "math"])
    p.add_argument("--samples", type=int, default=2000)
    p = command("translate", "input", "output", "model")
    p.add_argument("--targets", nargs="+", required=True)
    p.add_argument("--source_language", default="eng_Latn")
    p.add_argument("--text_column", default="text")
    p.add_argument("--names", help="CSV with the columns code and name, for further languages")
    p.add_argument("--max_samples", type=int)
    return parser


def _print(df: DataFrame) -> None:
    """All rows, tab-separated, a partition at a time."""
    print(*df.columns, sep="\t")
    for row in df.toLocalIterator():
        print(*row, sep="\t")


def main(argv: list[str] | None = None) -> None:
    a = _parser().parse_args(argv)
    spark = build_session()

    def names(path: str | None) -> dict[str, str] | None:
        return read_language_names(spark, path) if path else None

    if a.command == "mixture":
        print(runs.mixture_run(spark, a.config, a.corpus, a.output, a.fraction, a.subsets, a.precomputed, a.shuffle_seed))
    elif a.command == "normalize":
        runs.normalize_run(spark, a.input, a.output, a.languages)
    elif a.command == "check-splits":
        for path in a.mixture_config:
            found, missing = publish.check_splits(spark, a.input, read_mixture_config(spark, path))
            _print(found.orderBy("lang", "split"))
            print("missing:")
            _print(missing.orderBy("lang", "split"))
    elif a.command == "align":
        runs.align_run(spark, a.input, a.output)
    elif a.command == "split":
        runs.split_run(spark, a.input, a.output, a.target_gb)
    elif a.command == "score":
        runs.score_run(spark, a.input, a.output, _load(a.model), a.batch_size)
    elif a.command == "merge":
        runs.merge_run(spark, a.shards, a.manifest, a.output)
    elif a.command == "bitext":
        stats = runs.bitext_run(
            spark, a.bitext, a.scores, a.output, _config(a.config), names(a.names), compat_labels=a.compat_labels
        )
        _print(stats.orderBy("pair", "step_no"))
    elif a.command == "recipe":
        runs.recipe_run(spark, a.kind, a.input, a.output, a.max_tokens, a.max_samples, a.part_size, a.seed)
    elif a.command == "web-sample":
        runs.web_run(spark, a.input, a.output, a.max_tokens, a.part_size)
    elif a.command == "texts":
        runs.texts_run(spark, a.kind, a.input, a.output)
    elif a.command == "extended":
        seed = None if a.seed < 0 else a.seed
        runs.extended_run(spark, a.corpus, a.output, a.languages, a.sample_times, seed)
    elif a.command == "sources":
        runs.sources_run(spark, a.kind, a.input, a.output, a.samples)
    elif a.command == "translate":
        runs.translate_run(
            spark, a.input, a.output, a.targets, _load(a.model), a.source_language, a.max_samples,
            a.text_column, names(a.names),
        )


if __name__ == "__main__":
    main()
