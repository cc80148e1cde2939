"""Token-budget mixture of languages."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from ..functions.text import count_tokens
from ..operators.budget import (
    HEAD_MARGIN, RATIO_CHARS, mix_to_budget, token_char_ratio, token_estimate,
)
from ..operators.lookup import attach, small_table
from ..operators.prefix import Order, hash_order, source_order
from ..session import materialize

MAX_EXTENTS = 2_000
HEAD_ROWS = 1 << 14
MAX_COUNTED = 500

# Per language: its splits in order, each with its number of rows, first and last position.
Extents = dict[str, list[tuple[str, int, int, int]]]


def build_mixture(
    corpus: DataFrame,
    config: DataFrame,
    precomputed: str | None = None,
    tokens=count_tokens,
    shuffle_seed: int | None = None,
    blocks: DataFrame | None = None,
) -> DataFrame:
    """Rows of the mixture: (lang, split, split_pos, ord, text, n_tokens, epoch).

    `corpus` has (lang, split, ord, text), with `ord` the place in the split; `config` is a
    parsed mixture config. Each language is read in the order of its splits, or shuffled
    if a seed is given, and repeated until its target is met. Languages without any tokens
    are skipped.

    A budget often needs the first part of a large language only. Where that can be told
    from the number of rows, later files are neither counted nor read. With `blocks`, the sizes
    of blocks stored with the corpus (`read_block_sizes`), no scan of all positions is needed
    for that, and the characters of the blocks tell how far a budget reaches.
    """
    config, small = small_table(config)
    places = config.select("lang", "split", "split_pos")
    rows = attach(corpus.drop("split_pos"), places, ["lang", "split"], small, spread=["ord"])
    targets, _ = small_table(config.groupBy("lang").agg(F.max("target").alias("target")))
    if blocks is None:
        extents = _extents(rows)
    else:
        blocks = materialize(attach(blocks, places, ["lang", "split"], small, spread=["block"]))
        extents = _block_extents(blocks)

    source = source_order("ord", "split_pos")
    ratio, few = _ratios(rows, source, extents, tokens)
    rated = attach(rows, ratio.select("lang", "ratio"), ["lang"], few, spread=["ord"])
    known: Column | None = F.col(precomputed) if precomputed else None
    weight = token_estimate("text", F.col("ratio"), known, tokens)

    if shuffle_seed is None:
        needed = _rows_needed(ratio, targets, extents) if blocks is None else _blocks_needed(blocks, ratio, targets, extents)
        head, headed = _heads(extents, needed)
        return mix_to_budget(rated, targets, weight, "lang", source, head=head, headed=headed).drop("ratio")
    order = hash_order(shuffle_seed, "split_pos", "ord")
    return mix_to_budget(rated, targets, weight, "lang", order).drop("ratio")


def _extents(rows: DataFrame) -> Extents:
    """Reads positions only, no text. Empty if there are too many splits to list."""
    sizes = rows.groupBy("lang", "split", "split_pos").agg(
        F.count("*").alias("n"), F.min("ord").alias("first"), F.max("ord").alias("last")
    )
    return _listed(sizes)


def _block_extents(blocks: DataFrame) -> Extents:
    """The same from the sizes of blocks."""
    return _listed(blocks.groupBy("lang", "split", "split_pos").agg(
        F.sum("n_rows").alias("n"), F.min("first").alias("first"), F.max("last").alias("last")
    ))


def _listed(sizes: DataFrame) -> Extents:
    listed = sizes.limit(MAX_EXTENTS + 1).collect()
    if len(listed) > MAX_EXTENTS:
        return {}
    out: Extents = {}
    for r in sorted(listed, key=lambda r: r.split_pos):
        out.setdefault(r.lang, []).append((r.split, r.n, r.first, r.last))
    return out


def _heads(extents: Extents, rows: dict[str, int]) -> tuple[Column, list[str]]:
    """A filter for the first rows of large languages, and which languages are large.

    A language is large if it has more rows than asked for; all others pass the filter. It
    is made of constants on stored columns: the names let a scan skip folders, the last
    position of all that pass lets it skip row groups.
    """
    large, parts, ends = [], [], []
    for lang, splits in extents.items():
        left = rows.get(lang, 0)
        repeated = len({s[0] for s in splits}) < len(splits)  # no prefix by name then
        if repeated or left >= sum(n for _, n, _, _ in splits):
            ends += [last for _, _, _, last in splits]
            continue
        large.append(lang)
        for split, n, first, last in splits:
            if left <= 0:
                break
            end = last if left >= n else first + left - 1
            parts.append(f"(lang = {_literal(lang)} AND split = {_literal(split)} AND ord <= {end})")
            ends.append(end)
            left -= n
    if not large:
        return F.lit(True), []
    others = f"lang NOT IN ({', '.join(map(_literal, large))})"
    return F.expr(f"({' OR '.join([others, *parts])}) AND ord <= {max(ends, default=-1)}"), large


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ratios(
    rows: DataFrame, source: Order, extents: Extents, tokens
) -> tuple[DataFrame, bool]:
    """Ratios above 0. A sample that is full after the first rows needs no others."""
    positive = F.col("ratio") > 0
    if not extents:
        return small_table(token_char_ratio(rows, "lang", source, tokens=tokens).where(positive))
    head, large = _heads(extents, dict.fromkeys(extents, HEAD_ROWS))
    start = token_char_ratio(rows.where(head), "lang", source, tokens=tokens)
    quick, fits = small_table(start.where(positive))
    full = {r.lang for r in quick.where(F.col("chars") >= RATIO_CHARS).collect()}  # of listed languages
    short = [lang for lang in large if lang not in full]
    if not short:
        return quick, fits
    rest = token_char_ratio(rows.where(F.col("lang").isin(short)), "lang", source, tokens=tokens)
    return small_table(quick.where(~F.col("lang").isin(short)).unionByName(rest.where(positive)))


def _rows_needed(ratio: DataFrame, targets: DataFrame, extents: Extents) -> dict[str, int]:
    """How many rows of each listed language should meet its target, going by the sample."""
    if not extents:
        return {}
    sampled = ratio.join(targets, "lang").where("tokens > 0").collect()
    return {
        r.lang: int(r.target * HEAD_MARGIN * r.n_rows / r.tokens) + HEAD_ROWS for r in sampled
    }


def _blocks_needed(blocks: DataFrame, ratio: DataFrame, targets: DataFrame, extents: Extents) -> dict[str, int]:
    """How many rows of each listed language lie in the blocks that should meet its target."""
    if not extents:
        return {}
    earlier = Window.partitionBy("lang").orderBy("split_pos", "block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.withColumn("_before", F.coalesce(F.sum("chars").over(earlier), F.lit(0)))
    rated = before.join(ratio.select("lang", "ratio"), "lang").join(targets, "lang")
    within = F.col("_before") * F.col("ratio") < F.col("target") * F.lit(HEAD_MARGIN)
    rows = rated.where(within).groupBy("lang").agg(F.sum("n_rows").alias("n")).collect()
    return {r.lang: r.n for r in rows}


def counted_totals(mixture: DataFrame, langs: Sequence[str]) -> tuple[DataFrame, Callable[[], list[tuple[str | None, int, int]]]]:
    """`mixture`, and a function that tells (lang, rows, tokens) and the totals (None) once a job has written it.

    The job that writes counts as it goes, so nothing is read again. Languages come from a
    config; above MAX_COUNTED of them only the totals are counted.
    """
    seen = Observation()
    named = list(langs) if len(langs) <= MAX_COUNTED else []
    tokens = F.coalesce("n_tokens", F.lit(0))
    sums = [F.count("*").alias("rows"), F.sum(tokens).alias("tokens")]
    for i, lang in enumerate(named):
        own = F.col("lang") == lang
        sums += [F.count_if(own).alias(f"rows{i}"), F.sum(F.when(own, tokens)).alias(f"tokens{i}")]

    def totals() -> list[tuple[str | None, int, int]]:
        got = seen.get
        rows = [(lang, got[f"rows{i}"], got[f"tokens{i}"] or 0) for i, lang in enumerate(named)]
        return [r for r in rows if r[1]] + [(None, got["rows"], got["tokens"] or 0)]

    return mixture.observe(seen, *sums), totals


def mixture_totals(mixture: DataFrame) -> DataFrame:
    """Rows and tokens per language, and over all languages (lang is null)."""
    return mixture.rollup("lang").agg(
        F.count("*").alias("n_rows"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n_tokens")
    )
