"""Output records: pre-training text, chat records, translation prompts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import rand
from ..functions.langs import bitext_name, long_code, translation_name
from ..functions.text import fill_one_of, is_nonblank, or_empty
from .layout import pair_sides

# The wording of prompts.
TASK_TEMPLATES = ["Translate the {source} content to {target}."]
TRANSLATOR = (
    "You are a professional translator. Preserve meaning, formatting, numbers, "
    "math notation, code blocks, and named entities. Return only the translation."
)


def _columns(
    df: DataFrame, src: str, tgt: str, names: Mapping[str, str] | None, compat_labels: bool
) -> dict[str, Column]:
    """What a row says on each side, with codes and names that belong to it.

    Where the text was exchanged the labels are too. `compat_labels` gives the labels of
    the exchanged direction to the text in its first direction instead.
    """
    first, second = (long_code(c) for c in pair_sides("pair"))
    swapped = F.col("swapped") if "swapped" in df.columns else F.lit(False)

    def side(a: Column, b: Column) -> tuple[Column, Column]:
        return F.when(swapped, b).otherwise(a), F.when(swapped, a).otherwise(b)

    source_code, target_code = side(first, second)
    source, target = side(bitext_name(first, names), bitext_name(second, names))
    text = F.col(src), F.col(tgt)
    source_text, target_text = side(*text) if compat_labels else text
    return {
        "source": source, "target": target,
        "source_code": source_code, "target_code": target_code,
        "source_content": source_text, "target_content": target_text,
    }


def _filled(
    df: DataFrame, src: str, tgt: str, templates: Sequence[str], seed: int, key: Sequence[str],
    names: Mapping[str, str] | None, compat_labels: bool,
) -> DataFrame:
    rows = df.where(is_nonblank(src) & is_nonblank(tgt))
    return rows.select(
        "*",
        F.struct(*[
            c.alias(n) for n, c in _columns(rows, src, tgt, names, compat_labels).items()
        ]).alias("_f"),
    ).withColumn(
        "_filled",
        fill_one_of(
            list(templates),
            rand.choice(seed, len(templates), F.lit("template"), *key),
            {n: F.col(f"_f.{n}") for n in (
                "source", "target", "source_code", "target_code", "source_content", "target_content")},
        ),
    )


def format_pt(
    df: DataFrame, templates: Sequence[str] = TASK_TEMPLATES, seed: int = 42,
    key: Sequence[str] = ("pair", "row_id"), src: str = "sentence1", tgt: str = "sentence2",
    names: Mapping[str, str] | None = None, compat_labels: bool = False,
) -> DataFrame:
    """Pre-training records: `text` is a filled template. Rows with a blank side are dropped."""
    filled = _filled(df, src, tgt, templates, seed, key, names, compat_labels)
    return filled.withColumn("text", F.col("_filled")).drop("_filled", "_f")


def format_sft(
    df: DataFrame, templates: Sequence[str] = TASK_TEMPLATES, seed: int = 42,
    key: Sequence[str] = ("pair", "row_id"), src: str = "sentence1", tgt: str = "sentence2",
    names: Mapping[str, str] | None = None, compat_labels: bool = False,
) -> DataFrame:
    """Chat records: a filled template as `system`, then both sides as `conversations`."""
    def turn(who: str, value: str) -> Column:
        return F.struct(F.lit(who).alias("from"), F.col(value).alias("value"))

    filled = _filled(df, src, tgt, templates, seed, key, names, compat_labels)
    turns = F.array(turn("human", "_f.source_content"), turn("gpt", "_f.target_content"))
    return filled.withColumns({"conversations": turns, "system": F.col("_filled")}).drop("_filled", "_f")


def translation_prompt(text: str | Column, source: Column, target: Column) -> Column:
    """The plain form of a translation prompt."""
    body = F.col(text) if isinstance(text, str) else text
    return F.concat(
        F.lit(TRANSLATOR + "\n\nTranslate this "), source, F.lit(" text into "), target,
        F.lit(":\n\n"), or_empty(body), F.lit("\n\nTranslation:"),
    )


def fan_out_targets(
    df: DataFrame, targets: Sequence[str], source_language: str = "eng_Latn",
    names: Mapping[str, str] | None = None, text: str = "text",
) -> DataFrame:
    """Each row once per target language, with its `prompt`; null where the target is the source."""
    out = df.withColumn("source_language", F.lit(source_language)).withColumn(
        "target_language", F.explode(F.array(*[F.lit(t) for t in targets]))
    )
    same = F.col("target_language") == F.col("source_language")
    prompt = translation_prompt(
        text,
        translation_name(F.lit(source_language), names),
        translation_name(F.col("target_language"), names),
    )
    return out.withColumn("prompt", F.when(~same, prompt))


def translated_record(df: DataFrame, translation: str, stem: str) -> DataFrame:
    """The output columns; `source` falls back to the file stem, `domain` may be null."""
    has = lambda c: F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")
    return df.select(
        F.col(translation).alias("text"), "source_language", "target_language",
        F.coalesce(has("source"), F.lit(stem)).alias("source"), has("domain").alias("domain"),
    )
