"""Sources for synthetic data, and their translation by a caller's model."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..operators.formats import fan_out_targets, translated_record
from ..operators.inference import Generator, generate
from ..operators.sampling import sample_math, sample_topics

# Topic numbers and names.
TOPICS = {
    2: "Software_Dev",
    4: "Education_Jobs",
    6: "Entertainment",
    10: "Food_Dining",
    12: "Health",
    13: "History",
    15: "Industrial",
    17: "Politics",
    19: "Science_Tech",
    23: "Travel",
}
WEB_SOURCE = "WebOrganizer/TopicAnnotations-Llama-3.1-8B"
MATH_SOURCE = "nvidia/OpenMathReasoning"


def web_sources(df: DataFrame, samples_per_domain: int = 2000, **options) -> DataFrame:
    """(text, source, domain): a sample of each topic."""
    drawn = sample_topics(df, TOPICS, samples_per_domain, **options)
    return drawn.select("text", F.lit(WEB_SOURCE).alias("source"), "domain")


def math_sources(df: DataFrame, samples: int = 2000, **options) -> DataFrame:
    """(text, source, domain): sampled problems with their solutions."""
    drawn = sample_math(df, samples, **options)
    return drawn.select("text", F.lit(MATH_SOURCE).alias("source"), F.lit("Math").alias("domain"))


def translate(
    df: DataFrame, targets: Sequence[str], load: Callable[[], Generator], stem: str,
    source_language: str = "eng_Latn", names: Mapping[str, str] | None = None,
    text: str = "text", batch_rows: int = 16,
) -> DataFrame:
    """(text, source_language, target_language, source, domain) for every row and target."""
    asked = fan_out_targets(df, targets, source_language, names, text)
    columns = [c for c in ("source", "domain") if c in df.columns]
    asked = asked.select(F.col(text).cast("string").alias("text"), "prompt", "source_language", "target_language", *columns)
    return translated_record(generate(asked, load, batch_rows=batch_rows), "translation", stem)
