"""Math and code samples within a token budget."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import count_tokens, is_nonblank, join_code, strip
from ..operators.budget import take_token_budget
from ..operators.prefix import source_order


def math_sample(
    df: DataFrame, max_tokens: int | None = None, max_samples: int | None = None, seed: int = 42,
    key: tuple[str, ...] = ("ord",), tokens=count_tokens,
) -> DataFrame:
    """Shuffled math texts; a stored token_count is used where it is not 0."""
    stored = F.nullif("token_count", F.lit(0)) if "token_count" in df.columns else F.lit(None)
    weight = F.coalesce(stored.cast("bigint"), tokens("text"))
    return take_token_budget(df, weight, max_tokens, max_samples, key=key, seed=seed)


def code_sample(
    df: DataFrame, max_tokens: int | None = None, max_samples: int | None = None, seed: int = 42,
    key: tuple[str, ...] = ("ord",), tokens=count_tokens,
) -> DataFrame:
    """Shuffled code samples built from a query and a document."""
    built = df.withColumn("text", join_code("query", "document"))
    return take_token_budget(built, tokens("text"), max_tokens, max_samples, key=key, seed=seed)


def web_sample(
    df: DataFrame, max_tokens: int, ord_col: str = "ord", tokens=count_tokens
) -> DataFrame:
    """The first web texts of the source, stripped, up to a token budget."""
    texts = df.where(is_nonblank("text")).withColumn("text", strip("text"))
    return take_token_budget(texts, tokens("text"), max_tokens, order=source_order(ord_col))
