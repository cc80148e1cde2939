"""A caller's model as a table operator.

The model itself is not part of this package: the caller passes a function that loads it.
A Python worker calls it once and keeps the model for all tasks that it runs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .layout import score_direction

Scorer = Callable[[list[str], list[str]], list[float]]
Generator = Callable[[list[str]], list[str]]

# The model of this Python worker, by its loader; one at a time.
_MODELS: dict[bytes, Callable] = {}


def _with_model(
    df: DataFrame, schema: StructType, load: Callable[[], Callable],
    apply: Callable[[Callable, pd.DataFrame], pd.DataFrame],
) -> DataFrame:
    """`apply(model, rows)` on each Arrow batch; a worker loads the model with its first one."""
    key = cloudpickle.dumps(load)  # one loader with other settings is another model

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if key not in _MODELS:
                _MODELS.clear()
                _MODELS[key] = load()
            yield apply(_MODELS[key], frame)

    return df.mapInPandas(run, schema)


def _ask(model: Callable, batch_rows: int, *columns: pd.Series) -> list:
    """The model's answers, asked for in batches of `batch_rows`."""
    lists = [c.tolist() for c in columns]
    answers: list = []
    for at in range(0, len(lists[0]), batch_rows):
        answers.extend(model(*[v[at : at + batch_rows] for v in lists]))
    return answers


def score_pairs(
    df: DataFrame, load: Callable[[], Scorer], batch_rows: int = 256,
    keys: tuple[str, ...] = ("pair", "row_id"), src: str = "sentence1", mt: str = "sentence2",
    score: str = "comet_score", length_batching: bool = True,
) -> DataFrame:
    """Keys and the score of each row. Sides are exchanged where scoring runs the other way.

    Keys travel with the rows, so scores are joined back by key and never by position. That
    also lets rows of like length share a batch, which saves the model padding.
    """
    directed = score_direction(df, src, mt).select(*keys, "src", "mt").fillna("", ["src", "mt"])
    if length_batching:
        directed = directed.sortWithinPartitions(F.length("src") + F.length("mt"))
    fields = [f for f in directed.schema.fields if f.name in keys]
    schema = StructType([*fields, StructField(score, DoubleType())])

    def apply(model: Scorer, frame: pd.DataFrame) -> pd.DataFrame:
        answers = _ask(model, batch_rows, frame["src"], frame["mt"])
        return frame[list(keys)].assign(**{score: [float(a) for a in answers]})

    return _with_model(directed, schema, load, apply)


def generate(
    df: DataFrame, load: Callable[[], Generator], prompt: str = "prompt", text: str = "text",
    out: str = "translation", batch_rows: int = 16,
) -> DataFrame:
    """Adds the model's answer to `prompt`, stripped; rows without a prompt keep their text."""
    schema = StructType([*df.schema.fields, StructField(out, StringType())])

    def apply(model: Generator, frame: pd.DataFrame) -> pd.DataFrame:
        answer = frame[text].copy()
        asked = frame[prompt].notna()
        answer[asked] = [a.strip() for a in _ask(model, batch_rows, frame.loc[asked, prompt])]
        return frame.assign(**{out: answer})

    return _with_model(df, schema, load, apply)
