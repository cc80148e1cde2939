"""The bitext pipeline: configurable steps, step counts, formatted records."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import rand
from ..functions.text import is_nonblank
from ..operators.checks import count_steps, validate_outputs
from ..operators.formats import TASK_TEMPLATES, format_pt, format_sft
from ..operators.joins import join_scores, only_rows, pending_work
from ..operators.sampling import bounded_sample
from ..operators.scores import flag_score
from ..session import materialize

# The default pipeline. The score threshold is a percentile (the top 7 %).
DEFAULT_STEPS = [
    {"name": "FilterbyLength", "kargs": {"min_char": 20, "max_char": 10000}},
    {"name": "FilterbyScore", "kargs": {"threshold": 0.93}},
    {"name": "SwapBitext", "kargs": {"prob": 0.5, "seed": 2026}},
    {"name": "Sampling", "kargs": {
        "strategy": "uniform", "max_num_samples": 200000, "seed": 2026, "min_num_samples": 10000}},
]


@dataclass
class _State:
    """Decisions per row, without its text.

    `keep` is the column that says whether a row is still in. Dropped rows stay until
    their step has been counted.
    """

    rows: DataFrame
    keep: Column = field(default_factory=lambda: F.lit(True))
    number: int = 0
    uncounted: list[tuple[int, str, Column]] = field(default_factory=list)
    counts: list[DataFrame] = field(default_factory=list)
    n_swaps: int = 0
    of_text: list[Column] = field(default_factory=list)

    def done(self, name: str) -> None:
        self.uncounted.append((self.number, name, self.keep))
        self.number += 1

    def narrow_to(self, passed: Column) -> None:
        flag = f"keep_{self.number}"
        self.rows = self.rows.withColumn(flag, self.keep & passed)
        self.keep = F.col(flag)

    def count(self) -> None:
        """Counts the finished steps, all in one pass."""
        if self.counts:
            # pairs of which nothing is left are counted as 0
            steps = F.array(*[
                F.struct(F.lit(no).alias("step_no"), F.lit(name).alias("step"), F.lit(0).cast("bigint").alias("n_rows"))
                for no, name, _ in self.uncounted
            ])
            pairs = self.counts[0].where("step_no = 0").select("pair")
            self.counts.append(pairs.select("pair", F.inline(steps)))
        self.counts.append(count_steps(self.rows, self.uncounted))
        self.uncounted = []


def _by_length(state: _State, min_char: int = 0, max_char: int = 10**9) -> None:
    inside = F.col("len1").between(min_char, max_char) & F.col("len2").between(min_char, max_char)
    state.of_text += [F.length(c).between(min_char, max_char) for c in ("sentence1", "sentence2")]
    state.narrow_to(F.coalesce(inside, F.lit(False)))
    state.done("FilterbyLength")


def _by_score(state: _State, strategy: str = "percentile", threshold: float = 0.7) -> None:
    state.rows = flag_score(state.rows, "comet_score", "_pass", strategy, threshold, among=state.keep)
    state.narrow_to(F.col("_pass"))
    state.rows = state.rows.drop("_pass")
    state.done("FilterbyScore")


def _swap(state: _State, prob: float = 1.0, seed: int = 42) -> None:
    # Drawn here, so that later copies of a row share it; two swaps of a row undo each other.
    purpose = F.lit(f"swap{state.n_swaps}")
    hit = rand.uniform(seed, purpose, "pair", "row_id", "copy") < F.lit(prob)
    state.rows = state.rows.withColumn("swapped", F.col("swapped") != hit)
    state.n_swaps += 1
    state.done("SwapBitext")


def _sample(
    state: _State, strategy: str = "uniform", max_num_samples: int = 100000, seed: int = 42,
    min_num_samples: int = 0,
) -> None:
    state.count()
    rows = state.rows.where(state.keep).select(
        "pair", "row_id", F.col("copy").alias("_earlier"), "len1", "len2", "blank", "comet_score", "swapped"
    )
    sampled = bounded_sample(
        rows, "pair", max_num_samples, min_num_samples, seed, ["row_id", "_earlier"], strategy
    )
    # a second sampling step may repeat rows that were repeated before
    copy = F.concat_ws(".", F.nullif(F.col("_earlier"), F.lit("0")), F.col("copy").cast("string"))
    state.rows = sampled.withColumn("copy", copy).drop("_earlier")
    state.keep = F.lit(True)
    state.done("Sampling")


STEPS: dict[str, Callable[..., None]] = {
    "FilterbyLength": _by_length,
    "FilterbyScore": _by_score,
    "SwapBitext": _swap,
    "Sampling": _sample,
}


def run_bitext(
    bitext: DataFrame,
    scores: DataFrame,
    steps: Sequence[Mapping[str, Any]] = DEFAULT_STEPS,
    task: str = "sft",
    templates: Sequence[str] = TASK_TEMPLATES,
    seed: int = 42,
    names: Mapping[str, str] | None = None,
    compat_labels: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Formatted rows of all pairs, and the counts (pair, step_no, step, n_rows).

    One wide scan turns each row into a few numbers (lengths, score, blank or not). All
    steps decide on that narrow table, which is written once; the text is joined back at
    the end, to the rows that are kept. Step 0 counts the rows read, the last step the rows
    left after blank ones are dropped.
    """
    for step in steps:
        if step["name"] not in STEPS:
            raise ValueError(f"unknown step: {step['name']}")
    if task not in ("sft", "pt"):
        raise ValueError(f"unknown task: {task}")

    blank = ~(is_nonblank("sentence1") & is_nonblank("sentence2"))
    narrow = bitext.select(
        "pair", "row_id", F.length("sentence1").alias("len1"), F.length("sentence2").alias("len2"),
        blank.alias("blank"), F.lit("0").alias("copy"), F.lit(False).alias("swapped"),
    )
    state = _State(materialize(join_scores(narrow, scores.select("pair", "row_id", "comet_score"))))
    state.done("original")
    for step in steps:
        STEPS[step["name"]](state, **step.get("kargs", {}))
    state.narrow_to(~F.col("blank"))
    state.done("final")
    state.count()
    stats = reduce(DataFrame.unionByName, state.counts)
    stats = stats.groupBy("pair", "step_no", "step").agg(F.sum("n_rows").alias("n_rows"))

    kept = materialize(state.rows.where(state.keep).select("pair", "row_id", "copy", "swapped"))
    # what the text itself tells is applied before texts are shuffled
    long_enough = reduce(Column.__and__, state.of_text, ~blank)
    rows = _swapped(only_rows(bitext.where(long_enough), kept, "pair", "row_id").join(kept, ["pair", "row_id"]))
    make = format_pt if task == "pt" else format_sft
    key = ("pair", "row_id", "copy")
    return make(rows, templates, seed, key, names=names, compat_labels=compat_labels), stats


def _swapped(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "sentence1": F.when(F.col("swapped"), F.col("sentence2")).otherwise(F.col("sentence1")),
        "sentence2": F.when(F.col("swapped"), F.col("sentence1")).otherwise(F.col("sentence2")),
    })


def skip_finished(bitext: DataFrame, outputs: DataFrame, stats: DataFrame) -> DataFrame:
    """The pairs whose outputs are missing or disagree with the counts of their latest run."""
    valid = validate_outputs(outputs, stats).where("valid").select("pair")
    return pending_work(bitext, valid, ["pair"], ["row_id"])
