"""Quality by learning from positive and unlabelled texts."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .tables import held_out, per_batch
from .toxicity import labelled

# At most about so many trusted positives are used; the unlabelled texts are all others.
POSITIVE_ROWS = 30_000
BINS = 12
STEPS = 40
RATE = 0.1  # of the first step; it falls to nothing, as the bound at zero makes long steps swing
SHRINK = 1e-3
SMALL = 2.0  # divided by the number of rows it is added to SHRINK: few rows tell few of the weights
SUMMED = 256  # with more tasks than this, their sums are added up in the cluster first
THRESHOLD = 0.3

# The ASCII characters whose shares are features of their own.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def features(text: str) -> list[float]:
    """Numbers that describe how a text is written, whatever its language."""
    n = max(len(text), 1)
    words = text.split()
    m = max(len(words), 1)
    lowered = [w.lower() for w in words]
    counts = Counter(lowered)
    lines = [line.strip() for line in text.split("\n") if line.strip()]
    letters = sum(map(str.isalpha, text))
    plain = sum(map(str.isalpha, words))
    raw = text.encode()
    out = [
        math.log(n), math.log(m), len(text) / m, letters / n,
        sum(map(str.isupper, text)) / max(letters, 1), sum(map(str.isdigit, text)) / n,
        sum(1 for a, b in zip(lowered, lowered[1:]) if a == b) / m,
        len(counts) / m, max(counts.values(), default=0) / m,
        sum(c for c in counts.values() if c > 1) / m,
        math.log(len(counts) + 1) / math.log(m + 1),
        len(lines) / m, len(set(lines)) / max(len(lines), 1),
        plain / m, sum(map(str.isupper, words)) / m, sum(map(str.istitle, words)) / m,
        sum(1 for w in words if not w[-1].isalnum()) / m, sum(1 for w in words if not w[0].isalnum()) / m,
        sum(1 for w in words if len(w) > 14) / m,
        len(zlib.compress(raw, 1)) / max(len(raw), 1),
        sum(1 for c in text if ord(c) > 127) / n,
    ]
    return out + [text.count(mark) / m for mark in MARKS]


N_FEATURES = 21 + len(MARKS)


def bin_edges(rows: DataFrame, bins: int = BINS) -> np.ndarray:
    """Inner bounds of `bins` about equally frequent ranges of every feature, over all rows."""
    columns = [F.col("x")[i].alias(f"x{i}") for i in range(N_FEATURES)]
    shares = [k / bins for k in range(1, bins)]
    # the ends tell rare cases apart, among them the texts in which a mark stands at all
    shares = [0.01, *shares, 0.97, 0.99]
    found = rows.select(*columns).approxQuantile([f"x{i}" for i in range(N_FEATURES)], shares, 0.002)
    return np.array([f or [0.0] * len(shares) for f in found])


def indicators(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Which bounds each value exceeds: a step function of every feature is linear in these."""
    return (x[:, :, None] > edges[None, :, :]).reshape(len(x), -1).astype(np.float32)


def class_prior(labels: DataFrame, label: str) -> float:
    """The share of positives, estimated from the labels that may be learnt (0.5 without any).

    It is one standard error below what the labels say: with too large a share the unlabelled
    texts seem to hold no negatives at all, and none are learnt.
    """
    row = labels.where(f"{label} in (0, 1)").agg(F.count("*").alias("n"), F.sum(label).alias("ones")).first()
    n = row["n"] + 2
    share = ((row["ones"] or 0) + 1) / n
    return max(share - math.sqrt(share * (1 - share) / n), 0.01) if row["n"] else 0.5


def fit(rows: DataFrame, edges: np.ndarray, prior: float, steps: int = STEPS) -> np.ndarray:
    """Weights (and bias) of the linear model of least non-negative unbiased risk.

    `rows` has features x and `trusted`. With logistic losses l+ and l- the risk is
    prior * E_trusted[l+] + max(0, E_all[l-] - prior * E_trusted[l-]): what negatives cost is
    what all texts cost as negatives less the positives' part of it, and may not fall below
    zero; when it does, a step undoes the overfit instead. Every step sums the gradients of all
    rows in the cluster; one short vector per task comes back, and of more than SUMMED tasks one
    for about as many tasks as there are such vectors.
    """
    spark = rows.sparkSession
    tasks = rows.rdd.getNumPartitions()
    size = edges.size + 1
    weights, first, second = np.zeros(size), np.zeros(size), np.zeros(size)
    schema = "sums array<double>"

    def gradients(current: np.ndarray) -> np.ndarray:
        sent = spark.sparkContext.broadcast(current)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            w, total = sent.value, np.zeros(3 * size + 5)
            for batch in batches:
                x = batch.column("x").flatten().to_numpy().reshape(-1, N_FEATURES)
                trusted = batch.column("trusted").to_numpy(zero_copy_only=False)
                z = indicators(x, edges)
                score = z @ w[:-1].astype(np.float32) + w[-1]
                chance = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
                loss = np.logaddexp(0, score)
                for k, (mask, slope) in enumerate(((trusted, chance - 1), (trusted, chance), (~trusted, chance))):
                    g = slope * mask
                    total[k * size : (k + 1) * size] += np.append(g.astype(np.float32) @ z, g.sum())
                total[-5:] += [
                    trusted.sum(), len(trusted) - trusted.sum(), (loss - score)[trusted].sum(), loss[trusted].sum(),
                    loss[~trusted].sum(),
                ]
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["sums"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(3 * size + 5)
            for batch in batches:
                total += batch.column("sums").flatten().to_numpy().reshape(-1, len(total)).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["sums"])

        sums = rows.mapInArrow(run, schema)
        if tasks > SUMMED:
            sums = sums.repartition(math.isqrt(tasks)).mapInArrow(add, schema)
        return np.sum([r["sums"] for r in sums.collect()], axis=0)

    for step in range(1, steps + 1):
        total = gradients(weights)
        n_pos, n_rest, _, as_negative, all_negative = total[-5:]
        up, down, rest = (total[k * size : (k + 1) * size] for k in range(3))
        n_pos = max(n_pos, 1)
        # the unlabelled texts are all texts; trusted ones among them are rows of both kinds
        n_all = max(n_rest + n_pos, 1)
        negative = (all_negative + as_negative) / n_all - prior * as_negative / n_pos
        negative_slope = (rest + down) / n_all - prior * down / n_pos
        slope = prior * up / n_pos + negative_slope if negative >= 0 else -negative_slope
        slope = slope + (SHRINK + SMALL / n_all) * np.append(weights[:-1], 0)
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        rate = RATE * (1 - (step - 1) / steps)
        weights = weights - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return weights


class QualityModel:
    """Bounds of the features' ranges and the weights of the steps between them."""

    def __init__(self, edges: np.ndarray, weights: np.ndarray) -> None:
        self.edges, self.weights = edges, weights

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """How likely each text is of good quality, from 0 to 1."""
        x = np.array([features(text or "") for text in texts], np.float32).reshape(-1, N_FEATURES)
        total = indicators(x, self.edges) @ self.weights[:-1].astype(np.float32) + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(total.astype(float), -30, 30)))


def train(
    docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0, positive_rows: int = POSITIVE_ROWS,
) -> tuple[QualityModel, DataFrame]:
    """The classifier of `docs`, and the table (doc_id, x, trusted) of all texts' features.

    Trusted positives are at most about `positive_rows` documents whose `quality` label is 1 and
    may be learnt; all texts together are the unlabelled ones.
    """
    usable = labels.where(~held_out("doc_id", modulus, remainder)).join(
        docs.select("doc_id").distinct(), "doc_id", "left_semi"  # the share among these very documents
    )
    prior = class_prior(usable, "quality")
    chosen = labelled(
        docs.select("doc_id", F.lit("").alias("text")), usable, "quality", int(positive_rows / max(prior, 0.01))
    ).where("label = 1").select("doc_id").distinct()

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([features(text or "") for text in batch.column("text").to_pylist()], np.float32)
        flat = pa.array(found.reshape(-1))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, N_FEATURES, dtype=np.int32)), flat)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["doc_id", "x"])

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = per_batch(texts, make, "doc_id long, x array<float>")
    trusted = F.broadcast(chosen.withColumn("trusted", F.lit(True)))
    rows = materialize(rows.join(trusted, "doc_id", "left").withColumn("trusted", F.coalesce("trusted", F.lit(False))))
    edges = bin_edges(rows)
    return QualityModel(edges, fit(rows, edges, prior)), rows


def quality(
    docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0, threshold: float = THRESHOLD,
    positive_rows: int = POSITIVE_ROWS,
) -> DataFrame:
    """(doc_id, held_out, score, predicted): how likely each whole text is of good quality.

    See `train`: bounds of the features' ranges, the unlabelled risk and scores cover all texts. A
    null or empty text has the features of the empty text. One row per row of `docs`; without any
    positive, all texts count as unlabelled only and score low.
    """
    model, rows = train(docs, labels, modulus, remainder, positive_rows)

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = batch.column("x").flatten().to_numpy().reshape(-1, N_FEATURES)
        total = indicators(x, model.edges) @ model.weights[:-1].astype(np.float32) + model.weights[-1]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(total.astype(float), -30, 30))))], ["doc_id", "score"]
        )

    scored = per_batch(rows.select("doc_id", "x"), score, "doc_id long, score double")
    return scored.select(
        "doc_id", held_out("doc_id", modulus, remainder).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def of_quality(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, as they are, whose texts reach the threshold."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(model.scores(batch.column("text").to_pylist()) >= threshold))

    return per_batch(docs, make, docs.schema)
