"""Toxicity by weak supervision: lexicon and pattern voters, a label model, a linear classifier."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .tables import bounded_batches, held_out, per_batch

# At most about so many labelled rows are used to make the lexicons.
LABELLED_ROWS = 30_000
MAX_ENTRIES = 2_000
LEAST_EVIDENCE = 25.0
LEAST_PRECISION = 0.8
STEMS = (4, 5, 6, 7)
PARTS = 2
FEATURES = 1 << 12
THRESHOLD = 0.7
EM_ROUNDS = 50

# Characters that end a word in the lexicons.
_EDGE = bytes(b for b in range(128) if not (chr(b).isalnum()))
_TO_SPACE = bytes.maketrans(_EDGE, b" " * len(_EDGE))


def terms(text: str) -> set[str]:
    """The distinct words of a text (A-Z as a-z, without ASCII punctuation) and their stems.

    A stem is the first letters of a word; it is marked if two, or three, distinct words share it.
    """
    found = {w.decode() for w in text.encode().lower().translate(_TO_SPACE).split()}
    out = {f"w:{w}" for w in found}
    for n in STEMS:
        for stem, words in Counter([w[:n] for w in found if len(w) > n]).items():
            out.add(f"{n}:{stem}")
            if words > 1:
                out.add(f"{n}+:{stem}")
                if words > 2:
                    out.add(f"{n}++:{stem}")
    return out


def labelled(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """(doc_id, text, label) of documents with a label, about `most` at most, chosen by a hash of the id.

    The chosen labels are few enough to be broadcast, so texts are not shuffled.
    """
    own = labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("label")).where(
        "doc_id is not null and label in (0, 1)"
    )
    n = own.count()
    if n > most:
        own = own.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * most / n))
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(own), "doc_id")


def lexicon(rows: DataFrame, most: int = MAX_ENTRIES) -> list[str]:
    """Terms that stand in label-1 texts far more often than chance explains, the clearest first.

    Evidence is the log-likelihood ratio of a term and the label over `rows` (label, text).
    """

    def count(wanted: int, keep: frozenset[str] | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: Counter[str] = Counter()
            for batch in batches:
                for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist()):
                    if label == wanted:
                        own = terms(text or "")
                        found.update(own if keep is None else own & keep)
                        found[""] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["term", "n"]
            )

        counted = rows.select("label", "text").mapInArrow(run, "term string, n long")
        return counted.groupBy("term").agg(F.sum("n").alias("n"))

    # a term in fewer than four texts never has evidence enough; the rest is a bounded number
    of_ones = count(1, None).where("n >= 4")
    ones = {r["term"]: r["n"] for r in of_ones.orderBy(F.desc("n"), "term").limit(100 * most).collect()}
    n1 = ones.pop("", 0)
    zeros = {r["term"]: r["n"] for r in count(0, frozenset([*ones, ""])).collect()}
    n0 = zeros.pop("", 0)
    scored = []
    for term, a in ones.items():
        b = zeros.get(term, 0)
        if a < LEAST_PRECISION * (a + b):
            continue
        expected = (a + b) * n1 / max(n1 + n0, 1)
        evidence = 2 * a * math.log(a / expected) + (2 * b * math.log(b / (a + b - expected)) if b else 0.0)
        if evidence >= LEAST_EVIDENCE:
            scored.append((-evidence, term))
    return [term for _, term in sorted(scored)[:most]]


def voter_names() -> list[str]:
    return [f"{kind}{part}" for kind in ("w", *STEMS) for part in range(PARTS)] + ["several", "dense"]


def vote(hits: list[str], n_terms: int) -> int:
    """The votes of all voters for a text, one bit each: 1 toxic, 0 not.

    There is one lexicon voter for each part of each kind of term; a voter of several different
    terms of one kind; and one of terms that are dense in the text.
    """
    bits = 0
    kinds = [h.split(":", 1)[0].rstrip("+") for h in hits]
    names = voter_names()
    for kind, hit in zip(kinds, hits):
        bits |= 1 << names.index(f"{kind}{zlib.crc32(hit.encode()) % PARTS}")
    if any(n >= 2 for n in Counter(kinds).values()):
        bits |= 1 << names.index("several")
    if len(hits) >= 0.005 * n_terms and hits:
        bits |= 1 << names.index("dense")
    return bits


class LabelModel:
    """A generative model of correlated voters: each depends on the label and on one other voter.

    Fitted by expectation and maximisation to counts of vote patterns, without any label: the
    tables P(vote | label, vote of its parent) are the accuracies, and the tree of parents, the
    one of largest mutual information given the label, holds the correlations.
    """

    def __init__(self, votes: np.ndarray, counts: np.ndarray, rounds: int = EM_ROUNDS) -> None:
        n, m = votes.shape
        self.parent = np.full(m, -1)
        self.prior = 0.1
        share = votes.mean(1) if m else np.zeros(n)
        posterior = np.where(votes.sum(1) >= 2, 0.9, np.where(votes.sum(1) == 1, 0.4, 0.02)) if n else share
        for step in range(rounds):
            self._maximise(votes, counts, posterior, step >= rounds // 2)
            posterior = self.posterior(votes)

    def _tables(self, votes: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """P(vote j = 1 | parent's vote) for both values of the parent's vote."""
        out = np.empty((votes.shape[1], 2))
        for j, p in enumerate(self.parent):
            given = votes[:, p] if p >= 0 else np.zeros(len(votes), int)
            for v in (0, 1):
                own = weight * (given == v)
                out[j, v] = ((own * votes[:, j]).sum() + 0.5) / (own.sum() + 1.0)
        return out

    def _maximise(self, votes: np.ndarray, counts: np.ndarray, posterior: np.ndarray, tree: bool) -> None:
        weights = [counts * (1 - posterior), counts * posterior]
        self.prior = float((weights[1].sum() + 1) / (counts.sum() + 2))
        if tree and (self.parent < 0).all():
            self.parent = _tree(sum(_information(votes, w) for w in weights))
        self.table = [self._tables(votes, w) for w in weights]

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(label 1 | votes) for each pattern."""
        logs = []
        for y, p in enumerate((1 - self.prior, self.prior)):
            total = np.full(len(votes), math.log(p))
            for j, parent in enumerate(self.parent):
                given = votes[:, parent] if parent >= 0 else np.zeros(len(votes), int)
                one = self.table[y][j][given]
                total += np.log(np.where(votes[:, j] == 1, one, 1 - one))
            logs.append(total)
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))


def _information(votes: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Mutual information of all pairs of voters under weighted patterns, times the weight."""
    m, total = votes.shape[1], weight.sum() + 1e-9
    out = np.zeros((m, m))
    for a in (0, 1):
        for b in (0, 1):
            x, y = (votes == a).astype(float), (votes == b).astype(float)
            joint = (x * weight[:, None]).T @ y / total
            alone = np.outer((x * weight[:, None]).sum(0), (y * weight[:, None]).sum(0)) / total**2
            out += np.where(joint > 0, joint * np.log(np.maximum(joint, 1e-300) / np.maximum(alone, 1e-300)), 0)
    return out * total


def _tree(gain: np.ndarray) -> np.ndarray:
    """Parents of a spanning tree of largest gain, -1 for its root."""
    m = len(gain)
    parent, inside = np.full(m, -1), [0]
    while len(inside) < m:
        rest = [j for j in range(m) if j not in inside]
        i, j = max(((i, j) for i in inside for j in rest), key=lambda e: (gain[e], -e[0], -e[1]))
        parent[j] = i
        inside.append(j)
    return parent


class ToxicityModel:
    """The terms of the lexicons with their weights, and a bias."""

    def __init__(self, weights: dict[str, tuple[int, float]], bias: float) -> None:
        self.weights, self.bias = weights, bias

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """How likely each text is toxic, from 0 to 1."""
        out = []
        for text in texts:
            # terms that share a place of the classifier count once
            places = dict(self.weights[t] for t in terms(text or "") if t in self.weights)
            out.append(self.bias + sum(places.values()))
        return 1 / (1 + np.exp(-np.clip(np.array(out, float), -50, 50)))


def train(
    docs: DataFrame, labels: DataFrame, modulus: int = 3, remainder: int = 1, labelled_rows: int = LABELLED_ROWS,
) -> ToxicityModel:
    """The classifier of `docs`, learnt from the labels that are not held out and from all texts."""
    spark = docs.sparkSession
    bounded_batches(spark)
    usable = labels.where(~held_out("doc_id", modulus, remainder))
    entries = lexicon(labelled(docs, usable, "toxic", labelled_rows))
    known = spark.sparkContext.broadcast(frozenset(entries))

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        hits, votes = [], []
        for text in batch.column("text").to_pylist():
            own = terms(text or "")
            found = sorted(own & known.value)
            hits.append(found)
            votes.append(vote(found, len(own)))
        return pa.RecordBatch.from_arrays(
            [pa.array(hits, pa.list_(pa.string())), pa.array(votes, pa.int32())], ["hits", "votes"]
        )

    rows = per_batch(docs.select(F.col("text").cast("string")), make, "hits array<string>, votes int")
    # texts with equal terms and votes are one row from here on
    rows = materialize(rows.groupBy("hits", "votes").agg(F.count("*").alias("n")))
    # no more patterns than 2 to the number of voters, whatever the number of texts
    seen = rows.groupBy("votes").agg(F.sum("n").alias("n")).orderBy("votes").toArrow()
    if not seen.num_rows:
        return ToxicityModel({}, -50.0)
    patterns = (seen.column("votes").to_numpy()[:, None] >> np.arange(len(voter_names())) & 1).astype(int)
    model = LabelModel(patterns, seen.column("n").to_numpy().astype(float))
    posterior = spark.createDataFrame(
        pa.table({"votes": seen.column("votes"), "posterior": model.posterior(patterns)}), "votes int, posterior double"
    )
    weighed = rows.join(F.broadcast(posterior), "votes").select("hits", F.inline(F.array(
        F.struct(F.lit(1.0).alias("label"), (F.col("n") * F.col("posterior")).alias("weight")),
        F.struct(F.lit(0.0).alias("label"), (F.col("n") * (1 - F.col("posterior"))).alias("weight")),
    ))).where("weight > 0")
    hashing = HashingTF(numFeatures=FEATURES, binary=True, inputCol="hits", outputCol="features")
    trained = LogisticRegression(
        featuresCol="features", labelCol="label", weightCol="weight", maxIter=30, regParam=1e-4, standardization=False,
    ).fit(materialize(hashing.transform(weighed).select("features", "label", "weight")))
    places = {term: hashing.indexOf(term) for term in entries}
    weights = {term: (place, float(trained.coefficients[place])) for term, place in places.items()}
    return ToxicityModel(weights, float(trained.intercept))


def toxicity(
    docs: DataFrame, labels: DataFrame, modulus: int = 3, remainder: int = 1, threshold: float = THRESHOLD,
    labelled_rows: int = LABELLED_ROWS,
) -> DataFrame:
    """(doc_id, held_out, score, predicted): how likely each whole text is toxic.

    Lexicons come from the `toxic` labels of at most about `labelled_rows` documents that are not
    held out. Their votes on all texts, without labels, fit the label model; its posteriors are
    the labels on which a logistic regression over the terms of the lexicons is trained, and that
    scores every text. A null or empty text has no terms and gets the score of such texts. One row
    per row of `docs`; without any lexicon all texts have the same low score.
    """
    model = train(docs, labels, modulus, remainder, labelled_rows)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(model.scores(batch.column("text").to_pylist()))], ["doc_id", "score"]
        )

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return per_batch(texts, make, "doc_id long, score double").select(
        "doc_id", held_out("doc_id", modulus, remainder).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, as they are, whose texts score below the threshold."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(model.scores(batch.column("text").to_pylist()) < threshold))

    return per_batch(docs, make, docs.schema)
