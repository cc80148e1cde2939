"""Log-probability of texts: word counts backed by a lattice of subword pieces."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .hashing import chunks, words
from .tables import bounded_batches, held_out, per_batch

ADDED = 0.1
ROUNDS = 2
# At most so many frequent words are looked up in the tasks; all others are joined.
HOT_WORDS = 200_000
# Distinct words that a task counts before it hands them on.
COUNTED = 400_000
# Stands for the end of a text in the table of words, where no word is empty.
END = ""
WORD_BEGIN = "▁"
WORD_END = "</w>"

Weights = dict[str, float]


def piece_scores(path: str) -> Weights:
    """The pieces of a sentencepiece vocabulary and a first log-probability of each from its score.

    Scores of a vocabulary made by merging are ranks, which count as in Zipf's law; others are
    log-probabilities. Bytes, which any character can be spelt with, are pieces like `<0x0A>`.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    known = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i))]
    scores = {model.id_to_piece(i): model.get_score(i) for i in known}
    ranked = min(scores.values()) < -100
    raw = {p: 1.0 / (10.0 - s) if ranked else math.exp(s) for p, s in scores.items()}
    raw |= {f"<0x{b:02X}>": raw.get(f"<0x{b:02X}>", 0.0) or min(raw.values()) for b in range(256)}
    raw[WORD_END] = 0.2 * sum(raw.values())
    total = sum(raw.values())
    return {p: math.log(x / total) for p, x in raw.items()}


def _log_sum(values: list[float]) -> float:
    if len(values) == 1:
        return values[0]
    top = max(values)
    return top + math.log(sum([math.exp(v - top) for v in values]))


class Lattice:
    """All segmentations of a word into weighted pieces.

    A word is spelt with a mark before it, as the vocabulary's pieces are, and ends with a piece
    of its own, so the probabilities of all words add up to one at most. A character that is no
    piece is spelt with its bytes.
    """

    def __init__(self, weights: Weights) -> None:
        self.end = weights[WORD_END]
        self.bytes = [weights[f"<0x{b:02X}>"] for b in range(256)]
        # pieces and what they begin with; the latter have no weight
        self.tree: dict[str, float | None] = {}
        for piece, weight in weights.items():
            if piece != WORD_END and not (piece.startswith("<0x") and len(piece) == 6):
                for k in range(1, len(piece)):
                    self.tree.setdefault(piece[:k], None)
                self.tree[piece] = weight
        self.shares = {p: 0.0 if w is None else math.exp(w) for p, w in self.tree.items()}

    def _spelt_out(self, char: str) -> float:
        return sum([self.bytes[b] for b in char.encode()])

    def forward(self, spelt: str) -> list[float]:
        """Log-probability of each prefix, summed over its segmentations."""
        tree, n = self.tree, len(spelt)
        into: list[list[float]] = [[] for _ in range(n + 1)]
        into[0].append(0.0)
        reached = []
        for i in range(n + 1):
            here = _log_sum(into[i])
            reached.append(here)
            if i < n and tree.get(spelt[i]) is None:
                into[i + 1].append(here + self._spelt_out(spelt[i]))
            for j in range(i + 1, n + 1):
                weight = tree.get(spelt[i:j], 0.0)
                if weight == 0.0:
                    break
                if weight is not None:
                    into[j].append(here + weight)
        return reached

    def log_probability(self, word: str) -> float:
        """Natural logarithm of the sum over all segmentations of the word."""
        return self.forward(WORD_BEGIN + word)[-1] + self.end

    def expect(self, word: str, into: Counter[str]) -> None:
        """Adds how often each piece is expected in the word, given the word.

        Sums of probabilities in both directions; a word too improbable for them goes by logarithms.
        """
        spelt, shares = WORD_BEGIN + word, self.shares
        n = len(spelt)
        edges: list[tuple[int, int, float, str]] = []
        ahead = [0.0] * (n + 1)
        ahead[0] = 1.0
        for i in range(n):
            here = ahead[i]
            if not shares.get(spelt[i]):
                p = math.exp(self._spelt_out(spelt[i]))
                edges.append((i, i + 1, p, ""))
                ahead[i + 1] += here * p
            for j in range(i + 1, n + 1):
                piece = spelt[i:j]
                p = shares.get(piece)
                if p is None:
                    break
                if p:
                    edges.append((i, j, p, piece))
                    ahead[j] += here * p
        if ahead[n] < 1e-250:
            self._expect_long(spelt, into)
            return
        behind = [0.0] * (n + 1)
        behind[n] = 1.0 / ahead[n]
        for i, j, p, piece in reversed(edges):
            b = behind[j] * p
            behind[i] += b
            if piece:
                into[piece] += ahead[i] * b
            else:
                for byte in spelt[i].encode():
                    into[f"<0x{byte:02X}>"] += ahead[i] * b
        into[WORD_END] += 1

    def _expect_long(self, spelt: str, into: Counter[str]) -> None:
        """As `expect` in logarithms, for words whose probability is too small for a number."""
        reached, n = self.forward(spelt), len(spelt)
        left = [-math.inf] * n + [-reached[-1]]
        for i in range(n - 1, -1, -1):
            edges = [] if self.tree.get(spelt[i]) is not None else [(i + 1, self._spelt_out(spelt[i]), "")]
            for j in range(i + 1, n + 1):
                weight = self.tree.get(spelt[i:j], 0.0)
                if weight == 0.0:
                    break
                if weight is not None:
                    edges.append((j, weight, spelt[i:j]))
            left[i] = _log_sum([left[j] + w for j, w, _ in edges])
            for j, w, piece in edges:
                share = math.exp(reached[i] + w + left[j])
                for own in [piece] if piece else [f"<0x{b:02X}>" for b in spelt[i].encode()]:
                    into[own] += share
        into[WORD_END] += 1


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, hash, train, n): how often each word stands in the training texts and in all.

    `docs` has text and held_out. Words are `[^\\x20\\x09-\\x0D]+` with A-Z as a-z. Tasks count
    before they hand on, so frequent words are no hot keys.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter[bytes], Counter[bytes]] = (Counter(), Counter())
        for batch in batches:
            out = batch.column("held_out").to_pylist()
            for chunk in chunks(batch.column("text")):
                for i in range(chunk.last - chunk.first):
                    text = chunk.data[chunk.starts[i] : chunk.starts[i + 1]].tobytes()
                    counts[out[chunk.first + i]].update(text.lower().split())
                if len(counts[0]) + len(counts[1]) > COUNTED:
                    yield _count_rows(*counts)
                    counts = (Counter(), Counter())
        yield _count_rows(*counts)

    partial = docs.select("held_out", F.col("text").cast("string")).mapInArrow(
        run, "word string, hash long, train long, n long"
    )
    return partial.groupBy("word", "hash").agg(F.sum("train").alias("train"), F.sum("n").alias("n"))


def _count_rows(train: Counter[bytes], rest: Counter[bytes]) -> pa.RecordBatch:
    found = list(train.keys() | rest.keys())
    texts = pa.array([w.decode() for w in found], pa.string())
    hashes = [words(chunk).hashes for chunk in chunks(texts)]
    own = [train[w] for w in found]
    return pa.RecordBatch.from_arrays(
        [
            texts, pa.array(np.concatenate(hashes).astype(np.int64) if hashes else [], pa.int64()),
            pa.array(own, pa.int64()), pa.array([a + rest[w] for a, w in zip(own, found)], pa.int64()),
        ],
        ["word", "hash", "train", "n"],
    )


def fitted(weights: Weights, counted: DataFrame, rounds: int = ROUNDS) -> Weights:
    """Piece weights after some rounds of expectation and maximisation over the training words.

    Every distinct word counts once: the lattice is what stands in for rare and new words. One
    row per piece and task goes through the driver, a number that the vocabulary bounds.
    """
    spark = counted.sparkSession
    trained = counted.where("train > 0").select("word")
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lattice, found = Lattice(sent.value), Counter()
            for batch in batches:
                for word in batch.column("word").to_pylist():
                    lattice.expect(word, found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.float64())], ["piece", "n"]
            )

        sums = trained.mapInArrow(run, "piece string, n double").groupBy("piece").agg(F.sum("n").alias("n")).toArrow()
        found = dict(zip(sums.column("piece").to_pylist(), sums.column("n").to_pylist()))
        total = sum(found.values()) + ADDED * len(weights)
        weights = {piece: math.log((found.get(piece, 0.0) + ADDED) / total) for piece in weights}
    return weights


def hot_bound(counted: DataFrame, most: int) -> int:
    """The least count at which no more than `most` words are as frequent."""
    levels = counted.groupBy(F.floor(F.log2("n")).cast("int").alias("level")).agg(F.count("*").alias("words"))
    total, bound = 0, 62
    for level, n in sorted(((r["level"], r["words"]) for r in levels.collect()), reverse=True):
        if total + n > most:
            break
        total, bound = total + n, level
    return 1 << bound


def score_texts(docs: DataFrame, path: str, modulus: int = 10, rounds: int = ROUNDS) -> DataFrame:
    """Log-probability of every whole text, learnt from the texts that are not held out.

    (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score). Tokens are the words
    and one end. `base_score` is the add-0.1 unigram of the training tokens. `score` is the
    model's: of every word seen c times in N training tokens, (c - d)/N stays with the word, and
    the discounts d together go to the subword lattice, whose probability of the word is the sum
    over all segmentations into pieces of the vocabulary at `path`. Null and empty texts consist
    of the end. Rows with a null id count as the id ''. One row per row of `docs`.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(
        F.col("doc_id").cast("long"), held_out("doc_id", modulus, 0).alias("held_out"), F.col("text").cast("string")
    )
    counted = materialize(word_counts(texts))
    ends = texts.agg(F.sum((~F.col("held_out")).cast("long")).alias("n")).first()["n"] or 0
    stats = counted.where("train > 0").agg(
        F.coalesce(F.sum("train"), F.lit(0)).alias("tokens"), F.count("*").alias("types"),
        F.count(F.when(F.col("train") == 1, 1)).alias("once"), F.count(F.when(F.col("train") == 2, 1)).alias("twice"),
    ).first()
    total, types = stats["tokens"] + ends, stats["types"] + (ends > 0)
    discount = stats["once"] / (stats["once"] + 2 * stats["twice"]) if stats["once"] else 0.5
    discount = min(max(discount, 0.1), 0.9)
    freed = discount * types / total if total else 0.5
    weights = fitted(piece_scores(path), counted, rounds)
    sent = spark.sparkContext.broadcast(weights)

    def base(c: np.ndarray) -> np.ndarray:
        return np.log10((c + ADDED) / (total + ADDED * (types + 1)))

    def value(c: np.ndarray, spelt: np.ndarray) -> np.ndarray:
        kept = np.where(c > 0, c - discount, 0) / max(total, 1)
        with np.errstate(divide="ignore"):
            return np.logaddexp(np.log(kept), math.log(freed) + spelt) / math.log(10)

    def valued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(sent.value)
        for batch in batches:
            c = batch.column("train").to_numpy()
            spelt = np.array([lattice.log_probability(w) for w in batch.column("word").to_pylist()], float)
            yield pa.RecordBatch.from_arrays(
                [batch.column("hash"), batch.column("n"), pa.array(c > 0), pa.array(base(c)), pa.array(value(c, spelt))],
                ["hash", "n", "known", "base", "value"],
            )

    table = materialize(counted.select("word", "hash", "train", "n").mapInArrow(
        valued, "hash long, n long, known boolean, base double, value double"
    ))
    bound = hot_bound(table, HOT_WORDS)
    hot = table.where(F.col("n") >= bound).orderBy("hash").toArrow()
    keys = hot.column("hash").to_numpy()
    frequent = spark.sparkContext.broadcast((
        keys, *(hot.column(c).to_numpy().astype(float) for c in ("known", "base", "value"))
    ))
    end_base = float(base(np.array(float(ends))))
    end_value = math.log10((ends - discount) / total) if ends else math.log10(0.5)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, *columns = frequent.value
        counts, sums, rare = [], [], []
        for chunk in chunks(batch.column("text")):
            own = words(chunk)
            hashes = own.hashes.astype(np.int64)
            n = len(hashes)
            at = np.minimum(np.searchsorted(keys, hashes), max(len(keys) - 1, 0))
            hit = keys[at] == hashes if len(keys) else np.zeros(n, bool)
            sums.append(np.stack([
                np.diff(np.concatenate([[0.0], np.cumsum(np.where(hit, c[at], 0.0) if len(keys) else np.zeros(n))])[own.first])
                for c in columns
            ]))
            counts.append(np.diff(own.first))
            missed = np.flatnonzero(~hit)
            edges = np.searchsorted(missed, own.first)
            for lo, hi in zip(edges[:-1], edges[1:]):
                rare.append(hashes[missed[lo:hi]])
        totals = np.concatenate(sums, axis=1) if sums else np.zeros((3, 0))
        sizes = np.concatenate([[0], np.cumsum([len(r) for r in rare], dtype=np.int64)]).astype(np.int32)
        rest = pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate(rare) if rare else [], pa.int64()))
        n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(n.astype(np.int64)),
             pa.array(np.rint(totals[0]).astype(np.int64)), pa.array(totals[1]), pa.array(totals[2]), rest],
            ["doc_id", "held_out", "n_words", "known", "base", "value", "rare"],
        )

    rows = materialize(per_batch(texts, make, (
        "doc_id long, held_out boolean, n_words long, known long, base double, value double, rare array<long>"
    ))).withColumn("row", F.monotonically_increasing_id())
    rare = rows.select("row", F.explode("rare").alias("hash"))
    tail = table.where(F.col("n") < bound).select("hash", "known", "base", "value")
    found = rare.join(tail, "hash").groupBy("row").agg(
        F.sum(F.col("known").cast("long")).alias("k"), F.sum("base").alias("b"), F.sum("value").alias("v")
    )
    nothing = F.lit(0)
    return rows.drop("rare").join(found, "row", "left").select(
        "doc_id", "held_out", (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("known") + F.coalesce("k", nothing) + F.lit(int(ends > 0))).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("b", nothing) + F.lit(end_base)).alias("base_score"),
        (F.col("value") + F.coalesce("v", nothing) + F.lit(end_value)).alias("score"),
    )
