"""MinHash near-duplicates by an inverted join of signature coordinates."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.lookup import attach, counted_table
from ..session import materialize
from .hashing import chunks, mix, shingle_set, words
from .tables import components, per_batch

COORDINATES = 64
# Two texts with a similarity of 0.85 agree in 54 of 64 coordinates on average; fewer than
# 40 have a chance of about 1 in 100,000.
LEAST_MATCHES = 40
# Candidates are counted on a finer signature of one byte a coordinate: 435 of 512 agree on
# average at 0.85, and again fewer than 400 have a chance of less than 1 in 100,000.
FINE = 512
LEAST_FINE = 400
THRESHOLD = 85
BLOCK = 512

_SEEDS = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64)) | np.uint64(1)
_FINE_SEEDS = mix(np.arange(1001, FINE + 1001, dtype=np.uint64)) | np.uint64(1)


def fewer(coordinates: int, threshold: int, least: int) -> float:
    """The chance that a pair at `threshold` agrees in fewer than `least` coordinates."""
    p = threshold / 100
    return sum(math.comb(coordinates, k) * p**k * (1 - p) ** (coordinates - k) for k in range(least))


def as_sure(coordinates: int, least: int, threshold: int) -> int:
    """What is as sure at `threshold` as `least` coordinates are at THRESHOLD."""
    chance = fewer(coordinates, THRESHOLD, least)
    return max(m for m in range(1, coordinates + 1) if m == 1 or fewer(coordinates, threshold, m) <= chance)


def set_key(own: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets of shingles apart."""
    with np.errstate(over="ignore"):
        one, two = own.sum(dtype=np.uint64), mix(own ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64)
    return int(np.int64(one)), int(np.int64(two))


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, key1, key2, signature) of every whole text.

    The signature holds, for each coordinate, the least of the text's shingle hashes under
    that coordinate's permutation. Null and empty texts have no shingles and a null signature.
    """

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.num_rows
        sizes, key1, key2 = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        found, rows = [], []
        for chunk in chunks(batch.column("text")):
            own = words(chunk)
            sets, at = [], []
            for i in range(chunk.last - chunk.first):
                lo, hi = own.first[i], own.first[i + 1]
                if hi > lo:
                    one = shingle_set(own.hashes[lo:hi])
                    row = chunk.first + i
                    sizes[row] = len(one)
                    key1[row], key2[row] = set_key(one)
                    sets.append(one)
                    at.append(row)
            if sets:
                joined = np.concatenate(sets)
                starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
                rows.extend(at)
                found.append(np.stack(
                    [np.minimum.reduceat(permuted(joined, seed), starts) for seed in _SEEDS], axis=1
                ))
        flat = np.concatenate(found) if found else np.zeros((0, COORDINATES), np.uint64)
        values = pa.array(flat.astype(np.int64).ravel())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, flat.size + 1, COORDINATES, dtype=np.int32)), values)
        place = np.full(n, -1, np.int64)
        place[rows] = np.arange(len(rows))
        signature = lists.take(pa.array(place, mask=place < 0))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes), pa.array(key1), pa.array(key2), signature],
            ["doc_id", "n_shingles", "key1", "key2", "signature"],
        )

    schema = "doc_id long, n_shingles long, key1 long, key2 long, signature array<long>"
    return per_batch(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), make, schema)


def permuted(h: np.ndarray, seed: np.uint64) -> np.ndarray:
    """A cheap permutation of hashes that are well mixed already."""
    x = h * seed
    return x ^ (x >> np.uint64(32))


def prefix_postings(classes: DataFrame, least: int = LEAST_MATCHES) -> DataFrame:
    """(node, keys): the postings in which a pair with `least` matches must meet.

    A key stands for a pair of coordinate and value. Pairs are ordered from rare to frequent. Two signatures that agree in `least` places share a
    posting among the first COORDINATES - least + 1 of both, so frequent values (shared
    passages) are skipped. Values of one text alone match nothing, and a text with fewer than
    `least` shared values has no partner.
    """
    postings = classes.select("node", F.posexplode("signature").alias("coordinate", "value")).select(
        "node", F.xxhash64("coordinate", "value").alias("key")
    )
    shared = postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    own = postings.join(shared, "key").groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("n", "key"))).alias("own")
    )
    first = F.slice("own", F.lit(1), F.size("own") - F.lit(least - 1))
    keys = F.sort_array(F.transform(first, lambda p: p["key"]))
    return own.where(F.size("own") >= least).select("node", keys.alias("keys"))


def one_by_one(prefixes: DataFrame) -> DataFrame:
    """(node, key): a row for each posting of each node."""
    return prefixes.select("node", F.explode("keys").alias("key"))


def head_pairs(prefixes: DataFrame) -> DataFrame:
    """Every node of a posting list with the list's first node in three different orders."""
    postings = one_by_one(prefixes)
    orders = [F.col("node"), F.xxhash64(F.lit(1), "node"), F.xxhash64(F.lit(2), "node")]
    heads = postings.groupBy("key").agg(*[F.min_by("node", order).alias(f"h{i}") for i, order in enumerate(orders)])
    paired = postings.select("node", "key").join(heads, "key").select(
        "node", F.explode(F.array_distinct(F.array("h0", "h1", "h2"))).alias("head")
    )
    return paired.where("node != head").select(
        F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")
    ).distinct()


def crossing_pairs(prefixes: DataFrame, full: DataFrame, labels: DataFrame, least: int = LEAST_FINE) -> DataFrame:
    """Pairs of a posting list that are not connected yet and agree in `least` fine coordinates.

    Lists of one component are left out. Long lists are dealt out as pairs of blocks, so no
    task holds a list. Pairs are counted inside the task and leave it only if they match, and
    only from the first list that both share; after half of the coordinates, those that cannot
    reach `least` any more are skipped.
    """
    labelled = one_by_one(prefixes).join(labels.withColumnRenamed("component", "c"), "node", "left").withColumn(
        "c", F.coalesce("c", "node")
    )
    open_lists = labelled.groupBy("key").agg(
        F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("n")
    ).where("lo != hi").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    dealt = labelled.join(open_lists, "key").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # a node's keys join its rows only here, as each of these rows holds all of them
    of_node = full.select(F.col("doc_id").alias("node"), "fine").join(prefixes, "node")
    placed = dealt.join(of_node, "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("cell"), "key",
        (F.col("own") > F.col("other")).alias("second"), (F.col("own") == F.col("other")).alias("whole"),
        "node", "c", "keys", "fine",
    )
    tasks = placed.repartition("cell").sortWithinPartitions("cell")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            last = int(np.searchsorted(cells == cells[-1], True)) if len(cells) else 0
            if last:  # what came before the last cell is complete
                yield _count_cells(pa.Table.from_batches([*kept, batch.slice(0, last)]), least)
                kept = []
            elif kept and kept[-1].column("cell")[0].as_py() != cells[0]:
                yield _count_cells(pa.Table.from_batches(kept), least)
                kept = []
            kept.append(batch.slice(last))
        if kept:
            yield _count_cells(pa.Table.from_batches(kept), least)

    return tasks.mapInArrow(run, "a long, b long").distinct()


def _count_cells(rows: pa.Table, least: int) -> pa.RecordBatch:
    rows = rows.combine_chunks()
    cells, lists, nodes, comps = (rows.column(c).to_numpy() for c in ("cell", "key", "node", "c"))
    second, whole = (rows.column(c).to_numpy() for c in ("second", "whole"))
    fine = np.frombuffer(b"".join(rows.column("fine").to_pylist()), np.uint8).reshape(-1, FINE)
    bounds = np.concatenate([[0], np.flatnonzero(cells[1:] != cells[:-1]) + 1, [len(cells)]])
    keys = rows.column("keys")
    memo: dict[int, np.ndarray] = {}

    def own_keys(i: int) -> np.ndarray:
        if i not in memo:
            memo[i] = np.array(keys[i].as_py(), np.int64)
        return memo[i]

    left, right = [], []
    half = FINE // 2
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        own = np.arange(lo, hi)
        ones, others = (own, own) if whole[lo] else (own[~second[lo:hi]], own[second[lo:hi]])
        memo.clear()
        for i in ones:
            js = others[comps[others] != comps[i]]
            if whole[lo]:
                js = js[js > i]
            if not len(js):
                continue
            got = np.count_nonzero(fine[js, :half] == fine[i, :half], axis=1)
            js, got = js[got >= least - half], got[got >= least - half]
            got = got + np.count_nonzero(fine[js, half:] == fine[i, half:], axis=1)
            for j in js[got >= least]:
                if np.intersect1d(own_keys(i), own_keys(j), assume_unique=True)[0] == lists[lo]:
                    left.append(min(nodes[i], nodes[j]))
                    right.append(max(nodes[i], nodes[j]))
    return pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])


def full_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(doc_id, own, fine): sorted shingle hashes and fine signatures of the documents in `nodes`."""
    wanted, fits = counted_table(nodes.select(F.col("node").alias("doc_id")).distinct())
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    texts = attach(texts, wanted, ["doc_id"], fits, "left_semi")  # texts are not shuffled for few nodes

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        out, fine = [], []
        for chunk in chunks(batch.column("text")):
            own = words(chunk)
            for i in range(chunk.last - chunk.first):
                one = shingle_set(own.hashes[own.first[i] : own.first[i + 1]])
                out.append(one.tobytes())
                least = np.array([permuted(one, seed).min() for seed in _FINE_SEEDS]) if len(one) else np.zeros(FINE)
                fine.append(least.astype(np.uint8).tobytes())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(out, pa.binary()), pa.array(fine, pa.binary())], ["doc_id", "own", "fine"]
        )

    return per_batch(texts, sets, "doc_id long, own binary, fine binary")


def confirmed(
    pairs: DataFrame, full: DataFrame, threshold: int = THRESHOLD, least: int = LEAST_FINE,
) -> DataFrame:
    """The pairs (a, b) that agree in `least` fine coordinates and whose full sets are similar enough."""
    fine = [full.select(F.col("doc_id").alias(x), F.col("fine").alias(f"f{x}")) for x in ("a", "b")]
    near = per_batch(pairs.join(fine[0], "a").join(fine[1], "b"), lambda batch: _alike(batch, least), "a long, b long")
    both = near.distinct().join(full.select(F.col("doc_id").alias("a"), F.col("own").alias("sa")), "a").join(
        full.select(F.col("doc_id").alias("b"), F.col("own").alias("sb")), "b"
    )

    def compare(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for x, y in zip(batch.column("sa"), batch.column("sb")):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            if 100 * min(len(x), len(y)) < threshold * max(len(x), len(y)):
                keep.append(False)
                continue
            inside = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(inside > 0 and 100 * inside >= threshold * (len(x) + len(y) - inside))
        mask = pa.array(keep, pa.bool_())
        return pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"])

    return per_batch(both, compare, "a long, b long").distinct()


def _alike(batch: pa.RecordBatch, least: int) -> pa.RecordBatch:
    x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, FINE) for c in ("fa", "fb"))
    mask = pa.array(np.count_nonzero(x == y, axis=1) >= least)
    return pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"])


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD, least: int | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of `docs`.

    Documents are linked when 100 * |A & B| >= threshold * |A | B| for their sets of 5-word
    shingles; `component_id` is the smallest id that can be reached. Texts with equal sets
    form a class, and only classes are compared. First each class is compared with the heads
    of its posting lists, which connects groups of copies by few pairs; then all pairs of a
    list that are not connected by then are counted, so no link between components is lost.
    How many coordinates must agree follows from `threshold`, unless `least` is given.
    Null or empty texts have no shingles and stay alone; rows that repeat an id are documents
    of their own; a null id is never linked and kept.
    """
    least = as_sure(COORDINATES, LEAST_MATCHES, threshold) if least is None else least
    fine = as_sure(FINE, LEAST_FINE, threshold)
    rows = materialize(signatures(docs))
    named = rows.where("n_shingles > 0 and doc_id is not null")
    keys = ["key1", "key2", "n_shingles"]
    classes = materialize(named.groupBy(*keys).agg(
        F.min("doc_id").alias("node"), F.min_by("signature", "doc_id").alias("signature")
    ))
    prefixes = materialize(prefix_postings(classes, least))
    full = materialize(full_sets(docs, prefixes))
    first = materialize(confirmed(head_pairs(prefixes), full, threshold, fine))
    so_far = materialize(components(first))
    rest = confirmed(materialize(crossing_pairs(prefixes, full, so_far, fine)), full, threshold, fine)
    labels = components(so_far.select(F.col("node").alias("a"), F.col("component").alias("b")).union(rest))
    of_class = classes.select(*keys, "node").join(labels, "node", "left").select(
        *keys, F.coalesce("component", "node").alias("component")
    )
    alone: Column = F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("component"))
    component = F.coalesce(alone, F.col("doc_id"))
    return rows.drop("signature").join(of_class, keys, "left").select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
