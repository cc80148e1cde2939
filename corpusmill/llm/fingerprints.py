"""Context-triggered piecewise hashing: fingerprints of texts whose likeness can be measured."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .hashing import POWERS, mix
from .tables import bounded_batches

ROLLING = 7
SMALLEST = 3
PIECES = 64
SIGNATURES = 3
# Two signatures without a common run of so many pieces have nothing in common.
COMMON = 4
# The 64 digits of base64.
DIGITS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)


def rolling(data: np.ndarray) -> np.ndarray:
    """For each byte a hash of it and the six before it."""
    wide = data.astype(np.uint32)
    total = np.zeros(len(data), np.uint32)
    for k in range(min(ROLLING, len(data))):
        weight = np.uint32(pow(0x01000193, k + 1, 1 << 32))
        total[k:] += (wide[: len(data) - k] + np.uint32(1)) * weight
    total ^= total >> np.uint32(15)
    total *= np.uint32(0x2C1B3C6D)
    return total ^ (total >> np.uint32(13))


def _signature(ends: np.ndarray, sums: np.ndarray, down: np.ndarray, size: int) -> str:
    """One digit for each piece; a piece ends before each place in `ends`, the last at `size`."""
    edges = np.concatenate([[0], ends, [size]] if not len(ends) or ends[-1] < size else [[0], ends])
    pieces = mix((sums[edges[1:]] - sums[edges[:-1]]) * down[edges[:-1]])
    return DIGITS[(pieces >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def fingerprint(data: bytes | np.ndarray) -> str:
    """`size:signature:signature:signature` of some bytes, for the size, twice and four times it.

    A piece ends where the rolling hash has remainder size-1 modulo the size. The size is the
    smallest of 3, 6, 12, ... at which there are at most 64 pieces, so all signatures cover
    the whole text. The empty text has no pieces.
    """
    data = np.frombuffer(data, np.uint8) if isinstance(data, bytes) else data
    if not len(data):
        return f"{SMALLEST}" + ":" * SIGNATURES
    hashes = rolling(data)
    up, down = POWERS.upto(len(data) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])])
    size, ends = SMALLEST, np.arange(len(data))
    kept = hashes
    found = []
    while True:
        # a remainder of 2*size-1 modulo 2*size is one of size-1 modulo size: each step thins the last
        inside = kept % np.uint32(size) == size - 1
        ends, kept = ends[inside], kept[inside]
        if len(ends) < PIECES:
            found.append(_signature(ends + 1, sums, down, len(data)))
            if len(found) == SIGNATURES:
                return ":".join([str(size // 2 ** (SIGNATURES - 1)), *found])
        size *= 2


def common_lengths(pairs: list[tuple[str, str]]) -> np.ndarray:
    """Lengths of the longest common subsequences, all pairs at once, one bit per piece."""
    n = len(pairs)
    if not n:
        return np.zeros(0, np.int64)
    one, two = (np.zeros((n, PIECES), np.uint8) for _ in range(2))
    for i, (x, y) in enumerate(pairs):
        one[i, : len(x)] = np.frombuffer(x.encode(), np.uint8)
        two[i, : len(y)] = np.frombuffer(y.encode(), np.uint8)
    bits = np.uint64(1) << np.arange(PIECES, dtype=np.uint64)
    row = np.full(n, ~np.uint64(0))
    for k in range(PIECES):
        own = two[:, k]
        live = own != 0
        if not live.any():
            break
        hits = ((one == own[:, None]) & live[:, None]) @ bits
        taken = row & hits
        row = np.where(live, (row + taken) | (row - taken), row)
    return PIECES - np.bitwise_count(row).astype(np.int64)


def likenesses(left: list[str], right: list[str]) -> np.ndarray:
    """How alike fingerprints are, from 0 to 1.

    Signatures are compared where their sizes agree; the best one counts. The likeness is 1 less the edit distance (insertions
    and deletions) as a share of both lengths; 0 without a common run of four pieces, or of all
    if there are fewer; 1 for equal fingerprints, those of empty texts among them.
    """
    pairs, owner = [], []
    best = np.zeros(len(left))
    for i, (a, b) in enumerate(zip(left, right)):
        if a == b:
            best[i] = 1.0
            continue
        (m, *a_own), (n, *b_own) = a.split(":"), b.split(":")
        at = {int(m) << k: x for k, x in enumerate(a_own)}
        ways = [(at[int(n) << k], y) for k, y in enumerate(b_own) if int(n) << k in at]
        for x, y in ways:
            run = min(COMMON, len(x), len(y))
            if run and {x[k : k + run] for k in range(len(x) - run + 1)} & {y[k : k + run] for k in range(len(y) - run + 1)}:
                pairs.append((x, y))
                owner.append(i)
    lengths = np.array([len(x) + len(y) for x, y in pairs], float)
    if pairs:
        np.maximum.at(best, owner, 2 * common_lengths(pairs) / lengths)
    return best


def half_replaced(text: str, other: str) -> str:
    """`text` with its last floor(n/2) characters replaced by the first as many of `other`."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def in_order(docs: DataFrame) -> DataFrame:
    """(bucket, extra, doc_id, text), each partition sorted by all of them.

    Buckets hold documents with following ids, a null id first. The first rows of a bucket are
    also put at the end of the bucket before (extra), and those of the first bucket at the end
    of the last, so that every document finds its successor in its own bucket and texts are
    shuffled once. There are as many buckets as shuffle partitions; only their bounds and first
    ids go through the driver.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("ord"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / n for k in range(1, n)]
    found = rows.where("doc_id is not null").approxQuantile("ord", shares, 0.1 / n) if shares else []
    bounds = np.unique(np.array(found, dtype=np.float64).astype(np.int64))

    @F.pandas_udf("int")
    def bucket_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.to_numpy(), "right"), dtype="int32")

    placed = rows.withColumn("bucket", bucket_of("ord"))
    heads = placed.select("bucket", "ord").groupBy("bucket").agg(F.min("ord").alias("ord")).orderBy("bucket").collect()
    before = {h["ord"]: heads[i - 1]["bucket"] for i, h in enumerate(heads)}

    @F.pandas_udf("array<int>")
    def buckets_of(ids: pd.Series) -> pd.Series:
        own = np.searchsorted(bounds, ids.to_numpy(), "right")
        return pd.Series([[b, before[i]] if i in before else [b] for b, i in zip(own.tolist(), ids.tolist())])

    dealt = rows.select("*", F.posexplode(buckets_of("ord")).alias("extra", "bucket"))
    keys = ["bucket", "extra", "ord", "text"]
    return dealt.repartition(n, "bucket").sortWithinPartitions(*keys).select("bucket", "extra", "doc_id", "text")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every whole text, of its edited text, and their likeness.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).
    The edited text is `half_replaced` by the text of the next document in ascending order of
    id; after the last comes the first, so a single document is its own successor. Null texts
    are empty; rows that repeat an id follow each other by text; a null id comes first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # the last row so far: its successor is yet to come
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("bucket", "extra", "doc_id", "text"))))
            prints = [fingerprint(text.encode()) for *_, text in rows]
            held += [(*row, own) for row, own in zip(rows, prints)]
            yield _compared(held)
            held = held[-1:]

    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return in_order(docs).mapInArrow(run, schema)


def _compared(rows: list[tuple]) -> pa.RecordBatch:
    """A result for all rows but the last and the copies at a bucket's end."""
    ids, sizes, hashes, own, edited, following = [], [], [], [], [], []
    for (bucket, extra, doc_id, text, mark), (next_bucket, _, _, next_text, next_mark) in zip(rows, rows[1:]):
        if extra:
            continue
        if bucket != next_bucket:
            raise ValueError(f"bucket {bucket} ends without its successor")
        new = half_replaced(text, next_text).encode()
        ids.append(doc_id)
        sizes.append(len(text))
        hashes.append(hashlib.sha256(new).hexdigest())
        own.append(mark)
        edited.append(fingerprint(new))
        following.append(next_mark)
    columns = [
        pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(hashes, pa.string()),
        pa.array(own, pa.string()), pa.array(edited, pa.string()),
        pa.array(likenesses(own, edited)), pa.array(likenesses(own, following)),
    ]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return pa.RecordBatch.from_arrays(columns, names)
