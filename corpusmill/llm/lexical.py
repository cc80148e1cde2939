"""Ranked lexical search: many queries at once, their shared term sets scored once per document."""

from __future__ import annotations

import heapq
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialize
from .tables import bounded_batches, per_batch

K = 10
# A block of queries is answered by one pass over the texts; its terms travel with the tasks.
BLOCK_QUERIES = 1024
BLOCK_TERMS = 65_536
# Pairs of terms are counted within buckets of about so many terms of a query.
BUCKET = 64
# Values that a task holds while it combines accumulators.
CELLS = 1 << 21
PIECE = 1 << 20
SALTS = 32

_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")


def term_counts(text: bytes | None) -> Counter:
    """How often each term stands in a text: letters and digits of ASCII and all that is beyond, A-Z as a-z."""
    data = (text or b"").lower()  # bytes know the case of A-Z only
    if len(data) <= PIECE:
        return Counter(_TERM.findall(data))
    found: Counter = Counter()
    start = 0
    while start < len(data):
        gap = _GAP.search(data, start + PIECE)
        end = gap.start() if gap else len(data)
        found.update(_TERM.findall(data, start, end))
        start = end
    return found


class Sharing(NamedTuple):
    """Sums of term scores shared by queries: node i < len(terms) is a term, node len(terms)+j the sum of left[j] and right[j].

    The score of query q is the sum of the nodes parts[q].
    """

    terms: list[bytes]
    left: list[int]
    right: list[int]
    parts: list[list[int]]


def shared_sums(queries: Iterable[dict[bytes, int]]) -> Sharing:
    """Mines term sets that stand in several queries, the pair in most queries first.

    Such a pair becomes a node in all of them, which can be paired again, so larger sets are
    built from smaller ones. The second occurrence of a term in a query is an element of its
    own. Pairs are counted within buckets of a hash, so a long query does not make all pairs
    of its terms.
    """
    queries = list(queries)
    terms = sorted({t for q in queries for t in q})
    place = {t: i for i, t in enumerate(terms)}
    names: dict[tuple[int, int], int] = {}
    sets = [
        {names.setdefault((place[t], k), len(names)) for t, n in sorted(q.items()) for k in range(n)} for q in queries
    ]
    leaf = [t for t, _ in names]
    holders: dict[int, set[int]] = defaultdict(set)
    for q, own in enumerate(sets):
        for s in own:
            holders[s].add(q)
    widest = max((sum(len(holders[s]) > 1 for s in own) for own in sets), default=0)
    buckets = max(1, -(-widest // BUCKET))
    bucket = [zlib.crc32(terms[t]) % buckets for t in leaf]

    def together(q: int, b: int) -> list[int]:
        return sorted(s for s in sets[q] if bucket[s] == b and len(holders[s]) > 1)

    seen: Counter = Counter()
    for q in range(len(sets)):
        groups = defaultdict(list)
        for s in sorted(s for s in sets[q] if len(holders[s]) > 1):
            groups[bucket[s]].append(s)
        for own in groups.values():
            seen.update((x, y) for i, x in enumerate(own) for y in own[i + 1 :])
    heap = [(-n, x, y) for (x, y), n in seen.items() if n > 1]
    heapq.heapify(heap)
    left, right = [], []
    while heap:
        n, x, y = heapq.heappop(heap)
        both = holders[x] & holders[y]
        if len(both) < 2:
            continue
        if len(both) < -n:
            heapq.heappush(heap, (-len(both), x, y))
            continue
        new = len(bucket)
        left.append(x)
        right.append(y)
        bucket.append(bucket[x])
        holders[x] -= both
        holders[y] -= both
        holders[new] = both
        mates: Counter = Counter()
        for q in both:
            sets[q] -= {x, y}
            mates.update(together(q, bucket[x]))
            sets[q].add(new)
        for s, n in mates.items():
            if n > 1:
                heapq.heappush(heap, (-n, s, new))
    node = [*leaf, *range(len(terms), len(terms) + len(left))]
    return Sharing(
        terms, [node[x] for x in left], [node[y] for y in right], [sorted(node[s] for s in own) for own in sets]
    )


class Accumulators:
    """Evaluates a Sharing for many documents at once, level by level."""

    def __init__(self, sharing: Sharing) -> None:
        self.n_terms = len(sharing.terms)
        self.parts = [np.array(p, np.int64) for p in sharing.parts]
        depth = np.zeros(self.n_terms + len(sharing.left), np.int64)
        for j, (x, y) in enumerate(zip(sharing.left, sharing.right)):
            depth[self.n_terms + j] = 1 + max(depth[x], depth[y])
        left, right = np.array(sharing.left, np.int64), np.array(sharing.right, np.int64)
        self.levels = []
        for d in range(1, int(depth.max(initial=0)) + 1):
            nodes = np.flatnonzero(depth == d)
            self.levels.append((nodes, left[nodes - self.n_terms], right[nodes - self.n_terms]))
        self.size = len(depth)

    def scores(self, term: np.ndarray, doc: np.ndarray, value: np.ndarray, n_docs: int) -> np.ndarray:
        """Queries x documents, from the scores of terms in documents."""
        sums = np.zeros((self.size, n_docs), np.int64)
        sums[term, doc] = value
        for nodes, left, right in self.levels:
            sums[nodes] = sums[left] + sums[right]
        return np.stack([sums[p].sum(0) for p in self.parts])


def queries_of(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item_id, terms): the terms of each item with their counts, in order; items without terms are left out."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, terms, counts = [], [], []
        for i, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = term_counts(own)
            ids += [i] * len(found)
            terms += found.keys()
            counts += found.values()
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(terms, pa.binary()), pa.array(counts, pa.int64())],
            names=["item_id", "term", "n"],
        )

    rows = items.where(F.col(item_id).isNotNull()).select(F.col(item_id).cast("long"), F.col(text).cast("binary"))
    counted = per_batch(rows, make, "item_id long, term binary, n long").groupBy("item_id", "term").agg(F.sum("n").alias("n"))
    return counted.groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct("term", "n"))).alias("terms"))


def occurrences(docs: DataFrame, terms: list[bytes], doc_id: str, text: str) -> DataFrame:
    """(doc_id, n, term, tf) of every text with a term: all its terms counted, places in `terms` of those it holds, how often."""
    place = {t: i for i, t in enumerate(terms)}

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep, sizes, ends, places, times = [], [], [0], [], []
        for row, own in enumerate(batch.column(1)):
            found = term_counts(own.as_py())
            if not found:
                continue
            keep.append(row)
            sizes.append(found.total())
            mine = [(place[t], n) for t, n in found.items() if t in place]
            places += [p for p, _ in mine]
            times += [n for _, n in mine]
            ends.append(len(places))
        ends = pa.array(ends, pa.int32())
        return pa.RecordBatch.from_arrays([
            batch.column(0).take(pa.array(keep, pa.int64())), pa.array(sizes, pa.int64()),
            pa.ListArray.from_arrays(ends, pa.array(places, pa.int32())),
            pa.ListArray.from_arrays(ends, pa.array(times, pa.int32())),
        ], names=["doc_id", "n", "term", "tf"])

    rows = docs.select(F.col(doc_id).cast("long"), F.col(text).cast("binary"))
    return per_batch(rows, make, "doc_id long, n long, term array<int>, tf array<int>")


def _best(rows: list[np.ndarray], k: int) -> list[np.ndarray]:
    """The k best of each query of (query, score, no id, id), ordered; smaller ids first, none last."""
    query, score, none, ids = rows
    order = np.lexsort([ids, none, -score, query])
    query = query[order]
    keep = order[np.arange(len(query)) - np.searchsorted(query, query) < k]
    return [column[keep] for column in rows]


def best_documents(found: DataFrame, sharing: Sharing, names: list[int], k: int) -> DataFrame:
    """(query_id, doc_id, score): each task's k best documents of every query, from `occurrences`."""
    stats = found.agg(F.count("*"), F.sum("n")).first()
    n_docs, n_all = stats[0], stats[1] or 1
    df = np.zeros(len(sharing.terms), np.int64)
    for t, n in found.select(F.explode("term").alias("t")).groupBy("t").count().collect():
        df[t] = n
    weight = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
    n_queries = len(names)
    ids_of = np.array(names, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Accumulators(sharing)
        step = max(64, CELLS // max(sums.size, 1))
        best = [np.zeros(0, np.int64) for _ in range(4)]
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                rows = batch.num_rows
                n = batch.column("n").to_numpy()
                term, tf = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("term", "tf"))
                sizes = np.diff(batch.column("term").offsets.to_numpy())
                doc = np.repeat(np.arange(rows), sizes)
                m = 100 - 75 + (75 * n * n_docs) // n_all
                scores = sums.scores(term, doc, weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])), rows)
                floor = np.ones(n_queries, np.int64)
                full = np.bincount(best[0], minlength=n_queries) == k
                if full.any():
                    least = np.full(n_queries, np.iinfo(np.int64).max)
                    np.minimum.at(least, best[0], best[1])
                    floor[full] = np.maximum(least[full], 1)
                query, doc = np.nonzero(scores >= floor[:, None])
                none = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
                ids = batch.column("doc_id").fill_null(0).to_numpy()
                new = [query, scores[query, doc], none[doc].astype(np.int64), ids[doc]]
                best = _best([np.concatenate(pair) for pair in zip(best, new)], k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids_of[best[0]]), pa.array(best[3], pa.int64(), mask=best[2] == 1), pa.array(best[1])],
            names=["query_id", "doc_id", "score"],
        )

    return found.mapInArrow(run, "query_id long, doc_id long, score long")


def ranked_documents(
    docs: DataFrame, items: DataFrame, k: int = K, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
    block_queries: int = BLOCK_QUERIES, block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents for every item, equal scores by ascending id.

    Items with equal terms are one query. Queries are dealt into blocks of bounded size; a block
    is answered from one pass over all texts, which leaves each document's counts of the block's
    terms in the shared folder. From these come document frequencies, lengths and scores: every
    shared sum of term scores is made once for a document and used by all queries that hold it.

    Null and empty texts have no terms and count nowhere. Rows that repeat a doc_id are documents
    of their own, one without id comes last among equals; rows that repeat an item_id make up one
    item, and one without id is left out.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    wanted = materialize(queries_of(items, item_id, text))
    distinct = wanted.groupBy("terms").agg(F.min("item_id").alias("query_id"))
    total = distinct.agg(F.count("*").alias("n"), F.sum(F.size("terms")).alias("terms")).first()
    empty = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    if not total["n"]:
        return empty
    blocks = max(-(-total["n"] // block_queries), -(-total["terms"] // block_terms))

    def mine(table: pa.Table) -> pa.Table:
        own = sorted(zip(table["query_id"].to_pylist(), table["terms"].to_pylist()))
        sharing = shared_sums({e["term"]: e["n"] for e in terms} for _, terms in own)
        row = {"block": table["block"][0].as_py(), "query_id": [i for i, _ in own], **sharing._asdict()}
        return pa.Table.from_pylist([row], schema=shape)

    ints, many = pa.list_(pa.int64()), pa.list_(pa.list_(pa.int64()))
    shape = pa.schema({
        "block": pa.int32(), "query_id": ints, "terms": pa.list_(pa.binary()), "left": ints, "right": ints, "parts": many,
    })
    plans = materialize(
        distinct.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")).groupBy("block").applyInArrow(
            mine, "block int, query_id array<long>, terms array<binary>, left array<long>, right array<long>, parts array<array<long>>"
        )
    )
    best = None
    for block in range(blocks):
        plan = plans.where(F.col("block") == block).first()
        if plan is None:
            continue
        sharing = Sharing([bytes(t) for t in plan["terms"]], plan["left"], plan["right"], plan["parts"])
        found = materialize(occurrences(docs, sharing.terms, doc_id, text))
        own = best_documents(found, sharing, plan["query_id"], k)
        best = own if best is None else best.union(own)
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    salted = best.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "salt").orderBy(*order))).where(F.col("rank") <= k)
    top = few.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col("rank") <= k)
    named = wanted.join(distinct, "terms").select("item_id", "query_id")
    return named.join(top, "query_id").select("item_id", "rank", "doc_id", "score")


PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_FOLDED = f"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{PATTERN}')"
RANKED_SQL = f"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, {_FOLDED} AS terms FROM documents
), used AS (
    SELECT r, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM texts WHERE len(terms) > 0
), stats AS (
    SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_all FROM used
), wanted AS (
    SELECT item_id, term, CAST(count(*) AS BIGINT) AS c
    FROM (SELECT item_id, unnest({_FOLDED}) AS term FROM benchmark WHERE item_id IS NOT NULL) GROUP BY ALL
), held AS (
    SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(terms) AS term FROM used) GROUP BY ALL
), weighed AS (
    SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM held, stats GROUP BY term
), scored AS (
    SELECT item_id, r, any_value(doc_id) AS doc_id,
           CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_all)))) AS BIGINT) AS score
    FROM wanted JOIN held USING (term) JOIN weighed USING (term) JOIN used USING (r), stats
    GROUP BY item_id, r
), ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank, doc_id, score
    FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
