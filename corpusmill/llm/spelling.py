"""Spelling variants: words one edit apart, found by walking a trie that is a table of edges."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .tables import bounded_batches

RUN = re.compile("[A-Za-zÀ-ÿ]+")
PIECE = 1 << 20
# Words a task holds before it hands on what it counted.
HELD = 200_000
SHORTEST = 6
LEAST = 5
FACTOR = 5
# One run in so many loses a code point.
DAMAGE = 199


def run_counts(text: str) -> Counter:
    """How often each run of letters stands in a text, with A-Z as a-z."""
    folded = text.encode().lower().decode()  # bytes know the case of A-Z only
    if len(folded) <= PIECE:
        return Counter(RUN.findall(folded))
    found: Counter = Counter()
    start = 0
    while start < len(folded):
        end = min(start + PIECE, len(folded))
        run = RUN.match(folded, end)
        end = run.end() if run else end
        found.update(RUN.findall(folded, start, end))
        start = end
    return found


def damaged(run: str, seed: int) -> str:
    """`run`, without one code point if the crc32 of it after the hashed prefix `seed` is a multiple of DAMAGE."""
    h = zlib.crc32(run.encode(), seed)
    if h % DAMAGE:
        return run
    place = h % len(run)
    return run[:place] + run[place + 1 :]


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", damage: bool = False) -> DataFrame:
    """(word, n): the words of all texts and how often they occur; null texts have none, a null id is ''.

    Tasks count before they hand on, so frequent words are few rows. With `damage`, one run in
    199 of a document loses a code point, so that variants are known to be there.
    """

    def rows_of(counted: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counted), pa.string()), pa.array(list(counted.values()), pa.int64())], names=["word", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for own, whole in zip(batch.column(0), batch.column(1)):
                whole = whole.as_py()
                if not whole:
                    continue
                seed = zlib.crc32(f"{own.as_py() or ''}:".encode())
                for word, n in run_counts(whole).items():
                    if damage:
                        word = damaged(word, seed)
                    if len(word) >= SHORTEST:
                        held[word] += n
                if len(held) >= HELD:
                    yield rows_of(held)
                    held = Counter()
        yield rows_of(held)

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("string"), F.col(text).cast("string"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _node(side: Column, prefix: Column) -> Column:
    """A node of the trie is the prefix that leads to it, by its hash."""
    return F.xxhash64(side, prefix)


def _start(size: Column, side: Column) -> Column:
    """How much of a spelling has to agree before an edit: half a word, from its front (side 0) or its back."""
    half = F.floor(size / 2).cast("int")
    return F.when(side == 0, half).otherwise(size - half)


def _spelt(word: Column, side: Column) -> Column:
    return F.when(side == 0, word).otherwise(F.reverse(word))


def trie_edges(spellings: DataFrame) -> DataFrame:
    """(node, label, child, end): the edges of the tries of (side, spelling); end tells whether one ends at the child.

    Only nodes that matter are kept: where spellings part or end, and where walks start. All
    in between are runs of letters on one edge, so a walk takes as many steps as there are
    such nodes on its way, not as many as there are letters. Places of a spelling carry its
    hashes, not the spelling, so that long words do not make squares of letters.
    """
    side, size = F.col("side"), F.length("spelling")
    keys = {"one": F.xxhash64("spelling"), "two": F.crc32("spelling")}
    # every place from the earliest start on can be a node
    places = spellings.withColumns({"start": _start(size, side), **keys}).withColumn("at", F.explode(F.sequence("start", size)))
    named = places.select(
        "side", "one", "two", "at", _node(side, F.expr("substring(spelling, 1, at)")).alias("node"),
        F.expr("substring(spelling, at + 1, 1)").alias("next"), F.col("at").isin(F.col("start"), size).alias("sure"),
    )
    kept = named.groupBy("node").agg((F.bool_or("sure") | (F.min("next") != F.max("next"))).alias("kept")).where("kept")
    stops = named.join(kept.select("node"), "node").groupBy("side", "one", "two").agg(
        F.sort_array(F.collect_list(F.struct("at", "node"))).alias("stops")
    )
    pairs = stops.withColumn("p", F.explode(F.arrays_zip(
        F.expr("slice(stops, 1, size(stops) - 1)").alias("a"), F.expr("slice(stops, 2, size(stops) - 1)").alias("b")
    ))).drop("stops")
    edges = spellings.withColumns(keys).join(pairs, ["side", "one", "two"]).select(
        F.col("p.a.node").alias("node"),
        F.expr("substring(spelling, p.a.at + 1, p.b.at - p.a.at)").alias("label"),
        F.col("p.b.node").alias("child"), (F.col("p.b.at") == size).alias("end"),
    )
    return edges.groupBy("node", "label", "child").agg(F.bool_or("end").alias("end"))


def near_words(words: DataFrame) -> DataFrame:
    """(word, near): all pairs of words, both ways, that differ by one inserted, deleted or replaced code point.

    One edit leaves the front or the back half of a word as it is. So every word starts twice:
    in the trie of all words at the node of its front half, and in the trie of all words spelt
    backwards at the node of its back half. From there the frontier of states (word, position,
    node, edits) is joined with the edges, step by step. An edge is followed if its label agrees
    with the word, or, if nothing was edited so far, with one letter replaced or one letter of
    the word left out. States at the end of their word, at the end of another word and with one
    edit are neighbours. Of two words of one length only the smaller looks for the other, of two
    lengths the longer, so the frontier is half as large. Nodes are known by a hash; what was
    found is compared once more as text.
    """
    spellings = words.withColumn("side", F.explode(F.array(F.lit(0), F.lit(1)))).select(
        "side", _spelt(F.col("word"), F.col("side")).alias("spelling")
    )
    edges = materialize(trie_edges(spellings))
    size = F.length("spelling")
    frontier = spellings.withColumn("at", _start(size, F.col("side"))).select(
        "side", "spelling", "at", _node(F.col("side"), F.expr("substring(spelling, 1, at)")).alias("node"), F.lit(0).alias("edits"),
    )
    used, label = F.length("label"), F.col("label")
    own, longer = F.expr("substring(spelling, at + 1, length(label))"), F.expr("substring(spelling, at + 1, length(label) + 1)")
    agree = own == label
    fresh = (F.col("edits") == 0) & ~agree
    replaced = fresh & (F.length(own) == used) & (own < label) & (F.levenshtein(own, label, 1) == 1)
    left_out = fresh & (F.length(longer) == used + 1) & (F.levenshtein(longer, label, 1) == 1)

    def state(here: Column, more: int, edits: Column) -> Column:
        return F.when(here, F.struct((F.col("at") + used + more).alias("at"), edits.alias("edits")))

    states = F.array_compact(F.array(
        state(agree, 0, F.col("edits")), state(replaced, 0, F.lit(1)), state(left_out, 1, F.lit(1))
    ))
    found = None
    while True:
        moved = materialize(frontier.join(edges, "node").select("side", "spelling", "child", "end", F.explode(states).alias("s")).select(
            "side", "spelling", F.col("s.at").alias("at"), F.col("child").alias("node"), F.col("s.edits").alias("edits"),
            # with an edit the end of both words, else all but the last letter, which is left out
            (F.col("end") & (F.col("s.at") + 1 - F.col("s.edits") == size)).alias("found"),
        ))
        ends = moved.where("found").select("side", "spelling", "node")
        found = ends if found is None else found.union(ends)
        frontier = moved.where(F.col("at") < size).drop("found")
        if frontier.isEmpty():
            break
    names = spellings.select(_node(F.col("side"), F.col("spelling")).alias("node"), F.col("spelling").alias("other"))
    pairs = found.join(names, "node").where(F.levenshtein("spelling", "other", 1) == 1).select(
        *[_spelt(F.col(c), F.col("side")).alias(n) for c, n in (("spelling", "word"), ("other", "near"))]
    )
    return pairs.union(pairs.select(F.col("near").alias("word"), F.col("word").alias("near"))).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where following (word, form) from each word ends, in steps that double.

    A form occurs several times as often as its word, so ways are short and never meet again.
    """
    ways = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = materialize(ways.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"))
        ways = jumped.select("word", "root")
        if jumped.where("next is not null").isEmpty():
            return ways


def spelling_variants(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST, factor: int = FACTOR, damage: bool = False,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word with at least six letters and `least` occurrences.

    Two words are near if one edit makes one the other. A word's form is its most frequent near
    word (the smallest of equals), if that occurs `factor` times as often as the word; its root
    is where following the forms ends. Null and empty texts have no words, rows that repeat an
    id are texts of their own, and a text without id counts like the others.
    """
    words = materialize(word_counts(docs, doc_id, text, damage).where(F.col("n") >= least))
    near = near_words(words.select("word")).join(words.select(F.col("word").alias("near"), "n"), "near")
    best = near.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("minus"), F.col("near").alias("form"))).alias("best")
    )
    much = -F.col("best.minus") >= factor * F.col("n")
    judged = materialize(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(much, F.col("best.form")).alias("form"), F.when(much, -F.col("best.minus")).alias("form_n"),
    ))
    ends = roots(judged.where("form is not null"))
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
