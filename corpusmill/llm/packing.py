"""Packing documents into training sequences by multiway number partitioning."""

from __future__ import annotations

import heapq
import json
import os
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from ..session import materialize
from .hashing import Chunk, chunks, words
from .tables import per_batch

CAPACITY = 4096
END_ID = 2
# Windows of one group: padding is below one or two windows a group, work grows with their number.
GROUP_WINDOWS = 256
# Pieces of one group: differencing holds a row of windows for each, 128 MB in all.
GROUP_PIECES = 65_536
# What is left of a document beside full windows is cut into pieces of this length: windows of
# four or more pieces come out nearly equal, which those of one or two whole texts cannot.
PIECE = 1024
# Words whose ids a Python worker keeps, about 40 bytes each.
CACHED = 1_000_000
JOINED = 100
# What normalises and cuts words in tokenizers whose plain words are cut and lower-cased here.
SPELLING = {
    "normalizer": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
    "cut": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+",
}
LETTER, DIGIT, MARK = 1, 2, 3
_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = MARK
_KIND[0x30:0x3A] = DIGIT
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = LETTER
_KIND[[ord("'"), ord("<")]] = 0  # parts of contractions and of special tokens


def kinds(data: np.ndarray) -> np.ndarray:
    """Of each byte of texts whether it belongs to a letter of A-Z, a-z, U+00C0-U+00FF, a digit or an ASCII mark; else 0."""
    out = _KIND[data]
    lead = np.flatnonzero(data == 0xC3)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]  # multiplication and division signs
    out[lead] = out[lead + 1] = LETTER
    return out


def plain_tokenizer(path: str) -> Tokenizer | None:
    """The tokenizer of a file for text that is lower-case and cut already; None if it cuts in another way than SPELLING."""
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    model, special = whole["model"], [token["content"] for token in whole.get("added_tokens") or []]
    cut, spell = ((whole.get(step) or {}).get(inner) or [{}] for step, inner in (("pre_tokenizer", "pretokenizers"), ("normalizer", "normalizers")))
    fits = spell == SPELLING["normalizer"] and len(cut) == 2 and cut[0] == {
        "type": "Split", "pattern": {"Regex": SPELLING["cut"]}, "behavior": "Removed", "invert": True
    } and cut[1]["type"] == "ByteLevel" and not cut[1]["add_prefix_space"] and not cut[1].get("use_regex", True)
    if not fits or model["type"] != "BPE" or model.get("end_of_word_suffix") != "</w>" or not all("<" in t for t in special):
        return None
    whole |= {"normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, cut[1]]}}
    return Tokenizer.from_str(json.dumps(whole))


class Known(NamedTuple):
    """Ids of words: the words' sorted hashes, and for each where its ids begin in `table` and how many they are."""

    keys: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    table: np.ndarray

    def place(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each hash stands, and whether it is there at all."""
        at = np.searchsorted(self.keys, hashes)
        return at, self.keys[np.minimum(at, len(self.keys) - 1)] == hashes if len(self.keys) else np.zeros(len(at), bool)

    def only(self, at: np.ndarray) -> Known:
        lengths = self.lengths[at]
        ends = np.cumsum(lengths)
        ids = self.table[np.repeat(self.starts[at] - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)]
        return Known(self.keys[at], ends - lengths, lengths, ids)

    def extended(self, keys: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> Known:
        """With words that were not there, in any order."""
        order = np.argsort(keys)
        keys, starts, lengths = keys[order], (len(self.table) + np.cumsum(lengths) - lengths)[order], lengths[order]
        at = np.searchsorted(self.keys, keys)
        columns = zip((self.keys, self.starts, self.lengths), (keys, starts, lengths))
        return Known(*(np.insert(own, at, more) for own, more in columns), np.concatenate([self.table, ids]))


class WordTokenizer:
    """Token ids of texts, by a tokenizer that drops white space.

    Texts are cut at ASCII white space, across which such a tokenizer neither merges nor
    normalises, so every distinct word of a chunk is looked up or encoded once, under its 64-bit
    hash. What words come to is kept; when there are too many, only those of the present chunk are.
    Words of common letters, digits and marks are lower-cased and cut here, many at once, and only
    merged by the tokenizer.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.plain = plain_tokenizer(path)
        self.closes = np.zeros(self.tokenizer.get_vocab_size(), bool)  # tokens that end what is cut
        for token, at in self.tokenizer.get_vocab().items():
            self.closes[at] = token.endswith("</w>")
        self.known = Known(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4"))

    def _of_words(self, hashes: np.ndarray, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> Known:
        """The ids of at least these distinct words; a word is `data[begin:end]`."""
        at, there = self.known.place(hashes)
        rest = np.flatnonzero(~there)
        if not len(rest):
            return self.known
        if len(self.known.keys) + len(rest) > CACHED:
            self.known = self.known.only(at[there])
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if self.plain is not None:
            kind = kinds(data)
            others = np.concatenate([[0], np.cumsum(kind == 0)])
            simple = others[end[rest]] == others[begin[rest]]
            found = self._merged(data, kind, begin[rest[simple]], end[rest[simple]]) if simple.any() else None
            if found is not None:
                parts.append((hashes[rest[simple]], *found))
                rest = rest[~simple]
        if len(rest):
            text = data.tobytes()
            own = list(self._encoded([text[lo:hi].decode() for lo, hi in zip(begin[rest].tolist(), end[rest].tolist())]))
            lengths = np.fromiter(map(len, own), np.int64, len(own)) // 4
            parts.append((hashes[rest], lengths, np.frombuffer(b"".join(own), "<u4")))
        self.known = self.known.extended(*(np.concatenate(column) for column in zip(*parts)))
        return self.known

    def _merged(
        self, data: np.ndarray, kind: np.ndarray, begin: np.ndarray, end: np.ndarray,
    ) -> tuple[np.ndarray, np.ndarray] | None:
        """How many ids words have whose bytes are all of some kind, and these ids; None if the tokenizer left out any part.

        A part is a run of letters, a digit or a run of marks. Parts are set apart by spaces, and each
        ends with its only token that closes.
        """
        lengths = end - begin
        first = np.cumsum(lengths) - lengths
        at = np.repeat(begin - first, lengths) + np.arange(int(lengths.sum()))
        own = kind[at]
        opens = own == DIGIT
        opens[1:] |= own[1:] != own[:-1]
        opens[first] = True
        spaces = np.cumsum(opens)
        spaced = np.full(len(at) + int(spaces[-1]), 0x20, np.uint8)
        spaced[np.arange(len(at)) + spaces] = data[at]
        cuts = first[::JOINED] + spaces[first[::JOINED]] - 1
        cuts = [*cuts.tolist(), len(spaced)]
        lines = [spaced[lo:hi].tobytes().decode().lower() for lo, hi in zip(cuts, cuts[1:])]
        ids = np.concatenate([np.array(e.ids, "<u4") for e in self.plain.encode_batch_fast(lines, add_special_tokens=False)])
        closed = np.flatnonzero(self.closes[ids]) + 1
        if len(closed) != spaces[-1]:
            return None
        return np.diff(closed[np.append(spaces[first[1:]] - 1, spaces[-1]) - 1], prepend=0), ids

    def _encoded(self, spelt: list[str]) -> Iterator[bytes]:
        """The ids of each word: JOINED words are encoded at once, and ids go to the word they begin in."""
        lines = [spelt[at : at + JOINED] for at in range(0, len(spelt), JOINED)]
        encodings = self.tokenizer.encode_batch([" ".join(line) for line in lines], add_special_tokens=False)
        for line, encoding in zip(lines, encodings):
            ids = np.array(encoding.ids, "<u4").tobytes()
            begins = np.fromiter((offset[0] for offset in encoding.offsets), np.int64)
            ends = np.cumsum(np.fromiter(map(len, line), np.int64, len(line)) + 1)
            edges = (4 * np.searchsorted(begins, ends)).tolist()
            yield from (ids[lo:hi] for lo, hi in zip([0, *edges], edges))

    def ids(self, chunk: Chunk) -> list[bytes]:
        """For each text of a chunk its ids, 4 bytes each."""
        own = words(chunk, fold=False)
        distinct, place, inverse = np.unique(own.hashes, return_index=True, return_inverse=True)
        known = self._of_words(distinct, chunk.data, own.begin[place], own.end[place])
        at = known.place(distinct)[0]
        # the ids of word after word: its run in the table, moved to where it stands in the texts
        counts = known.lengths[at][inverse]
        ends = np.cumsum(counts)
        moved = known.starts[at][inverse] - (ends - counts)
        ids = known.table[np.repeat(moved, counts) + np.arange(int(ends[-1]) if len(ends) else 0)]
        edges = np.concatenate([[0], ends])[own.first]
        return [ids[lo:hi].tobytes() for lo, hi in zip(edges[:-1], edges[1:])]


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of a file; each Python worker makes it once."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def cuts(n: int, capacity: int, piece: int) -> list[int]:
    """Where the pieces of n ids begin, and n: full windows first, then pieces."""
    full = n - n % capacity
    return [*range(0, full, capacity), *range(full, n, piece), n]


def token_pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, piece: int = PIECE,
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): every document cut into pieces.

    A document's ids are those of its whole text and `end_id`. As many pieces as possible have
    `capacity` ids, the rest `piece` ids, and the last one what is left. Null and empty texts
    have the end alone.
    """

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, end = tokenizer(path), np.array([end_id], "<u4").tobytes()
        rows, starts, lengths, sums, totals = [], [], [], [], []
        for chunk in chunks(batch.column("text")):
            for i, ids in enumerate(own.ids(chunk), chunk.first):
                ids += end
                edges = cuts(len(ids) // 4, capacity, piece)
                for lo, hi in zip(edges, edges[1:]):
                    rows.append(i)
                    starts.append(lo)
                    lengths.append(hi - lo)
                    sums.append(zlib.crc32(ids[4 * lo : 4 * hi]))
                    totals.append(edges[-1])
        columns = [pa.array(c, pa.int64()) for c in (starts, lengths, sums, totals)]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(rows, pa.int64())), *columns],
            ["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
        )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return per_batch(rows, make, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def karmarkar_karp(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window of each item, with sums as near to equal as differencing gets them.

    Every item starts as a partial partition with all of its size in one window. The two
    partitions with the largest differences between their windows are merged again and again,
    the fullest window of one with the emptiest of the other, so that imbalances oppose.
    """
    n = len(sizes)
    if n <= windows:
        return np.arange(n)
    # a partial partition: its sums, smallest first, and which nodes make up each window
    start = np.zeros((n, windows), np.int64)
    start[:, -1] = sizes
    heap = [(-int(size), i) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    sums = dict(enumerate(start))
    parts: dict[int, tuple[int, int, np.ndarray]] = {}
    number = n
    while len(heap) > 1:
        one, two = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        total = sums.pop(one) + sums.pop(two)[::-1]
        order = np.argsort(total, kind="stable")
        total = total[order]
        sums[number] = total - total[0]
        parts[number] = one, two, order
        heapq.heappush(heap, (-int(total[-1] - total[0]), number))
        number += 1
    # from the whole down to the items: which window of the end each window of a part belongs to
    place = {number - 1: np.arange(windows)}
    out = np.empty(n, np.int64)
    for node in range(number - 1, n - 1, -1):
        one, two, order = parts[node]
        own = np.empty(windows, np.int64)
        own[order] = place.pop(node)
        for child, at in ((one, own), (two, own[::-1])):
            if child < n:
                out[child] = at[-1]
            else:
                place[child] = at
    return out


def balanced_windows(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The window of each item; one window more as long as any holds more than `capacity`."""
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        out = karmarkar_karp(sizes, windows)
        if np.bincount(out, weights=sizes).max() <= capacity:
            return out
        windows += 1


def pack(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, piece: int = PIECE,
    group_windows: int = GROUP_WINDOWS, group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """Pieces of documents in sequences of at most `capacity` tokens.

    (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): the ids start ..
    start+length-1 of the document stand in the sequence from `offset` on. Documents are cut by
    `cuts`, and full pieces are sequences of their own. The others are dealt
    by a hash, which takes in the place of a row, into groups of about `group_windows` sequences
    and no more than about `group_pieces` pieces, whose windows are balanced by Karmarkar-Karp differencing. A sequence's pieces follow each other from 0 without gaps. Null
    and empty texts have one token, the end. Rows that repeat a doc_id are documents of their own.
    """
    pieces = materialize(token_pieces(docs, path, capacity, end_id, piece))
    sums = pieces.agg(F.sum("length").alias("tokens"), F.count("*").alias("pieces")).first()
    groups = max(1, -(-(sums["tokens"] or 0) // (group_windows * capacity)), -(-sums["pieces"] // group_pieces))
    # rows that are equal in everything get into different groups by their place in what was stored
    place_of_row = F.monotonically_increasing_id()
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", place_of_row), F.lit(groups)))

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "start", "ids_crc32"], kind="stable", ignore_index=True)
        sizes = rows["length"].to_numpy()
        full = sizes == capacity
        window = np.empty(len(rows), np.int64)
        window[full] = np.arange(full.sum())
        if not full.all():
            window[~full] = full.sum() + balanced_windows(sizes[~full], capacity)
        rows["sequence_id"] = rows["group"] * (1 << 24) + window
        rows["offset"] = rows.groupby(window)["length"].cumsum() - rows["length"]
        return rows.drop(columns="group")

    schema = (
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )
    return dealt.groupBy("group").applyInPandas(place, schema)
