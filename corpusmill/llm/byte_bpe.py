"""Byte-level BPE by dynamic programming over prefixes."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .hashing import chunks
from .tables import per_batch

CACHED = 250_000


class Vocabulary:
    """Tokens by rank, which pairs they are merged from, and which pairs can stand side by side."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.merges: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self._pairs: dict[int, bool] = {}
        # A token is made by one merge: of the two lower ranks that can stand side by side as
        # long as only lower merges are made. Those are complete when it is this token's turn.
        for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None and max(left, right) < rank and self._stand(left, right):
                    self.merges[left, right] = rank
                    self.halves[rank] = left, right
                    break

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, "rb") as file:
            return cls({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)})

    def last_token(self, data: bytes, last: list[int], end: int) -> int:
        """The last token of the encoding of data[:end], given those of all shorter prefixes."""
        ranks, pairs, n = self.ranks, self._pairs, len(self.ranks)
        for start in range(max(0, end - self.longest), end):
            token = ranks.get(data[start:end])
            if token is None:
                continue
            if start == 0:
                return token
            pair = last[start - 1] * n + token
            stands = pairs.get(pair)
            if stands is None:
                if len(pairs) >= CACHED:
                    pairs.clear()
                stands = pairs[pair] = self._stand(last[start - 1], token)
            if stands:
                return token
        raise ValueError("the vocabulary lacks single bytes")

    def _stand(self, left: int, right: int) -> bool:
        """Undoes the merges of both tokens from the last one back, and looks at what then meets.

        If the tokens that meet at the border have a merge of their own that comes before the
        merges still to be made on either side, the border does not survive.
        """
        bound = 1 << 62
        while True:
            merged = self.merges.get((left, right))
            if merged is not None and merged < bound:
                return False
            ours, theirs = self.halves.get(left), self.halves.get(right)
            # of equal ranks the left one is made first, so the right one is undone first
            if ours is None and theirs is None:
                return True
            if theirs is None or ours is not None and left > right:
                bound, left = left, ours[1]
            else:
                # a merge of the same rank at the border comes earlier than the one on its right
                bound, right = right + 1, theirs[0]


class PrefixEncoder:
    """The encoding of a byte string that grows at its end.

    `last[i]` is the last token of the encoding of the first i+1 bytes. It is unique: of the
    tokens that end there, the one that can stand beside the last token of what precedes it. So
    appending bytes leaves all earlier entries as they are, and an edit needs new entries from
    the edited byte on only until they agree with the old ones again.
    """

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"") -> None:
        self.vocabulary = vocabulary
        self.data = b""
        self.last: list[int] = []
        self.append(data)

    def append(self, data: bytes) -> None:
        begin = len(self.data)
        self.data += data
        for end in range(begin + 1, len(self.data) + 1):
            self.last.append(self.vocabulary.last_token(self.data, self.last, end))

    def truncate(self, size: int) -> None:
        """Keeps the first `size` bytes."""
        self.data = self.data[:size]
        del self.last[size:]

    def replace(self, start: int, end: int, data: bytes) -> int:
        """Puts `data` in the place of bytes start .. end-1; returns how many entries it made anew.

        Once as many entries in a row as the longest token agree with the old ones behind the
        edit, all later ones agree too, for no token reaches further back.
        """
        old = self.last[end:]
        rest = self.data[end:]
        self.truncate(start)
        self.append(data)
        made, same = len(data), 0
        self.data += rest
        for i, before in enumerate(old):
            if same == self.vocabulary.longest:
                self.last += old[i:]
                break
            token = self.vocabulary.last_token(self.data, self.last, len(self.last) + 1)
            made += 1
            # an entry whose token reaches into the edit may agree by its rank alone
            same = same + 1 if token == before and len(self.vocabulary.tokens[token]) <= i + 1 else 0
            self.last.append(token)
        return made

    def tokens(self, end: int | None = None) -> list[int]:
        """The encoding of the first `end` bytes (of all)."""
        end, out = len(self.data) if end is None else end, []
        while end:
            out.append(self.last[end - 1])
            end -= len(self.vocabulary.tokens[out[-1]])
        return out[::-1]


class Encoder:
    """Encodes and decodes texts whose parts, the matches of a pattern, are encoded separately.

    What recent parts come to is kept, in two generations of bounded size.
    """

    def __init__(self, vocabulary: Vocabulary, pattern: str) -> None:
        self.vocabulary = vocabulary
        self.pattern = regex.compile(pattern)
        self.known: dict[str, tuple[int, str, bytes]] = {}
        self.older: dict[str, tuple[int, str, bytes]] = {}

    def _learn(self, parts: set[str]) -> None:
        """Encodes parts in byte order: each begins with the entries of what it shares with the last."""
        if len(self.known) + len(parts) > CACHED:
            self.known, self.older = {}, self.known
        missing = []
        for part in parts:
            if (found := self.older.get(part)) is not None:
                self.known[part] = found
            else:
                missing.append((part.encode(), part))
        prefix, tokens = PrefixEncoder(self.vocabulary), self.vocabulary.tokens
        for data, part in sorted(missing):
            shared = 0
            for x, y in zip(data, prefix.data):
                if x != y:
                    break
                shared += 1
            prefix.truncate(shared)
            prefix.append(data[shared:])
            ids = prefix.tokens()
            self.known[part] = len(ids), "".join([f" {i}" for i in ids]), b"".join([tokens[i] for i in ids])

    def digests(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Number of tokens, and SHA-256 of the ids as text and of what they decode to."""
        split = [self.pattern.findall(text) for text in texts]
        known = self.known
        new = {part for parts in split for part in parts if part not in known}
        if new:
            # a new generation may begin: then whatever these texts need is learnt again
            if len(known) + len(new) > CACHED:
                new = {part for parts in split for part in parts}
            self._learn(new)
            known = self.known
        out = []
        for parts in split:
            found = [known[part] for part in parts]
            ids = "".join([f[1] for f in found])[1:]
            decoded = b"".join([f[2] for f in found])
            out.append((
                sum([f[0] for f in found]), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest(),
            ))
        return out

    def encode(self, text: str) -> list[int]:
        return [i for part in self.pattern.findall(text) for i in PrefixEncoder(self.vocabulary, part.encode()).tokens()]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join([self.vocabulary.tokens[i] for i in ids])


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """The encoder of a file of ranks; each Python worker makes it once."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(Vocabulary.read(path), pattern)
    return _ENCODERS[path, pattern]


def byte_tokens(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text.

    `path` is a file of ranks, one base64 token and its rank per line, which every worker can
    read; each match of `pattern` is encoded by itself, without special tokens. Null and empty
    texts have no tokens; both hashes are then those of nothing. One row per row of `docs`.
    """

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = encoder(path, pattern)
        found: list[tuple[int, str, str]] = []
        for chunk in chunks(batch.column("text")):
            found += own.digests([
                chunk.data[lo:hi].tobytes().decode() for lo, hi in zip(chunk.starts[:-1], chunk.starts[1:])
            ])
        counts, ids, decoded = zip(*found) if found else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return per_batch(rows, make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
