"""Byte-level BPE: encoding by corpus-level merge replay, and decoding.

A batch of texts is cut into units at single spaces between two other characters, where
every match of the tokenizer's pattern ends. Units met before have their ids in a cache; the
pattern cuts the new ones into pieces, and the pieces of all of them together form a small
corpus over which the merges are replayed: an inverted index leads from a pair's rank to the
positions in all words where that pair stands; ranks are taken in order, every position of a
rank is merged, and only the two neighbours of a merged position are looked up again.

Nothing is shuffled: a text is encoded where it is read. The cache is emptied when it is
full, which costs time only.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import steps, text_of, utf8

CACHE_UNITS = 400_000


class MergeReplay:
    """Encoder and decoder of one rank file (base64 of a token's bytes, and its rank)."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.cache: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.pairs: dict[tuple[int, int], int | None] = {}

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        units = [_units(text) for text in texts]
        self.learn({u for of in units for u in of})
        return [b"".join(map(self.cache.__getitem__, of)) for of in units]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def learn(self, units: set[str]) -> None:
        """Put the ids of all ``units`` into the cache."""
        new = [u for u in units if u not in self.cache]
        if len(self.cache) + len(new) > CACHE_UNITS:
            self.cache.clear()
            new = list(units)
        cut = list(map(self.pattern.findall, new))
        pieces = {p for of in cut for p in of}
        unknown = [p for p in pieces if p not in self.pieces]
        if len(self.pieces) + len(unknown) > CACHE_UNITS:
            self.pieces.clear()
            unknown = list(pieces)
        ids = self.replay([p.encode() for p in unknown])
        self.pieces.update(zip(unknown, ids))
        for unit, of in zip(new, cut):
            self.cache[unit] = b"".join(map(self.pieces.__getitem__, of))

    def replay(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word after all merges, made in rank order over all words at once."""
        ranks, tokens, pairs = self.ranks, self.tokens, self.pairs
        if len(pairs) > 4 * CACHE_UNITS:
            pairs.clear()
        single = [ranks[bytes([b])] for b in range(256)]
        # One array of tokens for all words, as a chain: -1 ends a word, -2 is merged away.
        token: list[int] = [-1]
        begins = []
        for w in words:
            begins.append(len(token))
            if w in ranks:
                token.append(ranks[w])
            else:
                token += [single[b] for b in w]
            token.append(-1)
        right = list(range(1, len(token) + 1))
        left = list(range(-1, len(token) - 1))

        def joined(a: int, b: int) -> int:
            """Rank of the token that the bytes of both make together, or -1."""
            if a < 0 or b < 0:
                return -1
            rank = pairs[a, b] = ranks.get(tokens[a] + tokens[b], -1)
            return rank

        index: dict[int, list[int]] = {}
        for i, pair in enumerate(zip(token, token[1:])):
            rank = pairs[pair] if pair in pairs else joined(*pair)
            if rank >= 0:
                if rank in index:
                    index[rank].append(i)
                else:
                    index[rank] = [i]
        queue = list(index)
        heapq.heapify(queue)
        while queue:
            rank = heapq.heappop(queue)
            places = index.pop(rank)
            places.sort()
            held = -1  # up to here, a lower rank of the same word comes first
            for i in places:
                a = token[i]
                j = right[i]
                if a < 0 or pairs.get((a, token[j]), -1) != rank:
                    continue
                if i < held:
                    if rank not in index:
                        index[rank] = []
                        heapq.heappush(queue, rank)
                    index[rank].append(i)
                    continue
                k = right[j]
                token[i], token[j] = rank, -2
                right[i], left[k] = k, i
                h = left[i]
                for at, pair in ((h, (token[h], rank)), (i, (rank, token[k]))):
                    low = pairs[pair] if pair in pairs else joined(*pair)
                    if low >= 0:
                        if low in index:
                            index[low].append(at)
                        else:
                            index[low] = [at]
                            heapq.heappush(queue, low)
                        if low < rank:
                            held = token.index(-1, i)
        found = []
        for i in begins:
            ids = []
            while token[i] != -1:
                ids.append(token[i])
                i = right[i]
            found.append(array("I", ids).tobytes())
        return found

def _units(text: str) -> list[str]:
    """``text`` cut before each single space that stands between two other characters."""
    chunks = text.split(" ")
    if _even(chunks):
        return [chunks[0], *map(" ".__add__, chunks[1:])]
    first, *rest = chunks
    units = [first]
    for chunk in rest:
        before = units[-1]
        if chunk and not chunk[0].isspace() and before and not before[-1].isspace():
            units.append(" " + chunk)
        else:
            units[-1] = f"{before} {chunk}"
    return units


def _even(chunks: list[str]) -> bool:
    """Whether each space between the chunks of a text stands between two other characters."""
    return "" not in chunks and list(map(str.strip, chunks)) == chunks


_coders: dict[tuple[str, str], MergeReplay] = {}


def coder(path: str, pattern: str) -> MergeReplay:
    """One coder for each Python worker and vocabulary."""
    if (path, pattern) not in _coders:
        _coders[path, pattern] = MergeReplay(path, pattern)
    return _coders[path, pattern]


def _rows(texts: pa.Array):
    """Lists of texts of bounded size."""
    _, offsets = utf8(texts)
    for first, last in steps(offsets):
        yield texts.slice(first, last - first).fill_null("").to_pylist()


def encode(text: str | Column, path: str, pattern: str) -> Column:
    """Ids of a text as binary (little-endian unsigned 32-bit); null and empty: no ids."""

    @F.arrow_udf("binary")
    def ids(texts: pa.Array) -> pa.Array:
        replay = coder(path, pattern)
        return pa.array([x for rows in _rows(texts) for x in replay.encode(rows)], pa.binary())

    return ids.asNondeterministic()(text_of(text))


def decode(ids: str | Column, path: str, pattern: str) -> Column:
    """Bytes that ids as of ``encode`` stand for; null stays null."""

    @F.arrow_udf("binary")
    def data(ids: pa.Array) -> pa.Array:
        replay = coder(path, pattern)
        return pa.array([None if x is None else replay.decode(x) for x in ids.to_pylist()], pa.binary())

    return data(F.col(ids) if isinstance(ids, str) else ids)


def encode_digest(docs: DataFrame, path: str, pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256`` of each row: the ids, and what they decode to.

    One row for each row of ``docs``, in any order, repeated and null ids included; a null or
    empty text has no tokens. Encoding and decoding run in one pass over a batch, so that the
    ids don't leave the task.
    """

    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(texts: pa.Array) -> pa.Array:
        replay = coder(path, pattern)
        counts, of_ids, of_bytes = [], [], []
        for rows in _rows(texts):
            for ids in replay.encode(rows):
                counts.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_bytes.append(hashlib.sha256(replay.decode(ids)).hexdigest())
        columns = [pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())]
        return pa.StructArray.from_arrays(columns, ["n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(docs[id].alias("id"), text_of(docs[text]).alias("text"))
    rows = rows.select("id", digests.asNondeterministic()("text").alias("digest"))
    return rows.select(F.col("id").alias(id), "digest.*")
