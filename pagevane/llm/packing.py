"""Best-fit packing of documents into sequences, planned by bin completion.

Texts are tokenised where they are read and never move; a row for each piece goes on. How
pieces are put together depends on their lengths only, and there are at most ``capacity``
different lengths, so the plan is made on the histogram of lengths: its size doesn't grow with
the corpus. A plan is a list of fillings (a multiset of lengths) with a number of times. Pieces
are then numbered within their length and take the places of the plan by number.
"""

from __future__ import annotations

import json
import zlib
from array import array
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from public_tokenizers import PATTERN
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .bpe import _even, _units
from .common import give_back, steps, text_of, utf8, written

CACHE_UNITS = 650_000
# Signs which after a word are a match of the pattern, in any number. (An apostrophe may not be.)
SIGNS = ".,;:!?"
# Fillings that the branch-and-bound search looks at; each may cost a best fit of ``capacity`` lengths.
TRIES = 250
SLICE_POWER = 0.4

_tokenizers: dict = {}


class _Cache(dict):
    """What ``find`` gives, kept; emptied when it is full."""

    def __init__(self, find: Callable[[str], bytes]):
        self.find = find

    def __missing__(self, key: str) -> bytes:
        if len(self) >= CACHE_UNITS:
            self.clear()
        found = self[key] = self.find(key)
        return found


class _Ids:
    """Ids by a byte-level BPE tokenizer file, with a cache of units and pieces (see ``bpe``).

    With ``by_ranks`` pieces are merged by the ids of tokens as ranks, which is several times as fast.
    """

    def __init__(self, path: str, by_ranks: bool = False):
        from tokenizers import Tokenizer

        how = _read(path)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.ranked = _ranked(how) if by_ranks else None
        self.added = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = _byte_letters()
        self.cut = regex.compile(PATTERN).findall
        self.units = _Cache(self._unit)
        # Units that are a space and a chunk, by the chunk: most of a text, and no string is made for them.
        self.spaced = _Cache(self._spaced)
        self.pieces = _Cache(self._known)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers.

        The tokenizer's pattern always ends a match where ``_units`` cuts, so that the ids of
        a text are those of the pieces of its units, by the tokenizer's model. A text that
        holds an added token's string is given to the tokenizer whole.
        """
        return [self._whole(t) if any(s in t for s in self.added) else self._joined(t) for t in texts]

    def forget(self) -> None:
        for cache in (self.units, self.spaced, self.pieces):
            cache.clear()

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _joined(self, text: str) -> bytes:
        chunks = text.split(" ")
        if _even(chunks):
            first, *rest = chunks
            return self.units[first] + b"".join(map(self.spaced.__getitem__, rest))
        return b"".join(map(self.units.__getitem__, _units(text)))

    def _spaced(self, chunk: str) -> bytes:
        # Most chunks are a word, or a word and signs: one match of the pattern or two, and need no search.
        word = chunk.rstrip(SIGNS)
        if not _is_word(word):
            return self._unit(" " + chunk)
        if len(word) == len(chunk):
            return self._piece(" " + chunk)
        return self.spaced[word] + self.pieces[chunk[len(word) :]]

    def _unit(self, unit: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.cut(unit)))

    def _known(self, piece: str) -> bytes:
        ids = self.spaced.get(piece[1:]) if piece[:1] == " " else None
        return self._piece(piece) if ids is None else ids

    def _piece(self, piece: str) -> bytes:
        if self.ranked is not None:
            return array("I", self.ranked(piece.encode())).tobytes()
        letters = piece if piece.isascii() and piece.isalnum() else piece.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()


def _read(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        how = json.load(file)
    split = how["pre_tokenizer"] or {}
    if how["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space"):
        raise ValueError(f"not a byte-level tokenizer without prefix space: {path}")
    return how


def _ranks(how: dict) -> dict[bytes, int]:
    """Ids of the vocabulary's tokens by their bytes, without added tokens."""
    byte_of = {c: b for b, c in _byte_letters().items()}
    added = {t["content"] for t in how["added_tokens"]}
    return {bytes(byte_of[c] for c in t): i for t, i in how["model"]["vocab"].items() if t not in added}


def _ranked(how: dict) -> Callable[[bytes], list[int]]:
    import tiktoken

    own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=_ranks(how), special_tokens={})
    return own._encode_single_piece


@lru_cache(maxsize=None)
def by_ranks(path: str) -> bool:
    """Whether merging by ids gives a tokenizer's ids: merges are in order of the ids of what they make, and
    each token is made by them from its bytes. Looked at once, on the driver.
    """
    from tokenizers import Tokenizer

    how = _read(path)
    model, vocab = how["model"], how["model"]["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [vocab[a + b] for a, b in pairs]
    if made != sorted(made) or len(set(made)) < len(made) or model.get("dropout") or model.get("unk_token"):
        return False
    added = {t["content"] for t in how["added_tokens"]}
    tokenize = Tokenizer.from_file(path).model.tokenize
    return all([x.id for x in tokenize(t)] == [i] for t, i in vocab.items() if t not in added)


def _is_word(chunk: str) -> bool:
    """Whether a chunk is letters of the Latin blocks: one match of the pattern, with a space before it."""
    return chunk.isalpha() and (chunk.isascii() or max(chunk) < "\u0250")


def _byte_letters() -> dict[int, str]:
    """The printable character that a byte-level vocabulary has for each byte.

    Printable bytes of Latin-1 stand for themselves, the others for the characters from 256 on.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _ids(path: str, ranked: bool = False) -> _Ids:
    if (path, ranked) not in _tokenizers:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _tokenizers[path, ranked] = _Ids(path, ranked)
    return _tokenizers[path, ranked]


def pieces(text: str | Column, path: str, capacity: int, end_id: int = 0) -> Column:
    """Array of ``piece, start, length, ids_crc32`` of a text: its ids and the end id.

    A longer row of ids is cut into pieces of ``capacity``; what is over is the first piece.
    """
    ranked = by_ranks(path)

    @F.arrow_udf("array<struct<piece:int,start:long,length:long,ids_crc32:long>>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ids = _ids(path, ranked)
        try:
            for texts in batches:
                yield _cut(texts, ids, capacity, end_id)
        finally:
            ids.forget()  # the worker may go on to other work
            give_back()

    return cut.asNondeterministic()(text_of(text))


def _cut(texts: pa.Array, ids: _Ids, capacity: int, end_id: int) -> pa.Array:
    end = np.array([end_id], "<u4").tobytes()
    offsets, number, start, length, crc = [0], [], [], [], []
    _, bytes_at = utf8(texts)
    for first, last in steps(bytes_at):
        for row in ids.encode(texts.slice(first, last - first).fill_null("").to_pylist()):
            data = memoryview(row + end)
            n = len(data) // 4
            at, to = 0, n % capacity or capacity
            count = 0
            while at < n:
                number.append(count)
                start.append(at)
                length.append(to - at)
                crc.append(zlib.crc32(data[4 * at : 4 * to]))
                at, to, count = to, to + capacity, count + 1
            offsets.append(len(number))
    names = ["piece", "start", "length", "ids_crc32"]
    values = [pa.array(number, pa.int32())] + [pa.array(x, pa.int64()) for x in (start, length, crc)]
    items = pa.StructArray.from_arrays(values, names)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items)


# --- the plan, on the histogram of lengths -------------------------------------------

Filling = tuple[tuple[int, int], ...]  # lengths and how many of each, longest first
Plan = list[tuple[Filling, int]]


def plan(counts: dict[int, int], capacity: int, tries: int = TRIES) -> Plan:
    """Fillings and how often each is used, in as few sequences as the search finds.

    Bin completion by branch and bound. The first incumbent is best fit decreasing. A node
    takes the longest length left and goes through the undominated fillings around it, least waste
    first, as they are asked for; it uses one as often as the counts allow, then half as often, down to once. A
    branch is cut when its waste so far and the least waste of the rest can't beat the incumbent. Each node that is
    reached is also completed by best fit, for a new incumbent. The search ends when the incumbent meets the
    bound, when no branch is left (the plan is then the best one), or after ``tries`` fillings, as packing is
    NP-hard; the plan is whole either way.
    """
    counts = {k: n for k, n in counts.items() if n > 0}
    bound = lower_bound(counts, capacity)
    best = best_fit(counts, capacity)
    used = sum(n for _, n in best)
    chosen: Plan = []
    bins = 0
    # One open enumeration for each level, and what its node had left.
    stack = [(counts, _ways(counts, capacity))] if counts else []
    while stack and used > bound and tries > 0:
        left, ways = stack[-1]
        filling, times = next(ways, (None, 0))
        # What may be wasted from here on, if the incumbent is to be beaten.
        spare = (used - 1 - bins) * capacity - sum(k * n for k, n in left.items())
        if filling is None or capacity - size(filling) > spare:
            stack.pop()
            if chosen:
                bins -= chosen.pop()[1]
            continue
        tries -= 1
        if not times:
            continue
        after = _after(left, filling, times)
        if bins + times + lower_bound(after, capacity) >= used:
            continue
        rest = best_fit(after, capacity)
        if (total := bins + times + sum(n for _, n in rest)) < used:
            best, used = [*chosen, (filling, times), *rest], total
        if after:
            chosen.append((filling, times))
            bins += times
            stack.append((after, _ways(after, capacity)))
    return best


def _ways(left: dict[int, int], capacity: int) -> Iterator[tuple[Filling, int]]:
    """Fillings with numbers of times; a dominated filling has none."""
    for filling, dominated in fillings(left, capacity):
        times = 0 if dominated else min(left[k] // n for k, n in filling)
        yield filling, times
        while times > 1:
            times //= 2
            yield filling, times


def size(filling: Filling) -> int:
    return sum(k * n for k, n in filling)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any plan needs: by volume, and by the dual feasible functions of Fekete and Schepers (2001)."""
    if not counts:
        return 0
    lengths = np.array(list(counts), np.int64)
    times = np.array(list(counts.values()), np.int64)
    best = _ceil(int(lengths @ times), capacity)
    for k in range(1, 21):
        scaled = (k + 1) * lengths
        # A length that is a whole part of the capacity counts as it is, others as the parts they fill.
        exact = scaled % capacity == 0
        share = np.where(exact, k * lengths, scaled // capacity * capacity)
        best = max(best, _ceil(int(share @ times), k * capacity))
    return best


def _ceil(a: int, b: int) -> int:
    return -(-a // b)


def _after(left: dict[int, int], filling: Filling, times: int) -> dict[int, int]:
    after = dict(left)
    for k, n in filling:
        after[k] -= n * times
        if not after[k]:
            del after[k]
    return after


def _sums(reach: int, length: int, count: int) -> int:
    """Bits of the sums that ``reach`` has when up to ``count`` of a length are added."""
    step = 1
    while count:
        take = min(step, count)
        reach |= reach << (take * length)
        count -= take
        step *= 2
    return reach


def fillings(left: dict[int, int], capacity: int) -> Iterator[tuple[Filling, bool]]:
    """All fillings around the longest length, least waste first, one at a time, and whether each is dominated.

    For each waste, from none upward, those whose lengths add up to what it leaves: tables of sums that the
    shorter lengths can reach show which ways lead there, so that no way is tried in vain. Lengths are taken
    longest first, as many as fit first. A way is a stack of counts; nothing recurses.
    """
    lengths = sorted(left)
    longest = lengths[-1]
    room = capacity - longest
    pool = {k: left[k] - (k == longest) for k in lengths if k <= room and left[k] - (k == longest) > 0}
    shorter = sorted(pool)
    mask = (1 << (room + 1)) - 1
    # reach[i]: sums of the i shortest lengths.
    reach = [1]
    for k in shorter:
        reach.append(_sums(reach[-1], k, min(pool[k], room // k)) & mask)
    available = 0
    for k in shorter:
        available |= 1 << k
    for waste in range(room + 1):
        target = room - waste
        if not reach[-1] >> target & 1:
            continue
        # Counts chosen so far, from the longest; each entry: index, count, sum that is still to come.
        way: list[tuple[int, int, int]] = []
        i, rest, n = len(shorter), target, None
        while True:
            if rest == 0:
                counted = Counter({shorter[j]: c for j, c, _ in way if c})
                counted[longest] += 1
                filling = tuple(sorted(counted.items(), reverse=True))
                yield filling, _dominated(filling, pool, available, longest, waste)
            else:
                k = shorter[i - 1]
                if n is None:
                    n = min(pool[k], rest // k)
                while n >= 0 and not reach[i - 1] >> (rest - n * k) & 1:
                    n -= 1
                if n >= 0:
                    way.append((i - 1, n, rest))
                    i, rest, n = i - 1, rest - n * k, None
                    continue
            # Back to the last length of which one less can be taken.
            while way and not way[-1][1]:
                way.pop()
            if not way:
                break
            j, count, rest = way.pop()
            i, n = j + 1, count - 1


def _dominated(filling: Filling, pool: dict[int, int], available: int, longest: int, waste: int) -> bool:
    """Whether a length that is left can stand in for some of the filling's that are no longer, and still fit.

    A single length is replaced by a longer one; several also by one of their own sum.
    """
    single, several, taken = 0, 0, dict(filling)
    taken[longest] -= 1
    free = available
    for k, n in taken.items():
        if not n:
            continue
        if pool[k] <= n:
            free &= ~(1 << k)
        # Two or more: as before and any of this length, one and one or more of it, or two or more of it.
        several = _sums(several, k, n) | _sums(single << k, k, n - 1)
        if n > 1:
            several |= _sums(1 << 2 * k, k, n - 2)
        single |= 1 << k
    wider = single << 1 if waste else 0
    for w in range(waste + 1):
        if several << w & free or (w and wider << (w - 1) & free):
            return True
    return False


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best fit decreasing on a histogram: many sequences of equal filling at a time."""
    open_: dict[int, list[tuple[Filling, int]]] = {}  # by the room that is left
    rooms: list[int] = []  # ascending

    def put(filling: Filling, times: int) -> None:
        room = capacity - size(filling)
        if room not in open_:
            open_[room] = []
            rooms.insert(bisect_right(rooms, room), room)
        open_[room].append((filling, times))

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            at = bisect_right(rooms, length - 1)
            if at == len(rooms):
                each = capacity // length
                if n >= each:
                    put(((length, each),), n // each)
                    n %= each
                if n:
                    put(((length, n),), 1)
                    n = 0
                continue
            room = rooms[at]
            filling, times = open_[room].pop()
            if not open_[room]:
                del open_[room], rooms[at]
            each = min(room // length, n)
            use = min(times, n // each)
            if use < times:
                put(filling, times - use)
            put((*filling, (length, each)), use)
            n -= use * each
    return [x for room in sorted(open_) for x in open_[room]]


# --- the operator --------------------------------------------------------------------


def pack(
    docs: DataFrame,
    path: str,
    capacity: int = 2048,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``id, piece, start, length, ids_crc32, sequence_id, offset`` of each piece.

    A null or empty text is one piece of one id. Rows with the same id are packed one by
    one, as are rows with a null id. An empty table gives an empty result. Which of two pieces
    of equal length goes where is free; it follows from hashes of id, piece and content.
    """
    rows = docs.select(docs[id].alias("id"), pieces(docs[text], path, capacity).alias("cut"))
    rows = written(rows.select("id", F.inline("cut")))
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    place = _places(plan(counts, capacity), docs.sparkSession)
    # Slices of a length grow in number with the rows, so that no length is one task, but their sizes stay few.
    slices = F.lit(max(1, int(sum(counts.values()) ** SLICE_POWER)))
    rows = rows.withColumn("slice", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), slices))
    sizes = rows.groupBy("length", "slice").agg(F.count("*").alias("n"))
    before = W.partitionBy("length").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select("length", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    order = W.partitionBy("length", "slice").orderBy("id", "piece", "ids_crc32")
    ranked = rows.withColumn("rank", F.row_number().over(order) - 1)
    ranked = ranked.join(sizes, ["length", "slice"]).withColumn("rank", F.col("rank") + F.col("before"))
    placed = ranked.withColumn("place", place("length", "rank"))
    return placed.select(F.col("id").alias(id), "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset")


def _places(chosen: Plan, spark: SparkSession) -> Callable[[str, str], Column]:
    """The place of the n-th piece of a length, as an expression.

    The plan has a row for each filling and length in it: as many as the plan is long, whatever the rows.
    """
    taken: Counter = Counter()
    places, base = [], 0
    for filling, times in chosen:
        at = 0
        for k, n in filling:
            places.append((k, taken[k], n, base, at))
            taken[k] += n * times
            at += n * k
        base += times
    table = np.array(sorted(places), np.int64).reshape(-1, 5)
    shared = spark.sparkContext.broadcast(table)

    @F.arrow_udf("sequence_id long, offset long")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        of = shared.value
        k, n = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in (length, rank))
        # Rows are in order of length, then number: the last that begins no later.
        keys = of[:, 0] << 44 | of[:, 1]
        _, first, each, bins, offset = of[np.searchsorted(keys, k << 44 | n, "right") - 1].T
        nth = n - first
        columns = [pa.array(bins + nth // each), pa.array(offset + nth % each * k)]
        return pa.StructArray.from_arrays(columns, ["sequence_id", "offset"])

    return place
