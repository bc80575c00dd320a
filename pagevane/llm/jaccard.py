"""N-gram Jaccard join by adaptive multi-match prefixes.

Two sets whose Jaccard similarity reaches ``t`` share at least ``l`` shingles among the first
``n - ceil(t * n) + l`` of each, in any one order of all shingles. Rarest first is the best
order. A document picks the ``l`` that costs least by estimate: a longer prefix meets more
postings, but asks for more shared ones before a pair is verified. A pair is a candidate when
it shares as many prefix shingles as the smaller of its two ``l``.

Shingle counts come from a count sketch of fixed size over all documents; it sets the order and
the estimates and hence the cost, never the result. Texts with equal sets form a class, of
which one goes on. Links are verified on whole sets, after coarse sets have ruled out most others.

Groups of near copies aren't compared pair by pair. In rounds, the members of crowded postings
are first verified against a few leaders of the posting, and classes linked so far count as one
component. Rounds go on while the pairs left outnumber the postings and each round leaves
clearly fewer. Afterwards all pairs that share a posting and lie in different components are made
and verified. Pairs inside a component can't change the components, and no other pair is left
out, so the components are exact.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import (
    Words,
    bloom,
    gathered,
    in_bloom,
    likely_in,
    mixed,
    seems_in,
    signed,
    small_batches,
    steps,
    text_of,
    utf8,
    written,
)
from .components import connected

WORDS = 5
PERCENT = 75
SKETCH = 1 << 20
MOST_MATCHES = 3
# Cost of verifying a pair, for each shingle of a document, against one posting entry.
VERIFY_COST = 0.05
# Postings of more classes than this are first met by leaders.
CROWDED = 8
LEADERS = 3
# A coarse set keeps so many bits of each hash more than its size asks for.
COARSE_BITS = 5
# Rounds of leaders go on while one leaves less than this share of the pairs.
GAIN = 0.8
_MEMBER = ("node", "component", "n", "matches", "place")


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words: the whole sequence as one."""
    data, offsets = utf8(texts)
    for first, last in steps(offsets, trim=True):
        at = offsets[first : last + 1]
        found = Words(data[at[0] : at[-1]], at - at[0], lower=True)
        hashes, _ = found.shingles(words)
        for lo, hi in zip(found.first[:-1].tolist(), found.first[1:].tolist()):
            if hi == lo:
                yield np.zeros(0, np.uint64)
            elif hi - lo < words:
                few = found.hash[lo:hi]
                total = np.bitwise_xor.reduce(mixed(few + np.arange(1, len(few) + 1, dtype=np.uint64)))
                yield mixed(np.array([total], np.uint64) + np.uint64(len(few)))
            else:
                every = np.sort(hashes[lo : hi - words + 1])
                yield every[np.append(True, every[1:] != every[:-1])]


def _place(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(44)) & np.uint64(SKETCH - 1)


def _prefix(hashes: np.ndarray, counts: np.ndarray, mean: float, percent: int) -> tuple[int, np.ndarray]:
    """Matches to ask for, and the prefix to index, of one set."""
    n = len(hashes)
    count = counts[_place(hashes)]
    order = np.lexsort((hashes, count))
    least = -(-percent * n // 100)
    others = np.maximum(count[order] - mean - 1.0, 0.0)
    met = np.cumsum(others)
    most = min(MOST_MATCHES, least)
    ask = np.arange(1, most + 1)
    entries = met[np.minimum(n - least + ask, n) - 1]
    best = int(np.argmin(entries + VERIFY_COST * n * entries / ask)) + 1
    return best, hashes[order[: n - least + best]]


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(x) for x in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(signed(flat)))


def _signatures(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """``id, key, n, matches, prefix`` of each row of ``id, text``."""
    context = rows.sparkSession.sparkContext

    def fill(counts: np.ndarray, batch: pa.RecordBatch) -> None:
        for hashes in shingle_sets(batch.column(0), words):
            np.add.at(counts, _place(hashes), np.uint32(1))

    counts = gathered(rows.select("text"), SKETCH, "uint32", fill)
    shared = context.broadcast(counts)
    mean = float(counts.sum(dtype=np.float64)) / SKETCH

    @F.arrow_udf("key binary, n long, matches int, prefix array<long>")
    def signature(texts: pa.Array) -> pa.Array:
        keys, sizes, matches, prefixes = [], [], [], []
        for hashes in shingle_sets(texts, words):
            keys.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
            sizes.append(len(hashes))
            if len(hashes):
                ask, prefix = _prefix(hashes, shared.value, mean, percent)
            else:
                ask, prefix = 0, hashes
            matches.append(ask)
            prefixes.append(prefix)
        columns = [pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(matches, pa.int32()), _lists(prefixes)]
        return pa.StructArray.from_arrays(columns, ["key", "n", "matches", "prefix"])

    made = rows.select("id", signature.asNondeterministic()("text").alias("s"))
    return written(made.select("id", "s.*"))


def _shared_postings(signatures: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes ``key, node``, and postings ``node, n, matches, token, place`` of seemingly shared shingles.

    Most shingles occur once: a Bloom filter of the others keeps them from going on.
    """
    tokens = signatures.select(F.explode("prefix").alias("token"))
    twice = tokens.groupBy("token").agg(F.count("*").alias("c")).filter("c > 1").select("token")
    bits = signatures.sparkSession.sparkContext.broadcast(bloom(twice))

    @F.arrow_udf("array<struct<token:long,place:int>>")
    def likely(prefixes: pa.Array) -> pa.Array:
        flat = prefixes.flatten().to_numpy(zero_copy_only=False)
        keep = in_bloom(bits.value, flat)
        ends = prefixes.offsets.to_numpy() - prefixes.offsets[0].as_py()
        place = np.arange(len(flat)) - np.repeat(ends[:-1], np.diff(ends))
        total = np.append(0, np.cumsum(keep))
        items = [pa.array(flat[keep]), pa.array(place[keep].astype(np.int32))]
        items = pa.StructArray.from_arrays(items, ["token", "place"])
        return pa.ListArray.from_arrays(pa.array(total[ends].astype(np.int32)), items)

    some = signatures.select("id", "key", "n", "matches", likely("prefix").alias("prefix"))
    classes = written(
        some.groupBy("key").agg(
            F.min("id").alias("node"), F.min_by(F.struct("n", "matches", "prefix"), "id").alias("s")
        )
    )
    postings = classes.select("node", "s.n", "s.matches", F.inline("s.prefix"))
    return classes.select("key", "node"), postings


def _coarse(hashes: np.ndarray) -> bytes:
    """A set by the upper bits of its sorted hashes: a byte for each gap, after 255 for each 255 of it."""
    upper = (hashes >> np.uint64(64 - _width(len(hashes)))).astype(np.int64)
    more, rest = np.divmod(np.diff(upper, prepend=0), 255)
    out = np.full(len(upper) + int(more.sum()), 255, np.uint8)
    out[np.cumsum(more + 1) - 1] = rest
    return out.tobytes()


def _width(n: int) -> int:
    """Upper bits that are kept of each of ``n`` hashes."""
    return (max(n, 1) - 1).bit_length() + COARSE_BITS


def _most_shared(x: bytes, y: bytes) -> tuple[int, int, int]:
    """Sizes of two coarse sets, and a number that their sets can't share more of."""
    first, second = (np.cumsum(d, dtype=np.int64)[d != 255] for d in (np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)))
    m, n = len(first), len(second)
    width = min(_width(m), _width(n))
    first, second = first >> (_width(m) - width), second >> (_width(n) - width)
    return m, n, min(_found(first, second), _found(second, first))


def _found(items: np.ndarray, among: np.ndarray) -> int:
    """How many of some sorted numbers are among others, also sorted."""
    return int((np.searchsorted(among, items, "right") > np.searchsorted(among, items)).sum())


def _similar(m: int, n: int, shared: int, percent: int) -> bool:
    """Whether sets of these sizes that share so many are similar enough; empty sets never are."""
    return shared > 0 and shared * 100 >= (m + n - shared) * percent


def _verified(pairs: DataFrame, rows: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` of documents in ``rows`` whose whole sets are similar enough.

    All pairs are first compared by coarse sets, an eighth as large as the hashes, which can show
    more in common than there is but never less. Only what is left meets its texts, whose
    whole sets decide.
    """

    pairs = written(pairs)
    bits = _ends(pairs)

    # The filter and the sets in one function: two would ask for two Python workers for each task.
    @F.arrow_udf("binary")
    def coarse(ids: pa.Array, texts: pa.Array) -> pa.Array:
        keep = seems_in(bits.value, ids)
        sets = shingle_sets(texts.filter(pa.array(keep)), words)
        return pa.array([_coarse(next(sets)) if k else None for k in keep.tolist()], pa.binary())

    @F.arrow_udf("boolean")
    def possible(a: pa.Array, b: pa.Array) -> pa.Array:
        sets = zip(a.to_pylist(), b.to_pylist())
        return pa.array([_similar(*_most_shared(x, y), percent) for x, y in sets], pa.bool_())

    @F.arrow_udf("boolean")
    def similar(a: pa.Array, b: pa.Array) -> pa.Array:
        sets = zip(shingle_sets(a, words), shingle_sets(b, words))
        shared = ((len(x), len(y), len(np.intersect1d(x, y, assume_unique=True))) for x, y in sets)
        return pa.array([_similar(*s, percent) for s in shared], pa.bool_())

    sets = rows.select(F.col("id").alias("node"), coarse.asNondeterministic()("id", "text").alias("item"))
    pairs = written(_passing(pairs, written(sets.filter("item is not null").distinct()), possible))
    texts = rows.filter(likely_in(_ends(pairs), "id")).select(F.col("id").alias("node"), F.col("text").alias("item"))
    return written(_passing(pairs, texts.distinct(), similar))


def _passing(pairs: DataFrame, items: DataFrame, test: Callable[..., Column]) -> DataFrame:
    """The pairs ``a, b`` with ``node, item`` of both that pass a test."""
    both = pairs.join(items.toDF("b", "second"), "b").join(items.toDF("a", "first"), "a")
    return both.filter(test("first", "second")).select("a", "b")


def _ends(pairs: DataFrame) -> Broadcast:
    """A Bloom filter of the documents that are in a pair."""
    return pairs.sparkSession.sparkContext.broadcast(bloom(pairs.select(F.explode(F.array("a", "b")))))


def _with_component(postings: DataFrame, components: DataFrame | None) -> DataFrame:
    if components is None:
        return postings.withColumn("component", F.col("node"))
    known = postings.join(components, "node", "left")
    return known.withColumn("component", F.coalesce("component", "node"))


def _counted(postings: DataFrame) -> DataFrame:
    """Postings of shingles that more than one class has, with the number of their rows."""
    rows = postings.groupBy("token").agg(F.count("*").alias("rows")).filter("rows > 1")
    return written(postings.join(rows, "token"))


def _leader_pairs(crowded: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs of each member of a crowded posting with a few leaders of it.

    Leaders are the members with the smallest hashes, so that a group shares them over all its
    postings. (Two leaders meet twice, which may make one more candidate.)
    """
    member = F.struct(*_MEMBER)
    ranks = [
        F.min_by(member, F.xxhash64("node", F.lit(turn * LEADERS + i))).alias(f"l{i}") for i in range(LEADERS)
    ]
    leaders = crowded.groupBy("token").agg(*ranks)
    leaders = leaders.select("token", F.explode(F.array_distinct(F.array(*(f"l{i}" for i in range(LEADERS))))).alias("b"))
    met = crowded.select("token", F.struct(*_MEMBER).alias("a")).join(leaders, "token")
    return _asked(met.filter("a.component <> b.component").filter(_possible(percent)))


def _possible(percent: int) -> Column:
    """Whether ``a`` and ``b``, which share a shingle at known places of both, can be similar.

    Their sizes must fit. And what they share can't be more than what follows the place in
    either, and the shared ones before it; of a similar pair's first ``asked`` shared shingles,
    none has more than ``asked - 1`` before it.
    """
    na, nb = F.col("a.n"), F.col("b.n")
    shared = F.least(na - F.col("a.place"), nb - F.col("b.place")) + F.least("a.matches", "b.matches") - 1
    sizes = (na * 100 >= nb * percent) & (nb * 100 >= na * percent)
    return sizes & (shared * (100 + percent) >= (na + nb) * percent)


def _all_pairs(postings: DataFrame, percent: int) -> DataFrame:
    """Pairs in different components that share as many prefix shingles as they must."""
    left = postings.select("token", F.struct(*_MEMBER).alias("a"))
    right = postings.select("token", F.struct(*_MEMBER).alias("b"))
    apart = (F.col("a.node") > F.col("b.node")) & (F.col("a.component") != F.col("b.component"))
    return _asked(left.join(right, "token").filter(apart & _possible(percent)))


def _asked(met: DataFrame) -> DataFrame:
    """Pairs that met in as many postings as both prefixes ask for."""
    pairs = met.select(
        F.greatest("a.node", "b.node").alias("a"),
        F.least("a.node", "b.node").alias("b"),
        F.least("a.matches", "b.matches").alias("asked"),
    )
    counted = pairs.groupBy("a", "b").agg(F.count("*").alias("shared"), F.min("asked").alias("asked"))
    return counted.filter("shared >= asked").select("a", "b")


def jaccard_components(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """``id, n_shingles, component_id``: one row for each row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased. Two documents link when
    ``100 * intersection >= percent * union``. Null, empty and blank texts have no shingles and
    link with nothing. Rows that share an id count as one document in links; equal rows stay
    separate rows. A row with a null id links with nothing and has a null component.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(docs[id].alias("id"), text_of(docs[text]).alias("text"))
    signatures = _signatures(rows, words, percent)
    nodes = signatures.filter("n > 0 and id is not null")
    classes, postings = _shared_postings(nodes)
    postings = _counted(postings)
    crowded = postings.filter(F.col("rows") > CROWDED)
    links, components, turn, before = None, None, 0, math.inf
    while True:
        current = written(_with_component(crowded, components))
        size, cross = _work(current)
        if cross <= 2 * size or cross > GAIN * before:
            break
        before = cross
        found = _verified(_leader_pairs(current, turn, percent), rows, words, percent)
        turn += 1
        if found.isEmpty():
            break
        links = found if links is None else links.union(found)
        components = written(connected(links))
    found = _verified(_all_pairs(_with_component(postings, components), percent), rows, words, percent)
    links = found if links is None else links.union(found)
    # Documents with one id are one node, whatever their texts; classes of one id link too.
    twins = _one_id_several_classes(nodes).join(classes, "key")
    twins = twins.select(F.col("id").alias("a"), F.col("node").alias("b"))
    links = links.union(twins.filter("a <> b"))
    components = written(connected(links))
    result = classes.select("key", "node").join(components, "node", "left")
    result = result.select("key", F.coalesce("component", "node").alias("component_id"))
    out = signatures.join(result, "key", "left")
    return out.select(
        F.col("id").alias(id),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
    )


def _one_id_several_classes(nodes: DataFrame) -> DataFrame:
    several = nodes.groupBy("id").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).filter("lo <> hi")
    return nodes.select("id", "key").distinct().join(several.select("id"), "id", "left_semi")


def _work(postings: DataFrame) -> tuple[int, int]:
    """Posting entries, and the pairs in different components that they would make."""
    by = postings.groupBy("token", "component").agg(F.count("*").cast("double").alias("c"))
    by = by.groupBy("token").agg(F.sum("c").alias("s"), F.sum(F.col("c") * F.col("c")).alias("q"))
    row = by.agg(F.sum("s"), F.sum((F.col("s") * F.col("s") - F.col("q")) / 2)).first()
    return int(row[0] or 0), math.ceil(row[1] or 0)


# The components by counting the shared shingles of all pairs that share one.
SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
word AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words WHERE len(w) >= 5),
run AS (
  SELECT doc_id, n, i, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o,
    lead(word, 4) OVER o) AS shingle
  FROM word WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
item AS (
  SELECT DISTINCT doc_id, shingle FROM run WHERE i + 4 <= n
  UNION ALL
  SELECT doc_id, array_to_string(w, ' ') FROM words WHERE len(w) BETWEEN 1 AND 4),
size AS (SELECT doc_id, count(*) AS n FROM item GROUP BY doc_id),
pair AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
  FROM item a JOIN item b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
link AS (
  SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE 100 * i >= 75 * (x.n + y.n - i)),
reach AS (
  SELECT doc_id, doc_id AS other FROM words
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN link l ON l.a = r.other),
component AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM component LEFT JOIN size USING (doc_id)
"""
