"""Prefix trie of conversations, with totals of every subtree by parallel tree contraction.

A node stands for a distinct sequence of first turns; conversations that start with it are its members. Nodes
are found by hashing: a turn's words have two 64-bit hashes, and a prefix the polynomials over them, so that the
hashes of all prefixes follow from sums over chunks of a conversation, whatever its length. A node is named by
its smallest member and its depth.

Contraction. Nodes of a path that have the same members are unary, and are known by (smallest member, number of
members): blocks of ``BLOCK`` depths of such a path are contracted at once. On what is left, rounds alternate:
*rake* adds the totals of leaves to their parents and removes them; *compress* splices out nodes with one child
(of two that are neighbours at most one, by a coin of the round), and leaves their sums on the edge to the child.
Each round joins nodes by their own names only, and adds up children before they are moved, so a node with very
many children is no hot key; the number of rounds grows with the logarithm of the tree. Then the rounds are undone
from the last to the first: a spliced node's total is its sum and its child's total. At last blocks are
re-expanded.

Rules: a null role or text is empty. Turns go by number (null first), then role, then hashes of the text. A row
without conv_id belongs to no conversation. Bases are ``c - pmod(c, 5)``. Equal rows are turns of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import joined_sha256, signed, written

CHUNK = 4096
BLOCK = 64
# Longest head that a conversation takes from its base.
HEAD = 8
# Children of one parent that meet it in one group.
MEET = 2000
# Odd factors of the polynomials (modulo 2^64).
FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def _power(factor: np.uint64, exponent: int) -> np.uint64:
    """``factor ** exponent`` modulo 2^64; odd numbers have an inverse, so the exponent may be negative."""
    return np.uint64(pow(int(factor), exponent, 1 << 64))


def _prefix_sums(hashes: np.ndarray, factor: np.uint64) -> np.ndarray:
    """Sum over the first i hashes times the factor's powers, for i from 0 to all."""
    powers = np.full(len(hashes), factor)
    if len(powers):
        powers[0] = 1
    out = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * np.multiply.accumulate(powers), out=out[1:])
    return out


# --- turns to chunks ------------------------------------------------------------------------------


def _chunks(conversations: DataFrame, size: int) -> DataFrame:
    """``part, run, conv, n, x, y, bytes``: runs of at most ``size`` turns of one conversation, without texts."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").isNotNull().alias("placed"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
        role.alias("role"),
        F.xxhash64(role, text).alias("x"), F.xxhash64(text, role, F.lit(1)).alias("y"),
        F.octet_length(text).cast("long").alias("bytes"),
        # Tells equal rows apart, so that very many of them needn't be one range. Any order of them will do.
        F.monotonically_increasing_id().alias("salt"),
    )
    order = ["conv", "placed", "turn", "role", "x", "y", "salt"]
    dealt = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "x", "y", "bytes")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        held: list[np.ndarray] = []

        def take(rows: np.ndarray) -> pa.RecordBatch:
            nonlocal number
            cut = np.flatnonzero(np.diff(rows[0])) + 1
            firsts = np.concatenate([[0], cut, [rows.shape[1]]])
            firsts = np.concatenate([np.arange(a, b, size) for a, b in zip(firsts, firsts[1:])] + [firsts[-1:]])
            ends = pa.array(firsts, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(column)) for column in rows[1:]]
            n = np.diff(firsts)
            numbers = np.arange(number, number + len(n))
            number += len(n)
            plain = [pa.array(np.full(len(n), part, np.int32)), pa.array(numbers), pa.array(rows[0][firsts[:-1]]), pa.array(n)]
            return pa.RecordBatch.from_arrays(plain + lists, ["part", "run", "conv", "n", "x", "y", "bytes"])

        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            held.append(rows)
            # The last conversation may go on in the next batch.
            rows = np.concatenate(held, axis=1)
            last = int(np.searchsorted(rows[0], rows[0][-1]))
            last += (rows.shape[1] - last) // size * size
            if last:
                yield take(rows[:, :last])
            held = [rows[:, last:]]
        if held and held[0].shape[1]:
            yield take(held[0])

    schema = "part int, run long, conv long, n long, x array<long>, y array<long>, bytes array<long>"
    return written(dealt.mapInArrow(build, schema))


def _sums(chunks: DataFrame) -> DataFrame:
    """``part, run, conv, n, at, sx, sy``: turns and polynomials of a conversation before each chunk."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [
                pa.array(signed(np.array([_prefix_sums(_u64(v), f)[-1] for v in batch.column(c)], np.uint64)))
                for c, f in zip("xy", FACTORS)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *sums], ["part", "run", "conv", "n", "sx", "sy"])

    light = chunks.select("part", "run", "conv", "n", "x", "y")
    light = light.mapInArrow(own, "part int, run long, conv long, n long, sx long, sy long")

    def before(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at, sums = None, 0, [np.uint64(0)] * 2
        for batch in batches:
            out = []
            for part, run, conv, n, *own_sums in zip(*(c.to_pylist() for c in batch.columns)):
                if conv != now:
                    now, at, sums = conv, 0, [np.uint64(0)] * 2
                out.append((part, run, conv, n, at, *(int(s.view(np.int64)) for s in sums)))
                with np.errstate(over="ignore"):
                    mine = [np.int64(s).view(np.uint64) for s in own_sums]
                    sums = [s + _power(f, at) * m for s, f, m in zip(sums, FACTORS, mine)]
                at += n
            columns = [pa.array(c, pa.int32() if not i else pa.int64()) for i, c in enumerate(zip(*out))]
            yield pa.RecordBatch.from_arrays(columns, ["part", "run", "conv", "n", "at", "sx", "sy"])

    # Names of chunks and their sums only: one row stands for up to a chunk of turns.
    sorted_ = light.repartition("conv").sortWithinPartitions("conv", "part", "run")
    return sorted_.mapInArrow(before, "part int, run long, conv long, n long, at long, sx long, sy long")


def _u64(values: pa.Scalar) -> np.ndarray:
    return values.values.to_numpy(zero_copy_only=False).view(np.uint64)


# --- rebuilt conversations ------------------------------------------------------------------------


def head_length(conv: Column) -> Column:
    """How many turns a conversation takes from its base, and leaves out of its own."""
    return (F.crc32(conv.cast("string")) % (HEAD + 1)).cast("int")


def _rebuilt(chunks: DataFrame, sums: DataFrame) -> DataFrame:
    """``conv, n, h, m``, the base's head of m turns and the own one of h, for each conversation."""
    turn = F.arrays_zip("x", "y", "bytes")
    first = sums.filter(F.col("at") < HEAD).join(chunks.select("part", "run", "x", "y", "bytes"), ["part", "run"])
    first = first.select("conv", "at", F.slice(turn, 1, HEAD).alias("turns"))
    heads = first.groupBy("conv").agg(
        F.slice(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "turns"))), lambda s: s["turns"])), 1, HEAD)
        .alias("head")
    )
    lengths = sums.groupBy("conv").agg(F.sum("n").alias("n"))
    known = lengths.join(heads, "conv").withColumn("h", head_length(F.col("conv")))
    bases = heads.select(F.col("conv").alias("base"), F.col("head").alias("base_head"))
    based = known.withColumn("base", F.col("conv") - F.pmod("conv", F.lit(5)))
    joined = based.join(bases, "base", "left")
    given = F.coalesce(F.slice("base_head", F.lit(1), F.col("h")), F.slice("head", 1, 0))
    return joined.select("conv", "n", "h", F.slice("head", F.lit(1), F.col("h")).alias("own"), given.alias("given"))


MEMBER = "conv long, depth long, x long, y long, px long, py long, bytes long, at_end boolean"


def _members(chunks: DataFrame, sums: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """One row for each conversation and depth: hashes of the prefix and of its parent's, bytes of its last text."""
    rebuilt = written(rebuilt)

    def hashed(turns: list[dict]) -> list[np.ndarray]:
        return [_prefix_sums(np.array([t[c] for t in turns], np.int64).view(np.uint64), f) for c, f in zip("xy", FACTORS)]

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                sx, sy = (signed(s).tolist() for s in hashed(row["given"]))
                m, goes_on = len(row["given"]), row["n"] > row["h"]
                out.append((row["conv"], 0, 0, 0, None, None, 0, m == 0 and not goes_on))
                for d, turn in enumerate(row["given"], 1):
                    end = d == m and not goes_on
                    out.append((row["conv"], d, sx[d], sy[d], sx[d - 1], sy[d - 1], turn["bytes"], end))
            yield _batch(list(zip(*out)))

    def tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                skip = max(row["h"] - row["at"], 0)
                if skip >= row["n"]:
                    continue
                m, columns = len(row["given"]), []
                for c, given, own, factor, before in zip(
                    "xy", hashed(row["given"]), hashed(row["own"]), FACTORS, (row["sx"], row["sy"])
                ):
                    with np.errstate(over="ignore"):
                        sums = _prefix_sums(np.array(row[c], np.int64).view(np.uint64), factor)
                        sums = np.int64(before).view(np.uint64) + _power(factor, row["at"]) * sums - own[-1]
                        sums = given[-1] + _power(factor, m - row["h"]) * sums
                    columns += [signed(sums[skip + 1 :]), signed(sums[skip:-1])]
                first = m + row["at"] + skip - row["h"] + 1
                size = row["n"] - skip
                ends = np.zeros(size, bool)
                ends[-1] = row["at"] + row["n"] == row["total"]
                x, px, y, py = columns
                conv = np.full(size, row["conv"])
                yield _batch([conv, np.arange(first, first + size), x, y, px, py, row["bytes"][skip:], ends])

    # A conversation's chunks each take what they need of it; they are found by name, not dealt by conversation.
    asked = sums.join(rebuilt.withColumnRenamed("n", "total"), "conv")
    long = asked.filter("at + n > h").join(chunks.select("part", "run", "x", "y", "bytes"), ["part", "run"])
    return rebuilt.mapInArrow(heads, MEMBER).union(long.mapInArrow(tails, MEMBER))


def _batch(columns: list) -> pa.RecordBatch:
    fields = [f.split() for f in MEMBER.split(", ")]
    kinds = {"long": pa.int64(), "boolean": pa.bool_()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


# --- nodes ----------------------------------------------------------------------------------------


def trie(conversations: DataFrame, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """Nodes (``conv_id, depth, parent_conv_id, parent_convs, n_convs, n_children, own``) and ends (node, member).

    ``own`` is what a node saves by itself: the bytes of its last text for each member but one.
    """
    chunks = _chunks(conversations, chunk)
    sums = written(_sums(chunks))
    members = written(_members(chunks, sums, _rebuilt(chunks, sums)))
    name = ["depth", "x", "y"]
    nodes = members.groupBy(*name, "px", "py", "bytes").agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"))
    nodes = written(nodes)
    # Children meet their parent in groups of about MEET, however many they are.
    groups = 1 + nodes.count() // MEET
    part = F.pmod(F.xxhash64("x", "y"), F.lit(groups)).alias("part")
    children = nodes.withColumn("up", F.col("depth") - 1).select("*", part)
    asked = children.filter("depth > 0").groupBy("up", "px", "py", "part").agg(F.count("*").alias("n"))
    above = nodes.select(
        F.col("depth").alias("up"), F.col("x").alias("px"), F.col("y").alias("py"),
        F.col("conv_id").alias("parent_conv_id"), F.col("n_convs").alias("parent_convs"),
    )
    told = written(asked.join(above, ["up", "px", "py"]))
    counts = told.groupBy(F.col("parent_conv_id").alias("conv_id"), F.col("up").alias("depth"))
    counts = counts.agg(F.sum("n").alias("n_children"))
    found = children.join(told.drop("n"), ["up", "px", "py", "part"], "left").join(counts, ["conv_id", "depth"], "left")
    own = (F.col("n_convs") - 1) * F.col("bytes")
    out = found.select(
        "conv_id", "depth", "parent_conv_id", "parent_convs", "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), own.alias("own"), "x", "y",
    )
    ends = members.filter("at_end").select("depth", "x", "y", F.col("conv").alias("member"))
    return written(out), ends


def _coin(id_: Column, turn: int) -> Column:
    return F.pmod(F.xxhash64(id_, F.lit(turn)), F.lit(2)) == 1


def subtree_totals(tree: DataFrame, *sums: str) -> DataFrame:
    """``id`` and the totals of columns ``sums`` over each subtree of ``tree`` (``id, parent``, root's null).

    Tree contraction by rounds of joins, and expansion; every round is stored in the shared folder.
    """
    zero = F.struct(*(F.lit(0).cast("long").alias(c) for c in sums))
    own = F.struct(*(F.col(c).cast("long").alias(c) for c in sums))
    none = F.lit(None).cast(dict(tree.dtypes)["id"])

    def plus(*parts: Column) -> Column:
        return F.struct(*(sum((p[c] for p in parts[1:]), parts[0][c]).alias(c) for c in sums))

    active = written(tree.select("id", "parent", own.alias("acc"), zero.alias("edge")))
    gone: list[DataFrame] = []
    turn = 0
    while True:
        # Rake: nodes that are nobody's parent.
        parents = active.filter("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.lit(True).alias("is_parent"))
        marked = active.join(parents, "id", "left").withColumn("leaf", F.col("is_parent").isNull()).drop("is_parent")
        leaves = marked.filter("leaf")
        gone.append(written(leaves.select("id", "acc", none.alias("via"))))
        raked = leaves.filter("parent is not null").withColumn("gift", plus(F.col("acc"), F.col("edge")))
        gifts = raked.groupBy(F.col("parent").alias("id")).agg(
            F.struct(*(F.sum(f"gift.{c}").alias(c) for c in sums)).alias("gift")
        )
        rest = marked.filter("not leaf").drop("leaf").join(gifts, "id", "left")
        acc = F.when(F.col("gift").isNull(), F.col("acc")).otherwise(plus(F.col("acc"), F.coalesce("gift", zero)))
        active = written(rest.select("id", "parent", acc.alias("acc"), "edge"))
        if not active.limit(1).count():
            break
        # Compress: nodes with one child, whose child isn't spliced in this round.
        turn += 1
        kids = active.filter("parent is not null").groupBy(F.col("parent").alias("id")).agg(
            F.count("*").alias("n"), F.min("id").alias("child")
        )
        unary = active.filter("parent is not null").join(kids.filter("n = 1").drop("n"), "id")
        unary = written(unary.withColumn("heads", _coin(F.col("id"), turn)))
        tails = unary.filter("heads").select(F.col("id").alias("child"), F.lit(True).alias("next_heads"))
        chosen = unary.filter("heads").join(tails, "child", "left").filter("next_heads is null")
        below = active.select(F.col("id").alias("child"), F.col("edge").alias("child_edge"))
        spliced = written(chosen.join(below, "child").select("id", "parent", "acc", "edge", "child", "child_edge"))
        gone.append(spliced.select("id", plus(F.col("acc"), F.col("child_edge")).alias("acc"), F.col("child").alias("via")))
        moved = spliced.select(
            F.col("child").alias("id"), F.col("parent").alias("new_parent"),
            plus(F.col("acc"), F.col("edge"), F.col("child_edge")).alias("new_edge"),
        )
        left = active.join(spliced.select("id"), "id", "left_anti").join(moved, "id", "left")
        active = written(left.select(
            "id", F.coalesce("new_parent", "parent").alias("parent"), "acc", F.coalesce("new_edge", "edge").alias("edge")
        ))
    # Expansion: a spliced node's total is its sum and the total of the child it had.
    totals = gone.pop().select("id", "acc")
    while gone:
        one = gone.pop()
        known = totals.select(F.col("id").alias("via"), F.col("acc").alias("below"))
        if len(gone) % 2:
            back = one.join(known, "via").select("id", plus(F.col("acc"), F.col("below")).alias("acc"))
            totals = written(totals.union(back))
        else:
            totals = totals.union(one.select("id", "acc"))
    return totals.select("id", "acc.*")


def prefix_trie(conversations: DataFrame, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """The nodes with totals of their subtrees (``n_leaves, saved_tokens``), and the ends."""
    nodes, ends = trie(conversations, chunk)
    block = F.floor(F.col("depth") / BLOCK).cast("long")
    # A block is named by its members (smallest, number) and its place on their path.
    nodes = nodes.withColumn("block", F.struct("conv_id", "n_convs", block.alias("no")))
    up = F.floor((F.col("depth") - 1) / BLOCK).cast("long")
    above = F.struct(F.col("parent_conv_id").alias("conv_id"), F.col("parent_convs").alias("n_convs"), up.alias("no"))
    nodes = nodes.withColumn("above", F.when(F.col("parent_conv_id").isNotNull(), above))
    nodes = nodes.withColumn("childless", (F.col("n_children") == 0).cast("long"))
    blocks = nodes.groupBy(F.col("block").alias("id")).agg(
        F.min_by("above", "depth").alias("parent"), F.sum("childless").alias("n_leaves"), F.sum("own").alias("saved_tokens")
    )
    blocks = written(blocks)
    totals = subtree_totals(blocks, "n_leaves", "saved_tokens")
    # What lies below a block; then its own nodes from the bottom up, which are at most BLOCK.
    below = totals.join(blocks.select("id", F.col("n_leaves").alias("own_leaves"), F.col("saved_tokens").alias("own_saved")), "id")
    below = below.select(
        F.col("id").alias("block"), (F.col("n_leaves") - F.col("own_leaves")).alias("leaves_below"),
        (F.col("saved_tokens") - F.col("own_saved")).alias("saved_below"),
    )
    upward = "over (partition by block order by depth desc)"
    full = nodes.join(below, "block").withColumns({
        "n_leaves": F.expr(f"sum(childless) {upward} + leaves_below"),
        "saved_tokens": F.expr(f"sum(own) {upward} + saved_below"),
    })
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "x", "y"]
    return full.select(*columns), ends


def trie_digest(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row for each node, with a digest of the members that end there."""
    nodes, ends = prefix_trie(conversations, chunk)
    name = ["depth", "x", "y"]
    digests = joined_sha256(ends, name, ["member"], F.col("member").cast("string"), ",", "ends_sha256", short=True)
    joined = nodes.join(digests, name, "left")
    none = F.sha2(F.lit(""), 256)
    return joined.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", none).alias("ends_sha256"),
    )


SQL = """
WITH ids AS (
    SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL
), headed AS (
    SELECT c, ((c % 5) + 5) % 5 AS past, xor(list_reduce(
        [4294967295::BIGINT] || list_transform(range(1, length(c::VARCHAR) + 1), lambda i: ord(substr(c::VARCHAR, i::INT, 1))::BIGINT),
        lambda s, b: list_reduce([xor(s, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))
    ), 4294967295) % 9 AS h
    FROM ids
), original AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS n
    FROM conversations WHERE conv_id IS NOT NULL
), rebuilt AS (
    SELECT headed.c, 0 AS side, n, role, text FROM headed JOIN original AS o ON o.c = headed.c - past AND n <= h
    UNION ALL
    SELECT headed.c, 1 AS side, n, role, text FROM headed JOIN original AS o ON o.c = headed.c AND n > h
), placed AS (
    SELECT c, row_number() OVER (PARTITION BY c ORDER BY side, n) AS depth, role, text FROM rebuilt
), member AS (
    SELECT c, depth, strlen(text) AS bytes,
        list({'role': role, 'text': text}) OVER (PARTITION BY c ORDER BY depth) AS path
    FROM placed
    UNION ALL
    SELECT c, 0, 0, [] FROM ids
), last AS (
    SELECT c, max(depth) AS depth FROM member GROUP BY c
), node AS (
    SELECT path, any_value(m.depth) AS depth, min(m.c) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
        string_agg(CASE WHEN last.depth = m.depth THEN m.c::VARCHAR END, ',' ORDER BY m.c) AS ends
    FROM member AS m JOIN last ON last.c = m.c GROUP BY path
), linked AS (
    SELECT node.*, up.conv_id AS parent_conv_id,
        (SELECT count(*) FROM node AS k WHERE k.depth = node.depth + 1 AND k.path[:node.depth] = node.path) AS n_children
    FROM node LEFT JOIN node AS up ON up.depth = node.depth - 1 AND up.path = node.path[:node.depth - 1]
), totals AS (
    SELECT a.conv_id, a.depth, count_if(b.n_children = 0) AS n_leaves, sum((b.n_convs - 1) * b.bytes) AS saved_tokens
    FROM linked AS a JOIN member AS m ON m.c = a.conv_id AND m.depth = a.depth
        JOIN linked AS b ON b.depth >= a.depth AND b.path[:a.depth] = a.path
    GROUP BY a.conv_id, a.depth
)
SELECT l.conv_id, l.depth::BIGINT AS depth, l.parent_conv_id, l.n_convs::BIGINT AS n_convs, l.n_children::BIGINT AS n_children,
    n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM linked AS l JOIN totals USING (conv_id, depth)
"""
