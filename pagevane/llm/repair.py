"""Repair of conversations: the cheapest edits after which roles alternate as they should.

The edits of a conversation are a shortest path through its rows and four states (nothing yet, after the
system's, a user's, an assistant's row), so the cost to go from a row is a vector of four numbers, and a row
is a step from the vector behind it to the one before it. Steps run backward in chunks of rows, all at once:
every chunk but a conversation's last starts from a speculative vector. Steps commute with adding a constant,
and vectors soon differ by constants only whatever they started from, so a fix-up pass reruns a chunk from its
successor's vector only until it meets its earlier run, up to a constant. Passes end when no chunk's vector
changes. Then each chunk maps the state on entry to that on exit; the maps are composed over chunks by
doubling, and the stitched vectors drive the trace: at each row the first letter that is on a cheapest path.

Hot conversations: rows are dealt by ranges of (conversation, turn), so that one of any length is many chunks;
rows equal in conversation, turn, role and text are one item with a count. Between passes only the ends of
chunks are moved. What one task does in sequence, as streams, is a conversation's SHA-256 (``joined_sha256``).

Rules: a null role or text is one space. Rows go by turn (null first), then role, then a hash of the text. An
empty role has no initial. Texts are compared by 64-bit hashes. Rows of a null conversation are one conversation.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import joined_sha256, written

CHUNK = 4096
BLANKS = " \t\n\x0b\x0c\r"

# Costs of the edits.
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
# States: 0 nothing yet, 1 after s, 2 after u, 3 after a. A conversation ends in 0 or 3.
AFTER_INITIAL = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
AFTER_EXPECTED = (2, 2, 3, 2)
ROLE_OF = {2: "user", 3: "assistant"}

# Kinds of rows: 0 must go; else 1 + 2 * initial (s, u, a, other) + whether the text is cut off.
INITIALS = "sua"
# Costs at the end of a conversation, inserts included.
END = (0, 2 * INSERT, INSERT, 0)

KEYS = ["known", "conv", "placed", "turn", "role", "text_hash"]


# --- one step, and a run of steps ------------------------------------------------------------


def _kept(kind: int, state: int) -> int | None:
    """State after a row of this kind is kept as it is, if it can be."""
    initial = (kind - 1) // 2
    return AFTER_INITIAL[INITIALS[initial]][state] if kind and initial < 3 else None


def _cut(kind: int) -> int:
    return CUT if kind and kind % 2 == 0 else 0


@lru_cache(maxsize=None)
def step(behind: tuple[int, ...], kind: int) -> tuple[int, ...]:
    """Costs to go from before a row, up to a constant, from those behind it (the least is 0)."""
    costs = []
    for state in range(4):
        best = DELETE + behind[state]
        if kind:
            best = min(best, REROLE + _cut(kind) + behind[AFTER_EXPECTED[state]])
            kept = _kept(kind, state)
            if kept is not None:
                best = min(best, KEEP + _cut(kind) + behind[kept])
        costs.append(best)
    # Inserts in front of the row: two in a row lead from each state to any other that inserts reach.
    for _ in range(2):
        costs = [min(costs[q], INSERT + costs[AFTER_EXPECTED[q]]) for q in range(4)]
    return normal(tuple(costs))


def normal(costs: tuple[int, ...]) -> tuple[int, ...]:
    least = min(costs)
    return tuple(c - least for c in costs)


def run(kinds: bytes, end: tuple[int, ...]) -> list[tuple[int, ...]]:
    """Vectors before each row and at the end, from the end on."""
    vectors = [end] * (len(kinds) + 1)
    for i in range(len(kinds) - 1, -1, -1):
        vectors[i] = step(vectors[i + 1], kinds[i])
    return vectors


def rerun(kinds: bytes, earlier: tuple[int, ...], end: tuple[int, ...], start: tuple[int, ...]) -> tuple[int, ...]:
    """The vector at a chunk's start for another ``end``, given that ``earlier`` leads to ``start``.

    Where both runs meet they stay together, as they differ by a constant only.
    """
    for kind in reversed(kinds):
        if earlier == end:
            return start
        earlier, end = step(earlier, kind), step(end, kind)
    return end


def trace(kinds: bytes, vectors: list[tuple[int, ...]], state: int, last: bool) -> tuple[list[tuple[str, int]], int]:
    """Edits of least audit among the cheapest, as letter and state after it; and the state on exit.

    An insert stands before the row whose edit comes next. Inserts after the last row belong to the chunk only
    if it is its conversation's last one.
    """
    edits = []
    for i, kind in enumerate(kinds):
        while True:
            letter, state = _first_edit(kind, vectors[i], vectors[i + 1], state)
            edits.append((letter, state))
            if letter != "I":
                break
    while last and state not in (0, 3):
        state = AFTER_EXPECTED[state]
        edits.append(("I", state))
    return edits, state


@lru_cache(maxsize=None)
def _first_edit(kind: int, before: tuple[int, ...], behind: tuple[int, ...], state: int) -> tuple[str, int]:
    """The ASCII-least edit that starts a cheapest path."""
    # What was taken off ``before``, as vectors are kept up to a constant.
    off = _constant(kind, before, behind)
    ways = [("D", DELETE + behind[state] - off, state)]
    ways.append(("I", INSERT + before[AFTER_EXPECTED[state]], AFTER_EXPECTED[state]))
    if kind:
        kept = _kept(kind, state)
        if kept is not None:
            ways.append(("K", KEEP + _cut(kind) + behind[kept] - off, kept))
        ways.append(("R", REROLE + _cut(kind) + behind[AFTER_EXPECTED[state]] - off, AFTER_EXPECTED[state]))
    return min((letter, after) for letter, cost, after in ways if cost == before[state])


@lru_cache(maxsize=None)
def _constant(kind: int, before: tuple[int, ...], behind: tuple[int, ...]) -> int:
    """Least cost to go before the row, on the scale of ``behind``."""
    low = [DELETE + behind[q] for q in range(4)]
    if kind:
        low += [REROLE + _cut(kind) + behind[AFTER_EXPECTED[q]] for q in range(4)]
        low += [KEEP + _cut(kind) + behind[k] for q in range(4) if (k := _kept(kind, q)) is not None]
    return min(low)


# --- rows to chunks -----------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies``: rows as if from a careless export, by a checksum of their names."""

    def named(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    rows = conversations.select("conv_id", "turn", named("role").alias("role"), named("text").alias("text"))
    fault = F.crc32(F.concat(named("conv_id"), F.lit(":"), named("turn"))) % 20
    rows = rows.withColumn("fault", fault).filter("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", ""))
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        F.when(F.col("fault") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _keyed(rows: DataFrame) -> DataFrame:
    """Keys without nulls; null conversations and turns come first."""
    return rows.select(
        F.col("conv_id").isNotNull().alias("known"),
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"),
        F.col("turn").isNotNull().alias("placed"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.xxhash64(F.coalesce("text", F.lit(" "))).alias("text_hash"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        F.coalesce("copies", F.lit(1)).alias("copies") if "copies" in rows.columns else F.lit(1).alias("copies"),
    )


def _items(rows: DataFrame) -> DataFrame:
    """One item for all equal rows of a turn: count, kind of its text, and whether it is the first of its words."""
    keyed = _keyed(rows)
    core = F.rtrim("text", F.lit(BLANKS))
    ends = F.substring(core, -1, 1).isin(".", "!", "?")
    state = F.when(core == "", "blank").when(ends, "whole").otherwise("cut")
    light = keyed.select(*KEYS, state.alias("text_state"), "copies")
    items = light.groupBy(*KEYS, "text_state").agg(F.sum("copies").alias("copies"))
    # The first turn of the same words; a null turn comes before the others.
    said = ["known", "conv", "role", "text_hash"]
    firsts = light.groupBy(*said).agg(F.min("placed").alias("placed"), F.min("turn").alias("turn"),
                                      F.min(F.when(F.col("placed"), F.col("turn"))).alias("least"))
    firsts = firsts.withColumn("turn", F.when(F.col("placed"), F.col("least")).otherwise(F.lit(0)))
    firsts = firsts.select(*KEYS, F.lit(True).alias("first"))
    return items.join(firsts, KEYS, "left").withColumn("first", F.coalesce("first", F.lit(False)))


def _chunks(items: DataFrame, size: int) -> DataFrame:
    """Runs of at most ``size`` items of one conversation, as arrays, in order of ``chunk``.

    ``chunk`` numbers a conversation's chunks from 0.
    """
    columns = [*KEYS, "text_state", "copies", "first"]
    order = KEYS
    sorted_ = items.select(*columns).repartitionByRange(*order).sortWithinPartitions(*order)
    schema = (
        "known boolean, conv long, part int, run long, kinds binary, spare array<long>, placed array<boolean>, "
        "turns array<long>, roles array<string>, hashes array<long>, rows long, blank long, duplicate long, "
        "cut long, illegal long, first_initial string, last_initial string, n_turns long, least long, most long"
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        out: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in columns)):
                if held and (held[0][:2] != row[:2] or len(held) >= size):
                    out.append(_chunk(held, part, number))
                    held, number = [], number + 1
                held.append(row)
            if out:
                yield _as_batch(out, schema)
                out = []
        if held:
            yield _as_batch([_chunk(held, part, number)], schema)

    chunks = written(sorted_.mapInArrow(build, schema))
    ends = chunks.select("known", "conv", "part", "run")
    # Only the names of chunks are numbered; one name stands for up to ``size`` items.
    numbers = ends.selectExpr(
        "*", "row_number() over (partition by known, conv order by part, run) - 1L as chunk",
        "count(*) over (partition by known, conv) as chunks",
    ).select("part", "run", "chunk", "chunks")
    return written(chunks.join(numbers, ["part", "run"]))


def _as_batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"boolean": pa.bool_(), "long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    kinds |= {f"array<{k}>": pa.list_(v) for k, v in list(kinds.items())}
    fields = [f.split() for f in schema.split(", ")]
    columns = [pa.array(values, kinds[kind]) for (_, kind), values in zip(fields, zip(*rows))]
    return pa.RecordBatch.from_arrays(columns, [name for name, _ in fields])


def _chunk(held: list[tuple], part: int, number: int) -> tuple:
    known, conv = held[0][:2]
    kinds, counts, illegal, last = bytearray(), [0, 0, 0, 0], 0, None
    for _, _, _, _, role, _, state, copies, first in held:
        counts[0] += copies
        counts[1] += copies if state == "blank" else 0
        counts[2] += copies - first if state != "blank" else 0
        counts[3] += state == "cut" and first
        usable = first and state != "blank"
        initial = INITIALS.find(role[:1]) if role else -1
        kinds.append(1 + 2 * (initial if initial >= 0 else 3) + (state == "cut") if usable else 0)
        if last is not None:
            illegal += _illegal(last, role[:1])
        illegal += copies - 1
        last = role[:1]
    turns = [row[3] for row in held if row[2]]
    return (
        known, conv, part, number, bytes(kinds), [row[7] - 1 for row in held], [row[2] for row in held],
        [row[3] for row in held], [row[4] for row in held], [row[5] for row in held], *counts, illegal,
        held[0][4][:1], last, len(set(turns)), min(turns, default=None), max(turns, default=None),
    )


def _illegal(one: str, two: str) -> int:
    return one + two not in ("su", "ua", "au")


# --- passes over chunks ---------------------------------------------------------------------------


def _stitched(chunks: DataFrame, guess: tuple[int, ...] = END) -> DataFrame:
    """``part, run, chunk, known, conv, end``: the vector at each chunk's end, up to a constant, by fix-up passes."""
    vector = "array<int>"

    @F.arrow_udf(vector)
    def first_run(kinds: pa.Array, end: pa.Array) -> pa.Array:
        rows = zip(kinds.to_pylist(), end.to_pylist())
        return pa.array([list(run(k, tuple(e))[0]) for k, e in rows], pa.list_(pa.int32()))

    @F.arrow_udf(vector)
    def fix_up(kinds: pa.Array, earlier: pa.Array, end: pa.Array, start: pa.Array) -> pa.Array:
        rows = zip(*(c.to_pylist() for c in (kinds, earlier, end, start)))
        return pa.array([list(rerun(k, *map(tuple, v))) for k, *v in rows], pa.list_(pa.int32()))

    name = ["known", "conv", "chunk"]
    last = F.col("chunk") == F.col("chunks") - 1
    end = F.when(last, F.array(*map(F.lit, END))).otherwise(F.array(*map(F.lit, guess)))
    runs = chunks.select(*name, "chunks", "kinds", end.alias("end"))
    state = written(runs.withColumn("start", first_run("kinds", "end")).drop("kinds"))
    several = state.filter("chunks > 1")
    steps = chunks.filter("chunks > 1").select(*name, "kinds")
    while True:
        behind = several.select("known", "conv", (F.col("chunk") - 1).alias("chunk"), F.col("start").alias("true_end"))
        met = several.join(behind, name, "left").withColumn("true_end", F.coalesce("true_end", "end"))
        met = met.withColumn("wrong", F.col("true_end") != F.col("end"))
        if not met.filter("wrong").limit(1).count():
            break
        again = met.filter("wrong").join(steps, name)
        again = again.withColumn("start", fix_up("kinds", "end", "true_end", "start"))
        right = again.select(*name, "chunks", F.col("true_end").alias("end"), "start")
        several = written(met.filter("not wrong").select(*name, "chunks", "end", "start").union(right))
    return state.filter("chunks = 1").union(several).select(*name, "end")


def _entries(chunks: DataFrame, ends: DataFrame) -> DataFrame:
    """``known, conv, chunk, end, entry``: the state in which a trace enters each chunk."""
    name = ["known", "conv", "chunk"]

    @F.arrow_udf("array<int>")
    def exits(kinds: pa.Array, end: pa.Array, last: pa.Array) -> pa.Array:
        out = []
        for k, e, z in zip(kinds.to_pylist(), end.to_pylist(), last.to_pylist()):
            vectors = run(k, tuple(e))
            out.append([trace(k, vectors, q, z)[1] for q in range(4)])
        return pa.array(out, pa.list_(pa.int32()))

    joined = chunks.filter("chunks > 1").select(*name, "chunks", "kinds").join(ends, name)
    last = F.col("chunk") == F.col("chunks") - 1
    maps = written(joined.select(*name, exits("kinds", "end", last).alias("map")))
    # The map of a chunk and those before it: twice as many with each round.
    reach = 1
    longest = chunks.agg(F.coalesce(F.max("chunks"), F.lit(0))).first()[0]
    while reach < longest:
        before = maps.select("known", "conv", (F.col("chunk") + reach).alias("chunk"), F.col("map").alias("earlier"))
        composed = F.transform("earlier", lambda q: F.get(F.col("map"), q))
        both = maps.join(before, name, "left")
        maps = written(both.select(*name, F.coalesce(F.when(F.col("earlier").isNotNull(), composed), "map").alias("map")))
        reach *= 2
    entry = maps.select("known", "conv", (F.col("chunk") + 1).alias("chunk"), F.get("map", F.lit(0)).alias("entry"))
    return ends.join(entry, name, "left").withColumn("entry", F.coalesce("entry", F.lit(0)))


def _traced(chunks: DataFrame, entries: DataFrame) -> DataFrame:
    """Each chunk with its ``audit``, ``cost`` and its ``edits``."""
    edit = "struct<place:int,letter:string,role:string,item:int>"
    result = f"struct<audit:string,cost:long,edits:array<{edit}>>"

    @F.arrow_udf(result)
    def traced(kinds: pa.Array, spare: pa.Array, end: pa.Array, entry: pa.Array, last: pa.Array) -> pa.Array:
        out = []
        columns = (c.to_pylist() for c in (kinds, spare, end, entry, last))
        for k, more, e, q, z in zip(*columns):
            out.append(_edits(k, more, run(k, tuple(e)), q, z))
        shape = pa.struct([("place", pa.int32()), ("letter", pa.string()), ("role", pa.string()), ("item", pa.int32())])
        kind = pa.struct([("audit", pa.string()), ("cost", pa.int64()), ("edits", pa.list_(shape))])
        return pa.array(out, kind)

    last = F.col("chunk") == F.col("chunks") - 1
    joined = chunks.join(entries, ["known", "conv", "chunk"])
    return joined.withColumn("traced", traced("kinds", "spare", "end", "entry", last))


def _edits(kinds: bytes, spare: list[int], vectors: list, state: int, last: bool) -> dict:
    steps, _ = trace(kinds, vectors, state, last)
    audit, cost, edits, item = [], 0, [], 0
    for letter, after in steps:
        audit.append(letter)
        if letter == "I":
            cost += INSERT
            edits.append({"place": len(edits), "letter": "I", "role": ROLE_OF[after], "item": None})
            continue
        cut = _cut(kinds[item]) if letter in "KR" else 0
        cost += {"K": KEEP, "R": REROLE, "D": DELETE}[letter] + cut
        if letter != "D":
            role = ROLE_OF[after] if letter == "R" else None
            edits.append({"place": len(edits), "letter": letter, "role": role, "item": item})
        # Equal rows that follow are duplicates (or blank), and go.
        audit.append("D" * spare[item])
        cost += DELETE * spare[item]
        item += 1
    return {"audit": "".join(audit), "cost": cost, "edits": edits}


# --- the operator -----------------------------------------------------------------------------------


class Repair:
    """The repair of a table of conversations (``conv_id, turn, role, text``, and ``copies`` of a row, if given).

    ``summary()`` has one row for each conversation, ``rows()`` the repaired rows in order.
    """

    def __init__(self, rows: DataFrame, chunk: int = CHUNK, guess: tuple[int, ...] = END):
        self.source = rows
        self.chunks = _chunks(_items(rows), chunk)
        ends = written(_stitched(self.chunks, guess))
        self.traced = written(_traced(self.chunks, _entries(self.chunks, ends)))

    def summary(self) -> DataFrame:
        """``known, conv`` (id, if known), ``gaps, blank, duplicate, truncated, illegal, cost, audit``."""
        name = ["known", "conv"]
        behind = self.traced.filter("chunks > 1").select(
            *name, (F.col("chunk") - 1).alias("chunk"), F.col("first_initial").alias("next_initial"),
            F.element_at("turns", 1).alias("next_turn"), F.element_at("placed", 1).alias("next_placed"),
        )
        met = self.traced.join(behind, [*name, "chunk"], "left")
        border = F.concat("last_initial", "next_initial")
        broken = F.when(border.isNotNull() & ~border.isin("su", "ua", "au"), 1).otherwise(0)
        # A turn that goes on in the next chunk is counted there.
        same = F.col("next_placed") & F.element_at("placed", -1) & (F.element_at("turns", -1) == F.col("next_turn"))
        spoken = F.col("n_turns") - F.when(same, 1).otherwise(0)
        parts = F.array_sort(F.collect_list(F.struct("chunk", "traced.audit")))
        return met.groupBy(*name).agg(
            F.coalesce(F.max("most") - F.min("least") + 1 - F.sum(spoken), F.lit(0)).alias("gaps"),
            F.sum("blank").alias("blank"), F.sum("duplicate").alias("duplicate"), F.sum("cut").alias("truncated"),
            F.sum(F.col("illegal") + broken).alias("illegal"), F.sum("traced.cost").alias("cost"),
            F.array_join(F.transform(parts, lambda p: p["audit"]), "").alias("audit"),
        )

    def rows(self) -> DataFrame:
        """``known, conv, chunk, place, letter, role, text``: repaired rows, in order of chunk and place."""
        edits = self.traced.select(
            "known", "conv", "chunk", "placed", "turns", "roles", "hashes", F.explode("traced.edits").alias("edit")
        )

        def of_item(column: str) -> Column:
            return F.get(F.col(column), F.col("edit.item"))

        found = edits.select(
            "known", "conv", "chunk", "edit.place", "edit.letter", F.col("edit.role").alias("new_role"),
            of_item("placed").alias("placed"), of_item("turns").alias("turn"), of_item("roles").alias("role"),
            of_item("hashes").alias("text_hash"),
        )
        texts = _keyed(self.source).groupBy(*KEYS).agg(F.first("text").alias("text"))
        kept = found.filter("letter <> 'I'").join(texts, KEYS)
        added = found.filter("letter = 'I'").withColumn("text", F.lit(""))
        columns = ["known", "conv", "chunk", "place", "letter", F.coalesce("new_role", "role").alias("role"), "text"]
        return kept.select(*columns).union(added.select(*columns))


def repair_digest(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row for each conversation: its faults after the damage, the cost, the edits, and a digest of the result."""
    found = Repair(damaged(conversations), chunk)
    name = ["known", "conv"]
    line = F.concat("role", F.lit(":"), "text")
    digests = joined_sha256(found.rows(), name, ["chunk", "place"], line, "\n", "repaired_sha256")
    ids = conversations.select(
        F.col("conv_id").isNotNull().alias("known"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv")
    ).distinct()
    joined = ids.join(found.summary(), name, "left").join(digests, name, "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select(
        F.when(F.col("known"), F.col("conv")).alias("conv_id"), *counts,
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


# The same in SQL, over rows one by one from a conversation's end: costs, audits and lines of the four states.
SQL = """
WITH RECURSIVE named AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
    FROM conversations
), fated AS (
    SELECT *, xor(list_reduce(
        [4294967295::BIGINT] || list_transform(range(1, length(name) + 1), lambda i: ord(substr(name, i::INT, 1))::BIGINT),
        lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))
    ), 4294967295) % 20 AS fault
    FROM named
), hurt AS (
    SELECT conv_id, turn, copy, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
        CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM fated, (VALUES (1), (2)) AS copies(copy)
    WHERE fault <> 0 AND (copy = 1 OR fault = 3)
), seen AS (
    SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS core,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again
    FROM hurt
), judged AS (
    SELECT *, core = '' AS blank, core <> '' AND again AS duplicate,
        core <> '' AND NOT again AND right(core, 1) NOT IN ('.', '!', '?') AS truncated, left(role, 1) AS initial,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) || left(role, 1) AS pair
    FROM seen
), counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n_rows,
        count_if(blank) AS blank, count_if(duplicate) AS duplicate, count_if(truncated) AS truncated,
        count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM judged GROUP BY conv_id
), back(conv_id, n, b0, b1, b2, b3) AS (
    SELECT conv_id, n_rows + 1, {'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]},
        {'cost': 10::BIGINT, 'audit': 'II', 'lines': ['user:', 'assistant:']},
        {'cost': 5::BIGINT, 'audit': 'I', 'lines': ['assistant:']},
        {'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]}
    FROM counted
    UNION ALL
    SELECT conv_id, n,
        list_sort([t0, {'cost': c2.cost + 5, 'audit': 'I' || c2.audit, 'lines': ['user:'] || c2.lines}])[1],
        list_sort([t1, {'cost': c2.cost + 5, 'audit': 'I' || c2.audit, 'lines': ['user:'] || c2.lines}])[1],
        c2,
        list_sort([t3, {'cost': t2.cost + 5, 'audit': 'I' || t2.audit, 'lines': ['user:'] || t2.lines}])[1]
    FROM (
        SELECT *,
            list_sort([t2, {'cost': t3.cost + 5, 'audit': 'I' || t3.audit, 'lines': ['assistant:'] || t3.lines}])[1] AS c2
        FROM (
            SELECT b.conv_id, r.n,
                list_sort(list_filter([
                    {'cost': b0.cost + 2, 'audit': 'D' || b0.audit, 'lines': b0.lines},
                    CASE WHEN ok AND initial = 's' THEN {'cost': b1.cost + cut, 'audit': 'K' || b1.audit, 'lines': [line] || b1.lines}
                        WHEN ok AND initial = 'u' THEN {'cost': b2.cost + cut, 'audit': 'K' || b2.audit, 'lines': [line] || b2.lines} END,
                    CASE WHEN ok THEN {'cost': b2.cost + cut + 1, 'audit': 'R' || b2.audit, 'lines': ['user:' || r.text] || b2.lines} END
                ], lambda x: x IS NOT NULL))[1] AS t0,
                list_sort(list_filter([
                    {'cost': b1.cost + 2, 'audit': 'D' || b1.audit, 'lines': b1.lines},
                    CASE WHEN ok AND initial = 'u' THEN {'cost': b2.cost + cut, 'audit': 'K' || b2.audit, 'lines': [line] || b2.lines} END,
                    CASE WHEN ok THEN {'cost': b2.cost + cut + 1, 'audit': 'R' || b2.audit, 'lines': ['user:' || r.text] || b2.lines} END
                ], lambda x: x IS NOT NULL))[1] AS t1,
                list_sort(list_filter([
                    {'cost': b2.cost + 2, 'audit': 'D' || b2.audit, 'lines': b2.lines},
                    CASE WHEN ok AND initial = 'a' THEN {'cost': b3.cost + cut, 'audit': 'K' || b3.audit, 'lines': [line] || b3.lines} END,
                    CASE WHEN ok THEN {'cost': b3.cost + cut + 1, 'audit': 'R' || b3.audit, 'lines': ['assistant:' || r.text] || b3.lines} END
                ], lambda x: x IS NOT NULL))[1] AS t2,
                list_sort(list_filter([
                    {'cost': b3.cost + 2, 'audit': 'D' || b3.audit, 'lines': b3.lines},
                    CASE WHEN ok AND initial = 'u' THEN {'cost': b2.cost + cut, 'audit': 'K' || b2.audit, 'lines': [line] || b2.lines} END,
                    CASE WHEN ok THEN {'cost': b2.cost + cut + 1, 'audit': 'R' || b2.audit, 'lines': ['user:' || r.text] || b2.lines} END
                ], lambda x: x IS NOT NULL))[1] AS t3
            FROM back AS b JOIN (
                SELECT *, NOT blank AND NOT duplicate AS ok, CASE WHEN truncated THEN 5 ELSE 0 END AS cut, role || ':' || text AS line
                FROM judged
            ) AS r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.n = b.n - 1
        )
    )
), ids AS (
    SELECT DISTINCT conv_id FROM conversations
)
SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
    coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
    coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b0.cost, 0)::BIGINT AS cost, coalesce(b0.audit, '') AS audit,
    sha256(coalesce(array_to_string(b0.lines, chr(10)), '')) AS repaired_sha256
FROM ids LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM ids.conv_id
    LEFT JOIN back ON back.conv_id IS NOT DISTINCT FROM ids.conv_id AND back.n = 1
"""
