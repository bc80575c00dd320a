"""Conversations and archives: repair (11), prefix trie (12), web archives (13)."""

from __future__ import annotations

import hashlib
import random
import zlib
from functools import lru_cache

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

from pagevane.llm import archives, prefixes, repair
from tests.conftest import DATA, table

TURNS = "conv_id long, turn long, role string, text string"
CLASH = (
    ", known boolean, conv int, chunk string, kinds int, n string, x string, part int, depth string, copies_ int, "
    "id string, parent string, member int, text_hash int"
)
EXTRA = (True, 1, "c", 2, "n", "x", 3, "d", 4, "i", "p", 5, 6)


def odd_turns() -> list[tuple]:
    """Nulls in each column, ties, repeated rows, other roles, a very long text, a long conversation."""
    rows = [
        (0, 0, "system", "Be kind."), (0, 1, "user", "Hello."), (0, 2, "assistant", "Hello!"), (0, 3, "user", "Bye."),
        (1, 0, "user", "Hello."), (1, 1, "user", "Hello."), (1, 2, "assistant", "cut off"), (1, None, "assistant", "Early."),
        (2, 0, None, "No role."), (2, 1, "user", None), (2, 2, "", "Empty role."), (2, 3, "tool", "Result."),
        (3, 5, "user", " \t\n"), (3, 9, "assistant", "Fine. \n"), (3, 9, "assistant", "Tie."), (3, 9, "assistant", "Tie."),
        (4, None, "user", "A?"), (4, None, "user", "A?"), (4, None, "assistant", "B."), (4, 1, "assistant", "C."),
        (5, 0, "system", "Be kind."), (5, 1, "user", "Hello."), (5, 2, "assistant", "Hello!"), (5, 3, "user", "More."),
        (6, 0, "system", "Be kind."), (7, 0, "Été", "Ça va\xa0"), (8, 0, "user", "é🙂" * 90_000 + "."),
        (9, 0, "assistant", "x"), (None, 0, "user", "Nobody."), (None, None, None, None), (-3, 0, "user", "Below."),
    ]
    picked = random.Random(7)
    words = ["Yes.", "No!", "Why", "", "Again?"]
    rows += [(11, t, picked.choice(["user", "assistant", "system"]), picked.choice(words)) for t in range(60)]
    rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"Shared {t}.") for c in range(20, 26) for t in range(c - 12)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*row, *EXTRA) for row in rows], TURNS + CLASH)


# --- 11: repair -------------------------------------------------------------------------------------


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def plain_repair(rows: list[tuple]) -> dict:
    """Each conversation by a search over all edits from its end."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            name = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
            fault = zlib.crc32(name.encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            if fault == 0:
                continue
            text = {1: "", 2: text.translate({ord(c): None for c in ".!?"})}.get(fault, text)
            role = "user" if fault == 4 else role
            mine += [(turn, role, text)] * (2 if fault == 3 else 1)
        key = lambda r: (r[0] is not None, r[0] or 0, r[1], _signed(xxhash.xxh64(r[2].encode(), seed=42).intdigest()))
        mine.sort(key=key)
        out[conv] = _plain(mine)
    return out


def _plain(mine: list[tuple]) -> tuple:
    faults = []
    for i, (_, role, text) in enumerate(mine):
        core = text.strip(" \t\n\x0b\x0c\r")
        if not core:
            faults.append("blank")
        elif any(r[1:] == (role, text) for r in mine[:i]):
            faults.append("duplicate")
        else:
            faults.append("" if core[-1] in ".!?" else "truncated")
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @lru_cache(None)
    def best(i: int, state: str, inserts: int) -> tuple:
        ways = []
        if i == len(mine) and state in ("", "a"):
            ways.append((0, "", ()))
        if inserts < 3:
            for name in ("user", "assistant"):
                if (state, name[0]) in after:
                    c, a, lines = best(i, after[state, name[0]], inserts + 1)
                    ways.append((c + 5, "I" + a, (name + ":", *lines)))
        if i < len(mine):
            _, role, text = mine[i]
            c, a, lines = best(i + 1, state, 0)
            ways.append((c + 2, "D" + a, lines))
            if faults[i] in ("", "truncated"):
                more = 5 if faults[i] else 0
                for name, letter, price in ((role, "K", 0), ("user", "R", 1), ("assistant", "R", 1)):
                    if (state, name[:1]) in after:
                        c, a, lines = best(i + 1, after[state, name[:1]], 0)
                        ways.append((c + price + more, letter + a, (f"{name}:{text}", *lines)))
        return min(ways, default=(10**9, "", ()))

    cost, audit, lines = best(0, "", 0)
    turns = [t for t, _, _ in mine if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(mine, mine[1:])]
    counts = [faults.count(k) for k in ("blank", "duplicate", "truncated")]
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest)


@pytest.mark.parametrize("chunk", [2, 4096])
def test_repair_equals_a_search_over_all_edits(spark, chunk):
    rows = odd_turns()
    found = repair.repair_digest(frame(spark, rows), chunk).collect()
    assert {r["conv_id"]: tuple(r)[1:] for r in found} == plain_repair(rows)
    assert len(found) == len({r[0] for r in rows})


def test_repair_of_nothing(spark):
    assert repair.repair_digest(frame(spark, [])).count() == 0


def test_chunks_meet_whatever_they_started_from():
    """Any guess leads to the vector of one run over the whole, up to a constant."""
    picked = random.Random(3)
    for _ in range(200):
        kinds = bytes(picked.choice(range(9)) for _ in range(picked.randrange(1, 40)))
        end = repair.END
        guess = repair.normal(tuple(picked.randrange(12) for _ in range(4)))
        start = repair.run(kinds, guess)[0]
        assert repair.rerun(kinds, guess, end, start) == repair.run(kinds, end)[0]


def test_a_bad_guess_needs_more_passes_and_changes_nothing(spark):
    rows = [(1, t, "user" if t % 3 else "assistant", f"Words {t}.") for t in range(50)]
    df = spark.createDataFrame(rows, TURNS)
    two = [repair.Repair(df, 4, guess).summary().collect() for guess in (repair.END, (7, 0, 11, 3))]
    assert two[0] == two[1]


def test_many_equal_rows_are_one_item(spark):
    rows = spark.range(5000).select(F.lit(1).alias("conv_id"), F.lit(0).alias("turn"), F.lit("user").alias("role"), F.lit("Hi.").alias("text"))
    found = repair.Repair(rows.withColumn("text", F.lit("Hi.")))
    assert found.chunks.selectExpr("sum(size(roles))").first()[0] == 1
    (row,) = found.summary().collect()
    assert (row["duplicate"], row["illegal"], row["cost"]) == (4999, 4999, 10_000)
    assert row["audit"] == "D" * 5000


def test_repaired_rows_alternate(spark):
    found = repair.Repair(repair.damaged(table(spark, "conversations"))).rows().collect()
    by_conv: dict = {}
    for r in sorted(found, key=lambda r: (r["conv"], r["chunk"], r["place"])):
        by_conv.setdefault(r["conv"], []).append(r["role"][0])
    assert by_conv
    for roles in by_conv.values():
        text = "".join(roles)
        assert text.removeprefix("s") == "ua" * (len(text.removeprefix("s")) // 2)


# --- 12: prefix trie --------------------------------------------------------------------------------


def plain_trie(rows: list[tuple]) -> dict:
    own: dict = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn, role or "", text or ""))
    for turns in own.values():
        x = lambda r: _signed(xxhash.xxh64(r[2].encode(), seed=xxhash.xxh64(r[1].encode(), seed=42).intdigest()).intdigest())
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], x(r)))
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = tuple(r[1:] for r in own.get(c - c % 5, [])[:h] + turns[h:])
    members: dict = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    out = {}
    for node, convs in members.items():
        below = [m for m in members if m[: len(node)] == node]
        children = [m for m in below if len(m) == len(node) + 1]
        leaves = [m for m in below if not any(k[:-1] == m for k in below if k)]
        saved = sum((len(members[m]) - 1) * len(m[-1][1].encode()) for m in below if m)
        ends = ",".join(str(c) for c in sorted(convs) if len(paths[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out[min(convs), len(node)] = (
            parent, len(convs), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest(),
        )
    return out


@pytest.mark.parametrize("chunk", [2, 4096])
def test_trie_equals_a_plain_one(spark, chunk):
    rows = odd_turns()
    found = prefixes.trie_digest(frame(spark, rows), chunk).collect()
    assert {tuple(r)[:2]: tuple(r)[2:] for r in found} == plain_trie(rows)
    assert len(found) == len(plain_trie(rows))


def test_trie_of_nothing(spark):
    assert prefixes.trie_digest(frame(spark, [])).count() == 0
    assert prefixes.trie_digest(frame(spark, [(None, 0, "user", "x")])).count() == 0


def test_totals_of_any_tree(spark):
    """Chains, stars and random trees: contraction gives the totals of a plain recursion."""
    picked = random.Random(5)
    parents = [None] + list(range(60)) + [10] * 40 + [picked.randrange(i) for i in range(101, 200)]
    total = [i + 1 for i in range(len(parents))]
    for i in range(len(parents) - 1, 0, -1):
        total[parents[i]] += total[i]
    tree = spark.createDataFrame([(i, p, i + 1) for i, p in enumerate(parents)], "id long, parent long, w long")
    assert dict(prefixes.subtree_totals(tree, "w").collect()) == dict(enumerate(total))


# --- 13: archives -----------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string"
PAGE_CLASH = ", digest string, bucket int, size string, last int, response string, copies int, path string, content int"


def odd_pages() -> list[tuple]:
    long = "<p>" + "é🙂 long page " * 30_000
    shared = "<html>" + "same words " * 200
    small = "<p>small</p>"
    return [
        (1, "http://a/x y\r\nWARC-Type: revisit", shared), (2, None, shared), (3, "http://a/ü", shared), (4, "u", small), (5, "u", small),
        (6, "u", None), (7, "u", ""), (8, "u", long), (9, "v", long), (9, "v", long), (None, "w", shared), (None, None, None),
        (10, "u", "a" * 999), (11, "u", "a" * 999), (12, "u", "b" * 1000), (13, "u", "b" * 1000), (14, "u", "é" * 500), (15, "u", "é" * 500),
        (16, "z", "\x00WARC/1.1\r\n\r\n\r\n" * 100),
    ]


def plain_pages(rows: list[tuple]) -> list[tuple]:
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        equal = [p for p, _, h in rows if (h or "").encode() == data]
        best = max((p for p in equal if p is not None), default=None) if len(data) >= 1000 else None
        revisit = best is not None and page != best
        digest = hashlib.sha1(data).hexdigest()
        out.append((page, len(data), digest, "revisit" if revisit else "response", best if revisit else None))
    return sorted(out, key=str)


def test_archives_equal_plain_bookkeeping(spark):
    rows = odd_pages()
    pages = spark.createDataFrame([(*r, "d", 1, "s", 2, "r", 3, "p", 4) for r in rows], PAGES + PAGE_CLASH)
    assert sorted(map(tuple, archives.archived(pages).collect()), key=str) == plain_pages(rows)


def test_archives_give_pages_back(spark, tmp_path):
    pages = table(spark, "pages", "sf0.01")
    copies = pages.withColumn("page_id", F.col("page_id") + 100_000)
    folder = str(tmp_path / "archives")
    archives.write_archives(pages.union(copies), folder)
    found = archives.read_archives(spark, folder)
    whole = found.filter("record_type = 'response'")
    got = {r["page_id"]: (r["url"], bytes(r["payload"])) for r in whole.collect()}
    for r in pages.collect():
        html = r["html"].encode()
        assert got[r["page_id"] + 100_000] == (r["url"], html)
        assert (r["page_id"] in got) == (len(html) < 1000)
    # Records that others refer to are there.
    ids = {r["record_id"] for r in found.collect()}
    assert len(ids) == 2 * pages.count()


def test_an_archive_is_frames_that_a_plain_reader_can_use(spark, tmp_path):
    import struct

    import zstandard

    folder = tmp_path / "archives"
    archives.write_archives(table(spark, "pages", "sf0.01"), str(folder))
    (file,) = [f for f in folder.iterdir() if f.name.startswith("part-") and f.stat().st_size]
    data = file.read_bytes()
    magic, size = struct.unpack_from("<II", data)
    assert magic == archives.DICTIONARY
    shared = zstandard.ZstdDecompressor().decompress(data[8 : 8 + size])
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(shared))
    # A stream reader over all frames skips the separators.
    text = reader.stream_reader(data[8 + size :], read_across_frames=True).read()
    assert text.count(b"WARC/1.1\r\n") == table(spark, "pages", "sf0.01").count()
    # The dictionary pays: records without it are larger.
    alone = sum(len(zstandard.ZstdCompressor(level=archives.LEVEL).compress(r)) for r in archives.unpacked(data))
    assert len(data) < alone


def test_a_cut_off_archive_is_an_error(spark, tmp_path):
    folder = tmp_path / "archives"
    archives.write_archives(table(spark, "pages"), str(folder))
    (file,) = [f for f in folder.iterdir() if f.name.startswith("part-") and f.stat().st_size]
    data = file.read_bytes()
    assert len(list(archives.unpacked(data))) == 50
    with pytest.raises(ValueError):
        list(archives.unpacked(data[:-20]))


def test_archives_of_nothing(spark):
    assert archives.archived(spark.createDataFrame([], PAGES)).count() == 0


# --- the queries against SQL ------------------------------------------------------------------------


@pytest.mark.parametrize(
    "name",
    ["op5_embedding_near_dedup", "op6_ngram_jaccard", "op10_substring_dedup", "op11_conversation_repair", "op12_prefix_trie", "op13_warc"],
)
def test_query_equals_sql(spark, name):
    from pagevane.llm import queries

    folder = f"{DATA}/sf0.01"
    got = queries.QUERIES[name](spark, folder)
    con = duckdb.connect()
    for t in ("conversations", "documents", "embeddings", "pages"):
        con.sql(f"create view {t} as select * from '{folder}/{t}.parquet'")
    want = con.sql(queries.ORACLE_SQL[name])
    assert set(got.columns) == set(want.columns)
    rows = sorted((tuple(r) for r in got.select(*want.columns).collect()), key=str)
    assert rows == sorted(want.fetchall(), key=str)
