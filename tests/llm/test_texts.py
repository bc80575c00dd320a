"""Encoding, packing, personal data, fingerprints: against libraries and plain versions."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pagevane.llm import bpe, fingerprints, packing, personal
from pagevane.llm.queries import CAPACITY, QUERIES, RANKS, TOKENIZER

from ..conftest import DATA, table

SF = f"{DATA}/sf0.001"
RANK_FILE = public_tokenizers.path(RANKS)
TOKENIZER_FILE = public_tokenizers.path(TOKENIZER)


@pytest.fixture(scope="module")
def replay():
    return bpe.MergeReplay(RANK_FILE, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(replay):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=replay.ranks, special_tokens={}
    )


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab aeé's.1\n\t\xa0\x1c漢🙂", max_size=80), max_size=5))
def test_merge_replay_is_the_tokenizer(texts):
    replay = bpe.coder(RANK_FILE, public_tokenizers.PATTERN)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=replay.ranks, special_tokens={})
    for text, ids in zip(texts, replay.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == own.encode_ordinary(text)
        assert replay.decode(ids) == text.encode()


def test_equal_ranks_merge_from_the_left_and_lower_ranks_come_first(replay, reference):
    for text in ("a" * 300, "=" * 333, "ababab" * 40, "\n" * 50, "the" * 99):
        assert np.frombuffer(replay.encode([text])[0], "<u4").tolist() == reference.encode_ordinary(text)


def test_bpe_query_is_the_tokenizer(spark, reference):
    texts = {r.doc_id: r.text for r in table(spark, "documents").collect()}
    rows = QUERIES["op2_byte_bpe"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = np.array(reference.encode_ordinary(texts[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_bpe_of_odd_rows(odd, none, reference):
    found = Counter((r.doc_id, r.n_tokens) for r in bpe.encode_digest(odd, RANK_FILE, public_tokenizers.PATTERN).collect())
    assert found == Counter((r.doc_id, len(reference.encode_ordinary(r.text or ""))) for r in odd.collect())
    assert bpe.encode_digest(none, RANK_FILE, public_tokenizers.PATTERN).collect() == []
    both = odd.select("text", bpe.encode("text", RANK_FILE, public_tokenizers.PATTERN).alias("ids"))
    both = both.select("text", bpe.decode("ids", RANK_FILE, public_tokenizers.PATTERN).alias("back"))
    assert all(bytes(r.back) == (r.text or "").encode() for r in both.collect())


def _check_packing(rows, texts):
    """Every piece as it must be, and sequences without gaps or excess."""
    tokenizer = Tokenizer.from_file(TOKENIZER_FILE)
    own = defaultdict(list)
    for r in rows:
        own[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    expected = defaultdict(list)
    for doc_id, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at, to, n = 0, len(ids) % CAPACITY or CAPACITY, 0
        while at < len(ids):
            expected[doc_id].append((n, at, to - at, zlib.crc32(ids[at:to].tobytes())))
            at, to, n = to, to + CAPACITY, n + 1
    assert {k: sorted(v) for k, v in own.items()} == {k: sorted(v) for k, v in expected.items()}
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= CAPACITY
    return len(sequences)


def test_words_with_signs_need_no_search(monkeypatch):
    odd = ["a,. b?! été; ... , a.b it's x1. й. ª, a,b,", "mot mot, mot. mot,;", "", " ", "  a, b", "a\n, b", "x., \n y"]
    ids = packing._Ids(TOKENIZER_FILE, True)
    expected = [np.array(ids.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in odd]
    assert ids.encode(odd) == expected
    ids.forget()
    searched, cut = [], ids.cut
    monkeypatch.setattr(ids, "cut", lambda unit: searched.append(unit) or cut(unit), raising=False)
    assert ids.encode(odd[1:2]) == expected[1:2]
    assert searched == ["mot"]
    monkeypatch.setattr(packing, "CACHE_UNITS", 2)
    assert ids.encode(odd) == expected and max(map(len, (ids.units, ids.spaced, ids.pieces))) <= 2


def test_merging_by_ranks_gives_the_models_ids():
    assert packing.by_ranks(TOKENIZER_FILE)
    texts = [d + " \n\t x <|endoftext|> é漢字🙂 it's 1234567 \x00" for d in ("", "Word's", "ünï  codé", "a" * 5000)]
    plain, ranked = packing._Ids(TOKENIZER_FILE), packing._Ids(TOKENIZER_FILE, True)
    assert plain.encode(texts) == ranked.encode(texts)


def test_packing_query(spark):
    rows = QUERIES["op3_best_fit_packing"](spark, SF).collect()
    texts = [(r.doc_id, r.text) for r in table(spark, "documents").collect()]
    used = _check_packing(rows, texts)
    total = sum(r.length for r in rows)
    assert used <= -(-total // CAPACITY) + 1


def test_packing_of_odd_rows(odd, none):
    rows = packing.pack(odd, TOKENIZER_FILE, CAPACITY).collect()
    _check_packing(rows, [(r.doc_id, r.text) for r in odd.collect()])
    assert packing.pack(none, TOKENIZER_FILE, CAPACITY).collect() == []


def _hold(found, counts, capacity):
    held = Counter()
    for filling, times in found:
        assert sum(k * n for k, n in filling) <= capacity and times > 0
        for k, n in filling:
            held[k] += n * times
    assert held == Counter(counts)
    return sum(times for _, times in found)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 24), st.integers(1, 9), max_size=12))
def test_plans_hold_all_and_are_no_worse_than_best_fit(counts):
    used = _hold(packing.plan(counts, 24), counts, 24)
    assert packing.lower_bound(counts, 24) <= used <= sum(n for _, n in packing.best_fit(counts, 24))


def _least(lengths, capacity):
    """Fewest sequences, by trying each length in each of them."""
    best = len(lengths)

    def put(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for room in set(rooms):
            if room >= lengths[i]:
                rest = list(rooms)
                rest[rest.index(room)] -= lengths[i]
                put(i + 1, rest)
        put(i + 1, [*rooms, capacity - lengths[i]])

    put(0, [])
    return best


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_plans_are_optimal_where_the_search_ends(lengths):
    lengths.sort(reverse=True)
    counts = dict(Counter(lengths))
    assert _hold(packing.plan(counts, 20, 10**6), counts, 20) == _least(lengths, 20)


def test_search_fills_sequences_and_knows_dominance():
    counts = {7: 1, 6: 1, 5: 2, 4: 1, 3: 1}  # 30 in three of 10
    assert _hold(packing.plan(counts, 10), counts, 10) == 3
    found = dict(packing.fillings({10: 1, 8: 1, 5: 1, 3: 1, 2: 2, 1: 1}, 18))
    assert found[(10, 1), (8, 1)] is False
    assert found[(10, 1), (5, 1), (3, 1)] is True  # the 8 can stand for both
    assert found[(10, 1), (5, 1), (2, 1)] is True  # the 3 can stand for the 2


def test_all_undominated_fillings_are_listed():
    left = {9: 1, 6: 2, 5: 1, 4: 2, 2: 3, 1: 2}
    found = list(packing.fillings(left, 20))
    every = set()
    pool = sorted((Counter(left) - Counter([9])).elements())
    for n in range(len(pool) + 1):
        for some in itertools.combinations(pool, n):
            if sum(some) <= 11:
                every.add(tuple(sorted(Counter([9, *some]).items(), reverse=True)))
    assert {f for f, _ in found} == every and len(found) == len(every)
    waste = [20 - packing.size(f) for f, _ in found]
    assert waste == sorted(waste)


def test_very_many_short_documents():
    """Rows without text are one token each: a filling holds more of them than Python's stack has room for."""
    counts = {700: 300, 1: 5000}
    assert _hold(packing.plan(counts, 2048), counts, 2048) == 150
    _hold(packing.plan({1: 10**9, 2048: 10**6, 3: 7}, 2048), {1: 10**9, 2048: 10**6, 3: 7}, 2048)
    picked = random.Random(4)
    counts = {k: picked.randrange(1, 10**6) for k in range(1, 2049)}
    found = packing.plan(counts, 2048)
    assert _hold(found, counts, 2048) >= packing.lower_bound(counts, 2048)


def test_packing_of_many_empty_texts(spark):
    words = "word " * 350
    rows = spark.range(5300).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 300, words).otherwise("").alias("text"))
    found = packing.pack(rows, TOKENIZER_FILE, CAPACITY).collect()
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    assert len(found) == 5300
    for places in sequences.values():
        ends = 0
        for offset, length in sorted(places):
            assert offset == ends
            ends += length
        assert ends <= CAPACITY


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text: str) -> list[tuple[int, int, str]]:
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                kind == "email"
                or (kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")))
                or (kind == "card" and 14 <= len(digits) <= 19 and personal.luhn(digits))
                or (kind == "phone" and 10 <= len(digits) <= 15)
            ):
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], list(PATTERNS).index(s[2])))


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="12.@+- ()ab0\n", max_size=60))
def test_base_spans_are_those_of_the_rules(text):
    assert personal.base_spans(text) == plain_spans(text)


def test_personal_query(spark):
    texts = {r.doc_id: r.text for r in table(spark, "documents").collect()}
    rows = QUERIES["op7_personal_data"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain_spans(texts[r.doc_id])
        said = ",".join(f"{k}:{s}:{e}" for s, e, k in base)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b[2] == k for b in base) for k in PATTERNS]
        assert set(filter(None, said.split(","))) <= set(r.spans.split(","))


@pytest.fixture(scope="module")
def weights(spark):
    return personal.fit(table(spark, "documents", "sf0.01"))


@pytest.mark.parametrize(
    ("text", "added"),
    [
        ("write to anna at mail dot org today", ["email"]),
        ("see jo[at]site[dot]com there", ["email"]),
        ("pay by 4111.1111.1111.1111 now", ["card"]),
        ("it was at home. Then we left at noon. No one came", []),
        ("about 12,345,678 people in 1999 and 2004/05", []),
        ("pay by 4111.1111.1111.1112 now", []),
        ("from 10[.]20[.]30[.]40 on", ["ip"]),
    ],
)
def test_the_field_adds_spans(weights, text, added):
    base, more = personal.find_spans(text, weights)
    assert base == [] and [k for *_, k in more] == added


@pytest.mark.parametrize(
    ("text", "added"),
    [
        ("call 555-123-4567, 555-987-6543", ["555-123-4567", "555-987-6543"]),
        ("in 2024, 555-123-4567", ["555-123-4567"]),
        ("(212) 555-0100, (212) 555-0101", ["(212) 555-0100", "(212) 555-0101"]),
        ("555-123-4567 5pm", ["555-123-4567"]),
        ("10[.]0[.]0[.]1, 10[.]0[.]0[.]2, 10[.]0[.]0[.]3", ["10[.]0[.]0[.]1", "10[.]0[.]0[.]2", "10[.]0[.]0[.]3"]),
    ],
)
def test_neighbouring_numbers_are_parted(weights, text, added):
    found = personal.candidates(text)
    assert all((text.find(a), text.find(a) + len(a)) in found for a in added)
    assert [text[s:e] for s, e, _ in personal.find_spans(text, weights)[1]] == added


@pytest.mark.parametrize(
    ("text", "added"),
    [
        ("reach anna at mail dot org and bob at site dot com dot Thanks", ["anna at mail dot org", "bob at site dot com"]),
        ("write to jo.smith at site dot com.Then wait", ["jo.smith at site dot com"]),
        ("mail eve at a dot b dot c dot d dot e dot site dot org today", ["eve at a dot b dot c dot d dot e dot site dot org"]),
    ],
)
def test_spelt_addresses_end_where_the_field_says(weights, text, added):
    found = personal.candidates(text)
    assert all((text.find(a), text.find(a) + len(a)) in found for a in added)
    assert [text[s:e] for s, e, _ in personal.find_spans(text, weights)[1]] == added


def test_spelt_candidates_have_each_start_and_end():
    found = {"x a.b at c dot d.ef, g"[s:e] for s, e in personal.candidates("x a.b at c dot d.ef, g")}
    assert found == {"a.b at c dot d", "b at c dot d", "a.b at c dot d.ef", "b at c dot d.ef"}


def test_training_reads_whole_texts(spark):
    late = "plain words " * 2000 + "write to anna@mail.org today"
    assert personal.fit(spark.createDataFrame([(late,)], "text string"))
    many = [f"u{i:03}@m.nn" for i in range(40)]
    taken = {text[s:e] for text, gold in personal.make_examples([" ".join(many)]) for s, e, _ in gold}
    assert len(taken & set(many)) == 4 and taken & set(many[4:])


def test_candidates_are_all_parts_of_groups():
    text = " ".join(str(i) for i in range(10, 34))
    groups = [m.span() for m in re.finditer("[0-9]+", text)]
    parts = {(s, e) for (s, _), (_, e) in itertools.combinations_with_replacement(groups, 2) if e - s <= 64}
    assert personal.candidates(text) == sorted(parts)


def test_added_spans_are_right_on_texts_not_trained_on(spark, weights):
    texts = [r.text for r in table(spark, "documents", "sf0.1").orderBy("doc_id").collect()]
    texts = [t for t in texts if re.search(r"@|[0-9]{4}", t)][-150:]
    right = total = 0
    for text, gold in personal.make_examples(texts):
        base, more = personal.find_spans(text, weights)
        found = {*base, *more}
        right += set(gold) <= found if gold else not found
        total += 1
    assert right / total > 0.97


def test_best_segmentation_is_that_of_all_subsets(weights):
    rng = random.Random(5)
    for _ in range(40):
        text = " ".join(rng.choice(["555-123-4567", "12", "4111.1111", "(212) 555-0100", "x", "10.0.0.1 . 7"]) for _ in range(4))
        options = [
            (s, e, k, personal._score(weights, text, s, e, k))
            for s, e in personal.candidates(text)
            for k in personal.KINDS
        ]
        options = [o for o in options if o[3] > 0]
        best = 0.0

        def grow(i, end, score):
            nonlocal best
            best = max(best, score)
            for j in range(i, len(options)):
                if options[j][0] >= end:
                    grow(j + 1, options[j][1], score + options[j][3])

        options.sort()
        grow(0, 0, 0.0)
        found = personal.segment(text, [], weights)
        assert abs(sum(personal._score(weights, text, *s) for s in found) - best) < 1e-9


def test_personal_data_of_odd_rows(odd, none, weights):
    rows = personal.span_digest(odd, weights=weights).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in odd.collect())
    (mixed,) = [r for r in rows if r.doc_id == 12]
    assert (mixed.n_email, mixed.n_ip, mixed.n_phone) == (1, 1, 1)
    assert personal.span_digest(none).collect() == []
    covered = odd.select("doc_id", personal.mask(odd["text"], weights).alias("t")).collect()
    assert [r.t for r in covered if r.doc_id == 12] == ["éèê ça  va\xa0bien 漢字 🙂 [email] [phone] and [ip]"]
    assert [r.t for r in covered if r.doc_id == 3] == [None]


def test_long_texts_take_linear_time():
    import time

    began = time.perf_counter()
    for text in ("a" * 10**6, "1" * 10**6, "1." * 10**6, "+1" * 10**5, "a@" * 10**5, "1 " * 10**5, "- " * 10**6):
        personal.find_spans(text, {})
    assert time.perf_counter() - began < 60


def test_fingerprint_query(spark):
    docs = sorted(table(spark, "documents").collect(), key=lambda r: r.doc_id)
    rows = {r.doc_id: r for r in QUERIES["op8_fingerprints"](spark, SF).collect()}
    prints = defaultdict(set)
    better = 0
    for d, following in zip(docs, docs[1:] + docs[:1]):
        half = len(d.text) // 2
        edited = d.text[: len(d.text) - half] + following.text[:half]
        r = rows[d.doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(d.text), hashlib.sha256(edited.encode()).hexdigest())
        prints[d.text].add(r.fingerprint)
        better += r.near_edited > r.near_next
    assert all(len(p) == 1 for p in prints.values())
    assert better > 0.95 * len(docs)


def test_fingerprints_of_odd_rows(odd, none):
    rows = fingerprints.edited_fingerprints(odd).collect()
    assert Counter((r.doc_id, r.n_chars) for r in rows) == Counter((r.doc_id, len(r.text or "")) for r in odd.collect())
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert fingerprints.edited_fingerprints(none).collect() == []


def test_equal_substrings_share_phrases_at_any_offset():
    rng = random.Random(2)
    shared = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    one, other = ("".join(rng.choice("abcdefgh ") for _ in range(n)) + shared for n in (501, 1234))

    def names(text):
        data = np.frombuffer(text.encode(), np.uint8)
        symbols, at = data, np.array([0, len(data)])
        for _ in range(3):
            symbols, at = fingerprints.parse(symbols, at)
        return set(symbols.tolist())

    assert len(names(one) & names(other)) > 0.9 * len(names(shared))


def test_fingerprints_dont_depend_on_neighbours():
    texts = ["abc" * 40, "", "xyz", "abc" * 40, "q" * 200, "abcabcabd" * 9]
    together = fingerprints.of_texts(texts)
    assert together == [fingerprints.of_texts([t])[0] for t in texts]
    assert fingerprints.likeness(together[0], together[3]) == 1.0
    assert fingerprints.likeness(together[1], together[1]) == 1.0
