"""Joins over the corpus, lines, licenses, toxicity and the pipeline: against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import pathlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from pagevane.llm import jaccard, licenses, lines, near_vectors, substrings, toxicity
from pagevane.llm.common import _work_folder
from pagevane.llm.components import connected
from pagevane.llm.queries import ORACLE_SQL, QUERIES

from ..conftest import DATA, plan_of, table

SF = f"{DATA}/sf0.001"
WORDS = re.compile("[^\x20\x09-\x0d]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def groups(nodes, linked):
    """Smallest node reachable from each."""
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {n: top(n) for n in parent}


def plain_jaccard(rows):
    """Sizes and components by comparing all pairs."""
    sets = []
    for i, text in rows:
        w = WORDS.findall(lowered(text or ""))
        sets.append((i, frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()))
    some = [(i, s) for i, s in sets if s and i is not None]
    linked = [
        (a, b)
        for (a, x), (b, y) in itertools.combinations(some, 2)
        if 100 * len(x & y) >= 75 * len(x | y)
    ]
    top = groups({i for i, _ in sets if i is not None}, linked)
    return Counter((i, len(s), top.get(i)) for i, s in sets)


def answers(df):
    return Counter(tuple(r) for r in df.collect())


def test_jaccard_query(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, "documents").collect()]
    assert answers(QUERIES["op6_ngram_jaccard"](spark, SF)) == plain_jaccard(rows)


def test_jaccard_of_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert answers(jaccard.jaccard_components(odd)) == plain_jaccard(rows)
    assert jaccard.jaccard_components(none).collect() == []


def test_jaccard_of_a_crowd_of_near_copies(spark):
    rng = random.Random(3)
    base = [f"word{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(150):
        copy = list(base)
        for _ in range(rng.randrange(6)):
            copy[rng.randrange(len(copy))] = f"other{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    rows += [(150 + i, " ".join(base[:60] + [f"own{i}x{j}" for j in range(rng.randrange(15, 60))])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert answers(jaccard.jaccard_components(docs)) == plain_jaccard(rows)


def test_prefixes_share_as_many_as_they_ask_for():
    rng = np.random.default_rng(4)
    counts = rng.integers(0, 50, jaccard.SKETCH).astype(np.uint32)
    for _ in range(300):
        n = int(rng.integers(1, 80))
        x = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        swapped = int(rng.integers(0, max(1, len(x) // 6) + 1))
        y = np.unique(np.concatenate([x[swapped:], rng.integers(0, 2**63, swapped, dtype=np.uint64)]))
        common = len(np.intersect1d(x, y))
        if 100 * common < 75 * (len(x) + len(y) - common):
            continue
        (p, a), (q, b) = (jaccard._prefix(s, counts, 25.0, 75) for s in (x, y))
        assert len(np.intersect1d(a, b)) >= min(p, q)


def near_misses(rng, count, length):
    """Rows ``id, text`` in pairs of 0.4 to 1.0, and the pairs ``a, b`` of their ids."""
    rows = []
    for i in range(count):
        base = [f"word{rng.randrange(10**6)}" for _ in range(length)]
        copy = list(base)
        for _ in range(rng.randrange(1 + length // 10)):
            copy[rng.randrange(length)] = f"other{rng.randrange(10**6)}"
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(copy))]
    return rows, [(2 * i + 1, 2 * i) for i in range(count)]


def test_verified_pairs_are_those_of_whole_sets(spark):
    rows, pairs = near_misses(random.Random(6), 120, 60)
    # Ids with several rows link by any of them, but not by their empty ones.
    rows += [(i, "") for i in range(20)] + rows[10:14] + [(300, "a b"), (301, "A  b"), (302, "a"), (303, None), (304, " ")]
    pairs += [(301, 300), (302, 300), (304, 303), (303, 300)]
    sets = defaultdict(list)
    for i, text in rows:
        w = WORDS.findall(lowered(text or ""))
        sets[i].append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    linked = {(a, b) for a, b in pairs for x in sets[a] for y in sets[b] if x & y and 100 * len(x & y) >= 75 * len(x | y)}
    docs = spark.createDataFrame(rows, "id long, text string").selectExpr("id", "coalesce(text, '') AS text")
    found = jaccard._verified(spark.createDataFrame(pairs, "a long, b long"), docs, 5, 75)
    assert {tuple(r) for r in found.collect()} == linked
    assert 0 < len(linked) < 100


def test_near_misses_are_ruled_out_without_their_whole_sets(spark):
    rows, pairs = near_misses(random.Random(7), 60, 400)
    rows = [(i, text if i % 2 else " ".join(text.split()[:200] + [f"own{i}x{k}" for k in range(200)])) for i, text in rows]
    docs = spark.createDataFrame(rows, "id long, text string")
    folder = pathlib.Path(_work_folder(spark))
    before = {f for f in folder.rglob("*.parquet")}
    assert jaccard._verified(spark.createDataFrame(pairs, "a long, b long"), docs, 5, 75).collect() == []
    bytes_ = sum(f.stat().st_size for f in folder.rglob("*.parquet") if f not in before)
    assert bytes_ < len(rows) * 396 * 8 / 2  # half of what their hashes take


def test_coarse_sets_never_understate():
    rng = np.random.default_rng(9)
    for _ in range(300):
        x = np.unique(rng.integers(0, 2**64, int(rng.integers(0, 300)), dtype=np.uint64))
        own = rng.integers(0, 2**64, int(rng.integers(0, 300)), dtype=np.uint64)
        y = np.unique(np.concatenate([x[: int(rng.integers(0, len(x) + 1))], own]))
        m, n, most = jaccard._most_shared(jaccard._coarse(x), jaccard._coarse(y))
        assert (m, n) == (len(x), len(y))
        assert most >= len(np.intersect1d(x, y))


def plain_vectors(rows):
    good = []
    for n, (i, label, v) in enumerate(rows):
        if i is None or label is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        v = np.array(v, np.float64)
        good.append((n, i, label, v / np.linalg.norm(v)))
    links, linked = Counter(), []
    for (n, i, k, v), (m, j, l, w) in itertools.combinations(good, 2):
        if k == l and len(v) == len(w) and v @ w >= 0.98:
            links[n] += 1
            links[m] += 1
            linked.append((i, j))
    top = groups({i for i, *_ in rows if i is not None}, linked)
    return Counter((i, links[n], top.get(i), i is None or top[i] == i) for n, (i, *_) in enumerate(rows))


def test_near_vectors_query(spark):
    rows = [(r.vec_id, r.label, r.embedding) for r in table(spark, "embeddings").collect()]
    assert answers(QUERIES["op5_embedding_near_dedup"](spark, SF)) == plain_vectors(rows)


def test_near_vectors_of_odd_rows(spark):
    rng = np.random.default_rng(8)
    nan, inf = float("nan"), float("inf")
    rows = [(1000 + n, 1, v) for n, v in enumerate([None, [], [0.0] * 6, [1.0, nan, 0.0, 0.0, 0.0, 0.0], [inf] * 6, [None, 1.0]])]
    centres = rng.normal(size=(5, 6))
    for i in range(120):
        v = centres[i % 5] + rng.normal(size=6) * rng.choice([0.02, 0.08, 0.2])
        rows.append((i, int(i % 2), [float(x) for x in v * 10.0 ** float(rng.integers(-3, 3))]))
    rows += [(5, 0, rows[20][2]), (None, 1, [1.0] * 6), (300, None, [1.0] * 6), (301, 1, [1.0, 0.0]), (302, 1, [1.0, 0.01])]
    rows += [(303, 1, [2.0, 0.0]), (301, 1, [1.0, 0.0])]
    schema = "vec_id long, label int, embedding array<double>"
    df = spark.createDataFrame(rows, schema).selectExpr("*", "1 AS class", "2 AS size", "3 AS block", "4 AS key")
    assert answers(near_vectors.near_duplicates(df)) == plain_vectors(rows)
    assert near_vectors.near_duplicates(spark.createDataFrame([], schema)).collect() == []


def test_a_crowded_cell_is_met_in_chunks(spark, monkeypatch):
    rng = np.random.default_rng(9)
    rows = [(i, 1, [1.0, *(float(x) for x in rng.normal(size=7) * 0.03)]) for i in range(120)]
    monkeypatch.setattr(near_vectors, "CHUNK", 16)
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert answers(near_vectors.near_duplicates(df)) == plain_vectors(rows)


def plain_removal(rows):
    """Words of windows of 20 that start earlier: a smaller id, or the same and earlier."""
    starts = {}
    for i, text in rows:
        w = WORDS.findall(text or "")
        for k in range(len(w) - 19) if i is not None else ():
            at = starts.setdefault(tuple(w[k : k + 20]), (i, k))
            starts[tuple(w[k : k + 20])] = min(at, (i, k))
    out = Counter()
    for i, text in rows:
        w = WORDS.findall(text or "")
        gone = [False] * len(w)
        for k in range(len(w) - 19) if i is not None else ():
            if starts[tuple(w[k : k + 20])] < (i, k):
                gone[k : k + 20] = [True] * 20
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def test_substring_query(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, "documents").collect()]
    found = answers(QUERIES["op10_substring_dedup"](spark, SF))
    assert found == plain_removal(rows)
    assert sum(n for _, _, n, _ in found) > 0


def test_substrings_of_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert answers(substrings.removal_digest(odd)) == plain_removal(rows)
    assert substrings.removal_digest(none).collect() == []


def test_substrings_with_few_words(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(120)))) for i in range(60)]
    rows += [(100 + i, "x " * 90) for i in range(3)] + [(200, "p q r " * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert answers(substrings.removal_digest(docs)) == plain_removal(rows)


def duck_lines(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    return Counter(con.execute(lines.SQL).fetchall())


def test_lines_query(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/sf0.01/documents.parquet'")
    df = QUERIES["op4_line_dedup"](spark, f"{DATA}/sf0.01")
    found = answers(df)
    assert found == Counter(con.execute(ORACLE_SQL["op4_line_dedup"]).fetchall())
    assert sum(n for _, _, n, _ in found) > 0
    assert "Python" not in plan_of(df) and "Arrow" not in plan_of(df)


def test_lines_near_the_threshold(spark):
    rng = random.Random(7)
    rows = []
    for i in range(300):
        own = [f"own {i}", "", f"line {i % 40}", "everywhere", f"twice {i // 2}", " everywhere "]
        rng.shuffle(own)
        rows.append((i, "\n".join(own), f"site{i % (5 + i % 9)}" if i % 50 else None))
    rows += [(400, None, "a"), (401, "", "b"), (402, "\n\n", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert answers(lines.line_digest(docs)) == duck_lines(rows)


def test_lines_of_odd_rows(odd, none):
    found = lines.line_digest(odd).collect()
    assert Counter(r.doc_id for r in found) == Counter(r.doc_id for r in odd.collect())
    assert lines.line_digest(none).collect() == []
    kept = lines.without_boilerplate(odd).select("row.*", "kept")
    assert kept.columns == [*odd.columns, "kept"] and kept.count() == odd.count()


def test_license_query(spark):
    import regex

    def words(t):
        return regex.findall(r"[\p{L}\p{N}]+", t.lower())

    docs = {r.doc_id: f" {' '.join(words(r.text))} " for r in table(spark, "documents", "sf0.01").collect()}
    whole = {k: f" {' '.join(words(v))} " for k, v in licenses.TEMPLATES.items()}
    df = QUERIES["op9_license_scan"](spark, f"{DATA}/sf0.01")
    rows = {r.doc_id: r.licenses for r in df.collect()}
    assert rows == {i: ",".join(sorted(k for k, v in whole.items() if v in t)) for i, t in docs.items()}
    assert any(rows.values())
    assert "Python" not in plan_of(df) and "Arrow" not in plan_of(df) and "Exchange" not in plan_of(df)


def test_licenses_wherever_they_stand(spark):
    rng = random.Random(1)
    rows, expected = [], {}
    for i, (name, text) in enumerate(itertools.product(licenses.TEMPLATES, range(24))):
        before = " ".join(f"w{rng.randrange(999)}" for _ in range(text))
        rows.append((i, f"{before} ({licenses.TEMPLATES[name].upper()}) and more {before}", 1))
        expected[i] = name
    docs = spark.createDataFrame(rows, "doc_id long, text string, keys int")
    found = {r.doc_id: r.licenses for r in licenses.scan(docs).collect()}
    assert sum(expected[i] in v for i, v in found.items()) >= 0.99 * len(rows)
    assert all(set(v) <= {expected[i]} for i, v in found.items())


def test_license_lines_of_the_tables(spark):
    """The lines as they are in the tables, whatever the templates."""
    lines = {
        "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
        "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
        "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
        "MIT": "Released under the MIT License.",
        "Proprietary": "All rights reserved.",
    }
    docs = {r.doc_id: r.text for r in table(spark, "documents", "sf0.01").collect()}
    rows = {r.doc_id: r.licenses for r in QUERIES["op9_license_scan"](spark, f"{DATA}/sf0.01").collect()}
    assert rows == {i: ",".join(k for k, v in lines.items() if v in t) for i, t in docs.items()}
    assert {k for v in rows.values() for k in v.split(",") if k} == set(lines)


def test_license_bodies_and_other_wordings(spark):
    cases = [
        ("MIT", "Copyright (c) 2020 X\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\n"
         "of this software and associated documentation files (the \"Software\"), to deal in the Software"),
        ("BSD", "Redistribution and use in source and binary forms, with or without\nmodification, are permitted "
         "provided that the following conditions are met:"),
        ("Apache-2.0", "Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/"),
        ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991\nCopyright (C) 1989, 1991"),
        ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007"),
        ("GPL-2.0", "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
         "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
        ("CC-BY-NC-SA-4.0", "photos: CC BY-NC-SA 4.0, by the author"),
        ("CC-BY-NC-4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
        ("Proprietary", "(c) 2001 Someone. All Rights Reserved"),
    ]
    rng = random.Random(3)
    rows, expected = [], {}
    for i, ((name, text), n) in enumerate(itertools.product(cases, range(12))):
        around = " ".join(f"w{rng.randrange(999)}" for _ in range(n))
        rows.append((i, f"{around} {text} {around}"))
        expected[i] = [name]
    found = {r.doc_id: r.licenses for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == expected


def test_every_occurrence_of_a_license_counts(spark):
    gpl2, gpl3 = licenses.TEMPLATES["GPL-2.0"], licenses.TEMPLATES["GPL-3.0"]
    edited = gpl2.replace("work is", "work was")
    between = " ".join(f"x{i}" for i in range(60))
    rows = [
        (1, f"{gpl3} {between} {edited}"),
        (2, f"{edited} {between} {gpl3}"),
        (3, f"{gpl3} {between} {gpl3}"),
        (4, edited),
        (5, f"{between} ".join(["Released under the MIT License. "] * 400)),
    ]
    df = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"))
    found = {r.doc_id: r for r in df.collect()}
    assert found[1].licenses == found[2].licenses == ["GPL-2.0", "GPL-3.0"]
    assert found[3].licenses == ["GPL-3.0"] and len(found[3].evidence) == 2
    assert found[4].licenses == ["GPL-2.0"] and found[4].evidence[0].share < 1
    assert found[5].licenses == ["MIT"] and len(found[5].evidence) == 400


def test_licenses_of_odd_rows(odd, none):
    rows = licenses.scan(odd).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in odd.collect())
    assert not any(r.licenses for r in rows)
    assert licenses.scan(none).collect() == []
    assert not any(r.licenses for r in licenses.scan(odd, templates={}).collect())


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.fit(table(spark, "documents", "sf0.1"), table(spark, "labels", "sf0.1"))


def test_nearest_examples_are_exact(model):
    rng = np.random.default_rng(2)
    size = len(model.vocabulary)
    dense = np.zeros((size, len(model.ids)))
    for p, (at, weights) in enumerate(model.postings):
        dense[p, at] = weights
    for _ in range(200):
        places = np.sort(rng.choice(size, int(rng.integers(1, min(size, 9))), replace=False))
        weights = model.vector(places, rng.integers(1, 5, len(places)).astype(float))
        scores = weights @ dense[places]
        order = np.lexsort((np.arange(len(scores)), -np.round(scores, 12)))[: toxicity.NEIGHBOURS]
        order = order[scores[order] > 0]
        found, cosines = model.nearest(places, weights, toxicity.NEIGHBOURS)
        assert found.tolist() == order.tolist()
        assert np.allclose(cosines, scores[order])


def test_toxicity_on_held_out_rows(spark):
    rows = QUERIES["op1_toxicity"](spark, f"{DATA}/sf0.1").collect()
    known = {r.doc_id: r.toxic for r in table(spark, "labels", "sf0.1").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(r.score, known[r.doc_id]) for r in rows if r.held_out and r.doc_id in known]
    hit = np.array([s for s, t in held if t])
    miss = np.array([s for s, t in held if not t])
    assert (hit[:, None] > miss).mean() + 0.5 * (hit[:, None] == miss).mean() > 0.93
    assert (hit >= 0.5).mean() > 0.85 and (miss >= 0.5).mean() < 0.02
    # A score is a probability: those of about 0.9 are right about that often.
    assert abs(np.mean([s for s, _ in held]) - np.mean([t for _, t in held])) < 0.03


def test_toxicity_of_odd_rows(spark, odd, none, model):
    rows = odd.select("doc_id", toxicity.judged(odd, model).alias("j")).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in odd.collect())
    empty = {r.j.score for r in rows if r.doc_id in (3, 4, 5)}
    assert len(empty) == 1 and empty.pop() < 0.5
    labels = spark.createDataFrame([(0, 1, 1), (None, 0, 0), (1, None, 0)], "doc_id long, toxic int, text int")
    for found in (toxicity.scored(odd, labels), toxicity.scored(odd, labels.limit(0))):
        assert len({r.score for r in found.collect()}) == 1
    assert toxicity.scored(none, labels).collect() == []


def test_components_of_chains_and_stars(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(60)] + [(100, 101 + i) for i in range(50)] + [(7, 7), (3, 2)]
    edges += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(70)]
    found = {r.node: r.component for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = groups({n for e in edges if e[0] != e[1] for n in e}, edges)
    assert found == {n: t for n, t in expected.items() if n in found} and set(expected) == set(found)
    assert connected(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage got and gave, at sf0.01."""
    sf = f"{DATA}/sf0.01"
    docs, out = table(spark, "documents", "sf0.01"), {}
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, sf)
        after = spark.createDataFrame(found.collect(), found.schema)
        out[name] = docs, after
        docs = after
    return out


def test_stages_keep_the_columns(stages):
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.dtypes == before.dtypes, name
        assert all(r.n_chars == len(r.text) for r in after.collect()), name


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    before, after = stages["toxicity"]
    toxic = {r.doc_id: r.toxic for r in table(spark, "labels", "sf0.01").collect()}
    left = {r.doc_id for r in after.collect()}
    clean = [r.doc_id for r in before.collect() if toxic.get(r.doc_id) == 0]
    bad = [i for i, t in toxic.items() if t == 1]
    assert sum(i in left for i in clean) > 0.97 * len(clean)
    assert sum(i not in left for i in bad) > 0.6 * len(bad)


def test_lines_stage_is_the_query(stages):
    before, after = stages["line_dedup"]
    rows = [(r.doc_id, r.text, r.source) for r in before.collect()]
    expected = {i: sha for i, _, _, sha in duck_lines(rows)}
    assert {r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in after.collect()} == expected


def test_one_of_each_group_stays(stages):
    before, after = stages["ngram_jaccard"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    expected = {i for i, _, top in plain_jaccard(rows) if i == top}
    assert sorted(r.doc_id for r in after.collect()) == sorted(expected)


def test_personal_data_goes(stages):
    from pagevane.llm import personal

    before, after = stages["personal_data"]
    texts = {r.doc_id: r.text for r in before.collect()}
    for r in after.collect():
        assert not personal.base_spans(r.text) or "[" in r.text
        if not personal.base_spans(texts[r.doc_id]) and "[" not in r.text:
            assert r.text == texts[r.doc_id]


def test_last_stage_holds_every_document(stages):
    before, after = stages["best_fit_packing"]
    lengths = defaultdict(int)
    for r in after.collect():
        lengths[r.doc_id] += r.length
    assert set(lengths) == {r.doc_id for r in before.collect()}


def test_stages_take_odd_rows(spark, odd, none):
    for docs in (odd, none):
        rows = docs
        for _, stage in corpus_pipeline.STAGES:
            found = stage(spark, rows, SF)
            rows = spark.createDataFrame(found.collect(), found.schema)
    assert rows.count() == 0


def test_run_is_the_stages(spark, stages):
    found = answers(corpus_pipeline.run(spark, f"{DATA}/sf0.01").select("doc_id", "piece", "length", "ids_crc32"))
    assert found == answers(stages["best_fit_packing"][1].select("doc_id", "piece", "length", "ids_crc32"))
