from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pagevane.functions import main_text
from pagevane.operators import drop_site_blocks

SCHEMA = "page_id long, url string, text string, extra int"


def cut(spark, rows, **options):
    pages = spark.createDataFrame([(*r, 7) for r in rows], SCHEMA)
    found = drop_site_blocks(pages, "page_id", **options)
    assert sorted(found.columns) == ["extra", "n_dropped", "page_id", "text", "url"]
    rows = found.collect()
    assert all(r.extra == 7 for r in rows)
    return sorted((r.page_id, r.text, r.n_dropped) for r in rows if r.page_id is not None), rows


def test_planted_menus_go_and_articles_stay(spark):
    rows = [(i, f"http://A.org/{i}", f"menu\nstory {i}\nstory {i}\nall rights") for i in range(4)]
    rows += [(4, "https://a.org:80/4", "menu\nmenu\nonce"), (5, "http://a.org/5", "only an article")]
    # Elsewhere the same line is no template: on too few pages, or on too small a part of them.
    rows += [(6, "http://b.org/6", "menu\nx"), (7, "http://b.org/7", "menu\ny")]
    rows += [(10 + i, f"http://c.org/{i}", "menu" if i < 3 else f"other {i}") for i in range(7)]
    found, _ = cut(spark, rows)
    assert found[:4] == [(i, f"story {i}\nstory {i}", 2) for i in range(4)]
    assert found[4:8] == [(4, "once", 2), (5, "only an article", 0), (6, "menu\nx", 0), (7, "menu\ny", 0)]
    assert [t for _, t, _ in found[8:]] == ["menu"] * 3 + [f"other {i}" for i in range(3, 7)]


def test_odd_rows(spark):
    same = [(i, "http://a.org/", "menu") for i in (1, 1, 2)]
    odd = [(3, "http://a.org/", None), (4, "http://a.org/", ""), (5, None, "menu"), (6, "no url", "menu"), (None, "http://a.org/", "menu\n\nx")]
    found, rows = cut(spark, same + odd)
    assert len(rows) == len(same + odd)
    assert [r for r in found if r[0] < 3] == [(1, "", 1), (1, "", 1), (2, "", 1)]
    assert [r for r in rows if r.page_id is None][0].text == "\nx"
    kept = {r.page_id: (r.text, r.n_dropped) for r in rows if (r.page_id or 0) > 2}
    assert kept == {3: (None, 0), 4: ("", 0), 5: ("menu", 0), 6: ("menu", 0)}
    assert cut(spark, [])[1] == []


@pytest.mark.parametrize("salts", [1, 5])
def test_a_site_with_most_pages_equals_a_plain_count(spark, salts):
    pages = spark.range(3000).select(
        F.col("id").alias("page_id"),
        F.concat(F.lit("http://"), F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 50).cast("string")), F.lit(".org/")).alias("url"),
        F.concat_ws("\n", F.lit("menu"), F.concat(F.lit("part "), F.col("id") % 2), F.concat(F.lit("own "), "id")).alias("text"),
    )
    sites = {}
    rows = pages.collect()
    for r in rows:
        sites.setdefault(r.url, []).append(set(r.text.split("\n")))
    template = {
        u: {b for b in set().union(*of) if (n := sum(b in p for p in of)) >= 3 and n >= len(of) / 2}
        for u, of in sites.items()
    }
    expected = {r.page_id: [b for b in r.text.split("\n") if b not in template[r.url]] for r in rows}
    found = drop_site_blocks(pages, "page_id", salts=salts).collect()
    assert {r.page_id: r.text.split("\n") for r in found} == expected and len(found) == 3000


def test_blocks_of_pages(spark):
    html = "<ul><li>Subscribe to our letter</li></ul><p>Article {} is here.</p>"
    pages = spark.createDataFrame([(i, "http://a.org/", html.format(i)) for i in range(3)], "page_id long, url string, html string")
    found = drop_site_blocks(pages.select("page_id", "url", main_text("html").alias("text")), "page_id")
    assert {r.text for r in found.collect()} == {f"Article {i} is here." for i in range(3)}
