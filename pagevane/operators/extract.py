"""Raw pages to ``(url, h1, text)`` in one language, in one narrow stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagevane.functions.html import first_h1, main_text
from pagevane.functions.language import detect_lang

TARGET_LANG = "fr"


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters read without evaluating them again.

    Catalyst pushes a filter below the projection that made its input and repeats
    the expression there; for text extraction that doubles the cost of the scan.
    A one-element ``inline`` stops the push and stays inside whole-stage codegen.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def extract_pages(
    pages: DataFrame,
    lang: str = TARGET_LANG,
    html: str = "html",
    extractor: Callable[[Column], Column] = main_text,
    keep: Column | None = None,
) -> DataFrame:
    """Main text, language filter, then the heading of the pages that are left.

    Cheap tests come first: pages without text are dropped before language
    detection, and headings are read only from pages in the wanted language. The
    html column is replaced by ``h1`` and ``text``; all other columns are kept. Rows
    for which ``keep`` holds pass unfiltered, so that reports of damage travel in
    the same scan as the pages.
    """
    keep = F.lit(False) if keep is None else keep
    with_text = compute_once(pages, text=extractor(F.col(html))).filter(
        keep | (F.col("text") != "")
    )
    detected = compute_once(with_text, lang=detect_lang("text"))
    wanted = detected.filter(keep | (F.col("lang") == lang))
    return with_headings(wanted, html).drop("lang")


def page_key(path: str = "path", offset: str = "offset") -> Column:
    """Key of an archive record, unique even where two records share their url."""
    return F.sha2(F.concat_ws("#", F.col(path), F.col(offset).cast("string")), 256)


def with_headings(pages: DataFrame, html: str = "html") -> DataFrame:
    """Replace the html column by ``h1``, ahead of ``text``."""
    kept = [c for c in pages.columns if c not in (html, "text", "lang")]
    tail = [c for c in ("text", "lang") if c in pages.columns]
    return pages.select(*kept, first_h1(html).alias("h1"), *tail)
