"""HTML to text as Column expressions.

Three readings of a page, all evaluated in the JVM in one pass over the row:

``extract_text``  all visible text, without scripts, navigation and footers;
``main_text``     the article: ``extract_text`` cut into blocks, with link lists,
                  advertisement boxes and stray labels removed (shallow text
                  features, Kohlschuetter et al., WSDM 2010);
``first_h1``      the text of the first heading.
"""

from __future__ import annotations

from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagevane.functions.text import col, collapse_spaces, let

# Elements whose content is never rendered as text.
RAW_ELEMENTS = ("script", "style", "title", "textarea", "template", "iframe")
# Page furniture around an article.
CHROME_ELEMENTS = ("nav", "footer", "aside", "select", "noscript")
# Elements that start a new block of text.
BLOCK_ELEMENTS = (
    "address article aside blockquote body center dd details div dl dt fieldset figcaption "
    "figure footer h1 h2 h3 h4 h5 h6 header hr html li main ol p pre section summary table "
    "tbody td tfoot th thead tr ul"
).split()
# Elements whose blocks are kept however short they are.
CONTENT_ELEMENTS = (
    "article blockquote dd dt figcaption h1 h2 h3 h4 h5 h6 li main p pre td th".split()
)
# Class or id words that mark a block as not part of the article.
NOISE_CLASSES = (
    "ad ads advert advertisement banner breadcrumb breadcrumbs cookie newsletter pagination "
    "popup promo related share sidebar social sponsor sponsored widget"
).split()



# What follows a tag's name. A quote counts only as the start of a value, and a ">" in a quoted value
# doesn't end the tag; a quote that never closes is a character like others. Possessive, so linear.
_ATTRIBUTES = r"""[^>=]*+(?:=\s*+(?:"[^"]*+"|'[^']*+')?+[^>=]*+)*+"""
# As in an HTML parser a tag that never ends takes the rest of the page.
_TAG_END = r"(?:>|\z)"
_ANY_TAG = rf"/?[a-zA-Z]{_ATTRIBUTES}{_TAG_END}"
# A tag with a value; only these can hide markup.
_VALUE_TAG = rf"[a-zA-Z][^<>=]*+(?==){_ATTRIBUTES}{_TAG_END}"


def _elements(names: tuple[str, ...]) -> str:
    return "|".join(rf"{t}\b{_ATTRIBUTES}{_TAG_END}.*?(?:</{t}\s*>|\z)" for t in names)


# One alternation behind one "<", so the text is scanned once and whichever
# element opens first wins (a tag inside a comment, a script string or an attribute
# is not seen as markup: other tags with values are taken whole and put back). An unclosed
# element runs to the end, as in an HTML parser; an opening tag therefore always
# matches, and the scan is linear on broken pages too.
_RAW = rf"!--.*?(?:-->|\z)|{_elements(RAW_ELEMENTS)}"
RAW_PATTERN = f"(?is)<(?:{_RAW})|(<{_VALUE_TAG})"
DROP_PATTERN = f"(?is)<(?:{_RAW}|{_elements(CHROME_ELEMENTS)})|(<{_VALUE_TAG})"
TAG_PATTERN = rf"<(?:{_ANY_TAG}|[!?][^>]*+{_TAG_END})"
# What comes before a tag that starts or ends a block, with all other tags whole, and that tag.
_BLOCK_TAG = rf"/?(?:{'|'.join(BLOCK_ELEMENTS)})\b"
BLOCK_PATTERN = (
    rf"(?is)((?:[^<]++|<(?!{_BLOCK_TAG})(?:{_ANY_TAG})?+)*+)"
    rf"(<{_BLOCK_TAG}{_ATTRIBUTES}{_TAG_END}|\z)"
)
CONTENT_PATTERN = rf"(?i)^</?(?:{'|'.join(CONTENT_ELEMENTS)})\b"


def _noise(attribute: str) -> str:
    name = rf"(?<![\w-]){attribute}\s*+="
    before = rf"""(?:(?!{name})[^>=]|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+"""
    word = rf"\b(?:{'|'.join(NOISE_CLASSES)})\b"
    return rf"""[a-z]{before}{name}\s*+(?:"[^"]*{word}|'[^']*{word}|[^\s"'>]*{word})"""


NOISE_PATTERN = rf"(?is)^<(?:{_noise('class')}|{_noise('id')})"
ANCHOR_START = r"(?i)<a\b"
ANCHOR_REST = r"(?is)</a\b.*"
# The first heading that is not inside an attribute; it ends at the next heading tag, opening or closing.
H1_PATTERN = (
    rf"(?is)\A(?:[^<]++|<(?!h1\b)(?:{_ANY_TAG})?+)*+"
    rf"<h1\b{_ATTRIBUTES}>(.*?)(?:</?h[1-6]\b|\z)"
)
DECIMAL_PATTERN = r"^#(0*+[0-9]{1,7})(?![0-9]);?"
HEX_PATTERN = r"^#[xX](0*+[0-9a-fA-F]{1,6})(?![0-9a-fA-F]);?"
NAME_PATTERN = r"^([a-zA-Z][a-zA-Z0-9]{1,31});"
# Names that count without a semicolon too, from the standard library's table; the longest wins.
BARE_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
BARE_PATTERN = f"^({'|'.join(BARE_NAMES)})"
BLOCK_MARK = "\u0001"
MIN_BLOCK_WORDS = 10


def named_entities() -> dict[str, str]:
    """Name -> character of the entities that pages use most, from the standard library's table."""
    table = {name: chr(cp) for name, cp in name2codepoint.items()}
    table["apos"] = "'"
    return table


def _map(table: dict[str, str]) -> Column:
    # Control characters as separators: none of the mapped values contains one.
    packed = "\u0002".join(f"{k}\u0003{v}" for k, v in sorted(table.items()))
    return F.str_to_map(F.lit(packed), F.lit("\u0002"), F.lit("\u0003"))


def _named(name: Column) -> Column:
    # A map is searched from its start: the long table only for what the short one lacks.
    whole = {n.rstrip(";"): text for n, text in html5.items()}
    return F.coalesce(
        F.try_element_at(_map(named_entities()), name), F.try_element_at(_map(whole), name)
    )


def _numbered(cp: Column) -> Column:
    # Numbers of control characters mean windows-1252, where that has a character.
    codes = [c for c in range(0x80, 0xA0) if c not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
    valid = cp.between(1, 0xD7FF) | cp.between(0xE000, 0x10FFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "UTF-32")
    meant = F.translate(char, "".join(map(chr, codes)), bytes(codes).decode("cp1252"))
    return F.when(valid, meant)


def _decode_piece(piece: Column) -> Column:
    """The text after an ampersand with the reference it starts with decoded; null if there is none."""

    def after(pattern: str) -> Column:
        return F.substr(piece, F.length(F.regexp_extract(piece, pattern, 0)) + 1)

    def code(pattern: str, base: int) -> Column:
        digits = F.regexp_extract(piece, pattern, 1)
        return F.when(digits != "", F.conv(digits, base, 10).cast("bigint"))

    def number(pattern: str, base: int) -> Column:
        return F.concat(_numbered(code(pattern, base)), after(pattern))

    def name(pattern: str) -> Column:
        found = F.regexp_extract(piece, pattern, 1)
        return F.when(found != "", F.concat(_named(found), after(pattern)))

    numeric = F.coalesce(number(DECIMAL_PATTERN, 10), number(HEX_PATTERN, 16))
    named = F.coalesce(name(NAME_PATTERN), name(BARE_PATTERN))
    return F.when(piece.startswith("#"), numeric).otherwise(named)


def unescape(c: Column | str) -> Column:
    """Replace named and numeric character references, each once; unknown ones stay.

    As in HTML5 a number needs no semicolon, the oldest names need none either, and numbers of
    control characters mean windows-1252. Numbers that are no character stay as they are.
    The text is cut at the ampersands and every piece decoded by itself, so the
    cost is linear however many different references a page uses.
    """

    def decode_piece(piece: Column) -> Column:
        return F.coalesce(_decode_piece(piece), F.concat(F.lit("&"), piece))

    def decode(pieces: Column) -> Column:
        after = F.slice(pieces, 2, F.size(pieces))
        return F.concat(pieces[0], F.array_join(F.transform(after, decode_piece), ""))

    def if_any(text: Column) -> Column:
        return F.when(F.contains(text, F.lit("&")), let(F.split(text, "&"), decode)).otherwise(text)

    return let(col(c), if_any)


def _drop_tags(c: Column, by: str) -> Column:
    return F.regexp_replace(c, TAG_PATTERN, by)


def _n_words(c: Column) -> Column:
    # For text whose white space is already collapsed.
    return F.when(c == "", 0).otherwise(F.size(F.split(c, " ")))


def extract_text(html: Column | str) -> Column:
    """All visible text of a page on one line; ``''`` if there is none."""
    visible = F.regexp_replace(col(html), DROP_PATTERN, " $1")
    return collapse_spaces(unescape(_drop_tags(visible, " ")))


def _keep_block(block: Column, text: Column, min_words: int) -> Column:
    words = _n_words(text)
    pieces = F.split(block, ANCHOR_START)
    anchors = F.transform(
        F.slice(pieces, 2, F.size(pieces)),
        lambda p: F.concat(F.lit("<a"), F.regexp_replace(p, ANCHOR_REST, "")),
    )
    linked = _n_words(collapse_spaces(_drop_tags(F.array_join(anchors, " "), " ")))
    return (
        (words > 0)
        & (linked * 3 <= words)
        & ((words >= min_words) | block.rlike(CONTENT_PATTERN))
        & ~block.rlike(NOISE_PATTERN)
    )


def main_text(html: Column | str, min_words: int = MIN_BLOCK_WORDS) -> Column:
    """Article text, one line per block; ``''`` if no block qualifies.

    A block is kept if at most a third of its words are inside links, it is a
    paragraph-like element or has ``min_words`` words, and its class or id does
    not mark it as an advertisement or page furniture.
    """
    visible = F.regexp_replace(col(html), DROP_PATTERN, " $1")
    marked = F.regexp_replace(visible, BLOCK_PATTERN, "$1" + BLOCK_MARK + "$2")
    with_text = F.transform(
        F.split(marked, BLOCK_MARK),
        lambda b: F.struct(b.alias("block"), collapse_spaces(_drop_tags(b, " ")).alias("text")),
    )
    kept = F.filter(with_text, lambda b: _keep_block(b["block"], b["text"], min_words))
    joined = F.array_join(F.transform(kept, lambda b: b["text"]), "\n")
    return F.regexp_replace(unescape(joined), r"[ \x{A0}]+", " ")


def first_h1(html: Column | str) -> Column:
    """Text of the first ``<h1>``, nested tags removed, not trimmed; ``''`` if absent."""
    rendered = F.regexp_replace(col(html), RAW_PATTERN, "$1")
    return unescape(_drop_tags(F.regexp_extract(rendered, H1_PATTERN, 1), ""))
