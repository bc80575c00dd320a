"""Small string helpers shared by the other expression modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points that Unicode calls white space, less those that
# the ``\s`` of Java's regular expressions already covers.
ODD_SPACE_CLASS = (
    r"\x1c-\x1f\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
SPACE = rf"[\s\x0B{ODD_SPACE_CLASS}]"
NON_SPACE = rf"[^\s\x0B{ODD_SPACE_CLASS}]"

# Fixed value: public host that serves the crawl archives.
ARCHIVE_HOST = "https://data.commoncrawl.org/"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    Catalyst inlines a Column wherever it is used; binding it to a lambda
    variable keeps a costly sub-expression from being repeated.
    """
    return F.transform(F.array(value), body)[0]


def has_odd_spaces(c: Column | str) -> Column:
    """Quick scan: can the text hold white space outside ASCII?

    One range instead of the exact list, since most texts hold none of it and the
    scan then costs little; a false alarm only leads to the exact pattern.
    """
    return col(c).rlike(r"[\x1c-\x1f\x{85}\x{A0}\x{1680}-\x{3000}]")


def plain_spaces(c: Column | str) -> Column:
    """Turn white space outside ASCII into ordinary spaces."""
    replaced = F.regexp_replace(col(c), f"[{ODD_SPACE_CLASS}]", " ")
    return F.when(has_odd_spaces(c), replaced).otherwise(col(c))


def strip(c: Column | str) -> Column:
    """Remove white space at both ends (``F.trim`` removes spaces only)."""
    return F.regexp_replace(col(c), f"^{SPACE}+|{SPACE}+$", "")


def collapse_spaces(c: Column | str) -> Column:
    """Turn each run of white space into one space and trim the ends."""
    return let(
        col(c), lambda t: F.trim(F.regexp_replace(plain_spaces(t), r"\s+", " "))
    )


def tokens(c: Column | str) -> Column:
    """Lower-cased runs of letters and digits, in order."""
    return F.filter(F.split(F.lower(col(c)), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def resolve_path(path: Column | str, prefix: str = ARCHIVE_HOST) -> Column:
    """Full address of an archive path."""
    return F.concat(F.lit(prefix), col(path))


def local_key(path: Column | str) -> Column:
    """Collision-free file key of an archive path."""
    return F.md5(col(path))
