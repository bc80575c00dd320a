"""Vector arithmetic on ``array<float|double>`` columns, and feature hashing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagevane.functions.text import col, let

DIM = 384
NORM_FLOOR = 1e-12


def dot(a: Column | str, b: Column | str) -> Column:
    """Inner product in double precision."""
    products = F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, p: s + p)


def l2_norm(v: Column | str) -> Column:
    squares = F.aggregate(
        col(v), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")
    )
    return F.sqrt(squares)


def l2_normalize(v: Column | str) -> Column:
    """Scale to unit length; the zero vector stays zero."""
    return let(
        F.greatest(l2_norm(v), F.lit(NORM_FLOOR)),
        lambda n: F.transform(col(v), lambda x: x.cast("double") / n),
    )


def token_code(token: Column | str, dim: int = DIM) -> Column:
    """Signed feature hashing (Weinberger et al., ICML 2009): the code of one token.

    ``code >> 1`` is the dimension, ``code & 1`` is set for a negative sign. Both
    come from the token's md5, so any engine can reproduce them.
    """
    h = F.conv(F.substring(F.md5(col(token)), 1, 9), 16, 10).cast("bigint")
    bucket = F.pmod(F.shiftright(h, 4), F.lit(dim).cast("bigint"))
    return (bucket * 2 + F.pmod(h, F.lit(2).cast("bigint"))).cast("int")
