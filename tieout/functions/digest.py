"""Digests of many rows that never need the rows in one place.

The rows' SHA-256 values are cut into two 60-bit numbers which are summed. Sums combine
map-side, do not depend on row order, and count every copy, so a batch or an order that
holds a third of all rows costs the same per row as any other.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical(**fields: Column) -> Column:
    """``name=value`` pairs in name order; null is written as ``null``."""
    pairs = [
        F.concat(F.lit(f"{name}="), F.coalesce(fields[name].cast("string"), F.lit("null")))
        for name in sorted(fields)
    ]
    return F.concat_ws("|", *pairs)


def _sixty_bits(text: Column, start: int) -> Column:
    piece = F.substring(F.sha2(text, 256), start, 15)
    return F.conv(piece, 16, 10).cast("decimal(20,0)")


def row_set_sums(text: Column, prefix: str = "", copies: Column | None = None) -> list[Column]:
    """Aggregates whose values together identify the bag of texts; ``copies`` says how often a
    row's text is in it, once if not given."""
    if copies is None:
        number, first, second = F.count(text), _sixty_bits(text, 1), _sixty_bits(text, 16)
    else:
        often = F.when(text.isNotNull(), copies)
        number = F.coalesce(F.sum(often), F.lit(0).cast("bigint"))
        first, second = (_sixty_bits(text, at) * copies.cast("decimal(18,0)") for at in (1, 16))
    return [
        number.alias(f"{prefix}n"),
        F.sum(first).alias(f"{prefix}s1"),
        F.sum(second).alias(f"{prefix}s2"),
    ]


def row_set_text(prefix: str = "") -> Column:
    """The aggregates of :func:`row_set_sums` as one text; no rows reads ``0:0:0``."""
    parts = [
        F.coalesce(F.col(f"{prefix}{name}").cast("string"), F.lit("0"))
        for name in ("n", "s1", "s2")
    ]
    return F.concat_ws(":", *parts)
