"""Text columns: sentence templates, stringification, ids and codes."""

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

from tieout.fixed_values import UUID_PATTERN


def as_text(c: Column | str) -> Column:
    """Any value as text; null becomes the empty string."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit(""))


def fill(template: str, **figures: Column) -> Column:
    """A sentence with ``{name}`` marks replaced by columns. Never null."""
    parts = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name:
            parts.append(as_text(figures[name]))
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def by_code(code: Column, values: dict, otherwise: Column | None = None) -> Column:
    """Pick the value that belongs to a code; ``values`` may hold columns or literals."""
    picks = [
        F.when(code == key, value if isinstance(value, Column) else F.lit(value))
        for key, value in values.items()
    ]
    if otherwise is not None:
        picks.append(otherwise)
    return F.coalesce(*picks)


def cites_figures(explanation: Column | str) -> Column:
    """A digit is left once identifiers are taken out; null and empty text cite nothing."""
    text = F.col(explanation) if isinstance(explanation, str) else explanation
    return F.coalesce(F.regexp_replace(text, UUID_PATTERN, "").rlike("[0-9]"), F.lit(False))


def short_id(c: Column | str) -> Column:
    return F.substring(as_text(c), 1, 8)


def message_text(content: Column) -> Column:
    """Plain text of a reply that is either a string or a JSON list of text blocks.

    Blocks without text add nothing. Content that is not such a list is returned as is.
    """
    blocks = F.from_json(content, "array<struct<text:string>>")
    texts = F.filter(F.transform(blocks, lambda b: b["text"]), lambda t: t.isNotNull())
    is_list = F.substring(F.ltrim(content), 1, 1) == "["
    return F.when(is_list, F.coalesce(F.array_join(texts, ""), content)).otherwise(content)


def _code(prefix: str, number: Column, digits: int = 6) -> Column:
    """Prefix and number, padded with zeros to ``digits`` and never cut."""
    text = number.cast("string")
    width = F.greatest(F.length(text), F.lit(digits))
    return F.concat(F.lit(prefix), F.lpad(text, width, F.lit("0")))


def batch_code(number: Column, prefix: str = "BATCH-") -> Column:
    return _code(prefix, number)


def utr_code(number: Column) -> Column:
    return _code("UTR", number)


def customer_code(number: Column) -> Column:
    return _code("CUST-", number)
