"""Display text for amounts and codes."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tieout.fixed_values import CATEGORY_LABELS, MINUS, RUPEE
from tieout.functions.text import by_code


def inr(value: Column | str, decimals: int = 2) -> Column:
    """Rupees in lakh/crore grouping: the last three digits, then pairs."""
    value = F.col(value) if isinstance(value, str) else value
    exact = value.cast("decimal(28,6)")
    digits = F.bround(F.abs(exact), decimals).cast(f"decimal(28,{decimals})").cast("string")
    whole = F.substring_index(digits, ".", 1)
    head = F.regexp_extract(whole, "^(.*)...$", 1)
    tail = F.when(F.length(whole) > 3, F.right(whole, F.lit(3))).otherwise(whole)
    pairs = F.regexp_replace(head, "(\\d)(?=(\\d\\d)+$)", "$1,")
    grouped = F.when(head == "", tail).otherwise(F.concat(pairs, F.lit(","), tail))
    if decimals:
        grouped = F.concat(grouped, F.lit("."), F.substring_index(digits, ".", -1))
    sign = F.when(exact < 0, F.lit(MINUS)).otherwise(F.lit(""))
    return F.coalesce(F.concat(sign, F.lit(RUPEE), grouped), F.lit("n/a"))


def inr_compact(value: Column | str) -> Column:
    """Headline form: crores from ten million up, lakhs from a hundred thousand up."""
    value = F.col(value) if isinstance(value, str) else value
    amount = value.cast("double")

    def scaled(by: float, places: int, unit: str) -> Column:
        return F.concat(F.lit(RUPEE), F.format_number(amount / by, places), F.lit(unit))

    return F.coalesce(
        F.when(F.abs(amount) >= 1e7, scaled(1e7, 2, " Cr")),
        F.when(F.abs(amount) >= 1e5, scaled(1e5, 2, " L")),
        F.when(amount.isNotNull(), scaled(1.0, 0, "")),
        F.lit("n/a"),
    )


def category_label(code: Column | str) -> Column:
    code = F.col(code) if isinstance(code, str) else code
    return by_code(code, CATEGORY_LABELS, otherwise=code)
