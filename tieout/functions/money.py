"""Exact money columns: every product is brought back to two places, half up."""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tieout.fixed_values import GST_RATE, TOLERANCE

MONEY = "decimal(18,2)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    return _col(c).cast(MONEY)


def percentage_of(amount: Column | str, rate: Column | str) -> Column:
    return money(_col(amount) * _col(rate))


def gst_on(fee: Column | str) -> Column:
    return percentage_of(fee, F.lit(GST_RATE))


def net_of(amount, fee, gst, refund) -> Column:
    """What is paid out once fee, tax on the fee and refund are taken off."""
    return money(_col(amount) - _col(fee) - _col(gst) - _col(refund))


def breaks_tolerance(
    actual: Column | str, expected: Column | str, tolerance: Decimal | float | str = TOLERANCE
) -> Column:
    """Gap, in whole paise, above the tolerance. Null on either side gives null."""
    gap = money(F.abs(_col(actual) - _col(expected)))
    return gap > F.lit(Decimal(str(tolerance)))


def share(part: Column, whole: Column, places: int | None = None) -> Column:
    """part / whole as double; null when there is no whole."""
    ratio = F.try_divide(part.cast("double"), whole.cast("double"))
    return ratio if places is None else F.round(ratio, places)
