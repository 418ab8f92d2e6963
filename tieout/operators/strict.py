"""Checks that the verdict leaves out: gross amounts, references, refund dates, settlement lag."""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieout.fixed_values import SETTLEMENT_LAG_DAYS
from tieout.operators.batches import BATCH
from tieout.operators.quality import as_rows
from tieout.operators.skew import ROWS_PER_SLICE, join_many_to_one

#: A Monday, from which weeks are counted.
MONDAY = "1970-01-05"


def settlement_day_number(day: Column, holidays: list[date] | None = None) -> Column:
    """How many settlement days, Mondays to Fridays that are no holidays, there are up to and
    with a day. The difference of two such numbers is their distance in settlement days."""
    since = F.date_diff(day, F.lit(MONDAY).cast("date"))
    weekdays = 5 * F.floor(since / 7) + F.least(F.pmod(since, F.lit(7)) + 1, F.lit(5))
    off = sorted({d for d in holidays or [] if d.weekday() < 5})
    if not off:
        return weekdays
    return weekdays - F.size(F.filter(F.array(*map(F.lit, off)), lambda h: h <= day))


def gross_breaks(ledger: DataFrame, lines: DataFrame) -> DataFrame:
    """Lines of known orders whose gross amount is not the order's, or cannot be compared."""
    orders = ledger.groupBy("order_id").agg(
        F.min("order_amount").alias("order_amount"), F.max("order_amount").alias("_most")
    )
    met = lines.join(orders, "order_id")
    same = (F.col("gross_amount") == F.col("order_amount")) & (F.col("gross_amount") == F.col("_most"))
    return met.where(~F.coalesce(same, F.lit(False))).select(
        "order_id", "transaction_id", "gross_amount", "order_amount"
    )


def reference_breaks(lines: DataFrame, bank_feed: DataFrame) -> DataFrame:
    """Lines whose reference is none of those under which their batch was credited. Batches
    without a credit are not judged here; ``batch_check_strict`` names them."""
    credits = bank_feed.groupBy(BATCH).agg(F.count(F.lit(1)).alias("_credits"))
    known = bank_feed.select(BATCH, "utr_number").distinct().withColumn("_known", F.lit(True))
    # a batch's lines are spread by their references
    judged = lines.join(credits.select(BATCH), BATCH, "left_semi")
    met = judged.join(known, [BATCH, "utr_number"], "left").where("_known is null")
    return met.select("order_id", "transaction_id", BATCH, "utr_number")


def refund_date_breaks(ledger: DataFrame) -> DataFrame:
    """Orders whose refund lies before the order, has no date, or a date without an amount."""
    problem = (
        F.when(F.col("refund_date") < F.col("order_date"), F.lit("before_order"))
        .when(F.col("refund_amount").isNotNull() & F.col("refund_date").isNull(), F.lit("no_date"))
        .when(F.col("refund_amount").isNull() & F.col("refund_date").isNotNull(), F.lit("no_amount"))
    )
    return ledger.withColumn("problem", problem).where("problem is not null").select(
        "order_id", "order_date", "refund_amount", "refund_date", "problem"
    )


def settlement_lags(
    ledger: DataFrame,
    lines: DataFrame,
    bank_feed: DataFrame,
    least: int = SETTLEMENT_LAG_DAYS,
    most: int = SETTLEMENT_LAG_DAYS,
    holidays: list[date] | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Each line of a known order against the settlement calendar: the settlement days from the
    order to the first credit of the line's batch, and whether that lies within the interval.

    ``status`` is ``no_credit``, ``early``, ``on_time``, ``late``, or ``no_date`` where the order
    has none. Orders that stand on several ledger rows count from their last date.
    """
    orders = ledger.groupBy("order_id").agg(F.max("order_date").alias("order_date"))
    credits = bank_feed.groupBy(BATCH).agg(F.min("credit_date").alias("credit_date"))
    dated = lines.join(orders, "order_id").select("order_id", "transaction_id", BATCH, "order_date")
    sizes = lines.groupBy(BATCH).agg(F.count(F.lit(1)).alias("n"))
    met = join_many_to_one(
        dated, credits, BATCH, sizes, ["order_id", "transaction_id"], rows_per_slice
    )
    lag = settlement_day_number(F.col("credit_date"), holidays) - settlement_day_number(
        F.col("order_date"), holidays
    )
    days = F.col("settlement_days")
    status = (
        F.when(F.col("credit_date").isNull(), F.lit("no_credit"))
        .when(F.col("order_date").isNull(), F.lit("no_date"))
        .when(days < least, F.lit("early"))
        .when(days > most, F.lit("late"))
        .otherwise(F.lit("on_time"))
    )
    return met.withColumn("settlement_days", lag.cast("int")).select(
        "order_id", "transaction_id", BATCH, "order_date", "credit_date", "settlement_days",
        status.alias("status"),
    )


def check_strict(
    ledger: DataFrame, lines: DataFrame, bank_feed: DataFrame, least: int = SETTLEMENT_LAG_DAYS,
    most: int = SETTLEMENT_LAG_DAYS, holidays: list[date] | None = None,
) -> DataFrame:
    """All of these checks as rows (check_name, passed, n_bad)."""
    lags = settlement_lags(ledger, lines, bank_feed, least, most, holidays)

    def counted(df: DataFrame, name: str) -> DataFrame:
        return as_rows(df.agg(F.count(F.lit(1)).alias(name)), [name])

    out = counted(gross_breaks(ledger, lines), "gross_is_order_amount")
    for df, name in (
        (reference_breaks(lines, bank_feed), "reference_was_credited"),
        (refund_date_breaks(ledger), "refund_dates_fit"),
        (lags.where("status <> 'on_time'"), "settled_in_time"),
    ):
        out = out.unionByName(counted(df, name))
    return out
