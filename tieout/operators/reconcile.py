"""What each order should have settled at, and the verdict on what it did settle at."""

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieout.fixed_values import (
    CLEAN,
    DUPLICATE,
    ENGINE_SENTENCES,
    MISSING,
    RATE_MISMATCH,
    TIER_OF_CATEGORY,
    TIMING_LAG,
    TOLERANCE,
    UNEXPLAINED,
)
from tieout.functions.money import breaks_tolerance, gst_on, net_of, percentage_of
from tieout.functions.text import by_code, fill
from tieout.operators.lines import lines_per_order
from tieout.operators.skew import ROWS_PER_SLICE, join_hot_apart


def expected_settlement(ledger: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Fee, tax, refund and net of every order, from the order alone.

    ``keep`` names further ledger columns to carry along.
    """
    none = F.lit(Decimal("0.00"))
    return (
        ledger.select(
            "order_id",
            "order_amount",
            "refund_amount",
            *keep,
            percentage_of("order_amount", "expected_mdr_rate").alias("expected_mdr_fee"),
            F.coalesce("refund_amount", none).alias("expected_refund_adjustment"),
        )
        .withColumn("expected_gst_on_mdr", gst_on("expected_mdr_fee"))
        .withColumn(
            "expected_net_amount",
            net_of(
                "order_amount",
                "expected_mdr_fee",
                "expected_gst_on_mdr",
                "expected_refund_adjustment",
            ),
        )
    )


def join_expected_lines(
    expected: DataFrame,
    per_order: DataFrame,
    repeated_orders: bool = False,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Every order with its line figures, if any. One row per order on both sides.

    A ledger that breaks this, with many rows on one order id, is joined evenly under
    ``repeated_orders``, at the price of counting its ids first. Each row gets its verdict
    either way.
    """
    if repeated_orders:
        joined = join_hot_apart(expected, per_order, "order_id", rows_per_slice)
    else:
        joined = expected.join(per_order, "order_id", "left")
    return joined.withColumn(
        "settlement_row_count", F.coalesce("settlement_row_count", F.lit(0).cast("bigint"))
    )


def identity_check(joined: DataFrame) -> DataFrame:
    """The line against itself: tax and net rebuilt from the figures it charged."""
    return joined.withColumns(
        {
            "gst_on_charged_fee": gst_on("mdr_fee"),
            "identity_net_amount": net_of(
                "order_amount", "mdr_fee", "gst_on_mdr", "refund_adjustment"
            ),
        }
    )


def category_rules(
    tolerance: Decimal | float | str = TOLERANCE, strict: bool = False
) -> Sequence[tuple[str, Column]]:
    """Verdicts in order of priority; the first whose condition is true is the verdict.

    By default a missing figure makes its comparison null, which is not true, so the line
    can still pass as clean. ``strict`` counts a missing figure as an unexplained break.
    """

    def off(actual: str, expected: str) -> Column:
        return breaks_tolerance(actual, expected, tolerance)

    count = F.col("settlement_row_count")
    inconsistent = off("gst_on_mdr", "gst_on_charged_fee") | off(
        "net_amount", "identity_net_amount"
    )
    rules = [
        (MISSING, count == 0),
        (DUPLICATE, count > 1),
        (RATE_MISMATCH, off("mdr_fee", "expected_mdr_fee")),
        (TIMING_LAG, off("refund_adjustment", "expected_refund_adjustment")),
        (UNEXPLAINED, inconsistent),
    ]
    if strict:
        figures = ("mdr_fee", "gst_on_mdr", "refund_adjustment", "net_amount")
        absent = [F.col(c).isNull() for c in figures]
        rules.append((UNEXPLAINED, absent[0] | absent[1] | absent[2] | absent[3]))
    return rules


def classify_orders(
    checked: DataFrame, tolerance: Decimal | float | str = TOLERANCE, strict: bool = False
) -> DataFrame:
    hits = [F.when(found, F.lit(code)) for code, found in category_rules(tolerance, strict)]
    return checked.withColumn("category", F.coalesce(*hits, F.lit(CLEAN)))


def match_tier(category: Column | str = "category") -> Column:
    category = F.col(category) if isinstance(category, str) else category
    return by_code(category, TIER_OF_CATEGORY)


def engine_reasoning(category: Column | str = "category") -> Column:
    """The verdict's sentence with the figures it rests on. Never null."""
    category = F.col(category) if isinstance(category, str) else category
    figures = {
        "refund": F.col("expected_refund_adjustment"),
        "fee": F.col("mdr_fee"),
        "expected_fee": F.col("expected_mdr_fee"),
        "row_count": F.col("settlement_row_count"),
        "gst_on_charged": F.col("gst_on_charged_fee"),
        "gst": F.col("gst_on_mdr"),
        "identity_net": F.col("identity_net_amount"),
        "net": F.col("net_amount"),
    }
    sentences = {code: fill(text, **figures) for code, text in ENGINE_SENTENCES.items()}
    return by_code(category, sentences, otherwise=F.lit(""))


def reconciliation_result(classified: DataFrame) -> DataFrame:
    """The published result: one row per order, 15 columns."""
    return classified.select(
        "order_id",
        match_tier().alias("match_tier"),
        "category",
        engine_reasoning().alias("reasoning"),
        "order_amount",
        "expected_mdr_fee",
        F.col("mdr_fee").alias("actual_mdr_fee"),
        "expected_refund_adjustment",
        F.col("refund_adjustment").alias("actual_refund_adjustment"),
        "expected_net_amount",
        F.col("net_amount").alias("actual_net_amount"),
        "settlement_row_count",
        "transaction_id",
        "utr_number",
        "settlement_batch_id",
    )


def classified_orders(
    ledger: DataFrame,
    lines: DataFrame,
    tolerance: Decimal | float | str = TOLERANCE,
    strict: bool = False,
    repeated_orders: bool = False,
) -> DataFrame:
    joined = join_expected_lines(
        expected_settlement(ledger), lines_per_order(lines), repeated_orders
    )
    return classify_orders(identity_check(joined), tolerance, strict)


def reconcile(
    ledger: DataFrame,
    lines: DataFrame,
    tolerance: Decimal | float | str = TOLERANCE,
    strict: bool = False,
    repeated_orders: bool = False,
) -> DataFrame:
    """Ledger and settlement lines to the published result, as one lazy plan."""
    return reconciliation_result(
        classified_orders(ledger, lines, tolerance, strict, repeated_orders)
    )


def result_preview(result: DataFrame, n: int = 20) -> DataFrame:
    """The first rows, exact matches first; ties broken by order id."""
    return result.orderBy(F.col("match_tier") != "exact", "category", "order_id").limit(n)
