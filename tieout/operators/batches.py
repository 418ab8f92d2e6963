"""Batches: netting, and the cross-check of bank credits against summed lines."""

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieout.fixed_values import SETTLEMENT_LAG_DAYS, TOLERANCE
from tieout.operators.skew import join_hot_apart

BATCH = "settlement_batch_id"


def batch_net(lines: DataFrame) -> DataFrame:
    return lines.groupBy(BATCH).agg(
        F.sum("net_amount").cast("decimal(18,2)").alias("computed_batch_net")
    )


def batch_totals(lines: DataFrame) -> DataFrame:
    """What the rest of a run needs to know of the batches: sum and number of their lines."""
    return lines.groupBy(BATCH).agg(
        F.sum("net_amount").cast("decimal(18,2)").alias("computed_batch_net"),
        F.count(F.lit(1)).alias("n"),
    )


def bank_netting(
    ledger: DataFrame,
    lines: DataFrame,
    batch: str = BATCH,
    lag_days: int = SETTLEMENT_LAG_DAYS,
) -> DataFrame:
    """Per batch: what the bank should credit, when, and under which reference.

    Both sides are aggregated before they meet, so the join is one to one.
    """
    due = ledger.groupBy(batch).agg(
        F.date_add(F.max("order_date"), lag_days).alias("credit_date")
    )
    totals = lines.groupBy(batch).agg(
        F.sum("net_amount").cast("decimal(18,2)").alias("net_total"),
        F.min("utr_number").alias("utr_number"),
    )
    zero = F.lit(Decimal("0.00")).cast("decimal(18,2)")
    return due.join(totals, batch, "left").select(
        batch, F.coalesce("net_total", zero).alias("net_total"), "credit_date", "utr_number"
    )


def batch_orders_lines(ledger: DataFrame, lines: DataFrame, batch: str) -> DataFrame:
    """Per batch: how many orders and lines it has and what they add up to."""
    orders = ledger.groupBy(batch).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum("order_amount").cast("decimal(18,2)").alias("order_total"),
    )
    report = lines.groupBy(batch).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("net_amount").cast("decimal(18,2)").alias("net_total"),
    )
    return orders.join(report, batch, "full_outer")


def _balanced(diff: Column, tolerance) -> Column:
    return F.abs(diff) <= F.lit(Decimal(str(tolerance)))


def batch_balanced(joined: DataFrame, tolerance: Decimal | float | str = TOLERANCE) -> DataFrame:
    diff = (F.col("bank_credit_amount") - F.col("computed_batch_net")).cast("decimal(18,2)")
    return joined.withColumn("batch_diff", diff).withColumn(
        "batch_balanced", _balanced(F.col("batch_diff"), tolerance)
    )


def batch_check(
    bank_feed: DataFrame,
    lines: DataFrame,
    tolerance: Decimal | float | str = TOLERANCE,
    totals: DataFrame | None = None,
    hot_apart: int | None = None,
) -> DataFrame:
    """Each bank credit with its batch's summed lines; null where the batch has no lines.

    ``totals`` are the stored :func:`batch_totals`, if there are any. Credits are about one
    per batch, so this is a plain join; where one batch has very many, ``hot_apart`` joins
    batches with more credits than that in place (see :func:`join_hot_apart`).
    """
    net = batch_net(lines) if totals is None else totals.select(BATCH, "computed_batch_net")
    if hot_apart is not None:
        met = join_hot_apart(bank_feed, net, BATCH, hot_apart)
    else:
        met = bank_feed.join(net, BATCH, "left").select(*bank_feed.columns, "computed_batch_net")
    return batch_balanced(met, tolerance)


def batch_check_rollup(checked: DataFrame) -> DataFrame:
    """Counts of credits. Only a known difference counts against a batch."""
    unbalanced = F.count_if(~F.col("batch_balanced"))
    return checked.agg(
        F.count(F.lit(1)).alias("total_batches"), unbalanced.alias("unbalanced_batches")
    ).select(
        "total_batches",
        (F.col("total_batches") - F.col("unbalanced_batches")).alias("balanced_batches"),
        "unbalanced_batches",
    )


def unbalanced_batches(checked: DataFrame) -> DataFrame:
    return checked.filter(~F.col("batch_balanced"))


def batch_check_strict(
    bank_feed: DataFrame, lines: DataFrame, tolerance: Decimal | float | str = TOLERANCE
) -> DataFrame:
    """Every batch on either side, with credits and lines that have no counterpart named."""
    credits = bank_feed.groupBy(BATCH).agg(
        F.sum("bank_credit_amount").cast("decimal(18,2)").alias("bank_credit_amount")
    )
    met = batch_balanced(credits.join(batch_net(lines), BATCH, "full_outer"), tolerance)
    status = (
        F.when(F.col("computed_batch_net").isNull(), F.lit("unmatched_bank"))
        .when(F.col("bank_credit_amount").isNull(), F.lit("unmatched_lines"))
        .when(F.col("batch_balanced"), F.lit("balanced"))
        .otherwise(F.lit("unbalanced"))
    )
    return met.select(
        BATCH, "bank_credit_amount", "computed_batch_net", "batch_diff", status.alias("status")
    )


def distinct_batches(lines: DataFrame, batch: str = BATCH) -> DataFrame:
    return lines.select(batch).distinct().orderBy(batch)
