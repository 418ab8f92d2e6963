"""Settlement lines seen per order, and lines no order owns."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LINE_FIGURES = (
    "transaction_id",
    "mdr_fee",
    "gst_on_mdr",
    "refund_adjustment",
    "net_amount",
    "utr_number",
    "settlement_batch_id",
)


def lines_per_order(lines: DataFrame) -> DataFrame:
    """How many lines an order has, and the figures of its least line.

    The least line is one whole line, so figures of different lines are never mixed, and
    it is the same on every run. Both aggregates combine map-side: an order holding a large
    part of all lines reaches the reducer as one row per map task.
    """
    line = F.struct(*LINE_FIGURES)
    grouped = lines.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("settlement_row_count"), F.min(line).alias("line")
    )
    return grouped.select(
        "order_id", "settlement_row_count", *[F.col(f"line.{c}").alias(c) for c in LINE_FIGURES]
    )


def orphan_lines(lines: DataFrame, ledger: DataFrame) -> DataFrame:
    """Lines whose order is not in the ledger."""
    return lines.join(ledger.select("order_id"), "order_id", "left_anti")
