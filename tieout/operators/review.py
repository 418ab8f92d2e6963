"""What reviewers read: queue, slices, evidence lines, headline figures."""

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieout.fixed_values import (
    AUTO_CLEARED,
    CLEAN,
    NEEDS_REVIEW,
    QUEUE_COLUMNS,
    SLICE_COLUMNS,
    TOLERANCE,
)
from tieout.functions.display import category_label
from tieout.functions.money import share

AMOUNT = "evidence_order_amount"


def _held() -> Column:
    return F.col("review_status") == NEEDS_REVIEW


def _total(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(Decimal("0.00"))).cast("decimal(18,2)")


def review_queue(audit: DataFrame) -> DataFrame:
    return audit.filter(_held()).select(*QUEUE_COLUMNS).orderBy("engine_category", "order_id")


def queue_by_value(audit: DataFrame) -> DataFrame:
    """Held orders, largest amount first; ids break ties, so equal amounts split evenly."""
    return audit.filter(_held()).orderBy(F.desc(AMOUNT), "order_id")


def audit_slice(
    audit: DataFrame,
    categories: list[str] | None = None,
    tiers: list[str] | None = None,
    statuses: list[str] | None = None,
    min_amount: Decimal | int = 0,
) -> DataFrame:
    """The chosen rows; None leaves a facet open, a missing amount counts as zero."""
    chosen = {
        "engine_category": categories,
        "engine_match_tier": tiers,
        "review_status": statuses,
    }
    for column, values in chosen.items():
        if values is not None:
            audit = audit.filter(F.col(column).isin(*values))
    amount = F.coalesce(AMOUNT, F.lit(Decimal("0.00")))
    return audit.filter(amount >= F.lit(Decimal(min_amount)))


def export_slice(audit_rows: DataFrame) -> DataFrame:
    return audit_rows.select(*SLICE_COLUMNS)


def explode_evidence(audit: DataFrame) -> DataFrame:
    """Per held order, one row for each compared figure that has both sides."""
    figures = [
        ("MDR fee", "mdr_fee"),
        ("Refund adj.", "refund_adjustment"),
        ("Net amount", "net_amount"),
    ]
    sides = F.array(
        *[
            F.struct(
                F.lit(label).alias("label"),
                F.col(f"evidence_expected_{name}").alias("expected"),
                F.col(f"evidence_actual_{name}").alias("actual"),
            )
            for label, name in figures
        ]
    )
    differs = F.abs(F.col("expected") - F.col("actual")) > F.lit(TOLERANCE)
    return (
        audit.filter(_held())
        .select("order_id", F.inline(sides))
        .filter(F.col("expected").isNotNull() & F.col("actual").isNotNull())
        .withColumn("differs", differs)
    )


def kpi_tiles(audit: DataFrame) -> DataFrame:
    """Order counts and settled value, cleared and held, in one pass."""
    cleared = F.col("review_status") == AUTO_CLEARED
    totals = audit.agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(cleared).alias("auto_cleared"),
        F.count_if(_held()).alias("needs_review"),
        _total(F.when(cleared, F.col(AMOUNT))).alias("value_cleared"),
        _total(F.when(_held(), F.col(AMOUNT))).alias("value_held"),
    )
    none = F.lit(0.0)
    whole = F.col("value_cleared") + F.col("value_held")
    return totals.select(
        "orders",
        "auto_cleared",
        F.coalesce(share(F.col("auto_cleared"), F.col("orders")), none).alias("auto_rate"),
        "needs_review",
        "value_cleared",
        "value_held",
        F.coalesce(share(F.col("value_held"), whole), none).alias("held_share"),
    )


def value_split(audit: DataFrame) -> DataFrame:
    """Cleared and held value with their share in percent; no value at all gives zero shares."""
    tiles = kpi_tiles(audit)
    whole = F.col("value_cleared") + F.col("value_held")
    divisor = F.when(whole == 0, F.lit(1)).otherwise(whole)
    parts = F.array(
        F.struct(F.lit("Cleared").alias("part"), F.col("value_cleared").alias("value")),
        F.struct(F.lit("Held for review").alias("part"), F.col("value_held").alias("value")),
    )
    return tiles.select(divisor.cast("double").alias("_whole"), F.inline(parts)).select(
        "part", "value", (F.col("value").cast("double") / F.col("_whole") * 100).alias("share_pct")
    )


def exceptions_by_category(audit: DataFrame) -> DataFrame:
    grouped = (
        audit.filter(F.col("engine_category") != CLEAN)
        .groupBy("engine_category")
        .agg(F.count(F.lit(1)).alias("n_orders"), _total(F.col(AMOUNT)).alias("value"))
    )
    labelled = grouped.withColumn("label", category_label("engine_category"))
    return labelled.orderBy("n_orders", "engine_category")


def facets(audit: DataFrame) -> DataFrame:
    """Values to filter by, as (facet, value) rows, and the largest amount."""
    combos = audit.groupBy("engine_category", "engine_match_tier", "review_status").agg(
        F.max(AMOUNT).alias("amount")
    )
    values = F.array(
        *[
            F.struct(F.lit(name).alias("facet"), F.col(name).alias("value"))
            for name in ("engine_category", "engine_match_tier", "review_status")
        ]
    )
    # combos has one row per combination of three small closed sets
    listed = combos.select(F.inline(values)).distinct()
    largest = combos.agg(F.max("amount").cast("string").alias("value")).select(
        F.lit("max_amount").alias("facet"), "value"
    )
    return listed.unionByName(largest)


def provenance(audit: DataFrame) -> DataFrame:
    """Which run, model and prompt the records come from; the least value where they differ."""
    return audit.agg(
        F.min("run_id").alias("run_id"),
        F.min("run_started_at").alias("run_started_at"),
        F.coalesce(F.min("agent_model"), F.lit("n/a")).alias("agent_model"),
        F.coalesce(F.min("agent_prompt_version"), F.lit("n/a")).alias("agent_prompt_version"),
    )
