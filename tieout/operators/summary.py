"""Counts and rates of a run."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieout.fixed_values import (
    ACTION_NOTE,
    ACTION_POLICY,
    AGREEMENTS,
    AUDIT_SCHEMA_VERSION,
    AUTO_CLEARED,
    CATEGORIES,
    CLEAN,
    CONTROL,
    FLAGGED,
    NEEDS_REVIEW,
    TIERS,
)
from tieout.functions.money import share
from tieout.operators.batches import batch_check_rollup
from tieout.schemas import RUN_SUMMARY


def _n() -> Column:
    return F.count(F.lit(1)).alias("n")


def side_by_side(*one_row: DataFrame) -> DataFrame:
    """One-row frames with different columns as a single row, without a join."""
    stacked = one_row[0]
    for frame in one_row[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in stacked.columns])


def tier_counts(result: DataFrame) -> DataFrame:
    return result.groupBy("match_tier").agg(_n())


def category_counts(result: DataFrame) -> DataFrame:
    return result.groupBy("category").agg(_n())


def outcome_counts(result: DataFrame) -> DataFrame:
    """Counts by tier, by category and in all, from one pass over the orders.

    Orders are first counted by (tier, category), at most a handful of rows; the grouping
    sets then run over those.
    """
    pairs = result.groupBy("match_tier", "category").agg(_n())
    sets = [[F.col("match_tier")], [F.col("category")], []]
    return (
        pairs.groupingSets(sets, "match_tier", "category")
        .agg(F.sum("n").alias("n"), F.grouping_id().alias("_level"))
        .select(
            F.when(F.col("_level") == 1, F.lit("tier"))
            .when(F.col("_level") == 2, F.lit("category"))
            .otherwise(F.lit("all"))
            .alias("level"),
            F.coalesce("match_tier", "category", F.lit("all")).alias("code"),
            F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
        )
    )


def match_rates(result: DataFrame) -> DataFrame:
    """Share matched exactly, and share matched exactly or with a named difference.

    Orders with a named difference still go to review; the second rate counts them all the
    same. No orders, no rates.
    """
    tier = F.col("match_tier")
    return result.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if(tier == "exact").alias("exact"),
        F.count_if(tier == "fuzzy").alias("fuzzy"),
    ).select(
        "total_orders",
        share(F.col("exact"), F.col("total_orders")).alias("exact_rate"),
        share(F.col("exact") + F.col("fuzzy"), F.col("total_orders")).alias("auto_resolved_rate"),
    )


def agreement_on_flagged(audit: DataFrame) -> DataFrame:
    return (
        audit.filter(F.col("agent_selection_reason") == FLAGGED)
        .groupBy("engine_agent_agreement")
        .agg(_n())
    )


def mean_confidence(audit: DataFrame) -> DataFrame:
    return audit.agg(F.round(_exact_mean("agent_confidence"), 3).alias("mean_agent_confidence"))


def _exact_mean(c: str) -> Column:
    """A mean that does not depend on the order rows are added in."""
    total = F.sum(F.col(c).cast("decimal(18,9)"))
    return F.try_divide(total.cast("double"), F.count(c))


def latency_total(audit: DataFrame) -> DataFrame:
    total = F.coalesce(F.sum("agent_latency_ms"), F.lit(0).cast("bigint"))
    return audit.agg(total.alias("agent_total_latency_ms"))


def label_counts(truth: DataFrame) -> DataFrame:
    return truth.groupBy("exception_type").agg(_n())


def _counts_by(column: str, codes: tuple, within: Column | None = None) -> Column:
    """Counts of a closed code set as a map; codes that do not occur are left out."""
    pairs = []
    for code in codes:
        hit = F.col(column) == code
        pairs += [F.lit(code), F.count_if(hit if within is None else hit & within)]
    return F.map_filter(F.create_map(*pairs), lambda _, n: n > 0)


def run_summary(
    audit: DataFrame,
    batches: DataFrame,
    run_completed_at: str | None = None,
    data_source: str | None = None,
    temperature: float | None = None,
) -> DataFrame:
    """The run on one row: one aggregate over the audit, one over the batch check."""
    tier = F.col("engine_match_tier")
    flagged = F.col("agent_selection_reason") == FLAGGED
    total = F.count(F.lit(1))
    exact = F.count_if(tier == "exact")
    stage_on = F.max("agent_model").isNotNull()
    completed = F.coalesce(
        F.lit(run_completed_at).cast("timestamp"), F.date_trunc("second", F.current_timestamp())
    )
    counted = audit.agg(
        F.min("run_id").alias("run_id"),
        F.min("run_started_at").alias("run_started_at"),
        total.alias("total_orders"),
        _counts_by("engine_match_tier", TIERS).alias("tier_counts"),
        _counts_by("engine_category", CATEGORIES).alias("category_counts"),
        share(exact, total, 4).alias("exact_match_rate"),
        share(exact + F.count_if(tier == "fuzzy"), total, 4).alias("auto_resolved_rate"),
        # all flagged orders, also those a cap kept from the advisory stage
        F.count_if(F.col("engine_category") != CLEAN).alias("flagged_orders"),
        F.count_if("agent_invoked").alias("agent_invoked_count"),
        F.count_if(F.col("agent_error").isNotNull()).alias("agent_failed_count"),
        F.count_if(F.col("agent_selection_reason") == CONTROL).alias("control_sample_count"),
        F.min("agent_model").alias("agent_model"),
        F.min("agent_prompt_version").alias("agent_prompt_version"),
        F.when(stage_on, F.lit(temperature)).cast("double").alias("agent_temperature"),
        F.coalesce(F.sum("agent_latency_ms"), F.lit(0)).alias("agent_total_latency_ms"),
        _counts_by("engine_agent_agreement", AGREEMENTS, flagged).alias("agreement_on_flagged"),
        F.round(_exact_mean("agent_confidence"), 3).alias("mean_agent_confidence"),
        F.count_if("agent_explanation_cites_figures").alias("explanations_citing_figures"),
        F.count_if(F.col("review_status") == NEEDS_REVIEW).alias("orders_needing_human_review"),
        F.count_if(F.col("review_status") == AUTO_CLEARED).alias("orders_auto_cleared"),
        F.count_if("autonomous_action_taken").alias("autonomous_actions_taken"),
    )
    checked = batch_check_rollup(batches).select(
        F.col("total_batches").alias("batches_checked"),
        F.col("balanced_batches").alias("batches_balanced"),
    )
    joined = (
        side_by_side(counted, checked)
        .withColumns(
            {
                "schema_version": F.lit(AUDIT_SCHEMA_VERSION),
                "run_completed_at": completed,
                "data_source": F.lit(data_source).cast("string"),
                "action_policy": F.lit(ACTION_POLICY),
                "action_note": F.lit(ACTION_NOTE),
            }
        )
        .withColumn(
            "duration_seconds",
            F.round(
                F.col("run_completed_at").cast("double") - F.col("run_started_at").cast("double"),
                1,
            ),
        )
    )
    return joined.select([F.col(f.name).cast(f.dataType) for f in RUN_SUMMARY.fields])
