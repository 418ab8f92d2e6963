"""The audit record: verdict, evidence, second opinion, routing, and what was not done."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieout.fixed_values import (
    ACTION_NOTE,
    ACTION_POLICY,
    ACTION_TAKEN,
    AGREE,
    AUDIT_SCHEMA_VERSION,
    AUTO_CLEARED,
    CLEAN,
    DISAGREE,
    NEEDS_REVIEW,
    NOT_ASSESSED,
    NOT_SELECTED,
    REVIEW_CLEARED,
    REVIEW_CONTROL_DISAGREE,
    REVIEW_CONTROL_ERROR,
    REVIEW_FLAGGED,
    REVIEW_FLAGGED_DISAGREE,
    SKIP_CLEAN,
    SKIP_NOT_REACHED,
    SKIP_STAGE_OFF,
    TIER_RANK,
)
from tieout.functions.text import by_code, cites_figures
from tieout.operators.skew import ROWS_PER_SLICE, join_many_to_one
from tieout.schemas import EVIDENCE, audit_schema


def evidence_struct() -> Column:
    """The ten figures the verdict rests on, as one nested value."""
    return F.struct(
        *[F.col(field.name).cast(field.dataType).alias(field.name) for field in EVIDENCE.fields]
    )


def governance_columns() -> dict[str, Column]:
    return {
        "schema_version": F.lit(AUDIT_SCHEMA_VERSION),
        "action_taken": F.lit(ACTION_TAKEN),
        "autonomous_action_taken": F.lit(False),
        "action_policy": F.lit(ACTION_POLICY),
        "action_note": F.lit(ACTION_NOTE),
    }


def agreement(cause: Column, category: Column) -> Column:
    return F.coalesce(
        F.when(cause == category, F.lit(AGREE)),
        F.when(cause.isNotNull(), F.lit(DISAGREE)),
        F.lit(NOT_ASSESSED),
    )


def skip_reason(invoked: Column, selection: Column, category: Column, stage_on: bool) -> Column:
    """Why there is no second opinion; null where there is one.

    A flagged order cut off by the cap was not reached: only clean orders are passed over.
    """
    if not stage_on:
        why = F.lit(SKIP_STAGE_OFF)
    else:
        passed_over = (selection == NOT_SELECTED) & (category == CLEAN)
        why = F.when(passed_over, F.lit(SKIP_CLEAN)).otherwise(F.lit(SKIP_NOT_REACHED))
    return F.when(~invoked, why)


def decide_review(category: Column, agreed: Column, error: Column) -> Column:
    """Routing as struct<status, reason>: doubt from either side holds an order back."""
    differs = agreed == DISAGREE
    reason = F.coalesce(
        F.when((category != CLEAN) & differs, F.lit(REVIEW_FLAGGED_DISAGREE)),
        F.when(category != CLEAN, F.lit(REVIEW_FLAGGED)),
        F.when(F.coalesce(error, F.lit("")) != "", F.lit(REVIEW_CONTROL_ERROR)),
        F.when(differs, F.lit(REVIEW_CONTROL_DISAGREE)),
        F.lit(REVIEW_CLEARED),
    )
    status = F.when(reason == REVIEW_CLEARED, F.lit(AUTO_CLEARED)).otherwise(F.lit(NEEDS_REVIEW))
    return F.struct(status.alias("status"), reason.alias("reason"))


OPINION_COLUMNS = {
    "diagnosed": "boolean",
    "cause": "string",
    "explanation": "string",
    "confidence": "double",
    "recommended_action": "string",
    "model": "string",
    "prompt_version": "string",
    "case_fingerprint": "string",
    "latency_ms": "bigint",
    "error": "string",
}


def audit_assembly(
    marked: DataFrame,
    opinions: DataFrame | None,
    run_id: str,
    run_started_at: str,
    repeated_orders: bool = False,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """One nested record per row of the result.

    ``marked`` is the result with its ``selection_reason``; ``opinions`` has one row per
    order that was asked about, with its case fingerprint, or is None when the advisory
    stage did not run. An opinion on an order that was not selected is left out. With
    ``repeated_orders`` the rows of an id that has very many are spread for the join.
    """
    stage_on = opinions is not None
    selected = F.col("selection_reason")
    if stage_on:
        given = opinions.select("order_id", *OPINION_COLUMNS)
        if repeated_orders:
            sizes = marked.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
            rows = marked.withColumn("_row", F.monotonically_increasing_id())
            joined = join_many_to_one(rows, given, "order_id", sizes, ["_row"], rows_per_slice)
        else:
            joined = marked.join(given, "order_id", "left")
        joined = joined.withColumns(
            {c: F.when(selected != NOT_SELECTED, F.col(c)) for c in OPINION_COLUMNS}
        )
    else:
        joined = marked.withColumns({c: F.lit(None).cast(t) for c, t in OPINION_COLUMNS.items()})

    category = F.col("category")
    invoked = F.col("diagnosed").isNotNull()
    agreed = agreement(F.col("cause"), category)
    review = decide_review(category, agreed, F.col("error"))
    columns = {
        "run_id": F.lit(run_id),
        "run_started_at": F.lit(run_started_at).cast("timestamp"),
        "order_id": F.col("order_id"),
        "engine_match_tier": F.col("match_tier"),
        "engine_category": category,
        "engine_reasoning": F.col("reasoning"),
        "engine_evidence": evidence_struct(),
        "agent_selection_reason": selected,
        "agent_invoked": invoked,
        "agent_skip_reason": skip_reason(invoked, selected, category, stage_on),
        "agent_cause": F.col("cause"),
        "agent_explanation": F.col("explanation"),
        "agent_confidence": F.col("confidence"),
        "agent_recommended_action": F.col("recommended_action"),
        "agent_model": F.col("model"),
        "agent_prompt_version": F.col("prompt_version"),
        "agent_case_fingerprint": F.col("case_fingerprint"),
        "agent_latency_ms": F.when(F.col("diagnosed"), F.col("latency_ms")),
        "agent_error": F.col("error"),
        "agent_explanation_cites_figures": cites_figures("explanation"),
        "engine_agent_agreement": agreed,
        "review_status": review["status"],
        "review_reason": review["reason"],
        **governance_columns(),
    }
    return joined.select([columns[name].alias(name) for name in audit_schema().names])


def flatten_audit(audit: DataFrame) -> DataFrame:
    """The nested evidence as ``evidence_*`` columns after the record's own."""
    own = [c for c in audit.columns if c != "engine_evidence"]
    nested = audit.schema["engine_evidence"].dataType.names
    lifted = [F.col(f"engine_evidence.{c}").alias(f"evidence_{c}") for c in nested]
    return audit.select(*own, *lifted)


def nest_audit(flat: DataFrame) -> DataFrame:
    """The record as a document again: ``evidence_*`` columns back into one struct."""
    prefix = "evidence_"
    figures = [c for c in flat.columns if c.startswith(prefix)]
    evidence = F.struct(*[F.col(c).alias(c.removeprefix(prefix)) for c in figures])
    whole = flat.withColumn("engine_evidence", evidence)
    return whole.select(*audit_schema().names)


def audit_order(audit: DataFrame) -> DataFrame:
    """Unmatched orders first, then the doubtful, then the exact; by id within."""
    return audit.orderBy(by_code(F.col("engine_match_tier"), TIER_RANK), "order_id")

