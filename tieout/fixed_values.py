"""Codes, rates and texts that results must carry exactly as written here."""

from decimal import Decimal

# --- rates and limits ---------------------------------------------------------
GST_RATE = Decimal("0.18")
TOLERANCE = Decimal("0.01")
CONTROL_SAMPLE_SIZE = 5
CONTROL_SAMPLE_SEED = 42
SETTLEMENT_LAG_DAYS = 2
MIN_CLEAN_SHARE = Decimal("0.90")

# --- closed code sets ---------------------------------------------------------
CLEAN = "clean_match"
TIMING_LAG = "timing_lag_refund"
RATE_MISMATCH = "mdr_rate_mismatch"
DUPLICATE = "duplicate_transaction"
MISSING = "missing_payout"
UNEXPLAINED = "unexplained_value_break"

CATEGORIES = (CLEAN, TIMING_LAG, RATE_MISMATCH, DUPLICATE, MISSING, UNEXPLAINED)
TIER_OF_CATEGORY = {
    CLEAN: "exact",
    TIMING_LAG: "fuzzy",
    RATE_MISMATCH: "fuzzy",
    UNEXPLAINED: "fuzzy",
    DUPLICATE: "no_match",
    MISSING: "no_match",
}
TIERS = ("exact", "fuzzy", "no_match")
TIER_RANK = {"no_match": 0, "fuzzy": 1, "exact": 2}
CAUSES = (CLEAN, TIMING_LAG, RATE_MISMATCH, DUPLICATE, MISSING, "other")

FLAGGED = "flagged_by_engine"
CONTROL = "clean_control_sample"
NOT_SELECTED = "not_selected"
SELECTION_REASONS = (FLAGGED, CONTROL, NOT_SELECTED)

AGREE = "agree"
DISAGREE = "disagree"
NOT_ASSESSED = "not_assessed"
AGREEMENTS = (AGREE, DISAGREE, NOT_ASSESSED)

NEEDS_REVIEW = "needs_human_review"
AUTO_CLEARED = "auto_cleared"
REVIEW_STATUSES = (NEEDS_REVIEW, AUTO_CLEARED)

# --- verdict sentences; {name} marks a figure ---------------------------------
ENGINE_SENTENCES = {
    CLEAN: "Settlement matches the expected MDR fee, GST, and refund adjustment exactly.",
    TIMING_LAG: (
        "Order has a refund of {refund} not reflected in this settlement's refund_adjustment; "
        "likely pending the next cycle."
    ),
    RATE_MISMATCH: (
        "MDR fee charged ({fee}) does not match the agreed rate (expected {expected_fee})."
    ),
    DUPLICATE: (
        "Order has {row_count} settlement lines for the same transaction. "
        "Investigate duplicate payout."
    ),
    MISSING: "No settlement record found for this order in this batch.",
    UNEXPLAINED: (
        "MDR fee and refund adjustment both tie out, but the settlement line does not add up "
        "against itself: on a charged fee of {fee}, GST should be {gst_on_charged} "
        "(actual {gst}) and net should be {identity_net} (actual {net}). "
        "No known exception type explains this; investigate."
    ),
}
TRUTH_SENTENCES = {
    CLEAN: "Amounts reconcile exactly; no action needed.",
    TIMING_LAG: (
        "Refund of {refund} issued on {refund_date} was not netted in this settlement batch; "
        "expected in the next cycle."
    ),
    RATE_MISMATCH: (
        "MDR fee charged ({fee}) does not match the agreed rate (expected {expected_fee})."
    ),
    DUPLICATE: "Settlement contains a duplicate entry for transaction_id {transaction_id}.",
    MISSING: "No settlement record found for this order in this batch.",
}

# --- case text; {name} marks a field, {lines} the listed settlement lines -----
CASE_TEXT = """Order {order_id}:
- order_amount: {order_amount}
- order_date: {order_date}
- refund_amount on the order: {refund_amount}
- refund_date: {refund_date}
- expected_mdr_rate (agreed): {expected_mdr_rate}

Recomputed expected settlement figures (from the order alone, at the agreed rate):
- expected_mdr_fee: {expected_mdr_fee}
- expected_gst_on_mdr: {expected_gst_on_mdr}
- expected_refund_adjustment: {expected_refund_adjustment}
- expected_net_amount: {expected_net_amount}

Actual settlement_report line(s) for this order ({settlement_row_count} found):
{lines}

Batch-level context:
- bank_feed credit for this order's settlement batch: {batch_bank_credit_amount}
- sum of settlement_report.net_amount for that batch: {batch_computed_settlement_net}"""
CASE_LINE_TEXT = (
    "  - transaction_id={transaction_id}, mdr_fee={mdr_fee}, gst_on_mdr={gst_on_mdr}, "
    "refund_adjustment={refund_adjustment}, net_amount={net_amount}, "
    "batch={settlement_batch_id}"
)
CASE_NO_LINES = "  (none: no settlement_report row exists for this order)"
CASE_NO_VALUE = "None"

# --- advisory stage texts -----------------------------------------------------
SKIP_CLEAN = (
    "engine matched this order cleanly and it was not drawn as a control; "
    "advisory diagnosis is reserved for flagged orders"
)
SKIP_NOT_REACHED = "not reached (run limited via max_flagged)"
SKIP_STAGE_OFF = "reasoning_stage_disabled (--no-llm)"
FAILED_TEMPLATE = "no schema-valid response after {attempts} attempts: {error}"

REVIEW_FLAGGED = "Engine flagged an exception; advisory diagnosis attached for context."
REVIEW_FLAGGED_DISAGREE = (
    "Engine flagged an exception and the advisory agent diagnosed a different cause. "
    "Review both before acting."
)
REVIEW_CONTROL_ERROR = (
    "Engine matched cleanly, but the advisory agent failed to return a valid diagnosis for "
    "this control sample, flagged so the failure isn't invisible."
)
REVIEW_CONTROL_DISAGREE = (
    "Engine matched cleanly but the advisory agent disagreed, escalated rather than resolved "
    "toward either."
)
REVIEW_CLEARED = "Engine matched cleanly; no exception detected."

# --- governance constants, repeated on every audit row ------------------------
AUDIT_SCHEMA_VERSION = "1.0"
ACTION_TAKEN = "none"
ACTION_POLICY = "advisory_only"
ACTION_NOTE = (
    "This run produced a classification and, where applicable, a diagnosis and "
    "recommendation. No autonomous action was taken: no ledger entry, payout, refund, "
    "settlement correction, or write-back to any source system was performed. Any "
    "corrective action requires human review and approval."
)

# --- display texts ------------------------------------------------------------
CATEGORY_LABELS = {
    CLEAN: "Clean match",
    TIMING_LAG: "Refund timing lag",
    RATE_MISMATCH: "MDR rate mismatch",
    DUPLICATE: "Duplicate transaction",
    MISSING: "Missing payout",
}
RUPEE = "₹"
MINUS = "−"

# --- patterns -----------------------------------------------------------------
UUID_PATTERN = "[0-9a-f]{8}-[0-9a-f-]{27}"

# --- column lists of the published files --------------------------------------
AUDIT_CSV_COLUMNS = (
    "run_id",
    "order_id",
    "engine_match_tier",
    "engine_category",
    "engine_reasoning",
    "agent_selection_reason",
    "agent_invoked",
    "agent_cause",
    "agent_confidence",
    "agent_explanation",
    "agent_explanation_cites_figures",
    "agent_recommended_action",
    "agent_error",
    "engine_agent_agreement",
    "review_status",
    "review_reason",
    "action_taken",
    "autonomous_action_taken",
)
QUEUE_COLUMNS = (
    "order_id",
    "engine_category",
    "agent_cause",
    "engine_agent_agreement",
    "agent_confidence",
    "agent_explanation",
    "agent_recommended_action",
    "action_taken",
    "autonomous_action_taken",
)
SLICE_COLUMNS = (
    "order_id",
    "engine_match_tier",
    "engine_category",
    "evidence_order_amount",
    "agent_cause",
    "agent_confidence",
    "engine_agent_agreement",
    "review_status",
    "action_taken",
    "autonomous_action_taken",
)
