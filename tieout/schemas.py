"""Table schemas. Money is exact: decimal(18,2), rates decimal(6,4)."""

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(6, 4)


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


LEDGER = _struct(
    ("order_id", T.StringType(), False),
    ("customer_id", T.StringType(), False),
    ("order_amount", MONEY, False),
    ("order_date", T.DateType(), False),
    ("refund_amount", MONEY, True),
    ("refund_date", T.DateType(), True),
    ("expected_mdr_rate", RATE, False),
)

LINES = _struct(
    ("transaction_id", T.StringType(), False),
    ("order_id", T.StringType(), False),
    ("gross_amount", MONEY, False),
    ("mdr_fee", MONEY, False),
    ("gst_on_mdr", MONEY, False),
    ("refund_adjustment", MONEY, False),
    ("net_amount", MONEY, False),
    ("utr_number", T.StringType(), False),
    ("settlement_batch_id", T.StringType(), False),
)

BANK_FEED = _struct(
    ("utr_number", T.StringType(), False),
    ("bank_credit_amount", MONEY, False),
    ("credit_date", T.DateType(), False),
    ("settlement_batch_id", T.StringType(), False),
)

GROUND_TRUTH = _struct(
    ("order_id", T.StringType(), False),
    ("exception_type", T.StringType(), False),
    ("expected_reasoning", T.StringType(), False),
    ("related_transaction_id", T.StringType(), True),
)

RESPONSES = _struct(
    ("order_id", T.StringType(), False),
    ("attempt", T.LongType(), False),
    ("content", T.StringType(), True),
    ("latency_ms", T.LongType(), True),
    ("model", T.StringType(), True),
    ("prompt_version", T.StringType(), True),
)

EVIDENCE = _struct(
    ("order_amount", MONEY, True),
    ("expected_mdr_fee", MONEY, True),
    ("actual_mdr_fee", MONEY, True),
    ("expected_refund_adjustment", MONEY, True),
    ("actual_refund_adjustment", MONEY, True),
    ("expected_net_amount", MONEY, True),
    ("actual_net_amount", MONEY, True),
    ("settlement_row_count", T.LongType(), True),
    ("transaction_id", T.StringType(), True),
    ("settlement_batch_id", T.StringType(), True),
)


def audit_schema(order_id_type: T.DataType = T.StringType()) -> T.StructType:
    """The nested audit document; ``order_id`` keeps whatever type the ledger uses."""
    return _struct(
        ("schema_version", T.StringType(), False),
        ("run_id", T.StringType(), False),
        ("run_started_at", T.TimestampType(), False),
        ("order_id", order_id_type, False),
        ("engine_match_tier", T.StringType(), False),
        ("engine_category", T.StringType(), False),
        ("engine_reasoning", T.StringType(), False),
        ("engine_evidence", EVIDENCE, False),
        ("agent_selection_reason", T.StringType(), False),
        ("agent_invoked", T.BooleanType(), False),
        ("agent_skip_reason", T.StringType(), True),
        ("agent_cause", T.StringType(), True),
        ("agent_explanation", T.StringType(), True),
        ("agent_confidence", T.DoubleType(), True),
        ("agent_recommended_action", T.StringType(), True),
        ("agent_model", T.StringType(), True),
        ("agent_prompt_version", T.StringType(), True),
        ("agent_case_fingerprint", T.StringType(), True),
        ("agent_latency_ms", T.LongType(), True),
        ("agent_error", T.StringType(), True),
        ("agent_explanation_cites_figures", T.BooleanType(), False),
        ("engine_agent_agreement", T.StringType(), False),
        ("review_status", T.StringType(), False),
        ("review_reason", T.StringType(), False),
        ("action_taken", T.StringType(), False),
        ("autonomous_action_taken", T.BooleanType(), False),
        ("action_policy", T.StringType(), False),
        ("action_note", T.StringType(), False),
    )


_COUNTS = T.MapType(T.StringType(), T.LongType())

RUN_SUMMARY = _struct(
    ("schema_version", T.StringType(), True),
    ("run_id", T.StringType(), True),
    ("run_started_at", T.TimestampType(), True),
    ("run_completed_at", T.TimestampType(), True),
    ("duration_seconds", T.DoubleType(), True),
    ("data_source", T.StringType(), True),
    ("total_orders", T.LongType(), True),
    ("tier_counts", _COUNTS, True),
    ("category_counts", _COUNTS, True),
    ("exact_match_rate", T.DoubleType(), True),
    ("auto_resolved_rate", T.DoubleType(), True),
    ("batches_checked", T.LongType(), True),
    ("batches_balanced", T.LongType(), True),
    ("flagged_orders", T.LongType(), True),
    ("agent_invoked_count", T.LongType(), True),
    ("agent_failed_count", T.LongType(), True),
    ("control_sample_count", T.LongType(), True),
    ("agent_model", T.StringType(), True),
    ("agent_prompt_version", T.StringType(), True),
    ("agent_temperature", T.DoubleType(), True),
    ("agent_total_latency_ms", T.LongType(), True),
    ("agreement_on_flagged", _COUNTS, True),
    ("mean_agent_confidence", T.DoubleType(), True),
    ("explanations_citing_figures", T.LongType(), True),
    ("orders_needing_human_review", T.LongType(), True),
    ("orders_auto_cleared", T.LongType(), True),
    ("autonomous_actions_taken", T.LongType(), True),
    ("action_policy", T.StringType(), True),
    ("action_note", T.StringType(), True),
)
