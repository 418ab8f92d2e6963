import json

import pytest

from tests.rows import replies_df
from tieout.functions.text import cites_figures, message_text
from tieout.operators import audit as au
from tieout.operators import diagnosis as di
from tieout.operators import quality as qu
from tieout.operators import selection as se
from tieout.plans.run import Inputs, Settings, audit_of


def reply(**changes):
    fields = {
        "cause": "clean_match",
        "explanation": "fee 5.75",
        "confidence": 0.85,
        "recommended_action": "none",
    }
    fields.update(changes)
    return json.dumps({k: v for k, v in fields.items() if v != "absent"})


REPLIES = {
    "plain": (reply(), None),
    "extra_key": (reply(note=1), None),
    "percent": (reply(confidence=85), None),
    "integer_one": (reply(confidence=1), None),
    "exponent": (reply(confidence=9e-1), None),
    "in_blocks": (json.dumps([{"type": "text", "text": reply()}]), None),
    "split_blocks": (json.dumps([{"text": reply()[:9]}, {"x": 1}, {"text": reply()[9:]}]), None),
    "spaces": ("  \n" + reply() + " \n", None),
    "not_json": ("not json", "not JSON"),
    "empty": ("", "not JSON"),
    "no_content": (None, "not JSON"),
    "trailing": (reply() + " trailing", "not JSON"),
    "two_objects": (reply() + "," + reply(), "not JSON"),
    "closed_list": (reply() + "] }", "not JSON"),
    "closed_object": (reply() + "} ]", "not JSON"),
    "a_list": ("[1]", "invalid field: cause"),
    "bare_text": ('"x"', "invalid field: cause"),
    "unknown_cause": (reply(cause="fraud"), "invalid field: cause"),
    "cause_number": (reply(cause=5), "invalid field: cause"),
    "no_explanation": (reply(explanation="absent"), "invalid field: explanation"),
    "null_explanation": (reply(explanation=None), "invalid field: explanation"),
    "confidence_text": (reply(confidence="0.9"), "invalid field: confidence"),
    "confidence_null": (reply(confidence=None), "invalid field: confidence"),
    "no_action": (reply(recommended_action="absent"), "invalid field: recommended_action"),
    "action_object": (reply(recommended_action={}), "invalid field: recommended_action"),
}


def test_reply_validity(spark):
    df = replies_df(spark, *[(name, 1, text, 10) for name, (text, _) in REPLIES.items()])
    got = {r.order_id: r for r in di.parse_diagnosis(df).collect()}
    assert {k: r.error for k, r in got.items()} == {k: e for k, (_, e) in REPLIES.items()}
    assert all(r.valid == (r.error is None) for r in got.values())
    assert got["percent"].confidence == 0.85
    assert got["integer_one"].confidence == 1.0
    assert got["split_blocks"].explanation == "fee 5.75"


def test_confidence_range(spark):
    df = spark.createDataFrame([(85.0,), (0.85,), (250.0,), (-1.0,), (None,)], "c double")
    got = [r[0] for r in df.select(di.normalize_confidence("c")).collect()]
    assert got == [0.85, 0.85, 1.0, 0.0, None]


def test_cites_figures(spark):
    texts = ["fee 6b65a6a4-8b81-48f6-b38a-088ca65ed389 off", "fee 5.75", None, "", "none"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(cites_figures("t")).collect()] == [
        False, True, False, False, False,
    ]


def test_message_text_keeps_broken_lists(spark):
    df = spark.createDataFrame([("[oops",), ("plain",)], "t string")
    assert [r[0] for r in df.select(message_text(df.t)).collect()] == ["[oops", "plain"]


def test_first_valid_attempt_wins(spark):
    df = replies_df(
        spark,
        ("retry", 1, "bad", 10),
        ("retry", 2, reply(cause="other"), 20),
        ("retry", 3, reply(), 40),
        ("never", 1, "bad", 1),
        ("never", 2, reply(cause="fraud"), 2),
        ("never", 3, reply(confidence="high"), 4),
        ("late", 4, reply(), 1),
        ("from_zero", 0, "bad", 3),
        ("from_zero", 7, reply(cause="other"), 5),
        ("from_zero", 9, reply(), 6),
        ("once", 1, "bad", 2),
        *[("copies", 1, reply(), 7)] * 50,
    )
    got = {r.order_id: r for r in di.resolve_attempts(di.parse_diagnosis(df)).collect()}
    assert set(got) == {"retry", "never", "copies", "late", "from_zero", "once"}
    assert (got["late"].diagnosed, got["late"].attempts_used, got["late"].latency_ms) == (True, 1, 1)
    zero = got["from_zero"]
    assert (zero.cause, zero.attempts_used, zero.latency_ms) == ("other", 2, 8)
    assert got["once"].error == "no schema-valid response after 1 attempts: not JSON"
    limited = {r.order_id: r for r in di.resolve_attempts(di.parse_diagnosis(df), 1).collect()}
    assert set(limited) == set(got)
    assert not limited["retry"].diagnosed and limited["late"].diagnosed
    assert (got["retry"].cause, got["retry"].latency_ms, got["retry"].attempts_used) == (
        "other", 30, 2,
    )
    assert got["never"].error == (
        "no schema-valid response after 3 attempts: invalid field: confidence"
    )
    assert (got["never"].diagnosed, got["never"].latency_ms) == (False, 7)
    assert got["copies"].latency_ms == 7


@pytest.mark.parametrize(
    ("category", "agreed", "error", "status", "reason"),
    [
        ("missing_payout", "agree", None, "needs_human_review", "attached for context"),
        ("missing_payout", "disagree", None, "needs_human_review", "different cause"),
        ("missing_payout", "not_assessed", "x", "needs_human_review", "attached for context"),
        ("clean_match", "not_assessed", "x", "needs_human_review", "failed to return"),
        ("clean_match", "disagree", None, "needs_human_review", "rather than resolved"),
        ("clean_match", "agree", None, "auto_cleared", "no exception"),
        ("clean_match", "not_assessed", None, "auto_cleared", "no exception"),
    ],
)
def test_routing(spark, category, agreed, error, status, reason):
    df = spark.createDataFrame([(category, agreed, error)], "c string, a string, e string")
    row = df.select(au.decide_review(df.c, df.a, df.e).alias("r")).first().r
    assert row.status == status
    assert reason in row.reason


def test_capped_and_disabled_stages(tables):
    result = tables.stored_result
    inputs = Inputs(tables.ledger, tables.lines, tables.bank_feed, tables.responses)
    capped = audit_of(result, inputs, Settings("r", "2026-01-05 00:00:00", cap=10))
    reasons = {r[0]: r[1] for r in capped.groupBy("agent_skip_reason").count().collect()}
    assert reasons == {
        None: 15,
        "not reached (run limited via max_flagged)": 141,
        "engine matched this order cleanly and it was not drawn as a control; "
        "advisory diagnosis is reserved for flagged orders": 1344,
    }
    off = audit_of(
        result,
        Inputs(tables.ledger, tables.lines, tables.bank_feed),
        Settings("r", "2026-01-05 00:00:00"),
    )
    assert off.filter("agent_invoked").count() == 0
    assert [r[0] for r in off.select("agent_skip_reason").distinct().collect()] == [
        "reasoning_stage_disabled (--no-llm)"
    ]


def test_marking_equals_selecting(tables):
    result = tables.stored_result
    for cap in (None, 20):
        marked = se.mark_selection(result, controls=7, cap=cap)
        chosen = marked.filter("selection_reason <> 'not_selected'")
        picked = se.select_for_diagnosis(result, controls=7, cap=cap)
        assert sorted(chosen.select("order_id", "selection_reason").collect()) == sorted(
            picked.collect()
        )
        assert marked.count() == result.count()


def test_governance_holds(tables):
    checks = qu.check_governance(tables.audit, tables.stored_result).collect()
    assert len(checks) == 11
    assert all(r.passed for r in checks)
