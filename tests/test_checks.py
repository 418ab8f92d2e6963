"""Checks must find what is wrong; reports must hold up on empty input."""

from decimal import Decimal

from pyspark.sql import functions as F

from tests.rows import bank_df, ledger_df, line, lines_df, order
from tieout.operators import batches as ba
from tieout.operators import cases as ca
from tieout.operators import grading as gr
from tieout.operators import quality as qu
from tieout.operators import review as rv
from tieout.operators import summary as su
from tieout.operators.reconcile import reconcile
from tieout.schemas import GROUND_TRUTH


def failed(checks):
    return {r.check_name: r.n_bad for r in checks.collect() if not r.passed}


def truth_df(spark, **labels):
    return spark.createDataFrame([(k, v, "", None) for k, v in labels.items()], GROUND_TRUTH)


def test_labels_are_held_against_the_rows(spark):
    ledger = ledger_df(spark, *[order(c) for c in "abcdef"])
    lines = lines_df(spark, line("a"), line("b"), line("c"), line("c", txn="T-other"),
                     line("e", fee="21.00"), line("f"))
    truth = truth_df(
        spark,
        a="missing_payout",
        b="timing_lag_refund",
        c="duplicate_transaction",
        d="clean_match",
        e="clean_match",
        f="mdr_rate_mismatch",
    )
    assert failed(qu.check_labels(ledger, lines, truth)) == {
        "missing_has_no_line": 1,
        "timing_lag_has_refund": 1,
        "duplicate_is_a_copy": 1,
        "others_have_one_line": 1,
        "clean_fee_fits": 2,
        "clean_refund_fits": 1,
        "mismatch_fee_is_off": 1,
    }
    assert failed(qu.check_label_shares(truth)) == {"clean_share": 1}


def test_counts_find_doubles_and_gaps(spark):
    ledger = ledger_df(spark, order("a"), order("a"), order("b"))
    truth = truth_df(spark, a="clean_match", z="clean_match")
    lines = lines_df(spark, line("a", fee=None), line(None))
    assert failed(qu.check_counts(ledger, lines, truth)) == {
        "order_id_unique": 1,
        "one_truth_per_order": 1,
        "truth_has_order": 1,
        "lines_mdr_fee_filled": 1,
        "lines_order_id_filled": 1,
    }


def test_bank_sum_and_grading_checks(spark):
    ledger = ledger_df(spark, order("a"), order("b"), order("c"))
    lines = lines_df(spark, line("a"), line("b"))
    bank = bank_df(spark, ("u", "1952.80", "B1"), ("u", "1952.81", "B1"), ("v", "1.00", "B9"))
    bad = qu.check_bank_sum(ba.batch_check(bank, lines)).collect()
    assert sorted(str(r.batch_diff) for r in bad) == ["0.01", "None"]
    result = reconcile(ledger, lines)
    graded = gr.join_truth(result, truth_df(spark, a="clean_match", b="missing_payout"))
    assert failed(qu.check_graded_all(result, graded)) == {
        "all_orders_graded": 1,
        "all_categories_right": 1,
    }
    assert [r.order_id for r in gr.engine_mismatches(graded).collect()] == ["b"]


def test_governance_finds_actions(tables):
    acted = tables.audit.withColumn(
        "action_taken", F.when(F.col("order_id") == 3, "refunded").otherwise("none")
    ).withColumn("autonomous_action_taken", F.col("order_id") == 4)
    acted = acted.filter("order_id <> 9")
    assert failed(qu.check_governance(acted, tables.stored_result)) == {
        "action_taken_none": 1,
        "no_autonomous_action": 1,
        "one_record_per_order": 1,
    }


def test_reports_on_no_rows(tables):
    flat = tables.flat_audit.limit(0)
    kpi = rv.kpi_tiles(flat).first()
    assert (kpi.orders, kpi.auto_rate, kpi.held_share) == (0, 0.0, 0.0)
    assert [(r.part, r.value, r.share_pct) for r in rv.value_split(flat).collect()] == [
        ("Cleared", Decimal("0.00"), 0.0),
        ("Held for review", Decimal("0.00"), 0.0),
    ]
    assert su.mean_confidence(flat).first()[0] is None
    assert su.latency_total(flat).first()[0] == 0
    assert rv.provenance(flat).first().agent_model == "n/a"
    assert rv.review_queue(flat).count() == 0
    looked_up = flat.withColumn("ground_truth", F.lit("clean_match"))
    counts = gr.grading_counts(looked_up).first()
    assert (counts.engine_accuracy, counts.agent_accuracy) == (0.0, None)


def test_slice_treats_a_missing_amount_as_zero(tables):
    flat = tables.flat_audit.limit(5).withColumn(
        "evidence_order_amount", F.lit(None).cast("decimal(18,2)")
    )
    assert rv.audit_slice(flat).count() == 5
    assert rv.audit_slice(flat, min_amount=1).count() == 0
    assert rv.audit_slice(flat, tiers=[]).count() == 0


def test_requested_labels_and_pinned_digest(spark, tables):
    truth = spark.createDataFrame([("clean_match",)] * 9 + [("missing_payout",)], "exception_type string")
    asked = spark.createDataFrame(
        [("clean_match", 9, 0.0), ("missing_payout", 3, 1.0), ("duplicate_transaction", 1, 1.0)],
        "label string, requested long, slack double",
    )
    got = {r.check_name: (r.passed, r.n_bad) for r in qu.check_requested_labels(truth, asked).collect()}
    assert got == {
        "clean_match_as_requested": (True, 0),
        "missing_payout_as_requested": (False, 2),
        "duplicate_transaction_as_requested": (True, 1),
    }
    digest = ca.run_id_digest(tables.keyed_ledger, "_batch_no")
    pinned = digest.first().run_digest
    assert qu.check_run_digest(digest, pinned).first().passed
    assert qu.check_run_digest(digest, "0" * 64).first().n_bad == 1
