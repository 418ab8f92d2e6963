from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.rows import bank_df, ledger_df, line, lines_df, order
from tieout.functions.money import breaks_tolerance
from tieout.operators import batches as ba
from tieout.operators import reconcile as re
from tieout.operators import summary as su
from tieout.operators.lines import lines_per_order, orphan_lines

CASES = {
    # name: (order, lines, category)
    "clean": (order("clean"), [line("clean")], "clean_match"),
    "fee_one_paisa": (
        order("fee_one_paisa"),
        [line("fee_one_paisa", fee="20.01", net="976.39")],
        "clean_match",
    ),
    "fee_two_paise": (
        order("fee_two_paise"),
        [line("fee_two_paise", fee="20.02", net="976.38")],
        "mdr_rate_mismatch",
    ),
    "rounding": (
        order("rounding", amount="1462.75"),
        [line("rounding", fee="29.25", gst="5.26", net="1428.24")],
        "clean_match",
    ),
    "fee_before_refund": (
        order("fee_before_refund", refund="100.00"),
        [line("fee_before_refund", fee="21.00", gst="3.78", net="975.22")],
        "mdr_rate_mismatch",
    ),
    "refund_pending": (
        order("refund_pending", refund="100.00"),
        [line("refund_pending")],
        "timing_lag_refund",
    ),
    "refund_unasked": (
        order("refund_unasked"),
        [line("refund_unasked", refund="10.00", net="966.40")],
        "timing_lag_refund",
    ),
    "net_off": (order("net_off"), [line("net_off", net="975.40")], "unexplained_value_break"),
    "gst_off": (
        order("gst_off"),
        [line("gst_off", gst="4.60", net="975.40")],
        "unexplained_value_break",
    ),
    "two_lines": (
        order("two_lines"),
        [line("two_lines", txn="T-a"), line("two_lines", txn="T-b")],
        "duplicate_transaction",
    ),
    "no_line": (order("no_line"), [], "missing_payout"),
    "null_figures": (
        order("null_figures"),
        [line("null_figures", fee=None, refund=None, net=None)],
        "clean_match",
    ),
}


@pytest.fixture(scope="module")
def inputs(spark):
    ledger = ledger_df(spark, *[o for o, _, _ in CASES.values()])
    lines = lines_df(spark, *[ln for _, some, _ in CASES.values() for ln in some], line("orphan"))
    return ledger, lines


def test_every_branch(inputs):
    got = {r.order_id: r for r in re.reconcile(*inputs).collect()}
    assert {k: r.category for k, r in got.items()} == {k: c for k, (_, _, c) in CASES.items()}
    assert all(r.reasoning for r in got.values())
    assert got["clean"].match_tier == "exact"
    assert got["net_off"].match_tier == "fuzzy"
    assert got["no_line"].match_tier == "no_match"
    assert got["no_line"].settlement_row_count == 0
    assert got["fee_two_paise"].reasoning == (
        "MDR fee charged (20.02) does not match the agreed rate (expected 20.00)."
    )
    assert "refund of 0.00 not reflected" in got["refund_unasked"].reasoning
    assert "net should be 976.40 (actual 975.40)" in got["net_off"].reasoning


def test_strict_flags_missing_figures(inputs):
    got = {r.order_id: r.category for r in re.reconcile(*inputs, strict=True).collect()}
    assert got.pop("null_figures") == "unexplained_value_break"
    assert got == {k: c for k, (_, _, c) in CASES.items() if k != "null_figures"}


def test_wider_tolerance(inputs):
    got = {r.order_id: r.category for r in re.reconcile(*inputs, tolerance="0.02").collect()}
    assert got["fee_two_paise"] == "clean_match"


def test_result_ignores_partitioning_and_row_order(inputs):
    ledger, lines = inputs
    plain = sorted(re.reconcile(ledger, lines).collect())
    for n in (1, 13):
        shuffled = re.reconcile(
            ledger.orderBy(F.rand(n)).repartition(n), lines.orderBy(F.rand(n + 1)).repartition(n)
        )
        assert sorted(shuffled.collect()) == plain


def test_tolerance_on_doubles_rounds_first(spark):
    df = spark.createDataFrame(
        [(10.0149, 10.0), (10.0151, 10.0), (17.51, 17.5), (None, 1.0)], "a double, e double"
    )
    got = [r[0] for r in df.select(breaks_tolerance("a", "e")).collect()]
    assert got == [False, True, False, None]


def test_least_line_is_one_whole_line(spark):
    lines = lines_df(
        spark, line("x", txn="T-b", fee="1.00"), line("x", txn="T-a", fee="9.00", net="5.00")
    )
    row = lines_per_order(lines).first()
    assert (row.transaction_id, row.mdr_fee, row.net_amount) == (
        "T-a",
        Decimal("9.00"),
        Decimal("5.00"),
    )


def test_orphans(inputs):
    ledger, lines = inputs
    assert [r.order_id for r in orphan_lines(lines, ledger).collect()] == ["orphan"]


def test_empty_batch_has_no_rates(inputs):
    ledger, lines = inputs
    none = re.reconcile(ledger.limit(0), lines)
    row = su.match_rates(none).first()
    assert (row.total_orders, row.exact_rate, row.auto_resolved_rate) == (0, None, None)
    assert su.outcome_counts(none).collect() == []


def test_batch_checks(spark):
    lines = lines_df(
        spark,
        line("a", net="10.00", batch="even"),
        line("b", net="10.00", batch="even"),
        line("c", net="10.00", batch="off"),
        line("d", net="10.00", batch="unfed"),
        line("e", net="10.00", batch="edge"),
    )
    bank = bank_df(
        spark, ("u1", "20.00", "even"), ("u2", "15.00", "off"), ("u3", "9.00", "ghost"),
        ("u4", "10.01", "edge"),
    )
    checked = ba.batch_check(bank, lines)
    balanced = {r.settlement_batch_id: r.batch_balanced for r in checked.collect()}
    assert balanced == {"even": True, "off": False, "ghost": None, "edge": True}
    assert ba.batch_check_rollup(checked).first().asDict() == {
        "total_batches": 4,
        "balanced_batches": 3,
        "unbalanced_batches": 1,
    }
    assert [r.settlement_batch_id for r in ba.unbalanced_batches(checked).collect()] == ["off"]
    strict = {r.settlement_batch_id: r.status for r in ba.batch_check_strict(bank, lines).collect()}
    assert strict == {
        "even": "balanced",
        "edge": "balanced",
        "off": "unbalanced",
        "ghost": "unmatched_bank",
        "unfed": "unmatched_lines",
    }


def test_derived_tables_have_the_known_counts(tables):
    categories = {r.category: r.n for r in su.category_counts(tables.result).collect()}
    assert categories == {
        "clean_match": 1349,
        "timing_lag_refund": 62,
        "mdr_rate_mismatch": 37,
        "duplicate_transaction": 21,
        "missing_payout": 24,
        "unexplained_value_break": 7,
    }
    assert tables.lines.count() == 1501
    assert tables.lines.filter("order_id < 0").count() == 4
    assert tables.bank_feed.count() == 60
