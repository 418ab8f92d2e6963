"""Checks as result tables: (check_name, passed, n_bad), one row per check."""

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieout.fixed_values import (
    ACTION_TAKEN,
    AGREEMENTS,
    CATEGORIES,
    CLEAN,
    DUPLICATE,
    MIN_CLEAN_SHARE,
    MISSING,
    NEEDS_REVIEW,
    RATE_MISMATCH,
    REVIEW_STATUSES,
    SELECTION_REASONS,
    TIERS,
    TIMING_LAG,
    TOLERANCE,
)
from tieout.functions.money import percentage_of
from tieout.operators.summary import side_by_side


def as_rows(counts: DataFrame, names: list[str]) -> DataFrame:
    """A one-row frame of bad-row counts as check rows."""
    rows = F.array(
        *[F.struct(F.lit(n).alias("check_name"), F.col(n).alias("n_bad")) for n in names]
    )
    return counts.select(F.inline(rows)).select(
        "check_name", (F.col("n_bad") == 0).alias("passed"), "n_bad"
    )


def _check(df: DataFrame, bad: dict[str, Column]) -> DataFrame:
    """All checks of one table in one pass."""
    counted = df.agg(*[F.count_if(F.coalesce(c, F.lit(True))).alias(n) for n, c in bad.items()])
    return as_rows(counted, list(bad))


def check_counts(ledger: DataFrame, lines: DataFrame, truth: DataFrame) -> DataFrame:
    """Ids are unique, every order has one answer, and required columns are filled.

    Each table is read once: the rows of ledger and answer key meet by id with their gaps
    already counted, so grain and gaps come out of one aggregate.
    """
    required = {
        "ledger": ("order_id", "order_amount", "order_date", "expected_mdr_rate"),
        "lines": ("transaction_id", "order_id", "mdr_fee", "gst_on_mdr", "net_amount"),
        "truth": ("order_id", "exception_type"),
    }

    def gaps(table: str) -> dict[str, Column]:
        return {f"{table}_{c}_filled": F.col(c).isNull() for c in required[table]}

    sides = {"ledger": ledger, "truth": truth}
    names = [n for side in sides for n in gaps(side)]
    rows = None
    for side, df in sides.items():
        own = gaps(side)
        counters = [F.lit(int(side == s)).alias(f"_{s}") for s in sides]
        counters += [(own[n].cast("int") if n in own else F.lit(0)).alias(n) for n in names]
        part = df.select("order_id", *counters)
        rows = part if rows is None else rows.unionByName(part)
    per_id = rows.groupBy("order_id").agg(
        *[F.sum(f"_{s}").alias(f"_{s}") for s in sides], *[F.sum(n).alias(n) for n in names]
    )
    o, t = F.col("_ledger"), F.col("_truth")
    grain = {
        "order_id_unique": o > 1,
        "one_truth_per_order": (o > 0) & (t != 1),
        "truth_has_order": o == 0,
    }
    counted = per_id.agg(
        *[F.count_if(bad).alias(n) for n, bad in grain.items()],
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names],
    )
    return as_rows(counted, [*grain, *names]).unionByName(_check(lines, gaps("lines")))


def check_requested_labels(truth: DataFrame, asked: DataFrame) -> DataFrame:
    """Each label of ``asked(label, requested, slack)``: how far its count is from the one asked
    for. A label that is not in the answer key counts as found no times."""
    found = truth.groupBy(F.col("exception_type").alias("label")).agg(
        F.count(F.lit(1)).alias("found")
    )
    gap = F.abs(F.coalesce("found", F.lit(0)) - F.col("requested")).cast("bigint")
    return asked.join(found, "label", "left").select(
        F.concat("label", F.lit("_as_requested")).alias("check_name"),
        (gap <= F.col("slack")).alias("passed"),
        gap.alias("n_bad"),
    )


def check_run_digest(digest: DataFrame, pinned: str) -> DataFrame:
    """Whether the run's id digest is the pinned one."""
    same = F.col("run_digest") == F.lit(pinned)
    return digest.select(
        F.lit("id_digest_as_pinned").alias("check_name"),
        same.alias("passed"),
        (~same).cast("bigint").alias("n_bad"),
    )


def check_label_shares(truth: DataFrame) -> DataFrame:
    """At least nine orders in ten are clean."""
    clean = F.count_if(F.col("exception_type") == CLEAN)
    total = F.count(F.lit(1))
    short = clean < total * F.lit(MIN_CLEAN_SHARE)
    return as_rows(truth.agg(short.cast("bigint").alias("clean_share")), ["clean_share"])


def check_labels(ledger: DataFrame, lines: DataFrame, truth: DataFrame) -> DataFrame:
    """Each label against the raw rows: line count, copies, refund, fee."""
    # copies are told by the hash of their id: numbers, so that rows combine in place
    transaction = F.xxhash64("transaction_id")
    seen = lines.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(transaction).alias("t0"),
        F.max(transaction).alias("t1"),
        F.min("mdr_fee").alias("fee"),
        F.min("refund_adjustment").alias("adjustment"),
    )
    joined = ledger.join(truth, "order_id").join(seen, "order_id", "left")
    label = F.col("exception_type")
    n = F.coalesce("n", F.lit(0))
    gap = F.abs(F.col("fee") - percentage_of("order_amount", "expected_mdr_rate"))
    refund = F.coalesce("refund_amount", F.lit(Decimal("0.00")))

    def among(of: Column, bad: Column) -> Column:
        # a comparison that cannot be made counts as bad
        return of & F.coalesce(bad, F.lit(True))

    single = ~label.isin(MISSING, DUPLICATE)
    return _check(
        joined,
        {
            "missing_has_no_line": among(label == MISSING, n != 0),
            "duplicate_has_two_lines": among(label == DUPLICATE, n != 2),
            "duplicate_is_a_copy": among(label == DUPLICATE, F.col("t0") != F.col("t1")),
            "others_have_one_line": among(single, n != 1),
            "timing_lag_has_refund": among(label == TIMING_LAG, F.col("refund_amount").isNull()),
            "timing_lag_not_netted": among(label == TIMING_LAG, F.col("adjustment") != 0),
            "mismatch_fee_is_off": among(label == RATE_MISMATCH, gap <= F.lit(TOLERANCE)),
            "clean_fee_fits": among(label == CLEAN, gap >= F.lit(TOLERANCE)),
            "clean_refund_fits": among(
                label == CLEAN, F.abs(F.col("adjustment") - refund) >= F.lit(TOLERANCE)
            ),
        },
    )


def check_bank_sum(checked: DataFrame) -> DataFrame:
    """Credits that differ from their batch's summed lines by a paisa or more, or have none."""
    bad = F.coalesce(F.abs(F.col("batch_diff")) >= F.lit(TOLERANCE), F.lit(True))
    return checked.filter(bad).select(
        "settlement_batch_id", "bank_credit_amount", "computed_batch_net", "batch_diff"
    )


def check_governance(audit: DataFrame, result: DataFrame) -> DataFrame:
    """What the audit says about itself, row by row, and that no order is left out."""
    invoked = F.col("agent_invoked")

    def outside(column: str, codes: tuple) -> Column:
        return ~F.col(column).isin(*codes)

    def empty(column: str) -> Column:
        return invoked & (F.coalesce(column, F.lit("")) == "")

    rules = _check(
        audit,
        {
            "action_taken_none": F.col("action_taken") != ACTION_TAKEN,
            "no_autonomous_action": F.col("autonomous_action_taken"),
            "flagged_needs_review": (F.col("engine_category") != CLEAN)
            & (F.col("review_status") != NEEDS_REVIEW),
            "invoked_has_prompt_version": empty("agent_prompt_version"),
            "invoked_has_fingerprint": empty("agent_case_fingerprint"),
            "known_tier": outside("engine_match_tier", TIERS),
            "known_category": outside("engine_category", CATEGORIES),
            "known_selection": outside("agent_selection_reason", SELECTION_REASONS),
            "known_agreement": outside("engine_agent_agreement", AGREEMENTS),
            "known_status": outside("review_status", REVIEW_STATUSES),
        },
    )
    counted = side_by_side(
        audit.agg(F.count(F.lit(1)).alias("records")),
        result.agg(F.count(F.lit(1)).alias("orders")),
    )
    gap = counted.select(F.abs(F.col("records") - F.col("orders")).alias("one_record_per_order"))
    return rules.unionByName(as_rows(gap, ["one_record_per_order"]))


def check_graded_all(result: DataFrame, graded: DataFrame) -> DataFrame:
    """Every order was graded, and graded right."""
    right = F.count_if(F.col("category") == F.col("true_category"))
    counted = side_by_side(
        result.agg(F.count(F.lit(1)).alias("orders")),
        graded.agg(F.count(F.lit(1)).alias("graded"), right.alias("right")),
    )
    bad = counted.select(
        F.abs(F.col("orders") - F.col("graded")).alias("all_orders_graded"),
        (F.col("graded") - F.col("right")).alias("all_categories_right"),
    )
    return as_rows(bad, ["all_orders_graded", "all_categories_right"])
