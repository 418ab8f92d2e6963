"""Reconciliation tables derived from the order table by pure functions of the order key.

Every rule below is arithmetic on ``k = o_orderkey``, so the same tables come out under
any partitioning, and errors put into the lines flow on into the bank credits.
"""

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieout.fixed_values import (
    CLEAN,
    DUPLICATE,
    MISSING,
    RATE_MISMATCH,
    SETTLEMENT_LAG_DAYS,
    TIMING_LAG,
    TRUTH_SENTENCES,
    UNEXPLAINED,
)
from tieout.functions.money import gst_on, money, net_of, percentage_of
from tieout.functions.text import batch_code, by_code, customer_code, fill, utr_code

BATCH_SIZE = 25
RATE = Decimal("0.0200")
RATE_SLIP = Decimal("0.0010")
LABEL_BOUNDS = (  # upper bounds, per thousand
    (40, TIMING_LAG),
    (65, RATE_MISMATCH),
    (80, DUPLICATE),
    (95, MISSING),
    (100, UNEXPLAINED),
)
MODEL = "advisory-model-a"
PROMPT_VERSION = "prompt-0001"


def label_of(k: Column) -> Column:
    """One label per order, from disjoint ranges of a scrambled key."""
    slot = k * 7919 % 1000
    ranges = [F.when(slot < bound, F.lit(label)) for bound, label in LABEL_BOUNDS]
    return F.coalesce(*ranges, F.lit(CLEAN))


def derive_ledger(orders: DataFrame) -> DataFrame:
    """The ledger with its internal columns ``_label`` and ``_batch_no``."""
    k = F.col("o_orderkey")
    keyed = orders.select(
        k.alias("order_id"),
        customer_code(F.col("o_custkey")).alias("customer_id"),
        money("o_totalprice").alias("order_amount"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        label_of(k).alias("_label"),
        F.expr(f"o_orderkey div {BATCH_SIZE}").alias("_batch_no"),
    )
    k = F.col("order_id")
    refunded = (k * 37 % 1000 < 150) | (F.col("_label") == TIMING_LAG)
    fraction = ((k * 13 % 8 + 2) * F.lit(Decimal("0.1"))).cast("decimal(4,2)")
    return keyed.select(
        "order_id",
        "customer_id",
        "order_amount",
        "order_date",
        F.when(refunded, percentage_of("order_amount", fraction)).alias("refund_amount"),
        F.when(refunded, F.date_add("order_date", (k % 3 + 1).cast("int"))).alias("refund_date"),
        F.lit(RATE).cast("decimal(6,4)").alias("expected_mdr_rate"),
        "_label",
        "_batch_no",
    )


def drop_internal(df: DataFrame) -> DataFrame:
    return df.select([c for c in df.columns if not c.startswith("_")])


def derive_own_lines(ledger: DataFrame) -> DataFrame:
    """One netted line per order, label kept; missing payouts still have theirs here."""
    label = F.col("_label")
    slip = F.when(label == RATE_MISMATCH, F.lit(RATE_SLIP)).otherwise(F.lit(Decimal("0.0000")))
    refund = F.when(label == TIMING_LAG, F.lit(Decimal("0.00"))).otherwise(
        F.coalesce("refund_amount", F.lit(Decimal("0.00")))
    )
    short = F.when(label == UNEXPLAINED, F.lit(Decimal("1.00"))).otherwise(F.lit(Decimal("0.00")))
    return (
        ledger.withColumns(
            {
                "mdr_fee": percentage_of("order_amount", F.col("expected_mdr_rate") + slip),
                "refund_adjustment": money(refund),
            }
        )
        .withColumn("gst_on_mdr", gst_on("mdr_fee"))
        .select(
            F.concat(F.lit("TXN-"), F.col("order_id").cast("string")).alias("transaction_id"),
            "order_id",
            F.col("order_amount").alias("gross_amount"),
            "mdr_fee",
            "gst_on_mdr",
            "refund_adjustment",
            money(
                net_of("order_amount", "mdr_fee", "gst_on_mdr", "refund_adjustment") - short
            ).alias("net_amount"),
            utr_code(F.col("_batch_no")).alias("utr_number"),
            batch_code(F.col("_batch_no")).alias("settlement_batch_id"),
            "_label",
            "_batch_no",
        )
    )


def with_gaps(lines: DataFrame) -> DataFrame:
    """Lines of which some lack a figure."""
    k = F.col("order_id")
    return lines.withColumns(
        {
            "mdr_fee": F.when(k % 53 != 9, F.col("mdr_fee")),
            "net_amount": F.when(k % 59 != 4, F.col("net_amount")),
        }
    )


def with_repeats(ledger: DataFrame) -> DataFrame:
    """A ledger in which some order ids stand on two or three rows."""
    k = F.col("order_id")
    times = F.when(k % 400 == 3, 3).when(k % 40 == 3, 2).otherwise(1)
    copy = F.explode(F.sequence(F.lit(1), times)).alias("_copy")
    return ledger.select("*", copy).drop("_copy")


def append_duplicates(lines: DataFrame) -> DataFrame:
    """Every line, and once more each line whose order is labelled as paid twice."""
    return lines.unionByName(lines.filter(F.col("_label") == DUPLICATE))


def derive_lines(ledger: DataFrame) -> DataFrame:
    """The settlement report: own lines, verbatim copies, and lines no order asked for.

    One scan: each order yields its line zero, one or two times, and one order in 400 also
    an orphan under a negative order id, which no ledger row can have.
    """
    own = derive_own_lines(ledger)
    label, k = F.col("_label"), F.col("order_id")
    times = F.when(label == MISSING, 0).when(label == DUPLICATE, 2).otherwise(1)
    kinds = F.concat(
        F.array_repeat(F.lit("own"), times),
        F.array_repeat(F.lit("orphan"), F.when(k % 400 == 7, 1).otherwise(0)),
    )
    orphan = F.col("_kind") == "orphan"
    return own.withColumn("_kind", F.explode(kinds)).withColumns(
        {
            "transaction_id": F.when(
                orphan, F.concat(F.lit("TXN-O-"), k.cast("string"))
            ).otherwise(F.col("transaction_id")),
            "order_id": F.when(orphan, -k - 1).otherwise(k),
        }
    )


def derive_bank_feed(ledger: DataFrame, lines: DataFrame) -> DataFrame:
    """One credit per batch of messy lines, with wrong, absent and unowned credits put in."""
    from tieout.operators.batches import bank_netting

    n = F.col("_batch_no")
    netted = bank_netting(ledger, lines, batch="_batch_no", lag_days=SETTLEMENT_LAG_DAYS)
    surplus = F.when(n % 29 == 0, F.lit(Decimal("5.00"))).otherwise(F.lit(Decimal("0.00")))
    kinds = F.concat(
        F.array_repeat(F.lit("own"), F.when(n % 31 == 30, 0).otherwise(1)),
        F.array_repeat(F.lit("ghost"), F.when(n % 37 == 36, 1).otherwise(0)),
    )
    ghost = F.col("_kind") == "ghost"
    return netted.withColumn("_kind", F.explode(kinds)).select(
        utr_code(n).alias("utr_number"),
        F.when(ghost, F.lit(Decimal("10.00")))
        .otherwise(F.col("net_total") + surplus)
        .cast("decimal(18,2)")
        .alias("bank_credit_amount"),
        "credit_date",
        F.when(ghost, batch_code(n, "GHOST-"))
        .otherwise(batch_code(n))
        .alias("settlement_batch_id"),
    )


def truth_reasoning(label: Column) -> Column:
    """The answer key's sentence, from an order joined with its line."""
    expected_fee = percentage_of("order_amount", "expected_mdr_rate")
    figures = {
        "refund": F.col("refund_amount"),
        "refund_date": F.col("refund_date"),
        "fee": F.col("mdr_fee"),
        "expected_fee": expected_fee,
        "transaction_id": F.col("transaction_id"),
    }
    sentences = {code: fill(text, **figures) for code, text in TRUTH_SENTENCES.items()}
    return by_code(label, sentences, otherwise=F.lit(""))


def derive_truth(ledger: DataFrame, lines: DataFrame) -> DataFrame:
    """The answer key: label, sentence and first transaction, one row per order."""
    from tieout.operators.lines import lines_per_order

    joined = ledger.join(lines_per_order(lines), "order_id", "left")
    return joined.select(
        "order_id",
        F.col("_label").alias("exception_type"),
        truth_reasoning(F.col("_label")).alias("expected_reasoning"),
        F.col("transaction_id").alias("related_transaction_id"),
    )


def derive_responses(ledger: DataFrame) -> DataFrame:
    """Raw advisory replies, up to three attempts per order.

    Some attempts are not JSON, lack a field or have a wrongly typed one; some replies come
    as a list of text blocks. Some orders have one bad reply and no more, some number their
    attempts from 0, and some leave gaps.
    """
    k = F.col("order_id")
    hopeless = k % 97 == 5
    retried = k % 11 == 5
    given_up = k % 79 == 11
    attempts = F.when(hopeless, 3).when(given_up, 1).when(retried, 2).otherwise(1)
    cause = F.when((k % 13 == 5) | (F.col("_label") == UNEXPLAINED), F.lit("other")).otherwise(
        F.col("_label")
    )
    explanation = (
        F.when(k % 5 == 0, F.lit("The line agrees with the order."))
        .when(k % 5 == 1, F.format_string("See 00000000-0000-4000-8000-%012d only.", k))
        .otherwise(F.concat(F.lit("Amount on order is "), F.col("order_amount").cast("string")))
    )
    good = F.concat(
        F.lit('{"cause":"'),
        cause,
        F.lit('","explanation":"'),
        explanation,
        F.lit('","confidence":'),
        F.when(k % 7 == 5, F.lit("95")).otherwise(F.lit("0.9")),
        F.lit(',"recommended_action":"Review order '),
        k.cast("string"),
        F.lit('."}'),
    )
    in_blocks = F.to_json(F.array(F.struct(F.lit("text").alias("type"), good.alias("text"))))
    bad = (
        F.when(F.col("attempt") == 1, F.lit("not json"))
        .when(F.col("attempt") == 2, F.lit('{"cause":"clean_match"}'))
        .otherwise(
            F.lit(
                '{"cause":"clean_match","explanation":"x","confidence":"high",'
                '"recommended_action":"x"}'
            )
        )
    )
    is_bad = hopeless | given_up | (F.col("attempt") < attempts)
    number = F.when(k % 89 == 7, F.col("attempt") - 1).when(k % 83 == 9, F.col("attempt") * 3)
    return ledger.withColumn("attempt", F.explode(F.sequence(F.lit(1), attempts))).select(
        "order_id",
        F.coalesce(number, "attempt").cast("bigint").alias("attempt"),
        F.when(is_bad, bad).when(k % 17 == 3, in_blocks).otherwise(good).alias("content"),
        (k % 50 + 100).alias("latency_ms"),
        F.lit(MODEL).alias("model"),
        F.lit(PROMPT_VERSION).alias("prompt_version"),
    )
