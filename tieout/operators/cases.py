"""Cases: all the evidence on one order, for a second opinion that has not seen the verdict."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tieout.fixed_values import CASE_LINE_TEXT, CASE_NO_LINES, CASE_NO_VALUE, CASE_TEXT
from tieout.functions.digest import canonical, row_set_sums, row_set_text
from tieout.functions.text import fill
from tieout.operators.batches import BATCH, batch_totals
from tieout.operators.reconcile import expected_settlement
from tieout.operators.skew import ROWS_PER_SLICE, join_many_to_one

# An array of this many lines is a few megabytes; orders with more different lines get
# several parts of about so many.
LINES_PER_PART = 50_000

CASE_LINE = (
    "transaction_id",
    "mdr_fee",
    "gst_on_mdr",
    "refund_adjustment",
    "net_amount",
    "settlement_batch_id",
)
CASE_FIELDS = (
    "order_id",
    "order_amount",
    "order_date",
    "refund_amount",
    "refund_date",
    "expected_mdr_rate",
    "expected_mdr_fee",
    "expected_gst_on_mdr",
    "expected_refund_adjustment",
    "expected_net_amount",
    "batch_bank_credit_amount",
    "batch_computed_settlement_net",
)


def batch_context(bank_feed: DataFrame, totals: DataFrame) -> DataFrame:
    """Per batch with lines: what the bank credited (first credit) and what the lines sum to."""
    credit = F.struct("utr_number", "bank_credit_amount")
    credits = bank_feed.groupBy(BATCH).agg(F.min(credit).alias("credit"))
    return totals.join(credits, BATCH, "left").select(
        BATCH,
        F.col("credit.bank_credit_amount").alias("batch_bank_credit_amount"),
        F.col("computed_batch_net").alias("batch_computed_settlement_net"),
    )


def folded_lines(selected: DataFrame, lines: DataFrame) -> DataFrame:
    """The selected orders' lines, verbatim copies as one row; ``copies`` says how many it was."""
    chosen = lines.join(selected.select("order_id"), "order_id", "left_semi")
    return chosen.groupBy("order_id", *CASE_LINE).agg(F.count(F.lit(1)).alias("copies"))


def line_evidence(folded: DataFrame) -> DataFrame:
    """Per order of :func:`folded_lines`: line count, the batch of its least line, a digest of
    all its lines, and how many different ones there are.

    One aggregation that combines map-side; no order's lines are ever brought together.
    """
    text = canonical(**{c: F.col(c) for c in CASE_LINE})
    least = F.min(F.struct(*CASE_LINE)).alias("_least")
    return (
        folded.groupBy("order_id")
        .agg(
            F.sum("copies").alias("settlement_row_count"),
            F.count(F.lit(1)).alias("_different"),
            least,
            *row_set_sums(text, copies=F.col("copies")),
        )
        .select(
            "order_id",
            "settlement_row_count",
            "_different",
            F.col(f"_least.{BATCH}").alias(BATCH),
            row_set_text().alias("_lines_digest"),
        )
    )


def case_headers(
    selected: DataFrame,
    ledger: DataFrame,
    lines: DataFrame,
    bank_feed: DataFrame,
    rows_per_slice: int = ROWS_PER_SLICE,
    totals: DataFrame | None = None,
    evidence: DataFrame | None = None,
) -> DataFrame:
    """One row per ledger row of a selected order: facts, expected figures, batch context, line
    count, and a fingerprint that changes when any figure or line of the case changes.

    Only lines of selected orders are read for evidence; ``totals`` are the stored
    :func:`batch_totals` of all lines, if there are any, and ``evidence`` the orders'
    :func:`line_evidence`, where that is at hand.
    """
    ids = selected.select("order_id")
    totals = batch_totals(lines) if totals is None else totals
    chosen = ledger.join(ids, "order_id", "left_semi")
    facts = expected_settlement(chosen, keep=("order_date", "refund_date", "expected_mdr_rate"))
    if evidence is None:
        evidence = line_evidence(folded_lines(selected, lines))
    headers = facts.join(evidence, "order_id", "left").withColumn(
        "settlement_row_count", F.coalesce("settlement_row_count", F.lit(0).cast("bigint"))
    )
    # an order is placed in the batch of one of its lines, so a batch has no more orders
    # than lines
    placed = join_many_to_one(
        headers, batch_context(bank_feed, totals), BATCH, totals, ["order_id"], rows_per_slice
    )
    return placed.select(
        *CASE_FIELDS, BATCH, "settlement_row_count", case_fingerprint().alias("case_fingerprint")
    )


def case_fingerprint() -> Column:
    """Sixteen hex digits over every field of the case and the digest of its lines."""
    header = canonical(**{c: F.col(c) for c in CASE_FIELDS})
    digest = F.coalesce("_lines_digest", F.lit("0:0:0"))
    return F.substring(F.sha2(F.concat(header, F.lit("|lines="), digest), 256), 1, 16)


def case_lines(
    selected: DataFrame, lines: DataFrame, lines_per_part: int = LINES_PER_PART
) -> DataFrame:
    """The lines of each selected order as arrays of about ``lines_per_part`` entries at most.

    Verbatim copies are one entry, and ``copies`` says how often it occurs. An order's entries
    are dealt to parts by their hash, as many parts as their number asks for; parts that get
    none are not counted, so parts run from 0 to ``n_parts`` - 1 and every line is in exactly
    one. The same holds for orders of any size: one with few lines has part 0 of 1.
    """
    folded = folded_lines(selected, lines)
    return _listed(folded, line_evidence(folded), lines_per_part)


def _listed(folded: DataFrame, evidence: DataFrame, lines_per_part: int) -> DataFrame:
    many = evidence.where(F.col("_different") > lines_per_part).select(
        "order_id", F.ceil(F.col("_different") / lines_per_part).alias("_parts")
    )
    part = F.pmod(F.xxhash64(*CASE_LINE), F.coalesce("_parts", F.lit(1).cast("bigint")))
    dealt = folded.join(many, "order_id", "left").withColumn("_part", part)
    line = F.struct(*CASE_LINE, "copies")
    listed = dealt.groupBy("order_id", "_part").agg(
        F.sort_array(F.collect_list(line)).alias("settlement_lines")
    )
    # parts of the few orders that have several are numbered without their lines
    whole = Window.partitionBy("order_id")
    numbers = (
        dealt.where("_parts is not null")
        .select("order_id", "_part")
        .distinct()
        .select(
            "order_id",
            "_part",
            (F.row_number().over(whole.orderBy("_part")) - 1).alias("part_no"),
            F.count(F.lit(1)).over(whole).cast("int").alias("n_parts"),
        )
    )
    return listed.join(numbers, ["order_id", "_part"], "left").select(
        "order_id",
        F.coalesce("part_no", F.lit(0)).alias("part_no"),
        F.coalesce("n_parts", F.lit(1)).alias("n_parts"),
        "settlement_lines",
    )


def assemble_cases(
    selected: DataFrame,
    ledger: DataFrame,
    lines: DataFrame,
    bank_feed: DataFrame,
    lines_per_part: int = LINES_PER_PART,
    totals: DataFrame | None = None,
) -> DataFrame:
    """Each selected order with its evidence and lines; one row unless it has very many lines.

    Lines are folded once, and counts, digest, least line and lists all come from that.
    """
    folded = folded_lines(selected, lines)
    evidence = line_evidence(folded)
    headers = case_headers(selected, ledger, lines, bank_feed, totals=totals, evidence=evidence)
    parts = _listed(folded, evidence, lines_per_part)
    return headers.join(parts, "order_id", "left").withColumns(
        {
            "part_no": F.coalesce("part_no", F.lit(0)),
            "n_parts": F.coalesce("n_parts", F.lit(1)),
            "settlement_lines": F.coalesce("settlement_lines", F.array()),
        }
    )


def _shown(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(CASE_NO_VALUE))


def line_text(line: Column) -> Column:
    """One listed line; a copy count is added where a row stands for several."""
    text = fill(CASE_LINE_TEXT, **{c: _shown(line[c]) for c in CASE_LINE})
    often = F.concat(F.lit(" (x"), line["copies"].cast("string"), F.lit(")"))
    return F.concat(text, F.when(line["copies"] > 1, often).otherwise(F.lit("")))


def render_case(cases: DataFrame) -> DataFrame:
    """The case as text: facts, expected figures, actual lines, batch context."""

    listed = F.when(F.size("settlement_lines") == 0, F.lit(CASE_NO_LINES)).otherwise(
        F.array_join(F.transform("settlement_lines", line_text), "\n")
    )
    fields = {c: _shown(F.col(c)) for c in (*CASE_FIELDS, "settlement_row_count")}
    text = fill(CASE_TEXT, **fields, lines=listed)
    return cases.select("order_id", "part_no", "n_parts", text.alias("case_text"))


def batch_id_digests(ledger: DataFrame, batch: str) -> DataFrame:
    """Per batch, a digest of its order ids; equal only if the same ids are there."""
    sums = ledger.groupBy(batch).agg(*row_set_sums(F.col("order_id").cast("string")))
    return sums.select(batch, F.sha2(row_set_text(), 256).alias("id_digest"))


def run_id_digest(ledger: DataFrame, batch: str) -> DataFrame:
    """The digest of all batch digests, each under its batch."""
    per_batch = batch_id_digests(ledger, batch)
    text = F.concat_ws("|", F.col(batch).cast("string"), F.col("id_digest"))
    return per_batch.agg(*row_set_sums(text)).select(
        F.sha2(row_set_text(), 256).alias("run_digest")
    )
