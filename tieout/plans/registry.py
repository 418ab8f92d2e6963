"""Named queries. Each takes a session and a data folder and returns a DataFrame.

Queries about files and tables, and those on the audit, write under the shared folder while
they are built and return what reads back; the others start no job before they are read.
"""

from collections.abc import Callable
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tieout import schemas
from tieout.fixed_values import (
    AGREEMENTS,
    AUDIT_CSV_COLUMNS,
    CATEGORIES,
    CLEAN,
    DUPLICATE,
    MISSING,
    RATE_MISMATCH,
    REVIEW_STATUSES,
    TIERS,
    TIMING_LAG,
    UNEXPLAINED,
)
from tieout.functions import display
from tieout.functions import money as mo
from tieout.functions import text as tx
from tieout.operators import audit as au
from tieout.operators import batches as ba
from tieout.operators import cases as ca
from tieout.operators import diagnosis as di
from tieout.operators import grading as gr
from tieout.operators import lines as li
from tieout.operators import quality as qu
from tieout.operators import reconcile as re
from tieout.operators import review as rv
from tieout.operators import selection as se
from tieout.operators import sequence as sq
from tieout.operators import strict as st
from tieout.operators import summary as su
from tieout.plans.run import Inputs, Settings, audit_of
from tieout.plans.tables import RUN_ID, RUN_STARTED_AT, Tables
from tieout.session import scratch_path
from tieout.sources import derived as de
from tieout.sources import sinks, tables
from tieout.sources.runs import CatalogRuns, RunStore

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register a builder over :class:`Tables` under its own name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(Tables(spark, folder))

    run.__name__ = build.__name__
    QUERIES[build.__name__] = run
    return build


# --- sources ------------------------------------------------------------------
def _keyed(schema: T.StructType) -> T.StructType:
    """The schema with the order key as the number it is in the derived tables."""
    fields = [
        T.StructField(f.name, T.LongType() if f.name == "order_id" else f.dataType, f.nullable)
        for f in schema.fields
    ]
    return T.StructType(fields)


def _as_table(df: DataFrame, name: str) -> str:
    """The frame as a catalog table in a schema of its own under the shared folder."""
    place = scratch_path(df.sparkSession, "schema")
    return sinks.sink_table(df, "tieout_" + place.rsplit("-", 1)[1], name, place)


@query
def scan_table(t: Tables) -> DataFrame:
    return tables.scan_table(t.spark, _as_table(tables.scan_parquet(t.spark, t.folder, "orders"), "orders"))


@query
def scan_csv_typed(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "ledger-csv")
    sinks.sink_table_csv(t.ledger, path)
    return tables.scan_csv_typed(t.spark, path, _keyed(schemas.LEDGER))


@query
def scan_csv_strings(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "ledger-csv")
    sinks.sink_table_csv(t.ledger, path)
    return tables.scan_csv_strings(t.spark, path, t.ledger.columns)


def _audit_documents(t: Tables) -> str:
    path = scratch_path(t.spark, "audit-json")
    sinks.sink_audit_jsonl(t.audit, path)
    return path


@query
def scan_audit_jsonl(t: Tables) -> DataFrame:
    return tables.scan_audit_jsonl(t.spark, _audit_documents(t), T.LongType())


def _summary_columns(summary: DataFrame) -> DataFrame:
    """The counter maps as columns, and what does not depend on the clock."""

    def counters(column: str, prefix: str, codes: tuple) -> list:
        return [
            F.coalesce(F.try_element_at(column, F.lit(c)), F.lit(0).cast("bigint")).alias(
                f"{prefix}_{c}"
            )
            for c in codes
        ]

    clock = ("run_completed_at", "duration_seconds", "data_source", "action_note")
    maps = ("tier_counts", "category_counts", "agreement_on_flagged")
    plain = [c for c in summary.columns if c not in (*clock, *maps)]
    return summary.select(
        *plain,
        *counters("tier_counts", "tier", TIERS),
        *counters("category_counts", "category", CATEGORIES),
        *counters("agreement_on_flagged", "agreement", AGREEMENTS),
    )


@query
def scan_run_summaries(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "summaries")
    sinks.sink_document(su.run_summary(t.audit, t.checked, temperature=0.0), path)
    return _summary_columns(tables.scan_run_summaries(t.spark, path))


@query
def query_audit_sql(t: Tables) -> DataFrame:
    return tables.query_audit_sql(t.spark, _as_table(t.flat_audit, "audit_log"))


# --- sinks, read back ---------------------------------------------------------
@query
def sink_table(t: Tables) -> DataFrame:
    return tables.scan_table(t.spark, _as_table(t.result, "reconciliation_result"))


@query
def sink_audit_table(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "audit-log")
    sinks.sink_audit_table(t.flat_audit, path)
    back = t.spark.read.schema(t.flat_audit.schema).parquet(path)
    return back.select(*t.flat_audit.columns)


def _runs_with_changes(t: Tables) -> list[tuple[str, DataFrame]]:
    """The result as three runs would leave it: without a column, whole, and with one column
    more and a wider one."""
    result = t.stored_result
    return [
        ("run-0001", result.drop("reasoning").withColumn("settlement_row_count", F.col("settlement_row_count").cast("int"))),
        ("run-0002", result),
        ("run-0003", result.withColumns({
            "order_amount": F.col("order_amount").cast("decimal(24,4)"),
            "reviewed": F.col("order_id") % 2 == 0,
        })),
    ]


_RUN_COLUMNS = ("run_id", "order_id", "order_amount", "settlement_row_count", "reasoning", "reviewed")


@query
def published_runs(t: Tables) -> DataFrame:
    """Runs whose schema changes, one that was repeated, and one that never came to an end."""
    store = RunStore(t.spark, scratch_path(t.spark, "runs"))
    for run, df in _runs_with_changes(t):
        if run == "run-0002":  # an earlier attempt, which the later one replaces
            earlier = store.begin(run)
            earlier.write(df.where("order_id % 3 = 0"), "result")
            earlier.commit()
        attempt = store.begin(run)
        attempt.write(df, "result")
        attempt.commit()
    store.begin("run-0004").write(t.stored_result, "result")
    return store.read("result").select(*_RUN_COLUMNS)


@query
def published_catalog_runs(t: Tables) -> DataFrame:
    """The same runs in the catalog, as the view over them shows them."""
    place = scratch_path(t.spark, "schema")
    schema = "tieout_" + place.rsplit("-", 1)[1]
    t.spark.sql(f"CREATE SCHEMA {schema} LOCATION '{place}'")
    runs = CatalogRuns(t.spark, schema)
    for run, df in _runs_with_changes(t):
        if run == "run-0002":
            runs.write(df.where("order_id % 3 = 0"), "result", run, "first")
            runs.commit(run, "first")
        runs.write(df, "result", run, "second")
        runs.commit(run, "second")
    runs.write(t.stored_result, "result", "run-0004", "first")
    return t.spark.table(runs.show("result_of_all", "result")).select(*_RUN_COLUMNS)


@query
def sink_audit_jsonl(t: Tables) -> DataFrame:
    documents = t.spark.read.schema(schemas.audit_schema(T.LongType())).json(_audit_documents(t))
    return au.flatten_audit(documents)


@query
def sink_audit_csv(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "audit-csv")
    sinks.sink_audit_csv(t.audit, path)
    kinds = schemas.audit_schema(T.LongType())
    picked = T.StructType([kinds[c] for c in AUDIT_CSV_COLUMNS])
    return tables.scan_csv_typed(t.spark, path, picked)


@query
def sink_table_csv(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "lines-csv")
    sinks.sink_table_csv(t.lines, path)
    return tables.scan_csv_typed(t.spark, path, _keyed(schemas.LINES))


@query
def bank_feed_csv(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "bank-csv")
    sinks.sink_table_csv(t.bank_feed, path)
    return tables.scan_csv_typed(t.spark, path, t.bank_feed.schema)


@query
def truth_csv(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "truth-csv")
    sinks.sink_table_csv(t.truth, path)
    return tables.scan_csv_typed(t.spark, path, t.truth.schema)


@query
def sink_run_summary(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "summary")
    sinks.sink_document(su.run_summary(t.audit, t.checked, temperature=0.0), path)
    return _summary_columns(tables.scan_run_summaries(t.spark, path))


def _grading_columns(report: DataFrame) -> DataFrame:
    return report.select(
        "run_id",
        "total_orders",
        "engine_correct",
        "engine_accuracy",
        "agent_graded_orders",
        "agent_correct",
        "agent_accuracy",
        F.size("engine_confusion").cast("bigint").alias("engine_labels"),
        F.size("agent_confusion").cast("bigint").alias("agent_labels"),
    )


@query
def sink_grading(t: Tables) -> DataFrame:
    report = gr.grading_report(t.looked_up)
    path = scratch_path(t.spark, "grading")
    sinks.sink_document(report, path)
    return _grading_columns(t.spark.read.schema(report.schema).json(path))


def _slice(t: Tables) -> DataFrame:
    return rv.audit_slice(
        t.flat_audit,
        categories=[CLEAN, RATE_MISMATCH, MISSING],
        tiers=list(TIERS),
        statuses=list(REVIEW_STATUSES),
        min_amount=Decimal("250000"),
    )


@query
def export_slice_csv(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "slice-csv")
    sinks.export_slice_csv(_slice(t), path)
    return tables.scan_csv_typed(t.spark, path, rv.export_slice(t.flat_audit).schema)


# --- projections, filters, predicates -----------------------------------------
@query
def expected_settlement(t: Tables) -> DataFrame:
    return re.expected_settlement(t.ledger)


@query
def breaks_tolerance(t: Tables) -> DataFrame:
    return t.classified.select(
        "order_id",
        mo.breaks_tolerance("mdr_fee", "expected_mdr_fee").alias("fee_breaks"),
        mo.breaks_tolerance("refund_adjustment", "expected_refund_adjustment").alias(
            "refund_breaks"
        ),
        mo.breaks_tolerance("net_amount", "expected_net_amount", "100.00").alias(
            "net_breaks_wide"
        ),
    )


@query
def identity_check(t: Tables) -> DataFrame:
    return t.classified.select(
        "order_id", "mdr_fee", "gst_on_charged_fee", "net_amount", "identity_net_amount"
    )


@query
def classify_orders(t: Tables) -> DataFrame:
    return t.classified.select("order_id", "settlement_row_count", "category")


@query
def classify_orders_strict(t: Tables) -> DataFrame:
    """Some lines lack a figure here; only strict mode minds."""
    strict = re.classified_orders(t.ledger, de.with_gaps(t.lines), strict=True)
    return strict.select("order_id", "category")


@query
def classify_orders_gaps(t: Tables) -> DataFrame:
    lenient = re.classified_orders(t.ledger, de.with_gaps(t.lines))
    return lenient.select("order_id", "category")


@query
def match_tier(t: Tables) -> DataFrame:
    return t.result.select("order_id", "category", "match_tier")


@query
def engine_reasoning(t: Tables) -> DataFrame:
    return t.result.select("order_id", "category", "reasoning")


@query
def reconciliation_result(t: Tables) -> DataFrame:
    return t.result


@query
def flag_split(t: Tables) -> DataFrame:
    columns = ("order_id", "category")
    held = se.flagged(t.result).select(*columns, F.lit(True).alias("is_flagged"))
    return held.unionByName(se.clean(t.result).select(*columns, F.lit(False).alias("is_flagged")))


@query
def exceptions_only(t: Tables) -> DataFrame:
    return t.truth.filter(F.col("exception_type") != CLEAN)


@query
def review_queue(t: Tables) -> DataFrame:
    return rv.review_queue(t.audit)


@query
def audit_slice(t: Tables) -> DataFrame:
    return rv.export_slice(_slice(t))


@query
def coerce_types(t: Tables) -> DataFrame:
    k = F.col("order_id")
    answer = F.element_at(
        F.array(*[F.lit(v) for v in ("True", "1", "no", None, "FALSE")]), (k % 5 + 1).cast("int")
    )
    amount = F.when(k % 10 == 3, F.lit("n/a")).otherwise(F.col("order_amount").cast("string"))
    texts = t.ledger.select(
        "order_id", amount.alias("evidence_order_amount"), answer.alias("agent_invoked")
    )
    kinds = T.StructType(
        [
            T.StructField("evidence_order_amount", schemas.MONEY),
            T.StructField("agent_invoked", T.BooleanType()),
        ]
    )
    return tables.coerce_to(texts, kinds)


@query
def stringify(t: Tables) -> DataFrame:
    return t.ledger.select([tx.as_text(c).alias(c) for c in t.ledger.columns])


@query
def drop_internal(t: Tables) -> DataFrame:
    return de.drop_internal(t.keyed_ledger)


@query
def flatten_audit(t: Tables) -> DataFrame:
    return au.flatten_audit(t.audit)


@query
def evidence_struct(t: Tables) -> DataFrame:
    nested = t.result.select("order_id", au.evidence_struct().alias("evidence"))
    return nested.select("order_id", "evidence.*")


@query
def governance_columns(t: Tables) -> DataFrame:
    return t.ledger.select("order_id").withColumns(au.governance_columns())


@query
def explode_evidence(t: Tables) -> DataFrame:
    return rv.explode_evidence(t.flat_audit)


@query
def batch_balanced(t: Tables) -> DataFrame:
    return t.checked.select("settlement_batch_id", "batch_diff", "batch_balanced")


# --- joins --------------------------------------------------------------------
@query
def join_expected_lines(t: Tables) -> DataFrame:
    return re.join_expected_lines(re.expected_settlement(t.ledger), li.lines_per_order(t.lines))


@query
def orphan_lines(t: Tables) -> DataFrame:
    return li.orphan_lines(t.lines, t.ledger)


@query
def join_bank_batches(t: Tables) -> DataFrame:
    return t.checked


@query
def batch_check_strict(t: Tables) -> DataFrame:
    return ba.batch_check_strict(t.bank_feed, t.lines)


@query
def join_truth(t: Tables) -> DataFrame:
    return t.graded


@query
def assemble_cases(t: Tables) -> DataFrame:
    listed = F.array_join(F.transform("settlement_lines", ca.line_text), "\n")
    return t.cases.select(
        *ca.CASE_FIELDS,
        "settlement_batch_id",
        "settlement_row_count",
        "case_fingerprint",
        F.size("settlement_lines").alias("n_listed"),
        listed.alias("listed"),
    )


@query
def audit_assembly(t: Tables) -> DataFrame:
    return t.flat_audit


@query
def repeated_orders_audit(t: Tables) -> DataFrame:
    """One audit row per ledger row, also where an order id stands on several."""
    inputs = Inputs(de.with_repeats(t.ledger), t.lines, t.bank_feed, t.responses)
    settings = Settings(RUN_ID, RUN_STARTED_AT, repeated_orders=True)
    verdicts = re.reconcile(inputs.ledger, inputs.lines, repeated_orders=True)
    result = sinks.stored(verdicts, scratch_path(t.spark, "result"))
    return au.flatten_audit(audit_of(result, inputs, settings)).select(
        "order_id",
        "engine_category",
        "agent_selection_reason",
        "agent_invoked",
        "agent_cause",
        "agent_case_fingerprint",
    )


@query
def truth_lookup(t: Tables) -> DataFrame:
    return t.looked_up.select("order_id", "engine_category", "agent_cause", "ground_truth")


@query
def batch_orders_lines(t: Tables) -> DataFrame:
    met = ba.batch_orders_lines(t.keyed_ledger, t.keyed_lines, "_batch_no")
    code = tx.batch_code(F.col("_batch_no")).alias("settlement_batch_id")
    return met.select(code, "n_orders", "order_total", "n_lines", "net_total")


# --- aggregations -------------------------------------------------------------
@query
def lines_per_order(t: Tables) -> DataFrame:
    return li.lines_per_order(t.lines)


@query
def batch_net(t: Tables) -> DataFrame:
    return ba.batch_net(t.lines)


@query
def batch_check_rollup(t: Tables) -> DataFrame:
    return ba.batch_check_rollup(t.checked)


@query
def unbalanced_batches(t: Tables) -> DataFrame:
    return ba.unbalanced_batches(t.checked)


@query
def tier_counts(t: Tables) -> DataFrame:
    return su.tier_counts(t.result)


@query
def category_counts(t: Tables) -> DataFrame:
    return su.category_counts(t.result)


@query
def outcome_counts(t: Tables) -> DataFrame:
    return su.outcome_counts(t.result)


@query
def match_rates(t: Tables) -> DataFrame:
    return su.match_rates(t.result)


@query
def confusion_matrix(t: Tables) -> DataFrame:
    return gr.confusion_matrix(t.graded, "true_category", "category")


@query
def engine_accuracy(t: Tables) -> DataFrame:
    return gr.engine_accuracy(t.graded)


@query
def engine_mismatches(t: Tables) -> DataFrame:
    """Some verdicts are made wrong first."""
    wrong = F.when(F.col("order_id") % 211 == 3, F.lit(MISSING)).otherwise(F.col("category"))
    return gr.engine_mismatches(t.graded.withColumn("category", wrong))


@query
def agent_accuracy(t: Tables) -> DataFrame:
    return gr.agent_accuracy(t.looked_up)


@query
def agent_confusion(t: Tables) -> DataFrame:
    return gr.agent_confusion(t.looked_up)


@query
def agent_misses(t: Tables) -> DataFrame:
    return gr.agent_misses(t.looked_up)


@query
def run_summary(t: Tables) -> DataFrame:
    return _summary_columns(su.run_summary(t.audit, t.checked, temperature=0.0))


@query
def grading_report(t: Tables) -> DataFrame:
    return _grading_columns(gr.grading_report(t.looked_up))


@query
def agreement_on_flagged(t: Tables) -> DataFrame:
    return su.agreement_on_flagged(t.audit)


@query
def mean_confidence(t: Tables) -> DataFrame:
    return su.mean_confidence(t.audit)


@query
def kpi_tiles(t: Tables) -> DataFrame:
    return rv.kpi_tiles(t.flat_audit)


@query
def value_split(t: Tables) -> DataFrame:
    return rv.value_split(t.flat_audit)


@query
def exceptions_by_category(t: Tables) -> DataFrame:
    return rv.exceptions_by_category(t.flat_audit)


@query
def facets(t: Tables) -> DataFrame:
    return rv.facets(t.flat_audit)


@query
def provenance(t: Tables) -> DataFrame:
    return rv.provenance(t.audit)


@query
def label_counts(t: Tables) -> DataFrame:
    return su.label_counts(t.truth)


@query
def bank_netting(t: Tables) -> DataFrame:
    netted = ba.bank_netting(t.keyed_ledger, t.keyed_lines, "_batch_no")
    code = tx.batch_code(F.col("_batch_no")).alias("settlement_batch_id")
    return netted.select(code, "net_total", "credit_date", "utr_number")


@query
def latency_total(t: Tables) -> DataFrame:
    return su.latency_total(t.audit)


# --- sorts, top-n, sampling ---------------------------------------------------
@query
def result_preview(t: Tables) -> DataFrame:
    return re.result_preview(t.result)


@query
def audit_order(t: Tables) -> DataFrame:
    return au.audit_order(t.audit).select("order_id", "engine_match_tier")


@query
def queue_by_value(t: Tables) -> DataFrame:
    queue = rv.queue_by_value(t.flat_audit)
    return queue.select("order_id", "engine_category", "evidence_order_amount")


@query
def cap_flagged(t: Tables) -> DataFrame:
    return se.cap_flagged(se.flagged(t.result), 50).select("order_id", "category")


@query
def cap_flagged_text_ids(t: Tables) -> DataFrame:
    """Ids of one common prefix, as text."""
    rows = se.flagged(t.stored_result).withColumn("order_id", F.format_string("ORD-%012d", "order_id"))
    return se.cap_flagged(rows, 700).select("order_id", "category")


@query
def cap_flagged_sparse_ids(t: Tables) -> DataFrame:
    """Ids far apart, as decimals."""
    wide = (F.col("order_id").cast("decimal(20,0)") * 1000003 * 1000003).cast("decimal(38,0)")
    rows = se.flagged(t.stored_result).withColumn("order_id", wide)
    return se.cap_flagged(rows, 700).select("order_id", "category")


@query
def control_sample(t: Tables) -> DataFrame:
    return se.control_sample(se.clean(t.verdicts), 5)


@query
def control_sample_large(t: Tables) -> DataFrame:
    return se.control_sample(se.clean(t.verdicts), 12_000)


def _first_labels(t: Tables, n: int) -> DataFrame:
    first = se.first_per_group(t.truth, "exception_type", n)
    return first.select("order_id", "exception_type", "expected_reasoning")


@query
def samples_per_label(t: Tables) -> DataFrame:
    return _first_labels(t, 2)


@query
def one_per_category(t: Tables) -> DataFrame:
    return _first_labels(t, 1)


# --- set operations -----------------------------------------------------------
@query
def selection_union(t: Tables) -> DataFrame:
    clean_ids = se.control_sample(se.clean(t.result), 5)
    return se.selection_union(se.flagged(t.result), clean_ids)


@query
def duplicate_append(t: Tables) -> DataFrame:
    return de.drop_internal(de.append_duplicates(de.derive_own_lines(t.keyed_ledger)))


@query
def distinct_batches(t: Tables) -> DataFrame:
    return ba.distinct_batches(t.lines)


# --- scalar functions ---------------------------------------------------------
@query
def money_math(t: Tables) -> DataFrame:
    amount = F.col("order_amount")
    refund = F.coalesce("refund_amount", F.lit(Decimal("0.00")))
    return t.ledger.select(
        "order_id",
        mo.money(amount + refund).alias("added"),
        mo.money(amount - refund).alias("taken"),
        mo.percentage_of("order_amount", "expected_mdr_rate").alias("fee"),
        mo.money(F.abs(refund - amount)).alias("gap"),
    )


@query
def cites_figures(t: Tables) -> DataFrame:
    parsed = di.parse_diagnosis(t.responses)
    return parsed.select("order_id", "attempt", tx.cites_figures("explanation").alias("cites"))


@query
def normalize_confidence(t: Tables) -> DataFrame:
    raw = (F.col("order_id") % 301 - 50).cast("double") / 2
    return t.ledger.select("order_id", di.normalize_confidence(raw).alias("confidence"))


@query
def case_fingerprint(t: Tables) -> DataFrame:
    return t.headers.select("order_id", "case_fingerprint")


@query
def id_sequence_digest(t: Tables) -> DataFrame:
    digests = ca.batch_id_digests(t.keyed_ledger, "_batch_no")
    code = tx.batch_code(F.col("_batch_no")).alias("settlement_batch_id")
    return digests.select(code, "id_digest")


@query
def run_id_digest(t: Tables) -> DataFrame:
    coded = t.keyed_ledger.withColumn("settlement_batch_id", tx.batch_code(F.col("_batch_no")))
    return ca.run_id_digest(coded, "settlement_batch_id")


@query
def extract_content(t: Tables) -> DataFrame:
    message = tx.message_text(F.col("content")).alias("message")
    return t.responses.select("order_id", "attempt", message)


@query
def render_case(t: Tables) -> DataFrame:
    return ca.render_case(t.cases)


def _signed_refund(t: Tables) -> DataFrame:
    """Refunds scaled over all display ranges, a third of them negative, most absent."""
    k = F.col("order_id")
    factor = F.when(k % 3 == 0, F.lit(-1).cast("bigint")).otherwise(k)
    return t.ledger.select("order_id", mo.money(F.col("refund_amount") * factor).alias("v"))


@query
def inr_format(t: Tables) -> DataFrame:
    return _signed_refund(t).select(
        "order_id",
        display.inr("v").alias("amount_text"),
        display.inr("v", decimals=0).alias("whole_text"),
    )


@query
def inr_compact(t: Tables) -> DataFrame:
    return _signed_refund(t).select("order_id", display.inr_compact("v").alias("amount_text"))


@query
def category_label(t: Tables) -> DataFrame:
    return t.result.select("order_id", "category", display.category_label("category").alias("label"))


@query
def batch_codes(t: Tables) -> DataFrame:
    orders = tables.scan_parquet(t.spark, t.folder, "orders")
    number = F.expr(f"o_orderkey div {de.BATCH_SIZE}")
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        tx.batch_code(number).alias("batch_code"),
        tx.utr_code(number).alias("utr_code"),
        tx.customer_code(F.col("o_custkey")).alias("customer_code"),
    )


@query
def date_lag(t: Tables) -> DataFrame:
    lag = (F.col("order_id") % 3 + 1).cast("int")
    return t.ledger.select(
        "order_id",
        "order_date",
        F.date_add("order_date", 2).alias("plus_two"),
        F.date_add("order_date", lag).alias("plus_key"),
    )


@query
def short_id(t: Tables) -> DataFrame:
    return t.lines.select("order_id", tx.short_id("transaction_id").alias("short_id"))


@query
def truth_reasoning(t: Tables) -> DataFrame:
    return t.truth.select("order_id", "expected_reasoning")


# --- derived tables -----------------------------------------------------------
@query
def derive_ledger(t: Tables) -> DataFrame:
    return t.ledger


@query
def assign_labels(t: Tables) -> DataFrame:
    return t.keyed_ledger.select("order_id", F.col("_label").alias("label"))


@query
def force_refund(t: Tables) -> DataFrame:
    lagging = t.keyed_ledger.filter(F.col("_label") == TIMING_LAG)
    return lagging.select("order_id", "refund_amount", "refund_date")


@query
def derive_lines(t: Tables) -> DataFrame:
    return t.lines


@query
def derive_bank_feed(t: Tables) -> DataFrame:
    return t.bank_feed


@query
def derive_truth(t: Tables) -> DataFrame:
    return t.truth


# --- checks -------------------------------------------------------------------
@query
def check_counts(t: Tables) -> DataFrame:
    return qu.check_counts(t.ledger, t.lines, t.truth)


@query
def check_repeated_counts(t: Tables) -> DataFrame:
    """On a ledger with repeated order ids."""
    return qu.check_counts(de.with_repeats(t.ledger), t.lines, t.truth)


@query
def check_requested_labels(t: Tables) -> DataFrame:
    shares = {
        CLEAN: 900, TIMING_LAG: 40, RATE_MISMATCH: 25, DUPLICATE: 15, MISSING: 15, UNEXPLAINED: 5,
    }
    orders = t.truth.agg(F.count(F.lit(1)).alias("orders"))
    rows = F.explode(
        F.map_from_arrays(
            F.array(*[F.lit(c) for c in shares]), F.array(*[F.lit(n) for n in shares.values()])
        )
    ).alias("label", "share")
    asked = orders.select("orders", rows).select(
        "label",
        F.floor(F.col("orders") * F.col("share") / 1000).alias("requested"),
        (F.col("orders") * 0.002).alias("slack"),
    )
    return qu.check_requested_labels(t.truth, asked)


@query
def check_label_shares(t: Tables) -> DataFrame:
    return qu.check_label_shares(t.truth)


@query
def check_labels(t: Tables) -> DataFrame:
    return qu.check_labels(t.ledger, t.lines, t.truth)


@query
def check_bank_sum(t: Tables) -> DataFrame:
    return qu.check_bank_sum(t.checked)


@query
def check_governance(t: Tables) -> DataFrame:
    return qu.check_governance(t.audit, t.result)


@query
def check_graded_all(t: Tables) -> DataFrame:
    return qu.check_graded_all(t.result, t.graded)


# --- checks beyond the verdict -------------------------------------------------
def _off_gross(t: Tables) -> DataFrame:
    """Lines of which some state another gross amount, or none."""
    k = F.col("order_id")
    gross = F.when(k % 90 == 4, F.col("gross_amount") + 1).when(k % 90 != 5, F.col("gross_amount"))
    return t.lines.withColumn("gross_amount", gross.cast("decimal(18,2)"))


def _off_reference(t: Tables) -> DataFrame:
    """Lines of which some carry the reference of another batch."""
    other = F.when(F.col("order_id") % 80 == 6, F.lit("UTR-ELSE")).otherwise(F.col("utr_number"))
    return t.lines.withColumn("utr_number", other)


def _off_refunds(t: Tables) -> DataFrame:
    """Orders of which some were refunded too early, without a date, or without an amount."""
    k = F.col("order_id")
    day = F.when(k % 60 == 7, F.date_sub("order_date", 3)).when(k % 60 != 8, F.col("refund_date"))
    amount = F.when(k % 60 != 9, F.col("refund_amount"))
    return t.ledger.withColumns({"refund_date": day, "refund_amount": amount})


HOLIDAYS = [date(1995, 12, 25), date(1996, 1, 1), date(1996, 12, 25), date(1997, 1, 1), date(1998, 5, 1)]


@query
def check_gross_amounts(t: Tables) -> DataFrame:
    return st.gross_breaks(t.ledger, _off_gross(t))


@query
def check_line_references(t: Tables) -> DataFrame:
    return st.reference_breaks(_off_reference(t), t.bank_feed)


@query
def check_refund_dates(t: Tables) -> DataFrame:
    return st.refund_date_breaks(_off_refunds(t))


@query
def check_settlement_lags(t: Tables) -> DataFrame:
    return st.settlement_lags(t.ledger, t.lines, t.bank_feed, 1, 400, HOLIDAYS)


@query
def check_strict(t: Tables) -> DataFrame:
    return st.check_strict(t.ledger, t.lines, t.bank_feed, 1, 400, HOLIDAYS)


@query
def id_sequence_tree(t: Tables) -> DataFrame:
    """The hash tree over order ids in the order of their dates."""
    rows = sq.numbered(t.ledger.select("order_id", "order_date"), "order_date", "order_id")
    return sq.sequence_tree(rows, fanout=64)


@query
def id_sequence_differences(t: Tables) -> DataFrame:
    """Where the sequence differs from one in which two ids changed places and one is gone."""
    place = F.col("order_id").alias("place")
    swapped = F.when(F.col("order_id") == 130, 700).when(F.col("order_id") == 700, 130).otherwise(F.col("order_id"))
    one = t.ledger.select(place, "order_id")
    two = t.ledger.where("order_id <> 900").select(place, swapped.alias("order_id"))
    return sq.differing_ranges(sq.sequence_tree(one, fanout=64), sq.sequence_tree(two, fanout=64), 64)


@query
def run_digest_as_pinned(t: Tables) -> DataFrame:
    """The run's id digest against one that was pinned when the ledger was loaded."""
    keyed = t.keyed_ledger.withColumn(ba.BATCH, F.format_string("BATCH-%06d", "_batch_no"))
    pinned = ca.run_id_digest(keyed, ba.BATCH).first()["run_digest"]
    again = ca.run_id_digest(keyed.repartition(3), ba.BATCH)
    changed = ca.run_id_digest(keyed.where("order_id <> 7"), ba.BATCH)
    return qu.check_run_digest(again, pinned).unionByName(
        qu.check_run_digest(changed, pinned).withColumn("check_name", F.lit("changed_ids_are_noticed"))
    )


# --- second opinions ----------------------------------------------------------
@query
def parse_diagnosis(t: Tables) -> DataFrame:
    return di.parse_diagnosis(t.responses)


@query
def resolve_attempts(t: Tables) -> DataFrame:
    return t.resolved


@query
def select_for_diagnosis(t: Tables) -> DataFrame:
    return se.select_for_diagnosis(t.verdicts)


@query
def agreement(t: Tables) -> DataFrame:
    return t.audit.select("order_id", "engine_agent_agreement")


@query
def skip_reason(t: Tables) -> DataFrame:
    """Why each order outside a capped selection has no second opinion."""
    marked = se.mark_selection(t.verdicts, cap=50)
    reason = au.skip_reason(
        F.col("selection_reason") != "not_selected",
        F.col("selection_reason"),
        F.col("category"),
        stage_on=True,
    )
    why = marked.select("order_id", reason.alias("agent_skip_reason"))
    return why.filter(F.col("agent_skip_reason").isNotNull())


@query
def decide_review(t: Tables) -> DataFrame:
    return t.audit.select("order_id", "review_status", "review_reason")


@query
def diagnosis_outcome(t: Tables) -> DataFrame:
    return di.diagnosis_outcome(t.selection, t.resolved)
