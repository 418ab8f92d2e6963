from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tieout import schemas
from tieout.functions.display import category_label, inr, inr_compact
from tieout.operators import audit as au
from tieout.plans.run import Inputs, Settings, run_on_tables, run_reconciliation
from tieout.session import scratch_path
from tieout.sources import sinks, tables as sources


def test_typed_csv_with_bad_and_empty_fields(spark):
    path = scratch_path(spark, "csv")
    text = [
        "utr_number,bank_credit_amount,credit_date,settlement_batch_id",
        "u1,10.50,2026-01-07,B1",
        "u2,,2026-01-07,B2",
        "u3,abc,2026-01-07,B3",
    ]
    spark.createDataFrame([(t,) for t in text], "value string").coalesce(1).write.text(path)
    df = sources.scan_csv_typed(spark, path, schemas.BANK_FEED, keep_corrupt=True)
    got = {r.utr_number: r for r in df.collect()}
    assert got["u1"].bank_credit_amount == Decimal("10.50")
    assert got["u2"].bank_credit_amount is None
    assert got["u2"]._corrupt_record is None
    assert got["u3"].bank_credit_amount is None
    assert got["u3"]._corrupt_record.startswith("u3,abc")


def test_csv_keeps_quotes_breaks_and_nulls(spark):
    rows = [("a", 'say "hi", twice'), ("b", "two\nlines"), ("c", None), ("d", "back\\slash"), ("e", "")]
    df = spark.createDataFrame(rows, "k string, v string")
    path = scratch_path(spark, "csv")
    sinks.sink_table_csv(df, path)
    back = sources.scan_csv_typed(spark, path, df.schema)
    assert sorted(back.collect()) == sorted(df.collect())
    text = sources.scan_csv_strings(spark, path, df.columns)
    assert sorted(text.collect()) == sorted(df.collect())


def test_run_on_catalog_tables(spark, tables):
    place = scratch_path(spark, "catalog")
    schema = "tieout_" + place.rsplit("-", 1)[1]
    names = {
        part: sinks.sink_table(getattr(tables, part), schema, f"in_{part}", place)
        for part in ("ledger", "lines", "bank_feed", "responses")
    }
    for run in ("run-1", "run-2", "run-2"):
        out = run_on_tables(spark, names, Settings(run, "2026-01-05 00:00:00"), schema)
    audit = sources.query_audit_sql(spark, out["audit_log"])
    orders = tables.ledger.count()
    counts = {r.run_id: r["count"] for r in audit.groupBy("run_id").count().collect()}
    assert counts == {"run-1": orders, "run-2": orders}
    assert spark.table(out["reconciliation_result"]).count() == orders
    assert spark.table(out["run_summary"]).count() == 1


def test_coercion_goes_by_schema(spark):
    df = spark.createDataFrame(
        [("1.50", "True", "TXN-9"), ("n/a", "0", "TXN-8"), (None, None, None)],
        "evidence_order_amount string, agent_invoked string, evidence_transaction_id string",
    )
    kinds = au.flatten_audit(
        spark.createDataFrame([], schemas.audit_schema())
    ).schema
    got = sources.coerce_to(df, kinds).collect()
    assert [r.evidence_order_amount for r in got] == [Decimal("1.50"), None, None]
    assert [r.agent_invoked for r in got] == [True, False, False]
    assert [r.evidence_transaction_id for r in got] == ["TXN-9", "TXN-8", None]


def test_audit_table_appends_runs_and_replaces_one(spark, tables):
    flat = tables.flat_audit.limit(20)
    path = scratch_path(spark, "audit")
    sinks.sink_audit_table(flat, path)
    sinks.sink_audit_table(flat.withColumn("run_id", F.lit("run-2")), path)
    sinks.sink_audit_table(
        flat.limit(3).withColumn("run_id", F.lit("run-2")), path, replace_run=True
    )
    counts = {r.run_id: r["count"] for r in spark.read.parquet(path).groupBy("run_id").count().collect()}
    assert counts == {"run-0001": 20, "run-2": 3}


def test_flatten_and_nest_are_inverse(tables):
    nested = tables.audit
    flat = au.flatten_audit(nested)
    assert len(flat.columns) == 37
    back = au.nest_audit(flat)
    assert back.columns == nested.columns
    assert sorted(map(str, back.collect())) == sorted(map(str, nested.collect()))


def test_whole_run(spark, tables):
    out = scratch_path(spark, "out")
    inputs = Inputs(tables.ledger, tables.lines, tables.bank_feed, tables.responses)
    for run_id in ("run-a", "run-b"):
        settings = Settings(run_id, "2026-01-05 00:00:00", temperature=0.0, data_source="test")
        paths = run_reconciliation(inputs, settings, out, tables.truth)
    audit = sources.scan_audit_jsonl(spark, paths["audit_jsonl"], T.LongType())
    assert audit.count() == 1500
    assert spark.read.parquet(paths["audit_log"]).groupBy("run_id").count().count() == 2
    summaries = sources.scan_run_summaries(spark, f"{out}/run_summary").collect()
    assert {s.run_id for s in summaries} == {"run-a", "run-b"}
    s = summaries[0]
    assert s.total_orders == 1500
    assert s.tier_counts == {"exact": 1349, "fuzzy": 106, "no_match": 45}
    assert s.flagged_orders == 151
    assert s.agent_invoked_count == 156
    assert s.autonomous_actions_taken == 0
    assert s.run_started_at.year == 2026
    grading = spark.read.json(paths["grading"]).first()
    assert (grading.engine_correct, grading.total_orders) == (1500, 1500)
    assert grading.agent_graded_orders == 154
    misses = spark.read.json(paths["misses"]).count()
    assert misses == grading.agent_graded_orders - grading.agent_correct


def test_amount_texts(spark):
    values = ["0.00", "5.50", "999.00", "1000.00", "100000.00", "1234567.89", "-1234567.89",
              "12345678901.50", None]
    df = spark.createDataFrame([(None if v is None else Decimal(v),) for v in values],
                               "v decimal(18,2)")
    assert [r[0] for r in df.select(inr("v")).collect()] == [
        "₹0.00", "₹5.50", "₹999.00", "₹1,000.00", "₹1,00,000.00", "₹12,34,567.89",
        "−₹12,34,567.89", "₹12,34,56,78,901.50", "n/a",
    ]
    assert [r[0] for r in df.select(inr_compact("v")).collect()] == [
        "₹0.00"[:2], "₹6", "₹999", "₹1,000", "₹1.00 L", "₹12.35 L", "₹-12.35 L", "₹1,234.57 Cr",
        "n/a",
    ]
    labels = spark.createDataFrame([("missing_payout",), ("new_code",)], "c string")
    assert [r[0] for r in labels.select(category_label("c")).collect()] == [
        "Missing payout", "new_code",
    ]


def test_audit_documents_are_written_compressed(spark, tables):
    path = scratch_path(spark, "documents")
    sinks.sink_audit_jsonl(tables.audit, path)
    files = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0]
    plain = spark.read.text(path).agg(F.count("*"), F.sum(F.octet_length("value"))).first()
    assert plain[0] == 1500 and files < plain[1] / 4
