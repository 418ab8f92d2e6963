"""A whole run: reconcile, cross-check, second opinions, audit, summary, grading.

The result and the audit log are written once and read back, so everything after them reads
stored columns instead of computing the joins again, and a lost executor costs only the
stage it was in. A run's outputs are published together.
"""

import uuid
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tieout.fixed_values import CONTROL_SAMPLE_SEED, CONTROL_SAMPLE_SIZE, NOT_SELECTED, TOLERANCE
from tieout.operators.audit import audit_assembly, flatten_audit, nest_audit
from tieout.operators.batches import batch_check, batch_totals
from tieout.operators.cases import case_headers
from tieout.operators.diagnosis import parse_diagnosis, resolve_attempts
from tieout.operators.grading import agent_misses, grading_report, truth_lookup
from tieout.operators.reconcile import reconcile
from tieout.operators.selection import chosen_ids, mark_selection
from tieout.operators.summary import run_summary
from tieout.session import scratch_path
from tieout.sources import sinks
from tieout.sources.runs import CatalogRuns, RunStore
from tieout.sources.sinks import stored
from tieout.sources.tables import scan_table


@dataclass(frozen=True)
class Inputs:
    """The tables of a run. ``responses`` is None when the advisory stage is off."""

    ledger: DataFrame
    lines: DataFrame
    bank_feed: DataFrame
    responses: DataFrame | None = None


@dataclass(frozen=True)
class Settings:
    run_id: str
    run_started_at: str
    tolerance: Decimal | str = TOLERANCE
    strict: bool = False
    repeated_orders: bool = False
    max_attempts: int | None = None
    controls: int = CONTROL_SAMPLE_SIZE
    seed: int = CONTROL_SAMPLE_SEED
    cap: int | None = None
    temperature: float | None = None
    data_source: str | None = None


def opinions_on(
    selected: DataFrame,
    inputs: Inputs,
    totals: DataFrame | None = None,
    max_attempts: int | None = None,
) -> DataFrame:
    """Resolved replies on selected orders with the fingerprint of each case, one row per order.

    Replies on other orders are left out before they are parsed. An order id that stands on
    several ledger rows has several cases; its fingerprint is the least of theirs.
    """
    ids = selected.select("order_id").distinct()
    asked = inputs.responses.join(ids, "order_id", "left_semi")
    resolved = resolve_attempts(parse_diagnosis(asked), max_attempts)
    headers = case_headers(ids, inputs.ledger, inputs.lines, inputs.bank_feed, totals=totals)
    prints = headers.groupBy("order_id").agg(F.min("case_fingerprint").alias("case_fingerprint"))
    return resolved.join(prints, "order_id", "left")


def audit_of(
    result: DataFrame, inputs: Inputs, settings: Settings, totals: DataFrame | None = None
) -> DataFrame:
    """The nested audit records of a stored result, one for each of its rows.

    ``totals`` are the stored batch totals of the lines, if there are any.
    """
    # the choice is made once and written, since four parts of the plan read it
    place = scratch_path(result.sparkSession, "chosen")
    drawn, kept = chosen_ids(result, settings.controls, settings.seed, settings.cap)
    drawn = stored(drawn, f"{place}/controls")
    kept = stored(kept, f"{place}/flagged") if kept is not None else None
    marked = mark_selection(result, chosen=(drawn, kept))
    opinions = None
    if inputs.responses is not None:
        selected = marked.filter(F.col("selection_reason") != NOT_SELECTED)
        opinions = opinions_on(selected, inputs, totals, settings.max_attempts)
    return audit_assembly(
        marked, opinions, settings.run_id, settings.run_started_at, settings.repeated_orders
    )


def run_reconciliation(
    inputs: Inputs, settings: Settings, out: str, truth: DataFrame | None = None
) -> dict[str, str]:
    """Run everything over files and return where each output is.

    Tables: ``batch_totals``, ``reconciliation_result``, ``batch_check``, ``audit_log`` (its
    folder holds all runs, the others' this run's). Files: audit documents, audit CSV, run
    summary and, given an answer key, the grading document and its misses, apart from the audit.

    All of it is published at the end at once: ``RunStore(spark, out)`` reads the tables of
    published runs only, and a rerun replaces the run it repeats.
    """
    spark = inputs.ledger.sparkSession
    attempt = RunStore(spark, out).begin(settings.run_id)
    names = (
        "reconciliation_result", "batch_totals", "batch_check", "audit_jsonl", "audit_csv", "run_summary",
        *(("grading", "misses") if truth is not None else ()),
    )
    paths = {name: attempt.path(name) for name in names} | {"audit_log": f"{out.rstrip('/')}/audit_log"}
    verdicts = reconcile(
        inputs.ledger,
        inputs.lines,
        settings.tolerance,
        settings.strict,
        settings.repeated_orders,
    )
    result = attempt.write(verdicts, "reconciliation_result")
    totals = attempt.write(batch_totals(inputs.lines), "batch_totals")
    checked = attempt.write(
        batch_check(inputs.bank_feed, inputs.lines, settings.tolerance, totals), "batch_check"
    )
    audit = attempt.write(flatten_audit(audit_of(result, inputs, settings, totals)), "audit_log")

    def document(df: DataFrame, name: str) -> None:
        sinks.sink_document(df, paths[name], mode="overwrite")
        attempt.add(name, "json", df.schema)

    nested = nest_audit(audit)
    sinks.sink_audit_jsonl(nested, paths["audit_jsonl"])
    attempt.add("audit_jsonl", "json", nested.schema)
    sinks.sink_audit_csv(nested, paths["audit_csv"])
    summary = run_summary(
        audit,
        checked,
        data_source=settings.data_source,
        temperature=settings.temperature,
    )
    document(summary, "run_summary")
    if truth is not None:
        looked_up = truth_lookup(audit, truth)
        document(grading_report(looked_up), "grading")
        misses = agent_misses(looked_up)
        misses.write.mode("overwrite").json(paths["misses"])
        attempt.add("misses", "json", misses.schema)
    attempt.commit()
    return paths


def run_on_tables(
    spark: SparkSession, names: dict[str, str], settings: Settings, schema_name: str
) -> dict[str, str]:
    """Run over catalog tables and leave catalog views; returns the names of these.

    ``names`` gives the tables of ``ledger``, ``lines``, ``bank_feed`` and, where there are
    replies, ``responses``. The views show published runs only: ``audit_log`` and
    ``run_summaries`` all of them, a rerun in place of the run it repeats, the others the run
    published last.
    """
    inputs = Inputs(**{part: scan_table(spark, name) for part, name in names.items()})
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema_name}")
    runs, run, attempt = CatalogRuns(spark, schema_name), settings.run_id, uuid.uuid4().hex
    verdicts = reconcile(
        inputs.ledger,
        inputs.lines,
        settings.tolerance,
        settings.strict,
        settings.repeated_orders,
    )

    def written(df: DataFrame, table: str) -> DataFrame:
        return runs.write(df, table, run, attempt)

    result = written(verdicts, "reconciliation_result")
    totals = written(batch_totals(inputs.lines), "batch_totals")
    checked = written(
        batch_check(inputs.bank_feed, inputs.lines, settings.tolerance, totals), "batch_check"
    )
    audit = written(flatten_audit(audit_of(result, inputs, settings, totals)), "audit_log")
    summary = run_summary(
        audit,
        checked,
        data_source=settings.data_source,
        temperature=settings.temperature,
    )
    written(summary, "run_summary")
    # views are made before the commit, so that what becomes visible does so with it
    last = ("reconciliation_result", "batch_totals", "batch_check")
    views = {t: runs.show(t, t, last_only=True, with_run=False) for t in last}
    views["run_summary"] = runs.show("run_summary", "run_summary", last_only=True)
    views["run_summaries"] = runs.show("run_summaries", "run_summary")
    views["audit_log"] = runs.show("audit_log", "audit_log")
    runs.commit(run, attempt)
    return views
