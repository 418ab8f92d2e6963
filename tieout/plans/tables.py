"""All tables of one data folder, each built from the ones before it. All are lazy but for
``stored_result``, ``verdicts``, ``selection`` and what rests on them, which are written when they are first
used."""

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tieout.operators import audit as au
from tieout.operators import batches as ba
from tieout.operators import cases as ca
from tieout.operators import diagnosis as di
from tieout.operators import grading as gr
from tieout.operators import reconcile as re
from tieout.operators import selection as se
from tieout.plans.run import Inputs, Settings, audit_of
from tieout.session import scratch_path
from tieout.sources import derived as de
from tieout.sources.sinks import stored
from tieout.sources.tables import scan_parquet

RUN_ID = "run-0001"
RUN_STARTED_AT = "2026-01-05 00:00:00"


class Tables:
    """The reconciliation tables that derive from ``orders.parquet`` in ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    @cached_property
    def keyed_ledger(self) -> DataFrame:
        """The ledger with its internal label and batch number."""
        return de.derive_ledger(scan_parquet(self.spark, self.folder, "orders"))

    @cached_property
    def ledger(self) -> DataFrame:
        return de.drop_internal(self.keyed_ledger)

    @cached_property
    def keyed_lines(self) -> DataFrame:
        return de.derive_lines(self.keyed_ledger)

    @cached_property
    def lines(self) -> DataFrame:
        return de.drop_internal(self.keyed_lines)

    @cached_property
    def bank_feed(self) -> DataFrame:
        return de.derive_bank_feed(self.keyed_ledger, self.keyed_lines)

    @cached_property
    def truth(self) -> DataFrame:
        return de.derive_truth(self.keyed_ledger, self.lines)

    @cached_property
    def responses(self) -> DataFrame:
        return de.derive_responses(self.keyed_ledger)

    @cached_property
    def classified(self) -> DataFrame:
        return re.classified_orders(self.ledger, self.lines)

    @cached_property
    def result(self) -> DataFrame:
        return re.reconciliation_result(self.classified)

    @cached_property
    def checked(self) -> DataFrame:
        return ba.batch_check(self.bank_feed, self.lines)

    @cached_property
    def graded(self) -> DataFrame:
        return gr.join_truth(self.result, self.truth)

    @cached_property
    def selection(self) -> DataFrame:
        """The chosen orders as a written table, which cases read several times."""
        return stored(se.select_for_diagnosis(self.stored_result), scratch_path(self.spark, "selection"))

    @cached_property
    def resolved(self) -> DataFrame:
        return di.resolve_attempts(di.parse_diagnosis(self.responses))

    @cached_property
    def headers(self) -> DataFrame:
        """Case headers of the selected orders."""
        return ca.case_headers(self.selection, self.ledger, self.lines, self.bank_feed)

    @cached_property
    def cases(self) -> DataFrame:
        return ca.assemble_cases(self.selection, self.ledger, self.lines, self.bank_feed)

    @cached_property
    def stored_result(self) -> DataFrame:
        """The result as a written table, which the audit reads several times."""
        return stored(self.result, scratch_path(self.spark, "result"))

    @cached_property
    def verdicts(self) -> DataFrame:
        """Ids and categories of the result as a written table, for choices that read them
        several times and need no more."""
        return stored(self.result.select("order_id", "category"), scratch_path(self.spark, "verdicts"))

    @cached_property
    def totals(self) -> DataFrame:
        return ba.batch_totals(self.lines)

    @cached_property
    def audit(self) -> DataFrame:
        inputs = Inputs(self.ledger, self.lines, self.bank_feed, self.responses)
        return audit_of(self.stored_result, inputs, Settings(RUN_ID, RUN_STARTED_AT), self.totals)

    @cached_property
    def flat_audit(self) -> DataFrame:
        return au.flatten_audit(self.audit)

    @cached_property
    def looked_up(self) -> DataFrame:
        return gr.truth_lookup(self.audit, self.truth)
