"""Timings on one machine; prints one JSON line.

The tables are derived and stored first and a small warm-up run is thrown away; neither is
counted. ``reconcile`` is the whole reconciliation step: verdict of every order written as a
table, batch cross-check, counts and rates, and grading against the answer key, which must
come out at 100% for the timing to count. Each entry is the best of ``BENCH_ROUNDS`` rounds.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from tieout.operators import batches as ba  # noqa: E402
from tieout.operators import cases as ca  # noqa: E402
from tieout.operators import diagnosis as di  # noqa: E402
from tieout.operators import grading as gr  # noqa: E402
from tieout.operators import quality as qu  # noqa: E402
from tieout.operators import reconcile as re  # noqa: E402
from tieout.operators import review as rv  # noqa: E402
from tieout.operators import selection as se  # noqa: E402
from tieout.operators import summary as su  # noqa: E402
from tieout.operators.audit import flatten_audit  # noqa: E402
from tieout.plans.run import Inputs, Settings, audit_of  # noqa: E402
from tieout.plans.tables import RUN_ID, RUN_STARTED_AT, Tables  # noqa: E402
from tieout.session import local_session, scratch_path  # noqa: E402
from tieout.sources.sinks import stored  # noqa: E402


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def staged(spark, folder, files):
    """The input tables as stored files, as many as a loader with several writers leaves."""
    base = scratch_path(spark, "bench")
    t = Tables(spark, folder)
    names = ("ledger", "lines", "bank_feed", "responses", "truth")
    return {n: stored(getattr(t, n).repartition(files), f"{base}/{n}") for n in names}


def reconcile_step(spark, tables):
    """Everything the reconciliation step delivers; returns (orders, correct)."""
    out = scratch_path(spark, "bench-out")
    result = stored(re.reconcile(tables["ledger"], tables["lines"]), f"{out}/result")
    checked = ba.batch_check(tables["bank_feed"], tables["lines"])
    ba.batch_check_rollup(checked).collect()
    su.outcome_counts(result).collect()
    su.match_rates(result).collect()
    accuracy = gr.engine_accuracy(gr.join_truth(result, tables["truth"])).first()
    return accuracy.engine_graded_orders, accuracy.engine_correct


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    rounds = int(os.environ.get("BENCH_ROUNDS", "3"))
    spark = local_session(cpus, app="tieout-bench")

    small = f"{Path(folder).parent}/sf0.001"
    if Path(small).is_dir():
        reconcile_step(spark, staged(spark, small, 1))
    tables = staged(spark, folder, cpus)
    ledger, lines, bank = tables["ledger"], tables["lines"], tables["bank_feed"]

    base = scratch_path(spark, "bench-mid")
    result = stored(re.reconcile(ledger, lines), f"{base}/result")
    settings = Settings(RUN_ID, RUN_STARTED_AT, temperature=0.0)
    inputs = Inputs(ledger, lines, bank, tables["responses"])
    totals = stored(ba.batch_totals(lines), f"{base}/totals")  # as a run leaves them
    audit = stored(flatten_audit(audit_of(result, inputs, settings, totals)), f"{base}/audit")
    selected = stored(se.select_for_diagnosis(result), f"{base}/selected")
    checked = stored(ba.batch_check(bank, lines), f"{base}/checked")

    graded = {}

    def reconcile():
        graded["n"], graded["ok"] = reconcile_step(spark, tables)

    def audit_log():
        noop(flatten_audit(audit_of(result, inputs, settings, totals)))

    queries = {
        "reconcile": reconcile,
        "reconciliation_result": lambda: noop(re.reconcile(ledger, lines)),
        "batch_check": lambda: noop(ba.batch_check(bank, lines)),
        "batch_check_strict": lambda: noop(ba.batch_check_strict(bank, lines)),
        "outcome_counts": lambda: noop(su.outcome_counts(result)),
        "check_labels": lambda: noop(qu.check_labels(ledger, lines, tables["truth"])),
        "select_for_diagnosis": lambda: noop(se.select_for_diagnosis(result)),
        "assemble_cases": lambda: noop(
            ca.assemble_cases(selected, ledger, lines, bank, totals=totals)
        ),
        "resolve_attempts": lambda: noop(
            di.resolve_attempts(di.parse_diagnosis(tables["responses"]))
        ),
        "audit_log": audit_log,
        "run_summary": lambda: noop(su.run_summary(audit, checked)),
        "review_queue": lambda: noop(rv.review_queue(audit)),
        "kpi_tiles": lambda: noop(rv.kpi_tiles(audit)),
    }
    times = {}
    for name, work in queries.items():
        best = None
        for _ in range(rounds):
            start = time.perf_counter()
            work()
            spent = time.perf_counter() - start
            best = spent if best is None else min(best, spent)
        times[name] = round(best, 3)

    orders = result.agg(F.count("*")).first()[0]
    if not graded["n"] == graded["ok"] == orders:
        raise SystemExit(f"graded {graded} of {orders} orders: timing is not valid")
    print(
        json.dumps(
            {
                "metric": "reconcile_all_orders",
                "value": times["reconcile"],
                "unit": "sec",
                "queries": times,
                "sf": Path(folder).name,
                "orders": orders,
                "orders_per_sec": round(orders / times["reconcile"]),
                "accuracy": graded["ok"] / orders,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
