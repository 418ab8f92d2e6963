from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tieout.plans.run import Inputs, Settings, run_on_tables, run_reconciliation
from tieout.session import scratch_path
from tieout.sources import sinks, tables as sources
from tieout.sources.runs import CatalogRuns, RunStore, fitted, merged, wider


def kind(text):
    return T._parse_datatype_string(text)


@pytest.mark.parametrize(
    ("one", "two", "both"),
    [("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("float", "double", "double"),
     ("int", "float", "double"), ("decimal(18,2)", "decimal(10,4)", "decimal(20,4)"), ("int", "decimal(4,2)", "decimal(12,2)"),
     ("date", "timestamp", "timestamp"), ("void", "string", "string"), ("array<int>", "array<bigint>", "array<bigint>"),
     ("map<string,int>", "map<string,bigint>", "map<string,bigint>"),
     ("struct<a:int>", "struct<a:bigint,b:string>", "struct<a:bigint,b:string>")],
)
def test_types_that_hold_both(spark, one, two, both):
    assert wider(kind(one), kind(two)).simpleString() == both
    assert wider(kind(two), kind(one)).simpleString() in (both, "struct<a:bigint,b:string>")


@pytest.mark.parametrize(("one", "two"), [("string", "int"), ("bigint", "double"), ("boolean", "int"), ("decimal(38,0)", "decimal(38,10)")])
def test_types_without_a_common_one(spark, one, two):
    with pytest.raises(ValueError, match="column c: no type holds both"):
        merged(kind(f"struct<c:{one}>"), kind(f"struct<c:{two}>"))


def frames(spark):
    old = spark.createDataFrame([("a", 1, Decimal("1.50")), ("b", 2, None)], "order_id string, n int, v decimal(5,2)")
    new = spark.createDataFrame(
        [("a", 2**40, Decimal("2.125"), "x", date(2026, 1, 5))], "order_id string, n bigint, v decimal(8,3), note string, d date"
    )
    return old, new


def test_a_run_with_more_columns_and_wider_types(spark):
    old, new = frames(spark)
    store = RunStore(spark, scratch_path(spark, "runs"))
    for run, df in (("r1", old), ("r/2 é", new), ("r3", old.select("order_id"))):
        attempt = store.begin(run)
        back = attempt.write(df, "audit")
        assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)
        attempt.commit()
    got = store.read("audit")
    assert got.schema.simpleString() == "struct<run_id:string,order_id:string,n:bigint,v:decimal(8,3),note:string,d:date>"
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [("r1", "a", 1, Decimal("1.500"), None, None), ("r1", "b", 2, None, None, None), ("r3", "a", None, None, None, None),
         ("r3", "b", None, None, None, None), ("r/2 é", "a", 2**40, Decimal("2.125"), "x", date(2026, 1, 5))], key=str
    )
    assert store.read("audit", "r1").columns == ["run_id", "order_id", "n", "v"]
    with pytest.raises(ValueError, match="no published run"):
        store.read("other")


def test_nothing_is_seen_before_the_commit_and_reruns_replace(spark):
    old, new = frames(spark)
    store = RunStore(spark, scratch_path(spark, "runs"))
    assert store.commits() == []
    stopped = store.begin("r1")
    stopped.write(old, "audit")
    with pytest.raises(ValueError):
        store.read("audit")
    first = store.begin("r1")
    first.write(old, "audit")
    first.write(old, "result")
    first.commit()
    again = store.begin("r1")
    again.write(new, "audit")
    assert store.read("audit").count() == 2  # the rerun is not there yet
    again.write(old.limit(1), "result")
    again.commit()
    assert store.read("audit").count() == 1 and store.read("result").count() == 1
    assert [(c.run_id, c.generation) for c in store.commits()] == [("r1", 2)]


def test_a_run_that_stops_is_invisible(spark, tables, monkeypatch):
    out = scratch_path(spark, "out")
    inputs = Inputs(tables.ledger.limit(50), tables.lines, tables.bank_feed)
    store = RunStore(spark, out)
    run_reconciliation(inputs, Settings("r1", "2026-01-05 00:00:00"), out)
    before = {t: sorted(map(str, store.read(t).collect())) for t in ("reconciliation_result", "audit_log", "run_summary")}
    for name in ("sink_audit_jsonl", "sink_audit_csv", "sink_document"):
        with monkeypatch.context() as m:
            m.setattr(sinks, name, lambda *a, **k: 1 / 0)
            for run in ("r1", "r2"):
                with pytest.raises(ZeroDivisionError):
                    run_reconciliation(inputs, Settings(run, "2026-01-06 00:00:00", cap=3), out)
        assert {t: sorted(map(str, store.read(t).collect())) for t in before} == before
    run_reconciliation(inputs, Settings("r2", "2026-01-06 00:00:00"), out)
    assert {r.run_id for r in store.read("run_summary").collect()} == {"r1", "r2"}
    assert store.read("audit_log").groupBy("run_id").count().collect() and store.read("audit_jsonl", "r2").count() == 50


def catalog(spark):
    place = scratch_path(spark, "catalog")
    name = "tieout_" + place.rsplit("-", 1)[1]
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{place}'")
    return name


def test_catalog_runs_take_changed_schemas(spark):
    old, new = frames(spark)
    runs = CatalogRuns(spark, catalog(spark))
    for run, df in (("r1", old), ("r2", old.withColumn("note", F.lit("y"))), ("r3", new), ("r4", old)):
        back = runs.write(df, "audit", run, "t" + run)
        assert sorted(back.collect(), key=str) == sorted(fitted(df, back.schema).collect(), key=str)
        view = runs.show("audit", "audit")
        assert run not in {r.run_id for r in spark.table(view).collect()}
        runs.commit(run, "t" + run)
        assert run in {r.run_id for r in spark.table(view).collect()}
    got = spark.table(view)
    assert got.schema.simpleString() == "struct<order_id:string,n:bigint,v:decimal(8,3),note:string,d:date,run_id:string>"
    rows = {(r.run_id, r.order_id): (r.n, r.v, r.note) for r in got.collect()}
    assert rows["r1", "a"] == (1, Decimal("1.500"), None) and rows["r2", "b"] == (2, None, "y")
    assert rows["r3", "a"] == (2**40, Decimal("2.125"), "x") and len(rows) == 7
    runs.write(old.limit(1), "audit", "r1", "again")
    assert spark.table(view).where("run_id = 'r1'").count() == 2
    runs.commit("r1", "again")
    assert spark.table(view).where("run_id = 'r1'").count() == 1
    last = runs.show("last", "audit", last_only=True)
    assert [r.run_id for r in spark.table(last).collect()] == ["r1"]


def test_catalog_runs_keep_their_summaries(spark, tables, monkeypatch):
    schema = catalog(spark)
    names = {
        part: sinks.sink_table(getattr(tables, part).limit(40), schema, f"in_{part}") for part in ("ledger", "lines", "bank_feed")
    }
    for run in ("run-1", "run-2", "run-2"):
        out = run_on_tables(spark, names, Settings(run, "2026-01-05 00:00:00"), schema)
    assert sorted(r.run_id for r in spark.table(out["run_summaries"]).collect()) == ["run-1", "run-2"]
    assert [r.run_id for r in spark.table(out["run_summary"]).collect()] == ["run-2"]
    monkeypatch.setattr(CatalogRuns, "commit", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_on_tables(spark, names, Settings("run-3", "2026-01-05 00:00:00"), schema)
    assert {r.run_id for r in spark.table(out["audit_log"]).collect()} == {"run-1", "run-2"}
    assert [r.run_id for r in spark.table(out["run_summary"]).collect()] == ["run-2"]


def test_audit_table_reads_added_columns(spark, tables):
    path = scratch_path(spark, "audit")
    flat = tables.flat_audit.limit(5)
    sinks.sink_audit_table(flat, path)
    sinks.sink_audit_table(flat.withColumns({"run_id": F.lit("run-2"), "note": F.lit("n")}), path)
    rows = sources.scan_audit_table(spark, path).collect()
    assert sorted((r.run_id, r.note) for r in rows if r.note) == [("run-2", "n")] * 5 and len(rows) == 10
