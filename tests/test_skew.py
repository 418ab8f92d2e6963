"""One key holding a third of the rows or more: same results, bounded groups, cheap plans."""

from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.rows import bank_df, d, ledger_df, line, lines_df, order, replies_df
from tieout.operators import batches as ba
from tieout.operators import cases as ca
from tieout.operators import reconcile as re
from tieout.operators import selection as se
from tieout.operators.lines import lines_per_order
from tieout.operators.skew import hot_keys, join_many_to_one
from tieout.plans.registry import QUERIES
from tieout.plans.run import Inputs, Settings, run_reconciliation
from tieout.sources.sinks import sink_table
from tieout.session import scratch_path


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def hot(spark):
    """900 of 1,000 lines on one order: 600 copies of one line and 300 different ones."""
    hot_lines = [line("hot", txn="T-copy")] * 600 + [line("hot", txn=f"T-{i}") for i in range(300)]
    others = [line(f"o{i}", batch="B2") for i in range(100)]
    orders = [order("hot"), order("none")] + [order(f"o{i}") for i in range(100)]
    bank = bank_df(spark, ("u1", "1.00", "B1"), ("u2", "2.00", "B2"))
    return ledger_df(spark, *orders), lines_df(spark, *hot_lines, *others).repartition(7), bank


def test_sliced_join_equals_plain_join(spark):
    many = spark.range(1000).select(
        F.col("id"),
        F.when(F.col("id") < 400, "hot").when(F.col("id") < 500, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("key"),
    )
    one = many.groupBy("key").agg(F.sum("id").alias("v")).filter("key is not null and key <> 'k3'")
    sizes = many.groupBy("key").agg(F.count("*").alias("n"))
    assert {r.key: r._slices for r in hot_keys(sizes, "key", 150).collect()} == {"hot": 3}
    sliced = join_many_to_one(many, one, "key", sizes, ["id"], rows_per_slice=150)
    plain = many.join(one, "key", "left")
    assert Counter(sliced.select("id", "key", "v").collect()) == Counter(
        plain.select("id", "key", "v").collect()
    )


def test_hot_credits_join_in_place(spark):
    rows = [("u", "1.00", "hot")] * 400 + [("u", "2.00", f"B{i}") for i in range(50)]
    rows += [("u", "3.00", "lonely")] * 300
    bank = bank_df(spark, *rows)
    unkeyed = bank.filter("settlement_batch_id = 'B1'").withColumn(
        "settlement_batch_id", F.lit(None).cast("string")
    )
    bank = bank.unionByName(unkeyed)
    lines = lines_df(spark, line("a", batch="hot"), *[line(f"o{i}", batch=f"B{i}") for i in range(40)])
    apart = ba.batch_check(bank, lines, hot_apart=100)
    plain = ba.batch_balanced(bank.join(ba.batch_net(lines), "settlement_batch_id", "left"))
    assert Counter(apart.select(*plain.columns).collect()) == Counter(plain.collect())
    assert apart.count() == 751


def test_repeated_orders_keep_a_verdict_per_row(hot):
    ledger, lines, _ = hot
    copies = ledger.filter("order_id = 'hot'").withColumn(
        "_i", F.explode(F.sequence(F.lit(1), F.lit(300)))
    )
    ledger = ledger.unionByName(copies.drop("_i"))
    expected, per_order = re.expected_settlement(ledger), lines_per_order(lines)
    apart = re.join_expected_lines(expected, per_order, repeated_orders=True, rows_per_slice=100)
    plain = re.join_expected_lines(expected, per_order)
    assert Counter(apart.select(*plain.columns).collect()) == Counter(plain.collect())
    result = re.reconcile(ledger, lines, repeated_orders=True)
    assert result.count() == 402


def test_hot_order_is_cut_into_parts_and_kept_whole(hot):
    ledger, lines, bank = hot
    cases = ca.assemble_cases(ledger, ledger, lines, bank, lines_per_part=100)
    rows = cases.collect()
    by_order = {}
    for r in rows:
        by_order.setdefault(r.order_id, []).append(r)
    parts = by_order.pop("hot")
    assert len(parts) > 1
    assert sorted(r.part_no for r in parts) == list(range(parts[0].n_parts))
    assert all(r.n_parts == parts[0].n_parts for r in parts)
    listed = Counter()
    for r in parts:
        for ln in r.settlement_lines:
            listed[ln.transaction_id] += ln.copies
    assert listed["T-copy"] == 600
    assert sum(listed.values()) == 900
    assert len(listed) == 301
    assert all(len(rs) == 1 for rs in by_order.values())
    assert by_order["none"][0].settlement_lines == []
    # the batch of a hot order is found all the same
    assert parts[0].batch_bank_credit_amount == Decimal("1.00")
    assert parts[0].settlement_row_count == 900


def test_parts_render_with_copy_counts(hot):
    ledger, lines, bank = hot
    cases = ca.assemble_cases(ledger.filter("order_id = 'hot'"), ledger, lines, bank, 100)
    texts = [r.case_text for r in ca.render_case(cases).collect()]
    assert sum(t.count("(x600)") for t in texts) == 1
    assert sum(t.count("  - transaction_id=") for t in texts) == 301


def test_cases_have_one_shape_at_every_bound(spark, hot):
    ledger, _, bank = hot
    five = lines_df(spark, *[line("none", txn="T-1")] * 5, line("o1", txn="T-2"))
    got = []
    for bound in (10, 3, 1):
        rows = ca.case_lines(ledger.filter("order_id in ('none', 'o1')"), five, bound).collect()
        got.append(sorted((r.order_id, r.part_no, r.n_parts, tuple(x.copies for x in r.settlement_lines)) for r in rows))
    assert got == [[("none", 0, 1, (5,)), ("o1", 0, 1, (1,))]] * 3
    many = lines_df(spark, *[line("o1", txn=f"T-{i}") for i in range(40)])
    parts = ca.case_lines(ledger, many, 1).collect()
    assert sorted(r.part_no for r in parts) == list(range(len(parts)))
    assert {r.n_parts for r in parts} == {len(parts)}
    assert sum(len(r.settlement_lines) for r in parts) == 40


def test_fingerprint_counts_copies_and_ignores_order(hot):
    ledger, lines, bank = hot

    def prints(some_lines):
        headers = ca.case_headers(ledger, ledger, some_lines, bank)
        return {r.order_id: r.case_fingerprint for r in headers.collect()}

    base = prints(lines)
    assert prints(lines.orderBy(F.rand(3)).repartition(3)) == base
    copy = lines.filter("transaction_id = 'T-5' and order_id = 'hot'").withColumn(
        "net_amount", F.lit(d("0.00"))
    )
    more = prints(lines.unionByName(copy))
    assert more["hot"] != base["hot"]
    assert {k: v for k, v in more.items() if k != "hot"} == {
        k: v for k, v in base.items() if k != "hot"
    }
    assert len(set(base.values())) == len(base)


def test_digests_depend_on_ids_only(tables):
    ledger = tables.keyed_ledger
    one = ca.run_id_digest(ledger, "_batch_no").first()
    assert ca.run_id_digest(ledger.repartition(5), "_batch_no").first() == one
    assert ca.run_id_digest(ledger.filter("order_id <> 7"), "_batch_no").first() != one


def test_hot_order_reaches_the_reducer_combined(hot):
    plan = plan_of(lines_per_order(hot[1]))
    assert "partial_min" in plan
    assert "partial_count" in plan


def test_first_per_group_cuts_before_the_shuffle(tables):
    plan = plan_of(se.first_per_group(tables.keyed_ledger, "_label", 2))
    final, partial = plan.index("Final"), plan.index("Partial")
    assert final < plan.index("Exchange") < partial


def test_samples_and_caps_are_those_of_the_sort(spark, tables):
    clean = se.clean(tables.stored_result).select("order_id", "category")
    draw = F.sha2(F.concat(F.col("order_id").cast("string"), F.lit("|42")), 256)
    for n in (0, 1, 5, 500, 10_000):
        want = clean.orderBy(draw, "order_id").limit(n).select("order_id").collect()
        assert sorted(se.control_sample(clean, n).collect()) == sorted(want)
    held = se.flagged(tables.stored_result)
    for cap in (1, 100, 10_000):
        want = held.orderBy("order_id").limit(cap).collect()
        assert sorted(se.cap_flagged(held, cap).collect()) == sorted(want)
    assert se.cap_flagged(held, 0).count() == se.cap_flagged(held, None).count() == held.count()
    texts = held.withColumn("order_id", F.col("order_id").cast("string"))
    want = texts.orderBy("order_id").limit(30).collect()
    assert sorted(se.cap_flagged(texts, 30).collect()) == sorted(want)


def test_selecting_starts_no_job(spark, tables):
    result = tables.stored_result
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("selecting", "")
    se.mark_selection(result, controls=50_000, cap=20_000)
    assert list(tracker.getJobIdsForGroup("selecting")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("repeated", [False, True])
def test_audit_has_a_row_per_ledger_row(spark, repeated):
    ledger = ledger_df(spark, *[order("a")] * 3, *[order("b")] * 2, order("c"))
    lines = lines_df(spark, line("a"), line("b", fee="30.00"))
    bank = bank_df(spark, ("u1", "1.00", "B1"))
    answers = replies_df(spark, *[(o, 1, "bad", 1) for o in "abc"])
    settings = Settings("r", "2026-01-05 00:00:00", repeated_orders=repeated, cap=5)
    out = scratch_path(spark, "repeats")
    paths = run_reconciliation(Inputs(ledger, lines, bank, answers), settings, out)
    audit = spark.read.parquet(paths["audit_log"])
    assert Counter(r.order_id for r in audit.collect()) == {"a": 3, "b": 2, "c": 1}
    assert audit.filter("agent_invoked").count() == 6


def test_hot_opinions_are_spread(spark):
    from tieout.operators.audit import OPINION_COLUMNS, audit_assembly

    result = re.reconcile(
        ledger_df(spark, *[order("a")] * 400, order("b")), lines_df(spark, line("a"), line("b"))
    )
    marked = result.withColumn("selection_reason", F.lit("flagged_by_engine"))
    opinions = spark.createDataFrame([("a",), ("b",)], "order_id string").withColumns(
        {c: F.lit(None).cast(t) for c, t in OPINION_COLUMNS.items()} | {"diagnosed": F.lit(True)}
    )
    spread = audit_assembly(marked, opinions, "r", "2026-01-05 00:00:00", True, rows_per_slice=50)
    assert spread.filter("agent_invoked").count() == 401 == spread.count()


def test_bucketed_tables_join_without_a_shuffle(spark, tables):
    place = scratch_path(spark, "buckets")
    name = "tieout_" + place.rsplit("-", 1)[1]
    ledger = sink_table(tables.ledger, name, "ledger", place, bucket_by=("order_id", 4))
    lines = sink_table(tables.lines, name, "lines", place, bucket_by=("order_id", 4))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = re.reconcile(spark.table(ledger), spark.table(lines))
        assert "Exchange" not in plan_of(result)
        assert "SortMergeJoin" in plan_of(result)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(result.collect()) == sorted(tables.result.collect())


def test_a_small_cap_computes_its_rows_once(spark, tables):
    plan = plan_of(se.cap_flagged(se.flagged(tables.stored_result), 50))
    assert "TakeOrderedAndProject" in plan and plan.count("FileScan") == 1 and "Subquery" not in plan


def test_ties_under_a_small_cap_keep_copies(spark):
    rows = spark.createDataFrame(
        [(2, "b"), (1, "a"), (1, "a"), (None, "n"), (1, "c")], "order_id bigint, category string"
    )
    assert [sum(1 for r in se.cap_flagged(rows, n).collect() if r.order_id == 1) for n in (1, 4, 5)] == [0, 3, 3]


def test_choices_read_stored_verdicts(spark):
    """What reads the result several times reads written columns, not the joins behind it."""
    for name in ("skip_reason", "select_for_diagnosis", "control_sample"):
        plan = plan_of(QUERIES[name](spark, "/root/testdata/sf0.001"))
        assert "tieout-verdicts" in plan and "o_orderkey" not in plan, name
