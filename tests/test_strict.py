from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tieout.operators import sequence as sq
from tieout.operators import strict as st
from tieout.operators import selection as se

LINE = "order_id string, transaction_id string, gross_amount decimal(18,2), utr_number string, settlement_batch_id string"


def test_settlement_days_are_counted_as_days_pass(spark):
    holidays = [date(2026, 1, 1), date(2026, 1, 3), date(2025, 12, 25), date(2025, 12, 25)]
    days = [date(2025, 12, 20) + timedelta(i) for i in range(40)]
    df = spark.createDataFrame([(d,) for d in [*days, date(1969, 12, 31)]], "day date")
    got = {r.day: r.n for r in df.select("day", st.settlement_day_number(F.col("day"), holidays).alias("n")).collect()}
    for one, two in zip(days, days[1:], strict=False):
        assert got[two] - got[one] == (two.weekday() < 5 and two not in holidays)
    assert got[date(1969, 12, 31)] < 0


def frames(spark):
    day = date(2026, 1, 5)  # a Monday
    ledger = spark.createDataFrame(
        [("a", Decimal(10), day, None, None), ("b", Decimal(20), day + timedelta(4), Decimal(1), day), ("c", Decimal(5), None, None, day),
         ("d", Decimal(5), day, Decimal(2), None), ("d", Decimal(6), day, Decimal(2), day + timedelta(1))],
        "order_id string, order_amount decimal(18,2), order_date date, refund_amount decimal(18,2), refund_date date",
    )
    lines = spark.createDataFrame(
        [("a", "t1", Decimal(10), "u1", "B1"), ("b", "t2", Decimal(21), "u2", "B1"), ("c", "t3", None, None, "B2"),
         ("d", "t4", Decimal(5), "u9", "B3"), ("x", "t5", Decimal(1), "u1", "B1"), ("a", "t6", Decimal(10), "u1", None)], LINE
    )
    bank = spark.createDataFrame(
        [("u1", day + timedelta(2), "B1"), ("u2", day + timedelta(7), "B1"), ("u3", day + timedelta(1), "B2")],
        "utr_number string, credit_date date, settlement_batch_id string",
    )
    return ledger, lines, bank


def test_strict_checks_find_each_break(spark):
    ledger, lines, bank = frames(spark)
    assert {r.transaction_id for r in st.gross_breaks(ledger, lines).collect()} == {"t2", "t3", "t4"}
    assert {r.transaction_id for r in st.reference_breaks(lines, bank).collect()} == {"t3"}
    found = {(r.order_id, r.problem) for r in st.refund_date_breaks(ledger).collect()}
    assert found == {("b", "before_order"), ("c", "no_amount"), ("d", "no_date")}
    for slice_rows in (1, 10**6):
        lags = {r.transaction_id: (r.settlement_days, r.status) for r in
                st.settlement_lags(ledger, lines, bank, 2, 2, rows_per_slice=slice_rows).collect()}
        assert lags == {"t1": (2, "on_time"), "t2": (-2, "early"), "t3": (None, "no_date"), "t4": (None, "no_credit"), "t6": (None, "no_credit")}
    checks = {r.check_name: r.n_bad for r in st.check_strict(ledger, lines, bank).collect()}
    assert checks == {"gross_is_order_amount": 3, "reference_was_credited": 1, "refund_dates_fit": 3, "settled_in_time": 4}
    empty = [df.limit(0) for df in (ledger, lines, bank)]
    assert all(r.passed for r in st.check_strict(*empty).collect())


def root(spark, ids, fanout=4, parts=3):
    rows = spark.createDataFrame(list(enumerate(ids)), "place long, order_id string").repartition(parts)
    tree = sq.sequence_tree(rows, fanout=fanout)
    return tree, [tuple(r) for r in sq.sequence_digest(tree).collect()]


def test_the_sequence_digest_knows_order(spark):
    ids = [f"o{i}" for i in range(70)]
    tree, whole = root(spark, ids)
    assert {r.level: r["count"] for r in tree.groupBy("level").count().collect()} == {0: 18, 1: 5, 2: 2, 3: 1}
    assert whole[0][0] == 70 and root(spark, ids, parts=7)[1] == whole
    swapped = ids.copy()
    swapped[9], swapped[50] = ids[50], ids[9]
    other, changed = root(spark, swapped)
    assert changed != whole
    ranges = sorted((r.first_place, r.last_place) for r in sq.differing_ranges(tree, other, 4).collect())
    assert ranges == [(8, 11), (48, 51)]
    shorter, _ = root(spark, ids[:-3])
    assert [(r.first_place, r.n_one, r.n_two) for r in sq.differing_ranges(tree, shorter, 4).orderBy("first_place").collect()] == [
        (64, 4, 3), (68, 2, 0),
    ]
    assert root(spark, [*ids[:5], None, *ids[6:]])[1] != root(spark, [*ids[:5], "~", *ids[6:]])[1]
    assert root(spark, [])[1] == [] and root(spark, ["x"])[1][0][0] == 1


def test_rows_are_numbered_in_order(spark):
    rows = spark.range(5000).select(F.xxhash64("id").alias("h"), "id").repartition(7)
    got = sq.numbered(rows, "h").orderBy("place").collect()
    assert [r.place for r in got] == list(range(5000))
    assert [r.h for r in got] == sorted(r.h for r in got)
    assert sq.numbered(rows.limit(0), "h").count() == 0


@pytest.mark.parametrize("kind", ["prefixed", "sparse", "decimal", "skewed"])
def test_first_rows_of_ids_of_any_kind(spark, kind):
    ids = {
        "prefixed": F.format_string("ORD-2026-%09d", F.col("id") * 7 % 20011),
        "sparse": F.xxhash64("id"),
        "decimal": (F.xxhash64("id").cast("decimal(20,0)") / 7).cast("decimal(30,6)"),
        "skewed": F.when(F.col("id") % 3 == 0, F.lit(77)).otherwise(F.col("id") % 500),
    }[kind]
    rows = spark.range(20_000).select(ids.alias("order_id"), (F.col("id") % 2).alias("v"))
    rows = rows.unionByName(spark.createDataFrame([(None, 5)] * 3, "id int, v long").select(F.col("id").cast(rows.schema["order_id"].dataType).alias("order_id"), "v"))
    want = [r.order_id for r in rows.select("order_id").orderBy("order_id").collect()]
    for n in (1, 3, 4, 100, 7_777, 20_002, 20_003, 50_000):
        got = se.first_rows(rows, n).collect()
        assert sorted((r.order_id for r in got), key=lambda x: (x is not None, x)) == want[:n], n
    assert se.first_rows(rows.limit(0), 5).count() == 0


def test_only_one_range_is_put_in_order(spark):
    rows = spark.range(200_000).select(F.format_string("ORD-%09d", "id").alias("order_id"))
    kept = se.first_rows(rows, 100_000)
    assert kept.count() == 100_000
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan


def test_a_control_is_drawn_once_and_bounds_the_shuffle(spark):
    ids = spark.range(30_000).select((F.col("id") % 9_000).alias("order_id"))
    ids = ids.unionByName(spark.createDataFrame([(None,)], "order_id long"))
    draw = F.sha2(F.concat(F.col("order_id").cast("string"), F.lit("|42")), 256)
    order = [r.order_id for r in ids.distinct().where("order_id is not null").orderBy(draw).collect()]
    for n in (1, 5, 2_000, 8_999, 9_000, 20_000):
        assert sorted(r.order_id for r in se.control_sample(ids, n).collect()) == sorted(order[:n])
    hot = spark.range(30_000).select(F.when(F.col("id") < 29_000, 1).otherwise(F.col("id")).alias("order_id"))
    assert se.control_sample(hot, 700).distinct().count() == 700
