import pytest

from tieout.session import scratch_path
from tieout.sources import sinks, tables as sources

ROWS = [
    ("a", "plain", "1"), ("b", "two\nlines", "2"), ("c", 'say "hi",\n"twice"', "3"), ("d", "", None), ("e", None, ""),
    ("f", "\n\n", "x"), ("g", "ends with quote\"", 'in"side'), ("h", '"', ","), ("i", '",\n', '\n"'), ("j", "last\none\n\n", "é日😀"),
    ("k", "", "after"),
]
SCHEMA = "k string, v string, w string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def split(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    spark.conf.set(keys[1], "1")
    yield lambda n: spark.conf.set(keys[0], str(n))
    for k, v in before.items():
        spark.conf.set(k, v)


def written(spark, text):
    path = scratch_path(spark, "csv")
    lines = [(line,) for line in text.removesuffix("\n").split("\n")]
    spark.createDataFrame(lines, "value string").coalesce(1).write.text(path)
    return path


def test_every_split_reads_the_same_rows(spark, split):
    df = spark.createDataFrame(ROWS, SCHEMA).coalesce(1)
    path = scratch_path(spark, "csv")
    sinks.sink_table_csv(df, path)
    want = rows(df)
    assert rows(sources.scan_csv_strings(spark, path, df.columns, multi_line=True)) == want
    for n in (1, 2, 3, 7, 16, 33, 61, 104):  # 1: a range begins at every byte
        split(n)
        assert rows(sources.scan_csv_strings(spark, path, df.columns)) == want, n


def test_one_large_file_is_read_by_many_tasks(spark, split):
    df = spark.range(5000).selectExpr("cast(id as string) k", "concat('x\\n', id, ',\"y\"') v", "repeat('z', 20) w").coalesce(1)
    path = scratch_path(spark, "csv")
    sinks.sink_table_csv(df, path)
    split(20_000)
    got = sources.scan_csv_typed(spark, path, df.schema)
    assert spark.read.text(path).rdd.getNumPartitions() > 5
    assert rows(got) == rows(df)


def test_headers_blank_lines_and_loose_quotes(spark, split):
    text = '\n\nk,v,w\r\n1,a"b,\r\n\r\n"2","x\r\n\r\ny"z,"q"\r\n3,"",""""\n4,5\n'
    path = written(spark, text)
    want = [("1", 'a"b', None), ("2", '"x\r\n\r\ny"z', "q"), ("3", "", '"'), ("4", "5", None)]
    for n in (5, 11, 1000):
        split(n)
        got = rows(sources.scan_csv_strings(spark, path, ["k", "v", "w"]))
        assert [g[0] for g in got] == ["1", "2", "3", "4"]
        assert [g for g in got if g[0] != "2"] == [w for w in want if w[0] != "2"]


def test_several_files_and_none(spark, split):
    split(25)
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    path = scratch_path(spark, "csv")
    sinks.sink_table_csv(df, path)
    assert rows(sources.scan_csv_strings(spark, path, df.columns)) == rows(df)
    empty = scratch_path(spark, "csv")
    sinks.sink_table_csv(df.limit(0), empty)
    assert sources.scan_csv_strings(spark, empty, df.columns).count() == 0


def test_a_field_that_is_never_closed(spark, split):
    path = written(spark, 'k,v,w\n1,2,3\n4,"open,\nand on,\nto the end')
    for n in (6, 1000):
        split(n)
        got = rows(sources.scan_csv_strings(spark, path, ["k", "v", "w"]))
        assert [g[0] for g in got] == ["1", "4"]
