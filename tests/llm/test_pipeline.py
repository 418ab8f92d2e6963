import pytest

import corpus_pipeline as cp
from tests.llm.frames import docs_df


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    item = "one two three four five six seven eight nine ten eleven twelve"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_language_keeps_clean_documents(spark, sf):
    docs = docs_df(spark, *((i, f"the dog and cat number {i} are here") for i in range(40)), (90, None), (91, "12 34"),
                   (None, "the dog"), extra=True)
    got = cp.in_known_language(spark, docs, sf)
    assert got.columns == cp.COLUMNS
    assert set(rows(got)) == {*range(40), None}


def test_one_of_each_group_stays(spark, sf):
    text = " ".join(f"w{i}" for i in range(100))
    docs = docs_df(spark, (5, text), (3, text + " more"), (4, "else"), (4, "else"), (8, None), (9, ""), (None, text), extra=True)
    got = cp.without_near_copies(spark, docs, sf)
    assert got.columns == cp.COLUMNS and got.count() == 5
    assert set(rows(got)) == {3, 4, 8, 9, None}


def test_benchmark_passages_go(spark, sf):
    docs = docs_df(spark, (1, "x seven eight nine ten eleven twelve y one two three four five six"), (2, "one two three"),
                   (3, None), (None, "clean"), extra=True)
    assert set(rows(cp.without_benchmark(spark, docs, sf))) == {2, 3, None}


def test_secrets_are_blotted_out(spark, sf):
    docs = docs_df(spark, (1, "é token = \"abcdef123456\" end " + "0a" * 20), (2, "clean é"), (3, None), (4, "pwd"), extra=True)
    got = rows(cp.without_secrets(spark, docs, sf))
    assert got[1].text == "é [SECRET]\" end [SECRET]" and got[1].n_chars == len(got[1].text)
    assert [got[i].text for i in (2, 3, 4)] == ["clean é", None, "pwd"]
    assert cp.without_secrets(spark, docs, sf).columns == cp.COLUMNS


def test_stages_take_empty_tables(spark, sf):
    docs = docs_df(spark)
    for name, stage in cp.STAGES:
        out = stage(spark, docs, sf)
        assert out.count() == 0, name
        if name != "packing":
            assert out.columns == cp.COLUMNS
            docs = out


def test_whole_run(spark, folder):
    assert [n for n, _ in cp.STAGES] == ["language", "near_duplicates", "decontamination", "secrets", "packing"]
    got = cp.run(spark, folder)
    n = got.select("doc_id").distinct().count()
    assert 100 < n < 200
    assert got.groupBy("sequence_id").sum("length").where("`sum(length)` > 4096").count() == 0


def test_each_row_is_judged_by_its_own_text(spark, sf):
    docs = docs_df(spark, *((i, f"the dog and cat number {i} are here") for i in range(40)), (7, "12 34"), (7, None), (None, "12"))
    assert sorted(r.doc_id for r in cp.in_known_language(spark, docs, sf).collect()) == list(range(40))
    item = "one two three four five six seven eight nine ten eleven twelve"
    docs = docs_df(spark, (1, item), (1, "clean"), (1, "clean too"), (None, item), (None, None), (None, "clean"))
    got = cp.without_benchmark(spark, docs, sf)
    assert sorted((r.doc_id or 0, r.text or "") for r in got.collect()) == [(0, ""), (0, "clean"), (1, "clean"), (1, "clean too")]


def test_one_row_of_each_group_stays_where_ids_repeat(spark, sf):
    texts = [" ".join(f"{c}{i}" for i in range(100)) for c in "abc"]
    rows = [(1, t) for t in texts] + [(1, texts[0] + " more"), (2, texts[1]), (1, texts[2]), (3, ""), (3, None), (3, None)]
    want = None
    for order in (rows, rows[::-1]):
        got = cp.without_near_copies(spark, docs_df(spark, *order).repartition(5), sf)
        kept = sorted((r.doc_id, r.text or "") for r in got.collect())
        assert len(kept) == 5 and [k for k, _ in kept] == [1, 1, 1, 3, 3]
        assert {t[:1] for _, t in kept} == {"a", "b", "c", ""}
        assert want in (None, kept)
        want = kept


def test_lettered_texts_stay_where_no_language_is_known(spark, sf):
    docs = docs_df(spark, (1, "words"), (2, "12"), (3, None), (4, "été"), (5, "日本")).withColumn("lang", cp.F.lit(None).cast("string"))
    assert set(rows(cp.in_known_language(spark, docs, sf))) == {1, 4, 5}


def test_short_benchmark_items_reject_no_document(spark, tmp_path):
    spark.createDataFrame([(1, "yes"), (2, "a b c d e f")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = docs_df(spark, (1, "yes indeed"), (2, "x a b c d e f y"))
    assert set(rows(cp.without_benchmark(spark, docs, str(tmp_path)))) == {1}


def test_many_overlapping_secrets_are_blotted_in_order(spark, sf):
    text = "﻿a token=abcdef0123 " + " ".join(f"é{i} " + "0a" * 14 for i in range(3_000)) + " ﻿secret:abcdefg1"
    got = rows(cp.without_secrets(spark, docs_df(spark, (1, text)), sf))[1].text
    assert got.count("[SECRET]") == 3_002 and got.startswith("﻿a [SECRET] é0 [SECRET] é1 ")
    assert got.endswith(" ﻿[SECRET]")
