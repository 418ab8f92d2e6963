import random

from tests.llm.frames import docs_df
from tieout.llm.decontaminate import decontaminated, leaks, tiles, tokens


def plain_tiling(doc, item, least):
    """Brute force: the longest free common run, earliest in the document, then in the item."""
    in_doc, in_item, out = set(), set(), []
    while True:
        best = (0, 0, 0)
        for d in range(len(doc)):
            for i in range(len(item)):
                n = 0
                while (d + n < len(doc) and i + n < len(item) and doc[d + n] == item[i + n]
                       and d + n not in in_doc and i + n not in in_item):
                    n += 1
                if n > best[0]:
                    best = (n, d, i)
        if best[0] < least:
            return out
        n, d, i = best
        in_doc.update(range(d, d + n))
        in_item.update(range(i, i + n))
        out.append(best)


def cases():
    rng = random.Random(4)
    for _ in range(40):
        item = rng.choices("abcdefghijklmnop", k=rng.randrange(3, 25))
        parts = [item[i : i + 7] for i in range(0, len(item), 7)]
        rng.shuffle(parts)
        doc = [w for p in parts for w in p + rng.choices("xyz", k=rng.randrange(4))]
        yield rng.choices("abcxyz", k=5) + doc, item


def test_coverage_matches_brute_force(spark):
    all_cases = list(cases())
    bench = spark.createDataFrame([(i, " ".join(c[1])) for i, c in enumerate(all_cases)], "item_id long, text string")
    docs = docs_df(spark, *((i, " ".join(c[0])) for i, c in enumerate(all_cases)), extra=True)
    got = {(r.doc_id, r.item_id): r for r in leaks(docs, bench, 5, 0.01).collect()}
    for d, (doc, _) in enumerate(all_cases):
        for i, (_, item) in enumerate(all_cases):
            want = plain_tiling(doc, item, min(5, len(item)))
            share = sum(n for n, _, _ in want) / len(item)
            assert (got[d, i].coverage if (d, i) in got else 0) == share
            if (d, i) in got:
                assert got[d, i].n_tiles == len(want)


def test_reordered_and_awkward_rows(spark):
    text = "One two three four five six. Seven eight nine ten eleven twelve!"
    bench = spark.createDataFrame([(1, text), (2, ""), (3, None), (4, "short item"), (None, text)], "item_id long, text string")
    docs = docs_df(spark, (1, "x SEVEN, eight nine ten eleven twelve y one two three four five six"), (2, None), (3, ""),
                   (4, "one two three four"), (5, "a short  item"), (5, "a short  item"), (None, text),
                   (6, "filler " * 30_000 + text))
    got = {r.doc_id: (r.contaminated, r.coverage, r["items"]) for r in decontaminated(docs, bench).collect()}
    hit = (True, 1.0, [1])
    no = (False, 0.0, [])
    assert got == {1: hit, 2: no, 3: no, 4: no, 5: (True, 1.0, [4]), None: hit, 6: hit}
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminated(docs, empty).where("contaminated").count() == 0
    assert decontaminated(docs_df(spark), bench).count() == 0


def test_blocks_do_not_change_the_result(spark, monkeypatch):
    import tieout.llm.decontaminate as d

    bench = spark.createDataFrame([(i, f"a{i} b c d e f{i}") for i in range(20)], "item_id long, text string")
    docs = docs_df(spark, *((i, f"x a{i} b c d e f{i} y") for i in range(20)))
    whole = sorted(map(tuple, leaks(docs, bench).collect()))
    monkeypatch.setattr(d, "BLOCK_BYTES", 60)
    assert sorted(map(tuple, leaks(docs, bench).collect())) == whole and len(whole) >= 20


def test_tiles_prefer_the_longest():
    assert tiles([(5, 0, 0), (9, 3, 10)], 5) == [(9, 3, 10)]
    assert tokens("A_b-c É1") == ["a_b", "c", "é1"]


def test_short_items_need_enough_marked_words(spark):
    bench = spark.createDataFrame([(1, "yes"), (2, "one two three four five six"), (3, "a b c d")], "item_id long, text string")
    docs = docs_df(spark, (1, "yes it is"), (2, "one two three four five"), (3, "a b c d"), (4, "no"))
    got = {r.doc_id: r["items"] for r in decontaminated(docs, bench, marked=5).collect()}
    assert got == {1: [], 2: [2], 3: [], 4: []}
    assert {r.doc_id for r in decontaminated(docs, bench).where("contaminated").collect()} == {1, 2, 3}
