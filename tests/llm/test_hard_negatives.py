import numpy as np
import pytest
from pyspark.sql import functions as F

from tieout.llm import hard_negatives as hn
from tieout.llm.queries import op12_l2ap_negatives

ROWS = "id long, label int, vector array<long>"


def brute(rows, anchor, positives=5, negatives=5):
    out = set()
    rows = list({(i, c, tuple(v)) for i, c, v in rows})
    for a, label, q in rows:
        if a % anchor:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v, strict=True)), i, c) for i, c, v in rows if len(v) == len(q))
        own = [(-s, i) for s, i, c in scored if c == label and i != a][:positives]
        for p, pid in own:
            fits = [(-s, i) for s, i, c in scored if c != label and 80 * p <= -100 * s <= 100 * p][:negatives]
            out |= {(a, pid, k, i, p, s) for k, (s, i) in enumerate(fits, 1)}
    return out


def mined(spark, rows, anchor, settings=None):
    df = spark.createDataFrame(rows, ROWS).withColumns({"key": F.lit("x"), "size": F.lit(1), "score": F.lit(2)})
    got = [tuple(r) for r in hn.hard_negatives(df, F.col("id") % anchor == 0, settings).collect()]
    assert len(got) == len(set(got))
    return set(got)


SMALL = hn.Settings(block=40, anchor_block=7, wanted=3, least_block=20, seeds=3)


@pytest.mark.parametrize("settings", [None, SMALL])
def test_equal_to_comparing_all(spark, settings):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 20)) * 40
    rows = [(i, int(rng.integers(4)), np.floor(centres[rng.integers(6)] + rng.normal(size=20) * 25).astype(int).tolist())
            for i in range(400)]
    want = brute(rows, 10)
    assert len(want) > 300 and mined(spark, rows, 10, settings) == want


def test_copies_ties_and_repeated_rows(spark):
    rng = np.random.default_rng(5)
    pool = rng.integers(-3, 4, size=(9, 5)).tolist()
    rows = [(i, int(rng.integers(3)), pool[int(rng.integers(9)) if i > 200 else 0]) for i in range(500)]
    rows += rows[:60]
    assert mined(spark, rows, 9, SMALL) == brute(rows, 9)


def test_awkward_rows(spark):
    rows = [(0, 1, [3, 4]), (5, 1, [3, 3]), (10, 2, [3, 3]), (None, 2, [3, 3]), (11, None, [3, 3]), (12, 2, None),
            (13, 2, [None, 3]), (14, 2, [3, 3, 0]), (15, 2, []), (20, 1, []), (25, 1, []), (30, 3, [0, 0]),
            (16, 2, [2**40, 0]), (17, 2, [-5, -5]), (35, 3, [-1, -1]), (40, 3, [1, 1])]
    whole = [r for r in rows if None not in r[:2] and r[2] is not None and None not in r[2] and r[0] != 16]
    assert mined(spark, rows, 10) == brute(whole, 10)
    assert mined(spark, [], 10) == set()
    assert mined(spark, [(0, 1, [1, 2])], 10) == set()


def test_ids_with_several_labels_are_never_their_own_positive(spark):
    rows = [(0, 1, [4, 0]), (0, 1, [3, 1]), (1, 1, [4, 1]), (2, 2, [4, 0]), (3, 2, [3, 1])]
    assert mined(spark, rows, 10) == brute(rows, 10)


def test_quantized(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 0, [0.5, -0.001]), (2, 0, [nan, 1.0]), (3, 0, [inf, 1.0]), (4, 0, None), (5, 0, [None]), (6, 0, [])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    assert {r.id: r.vector for r in hn.quantized(df).collect()} == {1: [128, -1], 6: []}


def test_index_leaves_out_what_the_bound_covers():
    rng = np.random.default_rng(7)
    x = (rng.normal(size=(3000, 64)) * 0.9 ** np.arange(64) * 100).astype(np.int64)
    q = x[5]
    index = hn.SuffixIndex(x)
    norms = index._rest(q[None, index.order].astype(float))
    full, top = x.shape[0] * 8, float((x @ q).max())
    for share in (0.9, 0.5, 0.2):
        least = np.ceil(share * top)
        postings = hn.Postings(index, least / norms[0, 0], (norms / norms[0, 0]).max(axis=0))
        assert sum(postings.sizes) < full
        parts = [q[index.order].astype(float)[a:b] for a, b in zip(index.cuts, index.cuts[1:], strict=False)]
        rows, scores = postings.reaching(q, parts, norms[0], least)
        assert sorted(rows.tolist()) == np.flatnonzero(x @ q >= least).tolist()
        assert scores.tolist() == (x[rows] @ q).tolist()
    # at a high threshold most postings are never made
    assert sum(hn.Postings(index, 0.9 * top / norms[0, 0], norms[0] / norms[0, 0]).sizes) < full / 2


def test_registered_query(spark):
    sf = "/root/testdata/sf0.1"
    rows = hn.quantized(spark.read.parquet(f"{sf}/embeddings.parquet")).collect()
    rows = [(r.id, (r.label + 1) % 10 if r.id % 7 == 0 else r.label, r.vector) for r in rows]
    got = op12_l2ap_negatives(spark, sf)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert {tuple(r) for r in got.collect()} == brute(rows, 100)
