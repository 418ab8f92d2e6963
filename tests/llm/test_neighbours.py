import numpy as np
from pyspark.sql import functions as F

from tieout.llm.neighbours import Settings, nearest_neighbours, scan


def exact(rows, k=20):
    out = {}
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    for i, v in rows:
        if i % 20 == 0:
            score = (x * np.array(v, np.float64)).sum(axis=1)
            keep = ids != i
            order = np.lexsort((ids[keep], -score[keep]))[:k]
            out[i] = list(zip(ids[keep][order].tolist(), score[keep][order].tolist(), strict=True))
    return out


def run(spark, rows, settings=None):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in sorted(nearest_neighbours(df, F.col("vec_id") % 20 == 0, settings).collect(), key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    return got


def test_recall_on_the_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = exact(rows)
    got = run(spark, rows)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (20 * len(want)) >= 0.9
    scores = {q: dict(v) for q, v in want.items()}
    for q, found in got.items():
        assert [s for _, s in found] == sorted((s for _, s in found), reverse=True)
        assert all(abs(s - scores[q][i]) < 1e-12 for i, s in found if i in scores[q])


def test_all_lists_and_many_copies(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((120, 8)).astype(np.float32)
    rows = [(i, x[i % 40 if i < 90 else 0].tolist()) for i in range(300)]
    sure = Settings(lists=4, probes=4, candidates=16, queries=2, errors=50.0)
    assert run(spark, rows, sure) == exact(rows)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [1.0, None]), (None, [1.0, 0.0]), (8, [1.0, 0.0, 3.0]), (20, [1.0, 0.0]), (1, [0.5, 0.5]),
            (40, [0.0, 0.0])]
    assert run(spark, rows) == {0: [(20, 1.0), (1, 0.5)], 20: [(0, 1.0), (1, 0.5)]}
    assert run(spark, []) == {}
    assert run(spark, [(0, [1.0, 2.0])]) == {}


def test_scan_keeps_the_nearest():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((2000, 65))
    kept = 0
    for _ in range(20):
        q = rng.standard_normal(65)
        near = np.argsort(((x - q) ** 2).sum(axis=1))[:20]
        rows = scan(x, q, 20, 16, 3.0)
        assert len(rows) < 1500
        kept += np.isin(near, rows).sum()
    assert kept >= 395
