import random
import zlib

from tests.llm.frames import docs_df
from tieout.llm.toxicity import segments, solve_lambda, toxicity


def all_maximal(values):
    """Brute force by definition: take the best segment, then go on left and right of it."""
    best = None
    for i in range(len(values)):
        total = 0.0
        for j in range(i, len(values)):
            total += values[j]
            # the shortest of the best, the first of these
            if total > 0 and (best is None or total > best[2] + 1e-12):
                best = (i, j + 1, total)
    if best is None:
        return []
    i, j, _ = best
    return (all_maximal(values[:i]) + [best]
            + [(a + j, b + j, t) for a, b, t in all_maximal(values[j:])])


def test_segments_match_brute_force():
    rng = random.Random(3)
    for _ in range(200):
        n, drift = rng.randrange(1, 25), rng.choice([0.3, 0.7, 1.1])
        hits = [(i, rng.uniform(-2, 4)) for i in range(n) if rng.random() < 0.5]
        values = [-drift] * n
        for i, s in hits:
            values[i] += s
        got = segments(hits, drift)
        want = all_maximal(values)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert all(abs(g[2] - w[2]) < 1e-9 for g, w in zip(got, want, strict=True))


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def corpus(n=600):
    rng = random.Random(9)
    plain = [f"word{i}" for i in range(80)]
    for i in range(n):
        words = rng.choices(plain, k=rng.randrange(20, 200))
        toxic = i % 6 == 0
        if toxic:
            at = rng.randrange(len(words))
            words[at:at] = rng.choices(["vile", "rotten", "nasty"], k=4)
        yield i, " ".join(words), int(toxic)


def test_held_out_and_awkward_rows(spark):
    rows = list(corpus())
    odd = [(None, "vile rotten nasty vile"), (9001, None), (9002, ""), (9003, "word1 " * 50_000 + "vile rotten nasty vile"),
           (9004, "vile rotten nasty vile"), (9004, "vile rotten nasty vile")]
    labels = spark.createDataFrame(
        [(d, 1, t) for d, _, t in rows] + [(None, 1, 1), (1, 1, None), (1, 0, 0), (123456, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    docs = docs_df(spark, *(r[:2] for r in rows), *odd, extra=True)
    got = toxicity(docs, labels).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r.doc_id: r for r in got}
    assert all(r.held_out == (d is not None and fold(d)) for d, r in by.items())
    assert all(r.predicted == (r.score >= 0.5) for r in got)
    wrong = [d for d, _, t in rows if by[d].predicted != t]
    assert len(wrong) <= 3
    assert by[9003].predicted and by[9004].predicted and by[None].predicted
    start = len("word1 ") * 50_000
    assert any(p.start <= start and p.end >= start + 16 for p in by[9003].passages)
    assert by[9001].score == by[9002].score < 0.5
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity(docs, none).where("predicted = 1").count() == 0
    assert toxicity(docs_df(spark), labels).count() == 0


def test_lambda_is_the_root():
    import numpy as np

    p, s = np.array([0.9, 0.1]), np.array([-0.5, 1.5])
    assert abs((p * np.exp(solve_lambda(p, s) * s)).sum() - 1) < 1e-6
