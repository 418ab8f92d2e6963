import random

import numpy as np
import pytest

from tests.llm.frames import docs_df
from tieout.llm.common import WordHashes, ascii_words, shingle_hashes
from tieout.llm.components import connected
from tieout.llm.near_dups import CELLS, near_duplicates, parity_map, prefix_keys, superminhash


def groups(rows, n, num, den):
    """Brute force: all pairs, union-find."""
    sets = []
    for _, text in rows:
        w = ascii_words(text)
        sets.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return {(d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))}


def variants(rng, base, n, most):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(most + 1)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_groups_match_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for size in (6, 30, 80, 150):
        texts += variants(rng, rng.choices(words, k=size), 25, 1 + size // 20)
    texts += texts[:10] + ["", None, " \t\n", "one", "One", "two words", "two  WORDS", "É é", "é É"]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    for n, num, den in ((3, 85, 100), (5, 80, 100)):
        got = near_duplicates(docs_df(spark, *rows, extra=True), n, num, den).collect()
        assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == groups(rows, n, num, den)
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)
        assert len(got) == len(rows)


def test_awkward_rows(spark):
    rows = [(None, "a b c d"), (3, "a b c d"), (3, "a b c d"), (2, "A B C D"), (7, None), (8, ""),
            (9, "x"), (9, "y y"), (10, "y y")]
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept)
           for r in near_duplicates(docs_df(spark, *rows), 3, 85, 100).collect()}
    assert got == {(None, 2, None, True), (3, 2, 2, False), (2, 2, 2, True), (7, 0, 7, True), (8, 0, 8, True),
                   (9, 1, 9, True), (10, 1, 9, False)}
    assert near_duplicates(docs_df(spark)).count() == 0


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 400).astype(np.uint64)
    b = np.concatenate([a[:300], rng.integers(0, 2**63, 100).astype(np.uint64)])
    sets = [np.unique(a), np.unique(b), np.unique(a[:5])]
    owner = np.repeat(np.arange(3), [len(s) for s in sets])
    s = superminhash(np.concatenate(sets), owner, 3, 200)
    assert abs((s[0] == s[1]).mean() - 300 / 500) < 0.12
    assert np.isfinite(s).all()
    # a signature does not depend on what else is in the batch
    assert (superminhash(sets[2], np.zeros(5, int), 1, 200)[0] == s[2]).all()


def test_signature_is_the_minimum_over_whole_permutations():
    from tieout.llm.common import mixed, salt

    m, grams = 16, np.array([3, 99, 12345, 7], np.uint64)
    best = np.full(m, np.inf)
    for h in grams:
        perm = list(range(m))
        for j in range(m):
            x = int(mixed(np.array([h + salt(j + 1)]))[0])
            k = j + (x & 0xFFFFFFF) % (m - j)
            perm[j], perm[k] = perm[k], perm[j]
            best[perm[j]] = min(best[perm[j]], (x >> 12) / 2**52 + j)
    assert np.allclose(superminhash(grams, np.zeros(4, int), 1, m)[0], best)


def test_bounds_are_exact():
    rng = random.Random(2)
    order = np.zeros(CELLS, np.int64)
    for _ in range(300):
        size = rng.randrange(3, 200)
        a = [rng.randrange(10**12) for _ in range(size)]
        b = a[: rng.randrange(size // 2, size + 1)] + [rng.randrange(10**12) for _ in range(rng.randrange(size // 5 + 1))]
        x, y = (np.unique(np.array(s, np.uint64)) for s in (a, b))
        both = len(np.intersect1d(x, y))
        differ = sum(int(v).bit_count() for v in (parity_map(x) ^ parity_map(y)).view(np.uint64))
        assert differ <= len(x) + len(y) - 2 * both
        if 100 * both >= 85 * (len(x) + len(y) - both):
            assert np.isin(prefix_keys(x, order, 85, 100), prefix_keys(y, order, 85, 100)).any()


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 300), (300, 100), (7, 7), (500, 501)]
    got = connected(spark.createDataFrame(edges, "u long, v long")).collect()
    want = {i: 0 for i in range(61)} | {100: 100, 200: 100, 300: 100, 500: 500, 501: 500}
    assert {r.node: r.component for r in got} == want and len(got) == len(want)
    assert connected(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("text, n", [("", 0), ("a", 1), ("a b", 1), ("a b c", 1), ("a b c a b c", 3)])
def test_shingles(text, n):
    assert len(shingle_hashes(ascii_words(text), 3, WordHashes())) == n
