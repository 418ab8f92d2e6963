import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from tieout.llm import filter_audit as fa
from tieout.llm.queries import op13_filter_transducer

LABELS = "doc_id long, quality int, toxic int"
WORD = re.compile("[^\x20\x09-\x0d]+")
AWKWARD = ["", " ", "a", "Über straße ß", "日本語 日本語 x", "  a b", "😀 😀😀", "A B C", "#", "a\tb\x0bc\x0cd\re\nf\x1cg",
           "w" * 200 + " " + "w" * 200 + " " + "w" * 199 + "v", "abcdefgh abcdefgi abcdefg abcdefghi", "x\x00 x x\x00"]


def facts(text):
    words = WORD.findall(text)
    return (len(words), len(set(words)), len(text), len(re.findall("[A-Z]", text)), len(re.findall(r"[#$%&*|]", text)))


def brute(rows, labels):
    """rows: (doc_id, text, source); labels: {doc_id: (quality, toxic)}."""
    docs, least = [], {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    for i, t, s in rows:
        w, d, n, c, y = facts(t or "")
        fails = {"A": w < 50, "B": 100 * d < 65 * w, "C": 100 * c > 5 * n, "D": y > 0,
                 "E": i is not None and i > least[t or ""]}
        docs.append((s or "", {k for k, v in fails.items() if v}, *labels.get(i, (0, 0))))
    out = Counter()
    for part in {d[0] for d in docs}:
        for order in permutations("ABCDE"):
            left = [d for d in docs if d[0] == part]
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                redundant = sum(f in d[1] for d in docs if d[0] == part) - len(gone)
                left = [d for d in left if f not in d[1]]
                only = sum(d[1] == {f} for d in docs if d[0] == part)
                key = (part, "".join(order), step)
                out[key] = [len(left), len(gone), redundant, only, sum(d[2] for d in gone), sum(d[3] for d in gone)]
    total = Counter()
    for (part, order, step), v in out.items():
        total[part, order[step - 1]] += v[1]
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audit(spark, rows, labels):
    docs = spark.createDataFrame([(r[0], r[1], r[2], "x", "y") for r in rows],
                                 "doc_id long, text string, source string, mask string, part string")
    marks = spark.createDataFrame([(k, *v) for k, v in labels.items()], LABELS)
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in fa.filter_audit(docs, marks).collect()}


def test_transducer_needs_one_byte_of_memory():
    assert all(fa.NEXT[c] == (fa.BETWEEN if c == fa.GAP else fa.INSIDE) for c in range(6))
    assert {chr(b) for b in range(256) if fa.CLASS_OF[b] == fa.GAP} == set(" \t\n\x0b\x0c\r")


def run_pass(texts):
    raw = [t.encode() for t in texts]
    data, ends = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(r) for r in raw])
    counts, first, last = fa.transduce(data, ends)
    text = np.repeat(np.arange(len(texts)), counts["words"])
    words = fa.WordTable(data, first, last, text)
    spans = [bytes(data[a:b]).decode() for a, b in zip(first, last, strict=True)]
    return counts, words, spans


def test_pass_over_awkward_and_random_texts():
    rng = random.Random(5)
    letters = "aabbAZ  \t\n#|é日😀 \x85"
    texts = AWKWARD + ["".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(400)]
    counts, words, spans = run_pass(texts)
    counts["distinct"] = words.distinct(len(texts))
    got = list(zip(*(counts[k].tolist() for k in ("words", "distinct", "code_points", "capitals", "symbols")), strict=True))
    assert got == [facts(t) for t in texts]
    assert spans == [w for t in texts for w in WORD.findall(t)]


def test_words_are_compared_not_only_hashed(monkeypatch):
    rng = random.Random(6)
    texts = [" ".join("".join(rng.choices("ab", k=rng.choice([1, 3, 9, 17, 80]))) for _ in range(60)) for _ in range(8)]
    monkeypatch.setattr(fa.WordTable, "hashes", lambda self: np.zeros(len(self.first), np.uint64))
    _, words, _ = run_pass(texts)
    assert words.distinct(8).tolist() == [len(set(t.split())) for t in texts]


@pytest.mark.parametrize("size", [1, 64, 1 << 20])
def test_audit_against_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(fa, "SLICE", size)
    rng = random.Random(7)
    pool = [" ".join(rng.choices(["aa", "Bb", "cc", "dd#", *map(str, range(40))], k=rng.choice([3, 49, 50, 90])))
            for _ in range(12)] + AWKWARD
    rows = [(rng.randrange(400) if rng.random() < 0.95 else None, rng.choice([None, *pool]),
             rng.choice([None, "", "s1", "s2"])) for _ in range(300)]
    rows += [(7, pool[0], "s1")] * 3
    labels = {i: (rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 400, 2)}
    want = brute(rows, {k: (v[0] or 0, v[1] or 0) for k, v in labels.items()})
    assert audit(spark, rows, labels) == want


def test_empty_tables_and_repeated_labels(spark):
    assert audit(spark, [], {}) == {}
    docs = spark.createDataFrame([(1, "a b", "s")], "doc_id long, text string, source string")
    marks = spark.createDataFrame([(1, 0, 1), (1, 1, None), (None, 1, 1)], LABELS)
    first = [r for r in fa.filter_audit(docs, marks).collect() if r.filter_order == "ABCDE" and r.step == 1]
    assert [tuple(r)[3:] for r in first] == [(0, 1, 0, 1, 1, 1, 120)]


def test_long_text_is_read_whole(spark):
    text = " ".join(f"w{i}" for i in range(300_000)) + " #"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string").selectExpr("*", "'s' as source")
    row = fa.filter_failures(docs).first()
    assert (row.words, row.distinct_words, row.symbols, row["mask"]) == (300_001, 300_001, 1, 8)


def test_registered_query(spark):
    rows = op13_filter_transducer(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 600 * len({r.part for r in rows})
    assert all(r.kept + r.removed >= 0 and r.shapley >= r.removed for r in rows)
