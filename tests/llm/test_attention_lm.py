import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.frames import docs_df
from tieout.llm import attention_lm as lm
from tieout.llm.queries import op11_attention_lm

TINY = lm.Settings(block=4, context=3, width=6, hidden=5, classes=3, members=4)


def tiny_model(seed=2):
    rng = np.random.default_rng(seed)
    v = lm.Vocabulary.of(rng.integers(0, 50, 40), TINY)
    p = {k: x + rng.normal(0, 0.3, x.shape).astype(np.float32) for k, x in lm.first_parameters(v, TINY).items()}
    return lm.Model(p, TINY)


def plainly(model, items):
    """Log probabilities of a text's items one by one, without batches or masks."""
    p, s = model.p, model.s
    line, out = [model.start, *items], []
    for t in range(len(items)):
        first = max(0, t // s.block * s.block - s.context)
        seen = line[first : t + 1]
        e = np.array([p["embed"][i] for i in seen], np.float64)
        q = e[-1] @ p["query"]
        scores = [q @ (e[j] @ p["key"]) / math.sqrt(s.width) + p["distance"][len(seen) - 1 - j] for j in range(len(seen))]
        a = np.exp(np.array(scores) - max(scores))
        h = e[-1] + (a / a.sum()) @ (e @ p["value"])
        z = h + np.maximum(h @ p["enter"] + p["enter_bias"], 0) @ p["leave"]
        kind, member = divmod(items[t], s.members)
        logits = [z @ p["classes"].T + p["class_bias"], z @ p["items"][kind].T + p["item_bias"][kind]]
        out.append(sum(x[i] - np.log(np.exp(x).sum()) for x, i in zip(logits, (kind, member), strict=True)))
    return out


def test_windows_score_each_item_once_with_its_context():
    model, rng = tiny_model(), random.Random(3)
    texts = [[rng.randrange(TINY.items) for _ in range(n)] for n in (1, 4, 5, 23, 8, 2)]
    lengths = np.array([len(t) for t in texts])
    windows = model.windows(np.array([i for t in texts for i in t], np.int32), lengths)
    got = model.log_probabilities(windows)
    there = windows[:, -TINY.block :].ravel() >= 0
    assert np.allclose(got[there], [x for t in texts for x in plainly(model, t)], atol=1e-4)
    assert not got[~there].any()


def test_probabilities_sum_to_one():
    model = tiny_model()
    total = 0.0
    for last in range(TINY.items):
        text = np.array([5, 2, 7, 1, 0, last], np.int32)
        windows = model.windows(text, np.array([6]))
        total += math.exp(model.log_probabilities(windows)[5])
    assert total == pytest.approx(1, abs=1e-4)


def test_gradients_against_differences():
    model, rng = tiny_model(), random.Random(4)
    texts = [[rng.randrange(TINY.items) for _ in range(n)] for n in (9, 3, 14)]
    windows = model.windows(np.array(sum(texts, []), np.int32), np.array([9, 3, 14]))
    model.p = {k: x.astype(np.float64) for k, x in model.p.items()}
    _, g = model.gradients(windows)

    def loss():
        return model.gradients(windows)[0]

    for k, x in model.p.items():
        for _ in range(6):
            at = tuple(rng.randrange(n) for n in x.shape)
            was = x[at]
            x[at] = was + 1e-4
            up = loss()
            x[at] = was - 1e-4
            slope = (up - loss()) / 2e-4
            x[at] = was
            assert g[k][at] == pytest.approx(slope, abs=2e-3), k


def test_rare_ids_share_one_item():
    counts = np.array([9, 0, 7, 1, 3, 0, 2, 5, 4, 1, 1, 0, 0, 0, 6])
    v = lm.Vocabulary.of(counts, lm.Settings(classes=2, members=4))
    assert v.slots[-1] < 7 and sorted(v.slots[[0, 2, 14, 7, 8, 4]].tolist()) == [0, 1, 2, 3, 4, 5]
    rest = np.flatnonzero(v.slots == 7)
    assert np.exp(v.rare[rest]).sum() == pytest.approx(1)
    assert np.exp(v.bias).sum() == pytest.approx(1) and not v.rare[v.slots != 7].any()


def base(docs):
    """doc_id, held_out, n_tokens, n_known, N and base score by counting plainly."""
    crc = {i: zlib.crc32(str(i).encode()) % 7 for i, _ in docs if i is not None}
    tokens = [[*(w.decode() for w in (t or "").encode().lower().split()), None] for _, t in docs]
    c = Counter(w for (i, _), words in zip(docs, tokens, strict=True) if i is not None and crc[i] != 2 for w in words)
    n, v = sum(c.values()), len(c)
    return [
        (i, i is not None and crc[i] == 2, len(words), sum(c[w] > 0 for w in words), n,
         sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words))
        for (i, _), words in zip(docs, tokens, strict=True)
    ]


def scores(spark, docs, **more):
    rows = lm.language_scores(docs_df(spark, *docs, extra=True), **more).collect()
    return sorted([(*tuple(r)[:6],) for r in rows], key=repr), rows


def close(got, want):
    want = sorted(want, key=repr)
    assert [x[:5] for x in got] == [x[:5] for x in want]
    assert np.allclose([x[5] for x in got], [x[5] for x in want], rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("frequent", [10, 50_000])
def test_base_scores_against_counting(spark, monkeypatch, frequent):
    rng = random.Random(5)
    words = ["the", "The", "ÉTÉ", "été", "日本", "x#y", "<|endoftext|>", "a\x85b", "w" * 300] + [f"q{i}" for i in range(300)]
    docs = [(i, " \t\n".join(rng.choices(words, k=rng.choice([0, 1, 5, 80])))) for i in range(120)]
    docs += [(500, None), (501, ""), (502, "\x0b \x0c"), (None, "the q1 unseen"), (3, "twice the id"), (3, "twice the id")]
    got, rows = scores(spark, docs, settings=lm.Settings(frequent=frequent, rounds=1, part=2))
    close(got, base(docs))
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    empty = [r.score for r in rows if r.doc_id in (500, 501, 502)]
    assert len(empty) == 3 and np.ptp(empty) < 1e-5  # only the end is scored
    twice = [r.score for r in rows if r.doc_id == 3 and r.n_tokens == 4]
    assert len(twice) == 2 and twice[0] == pytest.approx(twice[1])


def test_nothing_to_learn_from(spark):
    assert scores(spark, [])[0] == []
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    got, rows = scores(spark, [(held, "a b"), (None, "c")])
    close(got, base([(held, "a b"), (None, "c")]))
    assert all(math.isfinite(r.score) for r in rows)


def test_lots_and_lexicon_restarts_change_nothing(spark, monkeypatch):
    rng = random.Random(8)
    docs = [(i, " ".join(f"w{rng.randrange(200)}" for _ in range(rng.choice([0, 7, 40])))) for i in range(60)]
    few = lm.Settings(rounds=0)
    want, rows = scores(spark, docs, settings=few)
    monkeypatch.setattr(lm, "REMEMBERED", 20)
    monkeypatch.setattr(lm, "DOCS", 3)
    got, again = scores(spark, docs, settings=few)
    close(got, want)
    key = lambda r: r.doc_id
    assert np.allclose([r.score for r in sorted(rows, key=key)], [r.score for r in sorted(again, key=key)], rtol=1e-5)


def test_long_texts_are_scored_whole(spark):
    text = " ".join(f"word{i % 977}" for i in range(60_000))
    docs = [(1, text), (4, text + " " + text)]
    got, rows = scores(spark, docs, settings=lm.Settings(rounds=0))
    close(got, base(docs))
    by = {r.doc_id: r.score for r in rows}
    assert by[4] == pytest.approx(2 * by[1], rel=1e-2)


def test_the_model_learns_order(spark):
    """Words follow each other in a cycle: only a model that reads the words before knows."""
    rng = random.Random(9)
    words = ["red", "green", "blue", "white", "black", "grey", "pink", "gold"]
    docs = []
    for i in range(1500):
        at = rng.randrange(8)
        docs.append((i, " ".join(words[(at + k) % 8] for k in range(40))))
    _, rows = scores(spark, docs, settings=lm.Settings(part=4))
    held = [r for r in rows if r.held_out]
    assert len(held) > 100
    assert sum(r.score for r in held) > 0.5 * sum(r.base_score for r in held)


def test_every_training_document_is_learned_from(spark, monkeypatch):
    """Ids are counted in all of them, and each is read in one of the rounds."""
    counted, read = [], []
    id_counts, one_round = lm._id_counts, lm._round

    def counts(texts, n_ids):
        counted.append(id_counts(texts, n_ids))
        return counted[-1]

    def rounds(texts, *more):
        read.append(texts.count())
        return one_round(texts, *more)

    monkeypatch.setattr(lm, "_id_counts", counts)
    monkeypatch.setattr(lm, "_round", rounds)
    docs = [(i, f"one text of words w{i}") for i in range(300)] + [(None, "of no fold"), (4, "twice"), (5, None)]
    scores(spark, docs)
    training = sum(i is not None and zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in docs)
    assert counted[0][-1] == training == sum(read) and min(read) > 0


def test_stored_ids_are_read_in_lots(monkeypatch):
    monkeypatch.setattr(lm, "IDS", 5)
    texts = [[1, 2], [], [3] * 9, [4], [5, 6, 7, 40_000], []]
    column = pa.array([np.array(t, np.uint16).tobytes() for t in texts], pa.binary())
    lots = [(rows, ids.tolist(), n.tolist()) for rows, ids, n in lm._id_lots(column, np.uint16)]
    assert [i for _, ids, _ in lots for i in ids] == sum(texts, []) and len(lots) > 2
    assert [n for *_, lengths in lots for n in lengths] == [len(t) for t in texts]
    assert [i for rows, *_ in lots for i in range(6)[rows]] == [0, 1, 2, 3, 4, 5]
    assert lm._code(65_535) is np.uint16 and lm._code(65_536) is np.uint32


def test_words_of_a_lot_are_looked_up_once(spark, monkeypatch):
    """Whatever stands often in a lot is split and told apart by Arrow, not word by word."""
    asked = []
    numbers = lm.Lexicon.numbers

    def recorded(self, words):
        asked.append(list(words))
        return numbers(self, words)

    monkeypatch.setattr(lm.Lexicon, "numbers", recorded)
    monkeypatch.setattr(lm, "found_by_tasks", lambda spark: None)
    texts = [" The the\t\x0bTHE cat ", None, "", " \n", "x\x85Y\xa0Z\x1cq É é", "the cat\x0c"] * 3
    lots = list(lm._lots(pa.array(texts)))
    lexicon = lm.Lexicon()
    words = [lexicon.numbers(found)[places] for _, found, places, _ in lots]
    back = {number: word for word, number in lexicon.items()}
    plain = [(t or "").encode().lower().split() for t in texts]
    assert [back[i] for i in np.concatenate(words).tolist()] == sum(plain, [])
    assert [n for *_, sizes in lots for n in sizes.tolist()] == [len(x) for x in plain]
    assert asked and all(len(set(x)) == len(x) for x in asked) and b"" not in lexicon
    counts = {r["key"]: r["n"] for r in lm.word_counts(docs_df(spark, *enumerate(texts))).collect()}
    assert counts == {h: sum(plain, []).count(w) for w, h in zip(lexicon, lexicon.hashes.tolist(), strict=True)}


def test_lots_of_texts_end_where_they_are_full(monkeypatch):
    texts = pa.array(["", "ab cd", None, "e" * 50, "f", "g", "h i"])
    whole = list(lm._lots(texts))
    assert [x[0] for x in whole] == [slice(0, 7)] and not list(lm._lots(texts[:0]))
    monkeypatch.setattr(lm, "BYTES", 6)
    assert [x[0] for x in lm._lots(texts)] == [slice(0, 3), slice(3, 4), slice(4, 7)]
    monkeypatch.setattr(lm, "DOCS", 2)
    lots = list(lm._lots(texts[1:]))
    assert [x[0] for x in lots] == [slice(0, 2), slice(2, 3), slice(3, 5), slice(5, 6)]
    assert [[x[1][i] for i in x[2]] for x in lots] == [[b"ab", b"cd"], [b"e" * 50], [b"f", b"g"], [b"h", b"i"]]


def test_gradients_in_lots_are_those_of_the_whole(monkeypatch):
    model, rng = tiny_model(), random.Random(6)
    lengths = [rng.choice([1, 3, 9, 30]) for _ in range(40)]
    items = [min(rng.randrange(TINY.items), rng.randrange(TINY.items)) for _ in range(sum(lengths))]
    windows = model.windows(np.array(items, np.int32), np.array(lengths))
    model.p = {k: x.astype(np.float64) for k, x in model.p.items()}
    loss, g = model.gradients(windows)
    logs = model.log_probabilities(windows)
    assert loss == pytest.approx(-logs.sum() / len(items), rel=1e-5)
    monkeypatch.setattr(lm, "BATCH", 7)
    monkeypatch.setattr(lm, "ROWS", 5)
    again, parts = model.gradients(windows)
    assert again == pytest.approx(loss) and all(np.allclose(g[k], parts[k]) for k in g)
    assert np.allclose(model.log_probabilities(windows), logs, atol=1e-6)


def test_large_logits_are_held():
    logits = np.array([[500, 0, 60], [1, 2, 3]], np.float32)
    want = [-math.log(2), -math.log(1 + math.exp(-1) + math.exp(-2))]
    assert np.allclose(lm._log_chosen(logits.copy(), np.array([0, 2])), want)
    assert lm._shares_less_chosen(logits, np.array([0, 2])) == pytest.approx(-sum(want))
    assert np.allclose(logits[0], [-0.5, 0, 0.5])


def test_sums_by_number(monkeypatch):
    rng = np.random.default_rng(7)
    numbers, rows = rng.integers(0, 9, 200) ** 2, rng.normal(size=(200, 6)).astype(np.float32)
    want = np.zeros((70, 6))
    np.add.at(want, numbers, rows)
    for size in (1, 16, 1_024):
        monkeypatch.setattr(lm, "ROWS", size)
        assert np.allclose(lm._sums_by(numbers, rows, 70), want, atol=1e-4)
    assert not lm._sums_by(numbers[:0], rows[:0], 70).any()


def test_held_out_texts_of_the_given_table(spark):
    rows = op11_attention_lm(spark, "/root/testdata/sf0.01").collect()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    close(sorted([tuple(r)[:6] for r in rows], key=repr), base([tuple(r) for r in docs]))
    # what was learned holds for texts that were not; the untrained model knows how frequent ids are
    untrained = lm.language_scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), settings=lm.Settings(rounds=0))
    before = sum(r.score for r in untrained.collect() if r.held_out)
    assert sum(r.score for r in rows if r.held_out) > 0.9 * before
