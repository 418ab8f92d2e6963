import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.frames import docs_df
from tieout.llm.packing import TokenIds, best_fit, default_tokenizer, intervals, pack_documents, plan, token_pieces

TEXTS = ["", None, "Hello, World's!  It's\tfine\n\n42 don't we'LL ''s x's's", "ÄÖÜß é×÷ ªº ² naïve", "日本 text ﬁ",
         "é <|endoftext|> a b", "a" * 5000, "-- '' ... !!!'t", "\x1f\x85 x", "İstanbul ſ Σς"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(default_tokenizer())


def test_ids_are_those_of_the_tokenizer(tokenizer, spark, folder):
    texts = [t or "" for t in TEXTS] + [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = TokenIds(default_tokenizer()).of(texts)
    for text, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def check(rows, pieces, tokenizer, size):
    by_sequence, per_doc = {}, {}
    for r in pieces:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        per_doc.setdefault(r.doc_id, []).append(r)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        own = sorted(per_doc[doc_id], key=lambda r: r.piece)
        assert [r.start for r in own] == list(range(0, len(ids), size))
        for r in own:
            part = ids[r.start : r.start + size]
            assert (r.length, r.ids_crc32) == (len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
            if hasattr(r, "ids"):
                assert r.ids == part
    return len(by_sequence)


@pytest.mark.parametrize("size", [7, 64, 4096])
def test_round_trip(spark, tokenizer, size):
    rng = random.Random(size)
    texts = TEXTS + [" ".join(rng.choices(["a", "bb", "word", "x1"], k=rng.randrange(60))) for _ in range(120)]
    rows = list(enumerate(texts))
    docs = docs_df(spark, *rows, extra=True).repartition(5)
    pieces = pack_documents(docs, size=size, ids=True).collect()
    n = check(rows, pieces, tokenizer, size)
    assert n <= -(-sum(r.length for r in pieces) // size) * 1.05 + 1


def test_awkward_rows(spark):
    got = pack_documents(docs_df(spark, (None, None), (1, "a"), (1, "a"), (2, ""))).collect()
    assert sorted((r.doc_id or 0, r.piece, r.length) for r in got) == [(0, 0, 1), (1, 0, 2), (1, 0, 2), (2, 0, 1)]
    assert len({r.sequence_id for r in got}) == 1
    assert pack_documents(docs_df(spark)).count() == 0
    assert token_pieces(docs_df(spark, (1, "x " * 50_000))).count() == 13


@pytest.mark.parametrize("kind", ["uniform", "long", "half", "third", "empty", "full"])
def test_plans_place_every_piece_once(kind):
    rng = np.random.default_rng(3)
    size = 4096
    lengths = {
        "uniform": rng.integers(1, size + 1, 3000), "long": rng.integers(2500, size + 1, 500),
        "half": np.full(101, 2049), "third": rng.choice([1365, 1366, 1367, 1], 900), "empty": np.empty(0, int),
        "full": np.full(10, size),
    }[kind]
    counts = np.bincount(lengths, minlength=size + 1)
    planned = plan(counts)
    placed = np.zeros(size + 1, int)
    for pattern, n in planned:
        assert sum(pattern) <= size and n > 0
        np.add.at(placed, list(pattern), n)
    assert (placed == counts).all()
    used = sum(n for _, n in planned)
    assert used <= sum(n for _, n in best_fit(counts)) + 2
    if kind == "uniform":
        assert used <= np.ceil(lengths.sum() / size) * 1.02
    rows = intervals(planned)
    assert len(rows) == 0 or (np.diff(rows[:, 0]) >= 0).all()
