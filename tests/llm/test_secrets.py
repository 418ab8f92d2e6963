import hashlib
import random
import re

from tests.llm.frames import docs_df
from tieout.llm import secrets as se

FIXED = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
               lambda m: len(m[2]) >= 6),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
}


def base(text):
    """Brute force: the contract's patterns, run as they are written."""
    found = []
    for order, (kind, (pattern, holds)) in enumerate(FIXED.items()):
        found += [(m.start(), order, kind, m.end()) for m in re.finditer(pattern, text or "", re.A) if holds(m)]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def texts():
    rng = random.Random(8)
    parts = ["token", "secret:token:abcdefg", "PassWord = 'x1y2z3w4'", "api_key=", "apikey: \"", "AKIA", "AKIAAKIA" * 3,
             "AKIA" + "B7" * 8, "a1b2c3d4" * 3, "deadbeef" * 5, "é", "日本", "\n", " ", "= ", ":", "abc", "passwd:12345",
             "passwd:123456", "token=token=abcdefgh", "x" * 30, "0" * 23, "f" * 24, "Secret='", "_.=-", "😀"]
    yield from ["", None, "   ", "no secrets here", "a" * 24, "token: " + "Z" * 20_000 + " " + "word " * 20_000]
    for _ in range(300):
        yield "".join(rng.choices(parts, k=rng.randrange(1, 15)))


def test_base_spans_match_the_patterns(spark):
    rows = list(enumerate(texts()))
    got = {r.doc_id: r for r in se.secrets_digest(docs_df(spark, *rows, extra=True)).collect()}
    assert len(got) == len(rows)
    for doc_id, text in rows:
        want = base(text)
        r = got[doc_id]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == n for k, _, _ in want) for n in FIXED]
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        spans = [tuple(x.split(":")) for x in r.spans.split(",") if x]
        assert [(k, int(s), int(e)) for k, s, e in spans if k != "markov"] == want
        places = [(int(s), se.KINDS.index(k)) for k, s, _ in spans]
        assert places == sorted(places)
        for k, s, e in spans:
            if k == "markov":
                assert re.fullmatch(se.CANDIDATE, text[int(s) : int(e)])
                assert all(int(e) <= a or b <= int(s) for _, a, b in want)


def test_random_strings_stand_out(spark):
    rng = random.Random(1)
    syllables = ["ing", "ther", "tion", "er", "com", "put", "load", "file", "name", "user"]
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"

    def word():
        return "".join(rng.choices(syllables, k=rng.randrange(2, 7)))

    def noise(n):
        return "".join(rng.choices(letters, k=n))

    rows = [(i, " ".join(word() for _ in range(60))) for i in range(60)]
    rows += [(100 + i, f"{word()} token={noise(32)} {word()}") for i in range(200)]
    held = [(1000 + i, f"{word()} {word()} {noise(30)} {word()}") for i in range(40)]
    plain = [(2000 + i, "".join(rng.choices(syllables, k=7)) + " " + word()) for i in range(40)]
    got = {r.doc_id: r.n_markov for r in se.find_secrets(docs_df(spark, *rows, *held, *plain)).collect()}
    assert sum(got[d] == 1 for d, _ in held) >= 38
    assert sum(got[d] == 0 for d, _ in plain) >= 39


def test_awkward_tables(spark):
    assert se.secrets_digest(docs_df(spark)).count() == 0
    got = se.secrets_digest(docs_df(spark, (None, None), (1, "x"), (1, "x"))).collect()
    assert sorted((r.doc_id or 0, r.n_hex, r.spans) for r in got) == [(0, 0, ""), (1, 0, ""), (1, 0, "")]


def test_no_python_in_the_plan(spark):
    plan = se.secrets_digest(docs_df(spark, (1, "token=abcdefgh")))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_long_texts_with_many_spans(spark):
    word = "0123456789abcdef01234567"
    text = " ".join(f"{word}{i % 10}" for i in range(150_000))  # nearly 4 MB of hex words
    docs = docs_df(spark, (1, text), (2, "token=abcdefgh1 " * 40_000))
    got = {r.doc_id: r for r in se.secrets_digest(docs).collect()}
    assert (got[1].n_hex, got[2].n_assign) == (150_000, 40_000)
    assert got[1].base_sha256 == hashlib.sha256(",".join(f"hex:{26 * i}:{26 * i + 25}" for i in range(150_000)).encode()).hexdigest()


def sampled_docs():
    """Labelled secrets, words that texts share, and strings of both sorts to be told apart."""
    rng = random.Random(4)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"
    shared = ["".join(rng.choices(["ra", "ne", "sto", "lin", "ka", "de", "mo"], k=rng.randrange(2, 9))) for _ in range(150)]
    rows = [(i, " ".join(rng.choices(shared, k=50))) for i in range(80)]
    rows += [(100 + i, f"{rng.choice(shared)} secret: {''.join(rng.choices(letters, k=rng.randrange(12, 40)))} é") for i in range(150)]
    for i in range(120):
        parts = [rng.choice(["é", "日本", ",", "token=abcdef99", "f" * 30, rng.choice(shared), "-" * 20,
                             "".join(rng.choices(letters, k=rng.randrange(14, 30)))]) for _ in range(rng.randrange(1, 9))]
        rows.append((300 + i, rng.choice([" ", ", "]).join(parts)))
    return rows


def test_markov_spans_against_plain_python(spark):
    rows = sampled_docs()
    docs = docs_df(spark, *rows)
    model = se.fit(docs, se.Settings())
    assert model.limit is not None
    found = 0
    for r in se.secrets_digest(docs).collect():
        text, want = dict(rows)[r.doc_id], []
        taken = [(s, e) for _, s, e in base(text)]
        for m in re.finditer(se.CANDIDATE, text):
            codes = [ord(c) - se.FIRST for c in m[0]]
            mean = sum(model.ratios[a * se.WIDTH + b] for a, b in zip(codes, codes[1:], strict=False)) / (len(codes) - 1)
            if mean > model.limit and not any(s < m.end() and m.start() < e for s, e in taken):
                want.append(f"markov:{m.start()}:{m.end()}")
        assert [x for x in r.spans.split(",") if x.startswith("markov")] == want
        found += len(want)
    assert found > 50


def test_running_totals(spark):
    for n in (0, 1, 2, 3, 7, 8, 100):
        df = spark.createDataFrame([([(7 * i) % 11 - 5 for i in range(n)],)], "v array<int>")
        values = df.first().v
        sums, tops = df.select(se.running(se.F.col("v"), 0, lambda x, y: x + y), se.running(se.F.col("v"), -99, lambda x, y: se.F.greatest(x, y))).first()
        assert sums == [sum(values[: i + 1]) for i in range(n)] and tops == [max(values[: i + 1]) for i in range(n)]


def test_without_samples_only_the_patterns_speak(spark):
    got = se.find_secrets(docs_df(spark, (1, "Zk3Qx9Lm2Pv7Tb5Rw8 words"), (2, "token=abcdef12"))).collect()
    assert sorted((r.doc_id, r.n_markov, r.spans) for r in got) == [(1, 0, ""), (2, 0, "assign:0:14")]
