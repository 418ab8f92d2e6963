import random

from tests.llm.frames import docs_df
from tieout.llm.licenses import TEMPLATES, Template, best_alignment, chain, find_licenses, patience, stretches, words


def longest(pairs):
    best = [[] for _ in pairs]
    for i, (a, b) in enumerate(pairs):
        before = max((best[j] for j in range(i) if pairs[j][0] < a and pairs[j][1] < b), key=len, default=[])
        best[i] = [*before, (a, b)]
    return max(map(len, best), default=0)


def test_chain_is_a_longest_increasing_one():
    rng = random.Random(6)
    for _ in range(100):
        places = list(range(rng.randrange(12)))
        rng.shuffle(places)
        pairs = list(enumerate(places))
        got = chain(pairs)
        assert len(got) == longest(pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))


def test_alignment_is_increasing_and_equal():
    rng = random.Random(7)
    for _ in range(100):
        a, b = (rng.choices("abcdefgh", k=rng.randrange(20)) for _ in range(2))
        got = patience(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))
    unique = [f"w{i}" for i in range(30)]
    assert len(patience(["x", *unique[:10], "y", *unique[10:]], unique)) == 30
    assert patience(["a", "a", "b"], ["a", "a", "b"]) == [(0, 0), (1, 1), (2, 2)]


def test_scan(spark):
    mit = TEMPLATES["mit-permission"]
    broken = mit.replace("sublicense", "subl1cense").replace("furnished", "given")
    docs = docs_df(
        spark, (1, f"Some text. {TEMPLATES['mit-notice']} More."), (2, "released the under license mit"), (3, None), (4, ""),
        (5, "prose " * 30_000 + broken + " prose" * 30_000), (6, TEMPLATES["cc-by-nc-4.0-notice"] * 2),
        (None, TEMPLATES["mit-notice"]), (7, TEMPLATES["apache-2.0-header"]), (7, TEMPLATES["apache-2.0-header"]),
        extra=True,
    )
    got = {}
    for r in find_licenses(docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert {k: sorted({r.license for r in v}) for k, v in got.items()} == {
        1: ["mit-notice"], 5: ["mit-permission"], 6: ["cc-by-nc-4.0-notice"], None: ["mit-notice"],
        7: ["apache-2.0-header", "apache-2.0-notice"],
    }
    assert len(got[7]) == 4
    n = len(words(mit))
    assert abs(got[5][0].coverage - (n - 2) / n) < 1e-9
    assert (got[1][0].first_word, got[1][0].end_word, got[1][0].coverage) == (2, 7, 1.0)
    assert find_licenses(docs_df(spark)).count() == 0
    assert find_licenses(docs, {"none": ""}).count() == 0


def test_an_edited_licence_is_found_wherever_it_stands():
    own = words(TEMPLATES["mit-permission"])
    template = Template("mit", " ".join(own))
    for extra, dropped in ((1.3, 0.15), (1.8, 0.1), (3.0, 0.15)):
        rng = random.Random(5)
        edited = [w for w in own if rng.random() > dropped]
        while len(edited) < extra * len(own):
            edited.insert(rng.randrange(1, len(edited)), f"x{len(edited)}")
        got = set()
        for at in range(0, 2 * len(own) + 5, 7):
            text = ["zz", "the", "qq", "of", "vv"] * 400
            text = text[: 5 * at] + edited + text[5 * at :]
            coverage, first, end = best_alignment(text, template, 0.8)
            got.add((coverage, first - 5 * at, end - 5 * at))
        assert len(got) == 1, got
        assert got.pop()[0] >= 0.8


def test_every_template_is_found_whole(spark):
    rows = [(i, f"some words before {text.upper()} and some after") for i, text in enumerate(TEMPLATES.values())]
    got = {(r.doc_id, r.license): r for r in find_licenses(docs_df(spark, *rows)).collect()}
    for i, name in enumerate(TEMPLATES):
        assert got[i, name].coverage == 1.0 and got[i, name].first_word == 3


def test_scans_find_what_a_plain_alignment_covers():
    rng = random.Random(6)
    templates = [Template(n, t) for n, t in TEMPLATES.items()]
    seen = 0
    for _ in range(300):
        t = rng.choice(templates)
        own = [w for w in t.words if rng.random() > 0.12]
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(own) + 1)
            own[at:at] = words("the of and filler words in a text")[: rng.randrange(1, min(6, len(t.words)))]
        own = ["x"] * rng.randrange(5) + own + ["the", "y"] * rng.randrange(5)
        plain = len(patience(own, t.words)) / len(t.words)
        found = best_alignment(own, t, 0.8)
        if plain >= 0.8 and len(list(stretches(own, t))) == 1:  # no break longer than the template
            seen += 1
            assert found is not None and found[0] >= plain - 1e-9
            assert own[found[1]] in t.counts and own[found[2] - 1] in t.counts
    assert seen > 100
