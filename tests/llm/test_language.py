import numpy as np
import pytest

from tests.llm.frames import docs_df
from tieout.llm.language import Pairwise, Settings, features, identify_language, svm


@pytest.fixture(scope="module")
def found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return docs.join(identify_language(docs), "doc_id").collect()


def test_held_out_accuracy(found):
    held = [r for r in found if r.held_out]
    assert len(found) == 1000 and 250 < len(held) < 420
    assert sum(r.lang == r.lang_pred for r in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_awkward_rows(spark):
    rows = [(i, "the cat and the dog are here", "en") for i in range(30)]
    rows += [(100 + i, "der Hund und die Katze sind da", "de") for i in range(30)]
    rows += [(200 + i, "le chien et le chat sont ici", "fr") for i in range(30)]
    odd = [(None, "the dog", "en"), (901, None, "en"), (902, "", "en"), (903, "123 !?", "de"), (904, "der Hund", None),
           (905, "le chat " * 40_000, None), (905, "le chat " * 40_000, None), (906, "日本語", None)]
    got = identify_language(docs_df(spark, *rows, *odd, extra=True)).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r.doc_id: r for r in got}
    assert (by[None].lang_pred, by[None].held_out) == ("en", False)
    assert all((by[i].lang_pred, by[i].score) == ("und", 0.0) for i in (901, 902, 903))
    assert by[904].lang_pred == "de" and by[905].lang_pred == "fr"
    assert by[906].lang_pred in {"en", "de", "fr"}
    assert identify_language(docs_df(spark)).count() == 0
    nothing = identify_language(docs_df(spark, (1, "words", None))).collect()
    assert [(r.lang_pred, r.score) for r in nothing] == [("und", 0.0)]
    one = identify_language(docs_df(spark, (1, "words", "en"), (2, "words", "en"), (3, "words", "en"))).collect()
    assert {r.lang_pred for r in one} == {"en"}


def test_features_are_shares():
    f = features("Ab, ab! " * 50)
    assert abs((f * f).sum() - 1) < 1e-5
    assert np.allclose(features("abc def"), features("ABC  --- def"), atol=1e-6)
    assert features("12 34") is None


def test_svm_separates():
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(1, 0.3, (50, 4)), rng.normal(-1, 0.3, (30, 4))])
    y = np.array([1.0] * 50 + [-1.0] * 30)
    w = svm(x, y, Settings())
    assert (np.sign(x @ w[:-1] + w[-1]) == y).all()
    three = Pairwise(np.vstack([x, rng.normal(5, 0.3, (20, 4))]), np.array(["a"] * 50 + ["b"] * 30 + ["c"] * 20), Settings())
    win, _ = three(np.array([[1.0] * 4, [-1.0] * 4, [5.0] * 4]))
    assert [three.names[i] for i in win] == ["a", "b", "c"]
