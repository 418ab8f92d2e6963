"""Language ID in two steps: the family first, then one-versus-one linear support vector machines
between the languages of that family, over hashed character n-grams of the whole text."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tieout.llm.common import fold, found_by_tasks, mixed, salt, stored

#: Families of related languages; a language that is not named is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr"),
}
#: Hashed n-gram features, and characters of a text that are hashed at a time.
FEATURES, CHARS = 4096, 1_000_000
LETTER = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class Settings:
    #: Training documents per language, those with the least hashes.
    per_language: int = 1_000
    #: Cost of a margin violation, and passes over the sample.
    cost: float = 8.0
    epochs: int = 12


def _codes(text: str) -> np.ndarray:
    """Code points in lower case; what is not a letter is a blank, runs of blanks are one."""
    c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)
    letter = ((c >= 97) & (c <= 122)) | ((c >= 0xC0) & (c != 0xD7) & (c != 0xF7))
    c = np.where(letter, c, np.uint32(32))
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1]
    return c[keep].astype(np.uint64)


def features(text: str | None) -> np.ndarray | None:
    """Square roots of n-gram shares (n = 1, 2, 3), hashed; None for a text without letters."""
    if not text or not LETTER.search(text):
        return None
    counts = np.zeros(FEATURES)
    for at in range(0, len(text), CHARS):
        c = _codes(text[at : at + CHARS])
        gram = c
        for n in (1, 2, 3):
            if n > 1:
                if len(c) < n:
                    break
                gram = (gram[:-1] << np.uint64(21)) | c[n - 1 :]
            cell = (mixed(gram + salt(n)) >> np.uint64(52)).astype(np.int64)
            counts += np.bincount(cell, minlength=FEATURES)
    return np.sqrt(counts / counts.sum()).astype(np.float32)


def svm(x: np.ndarray, y: np.ndarray, settings: Settings) -> np.ndarray:
    """Weights (bias last) of a linear support vector machine, by dual coordinate descent.

    Each side weighs as much as the other, however many rows it has."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float32)
    upper = settings.cost * len(y) / (2 * np.where(y > 0, (y > 0).sum(), (y < 0).sum()))
    square = np.einsum("ij,ij->i", x, x, dtype=np.float64)
    alpha, w = np.zeros(len(y)), np.zeros(x.shape[1])
    rng = np.random.default_rng(7)
    for _ in range(settings.epochs):
        for i in rng.permutation(len(y)):
            new = min(max(alpha[i] - (y[i] * (w @ x[i]) - 1) / square[i], 0.0), upper[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w


class Pairwise:
    """One-versus-one machines between named classes; most votes win, ties by margin."""

    def __init__(self, x: np.ndarray, names: np.ndarray, settings: Settings):
        weights = {}
        for a, b in combinations(sorted(set(names)), 2):
            rows = np.isin(names, [a, b])
            weights[a, b] = svm(x[rows], np.where(names[rows] == a, 1.0, -1.0), settings)
        self._take(sorted(set(names)), weights, x.shape[1])

    def _take(self, names: list[str], weights: dict[tuple[str, str], np.ndarray], width: int) -> None:
        self.names, self.pairs = names, list(combinations(range(len(names)), 2))
        rows = [weights[names[a], names[b]] for a, b in self.pairs]
        self.w = np.array(rows, np.float32).reshape(len(rows), width + 1)

    @classmethod
    def trained(cls, names: Sequence[str], weights: dict[tuple[str, str], np.ndarray]) -> Pairwise:
        """From machines that were trained elsewhere."""
        out = cls.__new__(cls)
        out._take(sorted(names), weights, FEATURES)
        return out

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the winner and its least margin against another class."""
        margin = x @ self.w[:, :-1].T + self.w[:, -1]
        votes = np.zeros((len(x), len(self.names)))
        least = np.full_like(votes, np.inf)
        for i, (a, b) in enumerate(self.pairs):
            m = margin[:, i]
            votes[:, a] += (m > 0) + 1e-3 * np.tanh(m)
            votes[:, b] += (m <= 0) - 1e-3 * np.tanh(m)
            least[:, a] = np.minimum(least[:, a], m)
            least[:, b] = np.minimum(least[:, b], -m)
        win = votes.argmax(axis=1)
        return win, least[np.arange(len(x)), win]


def family_of(lang: str) -> str:
    return next((family for family, group in FAMILIES.items() if lang in group), lang)


class Hierarchy:
    """The machines between families, and those between the languages of each family."""

    def __init__(self, langs: Sequence[str], weights: dict[tuple[str, str, str], np.ndarray]):
        families: dict[str, list[str]] = {}
        for lang in langs:
            families.setdefault(family_of(lang), []).append(lang)

        def step(name: str, classes: Sequence[str]) -> Pairwise:
            return Pairwise.trained(classes, {(a, b): w for (at, a, b), w in weights.items() if at == name})

        self.families = step("", list(families))
        self.within = [step(f, families[f]) for f in self.families.names]

    def __call__(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language of each row, and how sure both steps are together (0 to 1)."""
        chosen, margin = self.families(x)
        score = 1 / (1 + np.exp(-2 * np.clip(margin, -20, 20)))
        lang = np.empty(len(x), object)
        for f, model in enumerate(self.within):
            rows = np.flatnonzero(chosen == f)
            if len(rows):
                win, margin = model(x[rows])
                lang[rows] = [model.names[i] for i in win]
                score[rows] *= 1 / (1 + np.exp(-2 * np.clip(margin, -20, 20)))
        return lang.tolist(), score


def machines(langs: Sequence[str]) -> list[tuple[str, str, str]]:
    """(step, first class, second class) of every machine; the step is a family or, between
    families, empty."""
    families: dict[str, list[str]] = {}
    for lang in sorted(langs):
        families.setdefault(family_of(lang), []).append(lang)
    out = [("", a, b) for a, b in combinations(sorted(families), 2)]
    return out + [(f, a, b) for f, own in sorted(families.items()) for a, b in combinations(own, 2)]


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lang, held = [], []
        for name, text in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
            if (f := features(text)) is not None:
                lang.append(name)
                held.append(f.tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.string()), pa.array(held, pa.binary())], names=["lang", "features"]
        )


def _sample(docs: DataFrame, settings: Settings) -> DataFrame:
    """(lang, features) of at most ``per_language`` documents of each language, those with the
    least hashes, none from the held-out fold. Where a language has many documents, hashes far
    from the least are left out before rows of one language meet."""
    rows = docs.select(F.col("doc_id").cast("long").alias("at"), "lang").where(
        (fold(F.col("at"), 3) != 1) & F.col("lang").isNotNull()
    )
    sizes = rows.groupBy("lang").agg(F.count("*").alias("size"))  # a row for each language
    scale = 1 << 30
    place = F.pmod(F.xxhash64("at"), F.lit(scale))
    near = F.col("size") * place <= F.lit(4 * settings.per_language * scale)
    rows = rows.join(F.broadcast(sizes), "lang").where(near).withColumn("place", place)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "at"))
    chosen = rows.withColumn("rank", rank).where(F.col("rank") <= settings.per_language)
    chosen = stored(chosen.select("at", F.col("lang").alias("name")).distinct(), "sample")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    # at most languages * per_language rows of an id and a name
    found = texts.join(F.broadcast(chosen), F.expr("doc_id = at and lang = name")).select("name", "text")
    return stored(found.mapInArrow(_sample_features, "lang string, features binary"), "features")


def fit(docs: DataFrame, settings: Settings) -> Hierarchy | None:
    """Trained on the sample, each machine in a task of its own; only the machines' weights come
    to the driver. None if there is nothing to learn from."""
    sample = _sample(docs, settings)
    langs = sorted(r["lang"] for r in sample.select("lang").distinct().collect())
    if not langs:
        return None
    found = machines(langs)
    sides = [
        (i, lang, 1.0 if name == a else -1.0)
        for i, (step, a, b) in enumerate(found)
        for lang in langs
        for name in [family_of(lang) if step == "" else lang]
        if name in (a, b) and step in ("", family_of(lang))
    ]
    spark = docs.sparkSession
    asked = spark.createDataFrame(sides, "machine int, lang string, side double")

    def train(key: tuple, group: pa.Table) -> pa.Table:
        rows, side = group["features"].to_pylist(), group["side"].to_numpy()
        order = sorted(range(len(rows)), key=lambda i: (rows[i], side[i]))  # whatever order they came in
        x = np.empty((len(rows), FEATURES), np.float32)
        for at, i in enumerate(order):
            x[at] = np.frombuffer(rows[i], np.float32)
        w = svm(x, side[order], settings).astype(np.float32)
        return pa.table({"machine": pa.array([key[0].as_py()], pa.int32()), "weights": pa.array([w.tobytes()], pa.binary())})

    trained = sample.join(F.broadcast(asked), "lang").groupBy("machine")
    rows = trained.applyInArrow(train, "machine int, weights binary").collect()
    weights = {found[r["machine"]]: np.frombuffer(r["weights"], np.float32) for r in rows}
    return Hierarchy(langs, weights)


def _predict(model, carry: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hierarchy = model.value
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                found = [features(t) for t in batch.column(1).to_pylist()]
                lang, score = ["und"] * len(found), np.zeros(len(found))
                rows = [i for i, f in enumerate(found) if f is not None]
                if rows and hierarchy is not None:
                    names, sure = hierarchy(np.stack([found[i] for i in rows]))
                    score[rows] = sure
                    for i, name in zip(rows, names, strict=True):
                        lang[i] = name
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array(lang, pa.string()), pa.array(score)]
                    + [pa.array([f is not None for f in found], pa.bool_())]
                    + [batch.column(c) for c in carry],
                    names=["doc_id", "held_out", "lang_pred", "score", "lettered", *carry],
                )

    return run


def identify_language(
    docs: DataFrame, settings: Settings | None = None, carry: Sequence[str] = ()
) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, lang_pred, score (0 to 1) and whether the text is
    ``lettered``.

    ``und`` with score 0 for null, empty and letterless texts, and for every text if no row
    can be learned from. Every language of the sample can be predicted; machines grow with the
    square of a family's languages and of the families. Rows without doc_id are predicted, not learned from and not held out;
    rows without lang are predicted only. Repeated rows get equal results. Extra columns are
    not looked at; those named in ``carry`` are handed on with their row.
    """
    found_by_tasks(docs.sparkSession)
    settings = settings or Settings()
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, settings))
    rows = docs.select(
        F.col("doc_id").cast("long"), "text",
        F.coalesce(fold(F.col("doc_id").cast("long"), 3) == 1, F.lit(False)).alias("held_out"),
        *(c for c in carry if c != "text"),
    )
    kinds = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in carry)
    return rows.mapInArrow(
        _predict(model, list(carry)), "doc_id long, held_out boolean, lang_pred string, score double, lettered boolean" + kinds
    )
