"""Toxic passages: maximum-scoring segments over token log-odds, with extreme-value calibration.

Token log-odds compare toxic with other labelled documents under an informative Dirichlet prior
taken from token counts of the whole corpus. Every maximal segment of a document is found in
one pass; a segment's score is turned into the number of segments as good that a harmless text
of the same length would show, and a document's evidence is made of its significant segments.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieout.llm.common import fold, found_by_tasks, stored

TOKEN = re.compile(r"[^\W\d_]+")
#: Distinct tokens a task counts before it passes its counts on.
HELD = 200_000


@dataclass(frozen=True)
class Settings:
    #: Labelled documents the model is fitted on, those with the least hashes.
    labelled: int = 40_000
    #: Tokens with a log-odds of their own, those furthest from no difference.
    terms: int = 50_000
    #: Labelled documents a token must occur in, and standard errors from no difference.
    least_docs: int = 3
    least_z: float = 3.0
    #: Weight of the corpus in the prior, as a share of the labelled tokens.
    prior: float = 0.05
    #: Expected chance segments in a harmless text above which a segment does not count.
    significant: float = 0.05


@dataclass(frozen=True)
class Model:
    scores: dict[str, float]
    drift: float
    lam: float
    k: float
    weights: tuple[float, float]
    settings: Settings


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


def segments(hits: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, end, score), in order, in linear time.

    ``hits`` are the tokens with a score of their own; every token costs ``drift`` besides.
    """
    # each entry: start, end, total before it, total after it, entry to look at next on the left
    stack: list[tuple[int, int, float, float]] = []
    total, last = 0.0, 0
    for at, score in hits:
        total -= (at - last) * drift
        before = total
        total += score - drift
        last = at + 1
        if score <= drift:
            continue
        start, end, low, high = at, at + 1, before, total
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= low:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= high:
                stack.append((start, end, low, high, j))
                break
            start, low = stack[j][0], stack[j][2]
            del stack[j:]
    return [(s, e, h - lo) for s, e, lo, h, _ in stack]


def evidence(model: Model, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
    """Sum of -ln(expected chance segments) over the significant segments, and these."""
    words = tokens(text)
    get = model.scores.get
    hits = [(i, s) for i, w in enumerate(words) if (s := get(w)) is not None]
    if not any(s > model.drift for _, s in hits):
        return 0.0, []
    size = math.log(model.k * len(words))
    good = []
    for start, end, score in segments(hits, model.drift):
        expected = size - model.lam * score
        if expected <= math.log(model.settings.significant):
            good.append((start, end, -expected))
    return sum(e for _, _, e in good), good


def chance(model: Model, value: float) -> float:
    a, b = model.weights
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * math.log1p(value)))))


def _labelled_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per token: toxic and other documents that have it. A text that repeats a word a thousand
    times says no more about it than another."""
    held: dict[str, list[int]] = {}

    def out() -> pa.RecordBatch:
        columns = [pa.array(list(held), pa.string())]
        columns += [pa.array([v[i] for v in held.values()], pa.int64()) for i in range(2)]
        return pa.RecordBatch.from_arrays(columns, names=["token", "toxic", "other"])

    for batch in batches:
        for text, toxic in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
            for word in set(tokens(text)):
                held.setdefault(word, [0, 0])[0 if toxic else 1] += 1
            if len(held) > HELD:
                yield out()
                held.clear()
    yield out()


def _corpus_counts(vocabulary) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, known, total = Counter(), vocabulary.value, 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = set(tokens(text))
                total += len(words)
                counts.update(words & known)
        names, n = [*counts, ""], [*counts.values(), total]
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(n)], names=["token", "n"])

    return run


def training_rows(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """(text, toxic) of labelled documents outside the held-out fold: a bounded sample."""
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("at"), F.col("toxic").cast("int").alias("toxic"))
        .where("at is not null and toxic is not null")
        .where(fold(F.col("at"), 5) != 0)
        .groupBy("at")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("at"), "at")
        .limit(settings.labelled)
    )
    rows = F.broadcast(stored(chosen, "labelled"))  # settings.labelled rows at most
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.join(rows, F.col("doc_id") == F.col("at")).select("text", "toxic")


def solve_lambda(p: np.ndarray, s: np.ndarray) -> float:
    """The positive root of sum p exp(lambda s) = 1."""
    low, high = 1e-6, 1.0
    while (p * np.exp(high * s)).sum() < 1 and high < 64:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if (p * np.exp(mid * s)).sum() < 1 else (low, mid)
    return high


def fit(docs: DataFrame, labels: DataFrame, settings: Settings) -> Model:
    spark = docs.sparkSession
    rows = stored(training_rows(docs, labels, settings), "training")
    counts = (
        rows.mapInArrow(_labelled_counts, "token string, toxic long, other long")
        .groupBy("token")
        .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    )
    counts = stored(counts, "terms")
    n_toxic, n_other = counts.agg(F.sum("toxic"), F.sum("other")).first()
    if not n_toxic or not n_other:
        return Model({}, 1.0, 1.0, 1.0, (-30.0 if not n_toxic else 30.0, 0.0), settings)
    # a first cut by a plain comparison, twice as wide as the terms that may stay
    ratio = F.log((F.col("toxic") + 0.5) / n_toxic) - F.log((F.col("other") + 0.5) / n_other)
    wide = (
        counts.where(F.col("toxic") + F.col("other") >= settings.least_docs)
        .withColumn("z", F.abs(ratio) / F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("other") + 0.5)))
        .orderBy(F.desc("z"), "token")
        .limit(2 * settings.terms)
        .toPandas()
    )
    known = spark.sparkContext.broadcast(frozenset(wide["token"]))
    corpus = dict(
        docs.select("text")
        .mapInArrow(_corpus_counts(known), "token string, n long")
        .groupBy("token")
        .agg(F.sum("n"))
        .collect()  # one row per known term
    )
    everything = corpus.get("", 0) or 1
    a0 = settings.prior * (n_toxic + n_other)
    prior = a0 * (wide["token"].map(corpus).fillna(0).to_numpy(float) + 1) / (everything + len(wide) + 1)
    y1, y0 = wide["toxic"].to_numpy(float) + prior, wide["other"].to_numpy(float) + prior
    odds = np.log(y1 / (n_toxic + a0 - y1)) - np.log(y0 / (n_other + a0 - y0))
    z = odds / np.sqrt(1 / y1 + 1 / y0)
    order = [i for i in np.argsort(-np.abs(z), kind="stable")[: settings.terms] if abs(z[i]) >= settings.least_z]
    scores = {wide["token"][i]: float(odds[i]) for i in order}

    # what a harmless token scores, and the drift that keeps its mean clearly below zero
    s = np.array([odds[i] for i in order])
    p = np.array([wide["other"][i] for i in order]) / n_other
    mean, spread = float((p * s).sum()), math.sqrt(float((p * s * s).sum()) + 1e-12)
    drift = max(0.05, mean + 0.25 * spread)
    s, p = np.append(s, 0.0) - drift, np.append(p, max(0.0, 1 - p.sum()))
    p = (p + 1e-9) / (p + 1e-9).sum()
    lam = solve_lambda(p, s) if (s > 0).any() else 1.0
    return _calibrated(Model(scores, drift, lam, 1.0, (0.0, 1.0), settings), rows)


def _seen(model, measure: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure(model.value, t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.float64()), batch.column(1)], names=["x", "toxic"]
            )

    return run


def _extreme(model: Model, text: str | None) -> float:
    """n exp(-lambda S) for the best score S of a text of n tokens."""
    words = tokens(text)
    hits = [(i, s) for i, w in enumerate(words) if (s := model.scores.get(w)) is not None]
    best = max((s for _, _, s in segments(hits, model.drift)), default=0.0)
    return len(words) * math.exp(-model.lam * best)


def _evidence(model: Model, text: str | None) -> float:
    return evidence(model, text)[0]


def _calibrated(model: Model, rows: DataFrame) -> Model:
    """The factor of the extreme-value law, from the best scores of harmless training texts (its
    maximum likelihood, given lambda), then a logistic curve over ln(1 + evidence), by Newton's
    method on the training rows."""
    spark = rows.sparkSession

    def measured(m: Model, measure: Callable):
        held = spark.sparkContext.broadcast(m)
        return rows.mapInArrow(_seen(held, measure), "x double, toxic int").toPandas()

    best = measured(model, _extreme)
    harmless = best["x"][(best["toxic"] == 0) & (best["x"] > 0)]
    model = replace(model, k=float(1 / harmless.mean()) if len(harmless) else 1.0)
    seen = measured(model, _evidence)
    x = np.stack([np.ones(len(seen)), np.log1p(seen["x"].to_numpy())], 1)
    y = (seen["toxic"].to_numpy() > 0).astype(float)
    w = np.zeros(2)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        w = w - np.linalg.solve(h, x.T @ (p - y) + 1e-3 * w)
    return replace(model, weights=(float(w[0]), float(w[1])))


def _scored(model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            score, passages = [], []
            for text in batch.column(1).to_pylist():
                value, good = evidence(m, text)
                score.append(chance(m, value))
                if good:
                    spans = [x.span() for x in TOKEN.finditer(text.lower())]
                    good = [
                        {"start": spans[s][0], "end": spans[e - 1][1], "evidence": v}
                        for s, e, v in good
                    ]
                passages.append(good)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("evidence", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(2), pa.array(score, pa.float64()),
                    pa.array([int(x >= 0.5) for x in score], pa.int32()), pa.array(passages, kind),
                ],
                names=["doc_id", "held_out", "score", "predicted", "passages"],
            )

    return run


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted and the toxic passages.

    Passages are places in the lower-cased text. Labels of the fifth of the documents whose
    CRC-32 of the id leaves 0 modulo 5 are never learned from. Null and empty texts have no
    evidence and get the score of a text without toxic passages. Rows without doc_id are scored
    and are not held out; labels without id or value are left out; of several labels of one id
    the largest counts. Without toxic labels every score is near 0, without others near 1.
    Repeated rows get equal scores. Other columns, extra ones included, are not looked at.
    """
    found_by_tasks(docs.sparkSession)
    settings = settings or Settings()
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, settings))
    rows = docs.select(
        F.col("doc_id").cast("long"), "text",
        F.coalesce(fold(F.col("doc_id").cast("long"), 5) == 0, F.lit(False)).alias("held_out"),
    )
    return rows.mapInArrow(
        _scored(model),
        "doc_id long, held_out boolean, score double, predicted int,"
        " passages array<struct<start: long, end: long, evidence: double>>",
    )
