"""Hard negatives by threshold joins over an inverted index with suffix-norm bounds.

Rows of equal vector and label are one class. Anchors meet blocks of classes in tasks. There an
inverted index by groups of dimensions leaves out, for each class, the trailing dimensions whose
norm, times the largest norm that any anchor has there, stays under the threshold. An anchor adds
up partial scores group by group and drops a class once what it has plus the product of the
remaining norms stays under the threshold; what is left is scored exactly in integers.

First one class in ``seeds`` is searched, thresholds being lowered until the windows fill. The
scores found are then thresholds below which no other class can matter, and the rest of the
classes is joined under these. Both steps are exact, so the result is that of comparing all.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tieout.llm.common import found_by_tasks, stored

#: Dimensions of one group of posting lists.
GROUP = 8
#: Thresholds are shares of the product of the largest norms: each is this part of the one
#: before, and below the least share comes the floor itself.
STEP, LEAST_SHARE = 0.8, 0.02
#: Relative slack of bounds in floating point; scores themselves are integers.
SLACK = 1e-9


@dataclass(frozen=True)
class Settings:
    #: Positives of an anchor, and negatives of each positive.
    positives: int = 5
    negatives: int = 5
    #: A negative's score lies between these hundredths of its positive's score.
    low: int = 80
    high: int = 100
    #: One class in so many is searched first.
    seeds: int = 8
    #: Largest blocks of classes and of anchors, and the blocks wanted if those are smaller.
    block: int = 65_536
    anchor_block: int = 16_384
    wanted: int = 64
    least_block: int = 8_192


class Postings:
    """Posting lists by group of dimensions, for queries of one least threshold."""

    def __init__(self, index: SuffixIndex, least: float, reach: np.ndarray):
        covered = index.rest * reach < least * (1 - SLACK)
        covered[:, -1] = True
        #: Groups indexed of each row; the others are covered by the bound.
        extent = covered.argmax(axis=1) if least > 0 else np.full(len(covered), covered.shape[1] - 1)
        self.rows = np.argsort(-extent, kind="stable")
        self.sizes = [int((extent > g).sum()) for g in range(covered.shape[1])]
        self.lists = [index.values[g][self.rows[:n]] for g, n in enumerate(self.sizes[:-1])]
        self.rest = index.rest[self.rows]
        self.exact = index.exact
        self.least = least

    def reaching(self, q: np.ndarray, parts: list[np.ndarray], rest: np.ndarray, least: float):
        """Rows whose inner product with q is at least ``least``, and the products. ``rest`` are
        the norms of q from each group on; ``least`` is no less than the index was built for."""
        slack = SLACK * rest[0] * (self.rest[:, 0].max() if len(self.rest) else 0.0)
        if not self.lists:  # vectors without dimensions
            found = self.rows if least <= 0 else self.rows[:0]
            return found, np.zeros(len(found), np.int64)
        # a row without postings cannot reach the threshold
        at = np.arange(self.sizes[0])
        score = self.lists[0] @ parts[0]
        ended = []
        for g in range(1, len(rest)):
            alive = score + self.rest[at, g] * rest[g] >= least - slack
            at, score = at[alive], score[alive]
            cut = int(np.searchsorted(at, self.sizes[g]))
            ended.append(at[cut:])  # the bound covers all that their postings leave out
            at, score = at[:cut], score[:cut]
            if not cut:
                break
            score += self.lists[g][at] @ parts[g]
        found = self.rows[np.concatenate(ended)]
        exact = self.exact[found] @ q
        keep = exact >= least
        return found[keep], exact[keep]


class SuffixIndex:
    """The vectors of a block with their dimensions by falling energy and their suffix norms."""

    def __init__(self, x: np.ndarray):
        self.exact = x
        values = x.astype(np.float64)
        self.order = np.argsort(-(values * values).sum(axis=0), kind="stable")
        values = values[:, self.order]
        self.cuts = [*range(0, x.shape[1], GROUP), x.shape[1]]
        self.values = self._parts(values)
        self.rest = self._rest(values)

    def _parts(self, values: np.ndarray) -> list[np.ndarray]:
        return [np.ascontiguousarray(values[..., a:b]) for a, b in zip(self.cuts, self.cuts[1:], strict=False)]

    def _rest(self, values: np.ndarray) -> np.ndarray:
        squares = np.zeros((len(values), len(self.cuts)))
        for g in reversed(range(len(self.cuts) - 1)):
            part = values[:, self.cuts[g] : self.cuts[g + 1]]
            squares[:, g] = squares[:, g + 1] + (part * part).sum(axis=1)
        return np.sqrt(squares)

    def join(
        self,
        queries: np.ndarray,
        floors: np.ndarray,
        start: float,
        filled: Callable[[int, np.ndarray, np.ndarray, float], bool],
        found: Callable[[int, np.ndarray, np.ndarray], None],
    ) -> None:
        """Hand ``found`` each query's rows of a score down to some threshold. The threshold
        starts at the share ``start`` of the largest possible score and is lowered until
        ``filled`` says that it is low enough, or to the query's floor."""
        if not len(queries) or not len(self.exact):
            return
        values = queries.astype(np.float64)[:, self.order]
        rest = self._rest(values)
        norm = np.where(rest[:, 0] > 0, rest[:, 0], 1.0)
        top = float(self.rest[:, 0].max())
        share, open_ = start, np.arange(len(queries))
        while len(open_):
            least = np.maximum(np.ceil(share * norm[open_] * top), floors[open_])
            reach = (rest[open_] / norm[open_, None]).max(axis=0)
            postings = Postings(self, float((least / norm[open_]).min()), reach)
            still = []
            for i, t in zip(open_.tolist(), least.tolist(), strict=True):
                parts = [values[i, a:b] for a, b in zip(self.cuts, self.cuts[1:], strict=False)]
                rows, scores = postings.reaching(queries[i], parts, rest[i], t)
                if t <= floors[i] or filled(i, rows, scores, t):
                    found(i, rows, scores)
                else:
                    still.append(i)
            open_ = np.array(still, np.int64)
            share = share * STEP if share * STEP >= LEAST_SHARE else 0.0


def _vectors(table: pa.Table, size: int) -> np.ndarray:
    flat = table["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64, copy=False).reshape(table.num_rows, size)


def _best(scores: np.ndarray, least_ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the n first by falling score, then rising id."""
    if len(scores) > 4 * n:
        nth = np.partition(scores, len(scores) - n)[len(scores) - n]
        some = np.flatnonzero(scores >= nth)
        return some[np.lexsort((least_ids[some], -scores[some]))[:n]]
    return np.lexsort((least_ids, -scores))[:n]


class _Found:
    """Rows of (class of the anchor, window, score, ids) gathered in a task."""

    def __init__(self, classes: pa.Table):
        self.ids = classes["ids"].combine_chunks()
        self.keys: list[str] = []
        self.windows: list[int] = []
        self.scores: list[np.ndarray] = []
        self.rows: list[np.ndarray] = []

    def add(self, key: str, window: int, rows: np.ndarray, scores: np.ndarray) -> None:
        self.keys += [key] * len(rows)
        self.windows += [window] * len(rows)
        self.rows.append(rows)
        self.scores.append(scores)

    def table(self) -> pa.Table:
        rows = np.concatenate([np.empty(0, np.int64), *self.rows])
        scores = np.concatenate([np.empty(0, np.int64), *self.scores])
        return pa.table(
            {
                "anchor_key": pa.array(self.keys, pa.string()),
                "positive_score": pa.array(self.windows, pa.int64()),
                "score": pa.array(scores, pa.int64()),
                "ids": self.ids.take(pa.array(rows, pa.int64())),
            }
        )


FOUND = "anchor_key string, positive_score long, score long, ids array<long>"


def _positives(size: int, anchors: pa.Table, classes: pa.Table, n: int, start: float) -> pa.Table:
    """The n first classes of each anchor's own label in this block, by score, none below the
    anchor's floor."""
    out = _Found(classes)
    x, q = _vectors(classes, size), _vectors(anchors, size)
    counts = np.array([len(i) for i in out.ids.to_pylist()], np.int64)
    least_ids = np.array([i[0] for i in out.ids.to_pylist()], np.int64)
    own, wanted = (np.array(t["label"].to_pylist(), object) for t in (classes, anchors))
    floors = anchors["floor"].to_numpy()
    keys = anchors["anchor_key"].to_pylist()
    for label in set(wanted.tolist()):
        rows, asked = np.flatnonzero(own == label), np.flatnonzero(wanted == label)

        def filled(i: int, found: np.ndarray, scores: np.ndarray, t: float, rows=rows) -> bool:
            return counts[rows[found]].sum() >= n

        def keep(i: int, found: np.ndarray, scores: np.ndarray, rows=rows, asked=asked) -> None:
            best = _best(scores, least_ids[rows[found]], n)
            out.add(keys[asked[i]], 0, rows[found[best]], scores[best])

        SuffixIndex(x[rows]).join(q[asked], floors[asked], start, filled, keep)
    return out.table()


def _negatives(size: int, anchors: pa.Table, classes: pa.Table, s: Settings, start: float) -> pa.Table:
    """For each window of each anchor, the first classes of other labels in this block whose
    scores lie in the window, by score, none below the window's floor."""
    out = _Found(classes)
    x, q = _vectors(classes, size), _vectors(anchors, size)
    counts = np.array([len(i) for i in out.ids.to_pylist()], np.int64)
    least_ids = np.array([i[0] for i in out.ids.to_pylist()], np.int64)
    own, wanted = (np.array(t["label"].to_pylist(), object) for t in (classes, anchors))
    keys, windows = anchors["anchor_key"].to_pylist(), anchors["windows"].to_pylist()

    def inside(i: int, rows: np.ndarray, scores: np.ndarray) -> Iterable[tuple[dict, np.ndarray]]:
        other = own[rows] != wanted[i]
        for w in windows[i]:
            high = s.high * w["positive_score"] // 100
            yield w, np.flatnonzero(other & (scores >= w["floor"]) & (scores <= high))

    def filled(i: int, rows: np.ndarray, scores: np.ndarray, t: float) -> bool:
        return all(
            t <= w["floor"] or counts[rows[at]].sum() >= s.negatives for w, at in inside(i, rows, scores)
        )

    def keep(i: int, rows: np.ndarray, scores: np.ndarray) -> None:
        for w, at in inside(i, rows, scores):
            best = at[_best(scores[at], least_ids[rows[at]], s.negatives)]
            out.add(keys[i], w["positive_score"], rows[best], scores[best])

    floors = np.array([min(w["floor"] for w in own) for own in windows], np.int64)
    SuffixIndex(x).join(q, floors, start, filled, keep)
    return out.table()


def _blocked(
    anchors: DataFrame, classes: DataFrame, n_anchors: int, n_classes: int, s: Settings,
    search: Callable[[int, pa.Table, pa.Table], pa.Table],
) -> DataFrame:
    """Run ``search`` on every block of anchors with every block of classes of its dimensions."""
    few = min(s.wanted, math.ceil(n_classes / s.least_block))
    down, across = max(1, math.ceil(n_classes / s.block), few), max(1, math.ceil(n_anchors / s.anchor_block))
    spread = F.pmod(F.xxhash64("key"), F.lit(down))
    left = anchors.withColumn("a", F.pmod(F.xxhash64("anchor_key"), F.lit(across)).cast("int")).withColumn(
        "d", F.explode(F.sequence(F.lit(0), F.lit(down - 1)))
    )
    right = classes.withColumn("d", spread.cast("int")).withColumn(
        "a", F.explode(F.sequence(F.lit(0), F.lit(across - 1)))
    )

    def run(key: tuple, one: pa.Table, two: pa.Table) -> pa.Table:
        if not one.num_rows or not two.num_rows:
            return _Found(pa.table({"ids": pa.array([], pa.list_(pa.int64()))})).table()
        return search(key[0].as_py(), one, two)

    names = ("size", "a", "d")
    return left.groupBy(*names).cogroup(right.groupBy(*names)).applyInArrow(run, FOUND)


def _first_ids(found: DataFrame, n: int) -> DataFrame:
    """(anchor_key, positive_score, score, id, nth): the first n ids of each window."""
    rows = found.select("anchor_key", "positive_score", "score", F.explode("ids").alias("id")).distinct()
    order = Window.partitionBy("anchor_key", "positive_score").orderBy(F.desc("score"), "id")
    return rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= n)


def hard_negatives(rows: DataFrame, anchor: Column, settings: Settings | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows(id, label, vector)`` holds integer vectors; ``anchor`` says of an id whether it is one.
    An anchor's positives are the first other rows of its label by inner product, then id. For
    each, the first rows of other labels are returned whose scores lie in the positive's window;
    a positive of a negative score has an empty window, so none is returned for it.

    Rows with a null id, label, vector or component take no part, nor do vectors so long that a
    score times a hundred could leave the range of a long (a squared norm above 2^56). Only vectors of as many
    dimensions are compared; vectors without dimensions or of zeros score 0. Rows that repeat an
    id, label and vector count once; an id with several vectors or labels stands for each of
    them, but is never its own positive. Copies of one vector and label are searched once,
    however many. No rows give no rows.
    """
    found_by_tasks(rows.sparkSession)
    s = settings or Settings()
    n_own = s.positives + 1  # the anchor itself is among them
    squares = F.aggregate(
        "vector", F.lit(0.0), lambda done, x: done + x.cast("double") * x.cast("double")
    )
    whole = ~F.exists("vector", lambda x: x.isNull()) & (squares <= F.lit(2.0**56))
    taken = rows.select(
        F.col("id").cast("long").alias("id"), F.col("label").cast("string").alias("label"), "vector"
    ).where(F.col("id").isNotNull() & F.col("label").isNotNull() & whole)
    key = F.sha2(F.to_json(F.struct("label", "vector")), 256)
    keyed = stored(taken.select("id", "label", "vector", key.alias("key")), "keyed")

    ids = keyed.select("key", "id").distinct()
    nth = F.row_number().over(Window.partitionBy("key").orderBy("id"))
    least = ids.withColumn("nth", nth).where(F.col("nth") <= max(n_own, s.negatives))
    least = least.groupBy("key").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    vectors = keyed.groupBy("key").agg(F.first("label").alias("label"), F.first("vector").alias("vector"))
    classes = stored(vectors.join(least, "key").withColumn("size", F.size("vector")), "classes")
    members = stored(ids.where(anchor).withColumnRenamed("key", "anchor_key"), "anchors")
    asked = members.select(F.col("anchor_key").alias("key")).distinct()
    asked = classes.join(asked, "key", "left_semi").withColumnRenamed("key", "anchor_key")
    asked = stored(asked.withColumn("alone", F.size("ids") == 1).drop("ids"), "asked")
    n_anchors, n_classes = asked.count(), classes.count()

    seed = F.pmod(F.xxhash64("key", F.lit(1)), F.lit(s.seeds)) == 0
    parts = [(seed, 1.0, math.ceil(n_classes / s.seeds)), (~seed, 0.0, n_classes)]

    # positives: seeds from a floor of 0, since a lower score has no window; then the rest
    best = None
    for which, start, n in parts:
        if best is None:
            left = asked.withColumn("floor", F.lit(0).cast("long"))
        else:
            floor = best.where(F.col("nth") == n_own).select("anchor_key", F.col("score").alias("floor"))
            left = asked.join(floor, "anchor_key", "left").fillna(0, ["floor"])

        def search(size: int, a: pa.Table, c: pa.Table, start=start) -> pa.Table:
            return _positives(size, a, c, n_own, start)

        found = _blocked(left, classes.where(which), n_anchors, n, s, search)
        if best is not None:
            found = found.union(
                best.select("anchor_key", "positive_score", "score", F.array("id").alias("ids"))
            )
        best = stored(_first_ids(found, n_own), "positives")

    # a class of one row is the anchor alone, which is no positive of its own
    single = members.join(asked.where("alone"), "anchor_key", "left_semi").select(
        "anchor_key", "id", F.lit(True).alias("self")
    )
    own = best.join(single, ["anchor_key", "id"], "left").where("self is null")
    own = own.select("anchor_key", "id", F.col("score").alias("positive_score"))

    # negatives: a window for each score that a positive has
    lowest = F.expr(f"(positive_score * {s.low} + 99) div 100")
    scores = own.select("anchor_key", "positive_score").distinct()
    best = None
    for which, start, n in parts:
        if best is None:
            floors = scores.withColumn("floor", lowest)
        else:
            nth = best.where(F.col("nth") == s.negatives)
            nth = nth.select("anchor_key", "positive_score", F.col("score").alias("known"))
            floors = scores.join(nth, ["anchor_key", "positive_score"], "left")
            floors = floors.withColumn("floor", F.coalesce("known", lowest)).drop("known")
        windows = floors.groupBy("anchor_key").agg(
            F.collect_list(F.struct("positive_score", "floor")).alias("windows")
        )

        def search(size: int, a: pa.Table, c: pa.Table, start=start) -> pa.Table:
            return _negatives(size, a, c, s, start)

        found = _blocked(asked.join(windows, "anchor_key"), classes.where(which), n_anchors, n, s, search)
        if best is not None:
            found = found.union(
                best.select("anchor_key", "positive_score", "score", F.array("id").alias("ids"))
            )
        best = stored(_first_ids(found, s.negatives), "negatives")

    # each class has one row of bounded lists; every anchor of the class reads it
    listed = own.groupBy("anchor_key").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("positive_score")).alias("low"), "id"))).alias("own")
    )
    others = best.groupBy("anchor_key").agg(
        F.sort_array(F.collect_list(F.struct("positive_score", "nth", "score", F.col("id").alias("negative")))).alias("others")
    )
    rows = members.withColumnRenamed("id", "anchor_id").join(listed.join(others, "anchor_key"), "anchor_key")
    mine = F.slice(F.filter("own", lambda p: p["id"] != F.col("anchor_id")), 1, s.positives)
    rows = rows.select("anchor_id", "others", F.explode(mine).alias("p")).select(
        "anchor_id", F.col("p.id").alias("positive_id"), (-F.col("p.low")).alias("positive_score"), "others"
    )
    fitting = F.filter("others", lambda o: o["positive_score"] == F.col("positive_score"))
    rows = rows.select("anchor_id", "positive_id", "positive_score", F.explode(fitting).alias("o"))
    return rows.select(
        "anchor_id", "positive_id", F.col("o.nth").cast("int").alias("rank"),
        F.col("o.negative").alias("negative_id"), "positive_score", F.col("o.score").alias("negative_score"),
    )


def quantized(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(id, label, vector) with every component x as floor(scale * x). Rows with a null vector,
    or with a null or non-finite component, are left out."""
    finite = ~F.exists(
        "embedding",
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf"))),
    )
    return vectors.where(F.col("embedding").isNotNull() & finite).select(
        F.col("vec_id").alias("id"),
        "label",
        F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("vector"),
    )
