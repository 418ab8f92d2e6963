"""Nearest neighbours by largest inner product: probed lists scanned by adaptive dimensions.

Vectors get one more component so that the largest inner product is the least distance, are
rotated at random and kept in lists around trained centres, about as many as the root of the
number of vectors. How many lists a query probes follows from a trial: for a sample of queries
the true neighbours are found by comparing all, and lists are probed up to the number at which
enough of these are reached. In the probed lists the distance of a candidate is summed over
blocks of rotated columns; after each block a hypothesis test asks whether the full distance can
still be among the nearest, and hopeless candidates are left. The inner products of those that
stay are computed on the original vectors.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tieout.llm.common import found_by_tasks, stored


@dataclass(frozen=True)
class Settings:
    k: int = 20
    #: Vectors the centres are trained on, about, and vectors of the sample for each list.
    sample: int = 65_536
    per_list: int = 16
    #: Lists, and lists probed by each query; found from the data if None.
    lists: int | None = None
    probes: int | None = None
    #: Queries of the trial, about, and the share of their true neighbours in the probed lists.
    trial: int = 128
    recall: float = 0.975
    #: Candidates and queries that meet in one task.
    candidates: int = 8_192
    queries: int = 2_048
    #: Columns of a block, and standard errors of the test.
    block: int = 16
    errors: float = 3.0
    seed: int = 11


class Space:
    """The map from vectors to rotated columns, and the centres of the lists, which follow one
    another along the direction in which they differ most and form groups of about ``size``
    vectors."""

    def __init__(self, sample: np.ndarray, bound: float, n: int, settings: Settings):
        self.bound, d = bound, sample.shape[1] + 1
        rng = np.random.default_rng(settings.seed)
        self.rotation = np.linalg.qr(rng.standard_normal((d, d)))[0]
        x = self.candidates(sample)
        lists = settings.lists or min(math.isqrt(n) + 1, max(1, len(x) // settings.per_list))
        self.centres = x[rng.choice(len(x), min(lists, len(x)), replace=False)]
        for _ in range(12):
            near = self._nearest_one(x)
            counts = np.bincount(near, minlength=len(self.centres))
            sums = np.stack([np.bincount(near, x[:, i], len(self.centres)) for i in range(d)], 1)
            some = counts > 0
            self.centres[some] = sums[some] / counts[some, None]
        spread = self.centres - self.centres.mean(axis=0)
        along = spread @ np.linalg.svd(spread, full_matrices=False)[2][0]
        self.centres = self.centres[np.argsort(along, kind="stable")]
        counts = np.bincount(self._nearest_one(x), minlength=len(self.centres))
        groups = max(1, math.ceil(n / settings.candidates))
        before = np.cumsum(counts) - counts
        self.group = np.minimum(before * groups // max(1, counts.sum()), groups - 1).astype(np.int32)

    def _nearest_one(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self.nearest(x[at : at + 4096], 1)[:, 0] for at in range(0, len(x), 4096)])

    def candidates(self, x: np.ndarray) -> np.ndarray:
        """Lifted to one length, so that distance falls as the inner product grows."""
        x = x / self.bound
        lift = np.sqrt(np.maximum(0.0, 1 - (x * x).sum(axis=1)))
        return np.hstack([x, lift[:, None]]) @ self.rotation

    def queries(self, x: np.ndarray) -> np.ndarray:
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        return np.hstack([x, np.zeros((len(x), 1))]) @ self.rotation

    def nearest(self, x: np.ndarray, n: int) -> np.ndarray:
        d = (self.centres**2).sum(axis=1) - 2 * x @ self.centres.T
        if n == 1:
            return d.argmin(axis=1)[:, None]
        return np.argsort(d, axis=1, kind="stable")[:, :n]


def scan(
    x: np.ndarray, q: np.ndarray, k: int, block: int, errors: float, rows: np.ndarray | None = None
) -> np.ndarray:
    """Rows of x, or of those in ``rows``, that may be among the k nearest to q, by partial distances over column blocks.

    Under a random rotation the share of a squared distance that the first t of d columns show
    has a beta distribution with mean t / d and variance 2 t (d - t) / (d d (d + 2)). A candidate
    goes once its partial distance is ``errors`` standard errors above what the k-th best
    distance known would show.
    """
    d = x.shape[1]
    order = np.arange(len(x)) if rows is None else rows
    part = np.zeros(len(order))
    limit = np.inf
    for start in range(0, d, block):
        stop = min(d, start + block)
        diff = x[order, start:stop] - q[start:stop]
        part = part + np.einsum("ij,ij->i", diff, diff)
        if len(order) <= k or stop == d:
            continue
        if start == 0:
            # the full distances of the most promising ones bound the k-th best
            best = np.argpartition(part, k - 1)[: 2 * k]
            full = x[order[best]] - q
            limit = np.partition(np.einsum("ij,ij->i", full, full), k - 1)[k - 1]
        error = math.sqrt(2 * stop * (d - stop) / (d + 2)) / d
        keep = part <= limit * (stop / d + errors * error)
        order, part = order[keep], part[keep]
    return order


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _assigned(space) -> Callable:
    """Adds the list, and its group, that each vector belongs to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                own = space.value.nearest(space.value.candidates(_matrix(batch.column("vector"))), 1)[:, 0]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(own, pa.int32()), pa.array(space.value.group[own], pa.int32())],
                    names=[*batch.schema.names, "list", "group"],
                )

    return run


def _probing(space, n: int) -> Callable:
    """A row for each query and group of lists, with the lists that it probes there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                found = space.value.nearest(space.value.queries(_matrix(batch.column("vector"))), n)
                rows, groups, lists = [], [], []
                for i, own in enumerate(found):
                    of = space.value.group[own]
                    for g in np.unique(of):
                        rows.append(i)
                        groups.append(int(g))
                        lists.append(own[of == g].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [c.take(pa.array(rows, pa.int64())) for c in batch.columns]
                    + [pa.array(groups, pa.int32()), pa.array(lists, pa.list_(pa.int32()))],
                    names=[*batch.schema.names, "group", "lists"],
                )

    return run


def _best(score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best scores; ties at the end all stay."""
    last = np.partition(score, -k)[-k] if len(score) > k else -np.inf
    return np.flatnonzero(score >= last)


def _searched(space, settings: Settings) -> Callable:
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query": [], "node": [], "score": []}
        if left.num_rows and right.num_rows:
            left = left.sort_by("list")
            vectors, ids = _matrix(left["vector"]), left["node"].to_numpy()
            x = space.value.candidates(vectors)
            edges = np.searchsorted(left["list"].to_numpy(), np.arange(len(space.value.centres) + 1))
            asked = _matrix(right["vector"])
            rotated = space.value.queries(asked)
            queries = right["node"].to_pylist()
            for node, v, q, lists in zip(queries, asked, rotated, right["lists"].to_pylist(), strict=True):
                rows = np.concatenate([np.arange(edges[c], edges[c + 1]) for c in lists])
                if not len(rows):
                    continue
                rows = scan(x, q, settings.k + 1, settings.block, settings.errors, rows)
                score = (vectors[rows] * v).sum(axis=1)
                best = _best(score, settings.k + 1)  # the smaller ids may be behind any of equals
                out["query"].append(np.full(len(best), node))
                out["node"].append(ids[rows][best])
                out["score"].append(score[best])
        kinds = {"query": np.int64, "node": np.int64, "score": np.float64}
        return pa.table({n: np.concatenate([np.empty(0, kinds[n]), *v]) for n, v in out.items()})

    return run


def _probes(lists: DataFrame, asked: DataFrame, space: Space, settings: Settings) -> int:
    """How many lists hold the wanted share of the true neighbours of a sample of queries, which
    are found by comparing these with all vectors."""
    total = asked.count()
    some = asked.where(F.pmod(F.xxhash64("key"), F.lit(total)) < settings.trial) if total else asked
    trial = some.select("node", "vector").toArrow()
    if not trial.num_rows:
        return len(space.centres)
    x, own, k = _matrix(trial["vector"]), trial["node"].to_numpy(), settings.k

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 16_384):
                batch = whole.slice(at, 16_384)
                score, node = x @ _matrix(batch.column("vector")).T, batch.column("node").to_numpy()
                score[own[:, None] == node[None, :]] = -np.inf
                n = min(k, score.shape[1])
                best = np.argpartition(-score, n - 1, axis=1)[:, :n]
                query = np.repeat(np.arange(len(x)), n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query, pa.int32()), pa.array(batch.column("list").to_numpy()[best.ravel()], pa.int32()),
                     pa.array(score[query, best.ravel()])],
                    names=["query", "list", "score"],
                )

    found = lists.select("node", "vector", "list").mapInArrow(run, "query int, list int, score double")
    nth = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "list"))
    found = found.withColumn("nth", nth).where((F.col("nth") <= k) & (F.col("score") > float("-inf")))
    true = found.select("query", "list").toArrow()  # k rows for each query of the trial
    place = np.empty((len(x), len(space.centres)), np.int64)
    order = space.nearest(space.queries(x), len(space.centres))
    order = order if order.shape[1] > 1 else np.zeros((len(x), 1), np.int64)
    np.put_along_axis(place, order, np.arange(len(space.centres))[None, :], axis=1)
    at = np.sort(place[true["query"].to_numpy(), true["list"].to_numpy()])
    if not len(at):
        return len(space.centres)
    return int(at[min(len(at) - 1, math.ceil(settings.recall * len(at)) - 1)]) + 1


def usable(vector: Column) -> Column:
    """Vectors with components that are all finite and not all zero."""
    return (
        (F.size(vector) > 0)
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(vector, lambda x: x != 0)
    )


def nearest_neighbours(
    rows: DataFrame, is_query: Column, settings: Settings | None = None
) -> DataFrame:
    """The k vectors with the largest inner product for each query row of ``rows(vec_id, embedding)``.

    Returns query_id, rank (from 1), vec_id and score, in double precision; ties go to the
    smaller vec_id, a row is never its own neighbour, and a query gets fewer than k rows only
    if there are fewer candidates in the lists it probes. Rows without vec_id and vectors that
    are null, empty, zero or hold null or non-finite components take no part; vectors must have
    as many components as the most common number, others take no part either. Of rows that
    repeat a vec_id with one vector one counts; with several vectors each counts. Extra columns
    are not looked at.

    Equal vectors are searched for once, and of the copies of one vector only the k + 1 with
    the smallest ids can be among anybody's k nearest, so a vector that very many rows share
    is no heavier than another. Groups of lists and their queries are dealt in blocks of bounded
    size.
    """
    found_by_tasks(rows.sparkSession)
    settings = settings or Settings()
    spark = rows.sparkSession
    vectors = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    sizes = vectors.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not sizes:
        return empty
    vectors = vectors.where(F.size("vector") == sizes[0]["d"])
    # -0.0 and 0.0 are one value
    vectors = vectors.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    vectors = stored(vectors.withColumn("key", F.sha2(F.to_json("vector"), 256)), "vectors")

    first = vectors.groupBy("key").agg(
        F.min("vec_id").alias("least"), F.first("vector").alias("vector"), F.max("asks").alias("asks")
    )
    classes = stored(first.withColumn("node", F.monotonically_increasing_id()), "classes")
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    bound = classes.agg(F.max(length)).first()[0] * (1 + 1e-12)
    n = classes.count()
    wanted = F.floor(F.lit(settings.sample * float(1 << 40) / n)).cast("long")
    sample = classes.where(F.pmod(F.xxhash64("key"), F.lit(1 << 40)) <= wanted).select("key", "vector")
    sample = sample.toArrow().sort_by("key")  # in one order, however the rows came
    if not sample.num_rows:
        sample = classes.select("vector").limit(1).toArrow()
    own = Space(_matrix(sample["vector"]), bound, n, settings)
    space = spark.sparkContext.broadcast(own)
    lists = classes.select("node", "vector").mapInArrow(
        _assigned(space), "node long, vector array<double>, list int, group int"
    )
    lists = stored(lists, "lists")
    probing = classes.where("asks")
    probes = settings.probes or _probes(lists, probing, own, settings)
    asked = probing.select("node", "vector").mapInArrow(
        _probing(space, probes), "node long, vector array<double>, group int, lists array<int>"
    )
    asked = stored(asked, "probes")

    # every block of a group of lists meets every block of the queries that probe it
    def blocks(frame: DataFrame, name: str, size: int) -> DataFrame:
        return frame.groupBy("group").agg(F.ceil(F.count("*") / size).cast("int").alias(name))

    grid = stored(
        blocks(lists, "c", 2 * settings.candidates).join(blocks(asked, "q", settings.queries), "group"), "grid"
    )

    def dealt(frame: DataFrame, own: str, other: str, rest: str) -> DataFrame:
        return frame.join(grid, "group").select(
            "group", F.pmod(F.hash("node"), own).alias(own),
            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other), "node", "vector", rest,
        )

    place = ["group", "c", "q"]
    found = (
        dealt(lists, "c", "q", "list").groupBy(*place)
        .cogroup(dealt(asked, "q", "c", "lists").groupBy(*place))
        .applyInArrow(_searched(space, settings), "query long, node long, score double")
    )
    # equal scores: any class may hold the smaller ids, so ties at the end are all kept
    found = stored(found, "found")
    tied = F.rank().over(Window.partitionBy("query").orderBy(F.desc("score")))
    found = found.withColumn("place", tied).where(F.col("place") <= settings.k + 1).drop("place")

    order = Window.partitionBy("key").orderBy("vec_id")
    members = vectors.select("key", "vec_id").distinct()
    members = members.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= settings.k + 1)
    members = members.join(classes.select("key", "node"), "key").select("node", "vec_id")
    members = stored(members, "members")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    nearest = found.join(members, "node").withColumn("place", rank)
    nearest = stored(
        nearest.where(F.col("place") <= settings.k + 1).select("query", "vec_id", "score"), "nearest"
    )
    queries = vectors.where("asks").select("key", F.col("vec_id").alias("query_id")).distinct()
    queries = queries.join(classes.select("key", F.col("node").alias("query")), "key")
    rank = F.row_number().over(Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id"))
    return (
        stored(queries.select("query", "query_id"), "queries")
        .join(nearest, "query")
        .where("query_id <> vec_id")
        .withColumn("rank", rank)
        .where(F.col("rank") <= settings.k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
