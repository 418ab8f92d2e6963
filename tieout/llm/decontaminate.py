"""Benchmark decontamination by greedy string tiling.

Runs of shared tokens are found by a Karp-Rabin hash of every window of ``least`` tokens, joined
into maximal matches, and marked longest first so that no token is used twice. The share of a
benchmark item that ends up marked is its coverage in the document; since tiles may lie in any
order, reordered passages count like plain ones.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieout.llm.common import GOLDEN, WordHashes, found_by_tasks, stored

TOKEN = re.compile(r"\w+")
#: Bytes of benchmark text that are set against all documents at a time.
BLOCK_BYTES = 32_000_000


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Karp-Rabin hash of every run of k tokens."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * GOLDEN + hashes[i : i + n]
    return out


def tiles(matches: list[tuple[int, int, int]], least: int) -> list[tuple[int, int, int]]:
    """Greedy tiling of (length, document position, item position) matches.

    The longest match whose tokens are free on both sides is marked first, ties to the earlier
    document position, then item position; a match that lost tokens comes back with its free
    runs of at least ``least`` tokens.
    """
    heap = [(-n, d, i) for n, d, i in matches]
    heapq.heapify(heap)
    in_doc: set[int] = set()
    in_item: set[int] = set()
    marked = []
    while heap:
        n, d, i = heapq.heappop(heap)
        n = -n
        free = [x for x in range(n) if d + x not in in_doc and i + x not in in_item]
        if len(free) == n:
            in_doc.update(range(d, d + n))
            in_item.update(range(i, i + n))
            marked.append((n, d, i))
            continue
        start = 0
        for x in range(1, len(free) + 1):
            if x == len(free) or free[x] != free[x - 1] + 1:
                if x - start >= least:
                    heapq.heappush(heap, (start - x, d + free[start], i + free[start]))
                start = x
    return marked


class Benchmark:
    """A block of items: the hash of every window, sorted, with where it stands."""

    def __init__(self, items: list[tuple[int, str]], least: int):
        hashes = WordHashes()
        self.items: list[np.ndarray] = []
        self.ids: list[int] = []
        by_size = defaultdict(list)
        for item_id, text in items:
            words = [w.encode() for w in tokens(text)]
            if words:
                own = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
                by_size[min(least, len(words))].append((len(self.ids), own))
                self.items.append(own)
                self.ids.append(item_id)
        self.seeds = {}
        for k, group in by_size.items():
            keys = np.concatenate([windows(own, k) for _, own in group])
            nth = np.concatenate([np.full(len(own) - k + 1, n) for n, own in group])
            at = np.concatenate([np.arange(len(own) - k + 1) for _, own in group])
            order = np.argsort(keys, kind="stable")
            self.seeds[k] = keys[order], nth[order], at[order]

    def found(self, own: np.ndarray) -> list[tuple[int, float, list[tuple[int, int, int]]]]:
        """(item id, coverage, tiles) of the items that share a window with the document."""
        out = []
        for k, (keys, nth, at) in self.seeds.items():
            grams = windows(own, k)
            if not len(grams):
                continue
            low = np.searchsorted(keys, grams, "left")
            hit = np.flatnonzero(keys[np.minimum(low, len(keys) - 1)] == grams)
            if not len(hit):
                continue
            high = np.searchsorted(keys, grams[hit], "right")
            size = high - low[hit]
            seed = np.repeat(low[hit] - np.cumsum(size) + size, size) + np.arange(size.sum())
            where, item, pos = np.repeat(hit, size), nth[seed], at[seed]
            # windows that follow each other on one diagonal are one match
            order = np.lexsort((where, where - pos, item))
            where, item, pos = where[order], item[order], pos[order]
            new = np.ones(len(where), bool)
            new[1:] = (
                (item[1:] != item[:-1])
                | (where[1:] != where[:-1] + 1)
                | (pos[1:] != pos[:-1] + 1)
            )
            starts = np.flatnonzero(new)
            runs = np.diff(np.append(starts, len(where))) + k - 1
            matches = defaultdict(list)
            for s, n in zip(starts.tolist(), runs.tolist(), strict=True):
                matches[int(item[s])].append((n, int(where[s]), int(pos[s])))
            for which, found in matches.items():
                marked = tiles(found, k)
                share = sum(n for n, _, _ in marked) / len(self.items[which])
                out.append((self.ids[which], share, sorted(marked, key=lambda m: m[1])))
        return out


def _scan(block, threshold: float, marked: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench, hashes = block.value, WordHashes()
        for batch in batches:
            doc, item, share, n_tiles, place = [], [], [], [], []
            rows = zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True)
            for at, (doc_id, text) in enumerate(rows):
                words = tokens(text)
                if not words:
                    continue
                encoded = [w.encode("utf-8", "replace") for w in words]
                own = np.fromiter(map(hashes.__getitem__, encoded), np.uint64, len(words))
                for item_id, coverage, found in bench.found(own):
                    if coverage >= threshold and sum(n for n, _, _ in found) >= marked:
                        doc.append(doc_id)
                        item.append(item_id)
                        share.append(coverage)
                        n_tiles.append(len(found))
                        place.append(at)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc, pa.int64()), pa.array(item, pa.int64()),
                    pa.array(share, pa.float64()), pa.array(n_tiles, pa.int64()),
                    *(c.take(pa.array(place, pa.int64())) for c in batch.columns[2:]),
                ],
                names=["doc_id", "item_id", "coverage", "n_tiles", *batch.schema.names[2:]],
            )

    return run


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    least: int = 5,
    threshold: float = 0.5,
    text_key: str | None = None,
    marked: int = 0,
) -> DataFrame:
    """(doc_id, item_id, coverage, n_tiles) of documents that hold ``threshold`` of an item or
    more. Tokens are runs of letters, digits and underscores in lower case; tiles have at least
    ``least`` tokens, or the whole item if it is shorter. Null and empty texts hold nothing,
    empty items are held by nothing. ``marked`` is the least number of tokens that must be marked
    besides, so that items of a word or two, which any text may hold, are left out. Rows without doc_id are reported with a null id. Repeated
    rows and items give repeated results; other columns are not looked at, the column
    ``text_key`` of text is carried along.

    The benchmark is the stated query set: it is set against all documents in blocks of
    bounded size, one after the other, each block's rows being written before the next block is
    sent out; documents are never shuffled.
    """
    found_by_tasks(docs.sparkSession)
    spark = docs.sparkSession
    own_key = [text_key] if text_key else []
    texts = docs.select(F.col("doc_id").cast("long"), "text", *own_key)
    items = benchmark.select(F.col("item_id").cast("long"), "text")
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    total = items.agg(F.sum(size)).first()[0] or 0
    n_blocks = -(-total // BLOCK_BYTES) or 1
    out = None
    for nth in range(n_blocks):
        own = items if n_blocks == 1 else items.where(
            F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == nth
        )
        rows = sorted(((r[0], r[1]) for r in own.where("text is not null and item_id is not null").collect()))
        block = spark.sparkContext.broadcast(Benchmark(rows, least))
        found = texts.mapInArrow(
            _scan(block, threshold, marked),
            "doc_id long, item_id long, coverage double, n_tiles long"
            + "".join(f", {c} string" for c in own_key),
        )
        if n_blocks > 1:
            found = stored(found, "block")
            block.unpersist()
        out = found if out is None else out.union(found)
    return out


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, least: int = 5, threshold: float = 0.5, marked: int = 0
) -> DataFrame:
    """Per doc_id: contaminated, coverage (largest, 0 if below the threshold), items found.

    One row for each doc_id, null included. See ``leaks`` for what counts.
    """
    found = stored(leaks(docs, benchmark, least, threshold, marked=marked), "leaks")
    per_doc = found.groupBy("doc_id").agg(
        F.max("coverage").alias("coverage"), F.array_sort(F.collect_set("item_id")).alias("items")
    )
    ids = docs.select(F.col("doc_id").cast("long")).distinct()
    joined = ids.join(per_doc.withColumnRenamed("doc_id", "at"), F.expr("doc_id <=> at"), "left")
    return joined.select(
        "doc_id",
        F.col("coverage").isNotNull().alias("contaminated"),
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("items"),
    )
