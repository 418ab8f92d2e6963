"""Best-fit packing by length patterns: non-negative least squares on the length histogram.

Documents become token pieces in tasks. Only the histogram of piece lengths, at most one count
per possible length, comes to the driver. There a few-document patterns that nearly fill a
sequence get repeat counts by non-negative least squares, the counts are rounded down, and what
is left over is packed best fit first, still by counts. The plan is a list of intervals of
ranks within a length, so every piece finds its sequence from its own rank alone.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tieout.llm.common import found_by_tasks, stored

#: A text of these characters alone can be tokenized word by word; others go whole.
PLAIN = re.compile("[^\t\n\r\x20-\x7eÀ-ÿ]")
PIECE = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\sa-zß-öø-ÿ0-9]+")
#: Words whose ids a task remembers.
REMEMBERED = 500_000
#: Share of a sequence that a pattern may leave empty, and companions tried per length.
WASTE, COMPANIONS = 0.004, 8
#: Steps of projected gradient.
STEPS = 300


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# Bytes that the byte-level alphabet writes as themselves; the others follow 255.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTES = {b: 0x100 + i for i, b in enumerate(sorted(set(range(256)) - set(_SHOWN)))}


class TokenIds:
    """Ids of whole texts as little-endian 32-bit bytes; words met before are looked up.

    The tokenizer splits at white space and between letters, digits and other signs and lower
    cases, so in plain texts the ids of a text are those of its words in turn, and those of a
    word are what its model makes of the word's pieces.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def piece(self, text: str) -> bytes:
        known = self.pieces.get(text)
        if known is None:
            shown = text if text.isascii() else text.encode().decode("latin-1").translate(_BYTES)
            ids = [t.id for t in self.tokenizer.model.tokenize(shown)]
            known = self.pieces[text] = struct.pack(f"<{len(ids)}I", *ids)
        return known

    def of(self, texts: list[str]) -> list[bytes]:
        split = [None if "<|" in t or PLAIN.search(t) else t.lower().split() for t in texts]
        get = self.words.get
        found = [None if words is None else list(map(get, words)) for words in split]
        unknown = {
            w
            for words, ids in zip(split, found, strict=True)
            if ids is not None and None in ids
            for w, i in zip(words, ids, strict=True)
            if i is None
        }
        fresh = {w: b"".join(map(self.piece, PIECE.findall(w))) for w in unknown}
        if len(self.words) + len(fresh) > REMEMBERED:
            self.words.clear()
        if len(self.pieces) > REMEMBERED:
            self.pieces.clear()
        self.words.update(fresh)
        out = []
        for text, words, ids in zip(texts, split, found, strict=True):
            if words is None:
                own = self.tokenizer.encode(text, add_special_tokens=False).ids
                out.append(struct.pack(f"<{len(own)}I", *own))
            elif None in ids:
                out.append(b"".join([i or fresh.get(w, b"") for w, i in zip(words, ids, strict=True)]))
            else:
                out.append(b"".join(ids))
        return out


_LOADED: dict[str, TokenIds] = {}


def token_pieces(
    docs: DataFrame, size: int = 4096, tokenizer: str | None = None, end_id: int = 1, ids: bool = False
) -> DataFrame:
    """The documents' ids, each document's followed by ``end_id``, cut where longer than
    ``size``; ``ids=True`` adds the ids themselves. ``part`` and ``nth`` number the pieces of
    one length within a task."""
    found_by_tasks(docs.sparkSession)
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _LOADED:
            _LOADED[path] = TokenIds(path)
        part = TaskContext.get().partitionId()
        seen = np.zeros(size + 1, np.int64)
        end = np.array([end_id], "<u4").tobytes()
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                batch = whole.slice(at, 200)
                doc, piece, start, length, crc, nth, held = [], [], [], [], [], [], []
                texts = [t or "" for t in batch.column(1).to_pylist()]
                for doc_id, found in zip(batch.column(0).to_pylist(), _LOADED[path].of(texts)):
                    found += end
                    for i in range(0, len(found), 4 * size):
                        own = found[i : i + 4 * size]
                        n = len(own) // 4
                        doc.append(doc_id)
                        piece.append(i // (4 * size))
                        start.append(i // 4)
                        length.append(n)
                        crc.append(zlib.crc32(own))
                        nth.append(seen[n])
                        seen[n] += 1
                        if ids:
                            held.append(np.frombuffer(own, "<u4").astype(np.int32))
                columns = [
                    pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                    pa.array([part] * len(doc), pa.int64()), pa.array(nth, pa.int64()),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
                if ids:
                    columns.append(pa.array(held, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = (
        "doc_id long, piece int, start long, length long, ids_crc32 long, part long, nth long"
        + ", ids array<int>" * ids
    )
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def patterns(counts: np.ndarray) -> np.ndarray:
    """Few-document length patterns (rows of up to four lengths, padded with 0) that fill a
    sequence but for ``WASTE`` of it."""
    size = len(counts) - 1
    present = np.flatnonzero(counts)
    present = present[(present > 0) & (present < size)]
    if not len(present):
        return np.empty((0, 4), np.int64)

    def below(room: np.ndarray, nth: int) -> np.ndarray:
        """The nth-largest present length that fits each room, 0 if none."""
        at = np.searchsorted(present, room, "right") - 1 - nth
        return np.where(at >= 0, present[np.maximum(at, 0)], 0)

    found = []
    spread = np.linspace(0, 1, COMPANIONS)
    first = present[present * 4 > size]
    for share in spread:
        for nth in range(2):
            second = below(((size - first) * (1 - share / 2)).astype(np.int64), nth)
            third = below(size - first - second, 0)
            fourth = below(size - first - second - third, 0)
            found.append(np.stack([first, second, third, fourth], 1))
    rows = np.unique(-np.sort(-np.concatenate(found), axis=1), axis=0)
    return rows[size - rows.sum(axis=1) <= WASTE * size]


def repeats(rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """x >= 0 that minimises ||A x - counts||, A the lengths' multiplicities in the patterns."""
    n, wanted = len(counts), counts.astype(float).copy()
    wanted[0] = 0
    used = rows > 0

    def forward(x: np.ndarray) -> np.ndarray:
        return np.bincount(rows[used], np.repeat(x, used.sum(axis=1)), n)

    def back(y: np.ndarray) -> np.ndarray:
        y = y.copy()
        y[0] = 0
        return y[rows].sum(axis=1)

    v = np.ones(len(rows))
    for _ in range(20):
        v = back(forward(v))
        norm = np.linalg.norm(v)
        v /= norm
    x = z = np.zeros(len(rows))
    t = 1.0
    for _ in range(STEPS):
        nxt = np.maximum(0, z - back(forward(z) - wanted) / (1.05 * norm))
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        z = nxt + (before - 1) / t * (nxt - x)
        x = nxt
    return x


def best_fit(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Best fit decreasing over a histogram: sequences with the same content move together."""
    size = len(counts) - 1
    open_by_room: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(size + 1)]
    has = np.zeros(size + 1, bool)

    def put(pattern: tuple[int, ...], n: int, room: int) -> None:
        open_by_room[room].append((pattern, n))
        has[room] = True

    for length in range(size, 0, -1):
        left = int(counts[length])
        while left:
            room = length + int(np.argmax(has[length:]))
            if has[room]:
                pattern, n = open_by_room[room].pop()
                has[room] = bool(open_by_room[room])
                each = min(room // length, -(-left // n))
                fill = min(n, left // each)
                put(pattern + (length,) * each, fill, room - each * length)
                if n > fill:
                    put(pattern, n - fill, room)
                left -= fill * each
            else:
                each = min(size // length, left)
                put((length,) * each, left // each, size - each * length)
                left -= left // each * each
    return [x for groups in open_by_room for x in groups]


def plan(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of one sequence, how many such sequences) so that every piece is placed once."""
    size = len(counts) - 1
    left = counts.astype(np.int64).copy()
    left[0] = 0
    out = [((size,), int(left[size]))] if left[size] else []
    left[size] = 0
    rows = patterns(left)
    if len(rows):
        times = np.floor(repeats(rows, left) + 1e-6).astype(np.int64)
        for i in np.lexsort((-times, rows.sum(axis=1) * -1)):
            if times[i] > 0:
                lengths, each = np.unique(rows[i][rows[i] > 0], return_counts=True)
                n = int(min(times[i], (left[lengths] // each).min()))
                if n > 0:
                    left[lengths] -= n * each
                    out.append((tuple(int(x) for x in rows[i] if x), n))
    return out + best_fit(left)


def intervals(planned: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset): the piece of that length with rank
    first + i goes to sequence + i at the offset. Sorted by length and rank."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, n in planned:
        offset = 0
        for length in lengths:
            rank = taken.get(length, 0)
            taken[length] = rank + n
            rows.append((length, rank, sequence, offset))
            offset += length
        sequence += n
    table = np.array(rows, np.int64).reshape(-1, 4)
    return table[np.lexsort((table[:, 1], table[:, 0]))]


def _placed(table) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = table.value
        keys = (rows[:, 0] << 48) + rows[:, 1]
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(keys, (batch.column("length").to_numpy() << 48) + rank, "right") - 1
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names]
                + [pa.array(rows[at, 2] + rank - rows[at, 1]), pa.array(rows[at, 3])],
                names=[*names, "sequence_id", "offset"],
            )

    return run


def pack_documents(
    docs: DataFrame, size: int = 4096, tokenizer: str | None = None, end_id: int = 1, ids: bool = False
) -> DataFrame:
    """Packs all documents into sequences of at most ``size`` tokens.

    Returns per piece doc_id, piece, start, length, ids_crc32, sequence_id and offset, and the
    ids with ``ids=True``. Null and empty texts are documents of the end id alone. Repeated rows
    are packed as often as they occur; a null doc_id stays null. Other columns of ``docs`` are
    not looked at. An empty table gives no rows.
    """
    pieces = stored(token_pieces(docs, size, tokenizer, end_id, ids), "pieces")
    counts = np.zeros(size + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():  # at most one row per length
        counts[row["length"]] = row["count"]
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(intervals(plan(counts)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        pieces.groupBy("length", "part")
        .count()
        .select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    )
    ranked = pieces.join(stored(starts, "starts"), ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if ids else []),
        (F.col("before") + F.col("nth")).alias("rank"),
    )
    schema = (
        "doc_id long, piece int, start long, length long, ids_crc32 long"
        + ", ids array<int>" * ids
        + ", sequence_id long, offset long"
    )
    return ranked.mapInArrow(_placed(table), schema)
