"""How quality filters overlap and depend on their order.

A table-driven transducer reads every text's UTF-8 bytes once. Its class table sorts bytes, its
transition and action tables say what a byte does in a state: begin a word, end one, count as a
code point, a capital or a symbol. The word spans it emits go into an open-addressing hash table
in which a slot is only shared by words whose bytes were compared. Each text is then a few
numbers, and all that follows is joins and sums of small rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieout.llm.common import found_by_tasks, mixed, salt, stored

# White space that parts words, and signs that count as symbols.
SPACE, SYMBOLS = b"\x20\x09\x0a\x0b\x0c\x0d", b"#$%&*|"
#: The filters' letters; bit i of a mask stands for letter i.
FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
#: Bytes of text read in one go; a longer text is read alone.
SLICE = 1 << 20
#: Words up to this long are compared in numpy, eight bytes at a time.
SHORT = 64

# Byte classes, states and actions of the transducer.
GAP, PLAIN, CAPITAL, SYMBOL, LEAD, TAIL = range(6)
BETWEEN, INSIDE = range(2)
BEGIN, END, POINT, UPPER, SIGN = 1, 2, 4, 8, 16


def _class_table() -> np.ndarray:
    of = np.full(256, PLAIN, np.uint8)
    of[0x80:0xC0], of[0xC0:] = TAIL, LEAD
    of[ord("A") : ord("Z") + 1] = CAPITAL
    of[list(SYMBOLS)] = SYMBOL
    of[list(SPACE)] = GAP
    return of


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Next state by class, the same from either state, and the actions by state and class."""
    after = np.array([BETWEEN if c == GAP else INSIDE for c in range(6)], np.uint8)
    does = np.zeros((2, 6), np.uint8)
    for state in (BETWEEN, INSIDE):
        for c in range(6):
            if c == GAP:
                does[state, c] = END * (state == INSIDE) | POINT
            else:
                does[state, c] = (
                    BEGIN * (state == BETWEEN) | POINT * (c != TAIL) | UPPER * (c == CAPITAL) | SIGN * (c == SYMBOL)
                )
    return after, does


CLASS_OF = _class_table()
NEXT, ACTION = _tables()


@dataclass(frozen=True)
class Limits:
    #: A: fewer words fail. B: a smaller share of distinct words fails, in hundredths.
    words: int = 50
    distinct: int = 65
    #: C: a larger share of capitals among code points fails, in hundredths.
    capitals: int = 5


def transduce(data: np.ndarray, ends: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Run the transducer over texts that lie one after the other in ``data``.

    Returns counts per text (words, code points, capitals, symbols) and the words' first bytes
    and the bytes after their last. At its end a text is flushed: an open word ends there.
    """
    begins = np.concatenate([[0], ends[:-1]])
    full = begins < ends
    kind = CLASS_OF[data]
    state = NEXT[kind]
    before = np.empty_like(state)
    before[1:] = state[:-1]
    before[begins[full]] = BETWEEN
    act = ACTION.ravel()[before * np.uint8(6) + kind]
    edges = np.concatenate([[0], ends])

    def places(bit: int) -> np.ndarray:
        return np.flatnonzero(act & bit)

    def per_text(at: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(at, edges))

    first = places(BEGIN)
    flushed = ends[full][state[ends[full] - 1] == INSIDE]
    last = np.concatenate([places(END), flushed])
    last.sort()
    counts = {
        "words": per_text(first),
        "code_points": np.diff(edges) - per_text(np.flatnonzero(kind == TAIL)),
        "capitals": per_text(places(UPPER)),
        "symbols": per_text(places(SIGN)),
    }
    return counts, first, last


class WordTable:
    """Open-addressing hash table of word spans, one key per word and text, with compared bytes."""

    def __init__(self, data: np.ndarray, first: np.ndarray, last: np.ndarray, text: np.ndarray):
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        #: Eight bytes from any place, read as one number.
        self.eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
        self.data, self.first, self.text = data, first, text
        self.length = last - first
        self.head = self._part(np.arange(len(first)), 0)

    def _part(self, words: np.ndarray, k: int) -> np.ndarray:
        """The k-th eight bytes of each word, zeros after its end."""
        left = np.minimum(self.length[words] - 8 * k, 8)
        keep = np.uint64(0xFFFFFFFFFFFFFFFF) >> ((8 - left) * 8).astype(np.uint64)
        return self.eight[self.first[words] + 8 * k] & keep

    def hashes(self) -> np.ndarray:
        h = mixed(self.head ^ (self.text.astype(np.uint64) * salt(1) + self.length.astype(np.uint64) * salt(3)))
        k, open_ = 1, np.flatnonzero(self.length > 8)
        while len(open_) and 8 * k < SHORT:
            h[open_] = mixed(h[open_] * salt(5) ^ self._part(open_, k))
            k += 1
            open_ = open_[self.length[open_] > 8 * k]
        return h

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether words a and b, pair by pair, are the same bytes of the same text."""
        same = (self.head[a] == self.head[b]) & (self.text[a] == self.text[b]) & (self.length[a] == self.length[b])
        k, open_ = 1, np.flatnonzero(same & (self.length[a] > 8) & (a != b))
        while len(open_) and 8 * k < SHORT:
            ok = self._part(a[open_], k) == self._part(b[open_], k)
            same[open_[~ok]] = False
            k += 1
            open_ = open_[ok]
            open_ = open_[self.length[a[open_]] > 8 * k]
        for i in open_:
            x, y, n = self.first[a[i]], self.first[b[i]], self.length[a[i]]
            same[i] = np.array_equal(self.data[x + SHORT : x + n], self.data[y + SHORT : y + n])
        return same

    def distinct(self, n_texts: int) -> np.ndarray:
        """How many different words each text has: the slots that its words claim."""
        n = len(self.first)
        bits = max(4, (2 * n).bit_length())
        slots = np.full(1 << bits, -1, np.int32)
        at = (self.hashes() >> np.uint64(64 - bits)).astype(np.int64)
        todo = np.arange(n, dtype=np.int32)
        found = np.zeros(n_texts, np.int64)
        while len(todo):
            here = at[todo]
            free = slots[here] < 0
            slots[here[free]] = todo[free]  # of words that want one slot, one gets it
            owner = slots[here]
            found += np.bincount(self.text[todo[owner == todo]], minlength=n_texts)
            todo = todo[~self.equal(owner, todo)]
            at[todo] = (at[todo] + 1) & (len(slots) - 1)
        return found


def _slices(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``SLICE`` bytes, of one text at least."""
    at = 0
    while at < len(ends):
        begin = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, begin + SLICE, "right")))
        yield at, to
        at = to


def text_facts(docs: DataFrame) -> DataFrame:
    """doc_id, part, text_key (of the whole text), words, distinct_words, code_points, capitals
    and symbols of every row; a null text counts as empty, a null source as the empty string."""
    found_by_tasks(docs.sparkSession)
    names = ["words", "distinct_words", "code_points", "capitals", "symbols"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            for a, b in _slices(ends):
                raw = [t or b"" for t in texts.slice(a, b - a).to_pylist()]
                data = np.frombuffer(b"".join(raw), np.uint8)
                to = ends[a:b] - (ends[a - 1] if a else 0)
                counts, first, last = transduce(data, to)
                text = np.repeat(np.arange(b - a), counts["words"])
                counts["distinct_words"] = WordTable(data, first, last, text).distinct(b - a)
                keys = [hashlib.blake2b(t, digest_size=16).digest() for t in raw]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(keys, pa.binary())]
                    + [pa.array(counts[n], pa.int64()) for n in names],
                    names=["doc_id", "part", "text_key", *names],
                )

    columns = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.col("text").cast("binary").alias("text"),
    )
    return columns.mapInArrow(
        run, "doc_id long, part string, text_key binary, " + ", ".join(f"{n} long" for n in names)
    )


def filter_failures(docs: DataFrame, limits: Limits | None = None) -> DataFrame:
    """One row per document: the facts of its text and ``mask``, whose bits 0 to 4 say that it
    fails A to E. A row without an id never fails E and makes no other row fail it; rows that
    repeat the least id of a text pass E alike."""
    limits = limits or Limits()
    facts = stored(text_facts(docs), "facts")
    # joined by text and id, so many copies of one text are spread by their ids
    first = facts.groupBy("text_key").agg(F.min("doc_id").alias("doc_id")).where("doc_id is not null")
    rows = facts.join(first.withColumn("least", F.lit(True)), ["text_key", "doc_id"], "left")
    fails: list[Column] = [
        F.col("words") < limits.words,
        100 * F.col("distinct_words") < limits.distinct * F.col("words"),
        100 * F.col("capitals") > limits.capitals * F.col("code_points"),
        F.col("symbols") > 0,
        F.col("doc_id").isNotNull() & F.col("least").isNull(),
    ]
    mask = sum((F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(fails)), F.lit(0))
    return rows.withColumn("mask", mask).drop("least")


def filter_audit(docs: DataFrame, labels: DataFrame, limits: Limits | None = None) -> DataFrame:
    """One row per source value, order of the five filters and step, zeros included: documents
    kept after the step, removed by it, redundant (its filter fails them, an earlier one had
    removed them), failing its filter only, removed good and toxic ones, and the filter's
    removals summed over all orders.

    Words are maximal runs of bytes other than ASCII white space and compared byte by byte;
    texts of any length are read whole. A null text is empty: it fails A, and E if it repeats.
    Documents count as good or toxic if any of the labels' rows of their id says so; ids without
    labels count as neither. Other columns are left alone. No documents give no rows. Rows count
    as often as they stand in the table.
    """
    good, toxic = (F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("long")) for c in ("quality", "toxic"))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marks = marks.agg(good.alias("good"), toxic.alias("toxic"))
    rows = filter_failures(docs, limits).select("doc_id", "part", "mask").join(marks, "doc_id", "left")
    sums = [F.count("*").alias("n")] + [F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic")]
    # at most 32 rows of each part
    by_mask = rows.groupBy("part", "mask").agg(*sums)
    parts = by_mask.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    return _per_step(parts)


def _per_step(parts: DataFrame) -> DataFrame:
    """The audit's rows from the counts of each part by the filters that fail."""
    steps = []
    for order in ORDERS:
        before = 0
        for k, letter in enumerate(order, 1):
            own = 1 << FILTERS.index(letter)
            steps.append(F.struct(*(F.lit(x).alias(n) for n, x in (
                ("filter_order", "".join(order)), ("step", k), ("own", own), ("before", before)))))
            before |= own
    at = parts.select("part", "masks", F.explode(F.array(*steps)).alias("at")).select("part", "masks", "at.*")
    own, before = F.col("own"), F.col("before")
    none = F.lit(0).cast("int")

    def total(field: str, test: Callable[[Column], Column]) -> Column:
        chosen = F.filter("masks", lambda m: test(m["mask"]))
        return F.aggregate(chosen, F.lit(0).cast("long"), lambda done, m: done + m[field])

    def removed(mask: Column) -> Column:
        return (mask.bitwiseAND(own) != none) & (mask.bitwiseAND(before) == none)

    # of k failing filters each comes first in 120/k of the orders
    share = F.aggregate(
        F.filter("masks", lambda m: m["mask"].bitwiseAND(own) != none),
        F.lit(0).cast("long"),
        lambda done, m: done + m["n"] * F.element_at(F.array(*(F.lit(len(ORDERS) // k).cast("long") for k in range(1, 6))), F.bit_count(m["mask"])),
    )
    return at.select(
        "part",
        "filter_order",
        "step",
        total("n", lambda m: m.bitwiseAND(own.bitwiseOR(before)) == none).alias("kept"),
        total("n", removed).alias("removed"),
        total("n", lambda m: (m.bitwiseAND(own) != none) & (m.bitwiseAND(before) != none)).alias("redundant"),
        total("n", lambda m: m == own).alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"),
        share.alias("shapley"),
    )
