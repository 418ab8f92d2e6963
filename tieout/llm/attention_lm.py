"""Causal self-attention over subword ids, trained in numpy, and the scores of whole texts.

The model reads windows of ids: each id's embedding attends to the ids before it in its window,
with a bias for each distance, passes a small hidden layer and predicts the next id in two steps,
a class of items and an item of the class. Windows overlap, so every id has context, and each id
is scored in exactly one window. Windows are computed in batches under a causal mask.

Training runs where the texts are, over every window of every training document once. Documents
are dealt to the rounds by the hash of their id. In each round every task takes steps of its own
through its part of the round's documents; then the tasks' parameters are averaged, chunk by
chunk, in Spark. Counts of ids and of words, these for the plain score beside the model's, are
those of all training documents. Texts are cut into ids once, and kept as such.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieout.llm.common import fold, found_by_tasks, stored

#: Words a task remembers at a time; a limit of memory only.
REMEMBERED = 500_000
#: Documents of a batch of texts, and bytes of one.
DOCS, BYTES = 2_000, 1 << 22
#: Ids of a batch of texts that are already cut into ids.
IDS = 1 << 19
#: Floats of one chunk of parameters.
CHUNK = 8_192
#: Windows whose attention is computed at once, and rows of the output layer.
BATCH, ROWS = 128, 1_024
#: Windows whose items are predicted at once.
OUTPUT = 1_024
#: Scores and logits are held below this; what is not to be seen gets a score without weight.
LARGEST, NEVER = np.float32(60), np.float32(-1e9)


@dataclass(frozen=True)
class Settings:
    #: Ids scored in a window, and ids before the first of them that it also holds.
    block: int = 16
    context: int = 16
    #: Width of embeddings and of the hidden layer.
    width: int = 16
    hidden: int = 16
    #: Classes and items of a class; all ids beyond the most frequent ones share one item.
    classes: int = 32
    members: int = 32
    #: Parts that the training documents are dealt to, and rounds of training, which read these
    #: parts in turn: each document is in one round.
    rounds: int = 4
    part: int = 96
    #: Rate of learning in the first round and the last.
    first_rate: float = 0.02
    last_rate: float = 0.004
    #: Windows of a task's first steps in a round; later ones take one in 64 of those it has seen,
    #: up to the most.
    step: int = 64
    most: int = 512
    #: Windows that one task trains on at least, as far as there are as many.
    per_task: int = 16_384
    #: A word of at least one in so many tokens is looked up in tasks, at most so many words.
    frequent: int = 50_000

    @property
    def items(self) -> int:
        return self.classes * self.members


class Lexicon(dict):
    """Numbers of the words met by a task, with their hashes, subword ids and known counts."""

    def __init__(self, tokenizer=None, slots: np.ndarray | None = None, known: dict[int, float] | None = None):
        self.tokenizer, self.slots, self.known = tokenizer, slots, known
        self.restart()

    def restart(self) -> None:
        self.clear()
        self.fresh: list[bytes] = []
        self.hashes = np.empty(0, np.int64)
        self.logs = np.empty(0)
        self.pool = np.empty(0, np.int32)
        self.starts = np.zeros(1, np.int64)

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.fresh.append(word)
        return number

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The words' numbers; what the tables hold of new words is filled in."""
        out = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if not self.fresh:
            return out
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.fresh), np.uint64, len(self.fresh)).view(np.int64)
        self.hashes = np.concatenate([self.hashes, hashes])
        if self.known is not None:
            get = self.known.get
            self.logs = np.concatenate([self.logs, [get(h, math.nan) for h in hashes.tolist()]])
        if self.tokenizer is not None:
            ids = self.tokenizer.encode([w.decode() for w in self.fresh], num_threads=1)
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter(chain.from_iterable(ids), np.int32, int(lengths.sum()))
            self.pool = np.concatenate([self.pool, flat])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
        self.fresh = []
        return out

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Subword ids of the words in turn, and how many each has."""
        begin, n = self.starts[numbers], np.diff(self.starts)[numbers]
        ends = np.cumsum(n)
        at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begin - (ends - n), n)
        return self.pool[at], n


_TOKENIZERS: dict[str, object] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def tokenizer_at(path: str):
    """The subword tokenizer in a file; each word is a text of its own to it."""
    if path not in _TOKENIZERS:
        import sentencepiece

        _TOKENIZERS[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _TOKENIZERS[path]


@dataclass(frozen=True)
class Vocabulary:
    """Items of the tokenizer's ids. ``slots`` has the item of each id, the end of a text being
    the id after the last; ``rare`` the log probability of each id within the shared item."""

    slots: np.ndarray
    rare: np.ndarray
    bias: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray, s: Settings) -> Vocabulary:
        """From the counts of all ids and, last, of ends of texts."""
        n = s.items - 1
        order = np.lexsort((np.arange(len(counts) - 1), -counts[:-1]))
        own = np.sort(np.concatenate([order[: n - 1], [len(counts) - 1]]))
        own = own[np.lexsort((own, -counts[own]))]
        slots = np.full(len(counts), n, np.int32)
        slots[own] = np.arange(len(own))
        rest = np.where(slots == n, counts + 1.0, 0.0)
        rare = np.where(rest > 0, np.log(np.where(rest > 0, rest, 1.0) / max(rest.sum(), 1.0)), 0.0)
        weight = np.full(s.items, 0.1)
        np.add.at(weight, slots, counts)
        return cls(slots, rare.astype(np.float32), np.log(weight / weight.sum()))


def first_parameters(vocabulary: Vocabulary, s: Settings, seed: int = 1) -> dict[str, np.ndarray]:
    """Small random weights; the biases make the untrained model that of single items."""
    rng = np.random.default_rng(seed)
    d, logs = s.width, vocabulary.bias.reshape(s.classes, s.members)
    of_class = np.logaddexp.reduce(logs, axis=1)

    def normal(scale: float, *shape: int) -> np.ndarray:
        return rng.normal(0, scale, shape)

    p = {
        "embed": normal(0.3, s.items + 1, d),
        "query": normal(d**-0.5, d, d),
        "key": normal(d**-0.5, d, d),
        "value": normal(d**-0.5, d, d),
        "distance": np.zeros(s.block + s.context),
        "enter": normal(d**-0.5, d, s.hidden),
        "enter_bias": np.zeros(s.hidden),
        "leave": normal(s.hidden**-0.5, s.hidden, d),
        "classes": normal(0.05, s.classes, d),
        "class_bias": of_class,
        "items": normal(0.05, s.classes, s.members, d),
        "item_bias": logs - of_class[:, None],
    }
    return {k: v.astype(np.float32) for k, v in p.items()}


def flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)]).astype(np.float32)


def shaped(values: np.ndarray, like: dict[str, np.ndarray], views: bool = False) -> dict[str, np.ndarray]:
    """Parameters out of their row; with ``views`` they stay parts of it."""
    out, at = {}, 0
    for k in sorted(like):
        out[k] = values[at : at + like[k].size].reshape(like[k].shape).astype(np.float32, copy=not views)
        at += like[k].size
    return out


class Model:
    """Forward and backward passes over batches of windows.

    A window is ``context + block + 1`` items: the last ``block`` are predicted, each from the
    items before it. The item ``start`` stands before a text, ``-1`` where there is nothing.
    """

    def __init__(self, p: dict[str, np.ndarray], s: Settings):
        self.p, self.s = p, s
        n, ahead = s.block + s.context, s.context
        at, to = np.arange(ahead, n)[:, None], np.arange(n)[None, :]
        self.apart = np.clip(at - to, 0, n - 1)
        self.later = to > at
        self.start = s.items

    def windows(self, items: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Windows of texts whose items lie one after the other, each with its end; row after
        row they predict every item once, in order, with ``-1`` behind a text's last."""
        s = self.s
        blocks = -(-lengths // s.block)
        room = s.context + 1 + blocks * s.block
        begin = np.concatenate([[0], np.cumsum(room)[:-1]]).astype(np.int64)
        line = np.full(int(room.sum()), -1, np.int32)
        line[begin + s.context] = self.start
        ends = np.cumsum(lengths)
        at = np.arange(len(items)) + np.repeat(begin + s.context + 1 - (ends - lengths), lengths)
        line[at] = items
        first = np.repeat(begin, blocks) + s.block * (
            np.arange(int(blocks.sum())) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        )
        return np.lib.stride_tricks.sliding_window_view(line, s.context + s.block + 1)[first]

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each item its query, and its key and value: one product for each item instead of one
        for each place. Queries are scaled."""
        embed, p = self.p["embed"], self.p
        query = (embed @ p["query"]) * np.float32(self.s.width**-0.5)
        return query, embed @ np.hstack([p["key"], p["value"]])

    def _weights(self, q: np.ndarray, k: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """Weights of attention, not yet divided by their sums; 0 for later ids and for nothing.
        A row for each place that is seen, so that no product runs along the rows of both."""
        scores = k @ np.ascontiguousarray(q.transpose(0, 2, 1))
        scores += np.where(self.later.T, NEVER, self.p["distance"][self.apart.T])
        # only a text's first window begins with nothing; what follows a text is later than all of it
        begun = np.flatnonzero(seen[:, 0] < 0)
        if len(begun):
            window, place = np.nonzero(seen[begun] < 0)
            scores[begun[window], place] = NEVER
        return _exponentials(scores)

    def _states(self, x: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> dict[str, np.ndarray]:
        """The states ``z`` that the output layer reads, and what the backward pass needs of them.
        What stands for nothing has the rows of ``start``, and no weight."""
        p, s = self.p, self.s
        seen, w = x[:, :-1], s.width
        e = p["embed"].take(seen[:, s.context :], axis=0, mode="wrap")
        q = tables[0].take(seen[:, s.context :], axis=0, mode="wrap")
        theirs = tables[1].take(seen, axis=0, mode="wrap")
        k, v = theirs[..., :w], theirs[..., w:]
        weights = self._weights(q, k, seen)
        share = 1 / (np.ones(weights.shape[1], weights.dtype) @ weights)[..., None]
        mean = weights.transpose(0, 2, 1) @ v
        mean *= share
        e += mean
        h = e.reshape(-1, w)
        inner = h @ p["enter"]
        inner += p["enter_bias"]
        np.maximum(inner, 0, out=inner)
        z = inner @ p["leave"]
        z += h
        return {
            "q": q, "k": k, "v": v, "weights": weights, "share": share, "mean": mean,
            "h": h, "inner": inner, "z": z,
        }

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        """Natural logarithms of the predicted items, in a row; 0 where there is none."""
        s, tables = self.s, self.tables()
        out = np.zeros(len(x) * s.block, np.float32)
        for begin in range(0, len(x), OUTPUT):
            lot = x[begin : begin + OUTPUT]
            parts = range(0, len(lot), BATCH)
            z = np.concatenate([self._states(lot[at : at + BATCH], tables)["z"] for at in parts])
            y = lot[:, -s.block :].ravel()
            there = np.flatnonzero(y >= 0)
            out[begin * s.block + there] = self._output(z, y, there)
        return out

    def _by_class(self, y: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
        """Places of the items to be predicted, class by class, the classes and members of these
        items, and where each class begins."""
        t = y[there]
        kind = t // self.s.members
        order = np.argsort(kind.astype(np.int16), kind="stable")
        kind = kind[order]
        edges = np.searchsorted(kind, np.arange(self.s.classes + 1)).tolist()
        return order, kind, t[order] % self.s.members, edges

    def _with_biases(self) -> tuple[np.ndarray, np.ndarray]:
        """Weights of classes and of items, the biases in a last column."""
        p = self.p
        return (
            np.concatenate([p["classes"], p["class_bias"][:, None]], axis=1),
            np.concatenate([p["items"], p["item_bias"][..., None]], axis=2),
        )

    def _spans(self, edges: list[int]) -> Iterator[tuple[slice, list[tuple[int, slice, slice]]]]:
        """Some classes at a time: their rows, and each one's number with its rows among all and
        among these."""
        span, begin = [], 0
        for c in range(self.s.classes):
            a, b = edges[c], edges[c + 1]
            if a < b:
                span.append((c, slice(a, b), slice(a - begin, b - begin)))
            if span and (b - begin >= ROWS or c + 1 == self.s.classes):
                yield slice(begin, b), span
                span, begin = [], b

    def _output(self, z: np.ndarray, y: np.ndarray, there: np.ndarray) -> np.ndarray:
        """Log probability of each item's class, plus that of the item within its class."""
        order, kind, member, edges = self._by_class(y, there)
        z = _with_ones(z, there[order])
        classes, items = self._with_biases()
        found = np.empty(len(order), np.float32)
        for at in range(0, len(order), ROWS):
            to = at + ROWS
            found[at:to] = _log_chosen(z[at:to] @ classes.T, kind[at:to])
        for rows, span in self._spans(edges):
            d = np.empty((rows.stop - rows.start, self.s.members), z.dtype)
            for c, among_all, here in span:
                np.matmul(z[among_all], items[c].T, out=d[here])
            found[rows] += _log_chosen(d, member[rows])
        out = np.empty_like(found)
        out[order] = found
        return out

    def _output_gradients(
        self, z: np.ndarray, y: np.ndarray, there: np.ndarray, g: dict[str, np.ndarray]
    ) -> tuple[float, np.ndarray]:
        """Loss of the predicted items, and its gradient in the states; that in the output layer's
        parameters goes to ``g``. All are sums over the items."""
        w, m = self.s.width, self.s.members
        order, kind, member, edges = self._by_class(y, there)
        places = there[order]
        whole = np.zeros_like(z)
        z = _with_ones(z, places)
        classes, items = self._with_biases()
        of_classes, of_items = np.zeros_like(classes), np.zeros_like(items)
        dz = np.empty((len(z), w), z.dtype)
        loss = 0.0
        for at in range(0, len(z), ROWS):
            rows = slice(at, at + ROWS)
            d = z[rows] @ classes.T
            loss += _shares_less_chosen(d, kind[rows])
            of_classes += d.T @ z[rows]
            np.matmul(d, self.p["classes"], out=dz[rows])
        for rows, span in self._spans(edges):
            d = np.empty((rows.stop - rows.start, m), z.dtype)
            for c, among_all, here in span:
                np.matmul(z[among_all], items[c].T, out=d[here])
            loss += _shares_less_chosen(d, member[rows])
            more = np.empty((len(d), w), z.dtype)
            for c, among_all, here in span:
                np.matmul(d[here].T, z[among_all], out=of_items[c])
                np.matmul(d[here], self.p["items"][c], out=more[here])
            dz[rows] += more
        g["classes"], g["class_bias"] = of_classes[:, :w], of_classes[:, w]
        g["items"], g["item_bias"] = of_items[..., :w], of_items[..., w]
        whole[places] = dz
        return loss, whole

    def gradients(self, x: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss of the predicted items, and its gradient in every parameter."""
        p, s, w = self.p, self.s, self.s.width
        tables = self.tables()
        lots = [slice(at, at + BATCH) for at in range(0, len(x), BATCH)]
        states = [self._states(x[lot], tables) for lot in lots]
        y = x[:, -s.block :].ravel()
        there = np.flatnonzero(y >= 0)
        # sums over the items; all are divided by their number in the end
        g = {k: np.zeros_like(p[k]) for k in ("leave", "enter", "enter_bias", "query")}
        loss, dz = self._output_gradients(np.concatenate([f["z"] for f in states]), y, there, g)
        dz = dz.reshape(len(x), s.block, w)
        distance = np.zeros(self.apart.shape[::-1], dz.dtype)
        of_theirs = np.zeros((w, 2 * w), dz.dtype)
        from_theirs = np.concatenate([p["key"], p["value"]], axis=1).T
        # no weight of what stands for nothing comes to any row
        seen = np.where(x[:, :-1] < 0, s.items, x[:, :-1])
        embedded = np.empty((*seen.shape, w), dz.dtype)
        for lot, f in zip(lots, states, strict=True):
            # hidden layer
            whole = dz[lot].reshape(-1, w)
            g["leave"] += f["inner"].T @ whole
            d = whole @ p["leave"].T
            d *= f["inner"] > 0
            g["enter"] += f["h"].T @ d
            g["enter_bias"] += _sums(d)
            dh = dz[lot]
            dh += (d @ p["enter"].T).reshape(dh.shape)
            # attention: weights were not divided by their sums, so what they are multiplied with is
            part = dh * f["share"]
            ds = f["v"] @ np.ascontiguousarray(part.transpose(0, 2, 1))
            ds -= ((part * f["mean"]).reshape(-1, w) @ np.ones(w, dz.dtype)).reshape(-1, 1, s.block)
            ds *= f["weights"]
            distance += ds.sum(axis=0)
            dq = ds.transpose(0, 2, 1) @ f["k"]
            dq *= np.float32(w**-0.5)
            theirs = np.empty((*ds.shape[:2], 2 * w), dz.dtype)
            np.matmul(ds, f["q"], out=theirs[..., :w])
            np.matmul(f["weights"], part, out=theirs[..., w:])
            # embeddings
            e = p["embed"].take(seen[lot], axis=0)
            theirs = theirs.reshape(-1, 2 * w)
            of_theirs += e.reshape(-1, w).T @ theirs
            g["query"] += e[:, s.context :].reshape(-1, w).T @ dq.reshape(-1, w)
            np.matmul(theirs, from_theirs, out=embedded[lot].reshape(-1, w))
            dh += (dq.reshape(-1, w) @ p["query"].T).reshape(dh.shape)
            embedded[lot, s.context :] += dh
        g["key"], g["value"] = of_theirs[:, :w], of_theirs[:, w:]
        g["distance"] = np.bincount(
            self.apart.T.ravel(), distance.ravel(), minlength=len(p["distance"])
        ).astype(p["distance"].dtype)
        g["embed"] = _sums_by(seen.ravel(), embedded.reshape(-1, w), s.items + 1)
        n = np.float32(max(len(there), 1))
        for d in g.values():
            d /= n
        return loss / float(n), g


def _with_ones(z: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The states at these places, with a 1 that biases are multiplied with."""
    out = np.ones((len(places), z.shape[1] + 1), z.dtype)
    out[:, :-1] = z.take(places, axis=0)
    return out


def _exponentials(x: np.ndarray) -> np.ndarray:
    """Exponentials, in place, of what is held below the largest."""
    if x.max(initial=0) > LARGEST:
        np.minimum(x, LARGEST, out=x)
    return np.exp(x, out=x)


def _log_chosen(logits: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Logarithm of the chosen one's share of the exponentials in each row."""
    at = np.arange(0, logits.size, logits.shape[1]) + chosen
    own = np.minimum(logits.reshape(-1).take(at), LARGEST)
    _exponentials(logits)
    return own - np.log(logits @ np.ones(logits.shape[1], logits.dtype))


def _shares_less_chosen(logits: np.ndarray, chosen: np.ndarray) -> float:
    """Turn logits into shares of the exponentials in each row, less 1 for the chosen one; returns
    the sum of the chosen ones' negative logarithms."""
    _exponentials(logits)
    logits *= 1 / (logits @ np.ones(logits.shape[1], logits.dtype))[:, None]
    flat_shares = logits.reshape(-1)
    at = np.arange(0, logits.size, logits.shape[1]) + chosen
    own = flat_shares[at]
    flat_shares[at] = own - 1
    return -float(np.log(own).sum())


def _sums(rows: np.ndarray) -> np.ndarray:
    return np.ones(len(rows), rows.dtype) @ rows


def _sums_by(numbers: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of each number below ``n``; rows are of an even width, and two of their
    values are added as one complex number."""
    out = np.zeros((n, rows.shape[1]), rows.dtype)
    pairs = np.result_type(rows.dtype, np.complex64)
    # short numbers are sorted by digits
    order = np.argsort(numbers.astype(np.int16) if n <= 1 << 15 else numbers, kind="stable")
    counts = np.bincount(numbers, minlength=n)
    found = np.flatnonzero(counts)
    first = np.append(0, np.cumsum(counts[found]))
    # some rows at a time, which the processor has at hand
    at = 0
    while at < len(found):
        to = max(at + 1, int(np.searchsorted(first, first[at] + ROWS, "right")) - 1)
        lot = rows.take(order[first[at] : first[to]], axis=0).view(pairs)
        out.view(pairs)[found[at:to]] = np.add.reduceat(lot, first[at:to] - first[at], axis=0)
        at = to
    return out


class Adam:
    """Steps along running means of the gradient, scaled by those of its squares."""

    def __init__(self, rate: float, first: float = 0.9, second: float = 0.99):
        self.rate, self.first, self.second, self.n = rate, first, second, 0
        self.mean: dict[str, np.ndarray] = {}
        self.square: dict[str, np.ndarray] = {}

    def step(self, p: dict[str, np.ndarray], g: dict[str, np.ndarray]) -> None:
        self.n += 1
        scale = self.rate * math.sqrt(1 - self.second**self.n) / (1 - self.first**self.n)
        for k, d in g.items():
            m = self.mean.setdefault(k, np.zeros_like(d))
            v = self.square.setdefault(k, np.zeros_like(d))
            m += (1 - self.first) * (d - m)
            v += (1 - self.second) * (d * d - v)
            p[k] -= np.float32(scale) * m / (np.sqrt(v) + np.float32(1e-8))


def _lots(texts: pa.Array) -> Iterator[tuple[slice, list[bytes], np.ndarray, np.ndarray]]:
    """The texts' words, some texts at a time: (which texts, different words in lower case, the
    word at each place, words of each text)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at, before = 0, 0
    while at < len(texts):
        to = min(max(at + 1, int(np.searchsorted(ends, before + BYTES, "right"))), at + DOCS)
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts[at:to]))
        sizes = pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        encoded = split.flatten().dictionary_encode()
        words = encoded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        places = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        if b"" in words:  # before white space that a text begins with, and after its last
            nothing = words.index(b"")
            there = places != nothing
            sizes = np.bincount(np.repeat(np.arange(to - at), sizes)[there], minlength=to - at)
            places = places[there]
            places -= places > nothing
            del words[nothing]
        yield slice(at, to), words, places, sizes
        at, before = to, ends[to - 1]


def _learned_from(held_out: Column) -> Column:
    return F.coalesce(~held_out, F.lit(False))


def word_counts(docs: DataFrame) -> DataFrame:
    """(key, n) of every word of the documents: 64 bits of its hash, and how often it stands.

    Words of one hash count as one; of 10^10 different words about three pairs do."""
    found_by_tasks(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, counts = Lexicon(), np.zeros(0, np.int64)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(lexicon.hashes), pa.array(counts)], names=["key", "n"]
            )

        for batch in batches:
            for _, words, places, _ in _lots(batch.column(0)):
                numbers = lexicon.numbers(words)
                counts = np.append(counts, np.zeros(len(lexicon) - len(counts), np.int64))
                counts[numbers] += np.bincount(places, minlength=len(words))
                if len(lexicon) > REMEMBERED:
                    yield out()
                    lexicon.restart()
                    counts = np.zeros(0, np.int64)
        yield out()

    return docs.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _code(n_ids: int) -> type:
    """Type of the ids in stored texts, ends of texts included."""
    return np.uint16 if n_ids < 1 << 16 else np.uint32


def _id_lots(column: pa.Array, code: type) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Texts stored as ids, some at a time: (which ones, all their ids in a row, ids of each)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64) // np.dtype(code).itemsize
    ends = np.cumsum(lengths)
    at, before = 0, 0
    while at < len(lengths):
        to = max(at + 1, int(np.searchsorted(ends, before + IDS, "right")))
        yield slice(at, to), np.frombuffer(b"".join(column[at:to].to_pylist()), code), lengths[at:to]
        at, before = to, ends[to - 1]


def _id_counts(texts: DataFrame, n_ids: int) -> np.ndarray:
    """Counts of all ids of the tokenizer and, last, of texts; summed in tasks first."""
    code = _code(n_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n_ids + 1, np.int64)
        for batch in batches:
            for _, ids, lengths in _id_lots(batch.column(0), code):
                counts += np.bincount(ids, minlength=n_ids + 1)
                counts[n_ids] += len(lengths)
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.int32()), pa.array(counts[found])], names=["id", "n"]
        )

    out = np.zeros(n_ids + 1, np.int64)
    summed = texts.select("ids").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    for r in summed.collect():  # at most one row for each id of the tokenizer
        out[r["id"]] = r["n"]
    return out


def _round(texts: DataFrame, p: dict[str, np.ndarray], v: Vocabulary, s: Settings, rate: float) -> dict:
    """One round: tasks train from ``p`` on, and their parameters are averaged by windows."""

    code = _code(len(v.slots) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = {"all": flat(p)}
        model = Model(shaped(whole["all"], p, views=True), s)  # a step on the whole moves them all
        adam, seen, left = Adam(rate), 0, np.empty((0, s.context + s.block + 1), np.int32)
        rng = np.random.default_rng(TaskContext.get().partitionId())

        def step(windows: np.ndarray) -> None:
            _, g = model.gradients(windows)
            adam.step(whole, {"all": flat(g)})

        for batch in batches:
            for _, ids, lengths in _id_lots(batch.column(0), code):
                items = np.insert(v.slots[ids], np.cumsum(lengths), v.slots[-1])
                windows = np.concatenate([left, model.windows(items, lengths + 1)])
                windows = windows[rng.permutation(len(windows))]
                at = 0
                while at + (size := min(max(seen // 64, s.step), max(s.most, s.step))) <= len(windows):
                    step(windows[at : at + size])
                    at += size
                    seen += size
                left = windows[at:]
        if len(left):
            step(left)
            seen += len(left)
        if seen:
            values = whole["all"]
            parts = [values[i : i + CHUNK] for i in range(0, len(values), CHUNK)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(parts)), pa.int32()), pa.array([seen] * len(parts), pa.int64()),
                 pa.array([x.tobytes() for x in parts], pa.binary())],
                names=["chunk", "n", "part"],
            )

    def mean(group: pa.Table) -> pa.Table:
        weights = group["n"].to_numpy().astype(np.float64)
        total = sum(w * np.frombuffer(x, np.float32) for w, x in zip(weights, group["part"].to_pylist(), strict=True))
        value = (total / weights.sum()).astype(np.float32).tobytes()
        return pa.table({"chunk": group["chunk"][:1], "part": pa.array([value], pa.binary())})

    found = texts.select("ids").mapInArrow(run, "chunk int, n long, part binary")
    rows = found.groupBy("chunk").applyInArrow(mean, "chunk int, part binary").collect()
    if not rows:
        return p
    values = [np.frombuffer(r["part"], np.float32) for r in sorted(rows, key=lambda r: r["chunk"])]
    return shaped(np.concatenate(values), p)


@dataclass(frozen=True)
class Language:
    """A trained model with what its tasks need."""

    parameters: dict[str, np.ndarray]
    vocabulary: Vocabulary
    settings: Settings
    tokenizer: str


def train(texts: DataFrame, settings: Settings | None = None, tokenizer: str | None = None) -> Language:
    """Train on stored ``texts(round, ids)``: all of them, each in its round. No texts leave the
    untrained model, no rounds one that knows how frequent ids are."""
    s, path = settings or Settings(), tokenizer or default_tokenizer()
    counts = _id_counts(texts, tokenizer_at(path).get_piece_size())
    v = Vocabulary.of(counts, s)
    tasks = max(1, int(counts.sum()) // (s.block * s.rounds * s.per_task)) if s.rounds else 1
    p = first_parameters(v, s)
    for r in range(s.rounds):
        share = r / max(s.rounds - 1, 1)
        rate = s.first_rate ** (1 - share) * s.last_rate**share
        p = _round(texts.where(F.col("round") == r).coalesce(tasks), p, v, s, rate)
    return Language(p, v, s, path)


def _texts(docs: DataFrame, path: str, known: dict[int, float]) -> DataFrame:
    """Each text's subword ids, sums over the looked-up words, and the other words' hashes and
    counts."""
    code = _code(tokenizer_at(path).get_piece_size())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(tokenizer_at(path), known=known)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for rows, words, places, sizes in _lots(batch.column(3)):
                if len(lexicon) > REMEMBERED:
                    lexicon.restart()
                numbers = lexicon.numbers(words)[places]
                text = np.repeat(np.arange(len(sizes)), sizes)
                ids, n = lexicon.ids(numbers)
                id_ends = np.cumsum(np.bincount(text, n, len(sizes)).astype(np.int64)).tolist()
                ids = ids.astype(code)
                own = lexicon.logs[numbers]
                looked_up = ~np.isnan(own)
                base = np.bincount(text[looked_up], own[looked_up], len(sizes))
                n_known = np.bincount(text[looked_up], minlength=len(sizes))
                others = np.flatnonzero(~looked_up)
                pairs, times = np.unique(
                    text[others] * np.int64(len(lexicon)) + numbers[others], return_counts=True
                )
                ends = np.searchsorted(pairs, np.arange(len(sizes) + 1) * np.int64(len(lexicon)))
                offsets = pa.array(ends, pa.int32())
                keys = pa.array(lexicon.hashes[pairs % max(len(lexicon), 1)], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row + np.arange(len(sizes)), pa.int64()),
                        *(batch.column(i)[rows] for i in range(3)),
                        pa.array(sizes + 1), pa.array(base, pa.float64()), pa.array(n_known, pa.int64()),
                        pa.array([ids[a:b].tobytes() for a, b in zip([0, *id_ends], id_ends)], pa.binary()),
                        pa.ListArray.from_arrays(offsets, keys),
                        pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32())),
                    ],
                    names=["row", "doc_id", "held_out", "round", "n_tokens", "base", "known", "ids", "keys", "times"],
                )
                row += len(sizes)

    return docs.select("doc_id", "held_out", "round", "text").mapInArrow(
        run,
        "row long, doc_id long, held_out boolean, round int, n_tokens long, base double, known long, "
        "ids binary, keys array<long>, times array<int>",
    )


def _scored(texts: DataFrame, language: Language) -> DataFrame:
    """The model's log10 probability of every row's ids and end, in place of the ids."""
    s, v = language.settings, language.vocabulary
    code = _code(len(v.slots) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(language.parameters, s)
        for batch in batches:
            out = [np.empty(0)]
            for _, ids, lengths in _id_lots(batch.column(batch.num_columns - 1), code):
                ids = np.insert(ids, np.cumsum(lengths), len(v.slots) - 1)
                text, lengths = np.arange(len(lengths)), lengths + 1
                logs = model.log_probabilities(model.windows(v.slots[ids], lengths))
                places = np.repeat(text, -(-lengths // s.block) * s.block)
                out.append(
                    np.bincount(places, logs, len(text))
                    + np.bincount(np.repeat(text, lengths), v.rare[ids], len(text))
                )
            score = pa.array(np.concatenate(out) / math.log(10), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], score], names=[*batch.schema.names[:-1], "score"])

    return texts.select("row", "doc_id", "held_out", "n_tokens", "base", "known", "ids").mapInArrow(
        run, "row long, doc_id long, held_out boolean, n_tokens long, base double, known long, score double"
    )


def language_scores(
    docs: DataFrame, folds: int = 7, held: int = 2, settings: Settings | None = None, tokenizer: str | None = None
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    ``score`` is the model's log10 probability of the text's subword ids and its end;
    ``base_score`` that of its words and end under add-one counts of the training documents.
    Texts are read whole. A null text is empty: its end alone is scored. Rows without an id are
    scored, but belong to no fold and are not learned from. Rows count and are scored as often
    as they stand in the table; other columns are left alone. Without training documents the
    base score is 0 and the model untrained. Texts of one row number at most 2^40 a task.

    Words of at least one in ``frequent`` tokens, so at most that many, are looked up in tasks;
    the other words of each text, none of them frequent, meet their counts in a join.
    """
    found_by_tasks(docs.sparkSession)
    s, path = settings or Settings(), tokenizer or default_tokenizer()
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        (fold(F.col("doc_id").cast("long"), folds) == held).alias("held_out"),
    )
    training = docs.where(_learned_from(F.col("held_out")))
    counts = stored(word_counts(training), "counts")
    size = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    n_texts = training.count()
    total = size[1] + n_texts
    distinct = size[0] + (n_texts > 0)
    often = F.col("n") * s.frequent >= total
    known = {r["key"]: math.log10(r["n"] + 1) for r in counts.where(often).collect()}

    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(s.part)) % max(s.rounds, 1)
    dealt = docs.withColumns(
        {
            "round": F.when(_learned_from(F.col("held_out")), draw.cast("int")),
            "held_out": F.coalesce("held_out", F.lit(False)),
        }
    )
    found = stored(_texts(dealt, path, known), "texts", compression="zstd")
    language = train(found.where("round is not null").select("round", "ids"), s, path)
    scored = stored(_scored(found, language), "scored")
    words = found.select("row", F.explode(F.arrays_zip("keys", "times")).alias("w"))
    words = words.select("row", F.col("w.keys").alias("key"), F.col("w.times").alias("times"))
    rest = (
        words.join(counts.where(~often), "key")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more"),
            F.sum(F.col("times").cast("long")).alias("more_known"),
        )
    )
    rows = scored.join(rest, "row", "left")
    base = (
        F.col("base") + F.coalesce("more", F.lit(0.0)) + math.log10(n_texts + 1)
        - F.col("n_tokens") * math.log10(total + distinct + 1)
    )
    return rows.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0)) + int(n_texts > 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        "score",
    )
