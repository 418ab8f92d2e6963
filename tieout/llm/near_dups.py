"""Near-duplicate groups: SuperMinHash signatures, banding, verification, union-find grouping.

Texts that are equal as word sequences fall into one class first; everything after that is done
once per class. Classes whose signatures agree in a band share a bucket. In each bucket the
member with the most company is the hub, and every member is compared with its hub on the full
shingle sets. What the hubs leave open is settled exactly: classes of buckets that still hold
several components are compared wherever the rarest-first prefixes of their sets meet and
their parity maps do not rule the threshold out. Both are exact bounds, so no pair above the
threshold that shares two buckets is missed, and pairs inside one component are never listed.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieout.llm.common import (
    WordHashes,
    ascii_words,
    found_by_tasks,
    mixed,
    salt,
    shingle_hashes,
    stored,
)
from tieout.llm.components import connected

#: Signature components per band, and how many of them are packed in one 64-bit band key.
ROWS = 4
#: Chance that a pair exactly at the threshold shares no band.
MISS = 1e-9
#: Members compared with one copy of a hub's set; hubs with more get more copies.
SLICE = 2_000
#: Cells of the frequency sketch that orders shingles; a fixed size at any scale.
CELLS = 1 << 20
#: 64-bit words of a set's parity map.
MAP_WORDS = 16
#: Ratio between the bounds of neighbouring size classes.
STEP = 1.06
#: Shingles whose permutations are held at a time.
CHUNK = 40_000


def bands_for(num: int, den: int) -> int:
    """Bands needed so that a pair at similarity num/den is missed with chance ``MISS``."""
    return min(60, math.ceil(math.log(MISS) / math.log(1 - min(0.999, num / den) ** ROWS)))


def superminhash(hashes: np.ndarray, owner: np.ndarray, n_sets: int, m: int) -> np.ndarray:
    """Signatures (n_sets x m) of the sets whose element hashes are laid end to end.

    Element e draws a permutation of 0..m-1 and offers r + j at the j-th place of it. Elements
    take their steps together; a set stops as soon as no later step can lower any of its
    components, which is once each of them was reached in an earlier step.
    """
    best = np.full((n_sets, m), np.inf)
    flat = best.reshape(-1)
    for at in range(0, len(hashes), CHUNK):
        h, own = hashes[at : at + CHUNK], owner[at : at + CHUNK].astype(np.int64)
        perm = None
        for j in range(m):
            x = mixed(h + salt(j + 1))
            value = (x >> np.uint64(12)) * (1.0 / (1 << 52)) + j
            k = j + ((x & np.uint64(0xFFFFFFF)) % np.uint64(m - j)).astype(np.int64)
            if perm is None:
                slot = k
            else:
                line = np.arange(len(h))
                slot = perm[line, k].astype(np.int64)
                perm[line, k] = perm[:, j]
            np.minimum.at(flat, own * m + slot, value)
            sets = np.unique(own)
            open_sets = np.zeros(n_sets, bool)
            open_sets[sets] = best[sets].max(axis=1) >= j + 1
            stay = open_sets[own]
            if not stay.any():
                break
            if perm is None:
                perm = np.tile(np.arange(m, dtype=np.uint8), (int(stay.sum()), 1))
                perm[np.arange(len(perm)), slot[stay]] = 0
            else:
                perm = perm[stay]
            h, own = h[stay], own[stay]
    return best


def band_keys(signature: np.ndarray) -> np.ndarray:
    """Four components at 16 bits each make the 64-bit key of a band."""
    short = (mixed(signature.view(np.uint64)) >> np.uint64(48)).astype("<u2")
    return short.view("<i8")


def _signatures(n_words: int, bands: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                digests, sets = [], []
                for text in batch.column(1).to_pylist():
                    words = ascii_words(text)
                    digests.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest())
                    sets.append(shingle_hashes(words, n_words, hashes))
                sizes = np.array([len(s) for s in sets], np.int64)
                owner = np.repeat(np.arange(len(sets)), sizes)
                keys = band_keys(superminhash(np.concatenate(sets), owner, len(sets), bands * ROWS))
                keys[sizes == 0] = 0
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).cast(pa.int64()),
                        pa.array(digests, pa.binary()),
                        pa.array(sizes),
                        pa.ListArray.from_arrays(
                            np.arange(0, keys.size + 1, bands, dtype=np.int32), keys.reshape(-1)
                        ),
                        *batch.columns[2:],
                    ],
                    names=["doc_id", "digest", "n_shingles", "keys", *batch.schema.names[2:]],
                )

    return run


def _confirm(n_words: int, num: int, den: int) -> Callable:
    """Rows come sorted by (hub, part, is_member): the hub's set is read once per part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, hub, hub_set = WordHashes(), None, np.empty(0, np.uint64)
        for batch in batches:
            u, v = [], []
            rows = (batch.column(i).to_pylist() for i in range(4))
            for at, is_member, node, text in zip(*rows, strict=True):
                own = shingle_hashes(ascii_words(text), n_words, hashes)
                if not is_member:
                    hub, hub_set = at, own
                elif hub == at:
                    both = len(np.intersect1d(own, hub_set, assume_unique=True))
                    if den * both >= num * (len(own) + len(hub_set) - both):
                        u.append(at)
                        v.append(node)
            yield pa.RecordBatch.from_arrays(
                [pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"]
            )

    return run


def confirmed(pairs: DataFrame, texts: DataFrame, n_words: int, num: int, den: int) -> DataFrame:
    """Links among ``pairs(hub, node)`` on the full sets of ``texts(node, text)``.

    Each text is dealt to its hub; a hub with many members is dealt to several places, so no
    task holds more than a set and a stream of texts.
    """
    counts = stored(
        pairs.groupBy("hub").agg(F.ceil(F.count("*") / SLICE).cast("int").alias("parts")), "parts"
    )
    part = F.pmod(F.hash("node"), "parts").alias("part")
    members = pairs.join(counts, "hub").select("hub", part, F.lit(1).alias("is_member"), "node")
    parts = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    hubs = counts.select("hub", parts, F.lit(0).alias("is_member"), F.col("hub").alias("node"))
    dealt = (
        members.union(hubs)
        .join(texts, "node")
        .repartition("hub", "part")
        .sortWithinPartitions("hub", "part", "is_member")
        .select("hub", "is_member", "node", "text")
    )
    return stored(dealt.mapInArrow(_confirm(n_words, num, den), "u long, v long"), "links")


def _own_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose text is the one meant: an id may stand on several texts."""
    for batch in batches:
        same = [
            hashlib.blake2b(b" ".join(ascii_words(t)), digest_size=16).digest() == d
            for d, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
        ]
        yield batch.filter(pa.array(same, pa.bool_())).select([0, 3])


def _agreeing(a: Column, b: Column) -> Column:
    """Signature components that are equal."""
    lanes = [0xFFFF << s for s in (0, 16, 32)]

    def equal(x: Column) -> Column:
        out = (F.shiftrightunsigned(x, 48) == 0).cast("int")
        for lane in lanes:
            out += (x.bitwiseAND(F.lit(lane)) == 0).cast("int")
        return out

    return F.aggregate(
        F.zip_with(a, b, lambda x, y: equal(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x
    )


def _least_agreement(num: int, den: int, m: int) -> int:
    """Seven standard deviations below what a pair at the threshold shows."""
    t = num / den
    return max(1, math.floor(m * t - 7 * math.sqrt(m * t * (1 - t))))


def _sketch(n_words: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, total = WordHashes(), np.zeros(CELLS, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                s = shingle_hashes(ascii_words(text), n_words, hashes)
                np.add.at(total, (s % np.uint64(CELLS)).astype(np.int64), 1)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(total[used])], names=["cell", "n"]
        )

    return run


def _size_class(n: int) -> int:
    return int(math.log(n) / math.log(STEP))


def prefix_keys(grams: np.ndarray, order: np.ndarray, num: int, den: int) -> np.ndarray:
    """Keys under which a set must meet any set at or above num/den.

    Two sets of sizes s and t at or above the threshold share a = num (s + t) / (num + den)
    elements, so their first s - a + 1 and t - a + 1 elements, in one order for all sets,
    share one. Keys are made for each size class a partner can be in, by its least size.
    """
    s = len(grams)
    ranked = grams[np.lexsort((grams, order[(grams % np.uint64(CELLS)).astype(np.int64)]))]
    own, out = _size_class(s), []
    least, most = -(-num * s // den), den * s // num
    for other in range(_size_class(least), _size_class(most) + 1):
        lowest = max(least, math.ceil(STEP**other - 1e-9))
        share = -(-num * (s + lowest) // (num + den))
        if share <= s:
            tag = min(own, other) * 100_003 + max(own, other)
            out.append(mixed(ranked[: s - share + 1] + salt(tag)))
    return np.concatenate(out)


def _prefixes(n_words: int, num: int, den: int, order) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, rank = WordHashes(), order.value
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                keys = [
                    prefix_keys(shingle_hashes(ascii_words(t), n_words, hashes), rank, num, den)
                    for t in batch.column(2).to_pylist()
                ]
                size = [len(k) for k in keys]
                columns = [np.concatenate(keys).view(np.int64) if keys else np.empty(0, np.int64)]
                columns += [np.repeat(batch.column(i).to_numpy(), size) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], names=["key", "node", "component"]
                )

    return run


def parity_map(grams: np.ndarray) -> np.ndarray:
    """Bit b is set if an odd number of elements fall on b. Maps of two sets differ in no more
    bits than the sets differ in elements."""
    bits = np.bincount((mixed(grams) % np.uint64(MAP_WORDS * 64)).astype(np.int64), minlength=MAP_WORDS * 64)
    return np.packbits((bits & 1).astype(np.uint8)).view(np.int64)


def _maps(n_words: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingle_hashes(ascii_words(t), n_words, hashes) for t in batch.column(1).to_pylist()]
            maps = np.array([parity_map(s) for s in sets], np.int64).reshape(len(sets), MAP_WORDS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64())]
                + [pa.array(maps[:, i]) for i in range(MAP_WORDS)],
                names=["node", "n", *(f"p{i}" for i in range(MAP_WORDS))],
            )

    return run


def _open_pairs(pool: DataFrame, texts: DataFrame, n_words: int, num: int, den: int) -> DataFrame:
    """Pairs of ``pool(node, component)`` in different components whose
    prefixes meet and whose parity maps allow the threshold. Rows of a key's largest
    component are only set against the others."""
    spark = pool.sparkSession
    full = stored(pool.join(texts, "node").select("node", "component", "text"), "pool")
    cells = np.zeros(CELLS, np.int64)
    counts = full.select("text").mapInArrow(_sketch(n_words), "cell long, n long")
    for part in counts.groupBy("cell").agg(F.sum("n").alias("n")).toArrow().to_batches():
        cells[part.column(0).to_numpy()] = part.column(1).to_numpy()
    order = spark.sparkContext.broadcast(cells)
    keys = stored(
        full.mapInArrow(
            _prefixes(n_words, num, den, order), "key long, node long, component long"
        ),
        "prefixes",
    )
    several = stored(
        keys.groupBy("key", "component")
        .count()
        .groupBy("key")
        .agg(
            F.max_by("component", F.struct("count", "component")).alias("main"),
            F.count("*").alias("components"),
        )
        .where("components > 1")
        .select("key", "main"),
        "several",
    )
    places = [f"p{i}" for i in range(MAP_WORDS)]
    maps = full.select("node", "text").mapInArrow(
        _maps(n_words), "node long, n long, " + ", ".join(f"{p} long" for p in places)
    )
    shared = stored(keys.join(several, "key").join(maps, "node"), "shared")
    left = shared.where("component <> main").select(
        "key", F.col("node").alias("hub"), F.col("component").alias("hub_component"),
        F.col("n").alias("hub_n"), *(F.col(p).alias(f"hub_{p}") for p in places),
    )
    differ = " + ".join(f"bit_count({p} ^ hub_{p})" for p in places)
    both = f"(({num} * (n + hub_n) + {num + den - 1}) div {num + den})"
    right = shared.withColumnRenamed("key", "at")
    on = F.expr(
        "key = at and component <> hub_component and (component = main or hub < node)"
        f" and {differ} <= n + hub_n - 2 * {both}"
    )
    return left.join(right, on).select("hub", "node").distinct()


def near_duplicates(
    docs: DataFrame, n_words: int = 5, num: int = 80, den: int = 100
) -> DataFrame:
    """Groups of documents whose sets of word n-grams overlap by num/den or more (Jaccard).

    Returns doc_id, n_shingles, component_id (smallest doc_id of the group) and kept, a row for
    each row of ``docs``; other columns of ``docs`` are not looked at. Words are runs without
    ASCII white space, A-Z in lower case; a text with fewer than ``n_words`` words is one
    n-gram. Null, empty and blank texts have no n-grams and stay alone. A row without doc_id
    joins no group: component_id null, kept. Repeated rows get equal results; if an id stands
    on different texts, each row has the group of its own text. Ties go to the smaller id.
    """
    return grouped(docs, n_words, num, den).select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def grouped(
    docs: DataFrame, n_words: int = 5, num: int = 80, den: int = 100, text_key: str | None = None
) -> DataFrame:
    """The groups of :func:`near_duplicates`: doc_id, n_shingles, component_id, and component.

    ``component`` is one number for each group, also where one id is the smallest of several
    groups; null for rows that join none. The column ``text_key`` of text is carried along.
    """
    found_by_tasks(docs.sparkSession)
    bands = bands_for(num, den)
    own = [text_key] if text_key else []
    rows = stored(
        docs.select(F.col("doc_id").cast("long"), "text", *own).mapInArrow(
            _signatures(n_words, bands),
            "doc_id long, digest binary, n_shingles long, keys array<long>"
            + "".join(f", {c} string" for c in own),
        ),
        "signatures",
    )
    classes = stored(
        rows.where("n_shingles > 0 and doc_id is not null")
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("node_id"),
            F.first("n_shingles").alias("n"),
            F.first("keys").alias("keys"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    components = _components(classes, docs, n_words, num, den, bands)
    names = classes.join(components, "node", "left").select(
        "digest", "node_id", F.coalesce("component", "node").alias("component")
    )
    names = stored(names, "names")
    least = names.groupBy("component").agg(F.min("node_id").alias("component_id"))
    names = names.join(least, "component").select("digest", "component_id", "component")
    names = stored(names, "groups")
    return (
        rows.select("doc_id", "n_shingles", "digest", *own)
        .withColumn("digest", F.when(F.expr("n_shingles > 0 and doc_id is not null"), F.col("digest")))
        .join(names, "digest", "left")
        .select(
            "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "component", *own
        )
    )


def _components(
    classes: DataFrame, docs: DataFrame, n_words: int, num: int, den: int, bands: int
) -> DataFrame:
    """(node, component) of the classes that are linked with another."""
    in_bands = classes.select("node", F.posexplode("keys").alias("band", "key"))
    full = stored(in_bands.groupBy("band", "key").count().where("count > 1"), "buckets")
    members = stored(in_bands.join(full, ["band", "key"]), "members")
    company = stored(members.groupBy("node").agg(F.sum("count").alias("company")), "company")
    hubs = stored(
        members.join(company, "node")
        .groupBy("band", "key")
        .agg(F.max(F.struct("company", (-F.col("node")).alias("order"))).alias("top"))
        .select("band", "key", (-F.col("top.order")).alias("hub")),
        "hubs",
    )
    stars = members.join(hubs, ["band", "key"]).where("node <> hub").select("hub", "node").distinct()
    pairs = _described(stored(stars, "stars"), classes, num, den).where(
        _agreeing(F.col("hub_keys"), F.col("node_keys")) >= _least_agreement(num, den, bands * ROWS)
    )
    texts = _texts(members, classes, docs)
    links = confirmed(pairs.select("hub", "node"), texts, n_words, num, den)
    first = stored(connected(links), "components")

    grouped = stored(
        members.select("band", "key", "node")
        .join(first, "node", "left")
        .select("band", "key", "node", F.coalesce("component", "node").alias("component")),
        "grouped",
    )
    undecided = stored(
        grouped.groupBy("band", "key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
        .select("band", "key"),
        "undecided",
    )
    pool = (
        grouped.join(undecided, ["band", "key"])
        .groupBy("node", "component")
        .count()
        .where("count > 1")
    )
    more = stored(_open_pairs(pool, texts, n_words, num, den), "open")
    links = confirmed(more, texts, n_words, num, den)
    return connected(first.select(F.col("node").alias("u"), F.col("component").alias("v")).union(links))


def _texts(members: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, text) of the classes that share a bucket: the documents move once, here."""
    wanted = members.select("node").distinct().join(classes.select("node", "node_id", "digest"), "node")
    rows = docs.select(F.col("doc_id").cast("long").alias("node_id"), "text")
    found = wanted.join(rows, "node_id").select("node", "node_id", "digest", "text")
    own = found.mapInArrow(_own_text, "node long, text string")
    return stored(own, "texts")


def _described(pairs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs with their signatures; those of too different sizes are out."""
    out = pairs
    for side in ("hub", "node"):
        out = out.join(
            classes.select(
                F.col("node").alias(side), F.col("n").alias(f"{side}_n"), F.col("keys").alias(f"{side}_keys")
            ),
            side,
        )
    return out.where(
        F.least("hub_n", "node_n") * den >= F.greatest("hub_n", "node_n") * num
    ).drop("hub_n", "node_n")
