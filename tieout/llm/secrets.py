"""Secrets in texts: fixed patterns, and character Markov models of random and ordinary strings.

Column expressions only. Two first-order Markov chains over characters, one trained on labelled
secrets and one on ordinary identifiers, are compared by their log-likelihood ratio; strings
that look random but match no fixed pattern are found that way. The limit of the ratio is fitted
on samples of both kinds that were not trained on.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieout.llm.common import stored

# Kinds of the base patterns in their order, least sizes, and the method's kind.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_WORDS = r"(?i)password|passwd|secret|token|api_?key"
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "markov")
#: Strings the models are asked about: runs of these characters, so many at least.
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
WORD = r"[A-Za-z0-9+/_=-]{4,}"
#: Characters of the models are those from '+' to 'z'.
FIRST, LAST = 43, 122
WIDTH = LAST - FIRST + 1


@dataclass(frozen=True)
class Settings:
    #: Texts with labelled secrets, and texts of ordinary words, that the models are fitted on.
    secret_docs: int = 5_000
    ordinary_docs: int = 2_000
    #: A word is ordinary if so many of those texts hold it.
    shared: int = 3
    #: Weight of the single characters against the pairs that begin with one.
    backoff: float = 5.0
    #: One sample in so many is kept from training, to fit the limit on.
    held: int = 4
    #: Shares of ordinary words above the limit and of secrets below it that it aims at.
    alarms: float = 0.001
    misses: float = 0.02


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, neutral: int, op: Callable[[Column, Column], Column]) -> Column:
    """Running totals of an array of ints: each round joins every value with the one 1, 2, 4, ...
    places before, so n values take n log n steps."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int"))

    def add(done: Column, k: Column) -> Column:
        shifted = F.concat(F.array_repeat(F.lit(neutral), F.call_function("shiftleft", F.lit(1), k)), done)
        return F.zip_with(done, F.slice(shifted, F.lit(1), F.size(done)), op)

    return F.aggregate(rounds, values, add)


def matches(text: Column, pattern: str, group: int | None = None) -> Column:
    """Array of (start, end, value) of the leftmost non-overlapping matches, in code points.

    The pieces between the matches give the places: a match starts after all pieces up to it
    and all matches before it. ``value`` is a group of the match, or the whole of it."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group or 0))

    def parted(found: Column) -> Column:
        between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        return F.zip_with(
            F.zip_with(found, value, lambda m, v: F.struct(F.length(m).alias("length"), v.alias("value"))),
            F.transform(between, lambda p: F.length(p)),
            lambda m, gap: F.struct(m["length"].alias("length"), m["value"].alias("value"), gap.alias("gap")),
        )

    def placed(rows: Column) -> Column:
        ends = running(F.transform(rows, lambda r: r["gap"] + r["length"]), 0, lambda x, y: x + y)
        return F.zip_with(
            rows,
            ends,
            lambda r, e: F.struct((e - r["length"]).alias("start"), e.alias("end"), r["value"].alias("value")),
        )

    return let(whole, lambda found: let(parted(found), placed))


def none() -> Column:
    return F.array().cast("array<struct<start: int, end: int, value: string>>")


def base_spans(text: Column) -> dict[str, Column]:
    """Matches of the fixed patterns that are long enough. Texts without a trace of a pattern
    are not taken apart; the longer forms match exactly where the kept short ones do, since
    both patterns take whole runs."""
    long_hex = HEX.removesuffix("+") + "{%d,}" % LEAST["hex"]
    long_access = ACCESS.removesuffix("+") + "{%d,}" % (LEAST["access"] - 4)
    assign = F.filter(matches(text, ASSIGN, 2), lambda m: F.length(m["value"]) >= LEAST["assign"])
    return {
        "assign": F.when(text.rlike(ASSIGN_WORDS), assign).otherwise(none()),
        "access": F.when(text.rlike(long_access), matches(text, long_access)).otherwise(none()),
        "hex": F.when(text.rlike(long_hex), matches(text, long_hex)).otherwise(none()),
    }


def _transitions(strings: DataFrame) -> DataFrame:
    """(random, a, b, n): counts of neighbouring characters of ``strings(value, random)``,
    summed before the shuffle."""
    pairs = F.transform(
        F.sequence(F.lit(1), F.length("value") - 1),
        lambda i: F.struct(
            F.ascii(F.col("value").substr(i, F.lit(1))).alias("a"),
            F.ascii(F.col("value").substr(i + 1, F.lit(1))).alias("b"),
        ),
    )
    within = f"a between {FIRST} and {LAST} and b between {FIRST} and {LAST}"
    return (
        strings.where(F.length("value") >= 2)
        .select("random", F.explode(pairs).alias("p"))
        .select("random", "p.a", "p.b")
        .where(within)
        .groupBy("random", "a", "b")
        .agg(F.count("*").alias("n"))
    )


@dataclass(frozen=True)
class Model:
    """Log-likelihood ratio, random against ordinary, of each pair of characters, and the mean
    ratio above which a string counts as random; none if there were too few samples."""

    ratios: list[float]
    limit: float | None


def _chain(pairs: dict[tuple[int, int], int], backoff: float) -> list[list[float]]:
    """Probability of each character after each, backed off to that of the character alone."""
    codes = range(FIRST, LAST + 1)
    alone = [sum(pairs.get((a, b), 0) for a in codes) + 0.5 for b in codes]
    alone = [x / sum(alone) for x in alone]
    out = []
    for a in codes:
        row = [pairs.get((a, b), 0) for b in codes]
        total = sum(row) + backoff
        out.append([(n + backoff * p) / total for n, p in zip(row, alone, strict=True)])
    return out


def _samples(docs: DataFrame, settings: Settings) -> DataFrame:
    """Labelled samples ``(value, random, held)``, each string once: what the fixed patterns find
    in a bounded sample of texts that show a trace of one, and words that several texts of a
    bounded sample of all share while no pattern finds anything in them. The texts taken are
    those of the least hashes, so the sample doesn't depend on how the table is partitioned."""
    rows = docs.select(F.coalesce("text", F.lit("")).alias("text")).where("text <> ''")
    order = F.xxhash64("text")
    long_hex = HEX.removesuffix("+") + "{%d,}" % LEAST["hex"]
    marked = rows.where(F.col("text").rlike(long_hex) | F.col("text").rlike(ASSIGN_WORDS) | F.col("text").rlike(ACCESS))
    spans = base_spans(F.col("text"))
    found = F.concat(*(spans[k] for k in ("assign", "access", "hex")))
    secrets = _sampled(marked, order, settings.secret_docs).select(F.explode(found).alias("m"))
    secrets = secrets.select("m.value", F.lit(True).alias("random")).distinct()
    words = F.array_distinct(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    plain = _sampled(rows, order, settings.ordinary_docs).where(F.size(found) == 0)
    plain = plain.select(F.explode(words).alias("value")).groupBy("value").count()
    plain = plain.where(F.col("count") >= settings.shared).select("value", F.lit(False).alias("random"))
    held = F.pmod(F.xxhash64("value"), F.lit(settings.held)) == 0
    return stored(secrets.union(plain).withColumn("held", held), "samples")


def fit(docs: DataFrame, settings: Settings) -> Model:
    """Both chains and the limit, from the corpus itself. Collected are counts of character
    pairs, ``WIDTH`` squared of each kind at most, and four quantiles."""
    samples = _samples(docs, settings)
    counts: dict[bool, dict[tuple[int, int], int]] = {True: {}, False: {}}
    for r in _transitions(samples.where(~F.col("held"))).collect():
        counts[r["random"]][r["a"], r["b"]] = r["n"]
    random, plain = (_chain(counts[kind], settings.backoff) for kind in (True, False))
    table = [
        round(math.log(x / y), 5) for xs, ys in zip(random, plain, strict=True) for x, y in zip(xs, ys, strict=True)
    ]
    held = samples.where(F.col("held") & (F.length("value") >= 2))
    found = held.withColumn("ratio", mean_ratio(F.col("value"), table))
    found = found.groupBy("random").agg(F.percentile("ratio", [settings.misses, 1 - settings.alarms]).alias("at"))
    at = {r["random"]: r["at"][0 if r["random"] else 1] for r in found.collect()}
    if not all(counts.values()) or len(at) < 2:
        return Model(table, None)
    return Model(table, max(at[False], (at[False] + at[True]) / 2))


def _sampled(rows: DataFrame, order: Column, n: int) -> DataFrame:
    """The texts with the n least hashes (equal texts once, a few more if hashes are equal)."""
    hashes = rows.select(order.alias("at")).distinct().orderBy("at").limit(n)
    limit = hashes.agg(F.max("at")).first()[0]
    return rows.where(order <= F.lit(limit if limit is not None else -(2**63))).distinct()


def mean_ratio(value: Column, table: list[float]) -> Column:
    """Mean log-likelihood ratio of a string's pairs of characters; those outside the models'
    range count as 0."""
    ratios = F.from_json(F.lit(json.dumps(table)), "array<double>")

    def code(i: Column) -> Column:
        return F.ascii(value.substr(i, F.lit(1))) - FIRST

    def one(i: Column) -> Column:
        a, b = code(i), code(i + 1)
        return F.when(a.between(0, WIDTH - 1) & b.between(0, WIDTH - 1), F.get(ratios, a * WIDTH + b)).otherwise(0.0)

    return F.aggregate(
        F.sequence(F.lit(1), F.length(value) - 1), F.lit(0.0), lambda done, i: done + one(i)
    ) / (F.length(value) - 1)


def apart(found: Column, base: Column) -> Column:
    """Those of ``found`` that overlap no span of ``base``. In the order of the places where a
    found string ends or a base span starts, the furthest end of the spans started so far says
    whether one reaches into the string."""

    def events(f: Column) -> Column:
        ends = F.transform(f, lambda m: F.struct(m["end"].alias("key"), F.lit(0).alias("kind"), m["start"].alias("at"), m["value"].alias("value")))
        starts = F.transform(base, lambda m: F.struct(m["start"].alias("key"), F.lit(1).alias("kind"), m["end"].alias("at"), F.lit("").alias("value")))
        return F.array_sort(F.concat(ends, starts))

    def free(rows: Column) -> Column:
        ends = F.transform(rows, lambda e: F.when(e["kind"] == 1, e["at"]).otherwise(F.lit(-1)))
        furthest = running(ends, -1, lambda x, y: F.greatest(x, y))
        joined = F.zip_with(rows, furthest, lambda e, top: F.struct(e.alias("e"), top.alias("top")))
        kept = F.filter(joined, lambda j: (j["e"]["kind"] == 0) & (j["top"] <= j["e"]["at"]))
        return F.transform(
            kept,
            lambda j: F.struct(j["e"]["at"].alias("start"), j["e"]["key"].alias("end"), j["e"]["value"].alias("value")),
        )

    return let(events(found), free)


def random_spans(text: Column, model: Model, base: Column) -> Column:
    """Runs of identifier characters whose mean log-likelihood ratio is over the model's limit
    and that overlap no base match."""
    if model.limit is None:
        return none()
    looked_at = apart(matches(text, CANDIDATE), base)
    found = F.filter(looked_at, lambda m: mean_ratio(m["value"], model.ratios) > model.limit)
    return F.when(text.rlike(CANDIDATE), found).otherwise(none())


def _joined(spans: dict[str, Column]) -> Column:
    """kind:start:end by start, then kind in the order listed, comma-joined."""

    def shown(kind: str, column: Column) -> Column:
        place = F.lit(KINDS.index(kind)).alias("order")
        return F.transform(
            column,
            lambda m: F.struct(
                m["start"].alias("start"), place,
                F.concat_ws(":", F.lit(kind), m["start"], m["end"]).alias("shown"),
            ),
        )

    rows = F.concat(*(shown(kind, column) for kind, column in spans.items()))
    return F.array_join(F.transform(F.array_sort(rows), lambda r: r["shown"]), ",")


def find_secrets(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Adds n_assign, n_access, n_hex, n_markov, base_spans and spans to each row of ``docs``.

    Null and empty texts have no spans. Columns of these names that ``docs`` has already are
    replaced. Repeated rows get equal results. Where the table has no labelled secrets, or no
    words that texts share, nothing can be fitted and only the fixed patterns' spans are found.
    An empty table gives no rows. Texts of any length are read whole, in time that grows with
    their length times its logarithm.
    """
    settings = settings or Settings()
    model = fit(docs, settings)
    text = F.coalesce(F.col("text"), F.lit(""))
    kinds = ("assign", "access", "hex")
    base = base_spans(text)
    names = {k: f"__{k}_spans" for k in KINDS}
    out = docs.withColumns({names[k]: base[k] for k in kinds})
    out = out.withColumn(
        names["markov"], random_spans(text, model, F.concat(*(F.col(names[k]) for k in kinds)))
    )
    found = {k: F.col(names[k]) for k in KINDS}
    return out.withColumns(
        {f"n_{k}": F.size(found[k]).cast("long") for k in KINDS}
        | {
            "base_spans": _joined({k: found[k] for k in kinds}),
            "spans": _joined(found),
        }
    ).drop(*names.values())


def secrets_digest(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Per row: doc_id, counts by kind, SHA-256 of the base spans, and all spans."""
    return find_secrets(docs.select(F.col("doc_id").cast("long"), "text"), settings).select(
        "doc_id", "n_assign", "n_access", "n_hex", "n_markov",
        F.sha2("base_spans", 256).alias("base_sha256"), "spans",
    )
