"""Which orders get a second opinion: all that were flagged, and a sample of the clean."""

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tieout.fixed_values import (
    CLEAN,
    CONTROL,
    CONTROL_SAMPLE_SEED,
    CONTROL_SAMPLE_SIZE,
    FLAGGED,
    NOT_SELECTED,
)

#: Ranges that rows are counted in to find where the first n of them end.
RANGES = 4_096
#: Most rows that are taken as a top n, which one task brings together.
TOP = 10_000
#: Standard error of the sketch that counts ids.
SKETCH_ERROR = 0.02


def flagged(result: DataFrame) -> DataFrame:
    return result.filter(F.col("category") != CLEAN)


def clean(result: DataFrame) -> DataFrame:
    return result.filter(F.col("category") == CLEAN)


def cap_flagged(flagged_rows: DataFrame, cap: int | None) -> DataFrame:
    """The first ``cap`` rows by order id; none or zero keeps them all."""
    return first_rows(flagged_rows, cap) if cap else flagged_rows


def first_rows(rows: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows by order id, whatever kind of id that is, without sorting all rows.

    Up to ``TOP`` rows, each task keeps its first ``n``, and one task those of all; the rows are
    computed once. For more, they are read several times and should be a stored table. A sample of the ids themselves gives the ends of ``RANGES`` ranges that hold about as many
    rows each. Rows are counted by range; ranges before the one in which the n-th row lies pass
    whole, and only the rows of that one are put in order. Rows of one id are told apart by the
    hash of all their columns, and verbatim copies are counted before they are sent, so an id
    that stands on very many rows doesn't make a range large.
    """
    columns = rows.columns
    if n <= TOP:
        return rows.orderBy("order_id", F.xxhash64(*columns)).limit(n)
    key = F.struct("order_id", F.xxhash64(*columns).alias("row"))
    hashed = F.xxhash64("order_id", F.xxhash64(*columns))
    size = rows.agg(F.approx_count_distinct(hashed)).scalar()
    drawn = rows.where(F.pmod(hashed, F.greatest(size, F.lit(1))) < RANGES).select(key.alias("_key")).distinct()
    ends = drawn.agg(F.sort_array(F.collect_list("_key")).alias("all"))
    # every 64th end, then the 64 behind it
    coarse = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("all") - 1) / 64).cast("int")), lambda i: F.get("all", i * 64)
    )
    ends = ends.select(
        F.struct("all", F.when(F.size("all") > 0, coarse).otherwise(F.col("all")).alias("coarse"))
    ).scalar()
    placed = rows.withColumn("_key", key).withColumn("_ends", ends)
    step = F.size(F.filter("_ends.coarse", lambda e: e <= F.col("_key")))
    near = F.slice("_ends.all", 64 * (F.col("_step") - 1) + 1, F.lit(64))
    within = F.size(F.filter(near, lambda e: e <= F.col("_key")))
    bucket = F.when(F.col("_step") > 0, 64 * (F.col("_step") - 1) + within).otherwise(F.lit(0))
    placed = placed.withColumn("_step", step).withColumn("_bucket", bucket).drop("_ends", "_step")
    return _first_by_range(placed, n, ["_key"], columns)


def _first_by_range(placed: DataFrame, n: int, order: list[str], columns: list[str]) -> DataFrame:
    """The first ``n`` rows by ``order``; ``_bucket`` rises with it and takes few values."""
    sizes = placed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    # a window without partitions, over one row per range
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    reach = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    last = reach.where(F.col("_before") < n).agg(F.max(F.struct("_bucket", "_before"))).scalar()
    whole = placed.where(F.col("_bucket") < last["_bucket"]).select(*columns)
    # copies are counted in the tasks that read them
    copies = (
        placed.where(F.col("_bucket") == last["_bucket"])
        .withColumn("_task", F.spark_partition_id())
        .groupBy("_bucket", *dict.fromkeys([*order, *columns]), "_task")
        .agg(F.count(F.lit(1)).alias("_copies"))
    )
    so_far = Window.partitionBy("_bucket").orderBy(*order, "_task")
    until = so_far.rowsBetween(Window.unboundedPreceding, 0)
    room = n - last["_before"] - F.sum("_copies").over(until) + F.col("_copies")
    cut = copies.withColumn("_kept", F.least("_copies", room)).where("_kept > 0")
    cut = cut.select(*columns, F.explode(F.array_repeat(F.lit(0), F.col("_kept").cast("int"))))
    return whole.unionByName(cut.select(*columns))


def control_sample(clean_rows: DataFrame, n: int, seed: int = CONTROL_SAMPLE_SEED) -> DataFrame:
    """``n`` clean orders without replacement, the same ones for the same seed and orders.

    Orders are ranked by the hash of their id and the seed, so neither row order nor
    partitioning matters. ``n`` at or above the number of orders returns all of them. An id
    that stands on several clean rows is drawn once; rows without an id are not drawn.

    The draws fall evenly, so a sketch of the number of ids says how far the n least ones reach,
    with room to spare. Only rows within that reach leave their task. Should there be fewer ids
    within it than asked for, all rows are looked at.
    """
    ids = clean_rows.select("order_id").where("order_id is not null")
    if n <= 0:
        return ids.filter(F.lit(False))
    drawn = ids.withColumn("_draw", F.sha2(F.concat(F.col("order_id").cast("string"), F.lit(f"|{seed}")), 256))
    size = ids.agg(F.approx_count_distinct("order_id", SKETCH_ERROR)).scalar()
    # 8 standard deviations of the draws and of the sketch
    reach = (n + 8 * math.sqrt(n) + 64) * (1 + 8 * SKETCH_ERROR)
    place = F.conv(F.substring("_draw", 1, 13), 16, 10).cast("double") / 16.0**13
    near = place * size <= reach
    enough = drawn.where(near).select("order_id").distinct().agg(F.count(F.lit(1)) >= n).scalar()
    found = drawn.where(near | ~enough).distinct()
    if n <= TOP:
        return found.orderBy("_draw", "order_id").limit(n).select("order_id")
    placed = found.withColumn("_bucket", F.floor(place * F.greatest(size, F.lit(reach)) / reach * RANGES))
    return _first_by_range(placed, n, ["_draw", "order_id"], ["order_id"])


def selection_union(flagged_ids: DataFrame, control_ids: DataFrame) -> DataFrame:
    return flagged_ids.select("order_id", F.lit(FLAGGED).alias("selection_reason")).unionByName(
        control_ids.select("order_id", F.lit(CONTROL).alias("selection_reason"))
    )


def select_for_diagnosis(
    result: DataFrame,
    controls: int = CONTROL_SAMPLE_SIZE,
    seed: int = CONTROL_SAMPLE_SEED,
    cap: int | None = None,
) -> DataFrame:
    return selection_union(
        cap_flagged(flagged(result), cap), control_sample(clean(result), controls, seed)
    )


def mark_selection(
    result: DataFrame,
    controls: int = CONTROL_SAMPLE_SIZE,
    seed: int = CONTROL_SAMPLE_SEED,
    cap: int | None = None,
    chosen: tuple[DataFrame, DataFrame | None] | None = None,
) -> DataFrame:
    """The result with ``selection_reason``; the same choice as :func:`select_for_diagnosis`.

    One row for each row of the result, also where an order id stands on several. Only the
    drawn ids are joined; without a cap, being flagged is read off the row. ``chosen`` are the
    frames of :func:`chosen_ids`, where these have been stored.
    """
    drawn, kept = chosen or chosen_ids(result, controls, seed, cap)
    marked = result.join(drawn.withColumn("_control", F.lit(True)), "order_id", "left")
    reached = F.col("category") != CLEAN
    if kept is not None:
        marked = marked.join(kept.withColumn("_kept", F.lit(True)), "order_id", "left")
        reached = reached & F.col("_kept").isNotNull()
    drawn_clean = (F.col("category") == CLEAN) & F.col("_control").isNotNull()
    reason = F.coalesce(
        F.when(reached, F.lit(FLAGGED)),
        F.when(drawn_clean, F.lit(CONTROL)),
        F.lit(NOT_SELECTED),
    )
    return marked.select(*result.columns, reason.alias("selection_reason"))


def chosen_ids(
    result: DataFrame, controls: int, seed: int, cap: int | None
) -> tuple[DataFrame, DataFrame | None]:
    """The ids drawn as controls, and the flagged ids under the cap, or None without one."""
    kept = cap_flagged(flagged(result), cap).select("order_id").distinct() if cap else None
    return control_sample(clean(result), controls, seed), kept


def first_per_group(df: DataFrame, group: str, n: int) -> DataFrame:
    """The first ``n`` rows of each group by order id.

    The rank filter is pushed below the shuffle, so each task sends at most ``n`` rows per
    group, however large the group is.
    """
    rank = F.row_number().over(Window.partitionBy(group).orderBy("order_id"))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")
