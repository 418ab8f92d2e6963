"""Digests of ids in their order, as a hash tree over ranges of places.

Leaves cover fixed ranges of places in the sequence, inner nodes fixed numbers of nodes below
them. Each digest is that of its parts in order, so the tree depends on which id stands where,
not on how rows are partitioned; no node reads more than ``fanout`` parts, and two sequences are
compared range by range.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tieout.session import scratch_path
from tieout.sources.sinks import stored

FANOUT = 1_024


def numbered(rows: DataFrame, *order: str | Column) -> DataFrame:
    """The rows with their ``place``, from 0, in a total order, without one task sorting all.

    Rows are dealt to ranges of the order, numbered in their range, and moved up by the sizes
    of the ranges before. The ranges are written first, so every reader sees the same ones.
    """
    spark = rows.sparkSession
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # a partition's number is in the upper bits, a row's place within it in the lower ones
    marked = sorted_rows.withColumn("_at", F.monotonically_increasing_id())
    marked = stored(marked, scratch_path(spark, "numbered"))
    part, nth = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    marked = marked.withColumns({"_part": part, "_nth": nth})
    sizes = marked.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))  # a row for each range
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    return marked.join(F.broadcast(starts), "_part").select(
        *rows.columns, (F.col("_before") + F.col("_nth")).alias("place")
    )


def sequence_tree(rows: DataFrame, id_column: str = "order_id", fanout: int = FANOUT) -> DataFrame:
    """All nodes of the tree over ``rows(place, <id_column>)``: level (0 for leaves), node (from
    0 in its level), n (ids under it) and digest. The last level has one node, the root.

    Places are whole numbers from 0, each on one row; gaps do no harm, and a place that several
    rows share takes their ids in order. A null id counts as a mark of its own. No rows give no
    nodes.
    """
    spark = rows.sparkSession
    place = F.col("place").cast("bigint")
    text = F.coalesce(F.concat(F.lit("="), F.col(id_column).cast("string")), F.lit("~"))
    leaves = (
        rows.select(place.alias("place"), text.alias("text"))
        .groupBy(F.floor(F.col("place") / fanout).alias("node"))
        .agg(F.count(F.lit(1)).alias("n"), _digest("place", "text"))
    )
    level = stored(leaves.withColumn("level", F.lit(0)), scratch_path(spark, "leaves"))
    levels = [level]
    last = level.agg(F.max("node")).first()[0]
    while last:
        up = (
            level.groupBy(F.floor(F.col("node") / fanout).alias("node"))
            .agg(F.sum("n").alias("n"), _digest("node", "digest"))
            .withColumn("level", F.lit(len(levels)))
        )
        level = stored(up, scratch_path(spark, "nodes"))
        levels.append(level)
        last //= fanout
    out = levels[0]
    for one in levels[1:]:
        out = out.unionByName(one)
    return out.select("level", "node", "n", "digest")


def _digest(place: str, text: str) -> Column:
    """SHA-256 of numbered parts in order. Numbers are part of it, so gaps are told apart."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(place).alias("at"), F.col(text).alias("text"))))
    lines = F.transform(parts, lambda p: F.concat_ws(" ", p["at"].cast("string"), p["text"]))
    return F.sha2(F.array_join(lines, "\n"), 256).alias("digest")


def sequence_digest(tree: DataFrame) -> DataFrame:
    """The root of a tree: n and digest of the whole sequence; none for no ids."""
    return tree.where(F.col("level") == tree.agg(F.max("level")).scalar()).select("n", "digest")


def differing_ranges(one: DataFrame, two: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Ranges of places (from, to, both included) in which two sequences' trees differ, of
    ``fanout`` places each; only digests are compared, no ids are read."""
    leaves = [
        tree.where("level = 0").select("node", F.col("n").alias(f"n_{side}"), F.col("digest").alias(side))
        for side, tree in (("one", one), ("two", two))
    ]
    met = leaves[0].join(leaves[1], "node", "full_outer").where("not (one <=> two)")
    return met.select(
        (F.col("node") * fanout).alias("first_place"),
        ((F.col("node") + 1) * fanout - 1).alias("last_place"),
        F.coalesce("n_one", F.lit(0)).alias("n_one"),
        F.coalesce("n_two", F.lit(0)).alias("n_two"),
    )
