"""Joins that stay balanced when one key holds a large part of the rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_SLICE = 1_000_000


def hot_keys(sizes: DataFrame, key: str, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Keys with more rows than one slice should hold, and the slices each is given.

    ``sizes`` has one row per key with its row count ``n``. At most ``total rows /
    rows_per_slice`` keys can qualify. Joins with the list are left to Spark, which
    broadcasts it where it is small and shuffles where it is not.
    """
    return sizes.filter(F.col("n") > rows_per_slice).select(
        key, F.ceil(F.col("n") / F.lit(rows_per_slice)).cast("int").alias("_slices")
    )


def join_many_to_one(
    many: DataFrame,
    one: DataFrame,
    key: str,
    sizes: DataFrame,
    spread_by: list[str],
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Left join of rows to the single row of their key, with hot keys cut into slices.

    ``sizes`` bounds from above how many rows of ``many`` a key has; any cheap count will do,
    so ``many`` itself is not computed twice. Rows of a hot key are spread over slices by the
    hash of ``spread_by``, and only that key's single row is repeated, once per slice. Rows
    without a key match nothing, so they are spread freely. All other keys join as usual, and
    the result is that of the plain join.
    """
    hot = hot_keys(sizes, key, rows_per_slice)
    slices = F.coalesce("_slices", F.lit(1))
    slice_no = F.when(F.col(key).isNull(), F.hash(*spread_by)).otherwise(
        F.pmod(F.xxhash64(*spread_by), slices).cast("int")
    )
    left = many.join(hot, key, "left").withColumn("_slice", slice_no).drop("_slices")
    right = (
        one.join(hot, key, "left")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), slices - 1)))
        .drop("_slices")
    )
    return left.join(right, [key, "_slice"], "left").drop("_slice")


def join_hot_apart(
    many: DataFrame,
    one: DataFrame,
    key: str,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Left join of stored rows to the single row of their key, hot keys joined in place.

    For rows that may be exact copies of each other, which no hash can spread. The list of hot
    keys is short, so Spark broadcasts what they need and their rows stay in place; a list too
    long for that is joined like the rest. Rows without a key match nothing and do not move.
    All other keys join as usual. ``many`` is read
    once per part, so it should be a stored table.
    """
    sizes = many.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    hot = hot_keys(sizes, key, rows_per_slice).select(key)
    columns = [*many.columns, *[c for c in one.columns if c != key]]
    keyed = many.filter(F.col(key).isNotNull())
    cold = keyed.join(hot, key, "left_anti").join(one, key, "left")
    in_place = keyed.join(hot.join(one, key, "left"), key)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in one.schema.fields if f.name != key}
    unkeyed = many.filter(F.col(key).isNull()).withColumns(missing)
    parts = [part.select(*columns) for part in (cold, in_place, unkeyed)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
