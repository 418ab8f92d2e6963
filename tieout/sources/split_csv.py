"""CSV records of large files whose quoted fields hold line breaks, read by many tasks.

A file is read line by line in byte ranges. Whether a line begins inside a quoted field depends
on all lines before it, but each line only turns "inside" and "outside" into one another in one
of four ways, and these ways compose. So every range is summed up in one such way, a running
composition over a file's ranges says how each begins, and one within the range says how each
line begins. Lines that are records by themselves stay where they are; only the lines of records
over several lines are brought together.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A line that ends inside a quoted field, if it begins outside of one: whole fields, quoted or
#: not, then a quote that nothing closes. Doubled quotes belong to the text.
OPEN = r'\A(?:(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+|),)*+"[^"]*+(?:""[^"]*+)*+\z'


def _running(df: DataFrame, place: list[str], order: str, out: Column, inside: Column) -> DataFrame:
    """Adds, for either way to begin, how each row begins and ends: ``before0 after0 before1
    after1``, true for inside. ``out`` and ``inside`` say how a row ends that begins so."""
    rows = Window.partitionBy(*place).orderBy(order)
    upto = rows.rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumns({"_out": out, "_inside": inside})
    turns = F.col("_out") & ~F.col("_inside")
    df = df.withColumn("_turns", F.sum(turns.cast("long")).over(upto))
    fixed = F.when(F.col("_out") == F.col("_inside"), F.struct(F.col("_out").alias("to"), F.col("_turns").alias("at")))
    df = df.withColumn("_fixed", F.last(fixed, ignorenulls=True).over(upto))
    odd = (F.col("_turns") - F.coalesce("_fixed.at", F.lit(0))) % 2 == 1
    for k, begin in enumerate((False, True)):
        df = df.withColumn(f"after{k}", F.coalesce("_fixed.to", F.lit(begin)) != odd)
        df = df.withColumn(f"before{k}", F.lag(f"after{k}", 1, begin).over(rows))
    return df.drop("_out", "_inside", "_turns", "_fixed")


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of the files as text in ``value``, without each file's header.

    Lines end at a line feed; a carriage return before it is not part of a record. Blank lines
    outside of quotes are left out. A field that is never closed takes the rest of its file.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),  # rises within a range
    )
    quoted = F.col("value").contains('"')
    out = quoted & F.col("value").rlike(OPEN)
    inside = ~quoted | F.concat(F.lit('"'), "value").rlike(OPEN)
    lines = _running(lines, ["file", "block"], "at", out, inside)
    blank = F.col("value").isin("", "\r")
    starts = [F.sum((~F.col(f"before{k}") & ~blank).cast("long")).alias(f"starts{k}") for k in (0, 1)]
    last = F.max_by(F.struct("after0", "after1"), "at").alias("last")
    # one row for each range
    blocks = lines.groupBy("file", "block").agg(last, *starts)
    blocks = _running(
        blocks, ["file"], "block", F.col("last.after0"), F.col("last.after1")
    ).withColumn("starts", F.when(F.col("before0"), F.col("starts1")).otherwise(F.col("starts0")))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = F.when(F.col("starts") > 0, F.struct("block", F.col("starts").alias("nth")))
    blocks = blocks.select(
        "file", "block", F.col("before0").alias("enters"), F.last(begun, ignorenulls=True).over(earlier).alias("home")
    )

    lines = lines.join(blocks, ["file", "block"])
    for end in ("before", "after"):
        lines = lines.withColumn(end, F.when(F.col("enters"), F.col(f"{end}1")).otherwise(F.col(f"{end}0")))
    upto = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    nth = F.sum((~F.col("before") & ~blank).cast("long")).over(upto)
    lines = lines.withColumn("nth", nth)
    alone = ~F.col("before") & ~F.col("after")
    first = (F.col("block") == 0) & (F.col("nth") == 1)
    whole = lines.where(alone & ~blank & ~first).select("value")
    # the lines before a range's first record belong to the last one begun earlier
    home = F.when(F.col("nth") > 0, F.struct("block", "nth")).otherwise(F.col("home"))
    in_order = F.array_sort(F.collect_list(F.struct("block", "at", "value")))
    text = F.array_join(F.transform(in_order, lambda x: x["value"]), "\n")
    several = lines.where(~alone).withColumn("home", home).groupBy("file", "home").agg(text.alias("value"))
    several = several.where(~((F.col("home.block") == 0) & (F.col("home.nth") == 1))).select("value")
    return whole.unionByName(several).select(F.regexp_replace("value", r"\r\z", "").alias("value"))
