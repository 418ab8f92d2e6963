"""Writers. Each takes a DataFrame and a place; nothing passes through the driver."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieout.fixed_values import AUDIT_CSV_COLUMNS, SLICE_COLUMNS

def sink_table(
    df: DataFrame,
    schema_name: str,
    table: str,
    location: str | None = None,
    bucket_by: tuple[str, int] | None = None,
) -> str:
    """Create the schema if needed and overwrite ``schema.table``; returns the table name.

    ``bucket_by=(column, n)`` stores the table hashed and sorted on its join key, after
    which joins and aggregates on that key read it without a shuffle.
    """
    where = f" LOCATION '{location}'" if location else ""
    df.sparkSession.sql(f"CREATE SCHEMA IF NOT EXISTS {schema_name}{where}")
    name = f"{schema_name}.{table}"
    writer = df.write.mode("overwrite").format("parquet")
    if bucket_by:
        key, buckets = bucket_by
        # one file per bucket: hash the rows the way the buckets are hashed first
        writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet")
        writer = writer.bucketBy(buckets, key).sortBy(key)
    writer.saveAsTable(name)
    return name


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write the frame under a shared path and go on from what was written."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sink_audit_table(audit: DataFrame, path: str, replace_run: bool = False) -> None:
    """Append a run, partitioned by ``run_id``.

    ``replace_run`` swaps only the partitions of the runs that are written, so a rerun of
    one run leaves the others alone. Runs may have other columns than earlier ones;
    ``scan_audit_table`` reads them all. Where types change too, or a run has to appear at
    once, write it with ``RunStore``.
    """
    mode = "overwrite" if replace_run else "append"
    (
        audit.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(path)
    )


def sink_audit_jsonl(audit: DataFrame, path: str) -> None:
    """One object per order, evidence nested, nulls written out; gzip, as names and fixed texts
    are most of a document and stand in each. Readers of JSON open these files as they are."""
    writer = _iso_times(audit).write.mode("overwrite").option("compression", "gzip")
    writer.option("ignoreNullFields", False).json(path)


def sink_audit_csv(audit: DataFrame, path: str) -> None:
    _quoted_csv(audit.select(*AUDIT_CSV_COLUMNS), path)


def sink_table_csv(df: DataFrame, path: str) -> None:
    """A whole table as CSV with a header; null becomes an empty field."""
    _quoted_csv(df, path)


def sink_document(one_row: DataFrame, path: str, mode: str = "append") -> None:
    """A one-row frame as one JSON document (run summary, grading report)."""
    writer = _iso_times(one_row).coalesce(1).write.mode(mode)
    writer.option("ignoreNullFields", False).json(path)


def export_slice_csv(audit_slice: DataFrame, path: str) -> None:
    _quoted_csv(audit_slice.select(*SLICE_COLUMNS), path)


def _quoted_csv(df: DataFrame, path: str) -> None:
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("nullValue", "")
        .option("emptyValue", '""')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def _iso_times(df: DataFrame) -> DataFrame:
    times = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns(
        {name: F.date_format(name, "yyyy-MM-dd'T'HH:mm:ssXXX") for name in times}
    )
