"""Readers: catalog tables, parquet, typed and untyped CSV, audit documents."""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tieout.schemas import RUN_SUMMARY, audit_schema
from tieout.sources.split_csv import csv_records

CORRUPT = "_corrupt_record"


def _with_empty_texts(df: DataFrame, quoted_empty: str) -> DataFrame:
    """Quoted empty fields as empty text; the parser reports them as ``quoted_empty``, so that
    they are not taken for nulls."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name != CORRUPT]
    return df.withColumns(
        {c: F.when(F.col(c) != quoted_empty, F.col(c)).when(F.col(c).isNotNull(), "") for c in texts}
    )


def _scan_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool | None) -> DataFrame:
    """Several tasks read a file where ``multi_line`` is None (breaks are found) or false (there
    are none in fields); one task a file where it is true."""
    quoted_empty = f"\ue000{uuid.uuid4().hex}"  # a text of its own for each read
    options = {"mode": "PERMISSIVE", "escape": '"', "emptyValue": quoted_empty, "columnNameOfCorruptRecord": CORRUPT}
    if multi_line is None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        # breaks within a record stay as they are
        record = F.from_csv("value", columns, options | {"multiLine": "true"})
        parsed = csv_records(spark, path).select(record.alias("r"))
        df = parsed.select([F.col(f"r.`{f.name}`") for f in schema.fields])
    else:
        reader = spark.read.options(**options).option("header", True).option("multiLine", multi_line)
        df = reader.schema(schema).csv(path)
    return _with_empty_texts(df, quoted_empty)


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def scan_parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scan_csv_typed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keep_corrupt: bool = False,
    multi_line: bool | None = None,
) -> DataFrame:
    """CSV with a header under a declared schema. Empty fields are null, quoted ones empty text.

    A row that does not fit the schema is kept with nulls; ``keep_corrupt`` adds the raw
    row as a column so it can be reported. Quoted fields may hold line breaks, and large files
    are split all the same. ``multi_line=False`` is for files whose fields are known to hold
    none, and spares the search for them; ``multi_line=True`` reads each file in one task.
    """
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return _scan_csv(spark, path, schema, multi_line)


def scan_csv_strings(
    spark: SparkSession, path: str, columns: list[str], multi_line: bool | None = None
) -> DataFrame:
    """CSV with a header, every column as text; reads back what the CSV writer wrote."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return _scan_csv(spark, path, schema, multi_line)


def coerce_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns to the schema's types. Bad text becomes null; columns outside it are kept."""
    kinds = {field.name: field.dataType for field in schema.fields}

    def coerced(name: str) -> Column:
        kind = kinds.get(name)
        c = F.col(name)
        if kind is None or isinstance(kind, T.StringType):
            return c
        if isinstance(kind, T.BooleanType):
            # anything that is not a yes, null included, is a no
            return F.coalesce(F.lower(c).isin("true", "1"), F.lit(False)).alias(name)
        return c.try_cast(kind).alias(name)

    return df.select([coerced(name) for name in df.columns])


def scan_audit_jsonl(
    spark: SparkSession, path: str, order_id_type: T.DataType = T.StringType()
) -> DataFrame:
    """Audit documents with the nested evidence brought up to ``evidence_*`` columns."""
    from tieout.operators.audit import flatten_audit

    return flatten_audit(spark.read.schema(audit_schema(order_id_type)).json(path))


def scan_audit_table(spark: SparkSession, path: str) -> DataFrame:
    """All runs of an audit table, with every column that any of them has."""
    return spark.read.option("mergeSchema", True).parquet(path)


def scan_run_summaries(spark: SparkSession, path: str) -> DataFrame:
    """Every run's summary document, as a run history."""
    return spark.read.schema(RUN_SUMMARY).option("recursiveFileLookup", True).json(path)


def query_audit_sql(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql("SELECT * FROM IDENTIFIER(:audit)", args={"audit": table})
