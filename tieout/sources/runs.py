"""Runs that are published at once, and tables whose schema may change from run to run.

A run writes each of its tables to a folder, or a catalog partition, of its own attempt. Nothing
points there until the attempt is committed: one small document, written last and as one file,
names the run, the attempt and the schemas of its tables. Readers go by these documents alone,
so a run that stopped between two writes is not seen, and a rerun takes the place of the run as
a whole. Every table is read under the merged schema of the runs that are read.
"""

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMIT = (
    "run_id string, attempt string, generation long, "
    "tables array<struct<name: string, format: string, schema: string>>"
)
OWN_COLUMNS = T.StructType([T.StructField("run_id", T.StringType()), T.StructField("attempt", T.StringType())])

# Characters that partition folders write as % and two hexadecimal digits.
ESCAPED = set("\"#%'*/:=?\\\x7f{[]^") | {chr(c) for c in range(32)}
# Digits before the point that whole numbers can have.
WHOLE_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def wider(one: T.DataType, two: T.DataType) -> T.DataType:
    """The type that holds every value of both without loss; ValueError if there is none."""
    kinds = (type(one), type(two))
    if one == two or kinds[1] is T.NullType:
        return one
    if kinds[0] is T.NullType:
        return two
    if all(k in WHOLE_DIGITS for k in kinds):
        return max(one, two, key=lambda t: WHOLE_DIGITS[type(t)])
    if all(k in WHOLE_DIGITS or k is T.DecimalType for k in kinds):
        scale = max(getattr(t, "scale", 0) for t in (one, two))
        digits = max(WHOLE_DIGITS.get(type(t)) or t.precision - t.scale for t in (one, two))
        if digits + scale <= T.DecimalType(38, 0).precision:
            return T.DecimalType(digits + scale, scale)
    floats = {T.FloatType, T.DoubleType}
    exact = {T.ByteType, T.ShortType, T.IntegerType}
    if set(kinds) & floats and set(kinds) <= floats | exact:
        return T.DoubleType() if T.DoubleType in kinds or T.IntegerType in kinds else T.FloatType()
    if set(kinds) == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    if kinds == (T.StructType, T.StructType):
        return merged(one, two)
    if kinds == (T.ArrayType, T.ArrayType):
        return T.ArrayType(wider(one.elementType, two.elementType))
    if kinds == (T.MapType, T.MapType):
        return T.MapType(wider(one.keyType, two.keyType), wider(one.valueType, two.valueType))
    raise ValueError(f"no type holds both {one.simpleString()} and {two.simpleString()}")


def merged(one: T.StructType, two: T.StructType) -> T.StructType:
    """All columns of both, those of the first in their order, with types that hold both."""
    added = {f.name: f.dataType for f in two.fields}
    fields = []
    for f in one.fields:
        try:
            kind = wider(f.dataType, added.pop(f.name, T.NullType()))
        except ValueError as e:
            raise ValueError(f"column {f.name}: {e}") from None
        fields.append(T.StructField(f.name, kind))
    return T.StructType(fields + [T.StructField(n, kind) for n, kind in added.items()])


def fitted(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame under the schema; columns it lacks are null, columns beyond it stay behind."""
    have = set(df.columns)
    return df.select(
        *[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def _plain(schema: T.StructType) -> T.StructType:
    """Without the columns that say which run and attempt a row is of; every column nullable."""
    kept = [f for f in schema.fields if f.name not in OWN_COLUMNS.fieldNames()]
    return merged(T.StructType(), T.StructType(kept))


@dataclass(frozen=True)
class Commit:
    run_id: str
    attempt: str
    generation: int
    #: (format, schema) of each table.
    tables: dict[str, tuple[str, T.StructType]]


class RunStore:
    """Published runs under a folder that Spark can write to."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def begin(self, run_id: str) -> "Attempt":
        return Attempt(self, run_id, uuid.uuid4().hex)

    def place(self, table: str, run_id: str, attempt: str) -> str:
        folder = "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in run_id)
        return f"{self.root}/{table}/run_id={folder}/attempt={attempt}"

    def _documents(self) -> DataFrame | None:
        try:
            reader = self.spark.read.schema(COMMIT).option("recursiveFileLookup", True)
            return reader.json(f"{self.root}/commits")
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def commits(self) -> list[Commit]:
        """The commit that counts for each run, the last one, in the order they were made."""
        documents = self._documents()
        if documents is None:
            return []
        last = documents.groupBy("run_id").agg(
            F.max(F.struct("generation", "attempt", "tables")).alias("c")
        )
        found = [
            Commit(
                r.run_id,
                r.c.attempt,
                r.c.generation,
                {t.name: (t.format, T.StructType.fromJson(json.loads(t.schema))) for t in r.c.tables},
            )
            for r in last.collect()  # one row for each run
        ]
        return sorted(found, key=lambda c: (c.generation, c.attempt))

    def read(self, table: str, run_id: str | None = None) -> DataFrame:
        """A table of one published run, or of all, with ``run_id`` as its first column."""
        groups: dict[tuple[str, str], list[Commit]] = {}
        for c in self.commits():
            if table in c.tables and run_id in (None, c.run_id):
                kind, schema = c.tables[table]
                groups.setdefault((kind, schema.json()), []).append(c)
        if not groups:
            raise ValueError(f"no published run has a table {table}" if run_id is None else f"no table {table} of a published run {run_id}")
        schemas = [c[0].tables[table][1] for c in groups.values()]
        whole = T.StructType([OWN_COLUMNS["run_id"], *reduce(merged, schemas).fields])
        frames = []
        for (kind, _), members in groups.items():
            own = T.StructType([*members[0].tables[table][1].fields, *OWN_COLUMNS.fields])
            paths = [self.place(table, c.run_id, c.attempt) for c in members]
            reader = self.spark.read.schema(own).option("basePath", f"{self.root}/{table}")
            frames.append(fitted(reader.format(kind).load(paths), whole))
        return reduce(DataFrame.unionByName, frames)


class Attempt:
    """One attempt at a run: tables are written, then committed together."""

    def __init__(self, store: RunStore, run_id: str, attempt: str):
        self.store, self.run_id, self.attempt = store, run_id, attempt
        self.tables: dict[str, tuple[str, T.StructType]] = {}

    def path(self, table: str) -> str:
        return self.store.place(table, self.run_id, self.attempt)

    def add(self, table: str, kind: str, schema: T.StructType) -> None:
        """Count a table that was written to :meth:`path` in its own way as one of the run's."""
        self.tables[table] = (kind, _plain(schema))

    def write(self, df: DataFrame, table: str) -> DataFrame:
        """Write a table of the run and go on from what was written."""
        plain = _plain(df.schema)
        df.select(*[f"`{c}`" for c in plain.fieldNames()]).write.mode("overwrite").parquet(self.path(table))
        self.add(table, "parquet", df.schema)
        back = df.sparkSession.read.schema(plain).parquet(self.path(table))
        return back.withColumn("run_id", F.lit(self.run_id)).select(*[f"`{c}`" for c in df.columns])

    def commit(self) -> None:
        """Publish the run: from here on readers see its tables in place of earlier attempts."""
        documents = self.store._documents()
        before = 0
        if documents is not None:
            before = documents.agg(F.coalesce(F.max("generation"), F.lit(0))).first()[0]
        tables = [(name, kind, schema.json()) for name, (kind, schema) in self.tables.items()]
        row = (self.run_id, self.attempt, before + 1, tables)
        document = self.store.spark.createDataFrame([row], COMMIT).coalesce(1)
        document.write.json(f"{self.store.root}/commits/{self.attempt}")


class CatalogRuns:
    """Published runs in a schema of the catalog.

    Each table's attempts are partitions of one external table, ``<table>_runs_v<n>``; the table
    ``run_commits`` has a row for each published attempt, and views join the two. New columns
    are added to the table; where a type has to be widened, the same files get a new table over
    them and the view moves to it.
    """

    def __init__(self, spark: SparkSession, schema_name: str):
        self.spark, self.schema = spark, schema_name
        self.place = spark.catalog.getDatabase(schema_name).locationUri.rstrip("/")
        self.commits = f"{schema_name}.run_commits"
        if not spark.catalog.tableExists(self.commits):
            spark.sql(
                f"CREATE TABLE {self.commits} (run_id STRING, attempt STRING, generation BIGINT) "
                f"USING parquet LOCATION '{self.place}/run_commits'"
            )

    def _versions(self, table: str) -> list[str]:
        rows = self.spark.sql(f"SHOW TABLES IN {self.schema} LIKE '{table}_runs_v*'").collect()
        return sorted((r.tableName for r in rows), key=lambda n: int(n.rsplit("_v", 1)[1]))

    def _create(self, name: str, table: str, schema: T.StructType) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*schema.fields, *OWN_COLUMNS.fields])
        self.spark.sql(
            f"CREATE TABLE {self.schema}.{name} ({columns}) USING parquet "
            f"PARTITIONED BY (run_id, attempt) LOCATION '{self.place}/{table}_runs'"
        )

    def _holder(self, table: str, schema: T.StructType) -> str:
        """The table that can take rows of the schema, grown or made where there is none."""
        versions = self._versions(table)
        if not versions:
            self._create(f"{table}_runs_v1", table, schema)
            return f"{self.schema}.{table}_runs_v1"
        name = f"{self.schema}.{versions[-1]}"
        have = _plain(self.spark.table(name).schema)
        whole = merged(have, schema)
        if any(whole[f.name].dataType != f.dataType for f in have.fields):
            number = int(versions[-1].rsplit("_v", 1)[1]) + 1
            self._create(f"{table}_runs_v{number}", table, whole)
            name = f"{self.schema}.{table}_runs_v{number}"
            self.spark.sql(f"MSCK REPAIR TABLE {name}")
        elif len(whole) > len(have):
            added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in whole.fields[len(have) :])
            self.spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({added})")
        return name

    def write(self, df: DataFrame, table: str, run_id: str, attempt: str) -> DataFrame:
        """Write a table of an attempt and go on from what was written."""
        name = self._holder(table, _plain(df.schema))
        rows = fitted(df.drop("run_id"), _plain(self.spark.table(name).schema))
        rows = rows.withColumns({"run_id": F.lit(run_id), "attempt": F.lit(attempt)})
        rows.write.mode("append").insertInto(name)
        own = self.spark.table(name).where((F.col("run_id") == run_id) & (F.col("attempt") == attempt))
        return own.select(*[f"`{c}`" for c in df.columns])

    def commit(self, run_id: str, attempt: str) -> None:
        """Publish an attempt: one row in one file."""
        before = self.spark.table(self.commits).agg(F.coalesce(F.max("generation"), F.lit(0))).first()[0]
        row = self.spark.createDataFrame([(run_id, attempt, before + 1)], "run_id string, attempt string, generation long")
        row.coalesce(1).write.mode("append").insertInto(self.commits)

    def show(self, view: str, table: str, last_only: bool = False, with_run: bool = True) -> str:
        """A view of the published rows of all runs, or of the run published last."""
        latest = f"SELECT run_id, max_by(attempt, generation) AS attempt, max(generation) AS generation FROM {self.commits} GROUP BY run_id"
        if last_only:
            latest += " ORDER BY generation DESC LIMIT 1"
        versions = self._versions(table)
        name = f"{self.schema}.{versions[-1]}"
        columns = [f"d.`{f.name}`" for f in _plain(self.spark.table(name).schema).fields]
        columns += ["d.run_id"] * with_run
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.schema}.{view} AS SELECT {', '.join(columns)} FROM {name} d "
            f"LEFT SEMI JOIN ({latest}) c ON d.run_id = c.run_id AND d.attempt = c.attempt"
        )
        for old in versions[:-1]:
            self.spark.sql(f"DROP TABLE {self.schema}.{old}")  # its files belong to the new one
        return f"{self.schema}.{view}"
