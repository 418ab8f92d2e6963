"""A corpus from raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tieout.llm.common import stored, table
from tieout.llm.decontaminate import leaks
from tieout.llm.language import identify_language
from tieout.llm.near_dups import grouped
from tieout.llm.packing import pack_documents
from tieout.llm.secrets import find_secrets, let, running

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

def _keyed(docs: DataFrame) -> DataFrame:
    """The documents' columns and a digest of each text; an id may stand on several texts."""
    return docs.select(*COLUMNS, F.coalesce(F.sha2("text", 256), F.lit("")).alias("text_key"))


def in_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; texts without letters go. Where no document has a
    language to learn from, all texts with letters stay."""
    return identify_language(docs, carry=COLUMNS[1:]).where("lettered").select(COLUMNS)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group stays, the one with the smallest id, then digest of
    its text, then other columns; so does one of rows that repeat an id and a text without
    words. An id on texts of several groups may stay several times. Rows without an id all
    stay."""
    keyed = _keyed(docs)
    found = grouped(keyed, text_key="text_key").where("doc_id is not null")
    alone = F.col("component").isNull()
    kept = (
        found.groupBy(
            "component", F.when(alone, F.col("doc_id")).alias("own_id"), F.when(alone, F.col("text_key")).alias("own_key")
        )
        .agg(F.min(F.struct("doc_id", "text_key")).alias("first"))
        .select("first.doc_id", "first.text_key")
    )
    rows = keyed.join(kept, ["doc_id", "text_key"], "left_semi")
    rest = ["lang", "source", "n_chars"]
    one = rows.groupBy("doc_id", "text_key").agg(
        F.first("text").alias("text"), F.min(F.struct(rest)).alias("rest")
    )
    return one.select("doc_id", "text", *(f"rest.{c}" for c in rest)).union(
        docs.where("doc_id is null").select(COLUMNS)
    )


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds no passage of the benchmark, with or without an id. Items of fewer
    than five words say nothing of where a text is from, and reject none."""
    keyed = _keyed(docs)
    found = leaks(keyed, table(spark, sf_dir, "benchmark"), text_key="text_key", marked=5)
    # what a text holds depends on the text alone
    return keyed.join(found.select("text_key").distinct(), "text_key", "left_anti").select(COLUMNS)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets blotted out; the rest of each text stays, character by
    character, and ``n_chars`` follows."""
    found = find_secrets(docs.select(COLUMNS))
    def places(spans: Column) -> Column:
        numbers = F.transform(spans, lambda s: F.split(s, ":"))
        return F.transform(
            numbers,
            lambda n: F.struct(
                F.element_at(n, 2).cast("int").alias("start"), F.element_at(n, 3).cast("int").alias("end")
            ),
        )

    def parts(spans: Column) -> Column:
        # spans come by start; how far those before a span reach says what is left between
        reach = running(F.transform(spans, lambda s: s["end"]), 0, lambda x, y: F.greatest(x, y))
        before = F.slice(F.concat(F.array(F.lit(0)), reach), F.lit(1), F.size(spans))
        gaps = F.zip_with(
            spans, before, lambda s, at: F.when((at == 0) | (s["start"] >= at), F.struct(at.alias("a"), s["start"].alias("b")))
        )
        return F.concat(
            F.transform(F.filter(gaps, lambda g: g.isNotNull()), lambda g: F.struct(g["a"].alias("a"), g["b"].alias("b"))),
            F.array(F.struct(F.element_at(reach, -1).alias("a"), F.length("text").alias("b"))),
        )

    def joined(wide: Column, spans: Column) -> Column:
        # four bytes a character, so that cutting a part out takes as long as the part is; the
        # mark in front is what a decoder takes off
        def text_of(g: Column) -> Column:
            own = wide.substr(4 * g["a"] + 1, 4 * (g["b"] - g["a"]))
            return F.decode(F.concat(F.lit(bytearray(b"\x00\x00\xfe\xff")), own), "UTF-32")

        return F.array_join(F.transform(let(spans, parts), text_of), "[SECRET]")

    blotted = let(
        F.encode("text", "UTF-32"),
        lambda wide: let(places(F.split("spans", ",")), lambda spans: joined(wide, spans)),
    )
    clean = F.when(F.col("spans") == "", F.col("text")).otherwise(blotted)
    kind = docs.schema["n_chars"].dataType
    length = F.when(F.col("spans") == "", F.col("n_chars")).otherwise(F.length("clean").cast(kind))
    return found.withColumn("clean", clean).select(
        "doc_id", F.col("clean").alias("text"), "lang", "source", length.alias("n_chars")
    )


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their places in the training sequences."""
    return pack_documents(docs)


STAGES = [
    ("language", in_known_language),
    ("near_duplicates", without_near_copies),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: Trained models, signatures and packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
