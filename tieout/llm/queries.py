"""Named queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tieout.llm.attention_lm import language_scores
from tieout.llm.common import table
from tieout.llm.decontaminate import decontaminated
from tieout.llm.filter_audit import filter_audit
from tieout.llm.hard_negatives import hard_negatives, quantized
from tieout.llm.html import extract_text
from tieout.llm.language import identify_language
from tieout.llm.licenses import find_licenses
from tieout.llm.near_dups import near_duplicates
from tieout.llm.neighbours import nearest_neighbours
from tieout.llm.packing import pack_documents
from tieout.llm.secrets import secrets_digest
from tieout.llm.toxicity import toxicity
from tieout.llm.warc import archived


def op1_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op2_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op3_license_patience(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licenses(table(spark, sf_dir, "documents"))


def op4_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), n_words=3, num=85, den=100)


def op5_secret_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_digest(table(spark, sf_dir, "documents"))


def op6_language_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(table(spark, sf_dir, "documents"))


def op7_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminated(documents, benchmark, marked=5)


def op8_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op9_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity(documents, labels).drop("passages")


def op11_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(table(spark, sf_dir, "documents"))


def op12_l2ap_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = quantized(table(spark, sf_dir, "embeddings")).withColumn("label", noisy)
    return hard_negatives(rows, F.col("id") % 100 == 0)


def op13_filter_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_layout": op1_html_layout,
    "op2_warc_bundles": op2_warc_bundles,
    "op3_license_patience": op3_license_patience,
    "op4_superminhash": op4_superminhash,
    "op5_secret_markov": op5_secret_markov,
    "op6_language_hierarchy": op6_language_hierarchy,
    "op7_string_tiling": op7_string_tiling,
    "op8_pattern_packing": op8_pattern_packing,
    "op9_adaptive_scan": op9_adaptive_scan,
    "op10_toxic_segments": op10_toxic_segments,
    "op11_attention_lm": op11_attention_lm,
    "op12_l2ap_negatives": op12_l2ap_negatives,
    "op13_filter_transducer": op13_filter_transducer,
}

#: DuckDB SQL of the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op2_warc_bundles": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS payload_digest,
                   strlen(coalesce(html, '')) AS payload_bytes
            FROM pages),
        q AS (
            SELECT *, CASE WHEN payload_bytes >= 1000
                           THEN max(page_id) OVER (PARTITION BY payload_digest) END AS largest
            FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id < largest THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id < largest THEN largest END AS refers_to
        FROM q""",
    "op12_l2ap_negatives": """
        WITH e AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
                   list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::BIGINT AS score
            FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
            WHERE a.vec_id % 100 = 0),
        p AS (
            SELECT anchor_id, id AS positive_id, score AS positive_score
            FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
        n AS (
            SELECT p.*, s.id AS negative_id, s.score AS negative_score,
                   row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INT AS rank
            FROM p JOIN s USING (anchor_id)
            WHERE NOT s.same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
        FROM n WHERE rank <= 5""",
    "op13_filter_transducer": """
        WITH words AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents),
        d AS (
            SELECT part,
                   CASE WHEN len(w) < 50 THEN 1 ELSE 0 END
                   + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
                   + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 4 ELSE 0 END
                   + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
                   + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask,
                   coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS bad
            FROM words
            LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id)
                USING (doc_id)),
        m AS (
            SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad
            FROM d GROUP BY part, mask),
        letters(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
        orders AS (
            SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
                   [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
            FROM letters a, letters b, letters c, letters d, letters e
            WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
              AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
        steps AS (
            SELECT filter_order, step, bits[step] AS own,
                   coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
            FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
        parts AS (SELECT DISTINCT part FROM m),
        counted AS (
            SELECT p.part, s.filter_order, s.step, s.own,
                   coalesce(sum(n) FILTER (mask & (own | before) = 0), 0) AS kept,
                   coalesce(sum(n) FILTER (mask & own <> 0 AND mask & before = 0), 0) AS removed,
                   coalesce(sum(n) FILTER (mask & own <> 0 AND mask & before <> 0), 0) AS redundant,
                   coalesce(sum(n) FILTER (mask = own), 0) AS unique_fails,
                   coalesce(sum(good) FILTER (mask & own <> 0 AND mask & before = 0), 0) AS good_lost,
                   coalesce(sum(bad) FILTER (mask & own <> 0 AND mask & before = 0), 0) AS toxic_lost
            FROM parts p CROSS JOIN steps s JOIN m ON m.part = p.part
            GROUP BY ALL)
        SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
               redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
               good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
               (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
        FROM counted""",
}
