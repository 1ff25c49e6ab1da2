"""The ten queries over the driver's tables, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, exact_dedup, language_model, packing, quality, secrets, simhash, substring_dedup, tokens, warc
from tessera.llm.common import scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", "n_sentences", "n_removed", (F.col("n_removed") > 0).alias("changed"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    warc.write_warc(_table(spark, sf_dir, "pages"), path)
    back = warc.read_warc(spark, path)
    return back.select(warc.page_of(F.col("record_id")).cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), warc.page_of(F.col("refers_to")).cast("bigint").alias("refers_to"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.suffix_sums(tokens.length_histogram(_table(spark, sf_dir, "documents")))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id")


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(_table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents"))
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "guess")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_substring_dedup, op2_warc, op3_exact_dedup, op4_token_counts, op5_simhash, op6_lm_scoring, op7_quality, op8_secrets, op9_packing, op10_decontamination,
)}

def _said(text: str) -> str:
    """SQL: the words of a text for decontamination; only A to Z are lower-cased."""
    return f"regexp_extract_all(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


ORACLES: dict[str, str] = {
    "op10_decontamination": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_said("text")} AS w FROM documents),
        b AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {_said("text")} AS w FROM benchmark),
        bw AS (SELECT DISTINCT item, n, win FROM (SELECT item, least(len(w), 10) AS n, unnest(list_transform(range(greatest(1, len(w) - 9)), lambda i: array_to_string(w[i + 1:i + 10], ' '))) AS win FROM b WHERE len(w) > 0)),
        dw AS (SELECT r, n, unnest(range(len(w) - n + 1)) AS i, unnest(list_transform(range(len(w) - n + 1), lambda i: array_to_string(w[i + 1:i + n], ' '))) AS win FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n),
        hit AS (SELECT DISTINCT dw.r, dw.i, dw.n, bw.item FROM dw JOIN bw ON bw.n = dw.n AND bw.win = dw.win),
        cov AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
        its AS (SELECT r, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS said FROM hit GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(said, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN cov ON cov.r = d.r LEFT JOIN its ON its.r = d.r
    """,
    "op2_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        d AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest FROM p),
        g AS (SELECT payload_digest, max(page_id) AS stays FROM d WHERE payload_bytes >= 1000 GROUP BY 1)
        SELECT d.page_id, payload_bytes, d.payload_digest,
               CASE WHEN stays IS NULL OR stays = d.page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN stays <> d.page_id THEN stays END AS refers_to
        FROM d LEFT JOIN g ON d.payload_digest = g.payload_digest AND d.payload_bytes >= 1000
    """,
    "op3_exact_dedup": """
        WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
        g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
        SELECT d.doc_id, keep_id, group_size, d.doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
    """,
}
