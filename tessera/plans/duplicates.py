"""Duplicates over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import dedup
from tessera.plans.adapters import SHIPMENTS, shipments, table
from tessera.plans.registry import query


@query("SELECT sha256(text) AS sha256, count(*) AS n, min(doc_id) AS first_key, max(doc_id) AS last_key FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def hash_groups(spark, sf_dir):
    return dedup.hash_groups(table(spark, sf_dir, "documents"), "doc_id", "text")


_CODES = "b AS (SELECT vec_id, list_reduce(list_prepend(''::VARCHAR, list_transform(embedding[1:24], lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END)), lambda s, v: s || v) AS c FROM embeddings), re AS (SELECT c, min(vec_id) AS k FROM b GROUP BY c)"


def _codes(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", dedup.sign_code("embedding", 24).alias("code"))


@query(f"""WITH {_CODES} SELECT a.k AS key_a, z.k AS key_b, bit_count(xor(a.c::BIT, z.c::BIT))::BIGINT AS distance FROM re a JOIN re z ON a.k < z.k AND bit_count(xor(a.c::BIT, z.c::BIT)) <= 4""")
def hamming_pairs(spark, sf_dir):
    return dedup.hamming_pairs(_codes(spark, sf_dir), "vec_id", "code", 4, 24)


@query(f"WITH {_CODES} SELECT vec_id, k AS representative FROM b JOIN re USING (c)")
def hamming_classes(spark, sf_dir):
    return dedup.class_members(_codes(spark, sf_dir), "vec_id", "code")


HISTOGRAM = f"""{SHIPMENTS}, va AS (SELECT k, p AS v FROM sh WHERE NOT isnan(p)), en AS (SELECT k, min(v) AS lo, max(v) AS hi, count(*) AS n FROM va GROUP BY k),
    bi AS (SELECT va.k, least(floor((v - lo) / (hi - lo) * 20), 19)::INT AS bin, count(*) AS c FROM va JOIN en USING (k) GROUP BY 1, 2), al AS (SELECT k, lo, hi, n, unnest(range(20))::INT AS bin FROM en),
    hi AS (SELECT al.k, al.bin, coalesce(c, 0) / (n * ((hi - lo) / 20)) AS density FROM al LEFT JOIN bi ON al.k = bi.k AND al.bin = bi.bin)"""


def _prints(spark, sf_dir):
    return dedup.histogram(shipments(spark, sf_dir), ["k"], "p")


@query(f"WITH {HISTOGRAM} SELECT k, bin, round_even(density * 1e6, 6) AS density FROM hi")
def trajectory_fingerprint(spark, sf_dir):
    return _prints(spark, sf_dir).select("k", "bin", F.bround(F.col("density") * 1e6, 6).alias("density"))


@query(f"""WITH {HISTOGRAM}, ve AS (SELECT k, list(density ORDER BY bin) AS c FROM hi GROUP BY k), re AS (SELECT min(k) AS k FROM ve GROUP BY c), hr AS (SELECT hi.* FROM hi JOIN re USING (k))
    SELECT a.k AS key_a, b.k AS key_b, round_even(corr(a.density, b.density), 6) AS correlation FROM hr a JOIN hr b ON a.bin = b.bin AND a.k < b.k GROUP BY 1, 2 HAVING corr(a.density, b.density) >= 0.6""")
def trajectory_duplicates(spark, sf_dir):
    out = dedup.correlated_pairs(_prints(spark, sf_dir), "k", ["bin"], "density", 0.6)
    return out.withColumn("correlation", F.bround("correlation", 6))


@query("SELECT sha256(string_agg(conv_id || ':' || turn || ':' || role, ',' ORDER BY turn)) AS content_hash, conv_id FROM conversations GROUP BY conv_id")
def content_hashes(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    parts = F.array_sort(F.collect_list(F.struct("turn", F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"), F.col("role")).alias("s"))))
    return c.groupBy("conv_id").agg(F.sha2(F.array_join(F.transform(parts, lambda x: x["s"]), ","), 256).alias("content_hash")).select("content_hash", "conv_id")


@query("SELECT p_type, p_size, count(*) AS n, count(DISTINCT p_brand) AS brands FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49) GROUP BY 1, 2")
def work_list(spark, sf_dir):
    """Work that no completed manifest row covers, by its input and configuration."""
    done = table(spark, sf_dir, "lineitem").where("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey")).distinct()
    left = table(spark, sf_dir, "part").join(done, "p_partkey", "left_anti")
    return left.groupBy("p_type", "p_size").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("p_brand").alias("brands"))
