"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014), all in DataFrames.

Every step replaces links by links to the smallest neighbour; it ends when the links form stars.  Joins on a node are
salted by the other end, as a star's centre may hold most of the links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import discard_since, made, written

SALTS = 16


def _smallest(links: DataFrame) -> DataFrame:
    """(u, v) -> (u, v, m): m is the smallest neighbour of u."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_t_s")
    salted = links.withColumn("_t_s", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    return salted.join(least.select("u", "m", salts).hint("merge"), ["u", "_t_s"]).drop("_t_s")


def _step(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = _smallest(both).withColumn("m", F.least("m", "u"))
    large = near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    near = _smallest(large)
    small = near.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
    return small.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """Links (u, v) of any orderable type -> (node, comp), comp the smallest node reachable; only nodes with links.

    Links may repeat and run either way; self links and links with a null end say nothing and are left out; no links give
    an empty table.
    """
    now = written(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    mark = None
    while True:
        found = now.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if found["n"] == 0 or (found["n"], found["x"]) == mark:
            break
        mark = (found["n"], found["x"])
        before = made()
        now = written(_step(now), "links")
        discard_since(now.sparkSession, before - 1, 1)  # the step before
    return now.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
