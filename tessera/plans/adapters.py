"""The driver's tables as sensor streams, in Spark and in DuckDB SQL, with deterministic faults put in on both sides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

HOUR = 3_600_000_000_000
DAY = 24 * HOUR


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def nanos(c: str) -> Column:
    """A timestamp without zone as nanoseconds since 1970, whatever the session's zone."""
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast({c} as timestamp_ntz)) * 1000")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k (user), i (place in the stream), id, t (every 101st event an hour early), v, e."""
    i = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    t = nanos("ts") - F.when(F.col("event_id") % 101 == 0, HOUR).otherwise(0)
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("k"), i.cast("bigint").alias("i"), F.col("event_id").alias("id"), t.alias("t"), F.col("value").alias("v"), F.col("event_type").alias("e"))


EVENTS = f"""ev AS (SELECT user_id AS k, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i, event_id AS id,
    epoch_us(ts) * 1000 - CASE WHEN event_id % 101 = 0 THEN {HOUR} ELSE 0 END AS t, value AS v, event_type AS e FROM events)"""


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k (supplier), i (place by order, line and part), t (ship date: many equal ones), q, p (every 53rd order's is NaN), d."""
    i = F.row_number().over(Window.partitionBy("l_suppkey").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice")) - 1
    p = F.when(F.col("l_orderkey") % 53 == 0, float("nan")).otherwise(F.col("l_extendedprice"))
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("k"), i.cast("bigint").alias("i"), nanos("l_shipdate").alias("t"), F.col("l_quantity").alias("q"), p.alias("p"), F.col("l_discount").alias("d"), F.col("l_tax").alias("x"))


SHIPMENTS = """sh AS (SELECT l_suppkey AS k, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_shipdate, l_extendedprice) - 1 AS i,
    epoch_us(l_shipdate) * 1000 AS t, l_quantity AS q, CASE WHEN l_orderkey % 53 = 0 THEN 'NaN'::DOUBLE ELSE l_extendedprice END AS p,
    l_discount AS d, l_tax AS x FROM lineitem)"""


def six(c: str | Column) -> Column:
    return F.bround(F.col(c) if isinstance(c, str) else c, 6)
