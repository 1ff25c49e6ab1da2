"""Streaming twins over the driver's tables: a file source worked off in several micro-batches."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans.adapters import HOUR, table
from tessera.plans.registry import query
from tessera.streaming import clocks


def scratch(spark: SparkSession) -> str:
    """A new folder below the one that the cluster names; an own one only where none is named, in local mode (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    root = root or f"file://{tempfile.mkdtemp(prefix='tessera-')}"
    return f"{root.rstrip('/')}/stream-{uuid.uuid4().hex}"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.readStream.schema(table(spark, sf_dir, "events").schema).option("maxFilesPerTrigger", 1).parquet(f"{sf_dir}/events.parquet*")
    t = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts) * 1000")
    return rows.select(F.col("user_id").alias("k"), F.col("event_id").alias("id"), t.alias("t"), F.col("event_type").alias("e"), F.col("value").alias("v"), F.timestamp_micros(F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")).alias("at"))


_EV = "ev AS (SELECT user_id AS k, event_id AS id, epoch_us(ts) * 1000 AS t, event_type AS e, value AS v, ts FROM events)"


def _worked_off(spark, stream: DataFrame, mode: str = "append") -> DataFrame:
    folder = scratch(spark)
    return clocks.run_once(stream, f"{folder}/rows", f"{folder}/checkpoint", mode)


@query(f"""WITH {_EV}, d AS (SELECT *, t - lag(t) OVER (PARTITION BY k ORDER BY id) AS x FROM ev), r AS (SELECT k, id, t, coalesce(x, 0) AS delta_ns, CASE WHEN x IS NULL THEN 'stream_start' WHEN x < 0 THEN 'timestamp_rollback' WHEN x = 0 THEN 'timestamp_duplicate' WHEN x > {24 * HOUR} THEN 'timestamp_gap' ELSE '' END AS continuity_start_reason FROM d)
    SELECT *, CAST(sum(CASE WHEN continuity_start_reason IN ('', 'stream_start') THEN 0 ELSE 1 END) OVER (PARTITION BY k ORDER BY id) AS BIGINT) AS continuity_group FROM r""")
def streaming_continuity(spark, sf_dir):
    return _worked_off(spark, clocks.continuity(_events(spark, sf_dir).select("k", "id", "t"), "k", "id", "t", 24 * HOUR))


@query(f"""WITH RECURSIVE {_EV}, n AS (SELECT k, id, t, row_number() OVER (PARTITION BY k ORDER BY id) AS r FROM ev), f AS (SELECT k, id, t, r, t AS model_ts FROM n WHERE r = 1 UNION ALL SELECT n.k, n.id, n.t, n.r, greatest(f.model_ts + 1, n.t) FROM f JOIN n ON n.k = f.k AND n.r = f.r + 1) SELECT k, id, t, model_ts FROM f""")
def streaming_forced_increasing(spark, sf_dir):
    return _worked_off(spark, clocks.forced_increasing(_events(spark, sf_dir).select("k", "id", "t"), "k", "id", "t"))


_MARK = "mk AS (SELECT max(epoch_us(ts)) - 3600000000 AS mark FROM events)"


def _window_sql(slide_us: int, length_us: int = 86_400_000_000) -> str:
    return f"""WITH {_EV}, {_MARK}, wi AS (SELECT e, v, (t // 1000) // {slide_us} * {slide_us} - j * {slide_us} AS start_us FROM ev, range({length_us // slide_us}) r(j))
    SELECT e, start_us, count(*) AS rows, round_even(sum(v), 6) AS total FROM wi, mk WHERE start_us + {length_us} <= mark GROUP BY e, start_us"""


def _closed_windows(spark, sf_dir, slide: str | None):
    out = _worked_off(spark, clocks.windows(_events(spark, sf_dir), ["e"], "at", "v", "1 day", "1 hour", slide))
    return out.select("e", F.unix_micros("window_start").alias("start_us"), "rows", F.bround("total", 6).alias("total"))


@query(_window_sql(86_400_000_000))
def streaming_windows(spark, sf_dir):
    """Windows that the watermark has closed."""
    return _closed_windows(spark, sf_dir, None)


@query(_window_sql(21_600_000_000))
def streaming_sliding_windows(spark, sf_dir):
    return _closed_windows(spark, sf_dir, "6 hours")


@query(f"""WITH {_EV}, {_MARK}, g AS (SELECT k, t // 1000 AS u, CASE WHEN t // 1000 - lag(t // 1000) OVER (PARTITION BY k ORDER BY t) < 21600000000 THEN 0 ELSE 1 END AS s FROM ev), n AS (SELECT k, u, sum(s) OVER (PARTITION BY k ORDER BY u ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n FROM g),
    se AS (SELECT k, min(u) AS start_us, max(u) + 21600000000 AS end_us, count(*) AS rows FROM n GROUP BY k, n) SELECT k, start_us, end_us, rows FROM se, mk WHERE end_us <= mark""")
def streaming_sessions(spark, sf_dir):
    """Sessions that the watermark has closed."""
    out = _worked_off(spark, clocks.sessions(_events(spark, sf_dir), "k", "at", "6 hours", "1 hour"))
    return out.select("k", F.unix_micros("session_start").alias("start_us"), F.unix_micros("session_end").alias("end_us"), "rows")


@query(f"""WITH {_EV}, l AS (SELECT k, max(id) AS last FROM ev WHERE id % 7 <> 0 GROUP BY k) SELECT ev.k, ev.id, ev.id % 7 = 0 AND ev.id <= coalesce(last, -1) AS late FROM ev LEFT JOIN l ON l.k = ev.k""")
def streaming_late_rows(spark, sf_dir):
    """Two deliveries, the second of rows that mostly should have come before: the clock's state names these late."""
    folder = f"{scratch(spark)}/deliveries"
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("k"), F.col("event_id").alias("id"), F.col("ts"))
    rows = rows.select("k", "id", F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts) * 1000").alias("t"))
    out = scratch(spark)
    for part in (rows.where("id % 7 <> 0"), rows.where("id % 7 = 0")):  # the second run goes on from the first's state
        part.coalesce(1).write.mode("append").parquet(folder)
        found = clocks.continuity(spark.readStream.schema(rows.schema).parquet(folder), "k", "id", "t", 24 * HOUR)
        done = clocks.run_once(found, f"{out}/rows", f"{out}/checkpoint")
    return done.select("k", "id", (F.col("continuity_start_reason") == "late").alias("late"))


@query(f"WITH {_EV} SELECT k, count(*) AS rows FROM ev GROUP BY k")
def streaming_distinct(spark, sf_dir):
    rows = _events(spark, sf_dir)
    twice = rows.unionByName(rows)
    out = _worked_off(spark, clocks.distinct_rows(twice, ["id"], "at", "400 days").select("k", "id"))
    return out.groupBy("k").agg(F.count(F.lit(1)).alias("rows"))
