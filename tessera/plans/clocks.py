"""Clock checks over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import timeline
from tessera.plans.adapters import DAY, EVENTS, HOUR, SHIPMENTS, events, shipments
from tessera.plans.registry import query

_MISSING = "CAST(greatest(0, round_even(gap_ns / {e}::DOUBLE, 0) - 1) AS BIGINT)"


@query(f"""
    WITH {EVENTS}, d AS (SELECT *, lag(t) OVER w AS p, t - lag(t) OVER w AS gap_ns FROM ev WINDOW w AS (PARTITION BY k ORDER BY i))
    SELECT k, i AS frame_index, p AS start_ns, t AS end_ns, gap_ns, CASE WHEN gap_ns >= {DAY} THEN 'error' ELSE 'warning' END AS severity,
           CASE WHEN gap_ns >= {DAY} THEN 'split' ELSE 'keep_with_flag' END AS decision, {_MISSING.format(e=HOUR)} AS estimated_missing
    FROM d WHERE gap_ns > {2 * HOUR}
""")
def timestamp_gaps(spark, sf_dir):
    return timeline.timestamp_gaps(events(spark, sf_dir), ["k"], "i", "t", HOUR, 2.0, DAY)


@query(f"""
    WITH {SHIPMENTS}, u AS (SELECT DISTINCT k, t FROM sh),
    d AS (SELECT k, t, lag(t) OVER w AS p, row_number() OVER w - 1 AS n FROM u WINDOW w AS (PARTITION BY k ORDER BY t)),
    m AS (SELECT k, median(t - p) AS m FROM d GROUP BY k),
    j AS (SELECT d.*, t - p AS gap_ns, greatest({2 * DAY}::BIGINT, trunc(m * 2.0)::BIGINT) AS threshold_ns FROM d JOIN m USING (k))
    SELECT k, n AS sample_index, p AS start_ns, t AS end_ns, gap_ns, threshold_ns, CASE WHEN gap_ns >= {5 * DAY} THEN 'error' ELSE 'warning' END AS severity,
           CASE WHEN gap_ns >= {5 * DAY} THEN 'split' ELSE 'keep_with_flag' END AS decision, {_MISSING.format(e=DAY)} AS estimated_missing
    FROM j WHERE gap_ns > threshold_ns
""")
def sensor_gaps(spark, sf_dir):
    return timeline.sensor_gaps(shipments(spark, sf_dir), ["k"], "t", DAY, 2.0, 5 * DAY)


@query(f"""
    WITH {EVENTS}, d AS (SELECT *, lag(t) OVER w AS p, lag(i) OVER w AS pi, t - lag(t) OVER w AS gap_ns FROM ev WINDOW w AS (PARTITION BY k ORDER BY i))
    SELECT k, pi AS sample_index, p AS start_ns, t AS end_ns, gap_ns, CASE WHEN gap_ns >= {DAY} THEN 'timeseries_long_gap' ELSE 'timeseries_short_gap' END AS issue_type,
           CASE WHEN gap_ns >= {DAY} THEN 'error' ELSE 'warning' END AS severity, CASE WHEN gap_ns >= {DAY} THEN 'split' ELSE 'keep_with_flag' END AS decision
    FROM d WHERE gap_ns >= {6 * HOUR}
""")
def series_gaps(spark, sf_dir):
    return timeline.short_and_long_gaps(events(spark, sf_dir), ["k"], "i", "t", 6 * HOUR, DAY)


CONTINUITY = f"""{EVENTS}, d AS (SELECT *, t - lag(t) OVER (PARTITION BY k ORDER BY i) AS dt FROM ev),
    m AS (SELECT k, greatest({HOUR // 2}::BIGINT, coalesce(trunc(trunc(median(dt) FILTER (WHERE dt > 0)) * 3.0)::BIGINT, 0)) AS limit_ns FROM d GROUP BY k),
    r AS (SELECT d.*, limit_ns, CASE WHEN dt IS NULL THEN 'stream_start' WHEN dt < 0 THEN 'timestamp_rollback' WHEN dt = 0 THEN 'timestamp_duplicate'
          WHEN dt > limit_ns THEN 'timestamp_gap' ELSE '' END AS reason FROM d JOIN m USING (k)),
    c AS (SELECT k, i, id, t, v, e, coalesce(dt, 0) AS delta_ns, limit_ns AS gap_threshold_ns, reason AS continuity_start_reason,
          CAST(sum(CASE WHEN reason IN ('', 'stream_start') THEN 0 ELSE 1 END) OVER (PARTITION BY k ORDER BY i) AS BIGINT) AS continuity_group FROM r)"""


def continuity_rows(spark, sf_dir, **how):
    return timeline.continuity(events(spark, sf_dir), ["k"], "i", "t", HOUR // 2, 3.0, **how)


@query(f"WITH {CONTINUITY} SELECT * FROM c")
def timeline_continuity(spark, sf_dir):
    return continuity_rows(spark, sf_dir)


@query(f"WITH {CONTINUITY} SELECT * FROM c")
def timeline_continuity_sliced(spark, sf_dir):
    """The same with streams cut into stretches of 16 rows, as a stream that holds most rows would be."""
    return continuity_rows(spark, sf_dir, slice_rows=16)


@query(f"""
    WITH {CONTINUITY} SELECT k, count(*) AS sample_count, max(continuity_group) + 1 AS group_count, count_if(continuity_start_reason = 'timestamp_duplicate')::BIGINT AS duplicate_count,
    count_if(continuity_start_reason = 'timestamp_rollback')::BIGINT AS rollback_count, count_if(delta_ns > gap_threshold_ns)::BIGINT AS long_gap_count, max(gap_threshold_ns) AS gap_threshold_ns FROM c GROUP BY k
""")
def continuity_summary(spark, sf_dir):
    return timeline.continuity_summary(continuity_rows(spark, sf_dir), ["k"], "t")


ISSUES = f"""{CONTINUITY}, iss AS (SELECT k, i AS sample_index, continuity_start_reason AS issue_type, CASE WHEN continuity_start_reason = 'timestamp_duplicate' THEN t ELSE t - delta_ns END AS start_ns, t AS end_ns,
    CASE continuity_start_reason WHEN 'timestamp_rollback' THEN 'critical' WHEN 'timestamp_gap' THEN 'error' ELSE 'warning' END AS severity,
    CASE WHEN continuity_start_reason = 'timestamp_duplicate' THEN 'keep_with_flag' ELSE 'split' END AS decision
    FROM c WHERE continuity_start_reason NOT IN ('', 'stream_start'))"""


def issue_rows(spark, sf_dir):
    return timeline.continuity_issues(continuity_rows(spark, sf_dir), ["k"], "t", "i")


@query(f"WITH {ISSUES} SELECT * FROM iss")
def continuity_issues(spark, sf_dir):
    return issue_rows(spark, sf_dir)


@query(f"""
    WITH {EVENTS}, x AS (SELECT *, CASE WHEN id % 89 = 0 THEN 0.0 ELSE 0.6 END AS qa, CASE WHEN id % 89 = 0 THEN 0.0 ELSE 0.8 END AS qb FROM ev),
    d AS (SELECT *, t - lag(t) OVER w AS delta_ns, lag(e) OVER w AS pe FROM x WINDOW w AS (PARTITION BY k ORDER BY i)),
    m AS (SELECT k, greatest({HOUR}::BIGINT, coalesce(trunc(median(delta_ns) FILTER (WHERE delta_ns > 0) * 10)::BIGINT, 0)) AS lim FROM d GROUP BY k),
    r AS (SELECT k, i, CASE WHEN delta_ns IS NULL THEN 'segment_start' WHEN delta_ns <= 0 THEN 'timestamp_non_increasing' WHEN delta_ns > lim THEN 'timestamp_gap'
          WHEN e <> pe THEN 'reference_frame_change' WHEN sqrt(qa * qa + qb * qb) < 1e-12 THEN 'invalid_quaternion' ELSE '' END AS continuity_start_reason FROM d JOIN m USING (k))
    SELECT k, i, continuity_start_reason, CAST(sum(CASE WHEN continuity_start_reason IN ('', 'segment_start') THEN 0 ELSE 1 END) OVER (PARTITION BY k ORDER BY i) AS BIGINT) AS continuity_group FROM r
""")
def pose_continuity(spark, sf_dir):
    q = lambda v: F.when(F.col("id") % 89 == 0, 0.0).otherwise(v)
    rows = events(spark, sf_dir).withColumns({"qa": q(0.6), "qb": q(0.8)})
    return timeline.pose_continuity(rows, ["k"], "i", "t", "e", ["qa", "qb"], HOUR).select("k", "i", "continuity_start_reason", "continuity_group")


@query(f"""
    WITH {SHIPMENTS}, n AS (SELECT k, t, count(*) AS n FROM sh GROUP BY 1, 2),
    dup AS (SELECT k, sum(n - 1)::BIGINT AS duplicate_count, count_if(n > 1)::BIGINT AS duplicated_times, sum(n)::BIGINT AS sample_count FROM n GROUP BY k),
    b AS (SELECT k, t - lag(t) OVER (PARTITION BY k ORDER BY i) AS dt FROM sh), back AS (SELECT k, count_if(dt < 0)::BIGINT AS regression_count FROM b GROUP BY k),
    u AS (SELECT k, t - lag(t) OVER (PARTITION BY k ORDER BY t) AS dt FROM (SELECT DISTINCT k, t FROM sh)), m AS (SELECT k, trunc(median(dt) FILTER (WHERE dt > 0))::BIGINT AS m FROM u GROUP BY k),
    g AS (SELECT k, max(m) AS median_interval_ns, count_if(dt > m * 3.0)::BIGINT AS gap_count, coalesce(sum(dt) FILTER (WHERE dt > m * 3.0), 0)::BIGINT AS gap_total_ns FROM u JOIN m USING (k) GROUP BY k)
    SELECT * FROM dup JOIN back USING (k) JOIN g USING (k)
""")
def clock_report(spark, sf_dir):
    return timeline.clock_report(shipments(spark, sf_dir), ["k"], "i", "t")


@query(f"""
    WITH {EVENTS}, x AS (SELECT * FROM ev WHERE e <> 'error' AND id % 7 <> 0),
    d AS (SELECT k, t - lag(t) OVER w AS gap_ns, lag(i) OVER w AS pi, i FROM x WINDOW w AS (PARTITION BY k ORDER BY i))
    SELECT k, pi AS frame_index, gap_ns, i - pi - 1 AS frames_skipped, CASE WHEN gap_ns >= {2 * DAY} THEN 'split' ELSE 'keep_with_flag' END AS decision FROM d WHERE gap_ns >= {12 * HOUR}
""")
def frame_gaps(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("method", F.when(F.col("e") == "error", "pending_alignment").otherwise("native")).withColumn("t", F.when(F.col("id") % 7 != 0, F.col("t")))
    return timeline.frame_gaps(rows, ["k"], "i", "t", "i", "method", 12 * HOUR, 2 * DAY)


@query(f"""
    WITH {EVENTS}, d AS (SELECT k, lag(i) OVER w AS packet_a, i AS packet_b, lag(t) OVER w AS start_ns, t AS end_ns, t - lag(t) OVER w AS gap_ns FROM ev WINDOW w AS (PARTITION BY k ORDER BY i))
    SELECT * FROM d WHERE gap_ns > {int(3600 * 1e9 * 2.5)} AND gap_ns / 1e9 >= 20000
""")
def audio_gaps(spark, sf_dir):
    return timeline.audio_gaps(events(spark, sf_dir), ["k"], "i", "t", 3600.0, 2.5, 20_000.0)
