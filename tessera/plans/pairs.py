"""Pairing in time and by place over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import asof
from tessera.operators.annotate import positions, sample_offsets
from tessera.operators.sequence import previous
from tessera.plans.adapters import DAY, EVENTS, HOUR, events, six, table
from tessera.plans.registry import query


def _nearest(left: str, right: str, lt: str = "t", tie: str = "earlier") -> str:
    """Brute force over all pairs of a key: the nearest right time, the tie rule, then the smallest right place."""
    order = f"abs(r.t - l.{lt}), r.t, r.i" if tie == "earlier" else f"abs(r.t - l.{lt}), r.t DESC, r.i"
    return f"""(SELECT * FROM (SELECT l.*, r.t AS mt, r.i AS mi, row_number() OVER (PARTITION BY l.k, l.i ORDER BY {order}) AS rn FROM {left} l LEFT JOIN {right} r ON l.k = r.k) WHERE rn = 1)"""


CLICKS = f"{EVENTS}, cl AS (SELECT * FROM ev WHERE e = 'click'), vi AS (SELECT * FROM ev WHERE e = 'view'), nn AS (SELECT *, mt - t AS off FROM {_nearest('cl', 'vi')}), pr AS (SELECT *, coalesce(abs(off) <= {12 * HOUR}, false) AS paired FROM nn)"


def _in_ms(df, columns, places=2):
    """Percentiles are interpolated in doubles, whose last bits differ between engines at this size; compare milliseconds."""
    return df.withColumns({c: F.bround(F.col(c) / 1e6, places) for c in columns}).withColumnsRenamed({c: c.replace("_ns", "_ms") for c in columns})


def _sides(spark, sf_dir):
    rows = events(spark, sf_dir)
    return rows.where("e = 'click'"), rows.where("e = 'view'")


@query(f"WITH {CLICKS} SELECT k, i, t, mi AS match_index, mt AS match_ts, off AS offset_ns, paired FROM pr")
def nearest_pairing(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    return asof.pairing(left, right, ["k"], "t", "i", 12 * HOUR).select("k", "i", "t", "match_index", "match_ts", "offset_ns", "paired")


@query(f"""WITH {CLICKS}, a AS (SELECT k, count_if(paired)::BIGINT AS paired_count, count(*) AS left_count, quantile_cont(abs(off), 0.5) FILTER (WHERE paired) AS p50, quantile_cont(abs(off), 0.95) FILTER (WHERE paired) AS p95, max(abs(off)) FILTER (WHERE paired) AS offset_max FROM pr GROUP BY k),
    b AS (SELECT k, count(*) AS n FROM vi GROUP BY k) SELECT k, paired_count, left_count, round_even(p50, 0) AS offset_p50, round_even(p95, 0) AS offset_p95, offset_max, coalesce(n, 0) AS right_count,
    round_even(least(1.0, paired_count / greatest(least(left_count, coalesce(n, 0)), 1)::DOUBLE), 6) AS paired_ratio FROM a LEFT JOIN b USING (k)""")
def pairing_summary(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    out = asof.pairing_summary(asof.pairing(left, right, ["k"], "t", "i", 12 * HOUR), right, ["k"])
    return out.withColumns({"offset_p50": F.bround("offset_p50", 0), "offset_p95": F.bround("offset_p95", 0), "paired_ratio": six("paired_ratio")})


@query(f"""WITH {CLICKS}, p AS (SELECT k, row_number() OVER (PARTITION BY k ORDER BY i) AS n, paired FROM pr), u AS (SELECT k, n, n - row_number() OVER (PARTITION BY k ORDER BY n) AS g FROM p WHERE NOT paired)
    SELECT k, min(n) AS first_index, max(n) AS last_index FROM u GROUP BY k, g""")
def unpaired_spans(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    placed = asof.pairing(left, right, ["k"], "t", "i", 12 * HOUR).withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("i")).cast("bigint"))
    return asof.unpaired_spans(placed, ["k"], "n")


_GRID = f"""{EVENTS}, sp AS (SELECT k, min(t) + {DAY} AS s, min(t) + {11 * DAY} AS z FROM ev GROUP BY k), fr AS (SELECT ev.k, i, t FROM ev JOIN sp USING (k) WHERE t >= s AND t <= z),
    gr AS (SELECT k, unnest(range(0, (CASE WHEN {{n}} > 0 THEN {{n}} ELSE 0 END)::BIGINT)) AS i, s FROM sp), gt AS (SELECT k, i, i * {6 * HOUR} AS o, s + i * {6 * HOUR} AS tt FROM gr)
    SELECT k, i AS output_frame_index, o AS output_timestamp_ns, mi AS source_frame_index, mt AS source_timestamp_ns, 'nearest' AS mapping_method, mt - tt AS time_error_ns FROM {_nearest("gt", "fr", "tt")} WHERE mt IS NOT NULL"""
_FPS = 1e9 / (6 * HOUR)


def _spans(rows):
    return rows.groupBy("k").agg((F.min("t") + DAY).alias("s"), (F.min("t") + 11 * DAY).alias("z"))


@query("WITH " + _GRID.format(n=f"ceil((z - s) / {6 * HOUR}::DOUBLE)"))
def cfr_sample_map(spark, sf_dir):
    rows = events(spark, sf_dir)
    return asof.sample_map(rows, _spans(rows), ["k"], "t", "i", "s", "z", _FPS)


@query("WITH " + _GRID.format(n=f"greatest(1, floor((z - s) / {6 * HOUR}::DOUBLE))"))
def image_sample_map(spark, sf_dir):
    rows = events(spark, sf_dir)
    return asof.sample_map(rows, _spans(rows), ["k"], "t", "i", "s", "z", _FPS, image=True)


_ROBOTS = f"""{EVENTS}, r0 AS (SELECT k // 2 AS k, i, t, i // 8 AS g FROM ev WHERE k % 2 = 0), r1 AS (SELECT k // 2 AS k, i, t, i // 8 AS g FROM ev WHERE k % 2 = 1),
    b0 AS (SELECT k, g, min(t) AS a, max(t) AS z FROM r0 GROUP BY 1, 2), b1 AS (SELECT k, g, min(t) AS a, max(t) AS z FROM r1 GROUP BY 1, 2),
    me AS (SELECT b0.k, b0.g AS g0, b1.g AS g1 FROM b0 JOIN b1 ON b0.k = b1.k AND greatest(b0.a, b1.a) <= least(b0.z, b1.z)),
    ca AS (SELECT r0.k, r0.i, r0.t, r0.g, r1.i AS ri, r1.t AS rt, r1.g AS rg, row_number() OVER (PARTITION BY r0.k, r0.i ORDER BY abs(r1.t - r0.t) NULLS LAST, r1.i) AS rn
           FROM r0 LEFT JOIN me ON me.k = r0.k AND me.g0 = r0.g LEFT JOIN r1 ON r1.k = me.k AND r1.g = me.g1),
    al AS (SELECT k, i AS left_index, t AS left_ts, g AS left_group, CASE WHEN abs(rt - t) <= {12 * HOUR} THEN ri END AS right_index, CASE WHEN abs(rt - t) <= {12 * HOUR} THEN rt END AS right_ts, CASE WHEN abs(rt - t) <= {12 * HOUR} THEN rg END AS right_group,
           CASE WHEN abs(rt - t) <= {12 * HOUR} THEN rt - t END AS residual_ns, CASE WHEN coalesce(abs(rt - t) <= {12 * HOUR}, false) THEN 'inferred' ELSE 'unavailable' END AS mapping_method, {12 * HOUR}::BIGINT AS uncertainty_ns FROM ca WHERE rn = 1)"""


def _robots(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("g", F.floor(F.col("i") / 8))
    side = lambda n: rows.where(F.col("k") % 2 == n).withColumn("k", F.floor(F.col("k") / 2)).select("k", "i", "t", "g")
    return side(0), side(1)


@query(f"WITH {_ROBOTS} SELECT * FROM al")
def dual_alignment(spark, sf_dir):
    return asof.dual_alignment(*_robots(spark, sf_dir), ["k"], "t", "i", "g", 12 * HOUR)


@query(f"""WITH {_ROBOTS} SELECT k, count(*) AS left_count, count(residual_ns) AS mapped_count, round_even(count(residual_ns) / count(*)::DOUBLE, 6) AS mapped_ratio, round_even(trunc(quantile_cont(abs(residual_ns), 0.5)) / 1e6, 2) AS residual_p50_ms,
    round_even(trunc(quantile_cont(abs(residual_ns), 0.95)) / 1e6, 2) AS residual_p95_ms, max(abs(residual_ns)) AS residual_max_ns FROM al GROUP BY k""")
def dual_summary(spark, sf_dir):
    out = asof.dual_summary(asof.dual_alignment(*_robots(spark, sf_dir), ["k"], "t", "i", "g", 12 * HOUR), ["k"])
    return _in_ms(out, ["residual_p50_ns", "residual_p95_ns"])


_CAMERA = f"{EVENTS}, ca AS (SELECT k, i, CASE WHEN id % 13 = 0 THEN NULL ELSE t - t % {HOUR} END AS t FROM ev WHERE e = 'purchase'), ro AS (SELECT k, i, t - t % {HOUR} AS t FROM ev WHERE e <> 'purchase'), cn AS (SELECT * FROM {_nearest('ca', 'ro', tie='later')})"


def _camera(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("t", F.col("t") - F.col("t") % HOUR)
    cameras = rows.where("e = 'purchase'").withColumn("t", F.when(F.col("id") % 13 != 0, F.col("t"))).select("k", "i", "t")
    return asof.camera_rows(cameras, rows.where("e <> 'purchase'").withColumnsRenamed({"t": "rt", "i": "ri"}), ["k"], "t", "rt", "ri")


@query(f"WITH {_CAMERA} SELECT k, i, t, CASE WHEN t IS NULL THEN NULL ELSE mt END AS row_timestamp_ns, CASE WHEN t IS NULL THEN NULL ELSE abs(mt - t) END AS alignment_error_ns, CASE WHEN t IS NULL OR mt IS NULL THEN 'unavailable' ELSE 'nearest_row' END AS mapping_method FROM cn")
def camera_rows(spark, sf_dir):
    return _camera(spark, sf_dir).select("k", "i", "t", "row_timestamp_ns", "alignment_error_ns", "mapping_method")


@query(f"""WITH {_CAMERA}, er AS (SELECT k, i, CASE WHEN t IS NULL THEN NULL ELSE abs(mt - t) END AS x FROM cn)
    SELECT k, round_even(avg(x) / 1e6, 2) AS mean_error, max(x) AS max_error, round_even(quantile_cont(x, 0.95) / 1e6, 2) AS p95_error, round_even(quantile_cont(x, 0.99) / 1e6, 2) AS p99_error, arg_max(i, (x, -i)) FILTER (WHERE x IS NOT NULL) AS worst_index, count_if(x IS NULL)::BIGINT AS unavailable FROM er GROUP BY k""")
def alignment_errors(spark, sf_dir):
    out = asof.error_profile(_camera(spark, sf_dir), ["k"], "alignment_error_ns", "i")
    worst = F.when(F.col("max_error").isNotNull(), F.col("worst_index"))
    return _in_ms(out, ["mean_error", "p95_error", "p99_error"]).withColumn("worst_index", worst)


@query(f"""WITH {CLICKS} SELECT k, count(off) AS count, round_even(avg(off) / 1e6, 0) AS mean_ms, round_even(median(off) / 1e6, 0) AS median_ms, round_even(quantile_cont(abs(off), 0.95) / 1e6, 0) AS p95_ms, round_even(quantile_cont(abs(off), 0.99) / 1e6, 0) AS p99_ms, max(abs(off)) AS max_abs_ns FROM nn WHERE off IS NOT NULL GROUP BY k""")
def action_state_delay(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    return _in_ms(asof.delay_profile(asof.nearest(left, right, ["k"], "t", "t", "i"), ["k"]), ["mean_ns", "median_ns", "p95_ns", "p99_ns"], 0)


@query("""SELECT o.l_orderkey AS k, o.l_linenumber AS i, o.l_partkey AS part, p.l_quantity AS quantity, CASE WHEN p.l_orderkey IS NULL THEN 'unavailable' ELSE 'index' END AS mapping_method
    FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem) o LEFT JOIN (SELECT l_orderkey, l_linenumber + 1 AS n, max(l_quantity) AS l_quantity FROM lineitem GROUP BY 1, 2) p ON o.l_orderkey = p.l_orderkey AND o.l_linenumber = p.n""")
def positional_join(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    left = lines.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("i"), F.col("l_partkey").alias("part")).distinct()
    right = lines.groupBy(F.col("l_orderkey").alias("k"), (F.col("l_linenumber") + 1).alias("n")).agg(F.max("l_quantity").alias("quantity"))
    return asof.positional(left, right, ["k"], "i", "n", ["quantity"])


@query("""WITH p AS (SELECT l_orderkey AS k, l_linenumber AS i, l_partkey AS part, l_returnflag AS f FROM lineitem), n AS (SELECT k, f, i, part, row_number() OVER (PARTITION BY k, f ORDER BY i, part) - 1 AS position FROM p)
    SELECT k, f, i, part, position FROM n WHERE i >= 3""")
def depth_map(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_returnflag").alias("f"), F.col("l_linenumber").alias("i"), F.col("l_partkey").alias("part"))
    return positions(lines.withColumn("o", F.struct("i", "part")), ["k"], "o", ["f"]).drop("o").where("i >= 3")


@query(f"WITH {EVENTS} SELECT k, i, i AS packet_index, (i * 960)::BIGINT AS sample_offset FROM ev")
def audio_offsets(spark, sf_dir):
    return sample_offsets(events(spark, sf_dir), ["k"], "i").select("k", "i", "packet_index", "sample_offset")


_XC = f"""{EVENTS}, a0 AS (SELECT k // 2 AS k, i, v FROM ev WHERE k % 2 = 0), b0 AS (SELECT k // 2 AS k, i, v FROM ev WHERE k % 2 = 1),
    n AS (SELECT k, least(least(any_value(x), any_value(y)), 500) AS n FROM (SELECT k, count(*) AS x FROM a0 GROUP BY k) JOIN (SELECT k, count(*) AS y FROM b0 GROUP BY k) USING (k) GROUP BY k),
    a AS (SELECT k, i, v - avg(v) OVER (PARTITION BY k) AS v FROM a0 JOIN n USING (k) WHERE i < n), b AS (SELECT k, i, v - avg(v) OVER (PARTITION BY k) AS v FROM b0 JOIN n USING (k) WHERE i < n),
    s AS (SELECT a.k, a.i - b.i AS lag, sum(a.v * b.v) AS s FROM a JOIN b ON a.k = b.k AND abs(a.i - b.i) <= 20 GROUP BY 1, 2)
    SELECT k, arg_max(lag, (round_even(abs(s), 6), -lag)) AS lag_samples, round_even(arg_max(s, (round_even(abs(s), 6), -lag)), 4) AS correlation_peak FROM s GROUP BY k"""


@query("WITH " + _XC)
def state_action_lag(spark, sf_dir):
    rows = events(spark, sf_dir)
    side = lambda n: rows.where(F.col("k") % 2 == n).withColumn("k", F.floor(F.col("k") / 2)).select("k", "i", "v")
    return asof.cross_correlation(side(0), side(1), ["k"], "i", "v", 20).withColumn("correlation_peak", F.bround("correlation_peak", 4))


@query(f"""WITH {EVENTS}, d AS (SELECT k, i, abs(v - lag(v) OVER w) > 20 AS c FROM ev WINDOW w AS (PARTITION BY k ORDER BY i)), a AS (SELECT k // 2 AS k, i, c FROM d WHERE k % 2 = 0), b AS (SELECT k // 2 AS k, i, c FROM d WHERE k % 2 = 1)
    SELECT a.k, count_if(a.c)::BIGINT AS command_count, count_if(b.c)::BIGINT AS response_count, count_if(a.c AND NOT b.c)::BIGINT AS stall_count FROM a JOIN b ON a.k = b.k AND a.i = b.i GROUP BY a.k""")
def gripper_response(spark, sf_dir):
    moved = previous(events(spark, sf_dir), ["k"], "i", ["v"]).withColumn("c", F.abs(F.col("v") - F.col("prev_v")) > 20)
    side = lambda n, c: moved.where(F.col("k") % 2 == n).select(F.floor(F.col("k") / 2).alias("k"), "i", F.col("c").alias(c))
    j = side(0, "a").join(side(1, "b"), ["k", "i"])
    return j.groupBy("k").agg(F.count_if("a").alias("command_count"), F.count_if("b").alias("response_count"), F.count_if(F.col("a") & ~F.col("b")).alias("stall_count"))


@query(f"WITH {EVENTS}, s AS (SELECT DISTINCT k, e, CASE WHEN e = 'click' THEN 'robot_action_' || k ELSE 'robot_state_' || k END AS stream FROM ev WHERE e IN ('click', 'view')) SELECT a.stream AS action_stream, b.stream AS state_stream FROM s a LEFT JOIN s b ON b.e = 'view' AND b.stream = replace(a.stream, 'action', 'state') WHERE a.e = 'click'")
def action_state_streams(spark, sf_dir):
    rows = events(spark, sf_dir).select("k", "e").distinct()
    actions = rows.where("e = 'click'").select(F.concat(F.lit("robot_action_"), F.col("k").cast("string")).alias("action_stream")).withColumn("state_stream", F.replace(F.col("action_stream"), F.lit("action"), F.lit("state")))
    states = rows.where("e = 'view'").select(F.concat(F.lit("robot_state_"), F.col("k").cast("string")).alias("state_stream"), F.lit(True).alias("there"))
    return actions.join(states, "state_stream", "left").select("action_stream", F.when(F.col("there"), F.col("state_stream")).alias("state_stream"))


