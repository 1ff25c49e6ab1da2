"""Frame statistics, tracks and counts over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import frames
from tessera.plans.adapters import DAY, EVENTS, HOUR, SHIPMENTS, events, shipments, six, table
from tessera.plans.registry import query

_FRAMES = "fr AS (SELECT vec_id AS i, label AS k, list_transform(embedding, lambda x: CASE WHEN vec_id % 5 = 0 THEN 0 ELSE greatest(0, floor(x * 20))::INT END) AS px FROM embeddings)"


def _frames(spark, sf_dir):
    px = F.transform("embedding", lambda x: F.when(F.col("vec_id") % 5 == 0, 0).otherwise(F.greatest(F.lit(0), F.floor(x * 20)).cast("int")))
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("i"), F.col("label").alias("k"), px.alias("px"))


_STATS = f"""{_FRAMES}, g AS (SELECT i, k, px, list_filter(px, lambda x: x <> 0 AND x <> 3) AS g FROM fr), m AS (SELECT *, CASE WHEN len(g) > 0 THEN list_sum(g) / len(g)::DOUBLE ELSE 0.0 END AS m FROM g),
    st AS (SELECT i, k, len(px)::BIGINT AS pixels, round_even(len(list_filter(px, lambda x: x = 0)) / len(px)::DOUBLE, 6) AS zero_ratio, round_even((len(px) - len(g)) / len(px)::DOUBLE, 6) AS invalid_ratio, round_even(len(g) / len(px)::DOUBLE, 6) AS valid_ratio,
    len(list_filter(px, lambda x: x = 0)) = len(px) AS all_zero, round_even(m, 2) AS mean, CASE WHEN len(g) > 0 THEN round_even(sqrt(list_sum(list_transform(g, lambda x: (x - m) * (x - m))) / len(g)), 2) ELSE 0.0 END AS std,
    coalesce(list_min(g), 0)::BIGINT AS min, coalesce(list_max(g), 0)::BIGINT AS max FROM m)"""


@query(f"WITH {_STATS} SELECT * FROM st")
def depth_frames(spark, sf_dir):
    return frames.depth_stats(_frames(spark, sf_dir), ["i", "k"], "px", 3)


@query(f"""WITH {_STATS}, r AS (SELECT k, count(*) AS frames, count_if(all_zero)::BIGINT AS z, 1 - sum(trunc(invalid_ratio * pixels)::BIGINT) / sum(pixels)::DOUBLE AS v FROM st GROUP BY k)
    SELECT k, frames, z AS all_zero_frames, round_even(z / frames::DOUBLE, 4) AS all_zero_ratio, round_even(v, 4) AS valid_ratio, CASE WHEN z / frames::DOUBLE > 0.5 THEN 'fatal' WHEN z > 0 OR v < 0.5 THEN 'warn' ELSE 'pass' END AS severity FROM r""")
def depth_sequences(spark, sf_dir):
    return frames.depth_roll_up(frames.depth_stats(_frames(spark, sf_dir), ["i", "k"], "px", 3), ["k"])


@query(f"""WITH {EVENTS}, x AS (SELECT k, i, e, CASE WHEN e = lag(e) OVER (PARTITION BY k ORDER BY i) THEN 0 ELSE 1 END AS s FROM ev), g AS (SELECT *, sum(s) OVER (PARTITION BY k ORDER BY i) AS g FROM x) SELECT k, min(i) AS first, max(i) AS last, count(*) AS rows FROM g GROUP BY k, g HAVING count(*) >= 3""")
def frozen_frames(spark, sf_dir):
    return frames.frozen_frames(events(spark, sf_dir), ["k"], "i", "e")


@query("""WITH c AS (SELECT o_custkey AS k, count(*) AS a, CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE count(*) + o_custkey % 9 END AS b, max(o_orderkey) % 40 AS d FROM orders GROUP BY 1), l AS (SELECT k, 0 AS i, 'a' AS s, a AS n FROM c UNION ALL SELECT k, 1, 'b', b FROM c UNION ALL SELECT k, 2, 'd', d FROM c)
    SELECT x.k, x.s AS source_a, y.s AS source_b, abs(x.n - y.n) AS difference, CASE WHEN abs(x.n - y.n) <= 5 THEN 'warning' ELSE 'error' END AS severity FROM l x JOIN l y ON x.k = y.k AND x.i < y.i AND x.n <> y.n""")
def frame_count_mismatch(spark, sf_dir):
    c = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("a"), F.max("o_orderkey").alias("m"))
    rows = c.select("k", "a", F.when(F.col("k") % 3 != 0, F.col("a") + F.col("k") % 9).alias("b"), (F.col("m") % 40).alias("d"))
    return frames.count_mismatches(rows, ["k"], ["a", "b", "d"])


@query(f"""WITH {EVENTS}, sp AS (SELECT k, min(t) + {DAY} AS low, min(t) + {12 * DAY} AS high FROM ev GROUP BY k), iss AS (SELECT k, i, t - {HOUR} AS start_ns, t + {HOUR} AS end_ns FROM ev WHERE e = 'error') SELECT k, i FROM iss JOIN sp USING (k) WHERE start_ns >= low AND end_ns <= high""")
def contained_issues(spark, sf_dir):
    rows = events(spark, sf_dir)
    spans = rows.groupBy("k").agg((F.min("t") + DAY).alias("low"), (F.min("t") + 12 * DAY).alias("high"))
    issues = rows.where("e = 'error'").select("k", "i", (F.col("t") - HOUR).alias("start_ns"), (F.col("t") + HOUR).alias("end_ns"))
    return frames.contained(issues, spans, ["k"]).select("k", "i")


@query(f"""WITH {SHIPMENTS}, a AS (SELECT k, avg(p) FILTER (WHERE NOT isnan(p)) AS a FROM sh WHERE i % 2 = 0 GROUP BY k), b AS (SELECT k, avg(p) FILTER (WHERE NOT isnan(p)) AS b FROM sh WHERE i % 2 = 1 GROUP BY k)
    SELECT coalesce(a.k, b.k) AS k, round_even(a, 3) AS mean_a, round_even(b, 3) AS mean_b, round_even(abs(a - b), 3) AS difference, coalesce(abs(a - b) <= 2000, false) AS close FROM a FULL JOIN b ON a.k = b.k""")
def compare_means(spark, sf_dir):
    rows = shipments(spark, sf_dir)
    out = frames.compare_means(rows.where("i % 2 = 0"), rows.where("i % 2 = 1"), ["k"], "p", 2000)
    return out.withColumns({c: F.bround(c, 3) for c in ("mean_a", "mean_b", "difference")})


@query(f"WITH {EVENTS} SELECT k, i, last_value(CASE WHEN id % 3 = 0 THEN v END IGNORE NULLS) OVER (PARTITION BY k ORDER BY i) AS v FROM ev")
def forward_fill(spark, sf_dir):
    return frames.forward_filled(events(spark, sf_dir).withColumn("v", F.when(F.col("id") % 3 == 0, F.col("v"))), ["k"], "i", ["v"]).select("k", "i", "v")


@query(f"""WITH {EVENTS}, p AS (SELECT k, i, v AS x, v * 0.5 AS y FROM ev WHERE id % 6 <> 0), w AS (SELECT *, i - lag(i, 3) OVER o AS d3, i - lag(i, 1) OVER o AS d1, x - 3 * lag(x, 1) OVER o + 3 * lag(x, 2) OVER o - lag(x, 3) OVER o AS jx, y - 3 * lag(y, 1) OVER o + 3 * lag(y, 2) OVER o - lag(y, 3) OVER o AS jy,
    x - lag(x) OVER o AS sx, y - lag(y) OVER o AS sy FROM p WINDOW o AS (PARTITION BY k ORDER BY i)), g AS (SELECT k, median(CASE WHEN d3 = 3 THEN sqrt(jx * jx + jy * jy) * 1.0 / 100 END) AS j, max(CASE WHEN d1 = 1 THEN sqrt(sx * sx + sy * sy) * 1.0 / 100 END) AS s FROM w GROUP BY k)
    SELECT k, round_even(j, 6) AS jerk, round_even(s, 6) AS max_speed, round_even(exp(-j / 2.0), 6) AS smoothness FROM g""")
def motion_smoothness(spark, sf_dir):
    rows = events(spark, sf_dir).where("id % 6 <> 0").select("k", "i", F.col("v").alias("x"), (F.col("v") * 0.5).alias("y"))
    out = frames.motion(rows, ["k"], "i", "x", "y", 1.0, 100.0, 2.0)
    return out.select("k", *(six(c).alias(c) for c in ("jerk", "max_speed", "smoothness")))


@query(f"WITH {EVENTS} SELECT k, round_even(count(DISTINCT CASE WHEN e = 'click' THEN i END) / count(*)::DOUBLE, 6) AS presence FROM ev GROUP BY k")
def presence_ratio(spark, sf_dir):
    rows = events(spark, sf_dir)
    return frames.presence_ratio(rows.where("e = 'click'"), ["k"], "i", rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")), "n").withColumn("presence", six("presence"))


@query()
def matched_tracks(spark, sf_dir):
    x = F.col("v")
    rows = events(spark, sf_dir).select("k", F.floor(F.col("i") / 2).alias("f"), x.alias("x1"), x.alias("y1"), (x + 40).alias("x2"), (x + 40).alias("y2"))
    return frames.match_tracks(rows, "k", "f", ["x1", "y1", "x2", "y2"])
