"""Change points and scenes over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import robust, scene
from tessera.operators.sequence import previous
from tessera.plans.adapters import DAY, EVENTS, HOUR, events, six, table
from tessera.plans.registry import query


def _cosine(a: str, b: str) -> str:
    """SQL: 1 - cosine, each product and sum in doubles in order."""
    dot = lambda x, y: f"list_reduce(list_prepend(0::DOUBLE, list_transform(list_zip({x}, {y}), lambda p: p[1]::DOUBLE * p[2]::DOUBLE)), lambda s, v: s + v)"
    return f"least(1.0, greatest(0.0, 1 - {dot(a, b)} / (sqrt({dot(a, a)}) * sqrt({dot(b, b)}))))"


_CHANGES = f"""em AS (SELECT label AS k, vec_id AS i, embedding AS x, lag(embedding) OVER (PARTITION BY label ORDER BY vec_id) AS p FROM embeddings), ch AS (SELECT k, i, CASE WHEN p IS NULL THEN 0.0 ELSE {_cosine("x", "p")} END AS change FROM em)"""


def _changes(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select(F.col("label").alias("k"), F.col("vec_id").alias("i"), F.col("embedding").alias("x"))
    return scene.adjacent_change(rows, ["k"], "i", "x")


@query(f"WITH {_CHANGES} SELECT k, i, round_even(change, 6) AS change FROM ch")
def embedding_changes(spark, sf_dir):
    return _changes(spark, sf_dir).select("k", "i", six("change").alias("change"))


@query(f"""WITH {_CHANGES}, n AS (SELECT k, i, change, list_concat(coalesce(list(change) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING), []), coalesce(list(change) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN 1 FOLLOWING AND 30 FOLLOWING), [])) AS n FROM ch),
    m AS (SELECT *, list_sum(n) / len(n) AS m FROM n), s AS (SELECT *, sqrt(list_sum(list_transform(n, lambda v: (v - m) * (v - m))) / len(n)) AS s FROM m), z AS (SELECT k, i, CASE WHEN len(n) < 3 THEN 0.0 WHEN s > 2.220446049250313e-16 THEN (change - m) / s ELSE 0.0 END AS z FROM s)
    SELECT k, i, round_even(z, 5) AS z FROM z WHERE z > 0.5""")
def embedding_boundaries(spark, sf_dir):
    z = robust.local_z(_changes(spark, sf_dir), ["k"], "i", "change").where("z > 0.5")
    return z.select("k", "i", F.bround("z", 5).alias("z"))


@query(f"""WITH {EVENTS}, p AS (SELECT k, i, v, lag(v) OVER (PARTITION BY k ORDER BY i) AS p FROM ev) SELECT k, i, round_even(CASE WHEN p IS NULL THEN 0.0 WHEN (v <= 5) <> (p <= 5) THEN 1.0 ELSE abs(v - p) END, 6) AS score FROM p""")
def brightness_jumps(spark, sf_dir):
    return scene.brightness_jumps(events(spark, sf_dir), ["k"], "i", "v", 5.0).select("k", "i", six("score").alias("score"))


_CLUSTERS = "sum(CASE WHEN i - pi <= {g} THEN 0 ELSE 1 END) OVER (PARTITION BY k ORDER BY i)"


@query(f"""WITH {EVENTS}, c AS (SELECT k, i, v, lag(i) OVER (PARTITION BY k ORDER BY i) AS pi FROM ev WHERE e <> 'view'), g AS (SELECT *, {_CLUSTERS.format(g=2)} AS g FROM c), r AS (SELECT *, row_number() OVER (PARTITION BY k, g ORDER BY v DESC, i) AS r FROM g) SELECT k, i, v FROM r WHERE r = 1""")
def peak_select(spark, sf_dir):
    return scene.peaks(events(spark, sf_dir).where("e <> 'view'"), ["k"], "i", "v", 2).select("k", "i", "v")


WEIGHTS = {"click": 1.0, "error": 2.0, "purchase": 1.5}
_W = "CASE e WHEN 'click' THEN 1.0 WHEN 'error' THEN 2.0 ELSE 1.5 END::DOUBLE"
_SMOOTHED = """sm AS (SELECT k, i, list_sort([s, coalesce(lag(s, 1) OVER w, first_value(s) OVER f), coalesce(lag(s, 2) OVER w, first_value(s) OVER f), coalesce(lead(s, 1) OVER w, last_value(s) OVER f), coalesce(lead(s, 2) OVER w, last_value(s) OVER f)])[3] AS smoothed
    FROM sc WINDOW w AS (PARTITION BY k ORDER BY i), f AS (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"""
_FUSED = f"""{EVENTS}, sc AS (SELECT k, i, least(1.0, greatest(0.0, v / 100)) AS s, e FROM ev), {_SMOOTHED}, pp AS (SELECT sc.k, sc.i, s, e, {_W} AS w, smoothed, s > 0.9 AS h, lag(sc.i) OVER (PARTITION BY sc.k ORDER BY sc.i) AS pi FROM sc JOIN sm ON sc.k = sm.k AND sc.i = sm.i WHERE e IN ('click', 'error', 'purchase') AND s > 0.3),
    cl AS (SELECT *, {_CLUSTERS.format(g=1)} AS g FROM pp), bs AS (SELECT k, g, e, any_value(w) AS w, greatest(max(s), max(smoothed)) AS s, bool_or(h) AS h, min(i) AS a, max(i) AS z, count(*) AS n FROM cl GROUP BY 1, 2, 3),
    rp AS (SELECT k, g, i FROM (SELECT *, row_number() OVER (PARTITION BY k, g ORDER BY w * s DESC, i) AS r FROM cl) WHERE r = 1),
    fu AS (SELECT bs.k, any_value(rp.i) AS frame_index, sum(w * s) / 4.5 AS score, bool_or(h) AS is_hard_cut, array_to_string(list_sort(list(e)), ',') AS sources, min(a) AS first_frame, max(z) AS last_frame, sum(n)::BIGINT AS proposals FROM bs JOIN rp USING (k, g) GROUP BY bs.k, g)"""


def _fused(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("s", F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("v") / 100)))
    smoothed = robust.median_smooth(rows, ["k"], "i", "s").select("k", F.col("i").alias("frame_index"), F.col("e").alias("source"), "smoothed")
    chosen = rows.where(F.col("e").isin("click", "error", "purchase") & (F.col("s") > 0.3)).select("k", F.col("i").alias("frame_index"), F.col("e").alias("source"), F.col("s").alias("score"), (F.col("s") > 0.9).alias("is_hard_cut"))
    return scene.fuse(chosen, smoothed, ["k"], WEIGHTS, 1, 30.0)


@query(f"WITH {_FUSED} SELECT k, frame_index, round_even(least(1.0, greatest(0.0, score)), 6) AS score, is_hard_cut, sources, first_frame, last_frame, proposals, round_even(frame_index * 1e9 / 30.0, 0)::BIGINT AS timestamp_ns FROM fu")
def scene_fusion(spark, sf_dir):
    return _fused(spark, sf_dir).withColumns({"score": six("score"), "sources": F.array_join("sources", ",")})


@query(f"""WITH {_FUSED}, lo AS (SELECT k, i FROM sc WHERE s <= 0.2), hi AS (SELECT k, i FROM sc WHERE s >= 0.8) SELECT k, first_frame, last_frame, is_hard_cut OR EXISTS (SELECT 1 FROM lo, hi WHERE lo.k = fu.k AND hi.k = fu.k AND abs(lo.i - hi.i) <= 2 AND lo.i BETWEEN first_frame AND last_frame AND hi.i BETWEEN first_frame AND last_frame) AS is_hard_cut FROM fu""")
def joint_hard_cuts(spark, sf_dir):
    rows = events(spark, sf_dir).select("k", F.col("i").alias("frame_index"), F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("v") / 100)).alias("s"))
    return scene.joint_hard_cuts(_fused(spark, sf_dir), rows.where("s <= 0.2"), rows.where("s >= 0.8"), ["k"], 2).select("k", "first_frame", "last_frame", "is_hard_cut")


_CANDIDATES = f"{EVENTS}, cd AS (SELECT k, i AS f, t, v / 100 AS c, e = 'purchase' AS h FROM ev WHERE e <> 'click' AND t >= 0)"


def _candidates(spark, sf_dir):
    return events(spark, sf_dir).where("e <> 'click'").select("k", F.col("i").alias("frame_index"), F.col("t").alias("timestamp_ns"), (F.col("v") / 100).alias("confidence"), (F.col("e") == "purchase").alias("is_hard_cut"))


_HYSTERESIS = f"""{_CANDIDATES}, pv AS (SELECT *, lag(f) OVER (PARTITION BY k ORDER BY f) AS p FROM cd), gr AS (SELECT *, sum(CASE WHEN f - p <= 2 THEN 0 ELSE 1 END) OVER (PARTITION BY k ORDER BY f) AS g FROM pv),
    hd AS (SELECT k, g, f AS hf FROM gr WHERE h), ng AS (SELECT gr.k, gr.g, gr.f, hf, row_number() OVER (PARTITION BY gr.k, gr.f ORDER BY abs(hf - gr.f), hf) AS r FROM gr JOIN hd ON gr.k = hd.k AND gr.g = hd.g),
    bt AS (SELECT k, g, f AS bf FROM (SELECT *, row_number() OVER (PARTITION BY k, g ORDER BY c DESC, f) AS r FROM gr) WHERE r = 1),
    ta AS (SELECT gr.*, coalesce(hf, bf) AS target FROM gr LEFT JOIN (SELECT * FROM ng WHERE r = 1) x ON x.k = gr.k AND x.f = gr.f JOIN bt ON bt.k = gr.k AND bt.g = gr.g),
    hy AS (SELECT k, target AS frame_index, max(c) AS confidence, bool_or(h) AS is_hard_cut, min(t) FILTER (WHERE f = target) AS timestamp_ns FROM ta GROUP BY k, target)"""


@query(f"WITH {_HYSTERESIS} SELECT k, frame_index, round_even(confidence, 6) AS confidence, is_hard_cut, timestamp_ns FROM hy")
def hysteresis(spark, sf_dir):
    return scene.hysteresis(_candidates(spark, sf_dir), ["k"]).withColumn("confidence", six("confidence"))


def _ends(spark, sf_dir):
    return events(spark, sf_dir).groupBy("k").agg((F.min("t") - DAY).alias("start_ns"), (F.max("t") + DAY).alias("end_ns"))


_MINIMUM = f"""{_HYSTERESIS}, se AS (SELECT k, min(t) - {DAY} AS s, max(t) + {DAY} AS z FROM ev GROUP BY k),
    an AS (SELECT hy.*, s, z, coalesce(max(timestamp_ns) FILTER (WHERE is_hard_cut) OVER (PARTITION BY k ORDER BY timestamp_ns, frame_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), s) AS lo,
           coalesce(min(timestamp_ns) FILTER (WHERE is_hard_cut) OVER (PARTITION BY k ORDER BY timestamp_ns, frame_index ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), z) AS hi FROM hy JOIN se USING (k)),
    so AS (SELECT k, lo, hi, list(timestamp_ns ORDER BY timestamp_ns, frame_index) AS ts FROM an WHERE NOT is_hard_cut AND timestamp_ns > lo AND timestamp_ns < hi GROUP BY 1, 2, 3),
    gd AS (SELECT k, lo, hi, list_reduce(list_prepend([lo], list_transform(ts, lambda x: [x])), lambda a, b: CASE WHEN b[1] - a[-1] >= {12 * HOUR} THEN list_append(a, b[1]) ELSE a END) AS kept FROM so),
    kp AS (SELECT k, hi, unnest(kept[2:]) AS timestamp_ns FROM gd), ke AS (SELECT k, timestamp_ns FROM kp WHERE hi - timestamp_ns >= {12 * HOUR}),
    md AS (SELECT k, timestamp_ns, confidence FROM hy WHERE is_hard_cut UNION ALL SELECT k, timestamp_ns, confidence FROM hy WHERE NOT is_hard_cut AND (k, timestamp_ns) IN (SELECT k, timestamp_ns FROM ke))"""


def _kept(spark, sf_dir):
    found = scene.hysteresis(_candidates(spark, sf_dir), ["k"]).join(_ends(spark, sf_dir), "k")
    return scene.minimum_duration(found, ["k"], "start_ns", "end_ns", 12 * HOUR)


@query(f"WITH {_MINIMUM} SELECT k, timestamp_ns, round_even(confidence, 6) AS confidence FROM md")
def minimum_duration(spark, sf_dir):
    return _kept(spark, sf_dir).select("k", "timestamp_ns", six("confidence").alias("confidence"))


_SCENES = f"""{_MINIMUM}, al AS (SELECT k, s AS t0, NULL AS c, 0 AS o FROM se UNION ALL SELECT k, z, NULL, 2 FROM se UNION ALL SELECT k, timestamp_ns, confidence, 1 FROM md),
    ld AS (SELECT k, t0 AS start_ns, lead(t0) OVER w AS end_ns, c, lead(c) OVER w AS c2, row_number() OVER w - 1 AS place FROM al WINDOW w AS (PARTITION BY k ORDER BY t0, o)),
    scn AS (SELECT k, place, start_ns, end_ns, CASE WHEN c IS NULL AND c2 IS NULL THEN 0.0 ELSE (coalesce(c, 0.0) + coalesce(c2, 0.0)) / ((c IS NOT NULL)::INT + (c2 IS NOT NULL)::INT) END AS confidence, end_ns - start_ns < {12 * HOUR} AS short_span FROM ld WHERE end_ns IS NOT NULL)"""


@query(f"WITH {_SCENES} SELECT k, place, start_ns, end_ns, round_even(confidence, 6) AS confidence, short_span FROM scn")
def boundaries_to_scenes(spark, sf_dir):
    return scene.scenes(_kept(spark, sf_dir), _ends(spark, sf_dir), ["k"], 12 * HOUR).withColumn("confidence", six("confidence"))


@query(f"WITH {_SCENES} SELECT k, count(*) AS scenes, round_even(min(confidence), 6) AS min_confidence, round_even(avg(confidence), 4) AS mean_confidence, round_even(avg(short_span::INT), 6) AS short_ratio FROM scn GROUP BY k")
def scene_metrics(spark, sf_dir):
    m = scene.scene_metrics(scene.scenes(_kept(spark, sf_dir), _ends(spark, sf_dir), ["k"], 12 * HOUR), ["k"])
    return m.withColumns({"min_confidence": six("min_confidence"), "mean_confidence": F.bround("mean_confidence", 4), "short_ratio": six("short_ratio")})


@query(f"WITH {EVENTS}, g AS (SELECT k, unnest(range(i - 4, i + 5, 2)) AS frame_index FROM ev WHERE e = 'error'), n AS (SELECT k, count(*) AS n FROM ev GROUP BY k) SELECT DISTINCT g.k, frame_index FROM g JOIN n ON n.k = g.k WHERE frame_index >= 0 AND frame_index < n")
def sampling_grid(spark, sf_dir):
    rows = events(spark, sf_dir)
    counted = rows.where("e = 'error'").join(rows.groupBy("k").agg(F.count(F.lit(1)).alias("frames")), "k")
    return scene.sampling_grid(counted, ["k"], "i", 4, 2, "frames")


@query(f"""WITH h AS (SELECT user_id AS k, list(n ORDER BY e) AS h FROM (SELECT u.user_id, t.e, count(x.event_id)::DOUBLE AS n FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN (SELECT DISTINCT event_type AS e FROM events) t LEFT JOIN events x ON x.user_id = u.user_id AND x.event_type = t.e GROUP BY 1, 2) GROUP BY 1),
    p AS (SELECT k, h AS b, lag(h) OVER (ORDER BY k) AS a FROM h) SELECT k, round_even(sqrt(greatest(0.0, 1 - list_sum(list_transform(list_zip(a, b), lambda x: sqrt(x[1] * x[2]))) / sqrt(list_sum(a) * list_sum(b)))), 5) AS distance FROM p WHERE a IS NOT NULL""")
def histogram_distance(spark, sf_dir):
    counts = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("k"), "event_type").agg(F.count(F.lit(1)).cast("double").alias("n"))
    h = counts.groupBy("k").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("h"))
    # all users are one sequence: it is cut into stretches of 1000 ids
    p = previous(h, [], "k", ["h"], 1000).where("prev_h is not null")
    return p.select("k", F.bround(scene.sparse_histogram_distance("prev_h", "h"), 5).alias("distance"))
