"""Flows from raw streams to segments and scenes, and what stands between them, over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import annotate, frames, intervals, quality, scene
from tessera.operators.sequence import true_runs
from tessera.plans.adapters import EVENTS, HOUR, events, six, table
from tessera.plans.registry import query
from tessera.plans.scenes import _SCENES, _ends, _kept
from tessera.plans.spans import _BAD, PLAN, _bad, _subtracted, plan_rows

_ALIKE = """si AS (SELECT k, i, 1 - abs(v - lag(v) OVER w) / 100 AS s, 1 - abs(v - lag(v, 5) OVER w) / 100 AS l FROM ev WINDOW w AS (PARTITION BY k ORDER BY i)), s1 AS (SELECT k, i, coalesce(s, 1.0) AS s, l FROM si)"""


@query(f"""WITH {EVENTS}, {_ALIKE}, tr AS (SELECT *, count(*) FILTER (WHERE s < 0.999) OVER t AS c, min(s) OVER t AS m FROM s1 WINDOW t AS (PARTITION BY k ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)),
    gr AS (SELECT k, i - 2 AS i, least(1.0, greatest(0.0, 1 - l)) AS g FROM tr WHERE i >= 5 AND l <= 0.6 AND c >= 3 AND m > 0.2),
    ca AS (SELECT s1.k, s1.i, greatest(least(1.0, greatest(0.0, 1 - s)), coalesce(g, 0.0)) AS score FROM s1 LEFT JOIN gr ON gr.k = s1.k AND gr.i = s1.i WHERE g IS NOT NULL OR (s1.i > 0 AND s <= 0.2)),
    cl AS (SELECT *, sum(CASE WHEN i - p <= 3 THEN 0 ELSE 1 END) OVER (PARTITION BY k ORDER BY i) AS q FROM (SELECT *, lag(i) OVER (PARTITION BY k ORDER BY i) AS p FROM ca)),
    rk AS (SELECT *, row_number() OVER (PARTITION BY k, q ORDER BY score DESC, i) AS r FROM cl) SELECT k, i, round_even(score, 6) AS score FROM rk WHERE r = 1""")
def structural_cuts(spark, sf_dir):
    w = Window.partitionBy("k").orderBy("i")
    alike = lambda n: 1 - F.abs(F.col("v") - F.lag("v", n).over(w)) / 100
    rows = events(spark, sf_dir).select("k", "i", F.coalesce(alike(1), F.lit(1.0)).alias("similarity"), alike(5).alias("lag_similarity"))
    return scene.structural_cuts(rows, ["k"], "i", 0.2, 0.6, 3, 5).withColumn("score", six("score"))


_PIXELS = "fr AS (SELECT vec_id AS i, label AS k, list_transform(embedding, lambda x: least(255, greatest(0, floor(x::DOUBLE * 40 + 128)))::INT) AS px FROM embeddings)"
_METRICS = f"""{_PIXELS}, la AS (SELECT i, k, px, list_sort(px) AS s, list_transform(range(64), lambda j: px[(CASE WHEN j // 8 = 0 THEN 1 ELSE j // 8 - 1 END) * 8 + j % 8 + 1] + px[(CASE WHEN j // 8 = 7 THEN 6 ELSE j // 8 + 1 END) * 8 + j % 8 + 1]
        + px[(j // 8) * 8 + (CASE WHEN j % 8 = 0 THEN 1 ELSE j % 8 - 1 END) + 1] + px[(j // 8) * 8 + (CASE WHEN j % 8 = 7 THEN 6 ELSE j % 8 + 1 END) + 1] - 4 * px[j + 1]) AS d FROM fr),
    fm AS (SELECT i, k, list_sum(px) / 64.0::DOUBLE AS gray_mean, s[60] + 0.85 * (s[61] - s[60]) AS p95, s[63] + 0.37 * (s[64] - s[63]) AS p99, len(list_filter(px, lambda x: x >= 250)) / 64.0::DOUBLE AS saturated_ratio,
        list_sum(list_transform(d, lambda x: (x - list_sum(d) / 64.0::DOUBLE) * (x - list_sum(d) / 64.0::DOUBLE))) / 64.0::DOUBLE AS sharpness FROM la)"""


def _raw(spark, sf_dir):
    px = F.transform("embedding", lambda x: F.least(F.lit(255), F.greatest(F.lit(0), F.floor(x.cast("double") * 40 + 128))).cast("int"))
    raw = F.unhex(F.array_join(F.transform(px, lambda x: F.lpad(F.hex(x), 2, "0")), ""))
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("i"), F.col("label").alias("k"), raw.alias("content"), F.lit(8).alias("height"), F.lit(8).alias("width"))


def _metrics(spark, sf_dir):
    return frames.frame_metrics(_raw(spark, sf_dir), ["i", "k"], "content", "height", "width", 1)


@query(f"""WITH {_METRICS} SELECT i, round_even(gray_mean, 6) AS gray_mean, round_even(p95::DOUBLE, 6) AS p95, round_even(p99::DOUBLE, 6) AS p99, round_even(saturated_ratio, 6) AS saturated_ratio, round_even(sharpness, 4) AS sharpness,
    gray_mean >= 240 OR saturated_ratio >= 0.3 OR p95 >= 250 OR p99 >= 254 AS too_bright FROM fm""")
def frame_metrics(spark, sf_dir):
    out = _metrics(spark, sf_dir).withColumn("too_bright", frames.overexposed())
    return out.select("i", *(six(c).alias(c) for c in ("gray_mean", "p95", "p99", "saturated_ratio")), F.bround("sharpness", 4).alias("sharpness"), "too_bright")


def _run_spans(flag: str) -> str:
    return f"""fl AS (SELECT k, i, {flag} AS f FROM fm), nu AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY i) AS n, sum(f::INT) OVER (PARTITION BY k ORDER BY i) AS c FROM fl)
    SELECT k, min(i) AS first, max(i) AS last, count(*) AS rows FROM nu WHERE f GROUP BY k, n - c HAVING count(*) >= 2"""


def _flag_spans(rows, flag: str):
    marked = true_runs(rows, ["k"], "i", flag)
    return marked.groupBy("k", "run_id").agg(F.min("i").alias("first"), F.max("i").alias("last"), F.count(F.lit(1)).alias("rows")).where("rows >= 2").drop("run_id")


@query(f"WITH {_METRICS}, {_run_spans('sharpness < 2500')}")
def blur_spans(spark, sf_dir):
    rows = _metrics(spark, sf_dir).withColumns({"width": F.lit(8), "height": F.lit(8)})
    return _flag_spans(rows.withColumn("flag", frames.blurred(limits={(8, 8): 2500.0})), "flag")


@query(f"WITH {_METRICS}, {_run_spans('gray_mean >= 127.5 OR saturated_ratio >= 0.3 OR p95 >= 250 OR p99 >= 254')}")
def overexposure_spans(spark, sf_dir):
    return _flag_spans(_metrics(spark, sf_dir).withColumn("flag", frames.overexposed(limit=127.5)), "flag")


@query()
def video_hashes(spark, sf_dir):
    return frames.video_hashes(_raw(spark, sf_dir), ["k"], "i", "content", "height", "width").withColumn("share", six("share"))


@query(f"""WITH {EVENTS}, x AS (SELECT k, i, t, v < 70 AS f FROM ev), c AS (SELECT k, min(i) FILTER (WHERE NOT f) AS c, arg_min(t, i) AS a, arg_max(t, i) AS z, count(*) AS n FROM x GROUP BY k),
    g AS (SELECT c.k, any_value(a) AS a, any_value(c.z) AS z, any_value(n) AS n, count_if(i < c)::BIGINT AS b, max(t) FILTER (WHERE i < c) AS bz, min(t) FILTER (WHERE i = c) AS nx FROM c JOIN x USING (k) GROUP BY c.k),
    hd AS (SELECT k, a, z, n, greatest(a, CASE WHEN b > 0 AND (bz - a >= {48 * HOUR} OR b >= 3) THEN nx ELSE a END) AS s FROM g),
    ga AS (SELECT ev.k, ev.id % 983 AS si, floor(ev.id % 983 / 983.0::DOUBLE * n)::BIGINT AS at FROM ev JOIN hd ON hd.k = ev.k WHERE e = 'error' AND v / 100 > 3.0 * 0.02),
    ta AS (SELECT k, t FROM (SELECT ga.k, ev.t, row_number() OVER (PARTITION BY ga.k ORDER BY si DESC) AS r FROM ga JOIN hd ON hd.k = ga.k JOIN ev ON ev.k = ga.k AND ev.i = ga.at WHERE ga.at > 0 AND ga.at < n - 10) WHERE r = 1),
    sp AS (SELECT hd.k, s AS start_ns, greatest(s + 1000000000, coalesce(ta.t, z)) AS end_ns FROM hd LEFT JOIN ta ON ta.k = hd.k)
    SELECT sp.k, start_ns, end_ns, count_if(t >= start_ns AND t <= end_ns)::BIGINT AS frames, count_if(t < start_ns)::BIGINT AS head_frames, count_if(t > end_ns)::BIGINT AS tail_frames FROM sp JOIN ev ON ev.k = sp.k GROUP BY 1, 2, 3""")
def legacy_span(spark, sf_dir):
    rows = events(spark, sf_dir)
    head = quality.head_black_span(rows.withColumn("f", F.col("v") < 70), ["k"], "i", "t", "f", 48 * HOUR)
    gaps = rows.where("e = 'error'").select("k", (F.col("id") % 983).alias("sample_index"), (F.col("v") / 100).alias("gap_s"))
    return quality.legacy_span(rows, head, gaps, ["k"], "i", "t")


_LAYERS = """ly AS (SELECT p_brand AS profile, p_type AS path, max(p_name) AS value, 0 AS layer FROM part GROUP BY 1, 2 UNION ALL SELECT p_brand, p_type, CASE WHEN max(p_size) > 25 THEN 's' || max(p_size)::VARCHAR END, 1 FROM part WHERE p_size % 3 = 0 GROUP BY 1, 2),
    rl AS (SELECT *, row_number() OVER (PARTITION BY profile, path ORDER BY layer DESC) AS r FROM ly WHERE value IS NOT NULL), ef AS (SELECT profile, path, value, layer FROM rl WHERE r = 1)"""


def _layers(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    base = part.groupBy(F.col("p_brand").alias("profile"), F.col("p_type").alias("path")).agg(F.max("p_name").alias("value")).withColumn("layer", F.lit(0))
    own = part.where("p_size % 3 = 0").groupBy(F.col("p_brand").alias("profile"), F.col("p_type").alias("path")).agg(F.max("p_size").alias("s"))
    own = own.select("profile", "path", F.when(F.col("s") > 25, F.concat(F.lit("s"), F.col("s").cast("string"))).alias("value"), F.lit(1).alias("layer"))
    return quality.layered(base.unionByName(own), ["profile"], "path", "value", "layer")


@query(f"WITH {_LAYERS} SELECT profile, path, value, layer FROM ef")
def layered_settings(spark, sf_dir):
    return _layers(spark, sf_dir)


@query(f"WITH {_LAYERS} SELECT profile, count(*) AS settings, sha256(array_to_string(list_sort(list(path || '=' || value)), chr(10))) AS config_sha256 FROM ef GROUP BY 1")
def config_hashes(spark, sf_dir):
    return quality.config_hash(_layers(spark, sf_dir), ["profile"], "path", "value")


@query(f"""WITH {PLAN}, sg AS (SELECT k, place, start_ns, end_ns FROM pl WHERE duration_ns >= {HOUR}), ro AS (SELECT sg.k, place, ev.t - start_ns AS r, ev.v FROM sg JOIN ev ON ev.k = sg.k AND ev.t >= start_ns AND ev.t < end_ns)
    SELECT k, place, count(*) AS rows, min(r) AS first_ns, max(r) AS last_ns, round_even(sum(v), 4) AS total FROM ro GROUP BY k, place""")
def segment_generation(spark, sf_dir):
    """From raw streams to the planned segments' rebased rows, and a summary of each: all segments at once."""
    rows = annotate.clip(events(spark, sf_dir).select("k", "t", "v"), plan_rows(spark, sf_dir).select("k", "place", "start_ns", "end_ns"), ["k"], "t", "start_ns", "end_ns")
    return rows.groupBy("k", "place").agg(F.count(F.lit(1)).alias("rows"), F.min("t").alias("first_ns"), F.max("t").alias("last_ns"), F.bround(F.sum("v"), 4).alias("total"))


@query(f"""WITH {_SCENES}, fc AS (SELECT scn.k, place, count(*) AS frames, round_even(sum(v), 4) AS brightness FROM scn JOIN ev ON ev.k = scn.k AND ev.t >= start_ns AND ev.t < end_ns GROUP BY 1, 2)
    SELECT scn.k, scn.place, start_ns, end_ns, short_span, coalesce(frames, 0) AS frames, brightness FROM scn LEFT JOIN fc ON fc.k = scn.k AND fc.place = scn.place""")
def scene_pipeline(spark, sf_dir):
    """Candidates, hysteresis, minimum duration, scenes, and what each scene's frames come to."""
    found = scene.scenes(_kept(spark, sf_dir), _ends(spark, sf_dir), ["k"], 12 * HOUR).select("k", "place", "start_ns", "end_ns", "short_span")
    rows = annotate.clip(events(spark, sf_dir).select("k", "t", "v"), found.select("k", "place", "start_ns", "end_ns"), ["k"], "t", "start_ns", "end_ns")
    of = rows.groupBy("k", "place").agg(F.count(F.lit(1)).alias("frames"), F.bround(F.sum("v"), 4).alias("brightness"))
    return found.join(of, ["k", "place"], "left").na.fill(0, ["frames"])


@query(f"""WITH {_BAD}, ra AS (SELECT k, max(a) AS lo, min(b) AS hi FROM (SELECT k, e, min(t) AS a, max(t) AS b FROM ev WHERE e <> 'error' GROUP BY 1, 2) GROUP BY k HAVING max(a) < min(b)),
    hi AS (SELECT bad.* FROM bad JOIN ra USING (k) WHERE end_ns > lo AND start_ns < ra.hi), sp AS (SELECT k, start_ns, end_ns FROM {_subtracted("ra", "hi", "start_ns", "end_ns")}),
    lg AS (SELECT k, row_number() OVER (PARTITION BY k ORDER BY start_ns) - 1 AS place, start_ns, end_ns FROM sp WHERE end_ns - start_ns >= {12 * HOUR}),
    cv AS (SELECT lg.k, place, count(*) AS rows, count(DISTINCT e) AS streams FROM lg JOIN ev ON ev.k = lg.k AND ev.t >= start_ns AND ev.t < end_ns WHERE e <> 'error' GROUP BY 1, 2)
    SELECT lg.k, lg.place, start_ns, end_ns, coalesce(rows, 0) AS rows, coalesce(streams, 0) AS streams, coalesce(streams, 0) = n AS complete FROM lg JOIN (SELECT k, count(DISTINCT e) AS n FROM ev WHERE e <> 'error' GROUP BY k) x ON x.k = lg.k LEFT JOIN cv ON cv.k = lg.k AND cv.place = lg.place""")
def delivery_candidates(spark, sf_dir):
    """What can be delivered of each session: the range that all its streams share, without blocked intervals and short pieces, and
    whether every stream has rows in it."""
    rows = events(spark, sf_dir).where("e <> 'error'")
    ranges = rows.groupBy("k", "e").agg(F.min("t").alias("start_ns"), F.max("t").alias("end_ns"))
    spans = intervals.physical_spans(ranges, _bad(spark, sf_dir), ["k"]).where(F.col("end_ns") - F.col("start_ns") >= 12 * HOUR)
    placed = spans.select("k", (F.row_number().over(Window.partitionBy("k").orderBy("start_ns")) - 1).cast("bigint").alias("place"), "start_ns", "end_ns")
    inside = annotate.clip(rows.select("k", "t", "e"), placed, ["k"], "t", "start_ns", "end_ns").groupBy("k", "place").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("e").alias("streams"))
    every = ranges.groupBy("k").agg(F.count(F.lit(1)).alias("_t_all"))
    out = placed.join(inside, ["k", "place"], "left").na.fill(0, ["rows", "streams"]).join(every, "k")
    return out.select("k", "place", "start_ns", "end_ns", "rows", "streams", (F.col("streams") == F.col("_t_all")).alias("complete"))
