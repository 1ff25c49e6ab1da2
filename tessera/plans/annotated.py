"""Clipping, boxes, annotations and privacy over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import annotate, privacy
from tessera.plans.adapters import DAY, EVENTS, HOUR, events, six, table
from tessera.plans.registry import query

_SEGMENTS = f"sg AS (SELECT k, 1 AS seg, min(t) + {DAY} AS s, min(t) + {9 * DAY} AS z FROM ev GROUP BY k UNION ALL SELECT k, 2, min(t) + {8 * DAY}, min(t) + {20 * DAY} FROM ev GROUP BY k)"


def _segments(rows):
    ends = rows.groupBy("k").agg(F.min("t").alias("m"))
    part = lambda n, a, z: ends.select("k", F.lit(n).alias("seg"), (F.col("m") + a * DAY).alias("s"), (F.col("m") + z * DAY).alias("z"))
    return part(1, 1, 9).unionByName(part(2, 8, 20))


@query(f"WITH {EVENTS}, {_SEGMENTS} SELECT ev.k, i, seg, t - s AS t FROM ev JOIN sg ON ev.k = sg.k AND t >= s AND t < z")
def clip_half_open(spark, sf_dir):
    rows = events(spark, sf_dir)
    return annotate.clip(rows, _segments(rows), ["k"], "t", "s", "z").select("k", "i", "seg", "t")


@query(f"WITH {EVENTS}, {_SEGMENTS} SELECT ev.k, i, seg, t - s AS t FROM ev JOIN sg ON ev.k = sg.k AND t >= s AND t <= z")
def clip_closed(spark, sf_dir):
    rows = events(spark, sf_dir)
    return annotate.clip(rows, _segments(rows), ["k"], "t", "s", "z", closed=True).select("k", "i", "seg", "t")


@query(f"WITH {EVENTS}, {_SEGMENTS}, sp AS (SELECT k, t - {HOUR} AS a, t + {30 * HOUR} AS b FROM ev WHERE e = 'error') SELECT sp.k, seg, greatest(a, s) - s AS a, least(b, z) - s AS b FROM sp JOIN sg ON sp.k = sg.k AND a < z AND b > s")
def clip_spans(spark, sf_dir):
    rows = events(spark, sf_dir)
    spans = rows.where("e = 'error'").select("k", (F.col("t") - HOUR).alias("a"), (F.col("t") + 30 * HOUR).alias("b"))
    return annotate.clip_spans(spans, _segments(rows), ["k"], "a", "b", "s", "z").select("k", "seg", "a", "b")


_BOXES = "bx AS (SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS p, l_quantity * 40 - 100 AS x1, l_discount * 10000 - 50 AS y1, l_quantity * 40 + l_extendedprice / 100 AS x2, l_discount * 10000 + l_tax * 8000 AS y2 FROM lineitem)"


def _boxes(spark, sf_dir):
    q, d = F.col("l_quantity"), F.col("l_discount")
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"), (q * 40 - 100).alias("x1"), (d * 10_000 - 50).alias("y1"), (q * 40 + F.col("l_extendedprice") / 100).alias("x2"), (d * 10_000 + F.col("l_tax") * 8000).alias("y2"))


@query(f"""WITH {_BOXES}, c AS (SELECT k, n, p, x1 >= 0 AND x1 < x2 AND x2 <= 1920 AND y1 >= 0 AND y1 < y2 AND y2 <= 1080 AS valid, least(greatest(x1, 0.0), 1920.0) AS a, least(greatest(y1, 0.0), 1080.0) AS b, least(greatest(x2, 0.0), 1920.0) AS c, least(greatest(y2, 0.0), 1080.0) AS d, x1, y1, x2, y2 FROM bx)
    SELECT k, n, p, valid, round_even(a, 6) AS x1, round_even(b, 6) AS y1, round_even(c, 6) AS x2, round_even(d, 6) AS y2, a <> x1 OR b <> y1 OR c <> x2 OR d <> y2 AS was_clipped, round_even(greatest(c - a, 0.0) * greatest(d - b, 0.0), 3) AS area FROM c""")
def box_clip(spark, sf_dir):
    rows = _boxes(spark, sf_dir).withColumn("valid", annotate.box_valid("x1", "y1", "x2", "y2", 1920, 1080))
    out = annotate.box_clip(rows, ["x1", "y1", "x2", "y2"], 1920, 1080)
    return out.select("k", "n", "p", "valid", *(six(c).alias(c) for c in ("x1", "y1", "x2", "y2")), "was_clipped", F.bround("area", 3).alias("area"))


@query(f"""WITH {_BOXES}, b AS (SELECT k, n, max(x1) AS x1, max(y1) AS y1, max(x2) AS x2, max(y2) AS y2 FROM bx GROUP BY 1, 2), p AS (SELECT a.k, a.n, a.x1 AS a1, a.y1 AS a2, a.x2 AS a3, a.y2 AS a4, z.x1 AS b1, z.y1 AS b2, z.x2 AS b3, z.y2 AS b4 FROM b a JOIN b z ON a.k = z.k AND z.n = a.n + 1),
    i AS (SELECT *, greatest(0.0, least(a3, b3) - greatest(a1, b1)) * greatest(0.0, least(a4, b4) - greatest(a2, b2)) AS inter, greatest(0.0, a3 - a1) * greatest(0.0, a4 - a2) + greatest(0.0, b3 - b1) * greatest(0.0, b4 - b2) AS su FROM p)
    SELECT k, n, round_even(CASE WHEN su - inter > 0 THEN inter / (su - inter) ELSE 0.0 END, 6) AS iou FROM i""")
def box_iou(spark, sf_dir):
    b = _boxes(spark, sf_dir).groupBy("k", "n").agg(*(F.max(c).alias(c) for c in ("x1", "y1", "x2", "y2")))
    z = b.select("k", (F.col("n") - 1).alias("n"), *(F.col(c).alias(f"_{c}") for c in ("x1", "y1", "x2", "y2")))
    box = ["x1", "y1", "x2", "y2"]
    return b.join(z, ["k", "n"]).select("k", "n", six(annotate.iou([F.col(c) for c in box], [F.col(f"_{c}") for c in box])).alias("iou"))


@query(f"""WITH {EVENTS}, {_SEGMENTS}, ac AS (SELECT k, i, t AS a, t + {HOUR} * (id % 40 - 3) AS b FROM ev) SELECT ac.k, i, seg, greatest(a, s) AS clip_start_ns, least(b, z) AS clip_end_ns FROM ac JOIN sg ON ac.k = sg.k AND a <= z AND b >= s WHERE b >= a""")
def review_actions(spark, sf_dir):
    rows = events(spark, sf_dir)
    actions = rows.select("k", "i", F.col("t").alias("a"), (F.col("t") + F.lit(HOUR) * (F.col("id") % 40 - 3)).alias("b"))
    return annotate.overlapping(actions, _segments(rows), ["k"], "a", "b", "s", "z").select("k", "i", "seg", "clip_start_ns", "clip_end_ns")


@query(f"""WITH {EVENTS}, sg AS (SELECT k, min(t) + {DAY} AS s, min(t) + {15 * DAY} AS z FROM ev GROUP BY k), ou AS (SELECT k, i AS o, t FROM ev WHERE e = 'view'), an AS (SELECT ev.k, i, ev.t, s, id FROM ev JOIN sg ON ev.k = sg.k AND ev.t >= s AND ev.t < z WHERE e <> 'view'),
    ne AS (SELECT * FROM (SELECT an.*, o, ou.t - an.t AS off, row_number() OVER (PARTITION BY an.k, i ORDER BY abs(ou.t - an.t), ou.t, o) AS r FROM an JOIN ou ON an.k = ou.k) WHERE r = 1)
    SELECT k, i AS frame_index, o AS output_frame_index, t - s AS timestamp_ns, off AS mapping_error_ns, 'hand' AS kind, NULL::VARCHAR AS linked_id FROM ne WHERE id % 3 <> 0 UNION ALL
    SELECT k, i, o, t - s, off, 'object', 'hand_' || k || '_' || i FROM ne WHERE id % 3 <> 0 AND id % 4 = 0""")
def annotation_expand(spark, sf_dir):
    rows = events(spark, sf_dir)
    segments = rows.groupBy("k").agg((F.min("t") + DAY).alias("s"), (F.min("t") + 15 * DAY).alias("z"))
    zero, box = F.array(*(F.lit(0.0) for _ in range(4))), F.array(*(F.lit(x) for x in (0.1, 0.2, 0.3, 0.4)))
    notes = rows.where("e <> 'view'").select("k", F.col("i").alias("frame_index"), "t", F.when(F.col("id") % 3 == 0, zero).otherwise(box).alias("hand_bbox"), F.when(F.col("id") % 4 == 0, box).alias("object_bbox"))
    output = rows.where("e = 'view'").select("k", F.col("i").alias("output_frame_index"), F.col("t").alias("source_ts"))
    return annotate.expand_annotations(notes, ["k"], output, "t", "s", "z", segments).drop("bbox")


@query("""SELECT doc_id, CASE WHEN regexp_matches(text, '\\b\\d{17}[\\dXx]\\b') THEN 'id_card' WHEN regexp_matches(text, '\\b\\d{15}\\b') THEN 'id_card' WHEN regexp_matches(text, '\\b1[3-9]\\d{9}\\b') THEN 'phone' WHEN regexp_matches(text, '\\b\\d{13,19}\\b') THEN 'bank_card' ELSE '' END AS kind FROM documents""")
def strong_identifiers(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", privacy.strong_identifier(F.col("text")).alias("kind"))


@query("""SELECT conv_id, turn, CASE WHEN regexp_matches(text, '\\b\\d{17}[\\dXx]\\b') THEN 'id_card' WHEN regexp_matches(text, '\\b\\d{15}\\b') THEN 'id_card' WHEN regexp_matches(text, '\\b1[3-9]\\d{9}\\b') THEN 'phone' WHEN regexp_matches(text, '\\b\\d{13,19}\\b') THEN 'bank_card' ELSE '' END AS category FROM conversations""")
def classify_texts(spark, sf_dir):
    """Every distinct text is classified once, then joined back."""
    rows = table(spark, sf_dir, "conversations")
    return privacy.classify_distinct(rows, "text", lambda d: d.withColumn("category", privacy.strong_identifier(F.col("text")))).select("conv_id", "turn", "category")


@query("""SELECT doc_id, sha256(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\\b\\d{17}[\\dXx]\\b', '[REDACTED]', 'g'), '\\b\\d{15}\\b', '[REDACTED]', 'g'), '\\b1[3-9]\\d{9}\\b', '[REDACTED]', 'g'), '\\b\\d{13,19}\\b', '[REDACTED]', 'g')) AS sha FROM documents""")
def redacted_texts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(privacy.redacted(F.col("text")), 256).alias("sha"))


@query(f"""WITH RECURSIVE {EVENTS}, n AS (SELECT k, i, t, row_number() OVER (PARTITION BY k ORDER BY t, i) AS r FROM ev), f AS (SELECT k, i, t, r, t AS last, true AS inferred FROM n WHERE r = 1 UNION ALL
    SELECT n.k, n.i, n.t, n.r, CASE WHEN n.t - f.last >= {6 * HOUR} THEN n.t ELSE f.last END, n.t - f.last >= {6 * HOUR} FROM f JOIN n ON n.k = f.k AND n.r = f.r + 1) SELECT k, i, t, inferred FROM f""")
def sampled_rows(spark, sf_dir):
    return privacy.sampled(events(spark, sf_dir).select("k", "i", "t"), "k", "t", 6 * HOUR)


_OVERLAP = "greatest(0.0, least(n.x2, f.x2) - greatest(n.x1, f.x1)) * greatest(0.0, least(n.y2, f.y2) - greatest(n.y1, f.y1))"
_UNION = f"(n.x2 - n.x1) * (n.y2 - n.y1) + (f.x2 - f.x1) * (f.y2 - f.y1) - {_OVERLAP}"
_MEANS = ", ".join(f"CASE WHEN {_UNION} > 0 AND {_OVERLAP} / ({_UNION}) >= 0.3 THEN (n.{c} + f.{c}) / 2 ELSE n.{c} END" for c in ("x1", "y1", "x2", "y2"))


@query(f"""WITH RECURSIVE {_BOXES}, g AS (SELECT k % 97 AS video, k, max(x1) AS x1, max(y1) AS y1, max(x2) AS x2, max(y2) AS y2 FROM bx GROUP BY 1, 2), n AS (SELECT *, row_number() OVER (PARTITION BY video ORDER BY k) AS r FROM g),
    f AS (SELECT video, k, r, x1, y1, x2, y2 FROM n WHERE r = 1 UNION ALL SELECT n.video, n.k, n.r, {_MEANS} FROM f JOIN n ON n.video = f.video AND n.r = f.r + 1) SELECT video, k, x1, y1, x2, y2 FROM f""")
def smoothed_regions(spark, sf_dir):
    rows = _boxes(spark, sf_dir).withColumn("video", F.col("k") % 97).groupBy("video", "k").agg(*(F.max(c).alias(c) for c in ("x1", "y1", "x2", "y2")))
    return privacy.smooth_regions(rows, "video", "k", ["x1", "y1", "x2", "y2"])


@query(f"WITH {EVENTS} SELECT k, avg((abs(v) < 10)::INT) AS silence_ratio FROM ev GROUP BY k")
def audio_silence(spark, sf_dir):
    return annotate.audio_silence(events(spark, sf_dir), ["k"], "v", 10)


@query(f"WITH {EVENTS}, g AS (SELECT k, (max(t) - min(t)) / 1e9 AS s, count(*) AS n FROM ev GROUP BY k) SELECT k, n, n * 40000::DOUBLE AS expected_s FROM g WHERE abs(s - n * 40000.0) > 100000")
def duration_mismatch(spark, sf_dir):
    g = events(spark, sf_dir).groupBy("k").agg(((F.max("t") - F.min("t")) / 1e9).alias("s"), F.count(F.lit(1)).alias("n"))
    return annotate.duration_mismatch(g, "s", "n", 40_000.0, 100_000.0).select("k", "n", "expected_s")


@query("SELECT event_id, coalesce(abs(try_cast(value AS DOUBLE)) > 90, false) OR coalesce(abs(try_cast(event_type AS DOUBLE)) > 1, false) AS valid FROM events")
def valid_manipulation(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", annotate.valid_manipulation("value", "event_type", 90, 1).alias("valid"))


@query("SELECT conv_id, turn, CASE role WHEN 'user' THEN 'Left' WHEN 'assistant' THEN 'Right' ELSE 'Unknown' END AS hand FROM conversations")
def handedness(spark, sf_dir):
    label = F.when(F.col("role") == "user", " LEFT ").when(F.col("role") == "assistant", "r").otherwise("both")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", annotate.handedness(label).alias("hand"))


@query(f"""WITH {_BOXES}, c AS (SELECT k, n, p, y1 + 60 AS z, x1, y2 FROM bx) SELECT k, n, p, round_even(CASE WHEN z > 0 THEN 600.0 * x1 / z + 320 END, 4) AS u, round_even(CASE WHEN z > 0 THEN 600.0 * y2 / z + 240 END, 4) AS w FROM c""")
def camera_projection(spark, sf_dir):
    u, w = annotate.project(F.col("x1"), F.col("y2"), F.col("y1") + 60, 600.0, 600.0, 320.0, 240.0)
    return _boxes(spark, sf_dir).select("k", "n", "p", F.bround(u, 4).alias("u"), F.bround(w, 4).alias("w"))


@query(f"WITH {_BOXES} SELECT k, n, p, round_even(least(greatest((x1 - 16) / 0.5, 0.0), 1920.0), 6) AS x, round_even(least(greatest((y1 - 8) / 0.5, 0.0), 1080.0), 6) AS y FROM bx")
def letterbox_inverse(spark, sf_dir):
    box = annotate.letterbox_inverse([F.col(c) for c in ("x1", "y1", "x2", "y2")], F.lit(0.5), F.lit(16.0), F.lit(8.0), 1920, 1080)
    return _boxes(spark, sf_dir).select("k", "n", "p", six(box[0]).alias("x"), six(box[1]).alias("y"))
