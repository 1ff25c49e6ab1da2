"""Runs, spans and interval algebra over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import intervals
from tessera.plans.adapters import DAY, EVENTS, HOUR, SHIPMENTS, events, shipments, six
from tessera.plans.clocks import ISSUES, issue_rows
from tessera.plans.registry import query

RUNS = f"""{EVENTS}, fl AS (SELECT *, e = 'click' OR v > 60 AS f, t - lag(t) OVER w AS dt FROM ev WINDOW w AS (PARTITION BY k ORDER BY i)),
    ru AS (SELECT *, i - row_number() OVER (PARTITION BY k, f ORDER BY i) AS g FROM fl)"""


def _flagged(spark, sf_dir):
    return events(spark, sf_dir).withColumn("f", (F.col("e") == "click") | (F.col("v") > 60))


@query(f"""WITH {RUNS}, s AS (SELECT k, min(t) AS start_ns, arg_max(t + coalesce(dt, 0), i) AS end_ns, count(*) AS rows FROM ru WHERE f GROUP BY k, g) SELECT * FROM s WHERE end_ns - start_ns >= {HOUR}""")
def true_time_spans(spark, sf_dir):
    return intervals.time_spans(_flagged(spark, sf_dir), ["k"], "i", "t", "f", HOUR)


FRAMES = f"{RUNS}, fs AS (SELECT k, min(i) AS first, max(i) + 1 AS past, count(*) AS rows FROM ru WHERE f GROUP BY k, g)"


@query(f"WITH {FRAMES} SELECT * FROM fs WHERE rows >= 2")
def true_frame_spans(spark, sf_dir):
    return intervals.frame_spans(_flagged(spark, sf_dir), ["k"], "i", "f", 2)


@query(f"WITH {RUNS} SELECT k, i, f AND count(*) OVER (PARTITION BY k, f, g) >= 3 AS sustained FROM ru")
def sustained(spark, sf_dir):
    return intervals.sustained(_flagged(spark, sf_dir), ["k"], "i", "f", 3).select("k", "i", "sustained")


@query(f"""WITH {EVENTS}, x AS (SELECT k, i, t, i - row_number() OVER (PARTITION BY k ORDER BY i) AS g FROM ev WHERE e IN ('error', 'view'))
    SELECT k, min(i) AS first_index, max(i) AS last_index, count(*) AS rows, min(t) AS start_ns, max(t) AS end_ns FROM x GROUP BY k, g""")
def bad_index_runs(spark, sf_dir):
    return intervals.adjacent_runs(events(spark, sf_dir).where(F.col("e").isin("error", "view")), ["k"], "i", "t")


def _freeze(equal: str) -> str:
    return f"""{SHIPMENTS}, z AS (SELECT *, CASE WHEN i % 5 = 0 THEN 'NaN'::DOUBLE ELSE floor(q / 25) END AS a, floor(d * 20) AS b FROM sh),
    y AS (SELECT *, lag(a) OVER w AS pa, lag(b) OVER w AS pb FROM z WINDOW w AS (PARTITION BY k ORDER BY i)),
    n AS (SELECT *, sum(CASE WHEN {equal} THEN 0 ELSE 1 END) OVER (PARTITION BY k ORDER BY i) AS g FROM y)"""


_JOINT = "coalesce(a = pa AND NOT isnan(a) AND b = pb, false)"


def _levels(spark, sf_dir):
    return shipments(spark, sf_dir).withColumns({"a": F.when(F.col("i") % 5 == 0, float("nan")).otherwise(F.floor(F.col("q") / 25).cast("double")), "b": F.floor(F.col("d") * 20).cast("double")})


@query(f"WITH {_freeze(_JOINT)} SELECT k, min(i) AS first, max(i) AS last, count(*) AS rows, arg_min(t, i) AS start_ns, arg_max(t, i) AS end_ns FROM n GROUP BY k, g HAVING count(*) >= 3")
def freeze_joint(spark, sf_dir):
    return intervals.freeze_spans(_levels(spark, sf_dir), ["k"], "i", ["a", "b"], 3, ts="t")


@query(f"WITH {_freeze(_JOINT)} SELECT k, min(i) AS first, max(i) AS last, count(*) AS rows, arg_min(t, i) AS start_ns, arg_max(t, i) AS end_ns FROM n GROUP BY k, g HAVING count(*) >= 3")
def freeze_joint_sliced(spark, sf_dir):
    return intervals.freeze_spans(_levels(spark, sf_dir), ["k"], "i", ["a", "b"], 3, ts="t", slice_rows=64)


@query(f"WITH {_freeze('coalesce(isnan(a - pa) OR abs(a - pa) <= 1e-6, false)')} SELECT k, min(i) AS first, max(i) AS last, count(*) AS rows FROM n GROUP BY k, g HAVING count(*) >= 4")
def freeze_near(spark, sf_dir):
    return intervals.freeze_spans(_levels(spark, sf_dir), ["k"], "i", ["a"], 4, "near")


@query(f"""WITH {SHIPMENTS}, z AS (SELECT k, i, floor(q / 25) AS a, floor(d * 20) AS b FROM sh), l AS (SELECT k, i, 'a' AS axis, a AS v FROM z UNION ALL SELECT k, i, 'b', b FROM z),
    p AS (SELECT *, lag(v) OVER (PARTITION BY k, axis ORDER BY i) AS pv FROM l), g AS (SELECT *, sum(CASE WHEN v = pv THEN 0 ELSE 1 END) OVER (PARTITION BY k, axis ORDER BY i) AS g FROM p),
    c AS (SELECT *, count(*) OVER (PARTITION BY k, axis, g) AS n FROM g), r AS (SELECT k, i, bool_or(n >= 5) AS f FROM c GROUP BY k, i), u AS (SELECT k, i, i - row_number() OVER (PARTITION BY k ORDER BY i) AS h FROM r WHERE f)
    SELECT k, min(i) AS first, max(i) AS last, count(*) AS rows FROM u GROUP BY k, h""")
def freeze_any_axis(spark, sf_dir):
    rows = shipments(spark, sf_dir).withColumns({"a": F.floor(F.col("q") / 25), "b": F.floor(F.col("d") * 20)})
    return intervals.freeze_any_axis(rows, ["k"], "i", ["a", "b"], 5)


def _merged(source: str, start: str, end: str, gap: int) -> str:
    return f"""(WITH f AS (SELECT *, max({end}) OVER (PARTITION BY k ORDER BY {start}, {end} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM {source}),
        g AS (SELECT *, sum(CASE WHEN {start} - far <= {gap} THEN 0 ELSE 1 END) OVER (PARTITION BY k ORDER BY {start}, {end} ROWS UNBOUNDED PRECEDING) AS g FROM f)
        SELECT k, min({start}) AS {start}, max({end}) AS {end} FROM g GROUP BY k, g)"""


def _subtracted(ranges: str, holes: str, start: str, end: str) -> str:
    """ranges: (k, lo, hi); holes: (k, start, end)."""
    return f"""(WITH c AS (SELECT h.k, lo, hi, greatest({start}, lo) AS s, least({end}, hi) AS e FROM {holes} h JOIN {ranges} r ON h.k = r.k WHERE greatest({start}, lo) <= least({end}, hi) UNION ALL SELECT k, lo, hi, hi, hi FROM {ranges}),
        f AS (SELECT *, coalesce(max(e) OVER (PARTITION BY k ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), lo) AS far FROM c),
        p AS (SELECT DISTINCT k, far AS {start}, s AS {end} FROM f WHERE far < s) SELECT *, row_number() OVER (PARTITION BY k ORDER BY {start}) - 1 AS place FROM p)"""


_BAD = f"{EVENTS}, bad AS (SELECT k, t - {HOUR} AS start_ns, t + {6 * HOUR} AS end_ns FROM ev WHERE e = 'error')"


def _bad(spark, sf_dir):
    return events(spark, sf_dir).where("e = 'error'").select("k", (F.col("t") - HOUR).alias("start_ns"), (F.col("t") + 6 * HOUR).alias("end_ns"))


@query(f"WITH {_BAD} SELECT * FROM {_merged('bad', 'start_ns', 'end_ns', HOUR)}")
def merge_spans(spark, sf_dir):
    return intervals.merge(_bad(spark, sf_dir), ["k"], "start_ns", "end_ns", HOUR)


@query(f"WITH {FRAMES}, ln AS (SELECT k, 0::BIGINT AS lo, count(*) AS hi FROM ev GROUP BY k) SELECT k, first, past FROM {_subtracted('ln', 'fs', 'first', 'past')}")
def invert_spans(spark, sf_dir):
    rows = _flagged(spark, sf_dir)
    lengths = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    return intervals.invert(intervals.frame_spans(rows, ["k"], "i", "f"), lengths, ["k"], "first", "past", "n")


_KEEP = f"""{FRAMES}, ln AS (SELECT k, 0::BIGINT AS lo, count(*) AS hi FROM ev GROUP BY k), ex AS (SELECT * FROM {_merged("fs", "first", "past", 1)}), kp AS (SELECT * FROM {_subtracted("ln", "ex", "first", "past")}),
    al AS (SELECT k, first, past FROM ex UNION ALL SELECT k, first, past FROM kp WHERE past - first < 3), ag AS (SELECT * FROM {_merged("al", "first", "past", 0)})"""


@query(f"WITH {_KEEP} SELECT k, first, past FROM {_subtracted('ln', 'ag', 'first', 'past')}")
def keep_long_spans(spark, sf_dir):
    rows = _flagged(spark, sf_dir)
    lengths = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    return intervals.keep_long(intervals.frame_spans(rows, ["k"], "i", "f"), lengths, ["k"], "first", "past", "n", 1, 3)


@query(f"""WITH {FRAMES}, ln AS (SELECT k, count(*) AS length FROM ev GROUP BY k), j AS (SELECT fs.k, first, past, length, list_sort(list(DISTINCT e)) AS rs FROM fs JOIN ln USING (k) JOIN ev ON ev.k = fs.k AND i >= first AND i < past WHERE rows >= 2 GROUP BY ALL)
    SELECT k, first, past, array_to_string(rs, ',') AS reasons, CASE WHEN first = 0 AND past = length THEN 'reject' WHEN len(list_filter(rs, lambda x: x NOT IN ('click', 'view'))) = 0 THEN 'quarantine' WHEN first = 0 OR past = length THEN 'trim' ELSE 'split' END AS disposition FROM j""")
def span_reasons(spark, sf_dir):
    rows = _flagged(spark, sf_dir)
    spans = intervals.frame_spans(rows, ["k"], "i", "f", 2).join(rows.groupBy("k").agg(F.count(F.lit(1)).alias("length")), "k")
    out = intervals.span_reasons(spans, rows, ["k"], "first", "past", "i", "e", "length", ("click", "view"))
    return out.select("k", "first", "past", F.array_join("reasons", ",").alias("reasons"), "disposition")


_SESSIONS = "se AS (SELECT k, min(t) AS start_ns, max(t) AS end_ns FROM ev GROUP BY k)"


def _sessions(spark, sf_dir):
    return events(spark, sf_dir).groupBy("k").agg(F.min("t").alias("start_ns"), F.max("t").alias("end_ns"))


_PLAN_ISSUES = """pi AS (SELECT k, start_ns, end_ns, CASE WHEN sample_index % 11 = 0 THEN 'trim' WHEN sample_index % 3 = 0 THEN 'keep' ELSE decision END AS decision FROM iss)"""


def _plan_issues(spark, sf_dir):
    n = F.col("sample_index")
    return issue_rows(spark, sf_dir).withColumn("decision", F.when(n % 11 == 0, "trim").when(n % 3 == 0, "keep").otherwise(F.col("decision")))


PLAN = f"""{ISSUES}, {_PLAN_ISSUES}, {_SESSIONS},
    tr AS (SELECT pi.k, max(pi.end_ns) FILTER (WHERE pi.end_ns <= se.start_ns + (se.end_ns - se.start_ns) // 2) AS head, min(pi.start_ns) FILTER (WHERE pi.end_ns > se.start_ns + (se.end_ns - se.start_ns) // 2) AS tail FROM pi JOIN se USING (k) WHERE decision = 'trim' GROUP BY 1),
    vr AS (SELECT se.k, greatest(start_ns, coalesce(head, start_ns)) AS lo, least(end_ns, coalesce(tail, end_ns)) AS hi, head IS NOT NULL OR tail IS NOT NULL AS trimmed FROM se LEFT JOIN tr USING (k)),
    ra AS (SELECT k, lo, hi FROM vr WHERE lo < hi), ho AS (SELECT k, start_ns, end_ns FROM pi WHERE decision IN ('split', 'exclude_range', 'quarantine', 'keep_with_flag')),
    pa AS (SELECT * FROM {_subtracted("ra", "ho", "start_ns", "end_ns")}),
    pl AS (SELECT pa.k, place, start_ns, end_ns, end_ns - start_ns AS duration_ns, CASE WHEN end_ns = hi AND place = max(place) OVER (PARTITION BY pa.k) THEN CASE WHEN place > 0 THEN 'valid_span_after_long_gap' WHEN trimmed THEN 'trimmed_by_quality_boundary' ELSE 'full_session' END ELSE 'valid_span_before_long_gap' END AS reason,
           end_ns - start_ns > {10 * DAY} AS too_long FROM pa JOIN vr USING (k))"""


def plan_rows(spark, sf_dir):
    return intervals.plan_segments(_plan_issues(spark, sf_dir), _sessions(spark, sf_dir), ["k"], HOUR, 10 * DAY)


@query(f"WITH {PLAN} SELECT * FROM pl WHERE duration_ns >= {HOUR}")
def plan_segments(spark, sf_dir):
    return plan_rows(spark, sf_dir)


@query(f"""WITH {PLAN}, a AS (SELECT k, count(*) AS segments, sum(duration_ns)::BIGINT AS effective_ns, max(duration_ns) AS longest_ns FROM pl WHERE duration_ns >= {HOUR} GROUP BY k),
    b AS (SELECT k, count(*) AS issues FROM pi GROUP BY k) SELECT se.k, coalesce(segments, 0) AS segments, coalesce(effective_ns, 0) AS effective_ns, coalesce(longest_ns, 0) AS longest_ns, coalesce(issues, 0) AS issues FROM se LEFT JOIN a USING (k) LEFT JOIN b USING (k)""")
def session_plan(spark, sf_dir):
    """The flagship: continuity groups, their issues, planned segments, and what is left of every session."""
    plan = plan_rows(spark, sf_dir).groupBy("k").agg(F.count(F.lit(1)).alias("segments"), F.sum("duration_ns").alias("effective_ns"), F.max("duration_ns").alias("longest_ns"))
    issues = _plan_issues(spark, sf_dir).groupBy("k").agg(F.count(F.lit(1)).alias("issues"))
    return _sessions(spark, sf_dir).select("k").join(plan, "k", "left").join(issues, "k", "left").na.fill(0, ["segments", "effective_ns", "longest_ns", "issues"])


@query(f"""WITH RECURSIVE {PLAN}, cu AS (SELECT k, start_ns AS s, end_ns AS e, row_number() OVER (PARTITION BY k ORDER BY sample_index) AS n FROM (SELECT k, sample_index, start_ns, end_ns, CASE WHEN sample_index % 11 = 0 THEN 'trim' WHEN sample_index % 3 = 0 THEN 'keep' ELSE decision END AS d FROM iss) WHERE d IN ('split', 'exclude_range', 'quarantine', 'keep_with_flag')),
    fo AS (SELECT k, lo, hi, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS hs, CAST(NULL AS BIGINT) AS he FROM vr UNION ALL
        SELECT fo.k, CASE WHEN s < lo AND lo < e THEN e ELSE lo END, CASE WHEN NOT (s < lo AND lo < e) AND NOT (s >= lo AND e <= hi) AND s < hi AND hi < e THEN s ELSE hi END, cu.n, CASE WHEN s >= lo AND e <= hi THEN s END, CASE WHEN s >= lo AND e <= hi THEN e END FROM fo JOIN cu ON cu.k = fo.k AND cu.n = fo.n + 1),
    fi AS (SELECT fo.k, lo, hi FROM fo JOIN (SELECT k, max(n) AS n FROM fo GROUP BY k) x ON x.k = fo.k AND x.n = fo.n),
    en AS (SELECT k, hs AS s, he AS e, 0 AS z FROM fo WHERE hs IS NOT NULL UNION ALL SELECT k, hi, hi, 1 FROM fi),
    la AS (SELECT en.k, s, greatest(lo, coalesce(max(e) OVER (PARTITION BY en.k ORDER BY z, s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), lo)) AS a FROM en JOIN fi ON fi.k = en.k),
    pn AS (SELECT k, row_number() OVER (PARTITION BY k ORDER BY a) - 1 AS place, a AS start_ns, s AS end_ns FROM la WHERE a < s) SELECT k, place, start_ns, end_ns FROM pn WHERE end_ns - start_ns >= {HOUR}""")
def plan_segments_in_order(spark, sf_dir):
    return intervals.plan_segments_in_order(_plan_issues(spark, sf_dir), _sessions(spark, sf_dir), "k", "sample_index", HOUR)


@query(f"WITH {ISSUES} SELECT k, sample_index, CASE WHEN decision IN ('split', 'exclude_range', 'keep_with_flag') THEN 'keep' ELSE decision END AS decision FROM iss")
def downgraded_issues(spark, sf_dir):
    return intervals.downgrade(issue_rows(spark, sf_dir)).select("k", "sample_index", "decision")


@query(f"""WITH {_BAD}, ra AS (SELECT k, max(a) AS lo, min(b) AS hi FROM (SELECT k, e, min(t) AS a, max(t) AS b FROM ev WHERE e <> 'error' GROUP BY 1, 2) GROUP BY k HAVING max(a) < min(b)),
    hi AS (SELECT bad.* FROM bad JOIN ra USING (k) WHERE end_ns > lo AND start_ns < ra.hi) SELECT k, start_ns, end_ns FROM {_subtracted("ra", "hi", "start_ns", "end_ns")}""")
def physical_spans(spark, sf_dir):
    ranges = events(spark, sf_dir).where("e <> 'error'").groupBy("k", "e").agg(F.min("t").alias("start_ns"), F.max("t").alias("end_ns"))
    return intervals.physical_spans(ranges, _bad(spark, sf_dir), ["k"])


@query(f"""WITH {SHIPMENTS}, z AS (SELECT *, NOT isnan(p) AND p <= 70000 AND q <= 45 AND d <= 0.09 AS idle FROM sh), b AS (SELECT k, min(i) FILTER (WHERE NOT idle) AS a, max(i) FILTER (WHERE NOT idle) AS z FROM z GROUP BY k),
    h AS (SELECT z.k, 'head' AS edge, t, i FROM z JOIN b USING (k) WHERE b.a IS NULL OR i < b.a UNION ALL SELECT z.k, 'tail', t, i FROM z JOIN b USING (k) WHERE b.z IS NULL OR i > b.z)
    SELECT k, edge, arg_min(t, i) AS start_ns, arg_max(t, i) AS end_ns, count(*) AS rows FROM h GROUP BY k, edge HAVING count(*) >= 2""")
def edge_idle(spark, sf_dir):
    return intervals.edge_idle(shipments(spark, sf_dir), ["k"], "i", "t", {"p": 70_000, "q": 45, "d": 0.09}, 2)


@query(f"""WITH {SHIPMENTS}, z AS (SELECT k, i, q, i - row_number() OVER (PARTITION BY k ORDER BY i) AS g FROM sh WHERE q < 30) SELECT k, min(i) AS first, max(i) AS last, count(*) AS rows, round_even(avg(q), 6) AS mean_q FROM z GROUP BY k, g HAVING count(*) >= 4""")
def static_windows(spark, sf_dir):
    rows = shipments(spark, sf_dir).withColumn("still", F.col("q") < 30)
    return intervals.static_windows(rows, ["k"], "i", "still", 4, ["q"]).withColumn("mean_q", six("mean_q"))


@query(f"""WITH {EVENTS}, s AS (SELECT k, min(t) AS lo, max(t) AS hi FROM ev GROUP BY k), sp AS (SELECT k, t - {HOUR} AS a, t + {HOUR} AS b FROM ev WHERE e = 'error') SELECT sp.k, a, b, CASE WHEN a - lo <= {2 * DAY} OR hi - b <= {2 * DAY} THEN 'trim' ELSE 'split' END AS decision FROM sp JOIN s USING (k)""")
def black_span_decision(spark, sf_dir):
    rows = events(spark, sf_dir)
    ends = rows.groupBy("k").agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
    spans = rows.where("e = 'error'").select("k", (F.col("t") - HOUR).alias("a"), (F.col("t") + HOUR).alias("b")).join(ends, "k")
    return intervals.edge_decision(spans, "a", "b", "lo", "hi", 2 * DAY).select("k", "a", "b", "decision")


@query("""WITH d AS (SELECT DISTINCT user_id AS k, event_id // 100 AS i FROM events), p AS (SELECT k, i, lag(i) OVER (PARTITION BY k ORDER BY i) AS p FROM d) SELECT k, p + 1 AS first_missing, i - 1 AS last_missing, i - p - 1 AS missing FROM p WHERE i - p > 1""")
def missing_frames(spark, sf_dir):
    rows = events(spark, sf_dir).select("k", F.floor(F.col("id") / 100).alias("i"))
    return intervals.missing_runs(rows, ["k"], "i")
