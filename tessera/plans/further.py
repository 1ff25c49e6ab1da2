"""Plans, guards, numbering and sampling over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import annotate, quality, scene, validate
from tessera.plans.adapters import EVENTS, HOUR, events, table
from tessera.plans.clocks import ISSUES, issue_rows
from tessera.plans.registry import query
from tessera.sinks import tables
from tessera.sources import files


@query("""SELECT p_partkey AS id, CASE WHEN p_size % 7 = 0 THEN 'missing_calibration' WHEN p_size % 5 NOT IN (0, 1, 2) THEN 'unsupported_calibration' WHEN p_size % 2 = 0 THEN 'identity' ELSE 'applied' END AS plan FROM part""")
def undistortion_plan(spark, sf_dir):
    z = F.col("p_size")
    model = F.when(z % 5 == 0, " Plumb_Bob").when(z % 5 == 1, "fisheye").when(z % 5 == 2, "opencv").otherwise("mystery")
    k = F.when(z % 2 == 0, F.array(F.lit(0.0), F.lit(1e-9))).otherwise(F.array(F.lit(0.1), F.lit(0.0)))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), annotate.undistortion_plan(model, k, z % 7 != 0).alias("plan"))


@query("""WITH b AS (SELECT l_suppkey AS k, l_orderkey AS f, l_quantity AS x1, l_quantity AS y1, l_quantity + l_linenumber AS x2, l_quantity + 2 AS y2, l_discount AS s FROM lineitem), r AS (SELECT *, row_number() OVER (PARTITION BY k, f ORDER BY (x2 - x1) * (y2 - y1) DESC, x1, y1, x2, y2) AS r, max(s) OVER (PARTITION BY k, f) AS m FROM b)
    SELECT k, f, (x2 - x1) * (y2 - y1) AS area, x1, y1, x2, y2, m AS completeness FROM r WHERE r = 1""")
def hand_frames(spark, sf_dir):
    q = F.col("l_quantity")
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("k"), F.col("l_orderkey").alias("f"), q.alias("x1"), q.alias("y1"), (q + F.col("l_linenumber")).alias("x2"), (q + 2).alias("y2"), F.col("l_discount").alias("s"))
    return annotate.hand_frames(rows, ["k"], "f", ["x1", "y1", "x2", "y2"], "s")


@query(f"""WITH {EVENTS}, x AS (SELECT k, i, id // 40 AS f, CASE WHEN e = 'error' THEN NULL ELSE t END AS t FROM ev), l AS (SELECT *, f - lag(f) OVER w AS df, t - last_value(t IGNORE NULLS) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS dt FROM x WINDOW w AS (PARTITION BY k ORDER BY i))
    SELECT k, i, sum(CASE WHEN coalesce(df > 1, false) OR coalesce(dt > {24 * HOUR}, false) THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY i)::BIGINT AS continuity_group FROM l""")
def index_groups(spark, sf_dir):
    rows = events(spark, sf_dir).select("k", "i", F.floor(F.col("id") / 40).alias("f"), F.when(F.col("e") != "error", F.col("t")).alias("t"))
    return annotate.index_groups(rows, ["k"], "i", "f", "t", 24 * HOUR).select("k", "i", "continuity_group")


@query("""SELECT c_custkey AS id, c_mktsegment AS profile FROM customer WHERE c_mktsegment IN (SELECT c_mktsegment FROM customer GROUP BY 1 HAVING min(c_custkey) % 2 = 1)""")
def applicable_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("profile"))
    profiles = rows.groupBy("profile").agg((F.min("id") % 2 == 1).alias("on"))
    return quality.applicable(rows, profiles, "profile", "on").select("id", "profile")


@query(f"""WITH {EVENTS}, r AS (SELECT k, i, row_number() OVER (PARTITION BY k ORDER BY i) AS r FROM ev WHERE e = 'error') SELECT k, count(*) AS n, array_to_string(list(i ORDER BY i) FILTER (WHERE r <= 5), ',') AS evidence FROM r GROUP BY k""")
def first_evidence(spark, sf_dir):
    out = quality.first_evidence(events(spark, sf_dir).where("e = 'error'"), ["k"], "i", "i", 5)
    return out.withColumn("evidence", F.array_join(F.col("evidence").cast("array<string>"), ","))


@query(f"""WITH {EVENTS}, n AS (SELECT k, count(*) AS n FROM ev GROUP BY k) SELECT DISTINCT k, CASE WHEN n <= 10 THEN j ELSE floor(j * (n / 10.0))::BIGINT END AS i FROM n, range(10) t(j) WHERE j < n""")
def systematic_sample(spark, sf_dir):
    return quality.every_kth(events(spark, sf_dir), ["k"], "i", 10).select("k", "i")


@query(f"""WITH {EVENTS}, x AS (SELECT k, i, t, v < 70 AS f FROM ev), c AS (SELECT k, min(i) FILTER (WHERE NOT f) AS c, arg_min(t, i) AS a FROM x GROUP BY k),
    g AS (SELECT c.k, count_if(i < c)::BIGINT AS n, max(t) FILTER (WHERE i < c) AS z, any_value(a) AS a, min(t) FILTER (WHERE i = c) AS nx FROM c JOIN x USING (k) GROUP BY c.k) SELECT k, n AS black_rows, CASE WHEN n > 0 AND (z - a >= {48 * HOUR} OR n >= 3) THEN nx ELSE a END AS start_ns FROM g""")
def head_black_span(spark, sf_dir):
    return quality.head_black_span(events(spark, sf_dir).withColumn("f", F.col("v") < 70), ["k"], "i", "t", "f", 48 * HOUR)


@query(f"WITH {ISSUES} SELECT k, sample_index, format('iss_{{:06d}}', row_number() OVER (PARTITION BY k ORDER BY start_ns, sample_index)) AS issue_id FROM iss")
def numbered_issues(spark, sf_dir):
    return tables.numbered(issue_rows(spark, sf_dir), ["k"], ["start_ns", "sample_index"]).select("k", "sample_index", "issue_id")


@query("""WITH a AS (SELECT c_custkey AS k, c_mktsegment AS c FROM customer WHERE c_custkey % 3 <> 0), b AS (SELECT c_custkey AS k, min(CASE WHEN c_custkey % 5 = 0 THEN 'other' ELSE c_mktsegment END) AS c FROM customer WHERE c_custkey % 2 = 0 GROUP BY 1)
    SELECT coalesce(a.k, b.k) AS k, coalesce(a.c, b.c) AS c, coalesce(a.c <> b.c, false) AS conflict FROM a FULL JOIN b ON a.k = b.k""")
def manifest_upsert(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("c"))
    new = c.where("k % 2 = 0").withColumn("c", F.when(F.col("k") % 5 == 0, "other").otherwise(F.col("c")))
    return tables.upsert_immutable(c.where("k % 3 <> 0"), new, "k", "c").withColumn("conflict", F.coalesce("conflict", F.lit(False)))


@query("""SELECT 'error' AS kind, event_id AS id, value AS v, NULL::VARCHAR AS note FROM events WHERE event_type = 'error' UNION ALL SELECT 'view', event_id, NULL, 'seen' FROM events WHERE event_type = 'view'""")
def union_of_findings(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    a = e.where("event_type = 'error'").select(F.lit("error").alias("kind"), F.col("event_id").alias("id"), F.col("value").alias("v"))
    b = e.where("event_type = 'view'").select(F.lit("view").alias("kind"), F.col("event_id").alias("id"), F.lit("seen").alias("note"))
    return quality.union_of([a, b])


@query("""SELECT p_brand AS k, count(*) AS rows, count_if(NOT (p_size - 3 > 0 AND p_retailprice > 0))::BIGINT AS bad_focal, count_if(NOT (p_size > 5 AND p_size > 10))::BIGINT AS bad_center, count_if(p_type NOT LIKE 'S%')::BIGINT AS unknown_model, count_if(NOT (abs(p_size - 20) <= 10))::BIGINT AS bad_size FROM part GROUP BY 1""")
def calibration_rules(spark, sf_dir):
    z = F.col("p_size")
    rows = table(spark, sf_dir, "part").select(F.col("p_brand").alias("k"), (z - 3).alias("fx"), F.col("p_retailprice").alias("fy"), (z - 5).alias("cx"), (z - 10).alias("cy"), F.substring("p_type", 1, 1).alias("model"), z.alias("width"), F.lit(20).alias("video_width"), F.lit(1).alias("height"), F.lit(1).alias("video_height"))
    return validate.violations(rows, validate.calibration(rows, ["S"]), ["k"])


@query("""WITH s AS (SELECT event_id AS i, (event_id % 1000) * 7000000 AS a, (event_id % 1000) * 7000000 + 90000000 AS z FROM events), r AS (SELECT i, floor(a * 30.0 / 1e9)::BIGINT AS f, ceil(z * 30.0 / 1e9)::BIGINT - 1 AS l FROM s), c AS (SELECT i, greatest(0, least(199, f)) AS f, l FROM r), d AS (SELECT i, f, greatest(f, least(199, l)) AS l FROM c)
    SELECT i, f AS first_frame, floor((f + l) / 2)::BIGINT AS middle_frame, l AS last_frame FROM d""")
def representative_frames(spark, sf_dir):
    a = F.col("event_id") % 1000 * 7_000_000
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("i"), a.alias("a"), (a + 90_000_000).alias("z"), F.lit(200).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("s"))
    return scene.representative_frames(rows, "a", "z", 30.0, "n", "s").select("i", "first_frame", "middle_frame", "last_frame")


@query(f"""WITH {EVENTS}, d AS (SELECT k, t - lag(t) OVER (PARTITION BY k ORDER BY i) AS d FROM ev), g AS (SELECT k, avg(d) AS m, median(d) FILTER (WHERE d > 0) AS p FROM d GROUP BY k) SELECT k, round_even(CASE WHEN m > 0 THEN 1e15 / m END, 4) AS mean_rate, round_even(CASE WHEN p > 0 THEN 1e15 / p END, 4) AS median_rate FROM g""")
def sensor_rates(spark, sf_dir):
    r = files.rates(events(spark, sf_dir), ["k"], "i", "t")
    return r.select("k", F.bround(F.col("mean_rate_hz") * 1e6, 4).alias("mean_rate"), F.bround(F.col("median_rate_hz") * 1e6, 4).alias("median_rate"))


def _dot(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda p: p[1]::DOUBLE * p[2]::DOUBLE))"


#: SQL: the cosine of the embeddings at the places l and r of xs.
_ALIKE = f"({_dot('xs[l]', 'xs[r]')} / (sqrt({_dot('xs[l]', 'xs[l]')}) * sqrt({_dot('xs[r]', 'xs[r]')})))"


@query(f"""WITH RECURSIVE em AS (SELECT label AS k, list(vec_id ORDER BY vec_id) AS ts, list(embedding ORDER BY vec_id) AS xs, min(vec_id) AS s, max(vec_id) AS z, coalesce(list(vec_id ORDER BY vec_id) FILTER (WHERE vec_id % 20 = 0), []) AS b FROM embeddings GROUP BY label),
    st AS (SELECT k, [s][1:0] AS stands, 1 AS i, false AS fresh, 0 AS n FROM em UNION ALL
        SELECT k, CASE WHEN falls THEN stands[1:len(stands) - 1] WHEN held THEN stands ELSE list_append(stands, b[i]) END, CASE WHEN falls OR held THEN i ELSE i + 1 END, falls OR NOT held, n + 1 FROM (
            SELECT *, fresh AND len(stands) > 0 AND stands[-1] % 100 <> 0 AND {_ALIKE} > 0.2 AS falls, fresh AS held FROM (
                SELECT st.*, b, xs, greatest(1, len(list_filter(ts, lambda t: t <= (CASE WHEN len(stands) > 1 THEN stands[-2] ELSE s END + stands[-1]) // 2))) AS l, greatest(1, len(list_filter(ts, lambda t: t <= (stands[-1] + CASE WHEN i <= len(b) THEN b[i] ELSE z END) // 2))) AS r FROM st JOIN em USING (k)) WHERE fresh OR i <= len(b))),
    fi AS (SELECT st.k, stands FROM st JOIN (SELECT k, max(n) AS n FROM st GROUP BY k) x ON x.k = st.k AND x.n = st.n)
    SELECT k, t AS timestamp_ns, t % 100 = 0 AS is_hard_cut FROM (SELECT k, unnest(stands) AS t FROM fi)""")
def merged_scenes(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select(F.col("label").alias("k"), F.col("vec_id").alias("at"), F.col("embedding").alias("x"))
    ends = rows.groupBy("k").agg(F.min("at").alias("start_ns"), F.max("at").alias("end_ns"))
    cuts = rows.where("at % 20 = 0").select("k", F.col("at").alias("timestamp_ns"), (F.col("at") % 100 == 0).alias("is_hard_cut"))
    return scene.merge_same(cuts, ends, ["k"], "at", "x", rows, 0.2)
