"""Robust statistics over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import robust, sequence
from tessera.plans.adapters import EVENTS, SHIPMENTS, events, shipments, six
from tessera.plans.registry import query


def _spread(source: str, value: str) -> str:
    return f"""g AS (SELECT * FROM {source} WHERE isfinite({value})), m1 AS (SELECT k, median({value}) AS med, stddev_pop({value}) AS sd, count(*) AS n FROM g GROUP BY k),
    m AS (SELECT k, any_value(med) AS med, any_value(sd) AS sd, any_value(n) AS n, median(abs({value} - med)) AS mad FROM g JOIN m1 USING (k) GROUP BY k)"""


@query(f"""WITH {SHIPMENTS}, {_spread("sh", "p")}, s AS (SELECT *, CASE WHEN mad <> 0 THEN mad WHEN sd <> 0 THEN sd ELSE 1e-6 END AS sc FROM m)
    SELECT k, i, p, round_even(med, 6) AS median, round_even(sc, 6) AS scale FROM g JOIN s USING (k) WHERE abs(p - med) > 2.0 * sc""")
def mad_spikes(spark, sf_dir):
    return robust.spikes(shipments(spark, sf_dir), ["k"], "p", 2.0).select("k", "i", "p", six("median").alias("median"), six("scale").alias("scale"))


@query(f"""WITH {EVENTS}, {_spread("ev", "v")} SELECT k, i, v, round_even(med, 6) AS median, round_even(mad, 6) AS scale FROM g JOIN m USING (k) WHERE mad <> 0 AND abs(v - med) / (mad + 1e-12) > 3.0""")
def mad_spikes_skip_flat(spark, sf_dir):
    return robust.spikes(events(spark, sf_dir), ["k"], "v", 3.0, "skip").select("k", "i", "v", six("median").alias("median"), six("scale").alias("scale"))


@query(f"""WITH {EVENTS}, {_spread("ev", "v")} SELECT k, i, v FROM g JOIN m USING (k) WHERE n >= 5 AND mad > 0 AND abs(v - med) > 4.0 * mad""")
def encoder_range(spark, sf_dir):
    return robust.range_candidates(events(spark, sf_dir), ["k"], "v", 4.0).select("k", "i", "v")


@query(f"""WITH {SHIPMENTS}, st AS (SELECT k, i, sqrt(0.0 + (q - lag(q) OVER w) * (q - lag(q) OVER w) + (d - lag(d) OVER w) * (d - lag(d) OVER w)) AS s FROM sh WINDOW w AS (PARTITION BY k ORDER BY i)),
    {_spread("st", "s")} SELECT k, i, round_even(s, 6) AS s FROM g JOIN m USING (k) WHERE n >= 4 AND s > med + 3.0 * greatest(mad, 2.220446049250313e-16)""")
def step_outliers(spark, sf_dir):
    steps = sequence.previous(shipments(spark, sf_dir), ["k"], "i", ["q", "d"]).withColumn("s", robust.euclidean(["q", "d"]))
    return robust.step_outliers(steps, ["k"], "s", 3.0).select("k", "i", six("s").alias("s"))


@query(f"""WITH {SHIPMENTS}, x AS (SELECT k, d AS ax, x AS ay, CASE WHEN q < 10 THEN 9.8 ELSE q END AS az, d * 0.1 AS gx, x * 0.1 AS gy, 0.0 AS gz FROM sh),
    y AS (SELECT *, sqrt(0.0 + ax*ax + ay*ay + az*az) AS a, abs(sqrt(0.0 + ax*ax + ay*ay + az*az) - 9.81) < 0.5 AND sqrt(0.0 + gx*gx + gy*gy + gz*gz) < 0.05 AS still FROM x),
    z AS (SELECT k, count_if(still)::BIGINT AS static_samples, avg(az) FILTER (WHERE still) AS mz, stddev_pop(ax) FILTER (WHERE still) AS sx, avg(a) FILTER (WHERE still) - 9.81 AS g FROM y GROUP BY k)
    SELECT k, static_samples, CASE WHEN static_samples >= 10 THEN round_even(mz, 6) END AS mean_az, CASE WHEN static_samples >= 10 THEN round_even(sx, 6) END AS std_ax,
           CASE WHEN static_samples >= 10 THEN round_even(g, 6) END AS gravity_bias FROM z""")
def static_bias(spark, sf_dir):
    s = shipments(spark, sf_dir)
    rows = s.select("k", F.col("d").alias("ax"), F.col("x").alias("ay"), F.when(F.col("q") < 10, 9.8).otherwise(F.col("q")).alias("az"), (F.col("d") * 0.1).alias("gx"), (F.col("x") * 0.1).alias("gy"), F.lit(0.0).alias("gz"))
    out = robust.static_bias(rows, ["k"], ["ax", "ay", "az"], ["gx", "gy", "gz"])
    return out.select("k", "static_samples", *(six(c).alias(c) for c in ("mean_az", "std_ax", "gravity_bias")))


@query(f"WITH {SHIPMENTS} SELECT k, count_if(abs(q) >= 0.98 * 50)::BIGINT AS saturated_q, count_if(abs(d) >= 0.98 * 0.1)::BIGINT AS saturated_d FROM sh GROUP BY k")
def saturation(spark, sf_dir):
    return robust.saturation(shipments(spark, sf_dir), ["k"], {"q": 50, "d": 0.1})


@query(f"""WITH {SHIPMENTS} SELECT k, (count(*) * 2)::BIGINT AS elements, count_if(isnan(p))::BIGINT AS nan_count, 0::BIGINT AS inf_count, round_even(count_if(isnan(p)) / (count(*) * 2.0), 6) AS bad_ratio FROM sh GROUP BY k""")
def finite_profile(spark, sf_dir):
    return robust.finite_profile(shipments(spark, sf_dir), ["k"], ["p", "q"]).withColumn("bad_ratio", six("bad_ratio"))


@query(f"""WITH {SHIPMENTS} SELECT k, count(p) AS count, min(p) AS min, round_even(avg(p), 4) AS mean, round_even(quantile_cont(p, 0.5), 6) AS p50, round_even(quantile_cont(p, 0.9), 6) AS p90, round_even(quantile_cont(p, 0.95), 6) AS p95,
    round_even(quantile_cont(p, 0.99), 6) AS p99, max(p) AS max FROM sh WHERE NOT isnan(p) GROUP BY k""")
def distribution(spark, sf_dir):
    out = robust.distribution(shipments(spark, sf_dir), ["k"], "p")
    return out.select("k", "count", "min", F.bround("mean", 4).alias("mean"), *(six(c).alias(c) for c in ("p50", "p90", "p95", "p99")), "max")


SMOOTH = f"""{EVENTS}, sm AS (SELECT k, i, v, list_sort([v, coalesce(lag(v, 1) OVER w, first_value(v) OVER f), coalesce(lag(v, 2) OVER w, first_value(v) OVER f), coalesce(lead(v, 1) OVER w, last_value(v) OVER f),
    coalesce(lead(v, 2) OVER w, last_value(v) OVER f)])[3] AS smoothed FROM ev WINDOW w AS (PARTITION BY k ORDER BY i), f AS (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"""


@query(f"WITH {SMOOTH} SELECT * FROM sm")
def median_smooth(spark, sf_dir):
    return robust.median_smooth(events(spark, sf_dir), ["k"], "i", "v").select("k", "i", "v", "smoothed")


@query(f"""WITH {EVENTS}, nb AS (SELECT k, i, v, list_concat(coalesce(list(v) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING), []), coalesce(list(v) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN 1 FOLLOWING AND 30 FOLLOWING), [])) AS n FROM ev),
    ms AS (SELECT *, list_sum(n) / len(n) AS m FROM nb), sd AS (SELECT *, sqrt(list_sum(list_transform(n, lambda x: (x - m) * (x - m))) / len(n)) AS s FROM ms)
    SELECT k, i, round_even(CASE WHEN len(n) < 3 THEN 0.0 WHEN s > 2.220446049250313e-16 THEN (v - m) / s WHEN v > m THEN (v - m) / 2.220446049250313e-16 ELSE 0.0 END, 6) AS z FROM sd""")
def local_z(spark, sf_dir):
    return robust.local_z(events(spark, sf_dir), ["k"], "i", "v").select("k", "i", six("z").alias("z"))
