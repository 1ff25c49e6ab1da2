"""Findings, statuses, coverage, inventories, views over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import privacy, quality, validate
from tessera.plans.adapters import DAY, EVENTS, HOUR, events, nanos, six, table
from tessera.plans.registry import query

_SEVERITY = "CASE o_orderpriority WHEN '1-URGENT' THEN 'fatal' WHEN '2-HIGH' THEN 'error' WHEN '3-MEDIUM' THEN 'warn' WHEN '4-NOT SPECIFIED' THEN 'critical' ELSE 'info' END"
ORDERS = f"od AS (SELECT o_orderkey AS id, o_custkey AS c, o_orderstatus AS reason, {_SEVERITY} AS severity, (o_orderkey % 5)::BIGINT AS stage, o_totalprice AS price, epoch_us(o_orderdate) * 1000 AS t FROM orders)"


def orders(spark, sf_dir):
    severity = quality.lookup(F.col("o_orderpriority"), {"1-URGENT": "fatal", "2-HIGH": "error", "3-MEDIUM": "warn", "4-NOT SPECIFIED": "critical"}, "info")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("c"), F.col("o_orderstatus").alias("reason"), severity.alias("severity"), (F.col("o_orderkey") % 5).alias("stage"), F.col("o_totalprice").alias("price"), nanos("o_orderdate").alias("t"))


@query(f"WITH {ORDERS} SELECT 'total' AS by, NULL::VARCHAR AS value, count(*) AS n FROM od UNION ALL SELECT 'reason', reason, count(*) FROM od GROUP BY reason UNION ALL SELECT 'severity', severity, count(*) FROM od GROUP BY severity")
def issue_summary(spark, sf_dir):
    return quality.grouped_counts(orders(spark, sf_dir), ["reason", "severity"])


@query(f"WITH {ORDERS} SELECT 'total' AS by, NULL::VARCHAR AS value, count(*) AS n FROM od UNION ALL SELECT 'severity', severity, count(*) FROM od GROUP BY severity UNION ALL SELECT 'reason', reason, count(*) FROM od GROUP BY reason UNION ALL SELECT 'stage', stage::VARCHAR, count(*) FROM od GROUP BY stage")
def cascade_distribution(spark, sf_dir):
    return quality.grouped_counts(orders(spark, sf_dir), ["severity", "reason", "stage"])


@query(f"WITH {ORDERS} SELECT c, NOT bool_or(severity IN ('fatal', 'error')) AS passed, CASE WHEN bool_or(severity = 'fatal') THEN 'reject' WHEN bool_or(severity IN ('error', 'warn')) THEN 'quarantine' ELSE 'pass' END AS disposition FROM od GROUP BY c")
def overall_pass(spark, sf_dir):
    return quality.overall(orders(spark, sf_dir), ["c"])


@query(f"""WITH {ORDERS} SELECT c, CASE WHEN bool_or(severity = 'error') THEN 'fail' WHEN bool_or(severity IN ('warn', 'warning')) THEN 'warning' ELSE 'pass' END AS quality_status,
    CASE WHEN bool_or(severity IN ('error', 'critical', 'fatal')) THEN 'fail' WHEN bool_or(severity IN ('warn', 'warning')) THEN 'warning' ELSE 'pass' END AS strict_status FROM od GROUP BY c""")
def quality_status(spark, sf_dir):
    return quality.quality_status(orders(spark, sf_dir), ["c"])


@query(f"""WITH {ORDERS} SELECT id, 'price' AS name, price AS value, CASE WHEN id % 2 = 0 THEN 100000::DOUBLE ELSE 0.8::DOUBLE END AS threshold FROM od UNION ALL SELECT id, 'stage', stage::DOUBLE, 0.8::DOUBLE FROM od
    UNION ALL SELECT id, 'price_threshold', 100000::DOUBLE, 0.8::DOUBLE FROM od WHERE id % 2 = 0""")
def metric_explode(spark, sf_dir):
    limit = F.map_from_arrays(F.array(F.lit("price_threshold")), F.array(F.lit(100_000.0)))
    base = F.create_map(F.lit("price"), F.col("price"), F.lit("stage"), F.col("stage").cast("double"))
    detail = F.when(F.col("id") % 2 == 0, F.map_concat(base, limit)).otherwise(base)
    return quality.metrics(orders(spark, sf_dir).withColumn("detail", detail), ["id"], "detail")


@query(f"WITH {ORDERS}, s AS (SELECT *, min(stage) FILTER (WHERE severity = 'fatal') OVER (PARTITION BY c) AS stop FROM od) SELECT id, c, stage, severity FROM s WHERE stop IS NULL OR stage <= stop")
def cascade_stop(spark, sf_dir):
    return quality.stop_at_fatal(orders(spark, sf_dir), ["c"]).select("id", "c", "stage", "severity")


@query(f"""WITH {ORDERS}, d AS (SELECT id, CASE WHEN id % 4 = 0 THEN 'split' WHEN id % 4 = 1 THEN 'quarantine' WHEN id % 4 = 2 THEN 'pass' ELSE 'reject' END AS disposition, CASE WHEN id % 9 = 0 THEN NULL ELSE t END AS a,
    CASE WHEN id % 6 = 0 THEN NULL ELSE t + CASE WHEN id % 5 = 0 THEN -{DAY} ELSE {DAY} END END AS b FROM od WHERE id % 9 <> 0 OR id % 6 = 0),
    j AS (SELECT id, disposition, coalesce(a, 0) AS x, coalesce(b, CASE WHEN a IS NULL THEN 9000000000000000000 ELSE a END) AS y FROM d WHERE disposition <> 'pass')
    SELECT id, disposition, least(x, y) AS issue_start_ns, greatest(x, y) AS issue_end_ns FROM j""")
def decisions_to_issues(spark, sf_dir):
    i = F.col("id")
    rows = orders(spark, sf_dir).where((i % 9 != 0) | (i % 6 == 0)).withColumns({
        "disposition": F.when(i % 4 == 0, "split").when(i % 4 == 1, "quarantine").when(i % 4 == 2, "pass").otherwise("reject"), "timestamp_ns": F.when(i % 9 != 0, F.col("t")),
        "end_timestamp_ns": F.when(i % 6 != 0, F.col("t") + F.when(i % 5 == 0, -DAY).otherwise(DAY)), "s": F.lit(0).cast("bigint"), "z": F.lit(9_000_000_000_000_000_000).cast("bigint"),
    })
    return quality.decisions_to_issues(rows, "s", "z").select("id", "disposition", "issue_start_ns", "issue_end_ns")


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 IN (0, 1, 2) THEN 'split' WHEN o_orderkey % 5 = 3 THEN 'quarantine' ELSE 'reject' END AS action FROM orders")
def normalised_actions(spark, sf_dir):
    raw = F.element_at(F.array(*(F.lit(x) for x in ("trim", "exclude_range", "keep_with_flag", "quarantine", "reject"))), (F.col("o_orderkey") % 5 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), quality.normalised_action(raw).alias("action"))


@query("""WITH a AS (SELECT c_nationkey AS n, epoch_us(min(o_orderdate)) * 1000 AS a, epoch_us(max(o_orderdate)) * 1000 AS z FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F' GROUP BY 1) SELECT max(a) AS low, min(z) AS high FROM a HAVING max(a) < min(z)""")
def public_valid_range(spark, sf_dir):
    from tessera.operators.intervals import common_range

    j = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return common_range(j.groupBy("c_nationkey").agg(F.min(nanos("o_orderdate")).alias("start_ns"), F.max(nanos("o_orderdate")).alias("end_ns")), [])


@query(f"""WITH {ORDERS}, a AS (SELECT c, min(t) AS s, max(t) AS z FROM od GROUP BY c), b AS (SELECT c, min(t) AS s2, max(t) AS z2 FROM od WHERE reason = 'F' GROUP BY c)
    SELECT a.c, greatest(0, least(z, z2) - greatest(s, s2))::BIGINT AS overlap, CASE WHEN z > s THEN round_even(greatest(0, least(z, z2) - greatest(s, s2)) / (z - s)::DOUBLE, 6) ELSE 0.0 END AS ratio, s2 - s > {30 * DAY} AS starts_late, z - z2 > {30 * DAY} AS ends_early FROM a JOIN b USING (c)""")
def coverage(spark, sf_dir):
    rows = orders(spark, sf_dir)
    of = lambda df: df.groupBy("c").agg(F.min("t").alias("s"), F.max("t").alias("z"))
    return quality.coverage(of(rows), of(rows.where("reason = 'F'")), ["c"], "s", "z", 30 * DAY).withColumn("ratio", six("ratio"))


INVENTORY = """inv AS (SELECT coalesce(a.k, b.k, c.k) AS k, a.k IS NOT NULL AS has_video, b.k IS NOT NULL AS has_hands, c.k IS NOT NULL AS has_masks FROM (SELECT c_custkey AS k FROM customer) a
    FULL JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'O') b ON a.k = b.k FULL JOIN (SELECT s_suppkey AS k FROM supplier) c ON coalesce(a.k, b.k) = c.k)"""


def _inventory(spark, sf_dir):
    k = lambda t, c: table(spark, sf_dir, t).select(F.col(c).alias("k"))
    return quality.inventory({"video": k("customer", "c_custkey"), "hands": table(spark, sf_dir, "orders").where("o_orderstatus = 'O'").select(F.col("o_custkey").alias("k")), "masks": k("supplier", "s_suppkey")}, "k")


@query(f"WITH {INVENTORY} SELECT *, CASE WHEN has_video AND has_hands AND has_masks THEN 'ready' WHEN has_video THEN 'video_only' ELSE 'annotation_only' END AS status FROM inv")
def inventory_full_outer(spark, sf_dir):
    status = F.when(F.col("has_video") & F.col("has_hands") & F.col("has_masks"), "ready").when(F.col("has_video"), "video_only").otherwise("annotation_only")
    return _inventory(spark, sf_dir).withColumn("status", status)


@query(f"WITH {INVENTORY} SELECT count(*) AS total, count_if(has_video)::BIGINT AS videos, count_if(has_video AND has_hands)::BIGINT AS with_hands, count_if(NOT has_masks)::BIGINT AS without_masks FROM inv")
def inventory_statistics(spark, sf_dir):
    return _inventory(spark, sf_dir).agg(F.count(F.lit(1)).alias("total"), F.count_if("has_video").alias("videos"), F.count_if(F.col("has_video") & F.col("has_hands")).alias("with_hands"), F.count_if(~F.col("has_masks")).alias("without_masks"))


_ASSETS = f"{ORDERS}, asx AS (SELECT c, CASE WHEN severity = 'fatal' THEN 'reject' WHEN severity IN ('error', 'warn') THEN 'keep_with_flag' ELSE 'pass' END AS disposition FROM od)"


def _assets(spark, sf_dir):
    return orders(spark, sf_dir).withColumn("disposition", quality.lookup(F.col("severity"), {"fatal": "reject", "error": "keep_with_flag", "warn": "keep_with_flag"}, "pass"))


@query(f"WITH {_ASSETS} SELECT c, CASE WHEN bool_or(disposition = 'reject') THEN 'reject' WHEN bool_or(disposition = 'keep_with_flag') THEN 'keep_with_flag' ELSE 'pass' END AS disposition, count_if(disposition = 'reject')::BIGINT AS rejected, count_if(disposition = 'keep_with_flag')::BIGINT AS flagged, count(*) AS assets FROM asx GROUP BY c")
def completeness(spark, sf_dir):
    return quality.completeness(_assets(spark, sf_dir), ["c"])


_VIEWS = f"""{ORDERS}, g AS (SELECT c, count(*) AS n, bool_and(price > 1000) AS priced, bool_or(reason = 'F') AS finished FROM od GROUP BY c),
    vw AS (SELECT c, n >= 5 AND priced AND finished AS usable, CASE WHEN NOT n >= 5 THEN 'too_few' WHEN NOT priced THEN 'unpriced' WHEN NOT finished THEN 'unfinished' END AS reason,
    concat_ws(',', CASE WHEN NOT n >= 5 THEN 'too_few' END, CASE WHEN NOT priced THEN 'unpriced' END, CASE WHEN NOT finished THEN 'unfinished' END) AS reasons FROM g)"""


def _views(spark, sf_dir):
    g = orders(spark, sf_dir).groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.col("price") > 1000).alias("priced"), F.bool_or(F.col("reason") == "F").alias("finished"))
    return quality.views(g, ["c"], [("too_few", F.col("n") >= 5), ("unpriced", F.col("priced")), ("unfinished", F.col("finished"))])


@query(f"WITH {_VIEWS} SELECT * FROM vw")
def candidate_views(spark, sf_dir):
    return _views(spark, sf_dir).withColumn("reasons", F.array_join("reasons", ","))


@query(f"WITH {_VIEWS} SELECT c, CASE WHEN usable THEN 'pass' ELSE 'quarantine' END AS disposition, CASE WHEN usable THEN 'info' ELSE 'warn' END AS severity FROM vw")
def view_decisions(spark, sf_dir):
    return quality.view_decisions(_views(spark, sf_dir)).select("c", "disposition", "severity")


@query(f"""WITH {EVENTS} SELECT k, count(DISTINCT i) AS frames, count(e) FILTER (WHERE e <> 'view') AS regions, coalesce(array_to_string(list_sort(list(DISTINCT e) FILTER (WHERE e <> 'view')), ','), '') AS categories, arg_max(v > 30, i) AS model_available,
    CASE WHEN arg_max(v > 30, i) THEN 'pass' ELSE 'keep_with_flag' END AS disposition FROM ev GROUP BY k""")
def privacy_statistics(spark, sf_dir):
    rows = events(spark, sf_dir).withColumns({"category": F.when(F.col("e") != "view", F.col("e")), "model_available": F.col("v") > 30})
    return privacy.privacy_view(privacy.run_statistics(rows, ["k"], "i")).withColumn("categories", F.array_join("categories", ","))


@query(f"""WITH {ORDERS} SELECT reason, count(*) AS items FROM od GROUP BY reason""")
def batch_summary(spark, sf_dir):
    return orders(spark, sf_dir).groupBy("reason").agg(F.count(F.lit(1)).alias("items"))


@query(f"""WITH {EVENTS}, p AS (SELECT k, i, t, lag(t) OVER w AS pt, lag(id) OVER w AS pid, id FROM ev WINDOW w AS (PARTITION BY k ORDER BY i)) SELECT k, count_if(t <= pt)::BIGINT AS not_increasing_t, count_if(id <= pid)::BIGINT AS not_increasing_id FROM p GROUP BY k""")
def map_monotonic(spark, sf_dir):
    return validate.strictly_increasing(events(spark, sf_dir), ["k"], "i", ["t", "id"])


@query("""SELECT count(*) AS rows, count_if(NOT (l_quantity > 0))::BIGINT AS bad_quantity, count_if(NOT (l_discount BETWEEN 0 AND 0.05))::BIGINT AS bad_discount, count_if(NOT (l_returnflag IN ('A', 'N')))::BIGINT AS bad_flag FROM lineitem""")
def annotation_rules(spark, sf_dir):
    return validate.violations(table(spark, sf_dir, "lineitem"), {"bad_quantity": F.col("l_quantity") > 0, "bad_discount": F.col("l_discount").between(0, 0.05), "bad_flag": F.col("l_returnflag").isin("A", "N")})


@query("SELECT o_custkey AS c_key, count(*) AS rows FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 <> 0) GROUP BY 1")
def dangling_references(spark, sf_dir):
    child = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_key"))
    return validate.dangling(child, table(spark, sf_dir, "customer").where(F.col("c_custkey") % 3 != 0), "c_key", "c_custkey")


@query("""WITH e AS (SELECT c_custkey AS k FROM customer WHERE c_custkey % 2 = 0), f AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1)
    SELECT count(e.k) AS expected, count(f.k) AS found, count_if(f.k IS NULL)::BIGINT AS missing, count_if(e.k IS NULL)::BIGINT AS unexpected, count_if(n > 1)::BIGINT AS repeated FROM e FULL JOIN f ON e.k = f.k""")
def frame_coverage(spark, sf_dir):
    k = lambda t, c: table(spark, sf_dir, t).select(F.col(c).alias("k"))
    return validate.coverage_of(k("customer", "c_custkey").where("k % 2 = 0"), k("orders", "o_custkey"), ["k"])


@query(f"""WITH {EVENTS}, s AS (SELECT k, t AS a, t + {HOUR} * (id % 30 - 2) AS z FROM ev), n AS (SELECT *, lead(a) OVER (PARTITION BY k ORDER BY a, z) AS nx FROM s) SELECT k, count(*) AS rows, count_if(a >= z)::BIGINT AS reversed, count_if(nx < z)::BIGINT AS overlapping FROM n GROUP BY k""")
def scene_overlaps(spark, sf_dir):
    rows = events(spark, sf_dir).select("k", F.col("t").alias("a"), (F.col("t") + F.lit(HOUR) * (F.col("id") % 30 - 2)).alias("z"))
    return validate.no_overlap(rows, ["k"], "a", "z")


@query(f"""WITH {EVENTS}, p AS (SELECT k, abs((t - lag(t) OVER w) - (i - lag(i) OVER w) * {float(12 * HOUR)}) AS x FROM ev WINDOW w AS (PARTITION BY k ORDER BY i)) SELECT k, round_even(avg(x) / 1e6, 2) AS mean_error_ms, coalesce(avg(x) < {float(12 * HOUR)}, false) AS reliable FROM p GROUP BY k""")
def index_reliability(spark, sf_dir):
    out = validate.index_reliability(events(spark, sf_dir), ["k"], "i", "i", "t", 1e9 / (12 * HOUR), 12 * HOUR)
    return out.select("k", F.bround(F.col("mean_error_ns") / 1e6, 2).alias("mean_error_ms"), "reliable")


@query("""WITH a AS (SELECT o_orderkey AS k, o_totalprice AS p, o_orderstatus AS s FROM orders WHERE o_orderkey % 7 <> 0), b AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS p, o_orderstatus AS s FROM orders WHERE o_orderkey % 5 <> 0)
    SELECT count(a.k) AS left_rows, count(b.k) AS right_rows, count_if(a.k IS NULL OR b.k IS NULL)::BIGINT AS one_sided, count_if(a.k IS NOT NULL AND b.k IS NOT NULL AND (a.p <> b.p OR a.s <> b.s))::BIGINT AS different FROM a FULL JOIN b ON a.k = b.k""")
def positional_identity(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("p"), F.col("o_orderstatus").alias("s"))
    other = o.where("k % 5 <> 0").withColumn("p", F.when(F.col("k") % 11 == 0, F.col("p") + 1).otherwise(F.col("p")))
    return validate.same_rows(o.where("k % 7 <> 0"), other, ["k"], ["p", "s"])


@query("SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders")
def missing_streams(spark, sf_dir):
    k = lambda t, c: table(spark, sf_dir, t).select(F.col(c).alias("k"))
    return quality.missing_keys(k("customer", "c_custkey"), k("orders", "o_custkey"), ["k"])


@query("""WITH g AS (SELECT o_custkey AS k, list_sort(list(DISTINCT o_orderpriority)) AS p FROM orders GROUP BY 1), u AS (SELECT k, list_filter(p, lambda x: x NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')) AS u FROM g) SELECT k, array_to_string(u, ',') AS unknown FROM u WHERE len(u) > 0""")
def unknown_vocabulary(spark, sf_dir):
    g = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.array_sort(F.collect_set("o_orderpriority")).alias("p"))
    return quality.unknown_values(g, "p", ["1-URGENT", "2-HIGH", "3-MEDIUM"]).select("k", F.array_join("unknown", ",").alias("unknown"))


@query(f"""WITH {EVENTS}, g AS (SELECT k, count(*) AS frames, (max(t) - min(t)) / 1e9 AS s FROM ev GROUP BY k) SELECT k, frames, round_even(s / 43200.0, 0)::BIGINT AS expected_frames FROM g WHERE abs(frames - round_even(s / 43200.0, 0)) > 2""")
def frame_count_off(spark, sf_dir):
    g = events(spark, sf_dir).groupBy("k").agg(F.count(F.lit(1)).alias("frames"), ((F.max("t") - F.min("t")) / 1e9).alias("s"))
    return validate.frame_count_off(g, "frames", "s", 1 / 43200.0).select("k", "frames", "expected_frames")
