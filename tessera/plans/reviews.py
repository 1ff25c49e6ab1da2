"""Human review over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import review
from tessera.plans.adapters import EVENTS, HOUR, events, table
from tessera.plans.clocks import ISSUES, issue_rows
from tessera.plans.registry import query

_LABELS = "lb AS (SELECT l.doc_id, n_chars, quality = 1 AS good, toxic = 1 AS toxic FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"


def _labels(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return table(spark, sf_dir, "labels").join(docs, "doc_id").select("doc_id", "n_chars", (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))


def _rates(tp: str, fp: str, fn: str) -> str:
    p = f"CASE WHEN {tp} + {fp} > 0 THEN {tp} / ({tp} + {fp})::DOUBLE ELSE 0.0 END"
    r = f"CASE WHEN {tp} + {fn} > 0 THEN {tp} / ({tp} + {fn})::DOUBLE ELSE 0.0 END"
    return f"round_even({p}, 6) AS precision, round_even({r}, 6) AS recall, round_even(CASE WHEN {p} + {r} > 0 THEN 2 * ({p}) * ({r}) / (({p}) + ({r})) ELSE 0.0 END, 6) AS f1"


@query(f"""WITH {_LABELS}, c AS (SELECT count_if(n_chars >= 1000 AND good)::BIGINT AS tp, count_if(n_chars >= 1000 AND NOT good)::BIGINT AS fp, count_if(n_chars < 1000 AND good)::BIGINT AS fn, count_if(n_chars < 1000 AND NOT good)::BIGINT AS tn FROM lb)
    SELECT tp AS true_positive, fp AS false_positive, fn AS false_negative, tn AS true_negative, {_rates("tp", "fp", "fn")} FROM c""")
def confusion_matrix(spark, sf_dir):
    return _labels(spark, sf_dir).agg(*review.confusion(F.col("n_chars") >= 1000, F.col("good")))


_SWEEP = f"""{_LABELS}, th AS (SELECT DISTINCT n_chars::DOUBLE AS threshold FROM lb), sw AS (SELECT threshold, count_if(n_chars <= threshold AND good)::BIGINT AS tp, count_if(n_chars <= threshold AND NOT good)::BIGINT AS fp, count_if(n_chars > threshold AND good)::BIGINT AS fn FROM th, lb GROUP BY threshold),
    sc AS (SELECT threshold, tp, fp, fn, {_rates("tp", "fp", "fn")} FROM sw)"""


@query(f"WITH {_SWEEP} SELECT * FROM sc")
def threshold_sweep(spark, sf_dir):
    return review.threshold_sweep(_labels(spark, sf_dir), "n_chars", "good")


@query(f"WITH {_SWEEP} SELECT threshold, precision, recall, f1 FROM sc ORDER BY f1 DESC, precision DESC, recall DESC, threshold LIMIT 1")
def recommended_threshold(spark, sf_dir):
    return review.recommended(review.threshold_sweep(_labels(spark, sf_dir), "n_chars", "good"))


_REVIEWS = """rv AS (SELECT doc_id, 'a' AS who, quality = 1 AS usable, toxic AS extra FROM labels UNION ALL SELECT doc_id, CASE WHEN doc_id % 17 = 0 THEN 'a' ELSE 'b' END, toxic = 0, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE toxic END FROM labels WHERE doc_id % 13 <> 0),
    pa AS (SELECT doc_id, count(*) = 2 AND count(DISTINCT who) = 2 AS complete, count(DISTINCT usable) + max(usable IS NULL) <= 1 AND count(DISTINCT extra) + max((extra IS NULL)::INT) <= 1 AS same FROM rv GROUP BY doc_id), pr AS (SELECT doc_id, complete, complete AND same AS agreed FROM pa)""".replace("max(usable IS NULL)", "max((usable IS NULL)::INT)")


def _reviews(spark, sf_dir):
    l = table(spark, sf_dir, "labels")  # noqa: E741
    a = l.select("doc_id", F.lit("a").alias("who"), (F.col("quality") == 1).alias("usable"), F.col("toxic").alias("extra"))
    b = l.where("doc_id % 13 <> 0").select("doc_id", F.when(F.col("doc_id") % 17 == 0, "a").otherwise("b").alias("who"), (F.col("toxic") == 0).alias("usable"), F.when(F.col("doc_id") % 5 != 0, F.col("toxic")).alias("extra"))
    return review.pair_agreement(a.unionByName(b), "doc_id", "who", ["usable", "extra"])


@query(f"WITH {_REVIEWS} SELECT * FROM pr")
def review_pairs(spark, sf_dir):
    return _reviews(spark, sf_dir)


@query(f"WITH {_REVIEWS} SELECT count(*) AS items, count_if(complete)::BIGINT AS completed, count_if(agreed)::BIGINT AS agreements, CASE WHEN count_if(complete) > 0 THEN round_even(count_if(agreed) / count_if(complete)::DOUBLE, 6) END AS agreement_rate FROM pr")
def review_agreement(spark, sf_dir):
    return review.agreement_summary(_reviews(spark, sf_dir))


_EFFECTIVE = """ef AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'negative_audit' ELSE 'detected_candidate' END AS sample_source, CASE WHEN doc_id % 19 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN 'uncertain' WHEN quality = 1 THEN 'true_boundary' ELSE 'no_boundary' END AS a,
    CASE WHEN doc_id % 7 = 0 THEN 'uncertain' WHEN toxic = 0 THEN 'true_boundary' ELSE 'no_boundary' END AS b, CASE WHEN doc_id % 4 = 0 THEN 'true_boundary' WHEN doc_id % 4 = 1 THEN 'uncertain' END AS c FROM labels),
    el AS (SELECT doc_id, sample_source, a IS NOT NULL AS paired, coalesce(a = b AND a <> 'uncertain', false) AS agreed, CASE WHEN a = b AND a <> 'uncertain' THEN a WHEN a IS NOT NULL AND c <> 'uncertain' THEN c END AS effective FROM ef)"""


def _effective(spark, sf_dir):
    d = F.col("doc_id")
    rows = table(spark, sf_dir, "labels").select(
        "doc_id", F.when(d % 3 == 0, "negative_audit").otherwise("detected_candidate").alias("sample_source"),
        F.when(d % 19 == 0, None).when(d % 7 == 0, "uncertain").when(F.col("quality") == 1, "true_boundary").otherwise("no_boundary").alias("decision_1"),
        F.when(d % 7 == 0, "uncertain").when(F.col("toxic") == 0, "true_boundary").otherwise("no_boundary").alias("decision_2"), F.when(d % 4 == 0, "true_boundary").when(d % 4 == 1, "uncertain").alias("adjudicated"),
    )
    return review.effective_labels(rows, "doc_id")


@query(f"WITH {_EFFECTIVE} SELECT * FROM el")
def effective_labels(spark, sf_dir):
    return _effective(spark, sf_dir)


@query(f"""WITH {_EFFECTIVE}, n AS (SELECT count(*) AS items, count_if(paired)::BIGINT AS paired, count_if(agreed)::BIGINT AS agreed, count_if(paired AND effective IS NULL)::BIGINT AS unresolved, count_if(sample_source = 'detected_candidate' AND effective = 'true_boundary')::BIGINT AS tp,
    count_if(sample_source = 'detected_candidate' AND effective = 'no_boundary')::BIGINT AS fp, count_if(sample_source = 'negative_audit' AND effective IS NOT NULL)::BIGINT AS au, count_if(sample_source = 'negative_audit' AND effective = 'true_boundary')::BIGINT AS mi FROM el)
    SELECT items, paired, agreed, agreed / paired::DOUBLE AS agreement_rate, unresolved, tp AS true_positive, fp AS false_positive, tp / (tp + fp)::DOUBLE AS precision, au AS audited, mi / au::DOUBLE AS audit_hit_rate FROM n""")
def review_metrics(spark, sf_dir):
    return review.review_metrics(_effective(spark, sf_dir))


@query("""WITH d AS (SELECT doc_id, lang, source, CASE WHEN n_chars < 500 THEN 'short' WHEN n_chars < 3000 THEN 'medium' ELSE 'long' END AS bucket FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, bucket ORDER BY doc_id) AS r FROM d)
    SELECT doc_id, lang, source, bucket FROM r ORDER BY r, lang, source, bucket, doc_id LIMIT 100""")
def stratified_sample(spark, sf_dir):
    bucket = F.when(F.col("n_chars") < 500, "short").when(F.col("n_chars") < 3000, "medium").otherwise("long")
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", bucket.alias("bucket"))
    return review.stratified_sample(rows, ["lang", "source", "bucket"], "doc_id", 100)


@query(f"""WITH {EVENTS}, n AS (SELECT k, count(*) AS n FROM ev GROUP BY k), p AS (SELECT DISTINCT k, trunc(j * (n - 1) / 63.0)::BIGINT AS f FROM n, range(64) t(j)), ca AS (SELECT k, i FROM ev WHERE e = 'error'),
    fr AS (SELECT k, f FROM p WHERE NOT EXISTS (SELECT 1 FROM ca WHERE ca.k = p.k AND abs(ca.i - p.f) <= 2)), r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY f) AS r FROM fr) SELECT k, f AS frame_index FROM r WHERE r <= 8""")
def negative_frames(spark, sf_dir):
    rows = events(spark, sf_dir)
    return review.negative_frames(rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")), rows.where("e = 'error'").select("k", F.col("i").alias("frame_index")), ["k"], "n", 8, 2)


@query(f"WITH {EVENTS} SELECT k, i, substr(sha256(concat_ws(':', k::VARCHAR, i::VARCHAR, e)), 1, 16) AS review_item_id FROM ev")
def review_item_ids(spark, sf_dir):
    return events(spark, sf_dir).select("k", "i", review.review_item_id("k", "i", "e").alias("review_item_id"))


_MERGE = f"""{ISSUES}, nu AS (SELECT *, 'iss_' || k || '_' || sample_index AS issue_id FROM iss), en AS (SELECT issue_id, CASE sample_index % 6 WHEN 0 THEN 'rejected' WHEN 1 THEN 'approved' WHEN 2 THEN 'modified' WHEN 3 THEN 'modified' WHEN 4 THEN NULL ELSE 'added' END AS status, sample_index % 6 AS m, start_ns, end_ns, issue_type, severity FROM nu WHERE sample_index % 7 <> 0),
    e2 AS (SELECT CASE WHEN m = 5 THEN issue_id || '_new' ELSE issue_id END AS issue_id, coalesce(status, 'pending') AS status, issue_type AS ty, start_ns + {HOUR} AS s2, CASE WHEN m = 5 THEN NULL ELSE start_ns END AS z2, severity AS sv, CASE WHEN m = 3 THEN 'nonsense' ELSE 'keep' END AS de FROM en),
    jo AS (SELECT e2.*, nu.issue_id IS NOT NULL AS known, nu.issue_type, nu.start_ns, nu.end_ns, nu.severity, nu.decision FROM e2 LEFT JOIN nu USING (issue_id) WHERE status <> 'rejected'),
    oc AS (SELECT *, CASE WHEN status = 'modified' AND known AND de = 'keep' THEN 'modified' WHEN status = 'modified' AND known THEN 'kept' WHEN known AND status = 'approved' THEN 'approved' WHEN known THEN 'kept' WHEN de = 'keep' THEN 'added' END AS outcome FROM jo)
    SELECT issue_id, outcome, CASE WHEN outcome IN ('modified', 'added') THEN s2 ELSE start_ns END AS start_ns, CASE WHEN outcome IN ('modified', 'added') THEN greatest(s2, coalesce(z2, s2)) ELSE end_ns END AS end_ns, CASE WHEN outcome IN ('modified', 'added') THEN de ELSE decision END AS decision FROM oc WHERE outcome IS NOT NULL"""


@query("WITH " + _MERGE)
def apply_review(spark, sf_dir):
    n, m = F.col("sample_index"), F.col("sample_index") % 6
    issues = issue_rows(spark, sf_dir).withColumn("issue_id", F.concat_ws("_", F.lit("iss"), F.col("k").cast("string"), n.cast("string"))).withColumn("stream_id", F.col("k").cast("string"))
    status = F.when(m == 0, "rejected").when(m == 1, "approved").when(m.isin(2, 3), "modified").when(m == 5, "added")
    entries = issues.where(n % 7 != 0).select(
        F.when(m == 5, F.concat("issue_id", F.lit("_new"))).otherwise(F.col("issue_id")).alias("issue_id"), status.alias("status"), "issue_type", "stream_id", (F.col("start_ns") + HOUR).alias("start_ns"),
        F.when(m != 5, F.col("start_ns")).alias("end_ns"), F.when(F.col("severity") == "critical", "critical").otherwise(F.col("severity")).alias("severity"), F.when(m == 3, "nonsense").otherwise("keep").alias("decision"),
    )
    return review.apply_review(issues, entries).select("issue_id", "outcome", "start_ns", "end_ns", "decision")


@query(f"WITH {ISSUES} SELECT k, sample_index, CASE WHEN (CASE WHEN sample_index % 3 = 0 THEN 'quarantine' ELSE decision END) = 'quarantine' THEN 'split' ELSE decision END AS action FROM iss")
def reviewed_plan(spark, sf_dir):
    status = F.when(F.col("sample_index") % 3 == 0, "modified").otherwise("approved")
    return issue_rows(spark, sf_dir).select("k", "sample_index", review.reviewed_action(status, F.lit("quarantine"), F.col("decision")).alias("action"))


@query(f"WITH {EVENTS} SELECT k, i FROM ev WHERE e = 'error' OR v / 100 < 0.1")
def review_queue(spark, sf_dir):
    rows = events(spark, sf_dir).withColumns({"confidence": F.col("v") / 100, "decision": F.when(F.col("e") == "error", "inconsistent").otherwise("consistent")})
    return review.review_queue(rows, least=0.1).select("k", "i")
