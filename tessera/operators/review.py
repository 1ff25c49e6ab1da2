"""Human review: merging results, agreement, thresholds, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Decisions and severities that an issue may have.
DECISIONS = ("keep", "keep_with_flag", "trim", "split", "exclude_range", "quarantine", "reject")
SEVERITIES = ("info", "warning", "error", "critical")


def apply_review(issues: DataFrame, entries: DataFrame) -> DataFrame:
    """Issues after review, with ``outcome``.

    ``entries`` (issue_id, status, issue_type, stream_id, start_ns, end_ns, severity, decision) rule: rejected ones go;
    modified ones replace a known issue if they are valid, else it is kept; other known issues stay (approved or kept);
    unknown valid ones are added.  Issues without an entry are dropped.
    """
    fields = ["issue_type", "stream_id", "start_ns", "end_ns", "severity", "decision"]
    e = entries.select("issue_id", F.lower(F.coalesce("status", F.lit("pending"))).alias("status"), *(F.col(c).alias(f"_e_{c}") for c in fields)).where("status <> 'rejected'")
    joined = e.join(issues.select("issue_id", *fields, F.lit(True).alias("_t_known")), "issue_id", "left")
    valid = F.col("_e_issue_type").isNotNull() & F.col("_e_decision").isin(*DECISIONS) & F.coalesce("_e_severity", F.lit("warning")).isin(*SEVERITIES)
    valid, known = F.coalesce(valid, F.lit(False)), F.col("_t_known").isNotNull()
    outcome = F.when((F.col("status") == "modified") & known & valid, "modified").when((F.col("status") == "modified") & known, "kept").when(known & (F.col("status") == "approved"), "approved").when(known, "kept").when(valid, "added")
    start = F.coalesce("_e_start_ns", F.lit(0).cast("bigint"))
    new = {"issue_type": F.col("_e_issue_type"), "stream_id": F.coalesce("_e_stream_id", F.lit("")), "start_ns": start, "end_ns": F.greatest(start, F.coalesce("_e_end_ns", start)), "severity": F.coalesce("_e_severity", F.lit("warning")), "decision": F.col("_e_decision")}
    taken = joined.withColumn("outcome", outcome).where("outcome is not null")
    return taken.select("issue_id", "outcome", *(F.when(F.col("outcome").isin("modified", "added"), new[c]).otherwise(F.col(c)).alias(c) for c in fields))


def confusion(prediction: Column, label: Column) -> list[Column]:
    """Aggregates: the confusion matrix, precision, recall and f1 to 6 places; 0 where a denominator is 0."""
    tp, fp, fn, tn = F.count_if(prediction & label), F.count_if(prediction & ~label), F.count_if(~prediction & label), F.count_if(~prediction & ~label)
    return [tp.alias("true_positive"), fp.alias("false_positive"), fn.alias("false_negative"), tn.alias("true_negative"), *(F.bround(x, 6).alias(n) for x, n in zip(scores(tp, fp, fn), ("precision", "recall", "f1"), strict=True))]


def scores(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column, Column]:
    p = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0)
    r = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0)
    return p, r, F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)


def threshold_sweep(df: DataFrame, value: str, label: str, less_equal: bool = True, ranges: int = 1024) -> DataFrame:
    """Every distinct value as a threshold, with its scores.

    Values are counted, then summed up by running sums within ``ranges`` equal ranges and over the ranges' totals, so that
    only these totals meet in one task.
    """
    per = df.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("threshold")).agg(F.count_if(F.col(label)).alias("_t_p"), F.count_if(~F.col(label)).alias("_t_n"))
    ends = per.agg(F.min("threshold").alias("_t_lo"), F.max("threshold").alias("_t_hi"), F.sum("_t_p").alias("_t_all"))
    place = F.when(F.col("_t_hi") > F.col("_t_lo"), F.floor((F.col("threshold") - F.col("_t_lo")) / (F.col("_t_hi") - F.col("_t_lo")) * (ranges - 1))).otherwise(0)
    laid = per.crossJoin(F.broadcast(ends)).withColumn("_t_r", place)
    turn = (lambda c: F.col(c)) if less_equal else (lambda c: F.desc(c))
    before = Window.orderBy(turn("_t_r")).rowsBetween(Window.unboundedPreceding, -1)
    totals = laid.groupBy("_t_r").agg(F.sum("_t_p").alias("_t_sp"), F.sum("_t_n").alias("_t_sn"))
    totals = totals.select("_t_r", F.coalesce(F.sum("_t_sp").over(before), F.lit(0)).alias("_t_bp"), F.coalesce(F.sum("_t_sn").over(before), F.lit(0)).alias("_t_bn"))
    w = Window.partitionBy("_t_r").orderBy(turn("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    got = laid.join(F.broadcast(totals), "_t_r").withColumns({"tp": F.sum("_t_p").over(w) + F.col("_t_bp"), "fp": F.sum("_t_n").over(w) + F.col("_t_bn")})
    p, r, f = scores(F.col("tp"), F.col("fp"), F.col("_t_all") - F.col("tp"))
    return got.select("threshold", "tp", "fp", (F.col("_t_all") - F.col("tp")).alias("fn"), F.bround(p, 6).alias("precision"), F.bround(r, 6).alias("recall"), F.bround(f, 6).alias("f1"))


def recommended(sweep: DataFrame) -> DataFrame:
    """The threshold with the best (f1, precision, recall); ties go to the lowest."""
    best = F.max_by(F.struct("threshold", "precision", "recall", "f1"), F.struct("f1", "precision", "recall", -F.col("threshold")))
    return sweep.agg(best.alias("b")).select("b.*")


def pair_agreement(reviews: DataFrame, item: str, reviewer: str, fields: list[str]) -> DataFrame:
    """Per item: complete (exactly two reviews by two reviewers) and agreed (all fields equal, nulls too)."""
    same = F.lit(True)
    for f in fields:
        same = same & ((F.count_distinct(f) + F.max(F.col(f).isNull().cast("int"))) <= 1)
    out = reviews.groupBy(item).agg(F.count(F.lit(1)).alias("_t_n"), F.count_distinct(reviewer).alias("_t_r"), same.alias("_t_same"))
    complete = (F.col("_t_n") == 2) & (F.col("_t_r") == 2)
    return out.select(item, complete.alias("complete"), (complete & F.col("_t_same")).alias("agreed"))


def agreement_summary(pairs: DataFrame) -> DataFrame:
    done, agreed = F.count_if("complete"), F.count_if("agreed")
    return pairs.agg(F.count(F.lit(1)).alias("items"), done.alias("completed"), agreed.alias("agreements"), F.when(done > 0, F.bround(agreed / done, 6)).alias("agreement_rate"))


def effective_labels(reviews: DataFrame, item: str) -> DataFrame:
    """Per item from decision_1, decision_2 and adjudicated: paired, agreed, effective decision or null (unresolved).

    Two equal decisions count unless uncertain; else the adjudicated one, unless it is missing or uncertain.
    """
    a, b = F.col("decision_1"), F.col("decision_2")
    paired = a.isNotNull() & b.isNotNull()
    agreed = paired & (a == b) & (a != "uncertain")
    effective = F.when(agreed, a).when(paired & (F.col("adjudicated") != "uncertain"), F.col("adjudicated"))
    return reviews.select(item, "sample_source", paired.alias("paired"), F.coalesce(agreed, F.lit(False)).alias("agreed"), effective.alias("effective"))


def review_metrics(labels: DataFrame) -> DataFrame:
    """Agreement, precision over detected candidates, hit rate over audited negatives; nulls where there are none."""
    of = lambda s, d: F.count_if((F.col("sample_source") == s) & (F.col("effective") == d))
    tp, fp = of("detected_candidate", "true_boundary"), of("detected_candidate", "no_boundary")
    negatives = F.count_if((F.col("sample_source") == "negative_audit") & F.col("effective").isNotNull())
    ratio = lambda x, y: F.when(y > 0, x / y)
    return labels.agg(
        F.count(F.lit(1)).alias("items"), F.count_if("paired").alias("paired"), F.count_if("agreed").alias("agreed"), ratio(F.count_if("agreed"), F.count_if("paired")).alias("agreement_rate"),
        F.count_if(F.col("paired") & F.col("effective").isNull()).alias("unresolved"), tp.alias("true_positive"), fp.alias("false_positive"), ratio(tp, tp + fp).alias("precision"),
        negatives.alias("audited"), ratio(of("negative_audit", "true_boundary"), negatives).alias("audit_hit_rate"),
    )


def stratified_sample(df: DataFrame, strata: list[str], key: str, count: int) -> DataFrame:
    """``count`` rows taken in turn from the strata (in their order), within a stratum by ``key``; all rows if they are few.

    Each stratum's first ``count`` rows are all that can be taken, so only those are sorted together.
    """
    within = df.withColumn("_t_r", F.row_number().over(Window.partitionBy(*strata).orderBy(key))).where(F.col("_t_r") <= count)
    return within.orderBy("_t_r", *strata, key).limit(count).drop("_t_r")


def negative_frames(spans: DataFrame, candidates: DataFrame, keys: list[str], frames: str, count: int, radius: int) -> DataFrame:
    """The first ``count`` of evenly spaced frames of each stream that are over ``radius`` from all candidates.

    The pool has count * 8 places from 0 to frames - 1, truncated, distinct.
    """
    n = max(count * 8, count)
    place = (F.col("_t_i") * (F.col(frames) - 1) / (n - 1)).cast("bigint") if n > 1 else F.lit(0).cast("bigint")
    pool = spans.select(*keys, frames, F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_t_i")).select(*keys, place.alias("frame_index")).distinct()
    near = candidates.select(*keys, F.explode(F.sequence(F.col("frame_index") - radius, F.col("frame_index") + radius)).alias("frame_index")).distinct()
    free = pool.join(near, [*keys, "frame_index"], "left_anti")
    w = Window.partitionBy(*keys).orderBy("frame_index")
    return free.withColumn("_t_r", F.row_number().over(w)).where(F.col("_t_r") <= count).drop("_t_r")


def review_item_id(*parts) -> Column:
    """A stable id: the first 16 hex digits of the SHA-256 of the parts joined by a colon."""
    return F.substring(F.sha2(F.concat_ws(":", *(F.col(p).cast("string") if isinstance(p, str) else p.cast("string") for p in parts)), 256), 1, 16)


def reviewed_action(status: Column, action: Column, original: Column) -> Column:
    """Planning action of a reviewed issue: approved ones keep theirs, modified ones take the new one (quarantine splits)."""
    chosen = F.when(status == "modified", F.coalesce(action, original)).otherwise(original)
    return F.when(chosen == "quarantine", "split").otherwise(chosen)


def review_queue(df: DataFrame, confidence: str = "confidence", decision: str = "decision", least: float = 0.7) -> DataFrame:
    """Results to be reviewed: inconsistent, or not confident enough."""
    return df.where((F.col(decision) == "inconsistent") | (F.col(confidence) < least))
