"""Clock checks of streams: gaps, rollbacks, duplicates, continuity groups (timestamps are nanoseconds, BIGINT)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.numbers import half_even, truncated
from tessera.operators.sequence import previous, running_sum

SECOND = 1_000_000_000


def deltas(df: DataFrame, keys: list[str], order: str, ts: str, slice_rows: int | None = None) -> DataFrame:
    """``df`` with prev_<ts> and delta_ns; null on a stream's first row.  Rows are never sorted by time."""
    return previous(df, keys, order, [ts], slice_rows).withColumn("delta_ns", F.col(ts) - F.col(f"prev_{ts}"))


def distinct_times(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """The streams' distinct times with their place by time (from 0)."""
    return df.select(*keys, ts).distinct().withColumn("sample_index", (F.row_number().over(Window.partitionBy(*keys).orderBy(ts)) - 1).cast("bigint"))


def median_delta(with_deltas: DataFrame, keys: list[str]) -> DataFrame:
    """The exact median of the positive deltas of each stream (double)."""
    return with_deltas.groupBy(*keys).agg(F.median(F.when(F.col("delta_ns") > 0, F.col("delta_ns"))).alias("median_ns"))


def _missing(gap: Column, expected: Column) -> Column:
    return F.greatest(F.lit(0), half_even(gap / expected) - 1).cast("bigint")


def timestamp_gaps(df: DataFrame, keys: list[str], order: str, ts: str, expected_ns: int, factor: float = 2.0, split_ns: int = SECOND // 2, slice_rows: int | None = None) -> DataFrame:
    """Gaps of over int(expected * factor): split from ``split_ns`` on; frame_index is the later row's place."""
    d = deltas(df, keys, order, ts, slice_rows).where(F.col("delta_ns") > int(expected_ns * factor))
    split = F.col("delta_ns") >= split_ns
    return d.select(
        *keys, F.col(order).alias("frame_index"), F.col(f"prev_{ts}").alias("start_ns"), F.col(ts).alias("end_ns"), F.col("delta_ns").alias("gap_ns"),
        F.when(split, "error").otherwise("warning").alias("severity"), F.when(split, "split").otherwise("keep_with_flag").alias("decision"),
        _missing(F.col("delta_ns"), F.lit(expected_ns)).alias("estimated_missing"),
    )


def sensor_gaps(df: DataFrame, keys: list[str], ts: str, expected_ns: int, factor: float = 3.0, split_ns: int = SECOND, use_median: bool = True) -> DataFrame:
    """Gaps between distinct sorted times, over the larger of expected and median interval times the factor."""
    d = deltas(distinct_times(df, keys, ts), keys, "sample_index", ts)
    limit = F.lit(int(expected_ns * factor)).cast("bigint")
    if use_median:
        d = d.join(median_delta(d, keys).withColumnsRenamed({k: f"_t_{k}" for k in keys}), [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in keys])
        limit = F.greatest(limit, truncated(F.col("median_ns") * factor))
    split = F.col("delta_ns") >= split_ns
    return d.where(F.col("delta_ns") > limit).select(
        *keys, "sample_index", F.col(f"prev_{ts}").alias("start_ns"), F.col(ts).alias("end_ns"), F.col("delta_ns").alias("gap_ns"), limit.alias("threshold_ns"),
        F.when(split, "error").otherwise("warning").alias("severity"), F.when(split, "split").otherwise("keep_with_flag").alias("decision"),
        _missing(F.col("delta_ns"), F.lit(expected_ns)).alias("estimated_missing"),
    )


def short_and_long_gaps(df: DataFrame, keys: list[str], order: str, ts: str, short_ns: int, long_ns: int, slice_rows: int | None = None) -> DataFrame:
    """Positive deltas of at least ``short_ns`` (flag) or ``long_ns`` (split); sample_index is the earlier row's place."""
    long = F.col("delta_ns") >= long_ns
    return previous(df, keys, order, [ts, order], slice_rows).withColumn("delta_ns", F.col(ts) - F.col(f"prev_{ts}")).where((F.col("delta_ns") > 0) & (F.col("delta_ns") >= short_ns)).select(
        *keys, F.col(f"prev_{order}").alias("sample_index"), F.col(f"prev_{ts}").alias("start_ns"), F.col(ts).alias("end_ns"), F.col("delta_ns").alias("gap_ns"),
        F.when(long, "timeseries_long_gap").otherwise("timeseries_short_gap").alias("issue_type"), F.when(long, "error").otherwise("warning").alias("severity"),
        F.when(long, "split").otherwise("keep_with_flag").alias("decision"),
    )


def continuity(df: DataFrame, keys: list[str], order: str, ts: str, minimum_gap_ns: int = SECOND // 2, factor: float = 10.0, slice_rows: int | None = None) -> DataFrame:
    """``df`` with delta_ns (0 first), gap_threshold_ns, continuity_group and continuity_start_reason; source order is kept.

    The threshold is the larger of the minimum and int(int(median positive delta) * factor).
    """
    d = deltas(df, keys, order, ts, slice_rows)
    limit = median_delta(d, keys).select(*(F.col(k).alias(f"_t_{k}") for k in keys), F.greatest(F.lit(minimum_gap_ns).cast("bigint"), F.coalesce(truncated(truncated(F.col("median_ns")) * F.lit(float(factor))), F.lit(0))).alias("gap_threshold_ns"))
    d = d.join(limit, [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in keys]).drop(*(f"_t_{k}" for k in keys))
    x = F.col("delta_ns")
    reason = F.when(x.isNull(), "stream_start").when(x < 0, "timestamp_rollback").when(x == 0, "timestamp_duplicate").when(x > F.col("gap_threshold_ns"), "timestamp_gap").otherwise("")
    d = d.withColumn("continuity_start_reason", reason).withColumn("delta_ns", F.coalesce(x, F.lit(0)))
    breaks = F.when(F.col("continuity_start_reason").isin("", "stream_start"), 0).otherwise(1)
    return running_sum(d, keys, order, breaks, "continuity_group", slice_rows).drop(f"prev_{ts}")


def continuity_summary(groups: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """One row per stream over ``continuity``'s rows."""
    reason = lambda r: F.count_if(F.col("continuity_start_reason") == r)
    return groups.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sample_count"), (F.max("continuity_group") + 1).cast("bigint").alias("group_count"), reason("timestamp_duplicate").alias("duplicate_count"),
        reason("timestamp_rollback").alias("rollback_count"), F.count_if(F.col("delta_ns") > F.col("gap_threshold_ns")).alias("long_gap_count"), F.max("gap_threshold_ns").alias("gap_threshold_ns"),
    )


def continuity_issues(groups: DataFrame, keys: list[str], ts: str, order: str) -> DataFrame:
    """The breaks as issues: rollbacks are critical splits, duplicates warnings at one instant, gaps errors that split."""
    r = F.col("continuity_start_reason")
    return groups.where(r.isin("timestamp_rollback", "timestamp_duplicate", "timestamp_gap")).select(
        *keys, F.col(order).alias("sample_index"), r.alias("issue_type"), F.when(r == "timestamp_duplicate", F.col(ts)).otherwise(F.col(ts) - F.col("delta_ns")).alias("start_ns"), F.col(ts).alias("end_ns"),
        F.when(r == "timestamp_rollback", "critical").when(r == "timestamp_gap", "error").otherwise("warning").alias("severity"),
        F.when(r == "timestamp_duplicate", "keep_with_flag").otherwise("split").alias("decision"),
    )


def pose_continuity(df: DataFrame, keys: list[str], order: str, ts: str, frame: str, quaternion: list[str], minimum_gap_ns: int = SECOND // 2, slice_rows: int | None = None) -> DataFrame:
    """``df`` with continuity_group and reason: non-increasing time, gap, frame change, invalid quaternion, in that order.

    Every row with a quaternion that isn't finite or is shorter than 1e-12 starts a group.
    """
    d = previous(df, keys, order, [ts, frame], slice_rows).withColumn("delta_ns", F.col(ts) - F.col(f"prev_{ts}"))
    limit = median_delta(d, keys).select(*(F.col(k).alias(f"_t_{k}") for k in keys), F.greatest(F.lit(minimum_gap_ns).cast("bigint"), F.coalesce(truncated(F.col("median_ns") * 10), F.lit(0))).alias("gap_threshold_ns"))
    d = d.join(limit, [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in keys]).drop(*(f"_t_{k}" for k in keys))
    norm = F.sqrt(sum((F.col(q) * F.col(q) for q in quaternion), F.lit(0.0)))
    bad = F.coalesce(F.isnan(norm) | (norm == float("inf")) | (norm < 1e-12), F.lit(True))
    x = F.col("delta_ns")
    reason = F.when(x.isNull(), "segment_start").when(x <= 0, "timestamp_non_increasing").when(x > F.col("gap_threshold_ns"), "timestamp_gap").when(~F.col(frame).eqNullSafe(F.col(f"prev_{frame}")), "reference_frame_change").when(bad, "invalid_quaternion").otherwise("")
    d = d.withColumn("continuity_start_reason", reason)
    breaks = F.when(F.col("continuity_start_reason").isin("", "segment_start"), 0).otherwise(1)
    return running_sum(d, keys, order, breaks, "continuity_group", slice_rows).drop(f"prev_{ts}", f"prev_{frame}")


def clock_report(df: DataFrame, keys: list[str], order: str, ts: str, factor: float = 3.0, nominal_ns: int | None = None) -> DataFrame:
    """Per stream: duplicates (excess rows of equal times), regressions in row order, gaps between distinct times."""
    dup = df.groupBy(*keys, ts).agg(F.count(F.lit(1)).alias("n")).groupBy(*keys).agg(F.sum(F.col("n") - 1).alias("duplicate_count"), F.count_if(F.col("n") > 1).alias("duplicated_times"), F.sum("n").alias("sample_count"))
    back = deltas(df, keys, order, ts).groupBy(*keys).agg(F.count_if(F.col("delta_ns") < 0).alias("regression_count"))
    d = deltas(distinct_times(df, keys, ts), keys, "sample_index", ts)
    m = median_delta(d, keys)
    expected = F.lit(nominal_ns).cast("bigint") if nominal_ns else truncated(F.col("median_ns"))
    gaps = d.join(m, keys).groupBy(*keys).agg(F.max(truncated(F.col("median_ns"))).alias("median_interval_ns"), F.count_if(F.col("delta_ns") > expected * factor).alias("gap_count"), F.coalesce(F.sum(F.when(F.col("delta_ns") > expected * factor, F.col("delta_ns"))), F.lit(0)).alias("gap_total_ns"))
    return dup.join(back, keys).join(gaps, keys)


def frame_gaps(df: DataFrame, keys: list[str], order: str, ts: str, index: str, method: str, short_ns: int, long_ns: int) -> DataFrame:
    """Camera gaps over frames whose method isn't pending and whose time is known: filtered before deltas are taken."""
    valid = df.where((F.col(method) != "pending_alignment") & F.col(ts).isNotNull())
    d = previous(valid, keys, order, [ts, index]).withColumn("gap_ns", F.col(ts) - F.col(f"prev_{ts}"))
    return d.where((F.col("gap_ns") > 0) & (F.col("gap_ns") >= short_ns)).select(*keys, F.col(f"prev_{index}").alias("frame_index"), "gap_ns", (F.col(index) - F.col(f"prev_{index}") - 1).alias("frames_skipped"), F.when(F.col("gap_ns") >= long_ns, "split").otherwise("keep_with_flag").alias("decision"))


def audio_gaps(df: DataFrame, keys: list[str], order: str, ts: str, expected_s: float = 0.02, factor: float = 2.5, least_s: float = 0.2) -> DataFrame:
    """Packet gaps of over int(expected * factor) and at least ``least_s`` seconds."""
    d = previous(df, keys, order, [ts, order]).withColumn("gap_ns", F.col(ts) - F.col(f"prev_{ts}"))
    return d.where((F.col("gap_ns") > int(int(expected_s * 1e9) * factor)) & (F.col("gap_ns") / 1e9 >= least_s)).select(*keys, F.col(f"prev_{order}").alias("packet_a"), F.col(order).alias("packet_b"), F.col(f"prev_{ts}").alias("start_ns"), F.col(ts).alias("end_ns"), "gap_ns")
