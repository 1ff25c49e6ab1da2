"""Checks of produced tables: each gives counts of violations, 0 where all is well."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.sequence import previous


def violations(df: DataFrame, rules: dict[str, Column], keys: list[str] = ()) -> DataFrame:
    """Per key: rows, and for each rule how many rows don't hold it (null counts as not)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *(F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()))


def strictly_increasing(df: DataFrame, keys: list[str], order: str, columns: list[str]) -> DataFrame:
    """Per key: steps at which a column doesn't increase."""
    p = previous(df, keys, order, columns)
    return p.groupBy(*keys).agg(*(F.count_if(F.col(c) <= F.col(f"prev_{c}")).alias(f"not_increasing_{c}") for c in columns))


def no_overlap(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Per key: empty or reversed intervals, and those that the next one starts inside of."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    n = df.withColumn("_t_n", F.lead(start).over(w))
    return n.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(start) >= F.col(end)).alias("reversed"), F.count_if(F.col("_t_n") < F.col(end)).alias("overlapping"))


def dangling(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child keys, not null, that the parent lacks, with their rows."""
    return child.where(F.col(child_key).isNotNull()).join(parent.select(F.col(parent_key).alias(child_key)).distinct(), child_key, "left_anti").groupBy(child_key).agg(F.count(F.lit(1)).alias("rows"))


def coverage_of(expected: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """One row: expected, found, missing, unexpected and repeated keys."""
    e = expected.select(*keys).distinct().withColumn("_t_e", F.lit(1))
    f = found.groupBy(*keys).agg(F.count(F.lit(1)).alias("_t_f"))
    both = e.join(f, keys, "full")
    return both.agg(F.count("_t_e").alias("expected"), F.count("_t_f").alias("found"), F.count_if(F.col("_t_f").isNull()).alias("missing"), F.count_if(F.col("_t_e").isNull()).alias("unexpected"), F.count_if(F.col("_t_f") > 1).alias("repeated"))


def continuity_holds(df: DataFrame, keys: list[str], order: str, group: str, ts: str, recomputed: str) -> DataFrame:
    """Per key: a first group that isn't 0, steps other than 0 or 1, times that don't increase inside a group, rows whose
    group isn't the recomputed one."""
    p = previous(df, keys, order, [group, ts])
    step = F.col(group) - F.col(f"prev_{group}")
    return p.groupBy(*keys).agg(
        F.count_if(F.col(f"prev_{group}").isNull() & (F.col(group) != 0)).alias("bad_start"), F.count_if(~step.isin(0, 1)).alias("bad_step"),
        F.count_if((step == 0) & (F.col(ts) <= F.col(f"prev_{ts}"))).alias("bad_time"), F.count_if(F.col(group) != F.col(recomputed)).alias("not_recomputed"),
    )


def index_reliability(df: DataFrame, keys: list[str], order: str, index: str, ts: str, fps: float, most_ns: float = 5_000_000) -> DataFrame:
    """Per key: mean of |time step - index step / fps|, and whether it is under ``most_ns``."""
    p = previous(df, keys, order, [index, ts])
    error = F.abs((F.col(ts) - F.col(f"prev_{ts}")) - (F.col(index) - F.col(f"prev_{index}")) * (1e9 / fps))
    return p.groupBy(*keys).agg(F.bround(F.avg(error), 3).alias("mean_error_ns"), F.coalesce(F.avg(error) < most_ns, F.lit(False)).alias("reliable"))


def frame_count_off(df: DataFrame, frames: str, duration_s: str, fps: float, most: int = 2) -> DataFrame:
    """Rows whose frames are off round(duration * fps) by over ``most``."""
    return df.withColumn("expected_frames", F.bround(F.col(duration_s) * fps, 0).cast("bigint")).where(F.abs(F.col(frames) - F.col("expected_frames")) > most)


def same_rows(a: DataFrame, b: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """One row: rows of each side, keys only one side has, keys whose columns differ (nulls equal each other)."""
    x = a.select(*keys, F.struct(*columns).alias("_t_a"))
    y = b.select(*keys, F.struct(*columns).alias("_t_b"))
    j = x.join(y, keys, "full")
    one = F.count_if(F.col("_t_a").isNull() | F.col("_t_b").isNull())
    return j.agg(F.count("_t_a").alias("left_rows"), F.count("_t_b").alias("right_rows"), one.alias("one_sided"), F.count_if(F.col("_t_a").isNotNull() & F.col("_t_b").isNotNull() & ~F.col("_t_a").eqNullSafe(F.col("_t_b"))).alias("different"))


def calibration(df: DataFrame, models: list[str], most_px: int = 10) -> dict[str, Column]:
    """Rules for ``violations`` over camera rows."""
    return {
        "bad_focal": (F.col("fx") > 0) & (F.col("fy") > 0), "bad_center": (F.col("cx") > 0) & (F.col("cy") > 0), "unknown_model": F.col("model").isin(*models),
        "bad_size": (F.abs(F.col("width") - F.col("video_width")) <= most_px) & (F.abs(F.col("height") - F.col("video_height")) <= most_px),
    }
