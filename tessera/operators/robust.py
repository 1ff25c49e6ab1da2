"""Outliers by median and MAD, local scores, profiles of values."""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.numbers import finite

EPS = sys.float_info.epsilon


def center_and_spread(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per key: n, median, mad, std (population) of the finite values; two exact passes."""
    good = df.where(finite(value)).select(*keys, F.col(value).cast("double").alias("_t_v"))
    middle = good.groupBy(*keys).agg(F.median("_t_v").alias("median"), F.stddev_pop("_t_v").alias("std"), F.count(F.lit(1)).alias("n"))
    return good.join(middle, keys).groupBy(*keys, "median", "std", "n").agg(F.median(F.abs(F.col("_t_v") - F.col("median"))).alias("mad"))


def spikes(df: DataFrame, keys: list[str], value: str, factor: float, zero_mad: str = "std") -> DataFrame:
    """Finite rows over ``factor`` raw MADs off the median, with median and scale.

    A zero MAD: ``std`` falls back to the standard deviation and then 1e-6; ``skip`` leaves the key out and divides by
    MAD + 1e-12.
    """
    stats = center_and_spread(df, keys, value)
    if zero_mad == "std":
        stats = stats.withColumn("scale", F.when(F.col("mad") != 0, F.col("mad")).when(F.col("std") != 0, F.col("std")).otherwise(1e-6))
        over = F.abs(F.col(value) - F.col("median")) > factor * F.col("scale")
    elif zero_mad == "skip":
        stats = stats.where("mad <> 0").withColumn("scale", F.col("mad"))
        over = F.abs(F.col(value) - F.col("median")) / (F.col("scale") + 1e-12) > factor
    else:
        raise ValueError(f"zero_mad: {zero_mad}")
    return df.where(finite(value)).join(stats.select(*keys, "median", "scale"), keys).where(over)


def range_candidates(df: DataFrame, keys: list[str], value: str, factor: float = 10.0, least: int = 5) -> DataFrame:
    """Finite rows over ``factor`` MADs off the median, where there are ``least`` values and the MAD isn't zero."""
    stats = center_and_spread(df, keys, value).where((F.col("n") >= least) & (F.col("mad") > 0))
    return df.where(finite(value)).join(stats.select(*keys, "median", "mad"), keys).where(F.abs(F.col(value) - F.col("median")) > factor * F.col("mad"))


def step_outliers(df: DataFrame, keys: list[str], step: str, factor: float = 10.0, least: int = 4) -> DataFrame:
    """Rows whose step is over median + ``factor`` * max(MAD, eps), one-sided, where there are ``least`` finite steps."""
    stats = center_and_spread(df, keys, step).where(F.col("n") >= least).withColumn("threshold", F.col("median") + factor * F.greatest(F.col("mad"), F.lit(EPS)))
    return df.where(finite(step)).join(stats.select(*keys, "threshold"), keys).where(F.col(step) > F.col("threshold"))


def euclidean(columns: list[str], prefix: str = "prev_") -> Column:
    """The length of the step from the previous row's columns."""
    return F.sqrt(sum(((F.col(c) - F.col(prefix + c)) * (F.col(c) - F.col(prefix + c)) for c in columns), F.lit(0.0)))


def static_bias(df: DataFrame, keys: list[str], accel: list[str], gyro: list[str], least: int = 10) -> DataFrame:
    """Per key over still rows (|accel| within 0.5 of 9.81, |gyro| under 0.05, all finite): rows, means and deviations.

    Keys with under ``least`` such rows come back with their number and nulls.
    """
    size = lambda cs: F.sqrt(sum((F.col(c) * F.col(c) for c in cs), F.lit(0.0)))
    ok = finite(accel[0])
    for c in [*accel[1:], *gyro]:
        ok = ok & finite(c)
    still = ok & (F.abs(size(accel) - 9.81) < 0.5) & (size(gyro) < 0.05)
    enough = F.count_if(still) >= least
    means = [F.when(enough, f(F.when(still, F.col(c)))).alias(f"{n}_{c}") for c in [*accel, *gyro] for f, n in ((F.avg, "mean"), (F.stddev_pop, "std"))]
    return df.groupBy(*keys).agg(F.count_if(still).alias("static_samples"), *means, F.when(enough, F.avg(F.when(still, size(accel))) - 9.81).alias("gravity_bias"))


def saturation(df: DataFrame, keys: list[str], ranges: dict[str, float], part: float = 0.98) -> DataFrame:
    """Per key and column with a known range: values of at least ``part`` of it."""
    return df.groupBy(*keys).agg(*(F.count_if(finite(c) & (F.abs(F.col(c)) >= part * r)).alias(f"saturated_{c}") for c, r in ranges.items()))


def finite_profile(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Per key: elements, NaNs, infinities and the ratio of values that aren't finite."""
    nan = sum((F.count_if(F.isnan(F.col(c).cast("double")) | F.col(c).isNull()) for c in columns), F.lit(0))
    inf = sum((F.count_if(F.abs(F.col(c).cast("double")) == float("inf")) for c in columns), F.lit(0))
    total = F.count(F.lit(1)) * len(columns)
    out = df.groupBy(*keys).agg(total.alias("elements"), nan.alias("nan_count"), inf.alias("inf_count"))
    return out.withColumn("bad_ratio", (F.col("nan_count") + F.col("inf_count")) / F.col("elements"))


def distribution(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Count, min, mean, exact p50, p90, p95, p99 (interpolated) and max of the finite values."""
    q = [0.5, 0.9, 0.95, 0.99]
    good = df.where(finite(value)).withColumn("_t_v", F.col(value).cast("double"))
    out = good.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"), F.min("_t_v").alias("min"), F.avg("_t_v").alias("mean"), F.percentile("_t_v", q).alias("_t_q"), F.max("_t_v").alias("max"))
    return out.select(*keys, "count", "min", "mean", *(F.col("_t_q")[i].alias(f"p{int(x * 100)}") for i, x in enumerate(q)), "max")


def median_smooth(df: DataFrame, keys: list[str], order: str, value: str, name: str = "smoothed", window: int = 5) -> DataFrame:
    """Centred median over ``window`` (odd) rows; beyond the ends the end rows repeat."""
    half = window // 2
    w = Window.partitionBy(*keys).orderBy(order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = {-1: F.first(value).over(whole), 1: F.last(value).over(whole)}
    near = [F.col(value)] + [F.coalesce(F.lag(value, k).over(w), ends[-1]) for k in range(1, half + 1)] + [F.coalesce(F.lead(value, k).over(w), ends[1]) for k in range(1, half + 1)]
    return df.withColumn(name, F.array_sort(F.array(*near))[half])


def local_z(df: DataFrame, keys: list[str], order: str, value: str, name: str = "z", reach: int = 30, least: int = 3) -> DataFrame:
    """Distance from the mean of up to ``reach`` rows on each side, the own row excluded, in population deviations.

    Under ``least`` neighbours: 0.  A deviation of at most eps: the distance over eps where it is positive, else 0.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    near = F.concat(F.collect_list(value).over(w.rowsBetween(-reach, -1)), F.collect_list(value).over(w.rowsBetween(1, reach)))
    parts = df.withColumn("_t_near", near)
    n = F.size("_t_near")
    add = lambda f: F.aggregate("_t_near", F.lit(0.0), lambda s, x: s + f(x))
    parts = parts.withColumn("_t_mean", F.when(n > 0, add(lambda x: x) / n))
    parts = parts.withColumn("_t_std", F.when(n > 0, F.sqrt(add(lambda x: (x - F.col("_t_mean")) * (x - F.col("_t_mean"))) / n)))
    far = F.col(value) - F.col("_t_mean")
    z = F.when(n < least, 0.0).when(F.col("_t_std") > EPS, far / F.col("_t_std")).when(far > 0, far / EPS).otherwise(0.0)
    return parts.withColumn(name, z).drop("_t_near", "_t_mean", "_t_std")
