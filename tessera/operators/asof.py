"""Nearest-in-time pairing without a range join: one exchange, two windows.

Left and right rows are laid along one time axis per key; each left row sees the last right row before and the first right
row after it, and takes the nearer.  Right rows at the same time count as one (the smallest index, or the largest for the
later-row rule).  ``tie`` says who wins at equal distance: ``earlier`` or ``later``.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.numbers import truncated
from tessera.operators.sequence import true_runs


def nearest(left: DataFrame, right: DataFrame, keys: list[str], left_ts: str, right_ts: str, right_index: str, tie: str = "earlier", slice_ns: int | None = None) -> DataFrame:
    """``left`` with match_ts, match_index and offset_ns (match - left); nulls where the key has no right row.

    ``slice_ns`` cuts each key's axis into stretches of that long, for keys that hold a large part of all rows: rows meet within a
    stretch, and a table with one row per stretch carries the last right row before and the first after it over.
    """
    if tie not in ("earlier", "later"):
        raise ValueError(f"tie: {tie}")
    own = left.columns
    one = right.where(F.col(right_ts).isNotNull()).groupBy(*keys, F.col(right_ts).alias("_t_ts")).agg(F.min(right_index).alias("_t_low"), F.max(right_index).alias("_t_high"))
    rows = left.select(*keys, F.col(left_ts).alias("_t_ts"), F.lit(1).alias("_t_side"), F.struct(*own).alias("_t_row"))
    marks = one.select(*keys, "_t_ts", F.lit(0).alias("_t_side"), F.struct("_t_ts", "_t_low", "_t_high").alias("_t_mark"))
    both = rows.unionByName(marks, allowMissingColumns=True)
    by = list(keys)
    if slice_ns is not None:
        both = both.withColumn("_t_slice", F.floor(F.col("_t_ts") / slice_ns))
        by.append("_t_slice")
    before = Window.partitionBy(*by).orderBy("_t_ts", "_t_side").rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy(*by).orderBy(F.desc("_t_ts"), F.desc("_t_side")).rowsBetween(Window.unboundedPreceding, -1)
    seen = both.withColumns({"_t_prev": F.last("_t_mark", ignorenulls=True).over(before), "_t_next": F.last("_t_mark", ignorenulls=True).over(after)}).where("_t_side = 1")
    if slice_ns is not None:
        ends = both.groupBy(*by).agg(F.min("_t_mark").alias("_t_first"), F.max("_t_mark").alias("_t_last"))  # marks sort by time
        w = Window.partitionBy(*keys).orderBy("_t_slice")
        carry = ends.select(*(F.col(k).alias(f"_t_k_{k}") for k in by), F.last("_t_last", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("_t_past"), F.first("_t_first", ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)).alias("_t_future"))
        same = reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col(f"_t_k_{k}")) for k in by))
        seen = seen.join(carry, same).withColumns({"_t_prev": F.coalesce("_t_prev", "_t_past"), "_t_next": F.coalesce("_t_next", "_t_future")})
    back, ahead = F.col("_t_ts") - F.col("_t_prev._t_ts"), F.col("_t_next._t_ts") - F.col("_t_ts")
    nearer = back <= ahead if tie == "earlier" else (back < ahead) | (back == 0)
    use_prev = F.col("_t_next").isNull() | (F.col("_t_prev").isNotNull() & nearer)
    # the binary-search rule takes the first of equal times when they are at or after the left time, the last when before
    index = lambda m, last: F.col(f"{m}._t_high") if last else F.col(f"{m}._t_low")
    prev_index = F.when(back == 0, index("_t_prev", False)).otherwise(index("_t_prev", tie == "later"))
    out = seen.select("_t_row.*", F.when(F.col("_t_ts").isNull(), F.lit(None)).when(use_prev, F.col("_t_prev._t_ts")).otherwise(F.col("_t_next._t_ts")).alias("match_ts"), F.when(F.col("_t_ts").isNull(), F.lit(None)).when(use_prev, prev_index).otherwise(index("_t_next", False)).alias("match_index"))
    return out.withColumn("offset_ns", F.col("match_ts") - F.col(left_ts))


def grid(spans: DataFrame, start: str, end: str, fps: float, image: bool = False) -> DataFrame:
    """A row per output frame of each span: output_frame_index, output_timestamp_ns, target_ns.

    Steps are int(1e9 / fps); frames run while they start before the end, or, for images, max(1, int(duration / step)).
    """
    step = int(1_000_000_000 / fps)
    length = F.col(end) - F.col(start)
    n = F.greatest(F.lit(1).cast("bigint"), truncated(F.floor(length / step))) if image else truncated(F.ceil(length / step))
    frames = spans.withColumn("_t_n", n).where("_t_n > 0")
    out = frames.withColumn("output_frame_index", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_t_n") - 1))).drop("_t_n")
    return out.withColumn("output_timestamp_ns", F.col("output_frame_index") * step).withColumn("target_ns", F.col(start) + F.col("output_timestamp_ns"))


def sample_map(frames: DataFrame, spans: DataFrame, keys: list[str], ts: str, index: str, start: str, end: str, fps: float = 30.0, image: bool = False) -> DataFrame:
    """The nearest source frame within each (closed) span for each output frame; ties go to the earlier frame.

    ``spans`` has one row per key; spans without any frame give no rows.
    """
    within = frames.join(spans.select(*keys, start, end), keys).where((F.col(ts) >= F.col(start)) & (F.col(ts) <= F.col(end))).drop(start, end)
    found = nearest(grid(spans, start, end, fps, image), within, keys, "target_ns", ts, index).where("match_ts is not null")
    return found.select(*keys, "output_frame_index", "output_timestamp_ns", F.col("match_index").alias("source_frame_index"), F.col("match_ts").alias("source_timestamp_ns"), F.lit("nearest").alias("mapping_method"), F.col("offset_ns").alias("time_error_ns"))


def pairing(left: DataFrame, right: DataFrame, keys: list[str], ts: str, index: str, most_ns: int, slice_ns: int | None = None) -> DataFrame:
    """``left`` rows with their nearest ``right`` row and ``paired``: within ``most_ns``."""
    return nearest(left, right, keys, ts, ts, index, slice_ns=slice_ns).withColumn("paired", F.coalesce(F.abs("offset_ns") <= most_ns, F.lit(False)))


def pairing_summary(pairs: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: pairs, rows of each side, the ratio to the smaller side (at most 1), percentiles of the absolute offsets."""
    off = F.when(F.col("paired"), F.abs("offset_ns"))
    of = pairs.groupBy(*keys).agg(F.count_if("paired").alias("paired_count"), F.count(F.lit(1)).alias("left_count"), F.percentile(off, 0.5).alias("offset_p50"), F.percentile(off, 0.95).alias("offset_p95"), F.max(off).alias("offset_max"))
    n = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("right_count"))
    both = of.join(n, keys, "left").na.fill(0, ["right_count"])
    return both.withColumn("paired_ratio", F.least(F.lit(1.0), F.col("paired_count") / F.greatest(F.least("left_count", "right_count"), F.lit(1))))


def unpaired_spans(pairs: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Runs of rows without a partner: first and last place."""
    marked = true_runs(pairs.withColumn("_t_free", ~F.col("paired")), keys, order, "_t_free")
    return marked.groupBy(*keys, "run_id").agg(F.min(order).alias("first_index"), F.max(order).alias("last_index")).drop("run_id")


def default_tolerance(left: DataFrame, right: DataFrame, keys: list[str], ts: str, index: str) -> DataFrame:
    """Per key twice the larger of both sides' int(median positive interval); 100 ms where neither has one."""
    w = Window.partitionBy(*keys, "_t_side").orderBy(index)
    both = left.select(*keys, ts, index, F.lit(0).alias("_t_side")).unionByName(right.select(*keys, ts, index, F.lit(1).alias("_t_side")))
    d = both.withColumn("_t_d", F.col(ts) - F.lag(ts).over(w))
    m = d.groupBy(*keys, "_t_side").agg(truncated(F.median(F.when(F.col("_t_d") > 0, F.col("_t_d")))).alias("_t_m"))
    return m.groupBy(*keys).agg((F.coalesce(F.max("_t_m"), F.lit(50_000_000).cast("bigint")) * 2).alias("tolerance_ns"))


def dual_alignment(left: DataFrame, right: DataFrame, keys: list[str], ts: str, index: str, group: str, tolerance_ns: int | None = None, method: str = "inferred") -> DataFrame:
    """Nearest right row within right continuity groups that overlap the left row's group in time, and the tolerance.

    Groups are few against rows: each left group is paired with the right groups it overlaps (closed ranges), the pairing
    is done per such pair, and the best of a row's pairs stays (ties: the smaller right index).
    """
    bounds = lambda df, p: df.groupBy(*keys, F.col(group).alias(f"_t_{p}g")).agg(F.min(ts).alias(f"_t_{p}0"), F.max(ts).alias(f"_t_{p}1"))
    meet = bounds(left, "l").join(bounds(right, "r"), keys).where("greatest(_t_l0, _t_r0) <= least(_t_l1, _t_r1)").select(*keys, "_t_lg", "_t_rg")
    lefts = left.withColumn("_t_lg", F.col(group)).join(meet, [*keys, "_t_lg"], "left")
    rights = right.withColumn("_t_rg", F.col(group))
    paired = nearest(lefts, rights, [*keys, "_t_rg"], ts, ts, index)
    best = paired.groupBy(*keys, index).agg(F.first(ts).alias("ts"), F.first(group).alias("grp"), F.min(F.when(F.col("match_index").isNotNull(), F.struct(F.abs("offset_ns").alias("d"), F.col("match_index").alias("i"), F.col("match_ts").alias("t"), F.col("_t_rg").alias("g"), F.col("offset_ns").alias("o")))).alias("b"))
    if tolerance_ns is None:
        best = best.join(default_tolerance(left, right, keys, ts, index), keys, "left").withColumn("tolerance_ns", F.coalesce("tolerance_ns", F.lit(100_000_000).cast("bigint")))
    else:
        best = best.withColumn("tolerance_ns", F.lit(tolerance_ns).cast("bigint"))
    ok = F.coalesce(F.col("b.d") <= F.col("tolerance_ns"), F.lit(False))
    return best.select(
        *keys, F.col(index).alias("left_index"), F.col("ts").alias("left_ts"), F.col("grp").alias("left_group"), F.when(ok, F.col("b.i")).alias("right_index"), F.when(ok, F.col("b.t")).alias("right_ts"),
        F.when(ok, F.col("b.g")).alias("right_group"), F.when(ok, F.col("b.o")).alias("residual_ns"), F.when(ok, method).otherwise("unavailable").alias("mapping_method"), F.col("tolerance_ns").alias("uncertainty_ns"),
    )


def dual_summary(alignment: DataFrame, keys: list[str]) -> DataFrame:
    r = F.abs("residual_ns")
    return alignment.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("left_count"), F.count("residual_ns").alias("mapped_count"), F.bround(F.count("residual_ns") / F.count(F.lit(1)), 6).alias("mapped_ratio"),
        truncated(F.percentile(r, 0.5)).alias("residual_p50_ns"), truncated(F.percentile(r, 0.95)).alias("residual_p95_ns"), F.max(r).alias("residual_max_ns"),
    )


def camera_rows(cameras: DataFrame, rows: DataFrame, keys: list[str], camera_ts: str, row_ts: str, row_index: str) -> DataFrame:
    """Nearest row by binary search over sorted rows, a tie going to the later row; unknown camera times stay unavailable."""
    valid = F.coalesce(F.col(camera_ts) > 0, F.lit(False))
    found = nearest(cameras.withColumn("_t_at", F.when(valid, F.col(camera_ts))), rows, keys, "_t_at", row_ts, row_index, tie="later")
    return found.withColumn("alignment_error_ns", F.abs("offset_ns")).withColumn("mapping_method", F.when(F.col("match_index").isNotNull(), "nearest_row").otherwise("unavailable")).drop("_t_at", "offset_ns").withColumnsRenamed({"match_index": "row_index", "match_ts": "row_timestamp_ns"})


def error_profile(alignment: DataFrame, keys: list[str], error: str, index: str) -> DataFrame:
    """Per key: mean, max, p95, p99 of the absolute error, the row of the maximum (smallest index at ties), missing rows."""
    e = F.abs(F.col(error))
    return alignment.groupBy(*keys).agg(F.avg(e).alias("mean_error"), F.max(e).alias("max_error"), F.percentile(e, 0.95).alias("p95_error"), F.percentile(e, 0.99).alias("p99_error"), F.max_by(index, F.struct(e, -F.col(index))).alias("worst_index"), F.count_if(e.isNull()).alias("unavailable"))


def delay_profile(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Signed mean and median of the offsets, p95, p99, max and mean of their absolute values."""
    o, a = F.col("offset_ns"), F.abs("offset_ns")
    one = lambda c: F.bround(c, 1)
    return pairs.where(o.isNotNull()).groupBy(*keys).agg(F.count(o).alias("count"), one(F.avg(o)).alias("mean_ns"), one(F.median(o)).alias("median_ns"), one(F.percentile(a, 0.95)).alias("p95_ns"), one(F.percentile(a, 0.99)).alias("p99_ns"), F.max(a).alias("max_abs_ns"))


def positional(left: DataFrame, right: DataFrame, keys: list[str], left_index: str, right_index: str, columns: list[str]) -> DataFrame:
    """Rows paired by place; places that the right side lacks are ``unavailable``."""
    r = right.select(*keys, F.col(right_index).alias(left_index), *columns, F.lit(True).alias("_t_hit"))
    return left.join(r, [*keys, left_index], "left").withColumn("mapping_method", F.when(F.col("_t_hit"), "index").otherwise("unavailable")).drop("_t_hit")


#: Places that one task's arrays of a signal hold at least.
STRETCH = 4096


def cross_correlation(a: DataFrame, b: DataFrame, keys: list[str], index: str, value: str, most: int = 50, rows: int | None = 500) -> DataFrame:
    """Per key the lag in [-most, most] whose cross-correlation of the demeaned signals is largest in size.

    Positive lags: ``a`` follows ``b``.  The first ``rows`` rows of each signal take part, as the estimate is defined;
    ties go to the smallest lag.  Signals are cut into stretches of places; a row of ``b`` goes to the one or two stretches
    that it meets within the lags, and each stretch gives a sum per lag, so no row is repeated for every lag.
    """
    side = lambda df, n: df.select(*keys, F.lit(n).alias("_t_side"), F.col(index).cast("bigint").alias("_t_i"), F.col(value).cast("double").alias("_t_v"))
    both = side(a, 0).unionByName(side(b, 1)).where(F.col("_t_i").isNotNull())
    if rows is not None:
        both = both.where(F.col("_t_i") < rows)
    least = F.least(F.count_if(F.col("_t_side") == 0), F.count_if(F.col("_t_side") == 1))
    n = both.groupBy(*keys).agg(least.alias("_t_n")).where("_t_n > 0")
    short = both.join(n, keys).where("_t_i < _t_n").drop("_t_n")
    means = short.groupBy(*keys).agg(*(F.avg(F.when(F.col("_t_side") == x, F.col("_t_v"))).alias(f"_t_m{x}") for x in (0, 1)))
    centred = short.join(means, keys).select(*keys, "_t_side", "_t_i", (F.col("_t_v") - F.when(F.col("_t_side") == 0, F.col("_t_m0")).otherwise(F.col("_t_m1"))).alias("_t_v"))
    wide = max(STRETCH, 2 * most)
    # a's place i lies in stretch (i + most) // wide, so that all of b that it meets, i - most to i + most, lies in those of i to i + 2 * most
    first, last = (F.floor((F.col("_t_i") + F.when(F.col("_t_side") == 0, most).otherwise(x)) / wide) for x in (0, 2 * most))
    placed = centred.withColumn("_t_s", F.explode(F.sequence(first, last)))
    grouped = placed.groupBy(*keys, "_t_s").agg(F.collect_list(F.struct("_t_side", "_t_i", "_t_v")).alias("_t_rows")).where(F.exists("_t_rows", lambda x: x["_t_side"] == 0) & F.exists("_t_rows", lambda x: x["_t_side"] == 1))
    schema = T.StructType([*(grouped.schema[k] for k in keys), T.StructField("lag", T.IntegerType()), T.StructField("_t_s", T.DoubleType())])

    def run(batches):
        for batch in batches:
            found, held = batch.column(len(keys) + 1), []
            cuts, flat = found.offsets.to_numpy(), found.values
            parts = flat.field(0).to_numpy(), flat.field(1).to_numpy(), flat.field(2).to_numpy(zero_copy_only=False), flat.field(2).is_valid().to_numpy(zero_copy_only=False)
            for r, stretch in enumerate(batch.column(len(keys)).to_pylist()):
                lags, sums = _lagged_sums(*(x[cuts[r] : cuts[r + 1]] for x in parts), stretch * wide - most, wide, most)
                held.append((np.full(len(lags), r), lags, sums))
            if held:
                at, lags, sums = (np.concatenate(x) for x in zip(*held, strict=True))
                at = pa.array(at)
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in range(len(keys))), pa.array(lags, pa.int32()), pa.array(sums.filled(0.0), pa.float64(), mask=np.ma.getmaskarray(sums))], names=schema.names)

    sums = grouped.select(*keys, "_t_s", "_t_rows").mapInArrow(run, schema).groupBy(*keys, "lag").agg(F.sum("_t_s").alias("_t_s"))
    peak = sums.groupBy(*keys).agg(F.max_by(F.struct("lag", "_t_s"), F.struct(F.bround(F.abs("_t_s"), 6), -F.col("lag"))).alias("p"))
    return peak.select(*keys, F.col("p.lag").cast("bigint").alias("lag_samples"), F.col("p._t_s").alias("correlation_peak"))


def _lagged_sums(side: np.ndarray, place: np.ndarray, value: np.ndarray, known: np.ndarray, low: int, wide: int, most: int) -> tuple[np.ndarray, np.ma.MaskedArray]:
    """(lags at which any rows meet, the sums of their products): a's places from ``low`` on, b's from ``low - most``.

    Products without a value don't count; a lag that has no others has no sum.
    """
    def laid(n: int, start: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        own = side == n
        at, v, k = place[own] - start, value[own], known[own]
        return np.bincount(at, minlength=size).astype(float), np.bincount(at[k], minlength=size).astype(float), np.bincount(at[k], v[k], size)

    size = min(wide, int(place[side == 0].max()) - low + 1)
    near = (side == 0) | (place < low + size + most)
    side, place, value, known = side[near], place[near], value[near], known[near]
    (rows_a, known_a, a), (rows_b, known_b, b) = laid(0, low, size), laid(1, low - most, size + 2 * most)
    over = lambda x, y: np.correlate(y, x, "valid")[::-1]
    meet, sums, any_known = over(rows_a, rows_b) > 0, over(a, b), over(known_a, known_b) > 0
    if not np.isfinite(sums).all():  # nothing but rows that meet may spread what isn't a number
        for j in range(2 * most + 1):
            of = slice(2 * most - j, 2 * most - j + size)
            use = (known_a > 0) & (known_b[of] > 0)
            sums[j] = (a[use] * b[of][use]).sum()
    lags = np.flatnonzero(meet)
    return (lags - most).astype(np.int32), np.ma.masked_array(sums[lags], ~any_known[lags])
