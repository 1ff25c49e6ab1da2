"""Pixel statistics: over arrays of pixels in Spark itself, and over raw frames (bytes, height, width) by Arrow batches."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.numbers import half_even
from tessera.operators.intervals import freeze_spans
from tessera.operators.quality import every_kth


def depth_stats(df: DataFrame, keys: list[str], pixels: str, invalid: int | None = None) -> DataFrame:
    """Per frame (array of pixels): zero, invalid and valid ratios, all_zero, and mean, deviation, least, most of valid pixels.

    Zero pixels are invalid, as are those of the ``invalid`` value; an empty frame is all invalid; no valid pixels give 0.
    """
    p, n = F.col(pixels), F.size(pixels)
    bad = (lambda x: (x == 0) | (x == invalid)) if invalid else (lambda x: x == 0)
    good = F.filter(p, lambda x: ~bad(x))
    add = lambda a, f: F.aggregate(a, F.lit(0.0), lambda s, x: s + f(x))
    d = df.withColumns({"_t_n": n, "_t_good": good, "_t_zero": F.size(F.filter(p, lambda x: x == 0))}).withColumn("_t_m", F.size("_t_good"))
    d = d.withColumn("_t_mean", F.when(F.col("_t_m") > 0, add(F.col("_t_good"), lambda x: x.cast("double")) / F.col("_t_m")).otherwise(0.0))
    std = F.when(F.col("_t_m") > 0, F.sqrt(add(F.col("_t_good"), lambda x: (x.cast("double") - F.col("_t_mean")) * (x.cast("double") - F.col("_t_mean"))) / F.col("_t_m"))).otherwise(0.0)
    ratio = lambda c, empty: F.when(F.col("_t_n") > 0, half_even(c / F.col("_t_n"), 6)).otherwise(empty)
    invalid_px = F.col("_t_n") - F.col("_t_m")
    return d.select(
        *keys, F.col("_t_n").cast("bigint").alias("pixels"), ratio(F.col("_t_zero"), 1.0).alias("zero_ratio"), ratio(invalid_px, 1.0).alias("invalid_ratio"), ratio(F.col("_t_m"), 0.0).alias("valid_ratio"),
        (F.col("_t_zero") == F.col("_t_n")).alias("all_zero"), half_even("_t_mean", 2).alias("mean"), half_even(std, 2).alias("std"),
        F.coalesce(F.array_min("_t_good"), F.lit(0)).cast("bigint").alias("min"), F.coalesce(F.array_max("_t_good"), F.lit(0)).cast("bigint").alias("max"),
    )


def depth_roll_up(stats: DataFrame, keys: list[str], least_valid: float = 0.5) -> DataFrame:
    """Per stream over ``depth_stats``: frames, all-zero ones and their ratio, the overall valid ratio (from the frames' rounded
    ratios, truncated to pixels), severity (over half all zero: fatal; any, or too few valid pixels: warn)."""
    bad = F.sum((F.col("invalid_ratio") * F.col("pixels")).cast("bigint"))
    out = stats.groupBy(*keys).agg(F.count(F.lit(1)).alias("frames"), F.count_if("all_zero").alias("all_zero_frames"), (1 - bad / F.sum("pixels")).alias("_t_v"))
    zero = F.col("all_zero_frames") / F.col("frames")
    severity = F.when(zero > 0.5, "fatal").when((F.col("all_zero_frames") > 0) | (F.col("_t_v") < least_valid), "warn").otherwise("pass")
    return out.select(*keys, "frames", "all_zero_frames", F.bround(zero, 4).alias("all_zero_ratio"), F.bround("_t_v", 4).alias("valid_ratio"), severity.alias("severity"))


def frozen_frames(df: DataFrame, keys: list[str], order: str, content: str, least: int = 3) -> DataFrame:
    """Runs of at least ``least`` frames of equal content (text or bytes): first, last, rows."""
    hashed = df.withColumn("_t_h", F.xxhash64(content))
    return freeze_spans(hashed, keys, order, ["_t_h"], least)


def gray(frame: np.ndarray) -> np.ndarray:
    """Luma of a BGR frame; a frame of one channel is its own."""
    if frame.ndim == 2:
        return frame.astype(np.float64)
    return frame[..., 0] * 0.114 + frame[..., 1] * 0.587 + frame[..., 2] * 0.299


def laplacian_variance(frame: np.ndarray) -> float:
    """Sharpness: variance of the 4-neighbour Laplacian, edges mirrored."""
    p = np.pad(gray(frame), 1, mode="reflect")
    return float((p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * p[1:-1, 1:-1]).var())


def exposure(frame: np.ndarray) -> dict[str, float]:
    g = gray(frame)
    p95, p99 = np.percentile(g, [95, 99])
    return {"gray_mean": float(g.mean()), "p95": float(p95), "p99": float(p99), "saturated_ratio": float((g >= 250).mean())}


def dct_matrix(n: int) -> np.ndarray:
    """Orthonormal DCT-II."""
    k = np.arange(n)
    m = np.sqrt(2 / n) * np.cos(np.pi * (2 * k[None, :] + 1) * k[:, None] / (2 * n))
    m[0] /= np.sqrt(2)
    return m


def resized(image: np.ndarray, size: int) -> np.ndarray:
    """Bilinear, pixel centres aligned."""

    def weights(n: int) -> np.ndarray:
        at = np.clip((np.arange(size) + 0.5) * n / size - 0.5, 0, n - 1)
        low = np.floor(at).astype(int)
        high = np.minimum(low + 1, n - 1)
        w = np.zeros((size, n))
        np.add.at(w, (np.arange(size), low), 1 - (at - low))
        np.add.at(w, (np.arange(size), high), at - low)
        return w

    return weights(image.shape[0]) @ image @ weights(image.shape[1]).T


def perceptual_hash(frames: list[np.ndarray], size: int = 8) -> np.ndarray:
    """Mean over frames of (low DCT block > its mean)."""
    m = dct_matrix(size * 4)
    return np.mean([(lambda low: low > low.mean())((m @ resized(gray(f), size * 4) @ m.T)[:size, :size]) for f in frames], axis=0)


def similarity(a: np.ndarray, b: np.ndarray, window: int = 7) -> float:
    """Mean structural similarity with uniform windows."""
    x, y = gray(a), gray(b)
    c1, c2 = (0.01 * 255) ** 2, (0.03 * 255) ** 2

    def mean(z: np.ndarray) -> np.ndarray:
        s = np.pad(z.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
        return (s[window:, window:] - s[:-window, window:] - s[window:, :-window] + s[:-window, :-window]) / window**2

    mx, my = mean(x), mean(y)
    vx, vy, vxy = mean(x * x) - mx * mx, mean(y * y) - my * my, mean(x * y) - mx * my
    return float((((2 * mx * my + c1) * (2 * vxy + c2)) / ((mx * mx + my * my + c1) * (vx + vy + c2))).mean())


def frame_metrics(df: DataFrame, keys: list[str], content: str, height: str, width: str, channels: int = 3) -> DataFrame:
    """Raw 8-bit frames with gray_mean, p95, p99, saturated_ratio and sharpness; frames whose bytes don't fit come back null."""

    def run(parts):
        for part in parts:
            out = []
            for data, h, w in zip(part[content], part[height], part[width], strict=True):
                pixels = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
                if not len(pixels) or len(pixels) != h * w * channels:
                    out.append({c: None for c in names})
                    continue
                frame = pixels.reshape((h, w, channels) if channels > 1 else (h, w))
                out.append(exposure(frame) | {"sharpness": laplacian_variance(frame)})
            yield pd.concat([part[keys].reset_index(drop=True), pd.DataFrame(out, columns=names, dtype="float64")], axis=1)

    names = ["gray_mean", "p95", "p99", "saturated_ratio", "sharpness"]
    kinds = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)
    return df.select(*keys, content, height, width).mapInPandas(run, f"{kinds}, " + ", ".join(f"{n} double" for n in names))


def video_hashes(df: DataFrame, keys: list[str], order: str, content: str, height: str, width: str, channels: int = 1, samples: int = 10, size: int = 8) -> DataFrame:
    """(keys, bit, share): the perceptual hash of each video, the mean over evenly sampled frames of (low DCT block > its mean).

    Frames are sampled by number and hashed where they lie; only their bits are brought together.  Raw 8-bit frames; those whose
    bytes don't fit are left out.
    """
    chosen = every_kth(df, keys, order, samples)
    kinds = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)

    def run(parts):
        for part in parts:
            bits = []
            for data, h, w in zip(part[content], part[height], part[width], strict=True):
                pixels = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
                whole = len(pixels) and len(pixels) == h * w * channels
                bits.append(perceptual_hash([pixels.reshape((h, w, channels) if channels > 1 else (h, w))], size).ravel().tolist() if whole else None)
            yield part[keys].assign(bits=bits)

    hashed = chosen.select(*keys, content, height, width).mapInPandas(run, f"{kinds}, bits array<double>")
    return hashed.select(*keys, F.posexplode("bits").alias("bit", "v")).groupBy(*keys, "bit").agg(F.avg("v").alias("share"))


def blurred(width: str = "width", height: str = "height", sharpness: str = "sharpness", limits: dict[tuple[int, int], float] | None = None, limit: float = 100.0, area: int = 1920 * 1080) -> Column:
    """Too little detail: sharpness under the limit of the frame's resolution, or else under ``limit`` scaled by its area."""
    out = F.lit(limit) * F.least(F.lit(1.0), F.col(width) * F.col(height) / F.lit(float(area)))
    for (w, h), own in (limits or {}).items():
        out = F.when((F.col(width) == w) & (F.col(height) == h), own).otherwise(out)
    return F.col(sharpness) < out


def overexposed(mean: str = "gray_mean", limit: float = 240, saturated: float = 0.3, p95: float = 250, p99: float = 254) -> Column:
    """Too bright by any of the mean, the saturated part or the upper percentiles."""
    return (F.col(mean) >= limit) | (F.col("saturated_ratio") >= saturated) | (F.col("p95") >= p95) | (F.col("p99") >= p99)


def count_mismatches(df: DataFrame, keys: list[str], sources: list[str], most: int = 5) -> DataFrame:
    """Pairs of sources of a count that differ, in the order given: source_a, source_b, difference, severity."""
    long = F.array_compact(F.array(*(F.when(F.col(s).isNotNull(), F.struct(F.lit(i).alias("i"), F.lit(s).alias("s"), F.col(s).cast("bigint").alias("n"))) for i, s in enumerate(sources))))
    rows = df.select(*keys, long.alias("_t_l"))
    pairs = rows.select(*keys, "_t_l", F.explode("_t_l").alias("a")).select(*keys, "a", F.explode("_t_l").alias("b")).where("a.i < b.i and a.n <> b.n")
    off = F.abs(F.col("a.n") - F.col("b.n"))
    return pairs.select(*keys, F.col("a.s").alias("source_a"), F.col("b.s").alias("source_b"), off.alias("difference"), F.when(off <= most, "warning").otherwise("error").alias("severity"))


def contained(issues: DataFrame, spans: DataFrame, keys: list[str]) -> DataFrame:
    """Issues (start_ns, end_ns) wholly inside a span (low, high) of their key, ends included."""
    return issues.join(spans, keys).where("start_ns >= low and end_ns <= high")


def compare_means(a: DataFrame, b: DataFrame, keys: list[str], value: str, most: float) -> DataFrame:
    """Means of the values that aren't NaN on both sides, their difference, and whether it is at most ``most``."""
    mean = lambda df, n: df.groupBy(*keys).agg(F.avg(F.when(~F.isnan(F.col(value).cast("double")), F.col(value))).alias(n))
    j = mean(a, "mean_a").join(mean(b, "mean_b"), keys, "full")
    off = F.abs(F.col("mean_a") - F.col("mean_b"))
    return j.withColumn("difference", off).withColumn("close", F.coalesce(off <= most, F.lit(False)))


def forward_filled(df: DataFrame, keys: list[str], order: str, columns: list[str]) -> DataFrame:
    """Nulls taken from the last row before that has a value."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def match_tracks(df: DataFrame, key: str, frame: str, box: list[str], least_iou: float = 0.3) -> DataFrame:
    """``df`` with track_id: each box takes the unused track of the frames before with the best overlap, or opens one.

    Sequential within a video; boxes of a frame go by their order.
    """

    def overlap(a, b) -> float:
        w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
        inter = max(0.0, w) * max(0.0, h)
        union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - inter
        return inter / union if union > 0 else 0.0

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values([frame, *box]).reset_index(drop=True)
        tracks: dict[int, list[float]] = {}
        out, used, at = [], set(), None
        for f, own in zip(part[frame].tolist(), part[box].to_numpy(dtype=float).tolist(), strict=True):
            if f != at:
                used, at = set(), f
            best = max((t for t in tracks if t not in used), key=lambda t: (overlap(own, tracks[t]), -t), default=None)  # noqa: B023
            if best is None or overlap(own, tracks[best]) < least_iou:
                best = len(tracks)
            tracks[best] = own
            used.add(best)
            out.append(best)
        return part.assign(track_id=out)

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.groupBy(key).applyInPandas(run, f"{kinds}, track_id bigint")


def motion(df: DataFrame, keys: list[str], frame: str, x: str, y: str, fps: float, diagonal: float, scale: float = 1.0) -> DataFrame:
    """Per key: median normalised jerk over rows whose last four frames follow each other, smoothness exp(-jerk / scale), and the
    largest speed between frames that follow each other."""
    w = Window.partitionBy(*keys).orderBy(frame)
    follows = lambda k: F.col(frame) - F.lag(frame, k).over(w) == k
    lag = lambda c, k: F.lag(c, k).over(w)
    third = lambda c: F.col(c) - 3 * lag(c, 1) + 3 * lag(c, 2) - lag(c, 3)
    d = df.withColumns({
        "_t_jerk": F.when(follows(3), F.sqrt(third(x) * third(x) + third(y) * third(y)) * fps**3 / diagonal),
        "_t_speed": F.when(follows(1), F.sqrt((F.col(x) - lag(x, 1)) ** 2 + (F.col(y) - lag(y, 1)) ** 2) * fps / diagonal),
    })
    out = d.groupBy(*keys).agg(F.median("_t_jerk").alias("jerk"), F.max("_t_speed").alias("max_speed"))
    return out.withColumn("smoothness", F.exp(-F.col("jerk") / scale))


def presence_ratio(rows: DataFrame, keys: list[str], frame: str, totals: DataFrame, total: str) -> DataFrame:
    """Distinct frames with rows over all frames; 0 without frames."""
    seen = rows.groupBy(*keys).agg(F.count_distinct(frame).alias("_t_n"))
    return totals.join(seen, keys, "left").select(*keys, F.when(F.col(total) > 0, F.coalesce("_t_n", F.lit(0)) / F.col(total)).otherwise(0.0).alias("presence"))
