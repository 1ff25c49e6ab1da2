"""Change points: peaks, clusters of proposals, weighted fusion, hysteresis, minimum durations, scenes."""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.numbers import cosine_change, half_even
from tessera.operators.frames import similarity
from tessera.operators.sequence import previous, runs


def adjacent_change(df: DataFrame, keys: list[str], order: str, vector: str, name: str = "change") -> DataFrame:
    """clip(1 - cosine) with the row before; 0 on the first row."""
    p = previous(df, keys, order, [vector])
    return p.withColumn(name, F.when(F.col(f"prev_{vector}").isNull(), 0.0).otherwise(cosine_change(vector, f"prev_{vector}"))).drop(f"prev_{vector}")


def brightness_jumps(df: DataFrame, keys: list[str], order: str, mean: str, black: float, name: str = "score") -> DataFrame:
    """|mean - mean before|; 1 where exactly one of both frames is black (mean at most ``black``)."""
    p = previous(df, keys, order, [mean])
    flip = (F.col(mean) <= black) != (F.col(f"prev_{mean}") <= black)
    return p.withColumn(name, F.when(F.col(f"prev_{mean}").isNull(), 0.0).when(flip, 1.0).otherwise(F.abs(F.col(mean) - F.col(f"prev_{mean}")))).drop(f"prev_{mean}")


def sparse_histogram_distance(a: str, b: str):
    """Bhattacharyya distance of two histograms given as maps of a bin to its count; bins that a map lacks are empty."""
    add = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v)
    bins = F.array_sort(F.array_intersect(F.map_keys(a), F.map_keys(b)))
    overlap = add(F.transform(bins, lambda k: F.sqrt(F.element_at(a, k) * F.element_at(b, k)))) / F.sqrt(add(F.map_values(a)) * add(F.map_values(b)))
    return F.sqrt(F.greatest(F.lit(0.0), 1 - overlap))


def histogram_distance(a, b, method: str = "bhattacharyya"):
    """Distance of two histogram arrays: Bhattacharyya, or chi-squared as x / (x + 1)."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    add = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v)
    if method == "bhattacharyya":
        overlap = add(F.zip_with(a, b, lambda p, q: F.sqrt(p * q))) / F.sqrt(add(a) * add(b))
        return F.sqrt(F.greatest(F.lit(0.0), 1 - overlap))
    x = add(F.zip_with(a, b, lambda p, q: F.when(p > 0, (p - q) * (p - q) / p).otherwise(0.0)))
    return x / (x + 1)


def gap_clusters(df: DataFrame, keys: list[str], index: str, most: int, name: str = "cluster") -> DataFrame:
    """Chains of rows whose places are at most ``most`` apart (rows at the same place are one chain)."""
    seen = df.select(*keys, index).distinct()
    marked = runs(seen, keys, index, F.col(index) - F.col(f"prev_{index}") > most, [index], name)
    return df.join(marked, [*keys, index])


def peaks(df: DataFrame, keys: list[str], index: str, score: str, most: int = 1) -> DataFrame:
    """The highest row of each chain of candidates; ties go to the smallest place."""
    c = gap_clusters(df, keys, index, most)
    w = Window.partitionBy(*keys, "cluster").orderBy(F.desc(score), index)
    return c.withColumn("_t_r", F.row_number().over(w)).where("_t_r = 1").drop("_t_r")


def fuse(proposals: DataFrame, smoothed: DataFrame, keys: list[str], weights: dict[str, float], most: int, fps: float) -> DataFrame:
    """Clusters of (frame_index, source, score, is_hard_cut) proposals as one row each.

    A source's score is the larger of its best proposal and the best smoothed value (frame_index, source, smoothed) at its
    proposals' frames; the fused score is the weighted mean over all weights; the representative has the largest weighted
    score, ties to the smallest frame.
    """
    table = F.create_map(*(F.lit(x) for kv in weights.items() for x in kv))
    c = gap_clusters(proposals, keys, "frame_index", most).join(smoothed.select(*keys, "frame_index", "source", "smoothed"), [*keys, "frame_index", "source"], "left").withColumn("_t_w", table[F.col("source")])
    by_source = c.groupBy(*keys, "cluster", "source", "_t_w").agg(
        F.greatest(F.max("score"), F.coalesce(F.max("smoothed"), F.lit(0.0))).alias("_t_s"), F.bool_or("is_hard_cut").alias("_t_h"), F.min("frame_index").alias("_t_f0"), F.max("frame_index").alias("_t_f1"),
        F.max(F.struct((F.col("_t_w") * F.col("score")).alias("v"), (-F.col("frame_index")).alias("f"))).alias("_t_best"), F.count(F.lit(1)).alias("_t_n"),
    )
    total = float(sum(weights.values()))
    out = by_source.groupBy(*keys, "cluster").agg(
        (-F.max("_t_best")["f"]).alias("frame_index"), (F.sum(F.col("_t_w") * F.col("_t_s")) / total).alias("score"), F.bool_or("_t_h").alias("is_hard_cut"),
        F.array_sort(F.collect_list("source")).alias("sources"), F.min("_t_f0").alias("first_frame"), F.max("_t_f1").alias("last_frame"), F.sum("_t_n").alias("proposals"),
    )
    return out.withColumn("score", F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("score")))).withColumn("timestamp_ns", half_even(F.col("frame_index") * 1e9 / fps).cast("bigint")).drop("cluster")


def joint_hard_cuts(clusters: DataFrame, low: DataFrame, high: DataFrame, keys: list[str], most: int) -> DataFrame:
    """``clusters`` (first_frame, last_frame) with is_hard_cut also set where a low-similarity and a high-motion frame within
    the cluster are at most ``most`` apart.  ``low`` and ``high`` hold frame_index of such frames.  All joins are on frames, so
    their rows grow with the frames."""
    near = F.explode(F.sequence(F.col("frame_index") - most, F.col("frame_index") + most)).alias("_t_b")
    pairs = low.select(*keys, F.col("frame_index").alias("_t_a"), near).join(high.select(*keys, F.col("frame_index").alias("_t_b")), [*keys, "_t_b"])
    frames = clusters.select(*keys, "first_frame", "last_frame", F.explode(F.sequence("first_frame", "last_frame")).alias("_t_a"))
    hit = frames.join(pairs, [*keys, "_t_a"]).where("_t_b between first_frame and last_frame").select(*keys, "first_frame", F.lit(True).alias("_t_hit")).distinct()
    return clusters.join(hit, [*keys, "first_frame"], "left").withColumn("is_hard_cut", F.col("is_hard_cut") | F.coalesce("_t_hit", F.lit(False))).drop("_t_hit")


def structural_similarity(df: DataFrame, keys: list[str], order: str, content: str, height: str, width: str, channels: int = 1, window: int = 5) -> DataFrame:
    """``df`` without its pixels and with ``similarity`` to the frame before (1 on the first) and ``lag_similarity`` to that
    ``window`` before (null on the first ones): mean structural similarity of raw 8-bit frames of one size."""
    w = Window.partitionBy(*keys).orderBy(order)
    kept = [c for c in df.columns if c != content]
    both = df.withColumns({"_t_p": F.lag(content).over(w), "_t_l": F.lag(content, window).over(w)})
    kinds = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in kept)

    def run(parts):
        for part in parts:
            def frame(data, h, w):
                return np.frombuffer(data, np.uint8).reshape((h, w, channels) if channels > 1 else (h, w))

            def alike(other):
                return [None if o is None else similarity(frame(o, h, w), frame(x, h, w)) for o, x, h, w in zip(part[other], part[content], part[height], part[width], strict=True)]

            one, far = alike("_t_p"), alike("_t_l")
            out = part[kept].reset_index(drop=True)
            out["similarity"] = [1.0 if x is None else x for x in one]
            out["lag_similarity"] = pd.array(far, "Float64")
            yield out

    return both.mapInPandas(run, f"{kinds}, similarity double, lag_similarity double")


def structural_cuts(df: DataFrame, keys: list[str], index: str, hard: float = 0.4, gradual: float = 0.6, least: int = 3, window: int = 5) -> DataFrame:
    """(keys, index, score) of cuts by ``similarity`` and ``lag_similarity``, the highest of each chain of candidates.

    A frame is a hard candidate if its similarity is at most ``hard``.  The middle of a window is a gradual one if its ends are
    alike by at most ``gradual``, at least ``least`` of its steps changed, and none of them is hard.  Scores are 1 - similarity,
    raised to 1 - lag similarity in a gradual middle.
    """
    w = Window.partitionBy(*keys).orderBy(index)
    trail = w.rowsBetween(1 - window, 0)
    unit = lambda c: F.least(F.lit(1.0), F.greatest(F.lit(0.0), 1 - F.col(c)))
    d = df.withColumns({"_t_n": F.row_number().over(w) - 1, "_t_c": F.count_if(F.col("similarity") < 0.999).over(trail), "_t_h": F.min("similarity").over(trail)})
    slow = (F.col("_t_n") >= window) & (F.col("lag_similarity") <= gradual) & (F.col("_t_c") >= least) & (F.col("_t_h") > hard)
    # the window that ends half a window later has its middle here
    ahead = window // 2
    d = d.withColumn("_t_g", F.lead(F.when(slow, unit("lag_similarity")), ahead).over(w) if ahead else F.when(slow, unit("lag_similarity")))
    found = d.where(F.col("_t_g").isNotNull() | ((F.col("_t_n") > 0) & (F.col("similarity") <= hard)))
    scored = found.select(*keys, index, F.greatest(unit("similarity"), F.coalesce("_t_g", F.lit(0.0))).alias("score"))
    return peaks(scored, keys, index, "score", max(1, least)).select(*keys, index, "score")


def hysteresis(df: DataFrame, keys: list[str], most: int = 2) -> DataFrame:
    """Candidates (frame_index, timestamp_ns, confidence, is_hard_cut) merged within chains of places ``most`` apart.

    A chain without a hard cut becomes its most confident row (ties: the smallest frame); else each soft row joins the
    nearest hard one (ties: the smaller frame), and every hard cut stays.
    """
    c = gap_clusters(df.select(*keys, "frame_index", "timestamp_ns", "confidence", "is_hard_cut"), keys, "frame_index", most)
    near = lambda order: Window.partitionBy(*keys, "cluster").orderBy(order).rangeBetween(Window.unboundedPreceding, 0)
    hard = F.when(F.col("is_hard_cut"), F.col("frame_index"))
    before, after = F.max(hard).over(near(F.col("frame_index"))), F.min(hard).over(near(-F.col("frame_index")))
    best = F.first(F.col("frame_index")).over(Window.partitionBy(*keys, "cluster").orderBy(F.desc("confidence"), "frame_index"))
    m = c.withColumns({"_t_b": before, "_t_a": after, "_t_best": best})
    to = F.when(F.col("is_hard_cut"), F.col("frame_index")).when(F.col("_t_b").isNull() & F.col("_t_a").isNull(), F.col("_t_best")).when(F.col("_t_a").isNull() | (F.col("frame_index") - F.col("_t_b") <= F.col("_t_a") - F.col("frame_index")), F.col("_t_b")).otherwise(F.col("_t_a"))
    return m.withColumn("_t_to", to).groupBy(*keys, F.col("_t_to").alias("frame_index")).agg(F.max("confidence").alias("confidence"), F.bool_or("is_hard_cut").alias("is_hard_cut"), F.min(F.when(F.col("frame_index") == F.col("_t_to"), F.col("timestamp_ns"))).alias("timestamp_ns"))


def minimum_duration(df: DataFrame, keys: list[str], start: str, end: str, least_ns: int) -> DataFrame:
    """Soft boundaries kept greedily between hard ones (or the ends): each at least ``least_ns`` after the last kept one, and
    the last ones dropped while too near the next anchor.  One stretch between anchors is one group."""
    w = Window.partitionBy(*keys).orderBy("timestamp_ns", "frame_index")
    inside = df.where((F.col("timestamp_ns") > F.col(start)) & (F.col("timestamp_ns") < F.col(end)))
    hard_before = F.coalesce(F.max(F.when(F.col("is_hard_cut"), F.col("timestamp_ns"))).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.col(start))
    hard_after = F.coalesce(F.min(F.when(F.col("is_hard_cut"), F.col("timestamp_ns"))).over(w.rowsBetween(1, Window.unboundedFollowing)), F.col(end))
    laid = inside.withColumns({"_t_from": hard_before, "_t_to": hard_after})
    hard = laid.where("is_hard_cut").drop("_t_from", "_t_to")
    soft = laid.where("not is_hard_cut and timestamp_ns > _t_from and timestamp_ns < _t_to")

    row = F.struct("timestamp_ns", "frame_index", *(c for c in inside.columns if c not in ("timestamp_ns", "frame_index", *keys)))
    stretch = soft.groupBy(*keys, "_t_from", "_t_to").agg(F.array_sort(F.collect_list(row)).alias("_t_rows"))
    # a fold over the stretch accepts in order; accepted ones ascend, so those too near the next anchor are its tail
    accepted = F.aggregate("_t_rows", F.struct(F.col("_t_from").alias("last"), F.slice("_t_rows", 1, 0).alias("kept")), lambda s, x: F.when(x["timestamp_ns"] - s["last"] >= least_ns, F.struct(x["timestamp_ns"].alias("last"), F.array_append(s["kept"], x).alias("kept"))).otherwise(s))
    kept = F.filter(accepted["kept"], lambda x: F.col("_t_to") - x["timestamp_ns"] >= least_ns)
    chosen = stretch.select(*keys, F.explode(kept).alias("_t_x")).select(*keys, "_t_x.*")
    return hard.unionByName(chosen)


def merge_same_scenes(boundaries: list[tuple[int, bool]], start: int, end: int, similarity, most: float) -> list[tuple[int, bool]]:
    """Boundaries (time, hard) without soft ones whose two sides look alike at their centres.

    A stack holds what stands so far.  Each boundary goes on top, and the scene after it reaches to the boundary that comes
    next; as long as the top one is soft and its two sides look alike it falls, which widens the scene for the one below.
    """
    stands: list[tuple[int, bool]] = []
    nexts = [t for t, _ in boundaries[1:]] + [end]
    for boundary, right in zip(boundaries, nexts, strict=True):
        stands.append(boundary)
        while stands and not stands[-1][1]:
            top, left = stands[-1][0], stands[-2][0] if len(stands) > 1 else start
            if similarity((left + top) // 2, (top + right) // 2) <= most:
                break
            stands.pop()
    return stands


def merge_same(boundaries: DataFrame, sessions: DataFrame, keys: list[str], order: str, vector: str, embeddings: DataFrame, most: float) -> DataFrame:
    """``merge_same_scenes`` for every key of at most a few thousand boundaries (timestamp_ns, is_hard_cut): two centres look
    alike if the cosine of the embeddings (``order`` is their time) nearest before them is over ``most``."""
    b = boundaries.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("timestamp_ns", "is_hard_cut"))).alias("_t_b"))
    e = embeddings.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, vector))).alias("_t_e"))
    rows = sessions.select(*keys, "start_ns", "end_ns").join(b, keys).join(e, keys)
    kinds = ", ".join(f"{k} {sessions.schema[k].dataType.simpleString()}" for k in keys)

    def run(parts):
        for part in parts:
            out = []
            for row in part.to_dict("records"):
                times = [int(x[order]) for x in row["_t_e"]]
                unit = [np.asarray(x[vector], float) / max(float(np.linalg.norm(x[vector])), 1e-300) for x in row["_t_e"]]
                at = lambda t: unit[max(0, bisect_right(times, t) - 1)]  # noqa: B023, E731
                kept = merge_same_scenes([(int(x["timestamp_ns"]), bool(x["is_hard_cut"])) for x in row["_t_b"]], int(row["start_ns"]), int(row["end_ns"]), lambda p, q: float(at(p) @ at(q)), most)  # noqa: B023
                out += [{**{k: row[k] for k in keys}, "timestamp_ns": t, "is_hard_cut": h} for t, h in kept]
            yield pd.DataFrame(out, columns=[*keys, "timestamp_ns", "is_hard_cut"])

    return rows.mapInPandas(run, f"{kinds}, timestamp_ns bigint, is_hard_cut boolean")


def scenes(boundaries: DataFrame, sessions: DataFrame, keys: list[str], least_ns: int) -> DataFrame:
    """Boundaries (timestamp_ns, confidence) to scenes from the session's start_ns to its end_ns: place, start, end, the mean
    confidence of the one or two boundaries (0 without), short_span."""
    ends = sessions.select(*keys, F.col("start_ns").alias("timestamp_ns"), F.lit(None).cast("double").alias("confidence"), F.lit(0).alias("_t_k")).unionByName(sessions.select(*keys, F.col("end_ns").alias("timestamp_ns"), F.lit(None).cast("double").alias("confidence"), F.lit(2).alias("_t_k")))
    every = ends.unionByName(boundaries.select(*keys, "timestamp_ns", F.col("confidence").cast("double"), F.lit(1).alias("_t_k")))
    w = Window.partitionBy(*keys).orderBy("timestamp_ns", "_t_k")
    laid = every.withColumns({"end_ns": F.lead("timestamp_ns").over(w), "_t_c": F.lead("confidence").over(w), "place": (F.row_number().over(w) - 1).cast("bigint")}).where("end_ns is not null")
    n = F.col("confidence").isNotNull().cast("int") + F.col("_t_c").isNotNull().cast("int")
    mean = F.when(n == 0, 0.0).otherwise((F.coalesce("confidence", F.lit(0.0)) + F.coalesce("_t_c", F.lit(0.0))) / F.greatest(n, F.lit(1)))
    return laid.select(*keys, "place", F.col("timestamp_ns").alias("start_ns"), "end_ns", mean.alias("confidence"), (F.col("end_ns") - F.col("timestamp_ns") < least_ns).alias("short_span"))


def representative_frames(df: DataFrame, start: str, end: str, fps: float, frames: str, session_start: str) -> DataFrame:
    """Scenes with their first, middle and last frame, clamped to the frames there are."""
    rel = lambda c: (F.col(c) - F.col(session_start)) * fps / 1e9
    last = F.col(frames) - 1
    first = F.greatest(F.lit(0), F.least(last, F.floor(rel(start)).cast("bigint")))
    final = F.greatest(first, F.least(last, F.ceil(rel(end)).cast("bigint") - 1))
    return df.withColumns({"first_frame": first, "middle_frame": F.floor((first + final) / 2), "last_frame": final})


def sampling_grid(candidates: DataFrame, keys: list[str], frame: str, context: int, step: int, frames: str) -> DataFrame:
    """Distinct frames within ``context`` of any candidate at steps of ``step``, inside [0, the column ``frames``)."""
    grid = F.sequence(F.col(frame) - context, F.col(frame) + context, F.lit(step).cast("bigint"))
    return candidates.select(*keys, F.col(frames).alias("_t_n"), F.explode(grid).alias("frame_index")).where("frame_index >= 0 and frame_index < _t_n").drop("_t_n").distinct()


def scene_metrics(df: DataFrame, keys: list[str]) -> DataFrame:
    """Scenes, least and mean confidence, ratio of short ones; nulls without scenes."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("scenes"), F.min("confidence").alias("min_confidence"), F.avg("confidence").alias("mean_confidence"), F.avg(F.col("short_span").cast("double")).alias("short_ratio"))
