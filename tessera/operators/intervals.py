"""Runs to spans, and interval algebra: merge, subtract, invert, absorb, plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.numbers import finite
from tessera.operators.sequence import previous, runs, same, true_runs

#: Decisions whose intervals the planner takes out.
REMOVED = ("split", "exclude_range", "quarantine", "keep_with_flag")


def time_spans(df: DataFrame, keys: list[str], order: str, ts: str, flag: str, least_ns: int = 0, slice_rows: int | None = None) -> DataFrame:
    """Runs of true rows as [start_ns, end_ns], the end extended by the interval between the run's last row and the row
    before it in the stream (0 on the first row); runs of at least ``least_ns`` stay."""
    seen = previous(df, keys, order, [ts], slice_rows, "_t_prev_")
    marked = true_runs(seen.withColumn("_t_step", F.coalesce(F.col(ts) - F.col(f"_t_prev_{ts}"), F.lit(0))), keys, order, flag, slice_rows)
    spans = marked.groupBy(*keys, "run_id").agg(F.min(ts).alias("start_ns"), F.max_by(F.col(ts) + F.col("_t_step"), order).alias("end_ns"), F.count(F.lit(1)).alias("rows"))
    return spans.where(F.col("end_ns") - F.col("start_ns") >= least_ns).drop("run_id")


def frame_spans(df: DataFrame, keys: list[str], order: str, flag: str, least: int = 1, slice_rows: int | None = None) -> DataFrame:
    """Runs of true rows as half-open [first, past) places; runs of at least ``least`` rows stay."""
    marked = true_runs(df, keys, order, flag, slice_rows)
    return marked.groupBy(*keys, "run_id").agg(F.min(order).alias("first"), (F.max(order) + 1).alias("past"), F.count(F.lit(1)).alias("rows")).where(F.col("rows") >= least).drop("run_id")


def sustained(df: DataFrame, keys: list[str], order: str, flag: str, least: int, name: str = "sustained") -> DataFrame:
    """``df`` with ``name``: the flag holds there as part of a run of at least ``least`` rows."""
    flagged = F.coalesce(F.col(flag), F.lit(False))
    marked = runs(df.withColumn("_t_f", flagged), keys, order, ~F.col("_t_f").eqNullSafe(F.col("prev__t_f")), ["_t_f"])
    size = F.count(F.lit(1)).over(Window.partitionBy(*keys, "run_id"))
    return marked.withColumn(name, F.col("_t_f") & (size >= least)).drop("_t_f", "run_id")


def adjacent_runs(df: DataFrame, keys: list[str], index: str, ts: str | None = None) -> DataFrame:
    """Runs of places that follow each other without a hole: first_index, last_index, rows (and start_ns, end_ns)."""
    place = F.col(index) - F.row_number().over(Window.partitionBy(*keys).orderBy(index))
    times = [F.min(ts).alias("start_ns"), F.max(ts).alias("end_ns")] if ts else []
    return df.withColumn("_t_g", place).groupBy(*keys, "_t_g").agg(F.min(index).alias("first_index"), F.max(index).alias("last_index"), F.count(F.lit(1)).alias("rows"), *times).drop("_t_g")


def freeze_spans(df: DataFrame, keys: list[str], order: str, columns: list[str], least: int, rule: str = "equal", ts: str | None = None, eps: float = 1e-6, slice_rows: int | None = None) -> DataFrame:
    """Runs of rows that equal the row before in all ``columns``: first, last, rows (and start_ns, end_ns).

    ``equal``: NaN equals nothing (joint freeze, one or many columns).  ``finite``: only finite values can be equal.
    ``near``: differences of at most ``eps`` in size, or that are NaN, are frozen.
    """
    def still(c: str):
        if rule == "equal":
            return same(c, f"prev_{c}")
        if rule == "finite":
            return same(c, f"prev_{c}") & finite(c)
        d = F.abs(F.col(c).cast("double") - F.col(f"prev_{c}").cast("double"))
        return F.coalesce(F.isnan(d) | (d <= eps), F.lit(False))

    frozen = still(columns[0])
    for c in columns[1:]:
        frozen = frozen & still(c)
    marked = runs(df, keys, order, ~frozen, columns, slice_rows=slice_rows)
    times = [F.min_by(ts, order).alias("start_ns"), F.max_by(ts, order).alias("end_ns")] if ts else []
    return marked.groupBy(*keys, "run_id").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("rows"), *times).where(F.col("rows") >= least).drop("run_id")


def freeze_any_axis(df: DataFrame, keys: list[str], order: str, columns: list[str], least: int) -> DataFrame:
    """Per-column freeze runs of at least ``least`` rows, joined with OR per row, then merged: first, last, rows."""
    long = df.select(*keys, order, F.explode(F.array(*(F.struct(F.lit(c).alias("axis"), F.col(c).cast("double").alias("v")) for c in columns))).alias("x")).select(*keys, order, "x.*")
    marked = runs(long, [*keys, "axis"], order, ~same("v", "prev_v"), ["v"])
    size = F.count(F.lit(1)).over(Window.partitionBy(*keys, "axis", "run_id"))
    rows = marked.withColumn("_t_f", size >= least).groupBy(*keys, order).agg(F.bool_or("_t_f").alias("_t_f"))
    return true_runs(rows, keys, order, "_t_f").groupBy(*keys, "run_id").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("rows")).drop("run_id")


def merge(df: DataFrame, keys: list[str], start: str, end: str, gap: int = 0) -> DataFrame:
    """Intervals merged where the next starts at most ``gap`` after the furthest end so far."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    far = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = df.withColumn("_t_new", F.when(F.col(start) - far <= gap, 0).otherwise(1))
    marked = marked.withColumn("_t_g", F.sum("_t_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "_t_g").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_t_g")


def subtract(ranges: DataFrame, holes: DataFrame, keys: list[str], start: str, end: str, low: str, high: str) -> DataFrame:
    """What is left of each key's [low, high] (one row per key) without the holes: start, end and place (from 0) of each part.

    Holes are clipped to the range; parts of no length are left out.
    """
    inside = holes.select(*keys, start, end).join(ranges.select(*keys, low, high), keys).select(*keys, low, high, F.greatest(start, low).alias(start), F.least(end, high).alias(end)).where(F.col(start) <= F.col(end))
    edge = ranges.select(*keys, low, high, F.col(high).alias(start), F.col(high).alias(end))
    every = inside.unionByName(edge)
    w = Window.partitionBy(*keys).orderBy(start, end)
    far = F.coalesce(F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.col(low))
    free = every.withColumn("_t_from", far).where(F.col("_t_from") < F.col(start)).select(*keys, F.col("_t_from").alias(start), F.col(start).alias(end))
    return free.distinct().withColumn("place", (F.row_number().over(w) - 1).cast("bigint"))


def invert(spans: DataFrame, lengths: DataFrame, keys: list[str], first: str, past: str, length: str) -> DataFrame:
    """The complement of half-open spans in [0, length)."""
    ranges = lengths.select(*keys, F.lit(0).cast("bigint").alias("_t_low"), F.col(length).alias("_t_high"))
    return subtract(ranges, spans, keys, first, past, "_t_low", "_t_high").drop("place")


def keep_long(spans: DataFrame, lengths: DataFrame, keys: list[str], first: str, past: str, length: str, merge_gap: int, least: int) -> DataFrame:
    """What stays outside excluded spans: these are merged over gaps of ``merge_gap``, and kept parts under ``least`` are
    given to the excluded ones, which are merged and inverted again."""
    excluded = merge(spans, keys, first, past, merge_gap)
    kept = invert(excluded, lengths, keys, first, past, length)
    short = kept.where(F.col(past) - F.col(first) < least)
    again = merge(excluded.select(*keys, first, past).unionByName(short.select(*keys, first, past)), keys, first, past, 0)
    return invert(again, lengths, keys, first, past, length)


def span_reasons(spans: DataFrame, rows: DataFrame, keys: list[str], first: str, past: str, index: str, reason: str, length: str, soft: tuple[str, ...]) -> DataFrame:
    """Spans with the sorted distinct reasons of the rows inside, and what follows: reject for the whole, quarantine where
    all reasons are soft, trim at an edge, else split.  ``spans`` also has the stream's ``length``."""
    places = spans.where(F.col(first) < F.col(past)).select(*keys, first, past, length, F.explode(F.sequence(F.col(first), F.col(past) - 1)).alias(index))
    inside = places.join(rows.select(*keys, index, reason), [*keys, index])
    of = inside.groupBy(*keys, first, past, length).agg(F.array_sort(F.collect_set(reason)).alias("reasons"))
    allsoft = F.size(F.array_except("reasons", F.array(*(F.lit(s) for s in soft)))) == 0
    whole = (F.col(first) == 0) & (F.col(past) == F.col(length))
    return of.withColumn("disposition", F.when(whole, "reject").when(allsoft, "quarantine").when((F.col(first) == 0) | (F.col(past) == F.col(length)), "trim").otherwise("split"))


def edge_decision(df: DataFrame, start: str, end: str, low: str, high: str, tolerance_ns: int) -> DataFrame:
    """Spans near an edge of their session are trimmed, the others split it."""
    return df.withColumn("decision", F.when((F.col(start) - F.col(low) <= tolerance_ns) | (F.col(high) - F.col(end) <= tolerance_ns), "trim").otherwise("split"))


def plan_segments(issues: DataFrame, sessions: DataFrame, keys: list[str], least_ns: int = 1_000_000_000, most_ns: int = 120_000_000_000) -> DataFrame:
    """Candidate segments of each session [start_ns, end_ns] after trims and removals: place, start_ns, end_ns,
    duration_ns, reason, too_long.

    Trims that end by the middle move the start, others the end; intervals of ``REMOVED`` decisions are clipped to what is
    left and taken out.  Places count all parts, also those that are then too short.  ``plan_segments_in_order`` has the
    rule that goes by input order where intervals cross the ends.
    """
    i = issues.select(*keys, F.col("start_ns").alias("_t_s"), F.col("end_ns").alias("_t_e"), "decision")
    s = sessions.select(*keys, "start_ns", "end_ns")
    middle = F.col("start_ns") + F.floor((F.col("end_ns") - F.col("start_ns")) / 2)
    trim = i.where("decision = 'trim'").join(s, keys)
    trims = trim.groupBy(*keys).agg(F.max(F.when(F.col("_t_e") <= middle, F.col("_t_e"))).alias("_t_head"), F.min(F.when(F.col("_t_e") > middle, F.col("_t_s"))).alias("_t_tail"))
    valid = s.join(trims, keys, "left").select(*keys, F.greatest("start_ns", F.coalesce("_t_head", "start_ns")).alias("low"), F.least("end_ns", F.coalesce("_t_tail", "end_ns")).alias("high"), (F.col("_t_head").isNotNull() | F.col("_t_tail").isNotNull()).alias("trimmed"))
    holes = i.where(F.col("decision").isin(*REMOVED)).select(*keys, F.col("_t_s").alias("start_ns"), F.col("_t_e").alias("end_ns"))
    parts = subtract(valid.where("low < high"), holes, keys, "start_ns", "end_ns", "low", "high").join(valid.select(*keys, "low", "high", "trimmed"), keys)
    w = Window.partitionBy(*keys)
    last = (F.col("place") == F.max("place").over(w)) & (F.col("end_ns") == F.col("high"))
    reason = F.when(last & (F.col("place") > 0), "valid_span_after_long_gap").when(last & F.col("trimmed"), "trimmed_by_quality_boundary").when(last, "full_session").otherwise("valid_span_before_long_gap")
    length = F.col("end_ns") - F.col("start_ns")
    out = parts.select(*keys, "place", "start_ns", "end_ns", length.alias("duration_ns"), reason.alias("reason"), (length > most_ns).alias("too_long"))
    return out.where(F.col("duration_ns") >= least_ns)


def plan_segments_in_order(issues: DataFrame, sessions: DataFrame, key: str, order: str, least_ns: int = 1_000_000_000) -> DataFrame:
    """Segments (key, place, start_ns, end_ns) by the rule that depends on the issues' order.

    Trims narrow the range [low, high] first.  Then a fold over the removed intervals in order: one inside the range is a
    hole, one that crosses an end moves that end, and holes found before stay as they are.  Segments lie between the holes
    by start; places count them all, also those under ``least_ns``.  One session's removed intervals are one array.
    """
    i = issues.select(key, F.col(order).alias("_t_o"), F.col("start_ns").alias("_t_s"), F.col("end_ns").alias("_t_e"), "decision")
    middle = F.col("start_ns") + F.floor((F.col("end_ns") - F.col("start_ns")) / 2)
    trim = F.col("decision") == "trim"
    every = sessions.select(key, "start_ns", "end_ns").join(i, key, "left")
    removed = F.when(F.col("decision").isin(*REMOVED), F.struct("_t_o", F.col("_t_s").alias("s"), F.col("_t_e").alias("e")))
    of = every.groupBy(key, "start_ns", "end_ns").agg(
        F.max(F.when(trim & (F.col("_t_e") <= middle), F.col("_t_e"))).alias("_t_head"), F.min(F.when(trim & (F.col("_t_e") > middle), F.col("_t_s"))).alias("_t_tail"), F.array_sort(F.collect_list(removed)).alias("_t_cuts")
    )
    begun = F.struct(F.greatest("start_ns", "_t_head").alias("low"), F.least("end_ns", "_t_tail").alias("high"), F.slice("_t_cuts", 1, 0).alias("holes"))

    def step(r: Column, x: Column) -> Column:
        inside = (x["s"] >= r["low"]) & (x["e"] <= r["high"])
        at_low, at_high = (x["s"] < r["low"]) & (x["e"] > r["low"]), (x["s"] < r["high"]) & (x["e"] > r["high"])
        return F.struct(
            F.when(~inside & at_low, x["e"]).otherwise(r["low"]).alias("low"), F.when(~inside & ~at_low & at_high, x["s"]).otherwise(r["high"]).alias("high"), F.when(inside, F.array_append(r["holes"], x)).otherwise(r["holes"]).alias("holes")
        )

    folded = of.select(key, F.aggregate("_t_cuts", begun, step).alias("r")).select(key, "r.*")
    # what ends a segment: each hole, and the range's end
    ends = F.concat(F.transform("holes", lambda x: F.struct(F.lit(0).alias("last"), x["s"].alias("s"), x["e"].alias("e"))), F.array(F.struct(F.lit(1).alias("last"), F.col("high").alias("s"), F.col("high").alias("e"))))
    laid = folded.select(key, "low", F.explode(ends).alias("x")).select(key, "low", "x.*")
    before = Window.partitionBy(key).orderBy("last", "s", "e").rowsBetween(Window.unboundedPreceding, -1)
    cut = laid.withColumn("start_ns", F.greatest("low", F.max("e").over(before))).where(F.col("start_ns") < F.col("s"))
    place = (F.row_number().over(Window.partitionBy(key).orderBy("start_ns")) - 1).cast("bigint")
    return cut.select(key, place.alias("place"), "start_ns", F.col("s").alias("end_ns")).where(F.col("end_ns") - F.col("start_ns") >= least_ns)


def downgrade(issues: DataFrame) -> DataFrame:
    """Decisions of one unbroken segment: split, exclude_range and keep_with_flag become keep."""
    return issues.withColumn("decision", F.when(F.col("decision").isin("split", "exclude_range", "keep_with_flag"), "keep").otherwise(F.col("decision")))


def common_range(ranges: DataFrame, keys: list[str], start: str = "start_ns", end: str = "end_ns") -> DataFrame:
    """What all streams of a key share: low = latest start, high = earliest end; nothing where they don't meet."""
    return ranges.groupBy(*keys).agg(F.max(start).alias("low"), F.min(end).alias("high")).where("low < high")


def physical_spans(ranges: DataFrame, blocked: DataFrame, keys: list[str]) -> DataFrame:
    """The common range without blocked intervals that overlap it."""
    common = common_range(ranges, keys)
    hit = blocked.select(*keys, "start_ns", "end_ns").join(common, keys).where("end_ns > low and start_ns < high").select(*keys, "start_ns", "end_ns")
    return subtract(common, hit, keys, "start_ns", "end_ns", "low", "high").drop("place")


def edge_idle(df: DataFrame, keys: list[str], order: str, ts: str, limits: dict[str, float], least: int = 1) -> DataFrame:
    """Leading and trailing runs in which every signal is finite and at most its limit: edge, start_ns, end_ns, rows.

    A stream that idles throughout gives both edges.
    """
    idle = F.lit(True)
    for c, most in limits.items():
        idle = idle & finite(c) & F.coalesce(F.col(c) <= most, F.lit(False))
    marked = df.withColumn("_t_idle", idle)
    bounds = marked.groupBy(*keys).agg(F.min(F.when(~F.col("_t_idle"), F.col(order))).alias("_t_first"), F.max(F.when(~F.col("_t_idle"), F.col(order))).alias("_t_last"))
    rows = marked.join(bounds, keys)
    edges = F.array(F.when(F.col("_t_first").isNull() | (F.col(order) < F.col("_t_first")), "head"), F.when(F.col("_t_last").isNull() | (F.col(order) > F.col("_t_last")), "tail"))
    out = rows.withColumn("edge", F.explode(F.array_compact(edges)))
    return out.groupBy(*keys, "edge").agg(F.min_by(ts, order).alias("start_ns"), F.max_by(ts, order).alias("end_ns"), F.count(F.lit(1)).alias("rows")).where(F.col("rows") >= least)


def static_windows(df: DataFrame, keys: list[str], order: str, flag: str, least: int, columns: list[str]) -> DataFrame:
    """Runs of still rows of at least ``least`` rows with the means of ``columns``."""
    marked = true_runs(df, keys, order, flag)
    return marked.groupBy(*keys, "run_id").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("rows"), *(F.avg(c).alias(f"mean_{c}") for c in columns)).where(F.col("rows") >= least).drop("run_id")


def missing_runs(df: DataFrame, keys: list[str], index: str) -> DataFrame:
    """Stretches of places between the first and the last that no row has."""
    w = Window.partitionBy(*keys).orderBy(index)
    d = df.select(*keys, index).distinct().withColumn("_t_p", F.lag(index).over(w)).where(F.col(index) - F.col("_t_p") > 1)
    return d.select(*keys, (F.col("_t_p") + 1).alias("first_missing"), (F.col(index) - 1).alias("last_missing"), (F.col(index) - F.col("_t_p") - 1).alias("missing"))
