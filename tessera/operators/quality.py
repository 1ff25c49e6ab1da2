"""Findings to statuses: counts, lattices, metrics, cascades, views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def grouped_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """The total and the counts by each column by itself, in one pass: (by, value, n)."""
    sets = df.groupingSets([[], *([c] for c in columns)], *columns).agg(F.grouping_id().alias("_t_g"), F.count(F.lit(1)).alias("n"))
    full = (1 << len(columns)) - 1
    by, value = F.when(F.col("_t_g") == full, "total"), F.lit(None).cast("string")
    for i, c in enumerate(columns):
        mine = F.col("_t_g") == full - (1 << (len(columns) - 1 - i))
        by, value = by.when(mine, c), F.when(mine, F.col(c).cast("string")).otherwise(value)
    return sets.select(by.alias("by"), value.alias("value"), "n")


def overall(df: DataFrame, keys: list[str], severity: str = "severity") -> DataFrame:
    """Per key: passed (no fatal, no error) and disposition (fatal: reject; error or warn: quarantine; else pass)."""
    has = lambda *s: F.coalesce(F.bool_or(F.col(severity).isin(*s)), F.lit(False))
    return df.groupBy(*keys).agg((~has("fatal", "error")).alias("passed"), F.when(has("fatal"), "reject").when(has("error", "warn"), "quarantine").otherwise("pass").alias("disposition"))


def quality_status(df: DataFrame, keys: list[str], severity: str = "severity") -> DataFrame:
    """quality_status as it has always been (error, then warn or warning; critical and fatal alone pass), and strict_status,
    in which they fail."""
    has = lambda *s: F.coalesce(F.bool_or(F.col(severity).isin(*s)), F.lit(False))
    rule = lambda bad: F.when(has(*bad), "fail").when(has("warn", "warning"), "warning").otherwise("pass")
    return df.groupBy(*keys).agg(rule(["error"]).alias("quality_status"), rule(["error", "critical", "fatal"]).alias("strict_status"))


def metrics(df: DataFrame, keys: list[str], detail: str, default: float = 0.8) -> DataFrame:
    """A row per number in a map<string, double>: name, value, and the threshold under ``<name>_threshold`` or the default."""
    long = df.select(*keys, F.col(detail).alias("_t_d"), F.explode(detail).alias("name", "value")).where(F.col("value").isNotNull())
    return long.select(*keys, "name", "value", F.coalesce(F.element_at("_t_d", F.concat(F.col("name"), F.lit("_threshold"))), F.lit(default)).alias("threshold"))


def stop_at_fatal(df: DataFrame, keys: list[str], stage: str = "stage", severity: str = "severity") -> DataFrame:
    """Rows up to and including the first stage with a fatal one."""
    first = F.min(F.when(F.col(severity) == "fatal", F.col(stage))).over(Window.partitionBy(*keys))
    return df.withColumn("_t_stop", first).where(F.col("_t_stop").isNull() | (F.col(stage) <= F.col("_t_stop"))).drop("_t_stop")


def decisions_to_issues(df: DataFrame, start: str, end: str) -> DataFrame:
    """Decisions of four dispositions as issues: no interval means the whole scope, reversed ones are turned."""
    kept = df.where(F.col("disposition").isin("keep_with_flag", "split", "quarantine", "reject"))
    a = F.coalesce("timestamp_ns", start)
    b = F.coalesce("end_timestamp_ns", F.when(F.col("timestamp_ns").isNull(), F.col(end)).otherwise(F.col("timestamp_ns")))
    return kept.withColumns({"issue_start_ns": F.least(a, b), "issue_end_ns": F.greatest(a, b)})


def normalised_action(action: Column) -> Column:
    """Legacy range actions are splits."""
    return F.when(action.isin("trim", "exclude_range", "keep_with_flag"), "split").otherwise(action)


def lookup(value: Column, table: dict[str, str], default: str) -> Column:
    return F.coalesce(F.create_map(*(F.lit(x) for kv in table.items() for x in kv))[value], F.lit(default))


def completeness(df: DataFrame, keys: list[str], disposition: str = "disposition") -> DataFrame:
    """The worst of the assets' dispositions: reject over keep_with_flag over pass, with counts."""
    of = lambda d: F.count_if(F.col(disposition) == d)
    return df.groupBy(*keys).agg(F.when(of("reject") > 0, "reject").when(of("keep_with_flag") > 0, "keep_with_flag").otherwise("pass").alias("disposition"), of("reject").alias("rejected"), of("keep_with_flag").alias("flagged"), F.count(F.lit(1)).alias("assets"))


def views(df: DataFrame, keys: list[str], rules: list[tuple[str, Column]]) -> DataFrame:
    """usable: all rules hold; reason: the name of the first that doesn't; reasons: all of them."""
    failing = F.array_compact(F.array(*(F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules)))
    return df.select(*keys, (F.size(failing) == 0).alias("usable"), F.try_element_at(failing, F.lit(1)).alias("reason"), failing.alias("reasons"))


def view_decisions(df: DataFrame) -> DataFrame:
    """Views as decisions: usable ones pass, others are quarantined with their reason."""
    return df.withColumn("disposition", F.when(F.col("usable"), "pass").otherwise("quarantine")).withColumn("severity", F.when(F.col("usable"), "info").otherwise("warn"))


def coverage(a: DataFrame, b: DataFrame, keys: list[str], start: str, end: str, tolerance: int) -> DataFrame:
    """How much of a's range b covers: overlap, ratio, starts_late, ends_early (by over the tolerance)."""
    rename = {start: "_t_s", end: "_t_e"}
    j = a.join(b.withColumnsRenamed(rename), keys)
    overlap = F.greatest(F.lit(0).cast("bigint"), F.least(F.col(end), F.col("_t_e")) - F.greatest(F.col(start), F.col("_t_s")))
    length = F.col(end) - F.col(start)
    return j.select(*keys, overlap.alias("overlap"), F.when(length > 0, overlap / length).otherwise(0.0).alias("ratio"), (F.col("_t_s") - F.col(start) > tolerance).alias("starts_late"), (F.col(end) - F.col("_t_e") > tolerance).alias("ends_early"))


def inventory(sides: dict[str, DataFrame], key: str) -> DataFrame:
    """Full outer join of key lists: has_<side> flags; repeated keys count once."""
    flagged = [df.select(key).distinct().withColumn(f"has_{n}", F.lit(True)) for n, df in sides.items()]
    out = reduce(lambda x, y: x.join(y, key, "full"), flagged)
    return out.select(key, *(F.coalesce(f"has_{n}", F.lit(False)).alias(f"has_{n}") for n in sides))


def unknown_values(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Values of an array column that aren't allowed."""
    return df.withColumn("unknown", F.array_except(column, F.array(*(F.lit(a) for a in allowed)))).where(F.size("unknown") > 0)


def missing_keys(required: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Required keys that nothing has."""
    return required.select(*keys).distinct().join(present.select(*keys).distinct(), keys, "left_anti")


def union_of(frames: list[DataFrame]) -> DataFrame:
    """Detectors' outputs as one table; missing columns are null."""
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)


def applicable(df: DataFrame, profiles: DataFrame, key: str, flag: str) -> DataFrame:
    """Rows whose profile says so; profiles are a small dimension, and unknown ones don't apply."""
    return df.join(profiles.where(F.col(flag)).select(key).distinct(), key, "left_semi")


def first_evidence(df: DataFrame, keys: list[str], order: str, value: str, most: int) -> DataFrame:
    """The first ``most`` values of each key by order, as an array, and how many there are; only those rows are gathered."""
    ranked = df.withColumn("_t_r", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))
    n = F.count(F.lit(1)).alias("n")
    kept = F.array_sort(F.collect_list(F.when(F.col("_t_r") <= most, F.struct("_t_r", F.col(value).alias("v")))))
    return ranked.groupBy(*keys).agg(n, F.transform(kept, lambda x: x["v"]).alias("evidence"))


def every_kth(df: DataFrame, keys: list[str], order: str, most: int) -> DataFrame:
    """At most ``most`` rows of each key, evenly spaced: places int(i * n / most), or all rows if they are few."""
    w = Window.partitionBy(*keys)
    placed = df.withColumns({"_t_i": F.row_number().over(w.orderBy(order)) - 1, "_t_n": F.count(F.lit(1)).over(w)})
    step = F.col("_t_n") / most
    slot = F.ceil(F.col("_t_i") / step)
    hit = (F.col("_t_n") <= most) | ((slot < most) & (F.floor(slot * step) == F.col("_t_i")))
    return placed.where(hit).drop("_t_i", "_t_n")


#: Fixed values of the older rule: it takes a recording to have 983 samples, 50 a second, and leaves the last 10 frames alone.
LEGACY_SAMPLES, LEGACY_INTERVAL_S, LEGACY_LAST = 983, 0.02, 10


def legacy_span(frames: DataFrame, head: DataFrame, gaps: DataFrame, keys: list[str], order: str, ts: str, factor: float = 3.0) -> DataFrame:
    """(keys, start_ns, end_ns, frames, head_frames, tail_frames) of each stream by the older rule.

    ``head`` is ``head_black_span``'s start_ns.  The last of ``gaps`` (sample_index, gap_s) that is longer than ``factor`` usual
    intervals, and whose place in proportion to ``LEGACY_SAMPLES`` is a frame but one of the first or last, ends the span there;
    else the last frame does.  A span lasts a second at least.
    """
    placed = frames.select(*keys, F.col(ts).alias("_t_t"), (F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1).alias("_t_i"))
    of = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_t_n"), F.min_by("_t_t", "_t_i").alias("_t_first"), F.max_by("_t_t", "_t_i").alias("_t_last"))
    at = F.floor(F.col("sample_index") / LEGACY_SAMPLES * F.col("_t_n"))
    long = gaps.where(F.col("gap_s") > factor * LEGACY_INTERVAL_S).join(of, keys).withColumn("_t_i", at).where((F.col("_t_i") > 0) & (F.col("_t_i") < F.col("_t_n") - LEGACY_LAST))
    cut = long.groupBy(*keys).agg(F.max_by("_t_i", "sample_index").alias("_t_i")).join(placed, [*keys, "_t_i"]).select(*keys, F.col("_t_t").alias("_t_tail"))
    start = F.greatest("_t_first", "_t_head")
    spans = of.join(head.select(*keys, F.col("start_ns").alias("_t_head")), keys, "left").join(cut, keys, "left").select(*keys, start.alias("start_ns"), F.greatest(start + 1_000_000_000, F.coalesce("_t_tail", "_t_last")).alias("end_ns"))
    before, after = F.col("_t_t") < F.col("start_ns"), F.col("_t_t") > F.col("end_ns")
    return placed.join(spans, keys).groupBy(*keys, "start_ns", "end_ns").agg(F.count_if(~before & ~after).alias("frames"), F.count_if(before).alias("head_frames"), F.count_if(after).alias("tail_frames"))


def layered(layers: DataFrame, keys: list[str], path: str, value: str, layer: str) -> DataFrame:
    """(keys, path, value, layer): of the settings that several layers give, that of the highest layer.

    ``path`` is a setting's place in the nested configuration, dots between; a layer that gives a null doesn't override.
    """
    best = layers.where(F.col(value).isNotNull()).groupBy(*keys, path).agg(F.max(F.struct(layer, value)).alias("_t_b"))
    return best.select(*keys, path, F.col(f"_t_b.{value}").alias(value), F.col(f"_t_b.{layer}").alias(layer))


def config_hash(settings: DataFrame, keys: list[str], path: str, value: str) -> DataFrame:
    """(keys, settings, config_sha256): a hash of each configuration's sorted path=value lines."""
    lines = F.array_sort(F.collect_list(F.concat_ws("=", path, value)))
    return settings.groupBy(*keys).agg(F.count(F.lit(1)).alias("settings"), F.sha2(F.array_join(lines, "\n"), 256).alias("config_sha256"))


def head_black_span(df: DataFrame, keys: list[str], order: str, ts: str, flag: str, least_ns: int, least_rows: int = 3) -> DataFrame:
    """Where a stream starts after its leading flagged rows: the next row's time if these last ``least_ns`` or are ``least_rows``
    or more, else the first row's; a stream that is flagged throughout starts at its first row."""
    first = df.groupBy(*keys).agg(F.min(F.when(~F.coalesce(F.col(flag), F.lit(False)), F.col(order))).alias("_t_clear"))
    rows = df.join(first, keys)
    lead = F.col(order) < F.col("_t_clear")
    g = rows.groupBy(*keys).agg(F.count_if(lead).alias("black_rows"), F.max(F.when(lead, F.col(ts))).alias("_t_z"), F.min_by(ts, order).alias("_t_a"), F.min(F.when(F.col(order) == F.col("_t_clear"), F.col(ts))).alias("_t_next"))
    cut = (F.col("black_rows") > 0) & ((F.col("_t_z") - F.col("_t_a") >= least_ns) | (F.col("black_rows") >= least_rows))
    return g.select(*keys, F.coalesce("black_rows", F.lit(0)).alias("black_rows"), F.when(F.coalesce(cut, F.lit(False)), F.col("_t_next")).otherwise(F.col("_t_a")).alias("start_ns"))
