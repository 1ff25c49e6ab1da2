"""Streaming twins: continuity with the order in which rows arrive, sessions, tumbling counts, dedup, monotonic guards.

A file or broker source keeps a stream's rows in order within a micro-batch by ``order``; state carries the last time, the
group number and the last order seen, so any number of micro-batches gives what the batch operator gives for a constant gap.
Rows that come late by ``order`` are given out as ``late`` and don't change the state.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE = "last_order bigint, last_ts bigint, grp bigint"


def continuity(rows: DataFrame, key: str, order: str, ts: str, gap_ns: int) -> DataFrame:
    """(key, order, ts, delta_ns, continuity_group, continuity_start_reason) of a streaming table (BIGINT columns).

    Reasons are those of the batch operator with a constant threshold, and ``late`` for rows whose order has passed.
    """
    schema = f"{key} bigint, {order} bigint, {ts} bigint, delta_ns bigint, continuity_group bigint, continuity_start_reason string"

    def run(name: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last_order, last_ts, group = state.get if state.exists else (None, None, 0)
        out = []
        part = pd.concat(list(parts), ignore_index=True).sort_values(order, kind="stable")
        for o, t in zip(part[order].tolist(), part[ts].tolist(), strict=True):
            if last_order is not None and o <= last_order:
                out.append((name[0], o, t, 0, group, "late"))
                continue
            delta = 0 if last_ts is None else t - last_ts
            reason = "stream_start" if last_ts is None else "timestamp_rollback" if delta < 0 else "timestamp_duplicate" if delta == 0 else "timestamp_gap" if delta > gap_ns else ""
            group += reason not in ("", "stream_start")
            out.append((name[0], o, t, delta, group, reason))
            last_order, last_ts = o, t
        state.update((last_order, last_ts, group))
        yield pd.DataFrame(out, columns=[key, order, ts, "delta_ns", "continuity_group", "continuity_start_reason"])

    return rows.groupBy(key).applyInPandasWithState(run, schema, STATE, "append", GroupStateTimeout.NoTimeout)


def sessions(rows: DataFrame, key: str, at: str, gap: str, late: str) -> DataFrame:
    """Sessions of a key's rows that are at most ``gap`` apart, with their rows; rows later than ``late`` are dropped."""
    w = F.session_window(at, gap)
    return rows.withWatermark(at, late).groupBy(key, w).agg(F.count(F.lit(1)).alias("rows")).select(key, F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), "rows")


def windows(rows: DataFrame, keys: list[str], at: str, value: str, length: str, late: str, slide: str | None = None) -> DataFrame:
    """Counts and sums over tumbling (or sliding) windows."""
    w = F.window(at, length, slide) if slide else F.window(at, length)
    return rows.withWatermark(at, late).groupBy(*keys, w).agg(F.count(F.lit(1)).alias("rows"), F.sum(value).alias("total")).select(*keys, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "rows", "total")


def distinct_rows(rows: DataFrame, keys: list[str], at: str, late: str) -> DataFrame:
    """The first row of each key within the watermark."""
    return rows.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def forced_increasing(rows: DataFrame, key: str, order: str, ts: str) -> DataFrame:
    """Times made strictly increasing: each is at least one more than the one before."""
    schema = f"{key} bigint, {order} bigint, {ts} bigint, model_ts bigint"

    def run(name: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        out = []
        for o, t in pd.concat(list(parts), ignore_index=True).sort_values(order)[[order, ts]].itertuples(index=False):
            last = int(t) if last is None else max(last + 1, int(t))
            out.append((name[0], int(o), int(t), last))
        state.update((last,))
        yield pd.DataFrame(out, columns=[key, order, ts, "model_ts"])

    return rows.groupBy(key).applyInPandasWithState(run, schema, "last bigint", "append", GroupStateTimeout.NoTimeout)


def run_once(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Work off all there is and give the written rows."""
    query = stream.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
