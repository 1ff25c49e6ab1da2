"""Privacy: strong identifiers by rule, redaction of text, run statistics, routing, smoothing of regions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds of strong identifiers and their patterns, in order of priority.
STRONG = (
    ("id_card", r"\b\d{17}[\dXx]\b"),
    ("id_card", r"\b\d{15}\b"),
    ("phone", r"\b1[3-9]\d{9}\b"),
    ("bank_card", r"\b\d{13,19}\b"),
)


def strong_identifier(text: Column) -> Column:
    """The kind of the first pattern found, or an empty string."""
    out = F.when(text.rlike(STRONG[0][1]), STRONG[0][0])
    for kind, pattern in STRONG[1:]:
        out = out.when(text.rlike(pattern), kind)
    return out.otherwise("")


def redacted(text: Column, mark: str = "[REDACTED]") -> Column:
    """The text with all strong identifiers replaced."""
    for _, pattern in STRONG:
        text = F.regexp_replace(text, pattern, mark)
    return text


def classify_distinct(df: DataFrame, text: str, classify) -> DataFrame:
    """``df`` with ``category``: ``classify`` (a DataFrame with text to one with text, category) sees each text once."""
    known = classify(df.select(text).distinct())
    return df.join(known, text, "left")


def run_statistics(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Frames, regions, distinct categories, and whether the model was there on the last frame."""
    return df.groupBy(*keys).agg(F.count_distinct(order).alias("frames"), F.count("category").alias("regions"), F.array_sort(F.collect_set("category")).alias("categories"), F.max_by("model_available", order).alias("model_available"))


def privacy_view(df: DataFrame) -> DataFrame:
    """Runs without a model at the end are flagged."""
    return df.withColumn("disposition", F.when(F.col("model_available"), "pass").otherwise("keep_with_flag"))


def smooth_regions(df: DataFrame, key: str, frame: str, box: list[str], least_iou: float = 0.3) -> DataFrame:
    """Boxes averaged with the best overlapping smoothed box of the previous frame; sequential within a video."""

    def overlap(a, b) -> float:
        w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
        inter = max(0.0, w) * max(0.0, h)
        union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - inter
        return inter / union if union > 0 else 0.0

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values([frame, *box]).reset_index(drop=True)
        boxes, out = part[box].to_numpy(dtype=float).tolist(), []
        before, now, at = [], [], None
        for f, own in zip(part[frame].tolist(), boxes, strict=True):
            if f != at:
                before, now, at = now, [], f
            best = max(before, key=lambda b: overlap(own, b), default=None)  # noqa: B023
            if best is not None and overlap(own, best) >= least_iou:
                own = [(x + y) / 2 for x, y in zip(own, best, strict=True)]
            now.append(own)
            out.append(own)
        part[box] = out
        return part

    return df.groupBy(key).applyInPandas(run, df.schema)


def sampled(df: DataFrame, key: str, ts: str, interval_ns: int) -> DataFrame:
    """``df`` with ``inferred``: at least ``interval_ns`` after the last inferred row (the first is); sequential."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(ts).reset_index(drop=True)
        out, last = [], None
        for t in part[ts].tolist():
            hit = last is None or t - last >= interval_ns
            out.append(hit)
            last = t if hit else last
        return part.assign(inferred=out)

    return df.groupBy(key).applyInPandas(run, f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in df.schema.fields)}, inferred boolean")
