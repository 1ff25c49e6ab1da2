"""Clipping streams to segments, boxes, annotations, masks, sample offsets."""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.asof import nearest


def clip(rows: DataFrame, segments: DataFrame, keys: list[str], ts: str, start: str, end: str, closed: bool = False) -> DataFrame:
    """Rows within their key's segments, times from the segment's start: half-open [start, end), or closed.

    A key may have many segments; a row comes once for each it is in.
    """
    inside = F.col(ts) <= F.col(end) if closed else F.col(ts) < F.col(end)
    return rows.join(segments, keys).where((F.col(ts) >= F.col(start)) & inside).withColumn(ts, F.col(ts) - F.col(start))


def clip_spans(spans: DataFrame, segments: DataFrame, keys: list[str], first: str, past: str, start: str, end: str) -> DataFrame:
    """Half-open spans cut to their key's segment and counted from its start; those that don't meet it go."""
    j = spans.join(segments, keys).where((F.col(first) < F.col(end)) & (F.col(past) > F.col(start)))
    return j.withColumns({first: F.greatest(F.col(first), F.col(start)) - F.col(start), past: F.least(F.col(past), F.col(end)) - F.col(start)})


def box_valid(x1, y1, x2, y2, w, h) -> Column:
    x1, y1, x2, y2, w, h = (F.col(c) if isinstance(c, str) else F.lit(c) if isinstance(c, (int, float)) else c for c in (x1, y1, x2, y2, w, h))
    return (x1 >= 0) & (x1 < x2) & (x2 <= w) & (y1 >= 0) & (y1 < y2) & (y2 <= h)


def box_clip(df: DataFrame, box: list[str], w: float, h: float) -> DataFrame:
    """Boxes clamped to the image, with was_clipped and area (0 where nothing is left)."""
    limits = [w, h, w, h]
    new = [F.least(F.greatest(F.col(c).cast("double"), F.lit(0.0)), F.lit(float(m))) for c, m in zip(box, limits, strict=True)]
    clipped = F.lit(False)
    for c, n in zip(box, new, strict=True):
        clipped = clipped | (F.col(c) != n)
    out = df.withColumns({f"_t_{c}": n for c, n in zip(box, new, strict=True)}).withColumn("was_clipped", clipped)
    out = out.withColumns({c: F.col(f"_t_{c}") for c in box}).drop(*(f"_t_{c}" for c in box))
    x1, y1, x2, y2 = (F.col(c) for c in box)
    return out.withColumn("area", F.greatest(x2 - x1, F.lit(0.0)) * F.greatest(y2 - y1, F.lit(0.0)))


def iou(a: list[Column], b: list[Column]) -> Column:
    """Intersection over union of two boxes; 0 where both are empty."""
    side = lambda i: F.greatest(F.lit(0.0), F.least(a[i + 2], b[i + 2]) - F.greatest(a[i], b[i]))
    area = lambda x: F.greatest(F.lit(0.0), x[2] - x[0]) * F.greatest(F.lit(0.0), x[3] - x[1])
    inter = side(0) * side(1)
    union = area(a) + area(b) - inter
    return F.when(union > 0, inter / union).otherwise(0.0)


def dilate(box: list[Column], ratio: float, w: float, h: float) -> list[Column]:
    """A box grown by ``ratio`` of its sides each way, inside the image."""
    dx, dy = (box[2] - box[0]) * ratio, (box[3] - box[1]) * ratio
    return [F.greatest(F.lit(0.0), box[0] - dx), F.greatest(F.lit(0.0), box[1] - dy), F.least(F.lit(float(w)), box[2] + dx), F.least(F.lit(float(h)), box[3] + dy)]


def letterbox_inverse(box: list[Column], scale: Column, pad_x: Column, pad_y: Column, w: float, h: float) -> list[Column]:
    """Boxes of a scaled and padded image back in the original, clamped."""
    back = lambda c, pad, m: F.least(F.greatest((c - pad) / scale, F.lit(0.0)), F.lit(float(m)))
    return [back(box[0], pad_x, w), back(box[1], pad_y, h), back(box[2], pad_x, w), back(box[3], pad_y, h)]


def project(x: Column, y: Column, z: Column, fx: float, fy: float, cx: float, cy: float) -> tuple[Column, Column]:
    """Pinhole projection; null behind the camera."""
    ok = z > 0
    return F.when(ok, fx * x / z + cx), F.when(ok, fy * y / z + cy)


def expand_annotations(rows: DataFrame, keys: list[str], output: DataFrame, ts: str, start: str, end: str, segments: DataFrame) -> DataFrame:
    """Annotations (frame_index, ts, hand_bbox, object_bbox arrays) as hand and object rows on the nearest output frame.

    Half-open clip to the segment; boxes that are missing or all zero give no row; object rows carry their hand's id.
    ``output`` has output_frame_index and source_ts per key.
    """
    inside = rows.join(segments, keys).where((F.col(ts) >= F.col(start)) & (F.col(ts) < F.col(end)))
    near = nearest(inside, output, keys, ts, "source_ts", "output_frame_index").where("match_index is not null")
    real = lambda c: F.col(c).isNotNull() & F.coalesce(F.exists(c, lambda v: v != 0), F.lit(False))
    hand = F.concat_ws("_", F.lit("hand"), *(F.col(k).cast("string") for k in keys), F.col("frame_index").cast("string"))
    sides = F.array(F.when(real("hand_bbox"), F.struct(F.lit("hand").alias("kind"), F.col("hand_bbox").alias("bbox"), F.lit(None).cast("string").alias("linked_id"))), F.when(real("hand_bbox") & real("object_bbox"), F.struct(F.lit("object").alias("kind"), F.col("object_bbox").alias("bbox"), hand.alias("linked_id"))))
    out = near.withColumn("x", F.explode(F.array_compact(sides)))
    return out.select(*keys, "frame_index", F.col("match_index").alias("output_frame_index"), (F.col(ts) - F.col(start)).alias("timestamp_ns"), F.col("offset_ns").alias("mapping_error_ns"), "x.*")


def overlapping(actions: DataFrame, segments: DataFrame, keys: list[str], a_start: str, a_end: str, start: str, end: str) -> DataFrame:
    """Action intervals that overlap a segment (closed), reversed ones left out, cut to it."""
    j = actions.where(F.col(a_end) >= F.col(a_start)).join(segments, keys).where((F.col(a_start) <= F.col(end)) & (F.col(a_end) >= F.col(start)))
    return j.withColumns({"clip_start_ns": F.greatest(a_start, start), "clip_end_ns": F.least(a_end, end)})


def positions(df: DataFrame, keys: list[str], order: str, by: list[str] = (), name: str = "position") -> DataFrame:
    """Running place (from 0) per stream and file, taken before any filter."""
    return df.withColumn(name, (F.row_number().over(Window.partitionBy(*keys, *by).orderBy(order)) - 1).cast("bigint"))


def sample_offsets(df: DataFrame, keys: list[str], order: str, samples: int = 960) -> DataFrame:
    """Packets' places with the samples before them, all of ``samples``."""
    return positions(df, keys, order, name="packet_index").withColumn("sample_offset", F.col("packet_index") * samples)


def audio_silence(df: DataFrame, keys: list[str], value: str, threshold: float) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg((F.abs(value) < threshold).cast("double")).alias("silence_ratio"))


def duration_mismatch(df: DataFrame, duration: str, packets: str, packet_s: float = 0.02, tolerance_s: float = 0.5) -> DataFrame:
    """Rows whose duration is off their packets' by over the tolerance."""
    return df.withColumn("expected_s", F.col(packets) * packet_s).where(F.abs(F.col(duration) - F.col("expected_s")) > tolerance_s)


def valid_manipulation(speed: str, delta: str, most_speed: float, most_delta: float) -> Column:
    """|speed| or |gripper delta| over its threshold; what is no number counts as not."""
    over = lambda c, t: F.coalesce(F.abs(F.expr(f"try_cast({c} as double)")) > t, F.lit(False))
    return over(speed, most_speed) | over(delta, most_delta)


def handedness(label: Column) -> Column:
    """Left, Right or Unknown from names, initials and 0/1 classes."""
    x = F.lower(F.trim(label.cast("string")))
    return F.when(x.isin("left", "l", "0", "left_hand"), "Left").when(x.isin("right", "r", "1", "right_hand"), "Right").otherwise("Unknown")


#: Distortion models that can be undone.
DISTORTION_MODELS = ("plumb_bob", "rational_polynomial", "opencv", "equidistant", "fisheye", "kannala_brandt")


def undistortion_plan(model: Column, coefficients: Column, calibrated: Column) -> Column:
    """What is to be done with a camera's frames: missing_calibration, unsupported_calibration, identity or applied."""
    zero = F.forall(coefficients, lambda c: F.abs(c) <= 1e-8)
    known = F.lower(F.trim(model)).isin(*DISTORTION_MODELS)
    return F.when(~calibrated | coefficients.isNull(), "missing_calibration").when(~F.coalesce(known, F.lit(False)), "unsupported_calibration").when(zero, "identity").otherwise("applied")


def hand_frames(df: DataFrame, keys: list[str], frame: str, box: list[str], score: str) -> DataFrame:
    """Per frame of hand detections: the largest box (ties: the first by its corners) and the best score; negative frames go."""
    area = F.greatest(F.lit(0.0), F.col(box[2]) - F.col(box[0])) * F.greatest(F.lit(0.0), F.col(box[3]) - F.col(box[1]))
    best = F.max(F.struct(area.alias("a"), *((-F.col(c)).alias(c) for c in box)))
    out = df.where(F.col(frame) >= 0).groupBy(*keys, frame).agg(best.alias("_t_b"), F.max(score).alias("completeness"))
    return out.select(*keys, frame, F.col("_t_b.a").alias("area"), *((-F.col(f"_t_b.{c}")).alias(c) for c in box), "completeness")


def index_groups(df: DataFrame, keys: list[str], order: str, index: str, ts: str, gap_ns: int) -> DataFrame:
    """``df`` with a group that grows where the index jumps by over one, or the time by over the gap; unknown times (null) carry
    the last known one."""
    w = Window.partitionBy(*keys).orderBy(order)
    before = F.last(ts, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    jump = F.coalesce(F.col(index) - F.lag(index).over(w) > 1, F.lit(False)) | F.coalesce(F.col(ts) - before > gap_ns, F.lit(False))
    return df.withColumn("_t_j", jump.cast("int")).withColumn("continuity_group", F.sum("_t_j").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_t_j")


def encode_mask(mask: np.ndarray) -> list[int]:
    """Run lengths of a binary mask, column by column, starting with zeros."""
    flat = np.asarray(mask, bool).ravel(order="F")
    edges = np.flatnonzero(np.diff(flat)) + 1
    cuts = np.concatenate(([0], edges, [flat.size]))
    lengths = np.diff(cuts).tolist()
    return ([0] if flat.size and flat[0] else []) + lengths


def decode_mask(counts: list[int], height: int, width: int) -> np.ndarray:
    """The mask of run lengths; they must cover it exactly."""
    values = np.repeat(np.arange(len(counts)) % 2 == 1, counts)
    if values.size != height * width:
        raise ValueError("run lengths do not cover the mask")
    return values.reshape((height, width), order="F")


def mask_area(counts: Column) -> Column:
    """Set pixels of run lengths: every second one."""
    return F.aggregate(F.transform(counts, lambda x, i: F.when(i % 2 == 1, x).otherwise(0)), F.lit(0).cast("bigint"), lambda s, x: s + x.cast("bigint"))


def ogg_page(segments: bytes, content: bytes, serial: int, number: int, granule: int, flags: int) -> bytes:
    """One Ogg page: its header with the checksum, the segment table, the content."""
    page = struct.pack("<4sBBqIIIB", b"OggS", 0, flags, granule, serial, number, 0, len(segments)) + segments + content
    return page[:22] + struct.pack("<I", ogg_crc(page)) + page[26:]


def ogg_opus(packets: list[bytes], channels: int = 1, rate: int = 48_000, preskip: int = 0, vendor: str = "tessera", serial: int = 1, samples: int = 960) -> bytes:
    """An Ogg Opus file of raw packets in order: a page with OpusHead, one with OpusTags, then at most 32 packets a page.

    The granule position counts the samples (of 48 kHz) that a page's packets complete; the last page adds ``preskip``.  A packet
    that does not fit in a page's 255 segments goes on in the next one, which says so; a page that ends no packet has granule -1.
    """
    if not packets:
        raise ValueError("no packets")
    named = vendor.encode()
    head = struct.pack("<8sBBHIhB", b"OpusHead", 1, channels, preskip, rate, 0, 0)
    tags = struct.pack("<8sI", b"OpusTags", len(named)) + named + struct.pack("<I", 0)
    laid: list[tuple[bytes, bytes, int, bool]] = []  # segments, content, packets that end, whether it goes on from before
    held, content, ends, continued = bytearray(), bytearray(), 0, False

    def close(goes_on: bool) -> None:
        nonlocal held, content, ends, continued
        laid.append((bytes(held), bytes(content), ends, continued))
        held, content, ends, continued = bytearray(), bytearray(), 0, goes_on

    for p in packets:
        sizes = bytes([255] * (len(p) // 255) + [len(p) % 255])
        if ends == 32 or held and len(held) + len(sizes) > 255 >= len(sizes):
            close(False)
        at = 0
        while sizes:
            part, sizes = sizes[: 255 - len(held)], sizes[255 - len(held) :]
            held += part
            content += p[at : at + sum(part)]
            at += sum(part)
            if sizes:
                close(True)
        ends += 1
    close(False)
    out, done = [ogg_page(bytes([len(head)]), head, serial, 0, 0, 2), ogg_page(bytes([255] * (len(tags) // 255) + [len(tags) % 255]), tags, serial, 1, 0, 0)], 0
    for n, (sizes, data, count, goes_on) in enumerate(laid):
        done += samples * count
        last = n == len(laid) - 1
        out.append(ogg_page(sizes, data, serial, n + 2, done + preskip if last else done if count else -1, (4 if last else 0) | (1 if goes_on else 0)))
    return b"".join(out)


def opus_files(df: DataFrame, keys: list[str], order: str, payload: str, **how) -> DataFrame:
    """(keys, packets, content): each stream's packets by ``order`` as one Ogg Opus file; null packets are left out."""
    kinds = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)

    def run(part: pd.DataFrame) -> pd.DataFrame:
        packets = [bytes(p) for p in part.sort_values(order)[payload]]
        return pd.DataFrame([(*part[keys].iloc[0], len(packets), ogg_opus(packets, **how))], columns=[*keys, "packets", "content"])

    return df.where(F.col(payload).isNotNull()).select(*keys, order, payload).groupBy(*keys).applyInPandas(run, f"{kinds}, packets bigint, content binary")


def ogg_crc(data: bytes) -> int:
    """CRC-32 with polynomial 0x04C11DB7, not reflected, from 0."""
    crc = 0
    for byte in data:
        crc ^= byte << 24
        for _ in range(8):
            crc = ((crc << 1) ^ 0x04C11DB7) & 0xFFFFFFFF if crc & 0x80000000 else (crc << 1) & 0xFFFFFFFF
    return crc
