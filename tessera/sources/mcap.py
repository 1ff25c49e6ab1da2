"""MCAP containers: an index of their chunks, and the messages of the chunks that are wanted.

Files are listed by Spark; a first pass reads each file's summary alone (channels, chunk index, message counts), so that counts
and presence of topics cost no data, and times prune chunks.  A second pass deals out chunks, so a large file is read by many
tasks; each decompresses a chunk at a time and yields Arrow batches.  A file without a summary is one chunk.  Compression is
none or zstd; a chunk compressed otherwise is an error, as is a record that is cut short.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.sources.wire import wire_fields

MAGIC = b"\x89MCAP0\r\n"
#: Record kinds of the format that are read here.
SCHEMA, CHANNEL, MESSAGE, CHUNK, CHUNK_INDEX, STATISTICS, FOOTER = 3, 4, 5, 6, 8, 11, 2
_BATCH = 4 << 20
_INDEX = "path string, size bigint, offset bigint, length bigint, start_ns bigint, end_ns bigint, channels map<int,struct<topic:string,encoding:string,schema:string>>, counts map<int,bigint>"


def _text(data: bytes, at: int) -> tuple[str, int]:
    (n,) = struct.unpack_from("<I", data, at)
    return data[at + 4 : at + 4 + n].decode("utf-8", "replace"), at + 4 + n


def records(data: bytes) -> Iterator[tuple[int, bytes]]:
    """(kind, content) of each record of a stretch of a file."""
    at = 0
    while at < len(data):
        if at + 9 > len(data):
            raise ValueError(f"a record is cut short at byte {at}")
        kind, size = struct.unpack_from("<BQ", data, at)
        if at + 9 + size > len(data):
            raise ValueError(f"a record of {size} bytes is cut short at byte {at}")
        yield kind, data[at + 9 : at + 9 + size]
        at += 9 + size


def _channel(content: bytes, schemas: dict[int, str]) -> tuple[int, tuple[str, str, str | None]]:
    number, schema = struct.unpack_from("<HH", content)
    topic, at = _text(content, 4)
    encoding, _ = _text(content, at)
    return number, (topic, encoding, schemas.get(schema))


def summary(file, size: int) -> tuple[dict, dict[int, int] | None, list[tuple[int, int, int, int]]]:
    """(channels, messages by channel or None, chunks as (offset, length, start, end)) of a file."""
    if file.read_at(8, 0) != MAGIC:
        raise ValueError("no MCAP file")
    tail = file.read_at(37, size - 37)
    whole = [(8, size - 8, 0, (1 << 63) - 1)]
    if len(tail) < 37 or tail[-8:] != MAGIC or tail[0] != FOOTER:
        return {}, None, whole
    (begin,) = struct.unpack_from("<Q", tail, 9)
    if not begin:
        return {}, None, [(8, size - 45, 0, (1 << 63) - 1)]
    schemas: dict[int, str] = {}
    channels, counts, chunks = {}, None, []
    for kind, c in records(file.read_at(size - 37 - begin, begin)):
        if kind == SCHEMA:
            schemas[struct.unpack_from("<H", c)[0]] = _text(c, 2)[0]
        elif kind == CHANNEL:
            number, of = _channel(c, schemas)
            channels[number] = of
        elif kind == CHUNK_INDEX:
            start, end, offset, length = struct.unpack_from("<QQQQ", c)
            chunks.append((offset, length, start, end))
        elif kind == STATISTICS:
            (n,) = struct.unpack_from("<I", c, 42)
            counts = {k: v for k, v in struct.iter_unpack("<HQ", c[46 : 46 + n])}
    return channels, counts, chunks or ([(8, size - 45, 0, (1 << 63) - 1)] if not counts or sum(counts.values()) else [])


def _opened(path: str):
    fs, name = pafs.FileSystem.from_uri(path)
    return fs.open_input_file(name)


def index(spark: SparkSession, path: str) -> DataFrame:
    """One row per chunk of every file at ``path``: where it lies, its times, the file's channels and counts (null if unknown)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", F.col("length").alias("size"))

    def run(parts):
        for part in parts:
            out = []
            for where, size in zip(part["path"], part["size"], strict=True):
                with _opened(where) as f:
                    channels, counts, chunks = summary(f, size)
                named = {k: {"topic": t, "encoding": e, "schema": s} for k, (t, e, s) in channels.items()}
                out += [(where, size, *c, named, counts) for c in chunks or [(0, 0, 0, 0)]]
            yield pd.DataFrame(out, columns=["path", "size", "offset", "length", "start_ns", "end_ns", "channels", "counts"])

    return files.mapInPandas(run, _INDEX)


def topic_counts(found: DataFrame) -> DataFrame:
    """(path, topic, messages) from the index alone; files whose summary has no counts are left out (count their messages)."""
    one = found.where("counts is not null").dropDuplicates(["path"])
    every = one.select("path", "counts", F.explode("channels").alias("channel", "c"))
    return every.groupBy("path", F.col("c.topic").alias("topic")).agg(F.sum(F.coalesce(F.col("counts")[F.col("channel")], F.lit(0))).alias("messages"))


def messages(found: DataFrame, topics: list[str] | None = None, start_ns: int | None = None, end_ns: int | None = None) -> DataFrame:
    """path, topic, schema, encoding, sequence, log_time_ns, publish_time_ns, payload of the messages, chunk by chunk.

    ``topics`` and the times (by log time, both ends included) leave out chunks and messages before they are decoded further.
    """
    low, high = start_ns if start_ns is not None else -(1 << 63), end_ns if end_ns is not None else (1 << 63) - 1
    wanted = set(topics) if topics is not None else None
    of = found.where((F.col("length") > 0) & (F.col("end_ns") >= low) & (F.col("start_ns") <= high))
    if wanted is not None:
        known = F.transform(F.map_values("channels"), lambda c: c["topic"])
        of = of.where((F.size("channels") == 0) | F.arrays_overlap(known, F.array(*map(F.lit, sorted(wanted)))))
    fields = [("path", pa.string()), ("topic", pa.string()), ("schema", pa.string()), ("encoding", pa.string()), ("sequence", pa.int64()), ("log_time_ns", pa.int64()), ("publish_time_ns", pa.int64()), ("payload", pa.binary())]

    def inner(data: bytes, channels: dict, schemas: dict) -> Iterator[bytes]:
        for kind, c in records(data):
            if kind == SCHEMA:
                schemas[struct.unpack_from("<H", c)[0]] = _text(c, 2)[0]
            elif kind == CHANNEL:
                number, held = _channel(c, schemas)
                channels[number] = held if held[2] is not None or number not in channels else channels[number]
            elif kind == CHUNK:
                yield from inner(unpacked(c), channels, schemas)
            elif kind == MESSAGE:
                yield c

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(fields)], names=[n for n, _ in fields])

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                channels = {k: (v["topic"], v["encoding"], v["schema"]) for k, v in r["channels"] or []}
                with _opened(r["path"]) as f:
                    data = f.read_at(r["length"], r["offset"])
                rows, size = [], 0
                for c in inner(data, channels, {}):
                    number, sequence, log, publish = struct.unpack_from("<HIQQ", c)
                    topic, encoding, schema = channels[number]
                    if (wanted is None or topic in wanted) and low <= log <= high:
                        rows.append((r["path"], topic, schema, encoding, sequence, log, publish, c[22:]))
                        size += len(c)
                    if size > _BATCH:
                        yield batch(rows)
                        rows, size = [], 0
                yield batch(rows)

    return of.select("path", "offset", "length", "channels").mapInArrow(run, "path string, topic string, schema string, encoding string, sequence bigint, log_time_ns bigint, publish_time_ns bigint, payload binary")


def unpacked(chunk: bytes) -> bytes:
    """The records of a chunk record, decompressed and held against its checksum (0: none)."""
    _, _, size, crc = struct.unpack_from("<QQQI", chunk)
    how, at = _text(chunk, 28)
    (n,) = struct.unpack_from("<Q", chunk, at)
    data = chunk[at + 8 : at + 8 + n]
    if how == "zstd":
        import zstandard

        data = zstandard.ZstdDecompressor().decompress(data, max_output_size=size)
    elif how:
        raise ValueError(f"chunks compressed by {how} can't be read")
    if len(data) != size or crc and zlib.crc32(data) != crc:
        raise ValueError("a chunk's content doesn't fit its size or checksum")
    return data


def frame_index(found: DataFrame, topic: str) -> DataFrame:
    """The messages of a topic in each file by log time: frame_index from 0, stamp_ns of a protobuf message's first field (seconds,
    nanoseconds), log and publish times."""
    of = decoded(messages(found, [topic]), {"stamp_ns": ((1,), "stamp")})
    w = Window.partitionBy("path").orderBy("log_time_ns", "sequence")
    return of.select("path", (F.row_number().over(w) - 1).cast("bigint").alias("frame_index"), "stamp_ns", "log_time_ns", "publish_time_ns")


def bounds(frames: DataFrame) -> DataFrame:
    """(path, start_ns, end_ns) of a frame index."""
    return frames.groupBy("path").agg(F.min("stamp_ns").alias("start_ns"), F.max("stamp_ns").alias("end_ns"))


def first_message(found: DataFrame, topic: str) -> DataFrame:
    """The first message of a topic in each file, as a calibration is: (path, payload)."""
    return messages(found, [topic]).groupBy("path").agg(F.min_by("payload", F.struct("log_time_ns", "sequence")).alias("payload"))


#: Fields of the messages that recordings use: where a value stands in the nested protobuf message, and how it is read.
IMU = {"timestamp_ns": ((1,), "stamp"), "gx": ((3, 1), "double"), "gy": ((3, 2), "double"), "gz": ((3, 3), "double"), "ax": ((4, 1), "double"), "ay": ((4, 2), "double"), "az": ((4, 3), "double")}
AUDIO = {"timestamp_ns": ((1,), "stamp"), "data": ((2,), "bytes"), "format": ((3,), "text")}
CALIBRATION = {"frame_id": ((9,), "text"), "width": ((2,), "integer"), "height": ((3,), "integer"), "distortion_model": ((4,), "text"), "D": ((5,), "doubles"), "K": ((6,), "doubles"), "R": ((7,), "doubles"), "P": ((8,), "doubles")}
_KINDS = {"stamp": "bigint", "double": "double", "integer": "bigint", "bytes": "binary", "text": "string", "doubles": "array<double>"}


def _at(data: bytes, path: tuple[int, ...], how: str):
    for depth, field in enumerate(path):
        found = [(k, v) for f, k, v in wire_fields(data) if f == field]
        if depth < len(path) - 1 or how == "stamp":
            data = found[-1][1] if found else b""
    if how == "stamp":
        of = {f: v for f, k, v in wire_fields(data) if k == 0}
        signed = lambda v: v - (1 << 64) if v >> 63 else v
        return signed(of.get(1, 0)) * 1_000_000_000 + signed(of.get(2, 0))
    if how == "doubles":
        return [x for k, v in found for (x,) in struct.iter_unpack("<d", v)]
    if not found:
        return {"double": 0.0, "integer": 0, "bytes": b"", "text": ""}[how]
    value = found[-1][1]
    return struct.unpack("<d", value)[0] if how == "double" else value.decode("utf-8", "replace") if how == "text" else value


def decoded(found: DataFrame, fields: dict[str, tuple[tuple[int, ...], str]]) -> DataFrame:
    """``found`` with columns read from its protobuf ``payload``, which goes; fields that a message lacks have their zero."""
    kept = [c for c in found.columns if c != "payload"]
    types = {"bigint": pa.int64(), "double": pa.float64(), "binary": pa.binary(), "string": pa.string(), "array<double>": pa.list_(pa.float64())}
    schema = ", ".join([*(f"{c} {found.schema[c].dataType.simpleString()}" for c in kept), *(f"{n} {_KINDS[how]}" for n, (_, how) in fields.items())])

    def run(batches):
        for b in batches:
            payloads = b.column(len(kept)).to_pylist()
            made = [pa.array([_at(p or b"", path, how) for p in payloads], types[_KINDS[how]]) for path, how in fields.values()]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(kept))), *made], names=[*kept, *fields])

    return found.select(*kept, "payload").mapInArrow(run, schema)


def rate_hz(df: DataFrame, keys: list[str], ts: str, default: float) -> DataFrame:
    """(keys, rate_hz, dropped): 10^9 over the median interval of the sorted times, and how many intervals exceed twice it."""
    w = Window.partitionBy(*keys).orderBy(ts)
    gaps = df.withColumn("_t_g", F.col(ts) - F.lag(ts).over(w))
    middle = gaps.groupBy(*keys).agg(F.percentile("_t_g", F.lit(0.5)).alias("_t_m"))
    rate: Column = F.when(F.col("_t_m") > 0, F.lit(1e9) / F.col("_t_m")).otherwise(F.lit(default))
    return gaps.join(middle, keys).groupBy(*keys, "_t_m").agg(F.count_if(F.col("_t_g") > 2 * F.col("_t_m")).alias("dropped")).select(*keys, F.round(rate, 1).alias("rate_hz"), "dropped")
