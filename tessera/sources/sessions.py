"""Recording sessions as tables: what streams a session has, their frames and their samples; many sessions are read at once.

Every reader gives a ``Session`` of three tables, with the session's id in each:

* streams: session, stream, kind (video, depth, imu, audio, encoder, pose), source, rows, start_ns, end_ns, rate_hz, width,
  height, and for depth source_kind, dtype, unit, declared_rows, files;
* frames: session, stream, frame_index, timestamp_ns;
* samples: session, stream, timestamp_ns, values map<string,double>.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.sources import mcap
from tessera.sources.files import IMU, INDEX, rates

#: Other names of depth units and pixel types.
UNITS = {"millimeter": "mm", "millimeters": "mm", "millimetre": "mm", "millimetres": "mm", "meter": "m", "meters": "m", "metre": "m", "metres": "m"}
DTYPES = {"y16": "uint16", "z16": "uint16", "gray16": "uint16", "gray16le": "uint16", "uint16_t": "uint16"}
STREAM = "session string, stream string, kind string, source string, rows bigint, start_ns bigint, end_ns bigint, rate_hz double, width bigint, height bigint, source_kind string, dtype string, unit string, declared_rows bigint, files bigint"
#: The last part of a topic, the kind of its stream, and how messages of that kind are read.
TOPICS = {"camera0/compressed": "video", "camera1/compressed": "video", "camera2/compressed": "video", "depth/compressed": "depth", "sensor/imu": "imu", "sensor/audio": "audio", "sensor/magnetic_encoder": "encoder", "vio/eef_pose": "pose"}


@dataclass
class Session:
    streams: DataFrame
    frames: DataFrame
    samples: DataFrame


def named(value: Column, names: dict[str, str]) -> Column:
    """A unit or type in its usual name; ``unknown`` where there is none."""
    low = F.lower(F.trim(value))
    other = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))[low]
    return F.when(F.coalesce(low, F.lit("")) == "", "unknown").otherwise(F.coalesce(other, low))


def _folder(path: Column, depth: int) -> Column:
    """The name of the folder ``depth`` levels above a file."""
    return F.element_at(F.split(path, "/"), -depth)


def _ranges(rows: DataFrame, order: str) -> DataFrame:
    ends = rows.groupBy("session", "stream").agg(F.count(F.lit(1)).alias("rows"), F.min("timestamp_ns").alias("start_ns"), F.max("timestamp_ns").alias("end_ns"))
    return ends.join(rates(rows, ["session", "stream"], order, "timestamp_ns").select("session", "stream", F.col("median_rate_hz").alias("rate_hz")), ["session", "stream"])


def _shaped(rows: DataFrame) -> DataFrame:
    """All columns of ``STREAM``, null where the reader knows none."""
    kinds = dict(x.rsplit(" ", 1) for x in STREAM.split(", "))
    return rows.select(*(F.col(n).cast(t).alias(n) if n in rows.columns else F.lit(None).cast(t).alias(n) for n, t in kinds.items()))


def depth_sources(files: DataFrame, declared: DataFrame) -> DataFrame:
    """(session, source_kind, files, source) of each session's raw depth: what its metadata declare and is there, else videos named
    for depth, else images; ``missing`` where there is none.

    ``files``: (session, relative, path); ``declared``: (session, relative), a file or a folder.
    """
    image, video = F.col("relative").rlike(r"(?i)\.(png|tif|tiff)$"), F.col("relative").rlike(r"\.(mkv|mp4)$")
    folder = F.regexp_extract("relative", r"^(.*?)/?[^/]*$", 1)
    d = declared.select("session", F.regexp_replace("relative", r"/+$", "").alias("_t_d"))
    own = files.join(d, "session").withColumn("_t_f", folder)
    inside = (F.col("_t_f") == F.col("_t_d")) & image
    beside = image & F.col("_t_d").rlike(r"(?i)\.(png|tif|tiff)$") & (F.col("_t_f") == F.regexp_extract("_t_d", r"^(.*?)/?[^/]*$", 1))
    said = own.where(inside | beside).select("session", "path", F.lit(0).alias("rank"), F.lit("image_sequence").alias("source_kind"))
    said = said.unionByName(own.where((F.col("relative") == F.col("_t_d")) & ~image).select("session", "path", F.lit(0).alias("rank"), F.lit("video").alias("source_kind")))
    at_root = F.col("relative").rlike(r"^(depth_[^/]*|depth/[^/]*)$")
    found = files.where(at_root & video).select("session", "path", F.lit(1).alias("rank"), F.lit("video").alias("source_kind"))
    found = found.unionByName(files.where(at_root & image).select("session", "path", F.lit(2).alias("rank"), F.lit("image_sequence").alias("source_kind")))
    every = said.unionByName(found).distinct()
    best = every.withColumn("_t_b", F.min("rank").over(Window.partitionBy("session"))).where("rank = _t_b")
    chosen = best.groupBy("session").agg(F.max("source_kind").alias("source_kind"), F.count(F.lit(1)).alias("files"), F.min("path").alias("source"))
    return files.select("session").distinct().join(chosen, "session", "left").na.fill({"source_kind": "missing", "files": 0})


def folders(spark: SparkSession, root: str, prefix: str = "") -> Session:
    """Sessions as folders below ``root``: meta.json, index.jsonl, imu/*.csv, color_*.mkv, raw depth; ids are ``prefix`` and the folder.

    The index's frames are the time line of colour and depth.  A session without depth has no depth stream.
    """
    text = spark.read.option("wholetext", True).text(f"{root}/*/meta.json").select(F.concat(F.lit(prefix), _folder(F.col("_metadata.file_path"), 2)).alias("session"), "value")
    get = lambda p: F.get_json_object("value", f"$.{p}")
    first = lambda *ps: F.coalesce(*(get(f"streams.depth.{p}") for p in ps))
    meta = text.select(
        "session", get("streams.color.fps").cast("double").alias("fps"), get("streams.color.width").alias("width"), get("streams.color.height").alias("height"), get("imu.sample_rate_hz").cast("double").alias("imu_rate"),
        F.coalesce(first("frame_count"), get("recording_stats.total_frames")).alias("declared_rows"), named(first("unit", "depth_unit", "measurement_unit"), UNITS).alias("unit"), named(first("dtype", "data_type", "pixel_type", "format"), DTYPES).alias("dtype"),
        first("fps").cast("double").alias("depth_fps"), first("width").alias("depth_width"), first("height").alias("depth_height"), F.array_compact(F.array(*(get(f"streams.depth.{p}") for p in ("uri", "path", "file", "filename")))).alias("declared"),
    )
    index = spark.read.schema(INDEX).option("mode", "FAILFAST").json(f"{root}/*/index.jsonl").select(F.concat(F.lit(prefix), _folder(F.col("_metadata.file_path"), 2)).alias("session"), "*")
    place = F.row_number().over(Window.partitionBy("session").orderBy("seq")) - 1
    frames = index.where("type = 'frame'").select("session", F.lit("ego_rgb").alias("stream"), place.cast("bigint").alias("frame_index"), "timestamp_ns")
    csv = spark.read.schema(IMU).option("header", True).csv(f"{root}/*/imu/*.csv").select(F.concat(F.lit(prefix), _folder(F.col("_metadata.file_path"), 3)).alias("session"), "*")
    axes = ("ax", "ay", "az", "gx", "gy", "gz")
    samples = csv.select("session", F.lit("ego_imu").alias("stream"), "timestamp_ns", F.create_map(*(x for a in axes for x in (F.lit(a), F.col(a)))).alias("values"))
    paths = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    plain = lambda c: F.regexp_replace(c, r"^(\w+):/+", "$1:/")  # noqa: E731  the two ways that Spark writes a local path
    at = spark.read.format("binaryFile").load(f"{root}/*/meta.json").select(F.regexp_replace(plain("path"), "/meta.json$", "").alias("_t_at"), F.concat(F.lit(prefix), _folder(F.col("path"), 2)).alias("session"))
    parts = F.split(plain("path"), "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    base = paths.withColumn("_t_at", F.explode(above)).join(at, "_t_at")
    files = base.select("session", "path", F.expr("substr(regexp_replace(path, '^(\\\\w+):/+', '$1:/'), length(_t_at) + 2)").alias("relative"))
    colour = files.where(F.col("relative").rlike(r"^color_\d+\.mkv$")).groupBy("session").agg(F.min("path").alias("source"))
    video = _ranges(frames, "frame_index").join(meta.select("session", "width", "height", "fps"), "session").join(colour, "session", "left").withColumns({"kind": F.lit("video"), "rate_hz": F.col("fps")})
    imu = _ranges(samples, "timestamp_ns").join(meta.select("session", "imu_rate"), "session").withColumns({"kind": F.lit("imu"), "rate_hz": F.coalesce("imu_rate", "rate_hz")})
    declared = meta.select("session", F.explode("declared").alias("relative"))
    depth = depth_sources(files.select("session", "relative", "path"), declared).where("source_kind <> 'missing'")
    depth = depth.join(video.select("session", "rows", "start_ns", "end_ns", "fps"), "session").join(meta.select("session", "declared_rows", "unit", "dtype", "depth_fps", "depth_width", "depth_height"), "session")
    depth = depth.select("session", F.lit("ego_depth").alias("stream"), F.lit("depth").alias("kind"), "source", "rows", "start_ns", "end_ns", F.coalesce("depth_fps", "fps").alias("rate_hz"), F.col("depth_width").alias("width"), F.col("depth_height").alias("height"), "source_kind", "dtype", "unit", "declared_rows", "files")
    streams = reduce(DataFrame.unionByName, (_shaped(x) for x in (video, imu, depth)))
    with_depth = frames.join(depth.select("session"), "session", "left_semi").withColumn("stream", F.lit("ego_depth"))
    return Session(streams, frames.unionByName(with_depth), samples)


def containers(spark: SparkSession, path: str, prefix: str = "") -> Session:
    """Sessions as MCAP files at ``path``: a session a file (ids: ``prefix`` and its name), a stream a topic that ``TOPICS`` names, "robot0/camera0" and the like;
    robots are told apart by the topics, so recordings of one or of two are read alike.

    Times are the messages' stamps.  A rate is 10^9 over the median positive interval; sizes are those of the camera_info or
    calibration topic beside a camera's.
    """
    found = mcap.index(spark, path)
    kind = reduce(lambda out, kv: F.when(F.col("topic").endswith(kv[0]), kv[1]).otherwise(out), TOPICS.items(), F.lit(None).cast("string"))
    session = F.concat(F.lit(prefix), F.regexp_extract("path", r"([^/]+?)(?:\.[^/.]*)?$", 1))
    stream = F.regexp_replace(F.regexp_replace(F.regexp_replace("topic", "^/", ""), "/compressed$", ""), "/(sensor|vio)/", "/")
    every = mcap.messages(found)
    of = every.withColumns({"session": session, "stream": stream, "kind": kind})
    known = mcap.decoded(of.where("kind is not null").select("session", "stream", "kind", "path", "log_time_ns", "sequence", "payload"), {"timestamp_ns": ((1,), "stamp")})
    place = F.row_number().over(Window.partitionBy("session", "stream").orderBy("log_time_ns", "sequence")) - 1
    frames = known.where("kind in ('video', 'depth')").select("session", "stream", place.cast("bigint").alias("frame_index"), "timestamp_ns")
    imu = mcap.decoded(of.where("kind = 'imu'").select("session", "stream", "payload"), mcap.IMU)
    axes = [a for a in mcap.IMU if a != "timestamp_ns"]
    samples = imu.select("session", "stream", "timestamp_ns", F.create_map(*(x for a in axes for x in (F.lit(a), F.col(a)))).alias("values"))
    about = of.where(F.col("topic").rlike("/(camera_info|calibration)$")).groupBy("session", F.regexp_replace("stream", "/(camera_info|calibration)$", "").alias("stream")).agg(F.min_by("payload", F.struct("log_time_ns", "sequence")).alias("payload"))
    sizes = mcap.decoded(about, mcap.CALIBRATION).select("session", "stream", "width", "height")
    kinds = known.groupBy("session", "stream").agg(F.min("kind").alias("kind"), F.min("path").alias("source"))
    streams = _ranges(known.select("session", "stream", "timestamp_ns"), "timestamp_ns").join(kinds, ["session", "stream"]).join(sizes, ["session", "stream"], "left")
    return Session(_shaped(streams), frames, samples)
