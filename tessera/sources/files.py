"""Recordings' plain files as tables: metadata, frame indexes, sensor CSV, reviews, calibrations, inventories."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

INDEX = "type string, seq bigint, timestamp_ns bigint, segment bigint"
IMU = "timestamp_ns bigint, ax double, ay double, az double, gx double, gy double, gz double"
REVIEW = "review_item_id string, sample_source string, reviews array<struct<reviewer_id:string,decision:string,boundary_type:string,confidence:double>>, adjudication struct<adjudicator_id:string,decision:string,boundary_type:string,confidence:double>"


def metadata(spark: SparkSession, path: str, fields: dict[str, str]) -> DataFrame:
    """One row per JSON document: ``fields`` maps column names to dotted paths; missing ones are null."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("source"), "value")
    return raw.select("source", *(F.get_json_object("value", f"$.{p}").alias(n) for n, p in fields.items()))


def frame_index(spark: SparkSession, path: str) -> DataFrame:
    """The frame rows of JSON lines with their file and place by seq; malformed lines are an error."""
    rows = spark.read.schema(INDEX).option("mode", "FAILFAST").json(path).where("type = 'frame'").withColumn("source", F.col("_metadata.file_path"))
    place = F.row_number().over(Window.partitionBy("source").orderBy("seq")) - 1
    return rows.drop("type").withColumn("frame_index", place.cast("bigint"))


def sensor_csv(spark: SparkSession, path: str, schema: str = IMU) -> DataFrame:
    """CSV with a header, columns by schema."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def reviews(spark: SparkSession, path: str) -> DataFrame:
    """Review JSON lines, strictly; an array that was encoded as a string is decoded."""
    return spark.read.schema(REVIEW).option("mode", "FAILFAST").json(path)


def nested_array(column: Column, schema: str) -> Column:
    """An array that may come as JSON text."""
    return F.from_json(column, schema, {"mode": "PERMISSIVE"})


def literal_or_json(text: Column, schema: str) -> Column:
    """JSON, or a Python literal of strings, numbers, True, False and None, as a value of ``schema``."""
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"\bTrue\b", "true"), r"\bFalse\b", "false"), r"\bNone\b", "null")
    quoted = F.replace(plain, F.lit("'"), F.lit('"'))
    return F.coalesce(F.from_json(text, schema), F.from_json(quoted, schema))


def camera_models(spark: SparkSession, path: str) -> DataFrame:
    """Camera JSON (camera: id, model, width, height, params) as rows; empty where there is no such file content."""
    schema = "camera struct<id:int,model:string,width:int,height:int,params:array<double>>, images map<string,array<double>>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path).withColumn("source", F.col("_metadata.file_path"))
    p = F.col("camera.params")
    return rows.select("source", "camera.id", "camera.model", "camera.width", "camera.height", p[0].alias("fx"), p[1].alias("fy"), p[2].alias("cx"), p[3].alias("cy"), F.slice(p, 5, 100).alias("distortion"), F.size("images").alias("registered_images"))


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files below a folder without their content: path, name, bytes, modified."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return found.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def file_hashes(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """SHA-256 of each file's content."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return found.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def ids_from_names(files: DataFrame, pattern: str = r"(P\d{2}_\d{2,3})") -> DataFrame:
    """Files with the id in their names; files without one are left out."""
    return files.withColumn("video_id", F.regexp_extract("name", pattern, 1)).where("video_id <> ''")


def repeated_ids(files: DataFrame) -> DataFrame:
    """Ids that over one file has: an error for whoever needs them unique."""
    return files.groupBy("video_id").agg(F.count(F.lit(1)).alias("files"), F.array_sort(F.collect_list("path")).alias("paths")).where("files > 1")


def preferred(candidates: DataFrame, keys: list[str], rank: str, value: str) -> DataFrame:
    """Of each key's candidates the one with the smallest rank (ties: the smallest value)."""
    return candidates.groupBy(*keys).agg(F.min(F.struct(rank, value)).alias("_t_x")).select(*keys, f"_t_x.{value}")


def rates(df: DataFrame, keys: list[str], order: str, ts: str) -> DataFrame:
    """Rates by the mean interval and by the median positive interval; null where there is none."""
    d = df.withColumn("_t_d", F.col(ts) - F.lag(ts).over(Window.partitionBy(*keys).orderBy(order)))
    mean, middle = F.avg("_t_d"), F.median(F.when(F.col("_t_d") > 0, F.col("_t_d")))
    return d.groupBy(*keys).agg(F.when(mean > 0, 1e9 / mean).alias("mean_rate_hz"), F.when(middle > 0, 1e9 / middle).alias("median_rate_hz"))


def constant_rate(streams: DataFrame, keys: list[str], frames: str, fps: str) -> DataFrame:
    """A row per frame with its time at a constant rate, rounded half to even."""
    out = streams.where(F.col(frames) > 0).withColumn("frame_index", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(frames) - 1)))
    return out.select(*keys, "frame_index", F.bround(F.col("frame_index") * 1e9 / F.col(fps), 0).cast("bigint").alias("timestamp_ns"))


def settings(spark: SparkSession, path: str, layer: int = 0) -> DataFrame:
    """(path, value, layer) of the leaves of the JSON objects at ``path``, places joined by dots; lists are one value each."""
    whole = spark.read.option("wholetext", True).text(path)

    def run(parts):
        for part in parts:
            rows = []
            for text in part["value"]:
                held = [("", json.loads(text))]
                while held:
                    at, x = held.pop()
                    if isinstance(x, dict):
                        held += [(f"{at}.{k}" if at else k, v) for k, v in x.items()]
                    else:
                        rows.append((at, None if x is None else x if isinstance(x, str) else json.dumps(x)))
            yield pd.DataFrame(rows, columns=["path", "value"])

    return whole.mapInPandas(run, "path string, value string").withColumn("layer", F.lit(layer))
