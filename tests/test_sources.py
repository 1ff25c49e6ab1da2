"""Files, wire formats, sinks."""

import json
import struct

import pytest
from pyspark.sql import functions as F

from tessera.operators import quality
from tessera.sinks import tables
from tessera.sources import containers, files, mcap, sessions, wire


def test_metadata_and_index(spark, tmp_path):
    (tmp_path / "meta.json").write_text(json.dumps({"camera": {"fps": 30}, "id": "x"}))
    row = files.metadata(spark, str(tmp_path / "meta.json"), {"fps": "camera.fps", "id": "id", "none": "a.b"}).first()
    assert (row["fps"], row["id"], row["none"]) == ("30", "x", None)
    lines = [{"type": "frame", "seq": s, "timestamp_ns": s * 10, "segment": 0} for s in (2, 0, 1)] + [{"type": "other"}]
    (tmp_path / "index.jsonl").write_text("\n".join(map(json.dumps, lines)))
    got = files.frame_index(spark, str(tmp_path / "index.jsonl")).orderBy("frame_index").collect()
    assert [(r["frame_index"], r["timestamp_ns"]) for r in got] == [(0, 0), (1, 10), (2, 20)]


def test_csv_reviews_cameras(spark, tmp_path):
    (tmp_path / "imu.csv").write_text("timestamp_ns,ax,ay,az,gx,gy,gz\n1,0,0,9.8,0,0,0\n")
    assert files.sensor_csv(spark, str(tmp_path / "imu.csv")).first()["az"] == 9.8
    (tmp_path / "r.jsonl").write_text(json.dumps({"review_item_id": "a", "sample_source": "s", "reviews": [{"reviewer_id": "x", "decision": "d"}]}))
    assert files.reviews(spark, str(tmp_path / "r.jsonl")).first()["reviews"][0]["decision"] == "d"
    (tmp_path / "P01_01.json").write_text(json.dumps({"camera": {"id": 1, "model": "OPENCV", "width": 4, "height": 3, "params": [1.0, 2.0, 3.0, 4.0, 0.5]}, "images": {"f": [1.0]}}))
    cam = files.camera_models(spark, str(tmp_path / "P01_01.json")).first()
    assert (cam["fx"], cam["cy"], cam["distortion"], cam["registered_images"]) == (1.0, 4.0, [0.5], 1)
    found = files.ids_from_names(files.listing(spark, str(tmp_path), "*.json"))
    assert [r["video_id"] for r in found.collect()] == ["P01_01"]
    assert files.repeated_ids(found.unionByName(found)).first()["files"] == 2


def test_literals(spark):
    df = spark.createDataFrame([('{"a": 1}',), ("{'a': 2}",), ("no",)], "t string")
    got = [r["x"]["a"] if r["x"] else None for r in df.select(files.literal_or_json(F.col("t"), "a int").alias("x")).collect()]
    assert got == [1, 2, None]


def test_rates(spark):
    df = spark.createDataFrame([("s", i, t) for i, t in enumerate([0, 10, 20, 20, 80])], "k string, i bigint, t bigint")
    r = files.rates(df, ["k"], "i", "t").first()
    assert (r["mean_rate_hz"], r["median_rate_hz"]) == (5e7, 1e8)
    clip = spark.createDataFrame([("s", 3, 30.0), ("z", 0, 30.0)], "k string, n bigint, fps double")
    assert [r["timestamp_ns"] for r in files.constant_rate(clip, ["k"], "n", "fps").orderBy("frame_index").collect()] == [0, 33333333, 66666667]


def test_wire(spark):
    message = bytes([0x08, 0x96, 0x01, 0x12, 0x02]) + b"hi" + bytes([0x1D]) + struct.pack("<f", 1.5)
    assert wire.wire_fields(message) == [(1, 0, 150), (2, 2, b"hi"), (3, 5, struct.pack("<f", 1.5))]
    with pytest.raises(ValueError):
        wire.wire_fields(b"\x12\x05a")
    df = spark.createDataFrame([(1, bytearray(message)), (2, None)], "k bigint, p binary")
    got = wire.explode_wire(df, ["k"], "p")
    assert [(r["field"], r["number"]) for r in got.orderBy("place").collect()] == [(1, "150"), (2, None), (3, None)]
    assert got.where("kind = 5").select(wire.little_endian(F.col("content"), "float").alias("v")).first()["v"] == 1.5
    payload = b"\0\1\0\0" + struct.pack("<I", 2) + struct.pack("<2d", 1.0, 2.0)
    assert wire.cdr_doubles(payload) == [1.0, 2.0]
    header = b"\0\1\0\0" + struct.pack("<iII", 7, 9, 5) + b"base\0" + b"\0\0\0"
    assert wire.cdr_header(header) == (7, 9, "base", 24)


def test_containers_register(spark):
    containers.register(spark)
    assert "dataset string" in containers.Hdf5({}).schema()


def _record(kind, content):
    return struct.pack("<BQ", kind, len(content)) + content


def _string(text):
    return struct.pack("<I", len(text)) + text.encode()


def _varint(n):
    n &= (1 << 64) - 1
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def _field(number, value):
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    if isinstance(value, float):
        return _varint(number << 3 | 1) + struct.pack("<d", value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def _stamp(ns):
    return _field(1, _field(1, ns // 10**9) + _field(2, ns % 10**9))


def _mcap(messages, topics, compression="", indexed=True, chunk=3):
    """A container of (topic number, log time, payload), a few messages a chunk."""
    import zlib

    import zstandard

    schema = _record(3, struct.pack("<H", 1) + _string("some.Schema") + _string("protobuf") + struct.pack("<I", 0))
    channels = b"".join(_record(4, struct.pack("<HH", n, 1) + _string(t) + _string("protobuf") + struct.pack("<I", 0)) for n, t in enumerate(topics))
    out = mcap.MAGIC + _record(1, _string("") + _string("test"))
    index, counts = b"", {}
    for i in range(0, len(messages), chunk):
        part = messages[i : i + chunk]
        body = (schema + channels if i == 0 or not indexed else b"") + b"".join(_record(5, struct.pack("<HIQQ", n, i + k, t, t + 1) + p) for k, (n, t, p) in enumerate(part))
        packed = zstandard.ZstdCompressor().compress(body) if compression else body
        low, high = min(t for _, t, _ in part), max(t for _, t, _ in part)
        one = _record(6, struct.pack("<QQQI", low, high, len(body), zlib.crc32(body)) + _string(compression) + struct.pack("<Q", len(packed)) + packed)
        index += _record(8, struct.pack("<QQQQ", low, high, len(out), len(one)) + struct.pack("<I", 0) + struct.pack("<Q", 0) + _string(compression) + struct.pack("<QQ", len(packed), len(body)))
        out += one
        for n, _, _ in part:
            counts[n] = counts.get(n, 0) + 1
    out += _record(15, struct.pack("<I", 0))
    begin = len(out) if indexed else 0
    if indexed:
        numbers = b"".join(struct.pack("<HQ", *x) for x in counts.items())
        out += schema + channels + index + _record(11, struct.pack("<QHIIIIQQ", len(messages), 1, len(topics), 0, 0, 0, 0, 0) + struct.pack("<I", len(numbers)) + numbers)
    return out + _record(2, struct.pack("<QQI", begin, 0, 0)) + mcap.MAGIC


def _imu(ns, x):
    three = lambda *v: b"".join(_field(k + 1, float(y)) for k, y in enumerate(v))
    return _stamp(ns) + _field(3, three(x, 2, 3)) + _field(4, three(4, 5, 9.8))


@pytest.mark.parametrize("compression", ["", "zstd"])
@pytest.mark.parametrize("indexed", [True, False])
def test_mcap(spark, tmp_path, compression, indexed):
    topics = ["/imu", "/audio", "/calibration"]
    sent = [(0, 100 + 10 * i, _imu(10**9 * i + 5, i)) for i in range(7)] + [(1, 95 + i, _stamp(7 * i) + _field(2, bytes([i])) + _field(3, b"opus")) for i in range(4)]
    sent += [(2, 99, _field(2, 640) + _field(3, 480) + _field(4, b"plumb") + _field(6, struct.pack("<2d", 1.5, 2.5)) + _field(9, b"cam")), (2, 200, b"")]
    (tmp_path / "a.mcap").write_bytes(_mcap(sent, topics, compression, indexed))
    found = mcap.index(spark, str(tmp_path))
    assert found.count() == (5 if indexed else 1)
    if indexed:
        assert {r["topic"]: r["messages"] for r in mcap.topic_counts(found).collect()} == {"/imu": 7, "/audio": 4, "/calibration": 2}
    every = mcap.messages(found)
    assert sorted((r["topic"], r["log_time_ns"], bytes(r["payload"])) for r in every.collect()) == sorted((topics[n], t, p) for n, t, p in sent)
    assert {r["topic"] for r in mcap.messages(found, ["/audio"]).collect()} == {"/audio"} and mcap.messages(found, ["/none"]).count() == 0
    assert sorted(r["log_time_ns"] for r in mcap.messages(found, ["/imu"], 110, 130).collect()) == [110, 120, 130]
    imu = mcap.decoded(mcap.messages(found, ["/imu"]), mcap.IMU).orderBy("timestamp_ns").collect()
    assert [(r["timestamp_ns"], r["gx"], r["az"]) for r in imu] == [(10**9 * i + 5, float(i), 9.8) for i in range(7)]
    audio = mcap.decoded(mcap.messages(found, ["/audio"]), mcap.AUDIO).orderBy("timestamp_ns").collect()
    assert [(r["timestamp_ns"], bytes(r["data"]), r["format"]) for r in audio] == [(7 * i, bytes([i]), "opus") for i in range(4)]
    cal = mcap.decoded(mcap.first_message(found, "/calibration"), mcap.CALIBRATION).first()
    assert (cal["width"], cal["height"], cal["frame_id"], cal["K"], cal["D"]) == (640, 480, "cam", [1.5, 2.5], [])
    frames = mcap.frame_index(found, "/imu")
    assert [(r["frame_index"], r["stamp_ns"]) for r in frames.orderBy("frame_index").collect()] == [(i, 10**9 * i + 5) for i in range(7)]
    assert mcap.bounds(frames).first()["end_ns"] == 6 * 10**9 + 5
    rate = mcap.rate_hz(frames, ["path"], "stamp_ns", 25.0).first()
    assert (rate["rate_hz"], rate["dropped"]) == (1.0, 0)


def test_mcap_damage_is_an_error(spark, tmp_path):
    whole = _mcap([(0, i, _imu(i, i)) for i in range(9)], ["/imu"])
    broken = bytearray(whole)
    broken[whole.index(b"some.Schema") + 40] ^= 1
    (tmp_path / "a.mcap").write_bytes(bytes(broken))
    with pytest.raises(Exception, match="checksum"):
        mcap.messages(mcap.index(spark, str(tmp_path))).count()
    (tmp_path / "a.mcap").write_bytes(whole[:-20])
    with pytest.raises(Exception, match="cut short"):
        mcap.messages(mcap.index(spark, str(tmp_path))).count()


def test_folder_sessions(spark, tmp_path):
    for name, depth, files in (("a", {"path": "raw", "unit": "Millimeters", "format": "Z16", "frame_count": 2}, ["raw/1.png", "raw/2.png", "color_000000.mkv"]), ("b", {}, ["depth_000.mkv", "depth/1.png"]), ("c", {"path": "gone.mkv"}, [])):
        root = tmp_path / name
        (root / "imu").mkdir(parents=True)
        (root / "meta.json").write_text(json.dumps({"device": {"name": "x"}, "streams": {"color": {"fps": 30, "width": 640, "height": 480}, "depth": depth}, "recording_stats": {"total_frames": 3, "dropped_frames": 0}, "imu": {"sample_rate_hz": 200}}))
        (root / "index.jsonl").write_text("\n".join(json.dumps({"type": "frame", "seq": k, "timestamp_ns": 10 * k + 5}) for k in (2, 0, 1)))
        (root / "imu" / "imu_000000.csv").write_text("timestamp_ns,ax,ay,az,gx,gy,gz\n1,0,0,9.8,0,0,0\n6,1,0,9.8,0,0,0\n")
        for f in files:
            (root / f).parent.mkdir(exist_ok=True)
            (root / f).write_bytes(b"x")
    got = sessions.folders(spark, str(tmp_path), "rec_")
    streams = {(r["session"], r["stream"]): r for r in got.streams.collect()}
    assert set(streams) == {(f"rec_{n}", s) for n in "abc" for s in ("ego_rgb", "ego_imu")} | {("rec_a", "ego_depth"), ("rec_b", "ego_depth")}
    rgb, a, b = streams["rec_a", "ego_rgb"], streams["rec_a", "ego_depth"], streams["rec_b", "ego_depth"]
    assert (rgb["rows"], rgb["start_ns"], rgb["end_ns"], rgb["rate_hz"], rgb["width"]) == (3, 5, 25, 30.0, 640) and rgb["source"].endswith("a/color_000000.mkv")
    assert (a["source_kind"], a["files"], a["unit"], a["dtype"], a["declared_rows"], a["rows"]) == ("image_sequence", 2, "mm", "uint16", 2, 3)
    assert (b["source_kind"], b["files"], b["unit"], b["declared_rows"]) == ("video", 1, "unknown", 3)
    assert streams["rec_c", "ego_imu"]["rate_hz"] == 200.0 and got.samples.where("session = 'rec_c'").count() == 2
    assert [r["timestamp_ns"] for r in got.frames.where("session = 'rec_b' and stream = 'ego_depth'").orderBy("frame_index").collect()] == [5, 15, 25]


def test_container_sessions(spark, tmp_path):
    topics = ["/robot0/sensor/camera0/compressed", "/robot0/sensor/camera0/camera_info", "/robot0/sensor/imu", "/robot1/vio/eef_pose", "/other"]
    sent = [(0, 10 + i, _stamp(10**8 * i) + _field(2, b"h264")) for i in range(5)] + [(1, 9, _field(2, 640) + _field(3, 480)), (4, 11, b"")]
    sent += [(2, 10 + i, _imu(10**7 * i, i)) for i in range(4)] + [(3, 12, _stamp(77))]
    (tmp_path / "one.mcap").write_bytes(_mcap(sent, topics))
    (tmp_path / "two.mcap").write_bytes(_mcap(sent[:3], topics, "zstd"))
    got = sessions.containers(spark, str(tmp_path))
    streams = {(r["session"], r["stream"]): r for r in got.streams.collect()}
    assert set(streams) == {("one", "robot0/camera0"), ("one", "robot0/imu"), ("one", "robot1/eef_pose"), ("two", "robot0/camera0")}
    cam = streams["one", "robot0/camera0"]
    assert (cam["kind"], cam["rows"], cam["end_ns"], cam["rate_hz"], cam["width"], cam["height"]) == ("video", 5, 4 * 10**8, 10.0, 640, 480)
    assert streams["two", "robot0/camera0"]["width"] is None and streams["one", "robot0/imu"]["rate_hz"] == 100.0
    assert sorted(r["values"]["gx"] for r in got.samples.collect()) == [0.0, 1.0, 2.0, 3.0]
    assert got.frames.where("session = 'one'").count() == 5


def test_settings(spark, tmp_path):
    (tmp_path / "base.json").write_text(json.dumps({"a": {"b": 1, "c": [1, 2]}, "d": "x"}))
    (tmp_path / "own.json").write_text(json.dumps({"a": {"b": 5}, "e": None}))
    both = files.settings(spark, str(tmp_path / "base.json")).unionByName(files.settings(spark, str(tmp_path / "own.json"), 1)).withColumn("p", F.lit("p"))
    got = quality.layered(both, ["p"], "path", "value", "layer")
    assert {r["path"]: r["value"] for r in got.collect()} == {"a.b": "5", "a.c": "[1, 2]", "d": "x"}
    assert quality.config_hash(got, ["p"], "path", "value").first()["settings"] == 3



def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("b", 1, None)], "k string, n bigint, v string")
    got = tables.numbered(df, ["k"], ["n"]).orderBy("k", "n").collect()
    assert [r["issue_id"] for r in got] == ["iss_000001", "iss_000002", "iss_000001"]
    doc = json.loads(tables.documents(df, ["k"], ["n"]).orderBy("k").first()["document"])
    assert doc == {"k": "a", "count": 2, "items": [{"n": 1, "v": "x"}, {"n": 2, "v": "y"}]}
    tables.write_partitioned(df, str(tmp_path / "out"), ["k"])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    hashes = df.select(tables.content_hash(["v", "n"]).alias("a"), tables.content_hash(["n", "v"]).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in hashes)
    old = spark.createDataFrame([("p", "1"), ("q", "2")], "k string, c string")
    new = spark.createDataFrame([("p", "9"), ("r", "3")], "k string, c string")
    assert sorted(tuple(r) for r in tables.upsert_immutable(old, new, "k", "c").collect()) == [("p", "1", True), ("q", "2", False), ("r", "3", False)]
    flat = tables.flat_lists(spark.createDataFrame([([1, 2], {"a": 1})], "l array<int>, m map<string,int>")).first()
    assert (flat["l"], flat["m"]) == ("1,2", '{"a":1}')
