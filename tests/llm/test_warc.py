"""WARC round trips, splits, false magics."""

import gzip
import hashlib
import io
import random
import zlib

import pyarrow as pa
import pytest

from tessera.llm import warc
from tessera.llm.common import scratch


def uri(spark, name):
    return scratch(spark, name)


def pages(spark):
    rng = random.Random(3)
    same = "<p>" + "copy " * 400
    rows = [(i, f"http://x/{i}\r\nEvil: 1", "".join(chr(rng.randrange(32, 1000)) for _ in range(rng.randrange(0, 4000)))) for i in range(60)]
    rows += [(100, "u", same), (101, None, same), (99, "u", same), (102, "u", "tiny"), (103, "u", "tiny"), (104, "u", None), (105, "u", ""), (None, "n", "no id"), (None, "n", same), (106, "b", "a\r\n\r\nWARC/1.1\r\n\r\n" * 90), (7, "again", "x" * 1000), (7, "again", "x" * 1000)]
    return rows, spark.createDataFrame([(*r, "z", r[0]) for r in rows], "page_id bigint, url string, html string, value string, path bigint")


@pytest.mark.parametrize("split", [700, 5000, 8 << 20])
def test_round_trip(spark, split):
    rows, df = pages(spark)
    path = uri(spark, "warc-test")
    warc.write_warc(df, path)
    got = warc.read_warc(spark, path, split).select(warc.page_of("record_id").cast("bigint").alias("id"), "type", "payload_digest", "payload_bytes", "payload", warc.page_of("refers_to").cast("bigint").alias("refers")).collect()
    assert len(got) == len(rows)
    digest = lambda h: hashlib.sha1((h or "").encode()).hexdigest()
    stays = {}
    for i, _, h in rows:
        if len((h or "").encode()) >= 1000:
            stays[digest(h)] = max(stays.get(digest(h), -1), -1 if i is None else i)
    want = sorted(((-1 if i is None else i), digest(h), len((h or "").encode()), "revisit" if stays.get(digest(h), i) not in (i, -1 if i is None else i) else "response") for i, _, h in rows)
    assert sorted((-1 if r["id"] is None else r["id"], r["payload_digest"], r["payload_bytes"], r["type"]) for r in got) == want
    for r in got:
        if r["type"] == "response":
            assert hashlib.sha1(r["payload"]).hexdigest() == r["payload_digest"] and r["refers"] is None
        else:
            assert r["payload"] is None and r["refers"] == stays[r["payload_digest"]]


def test_files_are_plain_gzip(spark):
    _, df = pages(spark)
    path = uri(spark, "warc-gzip")
    warc.write_warc(df, path)
    parts = spark.read.format("binaryFile").load(path).collect()
    whole = b"".join(gzip.decompress(bytes(p["content"])) for p in parts if p["length"])
    assert whole.count(b"WARC-Record-ID: ") == df.count()


def scan(data, split):
    """What the reader's three steps give without Spark."""
    f = pa.PythonFile(io.BytesIO(data), mode="r")
    ranges = [(b, min(len(data), b + split)) for b in range(0, len(data), split)]
    known = {a: z for b, e in ranges for a, z in warc.entries(f, len(data), b, e)}
    out = []
    for begin, entry in warc.walk(f, len(data), split, known):
        out += [(at, content) for at, content, _ in warc.chain(f, len(data), entry, min(len(data), begin + split))]
    return out


def member(content, level=6):
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(content) + c.flush()


@pytest.mark.parametrize("split", [1, 3, 64, 1000, 10**7])
def test_members_are_owned_once_despite_false_magics(split):
    rng = random.Random(split)
    fake = b"\x1f\x8b\x08" * 20 + bytes(rng.randrange(256) for _ in range(300)) + member(b"not a record")[:40] + member(b"still not one " * 20)
    records = [b"WARC/1.1\r\nX: %d\r\n\r\n" % i + (fake if i % 2 else b"text " * i) for i in range(9)]
    data = b"".join(member(r, 0 if i % 2 else 6) for i, r in enumerate(records))
    assert [c for _, c in scan(data, split)] == records


def test_empty_and_large(spark):
    assert scan(b"", 10) == []
    _, df = pages(spark)
    path = uri(spark, "warc-empty")
    warc.write_warc(df.where("false"), path)
    assert warc.read_warc(spark, path).count() == 0
    big = bytes(random.Random(1).randrange(256) for _ in range(1 << 16)) * 257
    made = warc.record("1", "u", big, hashlib.sha1(big).hexdigest(), None, False, 1)
    assert made[-1] == 0 and [warc.parse(c)["payload"] for _, c in scan(made, 1 << 22)] == [big]


SPLITS = [1, 7, 64, 333, 1000, 4096, 10**7]


def some_records(n=12):
    rng = random.Random(5)
    return [b"WARC/1.1\r\nX: %d\r\n\r\n" % i + bytes(rng.randrange(256) for _ in range(40 * i)) for i in range(n)]


@pytest.mark.parametrize("split", SPLITS)
def test_records_within_a_payload_are_no_records(split):
    inner = b"".join(member(r, k % 2 * 6) for k, r in enumerate(some_records(6)))
    records = [b"WARC/1.1\r\nfirst\r\n\r\nx", b"WARC/1.1\r\nouter\r\n\r\n" + inner, b"WARC/1.1\r\nlast\r\n\r\ny" + inner]
    data = b"".join(member(r, 0) for r in records)
    assert [c for _, c in scan(data, split)] == records


@pytest.mark.parametrize("split", SPLITS)
def test_damage_is_an_error_in_every_layout(split):
    made = [member(r) for r in some_records()]
    whole = b"".join(made)
    assert [c for _, c in scan(whole, split)] == some_records()
    at = len(b"".join(made[:7]))
    broken = bytearray(whole)
    broken[at + len(made[7]) // 2] ^= 0x55
    alien = b"".join(made[:4]) + member(b"no record at all") + b"".join(made[4:])
    cases = {"cut": (whole[:-5], len(whole) - len(made[-1])), "only": (made[3][:-9], 0), "middle": (bytes(broken), at), "alien": (alien, len(b"".join(made[:4]))), "tail": (whole + b"junk", len(whole)), "head": (b"junk" + whole, 0)}
    for name, (data, where) in cases.items():
        with pytest.raises(ValueError, match=f"no whole WARC record at byte {where} of"):
            scan(data, split)
            pytest.fail(name)


@pytest.mark.parametrize("split", SPLITS)
def test_empty_members_belong_to_the_record_before(split):
    made = some_records()
    data = b"".join(member(r) + member(b"") * (k % 3) for k, r in enumerate(made))
    assert [c for _, c in scan(data, split)] == made


@pytest.mark.parametrize("split", [200, 8 << 20])
def test_a_truncated_file_fails_the_query(spark, tmp_path, split):
    folder = tmp_path / "cut"
    folder.mkdir()
    (folder / "a.warc.gz").write_bytes(b"".join(member(r) for r in some_records())[:-3])
    with pytest.raises(Exception, match="no whole WARC record"):
        warc.read_warc(spark, str(folder), split).count()


def test_many_revisits_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(warc, "FEW", 0)
    test_round_trip(spark, 5000)
