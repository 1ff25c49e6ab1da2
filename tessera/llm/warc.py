"""WARC archives: a writer through Spark's own file commit, and a splittable reader.

Every record is one gzip member.  The writer's files are parts of a Spark write (text sink, whose separator supplies the
last byte of each member, which is zero), so they go to any store that Spark writes to, and a lost or repeated task leaves
no partial file.

The reader deals out byte ranges.  A task scans its range for the gzip magic, validates each candidate by decoding its header
and follows the chain of whole records from there to the range's end; it reports where the chain enters and where it leaves.
A walk over a file's ranges from byte 0 (a row a range, not a record) then tells the true entry of each range, so that a record
that lies within another's payload is never taken for one, and a byte where the chain breaks (a record that is damaged or cut
short, a member that is no record) is an error wherever the ranges are cut.  Last, every task reads the records that start
inside its range.  Ranges are read through ``pyarrow.fs`` in windows, so memory holds one record and one window; files are
listed by Spark.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import join_groups, small_batches, utf8, written

MAGIC = b"\x1f\x8b\x08"
SPLIT = 8 << 20
#: Payloads shorter than this are not worth a revisit record.
LEAST_BYTES = 1000
#: Up to so many revisits (about 100 bytes each) are broadcast, so that payloads stay where they are; more are shuffled.
FEW = 200_000
_WINDOW = 1 << 18
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_DATE = "1970-01-01T00:00:00Z"


def _base32(hexed: str) -> str:
    return base64.b32encode(bytes.fromhex(hexed)).decode()


def _member(data: bytes, level: int) -> bytes:
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    out = pack.compress(data) + pack.flush()
    if out[-1]:  # 16 MiB and more: the size's highest byte isn't zero; an empty member's is
        pack = zlib.compressobj(level, zlib.DEFLATED, 31)
        out += pack.flush()
    return out


def _uri(url: str | None) -> str:
    return "".join(c if 32 < ord(c) < 127 else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in url or "about:blank") or "about:blank"


def record(page: str | None, url: str | None, payload: bytes, digest: str, refers: str | None, revisit: bool, level: int = 6) -> bytes:
    """One gzip member: a response with its payload, or a revisit with headers alone."""
    name = "" if page is None else page
    http = _HTTP % len(payload)
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {_DATE}", f"WARC-Target-URI: {_uri(url)}",
        "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{_base32(digest)}",
    ]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers or ''}>"]
    head += [f"Content-Length: {len(block)}", "", ""]
    return _member("\r\n".join(head).encode() + block + b"\r\n\r\n", level)


def revisits(pages: DataFrame, page_id: str = "page_id", payload: str = "html", least: int = LEAST_BYTES) -> DataFrame:
    """(_t_id, _t_digest, _t_refers): the rows that become revisits.

    Of equal payloads of at least ``least`` bytes, rows with the largest id stay responses (null ids count as smallest).
    """
    body = utf8(payload)
    narrow = pages.where(F.length(body) >= least).select(F.col(page_id).alias("_t_id"), F.sha1(body).alias("_t_digest"))
    narrow = written(narrow, "payloads")
    groups = narrow.groupBy("_t_digest").agg(F.max("_t_id").alias("_t_refers"), F.count(F.lit(1)).alias("_t_n")).where("_t_n > 1")
    return join_groups(narrow, groups, "_t_digest", "_t_n", narrow.count()).where(~F.col("_t_id").eqNullSafe(F.col("_t_refers"))).select("_t_id", "_t_digest", "_t_refers").distinct()


def write_warc(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html", least: int = LEAST_BYTES, level: int = 6) -> None:
    """Write a record per row of ``pages`` below ``path``.  Null payloads are empty, null urls about:blank."""
    small_batches(pages.sparkSession)
    body = utf8(payload)
    rows = pages.select(F.col(page_id).alias("_t_id"), F.col(url).cast("string").alias("_t_url"), body.alias("_t_body"), F.sha1(body).alias("_t_digest"))
    seen = written(revisits(pages, page_id, payload, least), "revisits")
    seen = F.broadcast(seen) if seen.count() <= FEW else seen
    joined = rows.alias("l").join(seen.alias("r"), F.col("l._t_id").eqNullSafe(F.col("r._t_id")) & (F.col("l._t_digest") == F.col("r._t_digest")), "left")
    dealt = joined.select(F.col("l._t_id").cast("string").alias("id"), "l._t_url", "l._t_body", "l._t_digest", F.col("r._t_refers").cast("string").alias("refers"), F.col("r._t_digest").isNotNull().alias("revisit"))

    def run(batches):
        for b in batches:
            made = [record(i, u, p, d, r, v, level)[:-1] for i, u, p, d, r, v in zip(*(c.to_pylist() for c in b.columns), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["value"])

    dealt.mapInArrow(run, "value binary").select(F.col("value").cast("string")).write.option("lineSep", "\x00").text(path)


class _Bytes:
    """Sequential reads of a file from an offset, in windows."""

    def __init__(self, file, at: int, size: int) -> None:
        self.file, self.at, self.size = file, at, size

    def more(self) -> bytes:
        got = self.file.read_at(min(_WINDOW, self.size - self.at), self.at) if self.at < self.size else b""
        self.at += len(got)
        return got


def _inflate(buffer: bytes, source: _Bytes) -> tuple[bytes, bytes] | None:
    """The member at the buffer's start, and what follows it; None if there is none."""
    unpack, out = zlib.decompressobj(31), []
    while True:
        try:
            out.append(unpack.decompress(buffer))
        except zlib.error:
            return None
        if unpack.eof:
            return b"".join(out), unpack.unused_data
        if not (buffer := source.more()):
            return None


def _is_record(buffer: bytes) -> bool | None:
    """Whether a member whose content starts as a WARC record starts here; None: more bytes are needed."""
    unpack = zlib.decompressobj(31)
    try:
        head = unpack.decompress(buffer, 1024)
    except zlib.error:
        return False
    if len(head) >= 512 or unpack.eof:
        return head.startswith(b"WARC/1.") and b"\r\n" in head
    return False if not b"WARC/1.".startswith(head[:7]) and not head.startswith(b"WARC/1.") else None


def _after_empty(buffer: bytes, source: _Bytes) -> bytes:
    """The buffer without empty members at its start; they belong to the record before."""
    while True:
        while len(buffer) < 64 and (more := source.more()):
            buffer += more
        unpack = zlib.decompressobj(31)
        try:
            out = unpack.decompress(buffer[:64])
        except zlib.error:
            return buffer
        if out or not unpack.eof:
            return buffer
        buffer = unpack.unused_data + buffer[64:]


def chain(file, size: int, at: int, end: int) -> Iterator[tuple[int, bytes, int]]:
    """(offset, content, where the next begins) of the records from byte ``at`` on that start before ``end``.

    Ends before that at the first byte that begins no whole record.
    """
    source = _Bytes(file, at, size)
    buffer = source.more()
    while at < end:
        got = _inflate(buffer, source)
        if got is None or not got[0].startswith(b"WARC/1."):
            return
        buffer = _after_empty(got[1] or source.more(), source)
        after = source.at - len(buffer)
        yield at, got[0], after
        at = after


def _candidates(file, size: int, begin: int, end: int) -> Iterator[int]:
    """Bytes of [begin, end) where a gzip member that starts as a WARC record may begin."""
    source = _Bytes(file, begin, size)
    buffer, at = source.more(), begin
    while at < end and buffer:
        found = buffer.find(MAGIC)
        if found < 0:
            keep = buffer[-2:]
            at += len(buffer) - len(keep)
            more = source.more()
            if not more:
                return
            buffer = keep + more
            continue
        at, buffer = at + found, buffer[found:]
        if at >= end:
            return
        verdict = _is_record(buffer)
        while verdict is None and (more := source.more()):
            buffer += more
            verdict = _is_record(buffer)
        if verdict:
            yield at
        at, buffer = at + 1, buffer[1:]


def entries(file, size: int, begin: int, end: int) -> list[tuple[int, int]]:
    """(entry, exit) of the chains in [begin, end): an exit before ``end`` is where a chain breaks.

    The first chain that reaches the end is the last of the list: the file's own chain enters there or before, or not at all.
    """
    out, seen = [], set()
    for entry in _candidates(file, size, begin, end):
        if entry in seen:
            continue
        at = entry
        for offset, _, at in chain(file, size, entry, end):
            seen.add(offset)
        if at > entry:
            out.append((entry, at))
        if at >= end:
            break
    return out


def walk(file, size: int, split: int, known: dict[int, int]) -> Iterator[tuple[int, int]]:
    """(begin, entry) of the ranges that a file's own chain enters, from byte 0 on; ``known`` has the scans' (entry, exit).

    ValueError where the chain breaks.
    """
    at = 0
    while at < size:
        begin = at // split * split
        end = min(begin + split, size)
        out = known.get(at)
        if out is None:  # no scan lists it: a chain that the scan came upon further up, or no record at all
            out = at
            for _, _, out in chain(file, size, at, end):
                pass
        if out < end:
            raise ValueError(f"no whole WARC record at byte {out} of {size}")
        yield begin, at
        at = out


def parse(content: bytes) -> dict:
    """Headers and payload of a record; the payload is what follows the HTTP headers of the block."""
    head, _, rest = content.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[: int(headers.get("content-length", len(rest)))]
    http, _, payload = block.partition(b"\r\n\r\n")
    return {"version": lines[0], "headers": headers, "http": http, "payload": payload}


def splits(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """(path, size, begin, end): the byte ranges of all files below ``path``, dealt out evenly; Spark lists the files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", F.col("length").alias("size")).where("size > 0")
    listed = written(files, "archives")
    cut = listed.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(split).cast("long"))).alias("begin")).withColumn("end", F.least(F.col("begin") + split, "size"))
    tasks = listed.agg(F.coalesce(F.sum(F.ceil(F.col("size") / split)), F.lit(1))).first()[0]
    return cut.repartition(max(1, min(int(tasks), 100_000)))


def _opened(where: str):
    fs, name = pafs.FileSystem.from_uri(where)
    return fs.open_input_file(name)


def entered(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """(path, size, begin, end, entry): the ranges in which records start, and where the first one does."""

    def scan(batches):
        for b in batches:
            rows = []
            for where, size, begin, end in zip(*(c.to_pylist() for c in b.columns), strict=True):
                with _opened(where) as f:
                    rows += [(where, size, a, z) for a, z in entries(f, size, begin, end)] or [(where, size, None, None)]
            yield _batch(rows, [("path", pa.string()), ("size", pa.int64()), ("entry", pa.int64()), ("exit", pa.int64())])

    found = written(splits(spark, path, split).mapInArrow(scan, "path string, size bigint, entry bigint, exit bigint"), "chains")

    def follow(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        listed = part.dropna(subset=["entry"])
        known = dict(zip(listed["entry"].astype("int64").tolist(), listed["exit"].astype("int64").tolist(), strict=True))
        where, size = key
        with _opened(where) as f:
            try:
                rows = [(where, size, begin, min(begin + split, size), at) for begin, at in walk(f, size, split, known)]
            except ValueError as e:
                raise ValueError(f"{where}: {e}") from None
        return pd.DataFrame(rows, columns=["path", "size", "begin", "end", "entry"])

    return written(found.groupBy("path", "size").applyInPandas(follow, "path string, size bigint, begin bigint, end bigint, entry bigint"), "entries")


def read_warc(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """One row per record: path, offset, type, record_id, refers_to, uri, payload_digest (hex SHA-1), payload_bytes, payload.

    A response's digest is that of the payload as read; a record whose header says otherwise is an error, as is a byte of a file
    that belongs to no whole record.  A revisit has the digest of its header, the length its HTTP header tells and a null
    payload.  An empty file has no records.
    """
    small_batches(spark)
    fields = [("path", pa.string()), ("offset", pa.int64()), ("type", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()), ("uri", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())]

    def row(where: str, offset: int, content: bytes) -> tuple:
        r = parse(content)
        h = r["headers"]
        said = h.get("warc-payload-digest", "").partition(":")[2]
        said = base64.b32decode(said).hex() if said else None
        revisit = h.get("warc-type") == "revisit"
        own = None if revisit else hashlib.sha1(r["payload"]).hexdigest()
        if own and said and own != said:
            raise ValueError(f"{where} at {offset}: the payload's digest is {own}, not {said}")
        lengths = [int(x.split(b":")[1]) for x in r["http"].split(b"\r\n") if x.lower().startswith(b"content-length:")]
        size = (lengths or [None])[0] if revisit else len(r["payload"])
        return where, offset, h.get("warc-type"), h.get("warc-record-id"), h.get("warc-refers-to"), h.get("warc-target-uri"), said if revisit else own, size, None if revisit else r["payload"]

    def run(batches):
        for b in batches:
            for where, size, _, end, entry in zip(*(c.to_pylist() for c in b.columns), strict=True):
                with _opened(where) as f:
                    held, weight = [], 0
                    for offset, content, _ in chain(f, size, entry, end):
                        held.append(row(where, offset, content))
                        weight += len(content)
                        if weight > 4 << 20:
                            yield _batch(held, fields)
                            held, weight = [], 0
                    yield _batch(held, fields)

    ranges = entered(spark, path, split)
    return ranges.repartition(max(1, min(ranges.count(), 100_000))).mapInArrow(run, "path string, offset bigint, type string, record_id string, refers_to string, uri string, payload_digest string, payload_bytes bigint, payload binary")


def _batch(rows: list[tuple], fields) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(fields)], names=[n for n, _ in fields])


def page_of(record_id) -> Column:
    """The page id text in a record id that ``write_warc`` made; null where the page had none."""
    inner = F.regexp_extract(record_id, "^<urn:page:(.*)>$", 1)
    return F.when(inner != "", inner)
