"""Binary payloads: protobuf wire format, CDR arrays, length-prefixed records."""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value, at
        shift += 7
        if shift > 63:
            raise ValueError("varint of over 64 bits")


def wire_fields(data: bytes) -> list[tuple[int, int, int | bytes]]:
    """(field number, wire type, value) of a protobuf message; groups are an error, as is a cut-off message."""
    out, at = [], 0
    while at < len(data):
        tag, at = varint(data, at)
        field, kind = tag >> 3, tag & 7
        if kind == 0:
            value, at = varint(data, at)
        else:
            size = {1: 8, 5: 4}.get(kind)
            if kind == 2:
                size, at = varint(data, at)
            if size is None or at + size > len(data):
                raise ValueError(f"bad field {field} of type {kind}")
            value, at = data[at : at + size], at + size
        out.append((field, kind, value))
    return out


def explode_wire(df: DataFrame, keys: list[str], payload: str) -> DataFrame:
    """A row per field of each message: place, field, kind, number (varints), content (the others)."""
    schema = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches):
        for b in batches:
            rows, place, field, kind, number, content = [], [], [], [], [], []
            for i, data in enumerate(b.column(len(keys)).to_pylist()):
                for n, (f, k, v) in enumerate(wire_fields(data or b"")):
                    rows.append(i)
                    place.append(n)
                    field.append(f)
                    kind.append(k)
                    number.append(str(v) if k == 0 else None)
                    content.append(v if k else None)
            take = pa.array(rows, pa.int64())
            made = [*(b.column(i).take(take) for i in range(len(keys))), pa.array(place, pa.int64()), pa.array(field, pa.int64()), pa.array(kind, pa.int32()), pa.array(number, pa.string()), pa.array(content, pa.binary())]
            yield pa.RecordBatch.from_arrays(made, names=[*keys, "place", "field", "kind", "number", "content"])

    return df.select(*keys, payload).mapInArrow(run, f"{schema}, place bigint, field bigint, kind int, number string, content binary")


def little_endian(content, kind: str):
    """A 4- or 8-byte value as a column: float, double or bigint, from its hex digits in turned order."""
    dtype = {"float": "<f4", "double": "<f8", "bigint": "<i8"}[kind]

    @F.pandas_udf(kind)
    def read(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else np.frombuffer(v, dtype)[0].item())

    return read(content)


def cdr_header(payload: bytes, at: int = 0) -> tuple[int, int, str, int]:
    """(seconds, nanoseconds, frame id, where it ends) of a little-endian CDR stamp, after an encapsulation header if there
    is one; the id is padded to 4 bytes."""
    if struct.unpack_from("<I", payload, at)[0] in (0x00010000, 0x00000100):
        at += 4
    seconds, nanos, size = struct.unpack_from("<iII", payload, at)
    at += 12
    text = payload[at : at + size].decode("utf-8", "replace").rstrip("\0") if size < 100 else ""
    return seconds, nanos, text, (at + size + 3) & ~3 if size else at


def cdr_doubles(payload: bytes, at: int = 4, align: int = 1) -> list[float]:
    """A sequence of doubles of a little-endian CDR message: its length, then the values (aligned as told)."""
    (n,) = struct.unpack_from("<I", payload, at)
    return list(struct.unpack_from(f"<{n}d", payload, (at + 4 + align - 1) // align * align))
