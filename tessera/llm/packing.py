"""Sequence packing: first-fit decreasing over a tournament tree of bin capacities, in randomised groups of documents.

A document's ids are cut every ``context`` ids from its start.  Full pieces fill a sequence each and stay where they are; what
is left of a document, at most one piece, is packed.  Groups of about ``group_size`` documents at any scale are drawn by the
pieces' numbers, and each is packed in one task; only lengths and checksums are shuffled, not ids.  The pieces are written along
with their numbers before that, so a task run again draws the same, and rows that repeat (even a third of all) spread.
"""

from __future__ import annotations

import zlib

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import small_batches, trimmed, utf8, written
from tessera.llm.tokens import VOCABULARY, as_u32, encoder

CONTEXT = 2048
END = 1
GROUP = 4096


class Bins:
    """A tournament tree over bins: each inner node has the largest capacity below it."""

    def __init__(self, most: int, context: int) -> None:
        self.leaves = 1 << max(0, most - 1).bit_length()
        self.tree = [context] * (2 * self.leaves)

    def place(self, length: int) -> int:
        """Put ``length`` into the first bin that has room; the bin's number."""
        tree, i = self.tree, 1
        while i < self.leaves:
            i *= 2
            if tree[i] < length:
                i += 1
        tree[i] -= length
        leaf = i
        while i > 1:
            i //= 2
            best = max(tree[2 * i], tree[2 * i + 1])
            if tree[i] == best:
                break
            tree[i] = best
        return leaf - self.leaves


def first_fit_decreasing(sizes: list[int], context: int) -> list[tuple[int, int]]:
    """(bin, offset) of each size, none over ``context``; equal sizes in the order given."""
    bins, fill, out = Bins(len(sizes), context), {}, [(0, 0)] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        b = bins.place(sizes[i])
        out[i] = (b, fill.get(b, 0))
        fill[b] = out[i][1] + sizes[i]
    return out


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", context: int = CONTEXT, end: int = END, vocabulary: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, place): a row per piece, ``place`` its number among all; with ``with_ids``
    also ids array<int>."""
    small_batches(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        encode, place = encoder(vocabulary), TaskContext.get().partitionId() << 40
        for b in batches:
            rows, start, length, crc, total, ids = [], [], [], [], [], []
            for k, t in enumerate(b.column(1).to_pylist()):
                x = as_u32(encode(t), end)
                for at in range(0, len(x), context):
                    part = x[at : at + context]
                    rows.append(k)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part))
                    total.append(len(x))
                    if with_ids:
                        ids.append(part)
            made = [b.column(0).take(pa.array(rows, pa.int64())), *(pa.array(c, pa.int64()) for c in (start, length, crc, total, range(place, place + len(rows))))]
            place += len(rows)
            made += [pa.array(ids, pa.list_(pa.int32()))] if with_ids else []
            yield pa.RecordBatch.from_arrays(made, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "place"] + ["ids"] * with_ids)

    return docs.select(F.col(doc_id).alias("doc_id"), utf8(text).alias("_t_text")).mapInArrow(trimmed(run), f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, place bigint" + ", ids array<int>" * with_ids)


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", context: int = CONTEXT, group_size: int = GROUP, seed: int = 0, **how) -> DataFrame:
    """The pieces with sequence_id and offset: where each lies, gapless from 0 in its sequence.

    Null texts are documents of the end id alone; null and repeated ids are documents like others; no rows give none.
    """
    cut = written(pieces(docs, doc_id, text, context, **how), "pieces")
    whole, rest = cut.where(F.col("length") == context), cut.where(F.col("length") < context)
    groups = max(1, -(-rest.count() // group_size))
    drawn = rest.withColumn("grp", F.pmod(F.xxhash64("place", F.lit(seed)), F.lit(groups)))

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["start", "ids_crc32", "length", "doc_tokens"], kind="stable") if len(part) else part
        placed = first_fit_decreasing(part["length"].tolist(), context)
        part["sequence_id"] = [(int(key[0]) << 32) + b for b, _ in placed]
        part["offset"] = [o for _, o in placed]
        return part.drop(columns=["grp", "place"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema.fields if f.name != "place")
    alone = whole.select(*(c for c in cut.columns if c != "place"), F.col("place").bitwiseOR(F.lit(1 << 62)).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    return alone.unionByName(drawn.groupBy("grp").applyInPandas(run, f"{kinds}, sequence_id bigint, offset bigint"))
