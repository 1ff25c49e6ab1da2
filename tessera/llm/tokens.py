"""Token ids of a public byte-level BPE vocabulary, and exact length histograms.

``tiktoken`` encodes with the same ranks and the same pattern as the ``tokenizers`` file several times faster; texts that
hold a special token's string, or that it can't take, go through ``tokenizers`` itself.  Tests hold both against each other.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import small_batches, utf8, written

VOCABULARY = "byte_bpe_50k"


class Encoder:
    """Text bytes -> list of ids, as ``tokenizers`` gives them with add_special_tokens=False."""

    def __init__(self, name: str = VOCABULARY) -> None:
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.full = lru_cache(1)(lambda: Tokenizer.from_file(public_tokenizers.path(f"{name}.json")))
        self.special = b"<|endoftext|>"

    def __call__(self, text: bytes) -> list[int]:
        said = text.decode("utf-8", "replace")
        if self.special not in text:
            try:
                return self.fast.encode_ordinary(said)
            except (KeyboardInterrupt, SystemExit):
                raise
            except BaseException as e:  # the Rust side panics, not an Exception, where its pattern's stack is too small
                if "Panic" not in type(e).__name__ and not isinstance(e, ValueError):
                    raise
        return self.full().encode(said, add_special_tokens=False).ids


@lru_cache(2)
def encoder(name: str = VOCABULARY) -> Encoder:
    return Encoder(name)


def lengths(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(n_tokens): one row per row of ``docs``; a null text has 0 tokens."""
    small_batches(docs.sparkSession)

    def run(batches):
        encode = encoder(vocabulary)
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(encode(t)) for t in b.column(0).to_pylist()], pa.int64())], names=["n_tokens"])

    return docs.select(utf8(text).alias("_t_text")).mapInArrow(run, "n_tokens bigint")


def length_histogram(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(n_tokens, n_docs): how many rows have each encoded length.  Null texts have length 0; no rows give no lengths."""
    return lengths(docs, text, vocabulary).groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(histogram: DataFrame, width: int = 256) -> DataFrame:
    """The histogram with, for each length L taken as a context limit, what all documents come to.

    docs_ge and tokens_ge: documents of at least L tokens, and their tokens; total_docs, total_tokens; truncated_tokens:
    sum of min(length, L); rank: documents of at most L tokens.  The sums run within ranges of ``width`` lengths, and over
    the ranges' totals, so that no task gets all lengths; the histogram is written first, as it is used twice.
    """
    h = written(histogram, "histogram").withColumn("_t_r", F.floor(F.col("n_tokens") / width)).withColumn("_t_w", F.col("n_tokens") * F.col("n_docs"))
    ranges = h.groupBy("_t_r").agg(F.sum("n_docs").alias("_t_d"), F.sum("_t_w").alias("_t_t"))
    above = Window.orderBy(F.desc("_t_r")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranges = ranges.select("_t_r", *(F.coalesce(F.sum(c).over(above), F.lit(0)).alias(n) for c, n in (("_t_d", "_t_da"), ("_t_t", "_t_ta"))), F.sum("_t_d").over(everything).alias("total_docs"), F.sum("_t_t").over(everything).alias("total_tokens"))
    within = Window.partitionBy("_t_r").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    s = h.join(ranges, "_t_r").withColumns({"docs_ge": F.sum("n_docs").over(within) + F.col("_t_da"), "tokens_ge": F.sum("_t_w").over(within) + F.col("_t_ta")})
    return s.select(
        "n_tokens", "n_docs", "docs_ge", "tokens_ge", "total_docs", "total_tokens",
        (F.col("total_tokens") - F.col("tokens_ge") + F.col("n_tokens") * F.col("docs_ge")).alias("truncated_tokens"),
        (F.col("total_docs") - F.col("docs_ge") + F.col("n_docs")).alias("rank"),
    )


def truncated_totals(sums: DataFrame, limits: list[int]) -> DataFrame:
    """(limit, truncated_tokens) for any context limits: from the smallest length above the limit, or all tokens."""
    at = sums.sparkSession.createDataFrame([(int(x),) for x in limits], "limit bigint")
    joined = at.hint("broadcast").join(sums, F.col("n_tokens") > F.col("limit"), "right").where("limit is not null")
    least = joined.groupBy("limit").agg(F.min_by(F.struct("docs_ge", "tokens_ge", "total_tokens"), "n_tokens").alias("x"))
    total = sums.agg(F.coalesce(F.max("total_tokens"), F.lit(0)).alias("t"))
    found = at.join(least, "limit", "left").crossJoin(F.broadcast(total))
    return found.select("limit", F.coalesce(F.col("x.total_tokens") - F.col("x.tokens_ge") + F.col("limit") * F.col("x.docs_ge"), F.col("t")).alias("truncated_tokens"))


def quantiles(sums: DataFrame, parts: list[float]) -> DataFrame:
    """(part, n_tokens): the smallest length that at least that part of the documents doesn't exceed; exact."""
    at = sums.sparkSession.createDataFrame([(float(p),) for p in parts], "part double")
    return sums.join(F.broadcast(at), F.col("rank") >= F.ceil(F.col("part") * F.col("total_docs"))).groupBy("part").agg(F.min("n_tokens").alias("n_tokens"))


def as_u32(ids: list[int], end: int) -> np.ndarray:
    """The ids and then the end's, as little-endian unsigned 32-bit."""
    out = np.empty(len(ids) + 1, "<u4")
    out[:-1] = ids
    out[-1] = end
    return out
