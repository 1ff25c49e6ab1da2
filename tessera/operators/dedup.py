"""Duplicates by content hash, by bit codes and by histograms of signals."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.numbers import finite

#: Parts that fingerprints are dealt into to meet each other, and correlations that a task computes at once.
DEALT = 16
PRODUCT = 1 << 22


def hash_groups(df: DataFrame, key: str, content: str) -> DataFrame:
    """Contents that over one row has: sha256, n, first key and last key, copies.

    Members are not gathered into one row; join ``members`` on the hash to list them.
    """
    return df.where(F.col(content).isNotNull()).groupBy(F.sha2(F.col(content).cast("binary"), 256).alias("sha256")).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first_key"), F.max(key).alias("last_key")).where("n > 1")


def sign_code(vector: str, bits: int = 64) -> Column:
    """A BIGINT whose bit i says whether element i is over 0."""
    return F.aggregate(F.zip_with(F.slice(vector, 1, bits), F.sequence(F.lit(0), F.lit(bits - 1)), lambda v, i: F.when(v > 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), i)).otherwise(F.lit(0).cast("bigint"))), F.lit(0).cast("bigint"), lambda s, x: s.bitwiseOR(x))


def classes(df: DataFrame, key: str, code: str) -> DataFrame:
    """(representative, code, members): one row per distinct code, by its smallest key; null codes are left out."""
    return df.where(F.col(code).isNotNull()).groupBy(F.col(code).alias("code")).agg(F.min(key).alias("representative"), F.count(F.lit(1)).alias("members"))


def class_members(df: DataFrame, key: str, code: str) -> DataFrame:
    """(key, representative): the class of each row with a code."""
    return df.where(F.col(code).isNotNull()).join(classes(df, key, code).select(F.col("code").alias("_t_c"), "representative"), F.col(code) == F.col("_t_c")).select(key, "representative")


def hamming_pairs(df: DataFrame, key: str, code: str, most: int, bits: int = 64) -> DataFrame:
    """Pairs of representatives of equal codes (smaller key first) whose codes differ in at most ``most`` bits; complete.

    Multi-index hashing: the code is cut into bands, about one for every three bits allowed; two codes that close are within
    most // bands bits in one of them.  Each code is filed under its bands' values and looks up the values in the balls
    around them, so the wider the bands, the fewer codes meet for nothing; the complete distance is verified.
    """
    bands = max(2, -(-(most + 1) // 3))
    radius = most // bands
    cut = [bits * i // bands for i in range(bands + 1)]

    def value(i: int) -> Column:
        wide = cut[i + 1] - cut[i]
        return F.shiftrightunsigned(F.col("code"), cut[i]).bitwiseAND(F.lit((1 << wide) - 1).cast("bigint"))

    def ball(i: int) -> Column:
        wide = cut[i + 1] - cut[i]
        flips = [sum(1 << x for x in of) for r in range(radius + 1) for of in combinations(range(wide), r)]
        return F.transform(F.array(*(F.lit(x).cast("bigint") for x in flips)), lambda x: F.struct(F.lit(i).alias("b"), value(i).bitwiseXOR(x).alias("v")))

    nodes = classes(df, key, code).select("representative", "code")
    filed = nodes.select(F.col("representative").alias("key_b"), F.col("code").alias("code_b"), F.explode(F.array(*(F.struct(F.lit(i).alias("b"), value(i).alias("v")) for i in range(bands)))).alias("x")).select("key_b", "code_b", "x.*")
    looked = nodes.select(F.col("representative").alias("key_a"), F.col("code").alias("code_a"), F.explode(F.concat(*(ball(i) for i in range(bands)))).alias("x")).select("key_a", "code_a", "x.*")
    distance = F.bit_count(F.col("code_a").bitwiseXOR(F.col("code_b")))
    met = looked.join(filed, ["b", "v"]).where((F.col("key_a") < F.col("key_b")) & (distance <= most))
    return met.select("key_a", "key_b", distance.cast("bigint").alias("distance")).distinct()


def histogram(df: DataFrame, keys: list[str], value: str, bins: int = 20) -> DataFrame:
    """Density of each signal over ``bins`` equal bins of its own range: (keys, bin, density), empty bins included.

    The last bin is closed; a constant signal spans half a unit each way; fewer than two finite values give zeros.
    """
    good = df.withColumn("_t_v", F.when(finite(value), F.col(value).cast("double")))
    ends = good.groupBy(*keys).agg(F.min("_t_v").alias("_t_0"), F.max("_t_v").alias("_t_1"), F.count("_t_v").alias("_t_n"))
    flat = F.col("_t_0") == F.col("_t_1")
    ends = ends.withColumns({"_t_lo": F.when(flat, F.col("_t_0") - 0.5).otherwise(F.col("_t_0")), "_t_hi": F.when(flat, F.col("_t_1") + 0.5).otherwise(F.col("_t_1"))})
    place = F.least(F.floor((F.col("_t_v") - F.col("_t_lo")) / (F.col("_t_hi") - F.col("_t_lo")) * bins), F.lit(bins - 1)).cast("int")
    counts = good.where("_t_v is not null").join(ends, keys).withColumn("bin", place).groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("_t_c"))
    every = ends.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    width = (F.col("_t_hi") - F.col("_t_lo")) / bins
    return every.join(counts, [*keys, "bin"], "left").select(*keys, "bin", F.when(F.col("_t_n") < 2, 0.0).otherwise(F.coalesce("_t_c", F.lit(0)) / (F.col("_t_n") * width)).alias("density"))


def fingerprints(prints: DataFrame, key: str, position: list[str], value: str) -> DataFrame:
    """(key, code): each fingerprint's values (long rows, every position given) as one array in the order of positions."""
    held = F.array_sort(F.collect_list(F.struct(*position, F.col(value).cast("double").alias("_t_v"))))
    return prints.groupBy(key).agg(F.transform(held, lambda x: x["_t_v"]).alias("code"))


def correlated_pairs(prints: DataFrame, key: str, position: list[str], value: str, least: float) -> DataFrame:
    """Pairs of representatives of equal fingerprints (smaller key first) with a Pearson correlation of at least ``least``;
    complete.  Constant fingerprints have no correlation, nor have those with a value that is not finite.

    Fingerprints are centred and scaled to length 1 and dealt into ``DEALT`` parts; every two parts meet once, as two matrices
    whose product holds all their correlations.  In twenty bins 0.6 is too wide an angle for cells or bands to keep any apart.
    """
    add = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v)
    nodes = classes(fingerprints(prints, key, position, value), key, "code").select("representative", "code")
    mean = add("code") / F.size("code")
    nodes = nodes.withColumn("_t_m", mean).withColumn("_t_c", F.transform("code", lambda v: v - F.col("_t_m"))).withColumn("_t_n", F.sqrt(add(F.transform("_t_c", lambda v: v * v))))
    unit = nodes.where(finite("_t_n") & (F.col("_t_n") > 0) & F.col("representative").isNotNull()).select("representative", F.transform("_t_c", lambda v: v / F.col("_t_n")).alias("u"), F.pmod(F.xxhash64("representative"), F.lit(DEALT)).cast("int").alias("part"))
    other = F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1)))
    met = unit.withColumn("with", other).select("representative", "u", "part", F.size("u").alias("n"), F.least("part", "with").alias("low"), F.greatest("part", "with").alias("high"))
    kind = unit.schema["representative"].dataType.simpleString()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        if not table.num_rows:
            return
        part, low, high = (table[c].to_numpy() for c in ("part", "low", "high"))
        keys, u = table["representative"].combine_chunks(), table["u"].combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
        own = np.flatnonzero(part == low)
        rest = own if low[0] == high[0] else np.flatnonzero(part == high)
        a, b = u[own], u[rest].T.copy()
        step = max(1, PRODUCT // max(1, len(rest)))
        for i in range(0, len(own), step):
            r = a[i : i + step] @ b
            x, y = np.nonzero(r >= least)
            if low[0] == high[0]:
                x, y = x[x + i < y], y[x + i < y]
            if len(x):
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(own[x + i])), keys.take(pa.array(rest[y])), pa.array(r[x, y])], names=["x", "y", "correlation"])

    found = met.groupBy("low", "high", "n").applyInArrow(meet, f"x {kind}, y {kind}, correlation double")
    return found.select(F.least("x", "y").alias("key_a"), F.greatest("x", "y").alias("key_b"), "correlation")
