"""SimHash near-dedup by multi-index hashing.

A fingerprint is cut into segments.  Every fingerprint is filed in one table per segment under the segment's value; every
fingerprint then enumerates, per segment, the values in a small Hamming ball around its own, fetches the table's entries
and verifies the complete distance.  With the default layout (two segments of 32 bits) two fingerprints that differ in at
most two bits either differ in at most one bit of the first segment or agree in the second, so no link is lost.

Equal fingerprints are one node, so exact copies never meet in pairs, and a node has at most 2080 others within two bits:
links grow with the nodes.

With ``jaccard`` similarity is that of the sets of distinct shingles, computed and not estimated.  Rows of equal sets are one
node.  A node is filed under ``BANDS`` keys, each of ``ROWS`` minima of the set's hashes; nodes that share a key are fetched
however their differences lie in the text.  A 1024-bit fingerprint of the set leaves out pairs that are far from the limit,
and the texts of all others are compared shingle by shingle.  Every node is first compared with one head of its keys, the
node that shares most keys with others, as the middle of a group does; only pairs that these links leave apart are looked
for after that, so that a large group doesn't emit its pairs.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, join_groups, small_batches, trimmed, utf8, written
from tessera.llm.components import components

SEED = 42
#: (which 64-bit word, lowest bit, width, ball radius); complete for a distance of 2.
TWO_BITS = ((0, 32, 32, 1), (0, 0, 32, 0))
#: For stages on five-word shingles with a similarity (Jaccard) of 0.8 or more.
FIVE_WORDS = {"shingle": 5, "jaccard": 0.8}
#: Two sets of similarity j share a key with a probability of 1 - (1 - j ** ROWS) ** BANDS: 0.9996 at 0.8.
BANDS, ROWS = 20, 5
#: 64-bit words of the sets' fingerprints.  Pairs of similarity j differ in acos(2j / (1 + j)) / pi of the bits on average, 310
#: of 2048 at 0.8; a pair is left out beyond ``DEVIATIONS`` standard deviations (16.2 bits), and never if a set has under ``SMALL``.
LONGS, DEVIATIONS, SMALL = 32, 4.5, 32
_ODD = np.random.default_rng(42).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_GOLDEN = 0x9E3779B97F4A7C15
_CHUNK = 255


def _mixed(h: np.ndarray, longs: int) -> np.ndarray:
    """A column per independent hash from the first (splitmix64's finaliser); the 0th is the hash itself."""
    if longs == 1:
        return h[:, None]
    z = h[:, None] + (np.arange(longs, dtype=np.uint64) * np.uint64(_GOLDEN))[None, :]
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    z[:, 0] = h
    return z


def _shingles(text: bytes, shingle: int) -> np.ndarray:
    """The hashes of all shingles in their order, repeats included; a shorter text is one shingle, one without words none."""
    words = text.translate(LOWER).split()  # bytes.split() splits at \x20 and \x09-\x0D, nothing else
    if not words:
        return np.zeros(0, np.uint64)
    joined, hash64 = b" ".join(words), xxhash.xxh64_intdigest
    n = max(1, len(words) - shingle + 1)
    if n == 1:
        return np.array([hash64(joined, SEED)], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[: n - 1] + 1)).tolist()
    return np.fromiter((hash64(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)), np.uint64, n)


def _bits(hashes: np.ndarray, longs: int) -> list[int]:
    n = len(hashes)
    if not n:
        return [0] * longs
    ones = np.zeros(64 * longs, np.int64)
    for i in range(0, n, _CHUNK):  # so many rows that their sums fit in bytes
        part = np.ascontiguousarray(_mixed(hashes[i : i + _CHUNK], longs).astype("<u8"))
        ones += np.add.reduce(np.unpackbits(part.view(np.uint8), axis=1, bitorder="little"), axis=0, dtype=np.uint8)
    return np.packbits(ones * 2 > n, bitorder="little").view("<i8").tolist()


def fingerprint(text: bytes, shingle: int = 3, longs: int = 1) -> list[int]:
    """``longs`` signed 64-bit words; bit i is 1 if set in over half the shingles' hashes."""
    return _bits(_shingles(text, shingle), longs)


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def sketch(text: bytes, shingle: int) -> tuple[int, int, list[int], list[int]]:
    """Of the set of distinct shingles: its hash, its size, its keys (none without words) and its fingerprint."""
    own = np.unique(_shingles(text, shingle))
    keys = []
    if len(own):
        least = np.full(len(_ODD), (1 << 64) - 1, np.uint64)
        for i in range(0, len(own), 2048):
            np.minimum(least, (own[None, i : i + 2048] * _ODD[:, None]).min(1), out=least)
        raw = least.astype("<u8").tobytes()
        keys = [_signed(xxhash.xxh3_64_intdigest(raw[8 * ROWS * k : 8 * ROWS * (k + 1)], k)) for k in range(BANDS)]
    return _signed(xxhash.xxh3_64_intdigest(own.astype("<u8").tobytes())), len(own), keys, _bits(own, LONGS)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, longs: int = 1) -> DataFrame:
    """(doc_id, f0, f1, ...): one row per row of ``docs``; a null text counts as empty, whose fingerprint is zero.

    ``text_key`` is a hash of the text, which with the id names a row.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        for b in batches:
            texts = b.column(2).to_pylist()
            found = [fingerprint(t, shingle, longs) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array([f[k] for f in found], pa.int64()) for k in range(len(names)))], names=["doc_id", "text_key", *names])

    names = [f"f{k}" for k in range(longs)]
    fields = ", ".join(f"{n} bigint" for n in names)
    return docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_key"), utf8(text).alias("_t_text")).mapInArrow(run, f"doc_id {kind}, text_key bigint, {fields}")


def _distance(longs: int, a: str = "f", b: str = "g") -> Column:
    return reduce(lambda x, y: x + y, (F.bit_count(F.col(f"{a}{k}").bitwiseXOR(F.col(f"{b}{k}"))) for k in range(longs)))


def sketches(docs: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    """(doc_id, text_key, node, n, keys, f0, f1, ...): one row per row of ``docs``, from its set of distinct shingles."""
    small_batches(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        for b in batches:
            found = [sketch(t, shingle) for t in b.column(2).to_pylist()]
            columns = [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.list_(pa.int64()))]
            columns += [pa.array([f[3][k] for f in found], pa.int64()) for k in range(LONGS)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *columns], names=["doc_id", "text_key", "node", "n", "keys", *words])

    words = [f"f{k}" for k in range(LONGS)]
    fields = ", ".join(f"{w} bigint" for w in words)
    return docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_key"), utf8(text).alias("_t_text")).mapInArrow(trimmed(run), f"doc_id {kind}, text_key bigint, node bigint, n bigint, keys array<bigint>, {fields}")


def _promising(jaccard: float) -> Column:
    """Whether sets of n and m shingles with fingerprints f and g may be as similar as that."""
    share = math.acos(2 * jaccard / (1 + jaccard)) / math.pi
    bits = 64 * LONGS
    most = bits * share + DEVIATIONS * math.sqrt(bits * share * (1 - share))
    return (F.least("n", "m") >= F.lit(jaccard) * F.greatest("n", "m") - 1e-6) & ((F.least("n", "m") < SMALL) | (_distance(LONGS) <= F.lit(most)))


def _confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, jaccard: float) -> DataFrame:
    """The pairs (u, v) whose sets of distinct shingles are similar enough; both sides of each join are exchanged, so that
    Spark can split a node that has very many pairs."""
    side = lambda name: texts.select(F.col("node").alias(name), F.col("text").alias(f"{name}_text"))
    both = pairs.hint("merge").join(side("u"), "u").hint("merge").join(side("v"), "v").select("u", "v", "u_text", "v_text")

    def run(batches):
        held: dict[int, np.ndarray] = {}
        size = 0
        for b in batches:
            keep = []
            for u, v, x, y in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for node, t in ((u, x), (v, y)):
                    if node not in held:
                        if size > 1 << 20:
                            held, size = {k: held[k] for k in (u, v) if k in held}, 0
                        held[node] = np.unique(_shingles(t, shingle))
                        size += len(held[node])
                one, two = held[u], held[v]
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(both / max(1, len(one) + len(two) - both) >= jaccard)
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(trimmed(run), "u bigint, v bigint")


def set_links(docs: DataFrame, prints: DataFrame, nodes: DataFrame, text: str, shingle: int, jaccard: float) -> DataFrame:
    """Links (u, v) between nodes that connect what all fetched pairs of at least that similarity connect."""
    words = [f"f{k}" for k in range(LONGS)]
    own = nodes.select("node", "n", *words)
    theirs = own.select(F.col("node").alias("v"), F.col("n").alias("m"), *(F.col(f"f{k}").alias(f"g{k}") for k in range(LONGS)))
    filed = written(prints.select("node", F.explode("keys").alias("key")).distinct(), "filed")
    sizes = filed.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    crowd = written(filed.hint("merge").join(sizes, "key"), "crowd")
    weight = crowd.groupBy("node").agg(F.sum("rows").alias("weight"))
    heads = crowd.join(weight, "node").groupBy("key").agg(F.max(F.struct("weight", "node")).alias("x")).select("key", F.col("x.weight").alias("weight"), F.col("x.node").alias("head"))
    shared = written(crowd.select("key", "node").hint("merge").join(heads, "key"), "shared")
    wanted = nodes.select("node", "rep").join(shared.select("node").distinct(), "node", "left_semi")
    # one text of each node: texts of a key are equal, and a node's texts have the same set
    texts = docs.select(F.xxhash64(text).alias("rep"), utf8(text).alias("text")).join(wanted, "rep").groupBy("node").agg(F.first("text").alias("text"))
    texts = written(texts, "texts")
    times = shared.where("node <> head").groupBy("node", "head").agg(F.count(F.lit(1)).alias("times"), F.max("weight").alias("weight"))
    best = times.groupBy("node").agg(F.max(F.struct("weight", "times", "head")).alias("x")).select("node", F.col("x.head").alias("v"))
    starred = best.hint("merge").join(own, "node").hint("merge").join(theirs, "v").where(_promising(jaccard)).select(F.col("node").alias("u"), "v")
    first = written(_confirmed(written(starred, "star-pairs"), texts, shingle, jaccard), "stars")
    comp = written(components(first), "star-components")
    named = shared.select("key", "node").join(comp, "node", "left").withColumn("c", F.coalesce("comp", "node")).drop("comp")
    named = written(named, "star-nodes")
    several = named.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select("key")
    apart = written(named.hint("merge").join(several, "key"), "apart")
    lists = apart.groupBy("node").agg(F.collect_list("key").alias("keys"))  # at most ``BANDS`` each
    left = apart.hint("merge").join(own.join(lists, "node"), "node")
    left = written(left, "left")
    right = left.select("key", F.col("node").alias("v"), F.col("c").alias("d"), F.col("n").alias("m"), F.col("keys").alias("theirs"), *(F.col(f"f{k}").alias(f"g{k}") for k in range(LONGS)))
    # a pair comes out once, at the least of the keys that its nodes share
    once = F.array_min(F.array_intersect("keys", "theirs")) == F.col("key")
    rest = left.hint("merge").join(right, "key").where((F.col("node") < F.col("v")) & (F.col("c") != F.col("d")) & _promising(jaccard) & once).select(F.col("node").alias("u"), "v")
    return first.unionByName(_confirmed(written(rest, "pairs"), texts, shingle, jaccard))


def _segments(layout) -> Column:
    """The keys (segment number above the segment's value) that a fingerprint is filed under."""
    return F.array(*(_value(w, low, width).bitwiseOR(F.lit(i << 33)) for i, (w, low, width, _) in enumerate(layout)))


def _value(word: int, low: int, width: int) -> Column:
    return F.shiftrightunsigned(F.col(f"f{word}"), low).bitwiseAND(F.lit((1 << width) - 1))


def _around(seg: int, value: Column, flips: Column) -> Column:
    return F.transform(flips, lambda x: value.bitwiseXOR(x).bitwiseOR(F.lit(seg << 33)))


def _balls(layout) -> Column:
    """All keys in the segments' balls, the fingerprint's own included."""
    out = []
    for i, (w, low, width, radius) in enumerate(layout):
        flips = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]
        out.append(_around(i, _value(w, low, width), F.array(*(F.lit(x).cast("long") for x in flips))))
    return F.concat(*out)


def links(nodes: DataFrame, layout=TWO_BITS, most: int = 2, longs: int = 1) -> DataFrame:
    """All links (u, v) that the layout reaches between nodes (node, f0, ...) of distinct fingerprints, at most ``most`` bits
    apart."""
    own = [f"f{k}" for k in range(longs)]
    theirs = [F.col(c).alias(f"g{k}") for k, c in enumerate(own)]
    table = nodes.select(F.col("node").alias("v"), *theirs, F.explode(_segments(layout)).alias("key"))
    probes = nodes.select("node", *own, F.explode(_balls(layout)).alias("key"))
    return probes.hint("merge").join(table, "key").where((F.col("node") < F.col("v")) & (_distance(longs) <= most)).select(F.col("node").alias("u"), "v")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, layout=TWO_BITS, most: int = 2, longs: int = 1, jaccard: float | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, f0 (and f1, ...; none with ``jaccard``), component_id,
    component_size.

    component_id is the smallest doc_id reachable over links, the row's own included.  Rows of equal fingerprints are
    linked (so are all rows without words, null texts included).  Null ids take part and never are a component_id, unless
    no row of the component has an id.  Rows that repeat an id are rows of their own.  Other columns are not read.
    """
    words = [f"f{k}" for k in range(longs if jaccard is None else LONGS)]
    if jaccard is None:
        prints = written(fingerprints(docs, doc_id, text, shingle, longs), "fingerprints")
        prints = prints.withColumn("node", F.col("f0") if longs == 1 else F.xxhash64(*words))
        more = []
    else:
        prints = written(sketches(docs, doc_id, text, shingle), "sketches")
        more = [F.min("n").alias("n"), F.min("text_key").alias("rep")]
    nodes = prints.groupBy("node").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows"), *(F.min(w).alias(w) for w in words), *more)
    nodes = written(nodes, "nodes")
    comp = components(links(nodes.select("node", *words), layout, most, longs) if jaccard is None else set_links(docs, prints, nodes, text, shingle, jaccard))
    total = prints.count()
    linked = written(nodes.join(comp, "node").select("node", "least", "rows", "comp"), "linked")
    of_comp = linked.groupBy("comp").agg(F.min("least").alias("component_id"), F.sum("rows").alias("component_size"), F.count(F.lit(1)).alias("nodes"))
    with_comp = join_groups(linked, of_comp, "comp", "nodes", total).select("node", "rows", "component_id", "component_size")
    alone = nodes.join(linked.select("node"), "node", "left_anti").select("node", "rows", F.col("least").alias("component_id"), F.col("rows").alias("component_size"))
    known = written(with_comp.unionByName(alone), "known")
    words = words if jaccard is None else []
    prints = prints.select("doc_id", "text_key", *words, "node")
    return join_groups(prints, known, "node", "rows", total).select("doc_id", "text_key", *words, "component_id", "component_size")


def drop_near(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` without the rows that are not the smallest id of their component; its columns in their order.

    Rows with that id and the same text stay together, as do all rows of a component without ids.  Rows go by id and text,
    so another text under the same (or under no) id is not touched.
    """
    found = near_duplicates(docs, doc_id, text, **how)
    gone = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_t_id"), F.col("text_key").alias("_t_text_key")).distinct()
    same = (F.xxhash64(text) == F.col("_t_text_key")) & F.col(doc_id).eqNullSafe(F.col("_t_id"))
    return docs.join(gone, same, "left_anti")
