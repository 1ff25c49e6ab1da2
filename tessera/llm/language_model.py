"""Hashed maximum-entropy language model with a class-factored softmax.

P(word | history) = P(class | history) * P(word | class, history).  Both factors are maximum-entropy models over hashed features
of the history: the word before and the two words before (n-grams), and the second and third word before by themselves
(skips; the third for the class alone).  Within a class the words are the leaves of a Huffman tree; each of its nodes is a
softmax over its two sides, whose bias is the log odds of their counts and whose features are hashed along with the node.

1. Words are counted over all training documents (combined in each task, then shuffled by word), along with the kind of
   document they stand in (a hash of its most common word).
2. The ``FREQUENT`` most common words that occur at least twice are put into classes by their profiles over the kinds of
   documents (k-means); all other words, known or not, make up the rare class, the end of a text is a class of its own.  Rare
   words are features of what follows by their own hashes.
3. Texts are numbered once and written.  Weights are trained in ``ROUNDS`` rounds over disjoint parts of all training
   documents: every task takes the shared weights through its documents by mini-batch gradient steps (AdaGrad), and the
   tasks' changes are averaged shard by shard: the classes' by tokens, the nodes' by each weight's gradients.
4. All documents are scored in sparse numpy batches.  Frequent words are looked up in the task; the others are shuffled, once
   per document and word, to meet their counts by the word itself, so that no table that grows with the corpus is broadcast.

What grows with the corpus are the counts; the weights that every task holds have a bound (``BUCKETS`` and ``MOST_NODE_BUCKETS``;
below it the nodes' buckets follow the number of distinct words).
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import scratch, small_batches, trimmed, utf8, written

FREQUENT = 65_536
KINDS = 32
CLASSES = 24
BUCKETS = 1 << 15
MOST_NODE_BUCKETS = 1 << 19
ROUNDS = 2
STEP = 0.3
BATCH = 32_768
SHARDS = 16
PIECE = 4096  # tokens whose arrays stay in a core's cache
PART_BYTES = 2 << 20  # of texts that are split at a time
END = b"\n"  # no word has white space
_START = -(1 << 31)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def split(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(how many words each text has, the distinct words, which of these each word is) of texts as bytes; A-Z are lower-cased."""
    found = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.binary()).view(pa.string())))
    at, flat = found.offsets.to_numpy(), found.values
    full = pc.binary_length(flat).to_numpy() > 0  # white space at an end leaves an empty word
    many = np.diff(at)
    if not full.all():
        many = np.diff(np.concatenate(([0], np.cumsum(full)))[at])
        flat = flat.filter(pa.array(full))
    coded = flat.dictionary_encode()
    return many, coded.dictionary.view(pa.binary()), coded.indices.to_numpy()


def _parts(batch: pa.RecordBatch, texts: int) -> Iterator[pa.RecordBatch]:
    """The batch in stretches of about PART_BYTES of texts, which are the column of that number."""
    size = np.cumsum(pc.binary_length(batch.column(texts)).to_numpy(), dtype=np.int64) // PART_BYTES
    at = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), len(size)]
    for a, b in zip(at[:-1], at[1:], strict=True):
        yield batch.slice(a, b - a)


def _runs(group: np.ndarray, code: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(group, code, order, starts): the distinct pairs in order, the order of all, and where in it each pair's begin."""
    bits = np.int64(max(wide, 1).bit_length())
    key = (group.astype(np.int64) << bits) | code
    order = np.argsort(key)
    key = key[order]
    starts = np.flatnonzero(np.concatenate((np.ones(len(key[:1]), bool), key[1:] != key[:-1])))
    key = key[starts]
    return key >> bits, key & ((np.int64(1) << bits) - 1), order, starts


def is_held_out(doc_id: str | Column) -> Column:
    """crc32 of the id's text mod 7 is 2; a null id is of the training documents."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def word_counts(training: DataFrame) -> DataFrame:
    """(word, kind, n) from (text bytes): tokens, the ends included, combined in each task before they are shuffled."""

    def run(batches):
        for b in (p for whole in batches for p in _parts(whole, 0)):
            many, distinct, codes = split(b.column(0))
            doc, code, order, starts = _runs(np.repeat(np.arange(len(many)), many), codes, len(distinct))
            times = np.diff(np.append(starts, len(codes)))
            kinds = np.zeros(len(many), np.int64)
            if len(doc):
                # each text's most common word, of ties the first
                at = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
                most = np.repeat(np.maximum.reduceat(times, at), np.diff(np.append(at, len(doc))))
                first = np.where(times == most, np.minimum.reduceat(order, starts), len(codes))
                best = distinct.take(pa.array(codes[np.minimum.reduceat(first, at)]))
                kinds[doc[at]] = [zlib.crc32(w) % KINDS for w in best.to_numpy(zero_copy_only=False)]
            kind, word, order, starts = _runs(kinds[doc], code, len(distinct))
            n = np.add.reduceat(times[order], starts) if len(starts) else times
            yield pa.RecordBatch.from_arrays([distinct.take(pa.array(word)), pa.array(kind.astype(np.int32)), pa.array(n.astype(np.int64))], names=["word", "kind", "n"])
            ends = np.bincount(kinds, minlength=KINDS)
            kind = np.flatnonzero(ends)
            yield pa.RecordBatch.from_arrays([pa.array([END] * len(kind), pa.binary()), pa.array(kind.astype(np.int32)), pa.array(ends[kind].astype(np.int64))], names=["word", "kind", "n"])

    return training.mapInArrow(trimmed(run), "word binary, kind int, n bigint").groupBy("word", "kind").agg(F.sum("n").alias("n"))


def cluster(profiles: np.ndarray, weights: np.ndarray, classes: int, rounds: int = 10) -> np.ndarray:
    """Weighted k-means over square roots of the words' profiles, from centres that are far apart; deterministic."""
    if not len(profiles):
        return np.zeros(0, np.int64)
    x = np.sqrt(profiles / np.maximum(profiles.sum(1, keepdims=True), 1e-9)).astype(np.float32)
    centres, heavy = [x[int(weights.argmax())]], np.minimum(weights, np.quantile(weights, 0.99))
    far = ((x - centres[0]) ** 2).sum(1)
    for _ in range(1, min(classes, len(x))):
        centres.append(x[int((far * heavy).argmax())])
        far = np.minimum(far, ((x - centres[-1]) ** 2).sum(1))
    centre = np.array(centres)
    for _ in range(rounds):
        of = (x @ centre.T * 2 - (centre**2).sum(1)).argmax(1)
        for k in range(len(centre)):
            if (of == k).any():
                centre[k] = np.average(x[of == k], axis=0, weights=weights[of == k])
    return of


@dataclass
class Trees:
    """A Huffman tree of each class's words.

    A word's path is a stretch of the flat arrays, a place for each node from the root on: a hash of the node, the log odds of
    the counts that it turns right, and whether the word does.
    """

    at: np.ndarray
    long: np.ndarray
    salt: np.ndarray
    bias: np.ndarray
    right: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray, classes: np.ndarray) -> Trees:
        """Frequent words make the shortest paths; a class of one word has none.  Ties go by number."""
        parent: dict[int, tuple[int, bool]] = {}
        bias: list[float] = []
        many = len(counts)
        for k in np.unique(classes):
            heap = [(float(counts[i]), int(i)) for i in np.flatnonzero(classes == k)]
            heapq.heapify(heap)
            while len(heap) > 1:
                (n, low), (m, high) = heapq.heappop(heap), heapq.heappop(heap)
                node = many + len(bias)
                parent[low], parent[high] = (node, False), (node, True)
                bias.append(float(np.log(m / n)))
                heapq.heappush(heap, (n + m, node))
        at, nodes, turns = [0], [], []
        for i in range(many):
            path = []
            while i in parent:
                i, right = parent[i]
                path.append((i - many, right))
            nodes += [n for n, _ in reversed(path)]
            turns += [r for _, r in reversed(path)]
            at.append(len(nodes))
        ends, node = np.array(at), np.array(nodes, np.int64)
        salt = (node.astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1)
        return cls(ends[:-1], np.diff(ends), salt, np.array(bias, np.float32)[node], np.array(turns, bool))

    def steps(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of the ids, place in the flat arrays) of every node on the ids' paths."""
        long = self.long[ids]
        of = np.repeat(np.arange(len(ids)), long)
        return of, np.arange(len(of)) - np.repeat(np.cumsum(long) - long - self.at[ids], long)


@dataclass
class Vocabulary:
    """The frequent words with their counts, classes and trees, and what is known of all training tokens."""

    words: dict[bytes, int]
    counts: np.ndarray
    classes: np.ndarray
    trees: Trees
    tokens: int
    distinct: int
    rare_tokens: int
    rare_distinct: int
    wide: int  # classes; the last but one is the rare words', the last the end's

    @property
    def rare(self) -> int:
        return len(self.words)

    @property
    def node_buckets(self) -> int:
        return 1 << min(max(10, (4 * self.distinct).bit_length()), MOST_NODE_BUCKETS.bit_length() - 1)


def vocabulary(kinds: DataFrame, counts: DataFrame, frequent: int = FREQUENT, classes: int = CLASSES) -> Vocabulary:
    """From (word, kind, n) and (word, n); at most ``frequent`` words, with a count for each kind, are collected."""
    spark = kinds.sparkSession
    end = F.col("word") == F.lit(END)
    whole = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    top = counts.where((F.col("n") >= 2) | end).orderBy(F.desc(end), F.desc("n"), "word").limit(frequent).toArrow()
    number = {w: i for i, w in enumerate(top["word"].to_pylist())}
    n = top["n"].to_numpy().astype(np.float64)
    listed = F.broadcast(spark.createDataFrame(pa.table({"word": top["word"], "id": pa.array(range(len(n)), pa.int32())})))
    of_kind = kinds.join(listed, "word").select("id", F.col("kind").cast("tinyint"), "n").toArrow()
    profiles = np.zeros((len(n), KINDS), np.float32)
    profiles[of_kind["id"].to_numpy(), of_kind["kind"].to_numpy()] = of_kind["n"].to_numpy()
    of = np.append(cluster(profiles, n, classes), classes)  # the last is the rare words'
    if END in number:
        of[number[END]] = classes + 1
    found, of = np.unique(np.append(of, classes + 1), return_inverse=True)
    of = of[:-1].astype(np.int32)
    return Vocabulary(number, np.append(n, 0), of, Trees.of(np.append(n, 0), of), int(whole["n"]), whole["v"], int(whole["n"] - n.sum()), whole["v"] - len(n), len(found))


class _Numbers(dict):
    """Word -> its number, or -1 - a hash of it for rare ones."""

    def __init__(self, known: dict[bytes, int]) -> None:
        super().__init__(known)
        self.known = pa.array(sorted(known, key=known.__getitem__), pa.binary())

    def __missing__(self, word: bytes) -> int:
        return -1 - (xxhash.xxh3_64_intdigest(word) & 0x3FFFFFFF)

    def of(self, words: pa.Array) -> np.ndarray:
        """The numbers of many words."""
        found = pc.fill_null(pc.index_in(words, value_set=self.known), -1).to_numpy().copy()
        rare = np.flatnonzero(found < 0)
        found[rare] = [self.__missing__(w) for w in words.to_numpy(zero_copy_only=False)[rare]]
        return found


def numbered(docs: DataFrame, vocab: tuple) -> DataFrame:
    """(row, doc_id, held_out, part, ids, rare, times) from (doc_id, held_out, part, text): a text's words as 32-bit numbers,
    and its distinct rare words with their numbers of times."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        number = _Numbers(_value(vocab).words)
        part, row = TaskContext.get().partitionId() << 36, 0
        for b in (p for whole in batches for p in _parts(whole, 3)):
            many, distinct, codes = split(b.column(3))
            n, ids = len(many), number.of(distinct)[codes]
            at = np.flatnonzero(ids < 0)
            doc, code, _, starts = _runs(np.repeat(np.arange(n), many)[at], codes[at], len(distinct))
            lists = pa.array(np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=n)))).astype(np.int32))
            rare = pa.ListArray.from_arrays(lists, distinct.take(pa.array(code)))
            times = pa.ListArray.from_arrays(lists, pa.array(np.diff(np.append(starts, len(at))).astype(np.int64)))
            ends = pa.array(np.concatenate(([0], np.cumsum(many) * 4)), pa.int64()).cast(pa.int32())
            numbers = pa.Array.from_buffers(pa.binary(), n, [None, ends.buffers()[1], pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays([pa.array(range(part + row, part + row + n), pa.int64()), *(b.column(k) for k in range(3)), numbers, rare, times], names=["row", "doc_id", "held_out", "part", "ids", "rare", "times"])
            row += n

    return docs.select("doc_id", "held_out", "part", "text").mapInArrow(trimmed(run), f"row bigint, doc_id {kind}, held_out boolean, part bigint, ids binary, rare array<binary>, times array<bigint>")


def _padded(ids: bytes) -> np.ndarray:
    """Three starts, the words, and a place for the end."""
    out = np.empty(len(ids) // 4 + 4, np.int32)
    out[:3] = out[-1] = _START
    out[3:-1] = np.frombuffer(ids, np.int32)
    return out


def _contexts(rows: list[np.ndarray]) -> np.ndarray:
    """A 32-bit hash per feature and token of padded rows: the word before, the two before, the second and the third before."""
    w1, w2, w3 = (np.concatenate([r[3 - k : len(r) - k] for r in rows]).astype(np.int64).astype(np.uint64) for k in (1, 2, 3))
    out = np.empty((4, len(w1)), np.uint32)
    for i, x in enumerate((w1, (w1 * np.uint64(0xC2B2AE3D27D4EB4F)) ^ w2, w2, w3)):
        h = (x + np.uint64(i + 1 << 40)) * _ODD
        out[i] = ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)
    return out


def _features(contexts: np.ndarray, buckets: int) -> np.ndarray:
    """The class model's buckets of each feature and token; every token also has the bias, bucket 0."""
    return (1 + (contexts >> np.uint32(1)) % np.uint32(buckets - 1)).astype(np.intp)


def _node_features(contexts: np.ndarray, of: np.ndarray, salt: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of three contexts (two n-grams, a skip) along with a node, for each of the tokens' nodes."""
    out = np.empty((3, len(of)), np.intp)
    shift = np.uint32(33 - buckets.bit_length())
    for row, c in zip(out, contexts, strict=False):
        h = np.take(c, of, mode="clip")
        h ^= salt
        h *= np.uint32(0x85EBCA6B)
        h >>= shift
        row[:] = h
    return out


def _odds(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Unnormalised logs (tokens x classes) from weights (classes x buckets, in Fortran's order) and features (features x tokens)."""
    by_bucket = weights.T
    z = np.take(by_bucket, features[0], axis=0, mode="clip")
    more = np.empty_like(z)
    for f in features[1:]:
        z += np.take(by_bucket, f, axis=0, out=more, mode="clip")
    z += by_bucket[0]
    return np.clip(z, -80, 80, out=z)


def gradient_steps(weights: np.ndarray, sums: np.ndarray, features: np.ndarray, classes: np.ndarray, step: float = STEP) -> None:
    """AdaGrad steps in place over mini-batches of (features, class); both tables in Fortran's order.

    Gradients are added to their buckets as complex numbers, two classes at a time.
    """
    by_bucket, sums = weights.T, sums.T
    wide = len(weights)
    ones = np.ones(wide, np.float32)
    g = np.empty((-(-wide // 2), min(BATCH, len(classes))), np.complex64)
    total = np.empty((len(g), len(by_bucket)), np.complex64)
    for i in range(0, len(classes), BATCH):
        f, y = features[:, i : i + BATCH], classes[i : i + BATCH]
        for k in range(0, len(y), PIECE):
            p = _odds(weights, f[:, k : k + PIECE])
            np.exp(p, out=p)
            p /= (p @ ones)[:, None]
            p[np.arange(len(p)), y[k : k + PIECE]] -= 1
            if wide % 2:
                p = np.pad(p, ((0, 0), (0, 1)))
            g[:, k : k + len(p)] = p.view(np.complex64).T
        total[...] = 0
        for pair, own in zip(total, g[:, : len(y)], strict=True):
            for x in f:
                np.add.at(pair, x, own)
            pair[0] = own.sum()
        for k in range(0, len(by_bucket), PIECE):
            t = np.ascontiguousarray(total[:, k : k + PIECE].T).view(np.float32)[:, :wide]
            sums[k : k + PIECE] += t * t
            by_bucket[k : k + PIECE] -= step * t / np.sqrt(sums[k : k + PIECE] + np.float32(1e-6))


def _node_odds(weights: np.ndarray, trees: Trees, contexts: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(which token, buckets, log odds of turning right, whether it does) of every node on the words' paths."""
    of, place = trees.steps(ids)
    at = _node_features(contexts, of, np.take(trees.salt, place, mode="clip"), len(weights))
    odds = np.take(trees.bias, place, mode="clip")
    for row in at:
        odds += np.take(weights, row, mode="clip")
    return of, at, np.clip(odds, -80, 80, out=odds), np.take(trees.right, place, mode="clip")


def node_steps(weights: np.ndarray, sums: np.ndarray, trees: Trees, contexts: np.ndarray, ids: np.ndarray, step: float = STEP) -> None:
    """AdaGrad steps in place for the nodes on the paths of frequent words."""
    total = np.zeros(len(weights), np.float32)
    for i in range(0, len(ids), PIECE):
        _, at, odds, right = _node_odds(weights, trees, contexts[:, i : i + PIECE], ids[i : i + PIECE])
        g = 1 / (1 + np.exp(-odds)) - right
        for x in at:
            np.add.at(total, x, g)
    for i in range(0, len(total), 4 * PIECE):
        t, own = total[i : i + 4 * PIECE], sums[i : i + 4 * PIECE]
        own += t * t
        weights[i : i + 4 * PIECE] -= step * t / np.sqrt(own + np.float32(1e-6))


def _value(sent, cache: dict = {}):  # noqa: B006  a worker process keeps the last value of each name
    name, key, held = sent
    if cache.get(name, (None,))[0] != key:
        cache[name] = key, held.value
    return cache[name][1]


def _send(spark, name: str, value) -> tuple:
    return name, scratch(spark, name), spark.sparkContext.broadcast(value)


def _chunks(rows: Iterator[bytes], most: int) -> Iterator[list[np.ndarray]]:
    held, size = [], 0
    for ids in rows:
        held.append(_padded(ids))
        size += len(held[-1])
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def _targets(rows: list[np.ndarray], v: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number or the rare words' number, class, whether it is the end) of each token."""
    ids = np.concatenate([x[3:] for x in rows])
    last = np.zeros(len(ids), bool)
    last[np.cumsum([len(x) - 3 for x in rows]) - 1] = True
    ids = np.where(ids < 0, v.rare, ids)
    return ids, np.where(last, v.wide - 1, v.classes[ids]), last


def train(training: DataFrame, v: Vocabulary, buckets: int = BUCKETS, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(class weights, classes x buckets; node weights) from (ids, part): round r takes the documents whose part is r."""
    spark = training.sparkSession
    weights, nodes = np.zeros((v.wide, buckets), np.float32, order="F"), np.zeros(v.node_buckets, np.float32)
    vocab = _send(spark, "vocabulary", v)
    every = max(BATCH, len(nodes) // 8)  # so that a step over all of the nodes' weights is little beside its tokens'

    for r in range(rounds):
        shared = _send(spark, "weights", (weights, nodes))

        def run(batches, shared=shared):
            v, (base, node_base) = _value(vocab), _value(shared)
            own, sums, done = base.copy(order="F"), np.full(base.shape, 1.0, np.float32, order="F"), 0
            node_own, node_sums = node_base.copy(), np.full(node_base.shape, 1.0, np.float32)
            for rows in _chunks((t for b in batches for t in b.column(0).to_pylist()), 4 * BATCH):
                contexts = _contexts(rows)
                ids, y, last = _targets(rows, v)
                gradient_steps(own, sums, _features(contexts, own.shape[1]), y)
                words = np.flatnonzero(~last & (ids < v.rare))
                for i in range(0, len(words), every):
                    part = words[i : i + every]
                    node_steps(node_own, node_sums, v.trees, contexts[:, part], ids[part])
                done += len(y)
            if done:
                change, weight = (own - base) * np.float32(done), node_sums - 1
                part = TaskContext.get().partitionId()
                parts = [np.array_split(x.T.ravel(), SHARDS) for x in (change, (node_own - node_base) * weight, weight)]
                yield pa.RecordBatch.from_arrays([pa.array(range(SHARDS), pa.int32()), pa.array([part] * SHARDS, pa.int32()), pa.array([float(done)] * SHARDS), *(pa.array([s.tobytes() for s in p], pa.binary()) for p in parts)], names=["shard", "part", "tokens", "change", "node_change", "node_weight"])

        def add(part: pd.DataFrame) -> pd.DataFrame:
            sums = {}
            for c in ("change", "node_change", "node_weight"):
                total = np.zeros(len(part[c].iloc[0]) // 4, np.float32)
                for x in part[c]:
                    total += np.frombuffer(x, np.float32)
                sums[c] = [total.tobytes()]
            return pd.DataFrame({"shard": part["shard"].iloc[:1], "part": part["part"].iloc[:1] // 32, "tokens": [part["tokens"].sum()], **sums})

        schema = "shard int, part int, tokens double, change binary, node_change binary, node_weight binary"
        of = training.where(F.col("part") == r).select("ids").mapInArrow(trimmed(run), schema)
        # at most 32 tasks' changes of one shard are added at a time
        few = of.groupBy("shard", F.floor(F.col("part") / 32)).applyInPandas(add, schema)
        few = few.groupBy("shard", F.floor(F.col("part") / 32)).applyInPandas(add, schema)
        got = few.groupBy("shard").applyInPandas(add, schema).collect()
        shards, node_shards = np.array_split(weights.T.reshape(-1), SHARDS), np.array_split(nodes, SHARDS)
        for x in got:
            shards[x["shard"]][...] += np.frombuffer(x["change"], np.float32) / np.float32(x["tokens"])
            weight = np.frombuffer(x["node_weight"], np.float32)
            node_shards[x["shard"]][...] += np.frombuffer(x["node_change"], np.float32) / np.maximum(weight, np.float32(1e-12))
    return weights, nodes


def log_probabilities(rows: list[np.ndarray], v: Vocabulary, weights: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Natural log of the model's probability of every token of padded rows; a rare word's is that of its class."""
    contexts = _contexts(rows)
    ids, y, last = _targets(rows, v)
    f = _features(contexts, weights.shape[1])
    out = np.empty(len(ids))
    ones = np.ones(len(weights), np.float32)
    for i in range(0, len(ids), PIECE):
        z, own = _odds(weights, f[:, i : i + PIECE]), y[i : i + PIECE]
        chosen = z[np.arange(len(own)), own]
        out[i : i + PIECE] = chosen - np.log(np.exp(z, out=z) @ ones)
    words = np.flatnonzero(~last & (ids < v.rare))
    for i in range(0, len(words), PIECE):
        part = words[i : i + PIECE]
        of, _, odds, right = _node_odds(nodes, v.trees, contexts[:, part], ids[part])
        odds *= 1 - 2 * right.astype(np.float32)
        out[part] -= np.bincount(of, np.log1p(np.exp(odds, out=odds), out=odds), len(part))
    return out


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", frequent: int = FREQUENT, buckets: int = BUCKETS, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words and one end; a null text has the end alone.  base_score is the add-one unigram's log10 probability,
    score the model's.  Rows that repeat keep a row each; null ids count as training documents.  Without training documents
    no token is known and the model is uniform over its two classes.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kind_of_id = docs.schema[doc_id].dataType.simpleString()
    part = F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), F.lit(rounds))
    narrow = docs.select(F.col(doc_id).alias("doc_id"), is_held_out(doc_id).alias("held_out"), part.alias("part"), utf8(text).alias("text"))
    kinds = written(word_counts(narrow.where("not held_out").select("text")), "word-counts")
    counts = written(kinds.groupBy("word").agg(F.sum("n").alias("n")), "counts")
    v = vocabulary(kinds, counts, frequent)
    vocab = _send(spark, "vocabulary", v)
    rows = written(numbered(narrow, vocab), "numbered")
    shared = _send(spark, "weights", train(rows.where("not held_out"), v, buckets, rounds))

    def run(batches):
        v, (w, nodes) = _value(vocab), _value(shared)
        known = np.log10((v.counts + 1) / (v.tokens + v.distinct + 1))
        end_known = END in v.words
        end_base = known[v.words.get(END, v.rare)]
        for b in batches:
            sums = []
            for held in _chunks(iter(b.column(3).to_pylist()), 4 * BATCH):
                model = log_probabilities(held, v, w, nodes) / np.log(10.0)
                ids, _, last = _targets(held, v)
                base = np.where(last, end_base, np.where(ids < v.rare, known[ids], 0.0))
                hit = np.where(last, end_known, ids < v.rare)
                at = np.concatenate(([0], np.cumsum([len(x) - 3 for x in held])[:-1]))
                sums.append(([len(x) - 3 for x in held], *(np.add.reduceat(x, at) for x in (hit.astype(np.int64), base, model))))
            columns = [np.concatenate([x[k] for x in sums] or [np.zeros(0)]) for k in range(4)]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(3)), *(pa.array(x.astype(np.int64 if k < 2 else np.float64)) for k, x in enumerate(columns))], names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "model"])

    scored = rows.select("row", "doc_id", "held_out", "ids").mapInArrow(trimmed(run), f"row bigint, doc_id {kind_of_id}, held_out boolean, n_tokens bigint, n_known bigint, base double, model double")
    frequent_words = F.broadcast(spark.createDataFrame(pa.table({"word": pa.array(list(v.words), pa.binary())})))
    # words whose count may be wanted: all but the frequent ones
    table = counts.join(frequent_words, "word", "left_anti")
    wanted = rows.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
    # a partition of distinct words is small, so it is hashed and the documents' words needn't be sorted
    met = wanted.join(table.hint("shuffle_hash"), "word", "left")
    c = F.log10(F.coalesce(F.col("n"), F.lit(0)) + 1) * F.col("times")
    sums = met.groupBy("row").agg(F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("more"), F.sum("times").alias("rares"), F.sum(c).alias("logs"))
    both = scored.join(sums, "row", "left").na.fill(0, ["more", "rares", "logs"])
    whole = float(np.log10(v.tokens + v.distinct + 1))
    in_rare = float(np.log10(v.rare_tokens + v.rare_distinct + 1))
    return both.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.col("more")).alias("n_known"), F.lit(v.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.col("logs") - F.col("rares") * F.lit(whole)).alias("base_score"), (F.col("model") + F.col("logs") - F.col("rares") * F.lit(in_rare)).alias("score"),
    )
