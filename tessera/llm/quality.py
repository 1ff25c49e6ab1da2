"""Quality classifier: an interpolated modified Kneser-Ney trigram model of trusted text, and perplexities under it.

1. The model is fitted on all trusted documents of its half, whole.  Their trigrams are counted in Spark and dealt into shards by
   the middle word, so that all that a trigram's probability needs (its context, its last two words and theirs) is counted in
   the same shard; single words are dealt by themselves.  There is a shard for every ``SHARD_BYTES`` of trusted text, ``SHARDS``
   at least; of the counts only a few sums reach the driver, and the tables stay in the shared folder.
2. Scoring joins the n-grams of every document with the count tables shard by shard: a token needs the one shard of the word
   before it.  A worker takes ``CHUNK_BYTES`` of texts at a time and reads the shards one after another, holding one.  So the
   text is scanned where it lies and never shuffled, and the model is read once for every such chunk.
3. A document's score is its mean negative log10 probability a token (perplexity = 10 ** score).  Trusted documents are halved
   by a hash of their ids: the model is of one half, and each language's threshold is the quantile ``HIGH`` of the scores of
   all documents of the other half.  Languages with fewer than ``FEW`` of these take the quantile of all languages together.

Words are 64-bit hashes, n-grams mixed ones; two of a billion n-grams fall together with a chance of a few in a hundred.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, discard_since, made, small_batches, trim_memory, utf8, written

HIGH = 0.995
FEW = 30
#: Least shards, trusted text a shard beyond them, and text that is scored in one pass over the shards.
SHARDS = 16
SHARD_BYTES = 1 << 20
CHUNK_BYTES = 8 << 20
#: Tables of up to ``MANY`` thresholds are broadcast, and up to ``MANY_IDS`` trusted ids.
MANY = 100_000
MANY_IDS = 1_000_000
#: Columns of packed trigrams.
TRIGRAMS = ("words", "a", "b", "c", "n")
_START, _END = np.uint64(1), np.uint64(2)


class _Hashes(dict):
    """Hashes of words, each computed once."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1 << 17:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = _Hashes()


class _Places(dict):
    """Words' places in a growing list of hashes; a word that comes again after the words held were dropped gets another."""

    def __init__(self, hashes: array):
        self.hashes = hashes

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1 << 17:
            self.clear()
        at = self[word] = len(self.hashes)
        self.hashes.append(xxhash.xxh3_64_intdigest(word))
        return at


def words(text: bytes) -> list[bytes]:
    return text.translate(LOWER).split()


def _row(text: bytes) -> np.ndarray:
    """Two starts, the words and the end."""
    ws = words(text)
    out = np.empty(len(ws) + 3, np.uint64)
    out[:2], out[-1] = _START, _END
    out[2:-1] = np.fromiter(map(_HASHES.__getitem__, ws), np.uint64, len(ws))
    return out


def _trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(tokens with the end of each text, a, b, c): every token c and the two before it."""
    rows = [_row(t) for t in texts]
    a, b, c = (np.concatenate([r[k : len(r) - 2 + k] for r in rows] or [np.empty(0, np.uint64)]) for k in range(3))
    return np.array([len(r) - 2 for r in rows], np.int64), a, b, c


def _pair(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    z = x * np.uint64(0x9E3779B97F4A7C15) + (y ^ (y >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    z = (z ^ (z >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return z ^ (z >> np.uint64(29))


def _discounts(n: list[int]) -> np.ndarray:
    """Modified Kneser-Ney's discounts for counts of 0, 1, 2 and more from the numbers of n-grams that occur 1 to 4 times;
    plain ones where too few n-grams tell."""
    n1, n2, n3, n4 = n
    if not (n1 and n2 and n3 and n4):
        return np.array([0.0, 0.5, 0.75, 0.9])
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([0.0, *(min(max(x, 0.05), k - 0.01) for k, x in zip((1, 2, 3), d, strict=True))])


def _occur(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]


def _lower_part(group: np.ndarray, counts: np.ndarray, groups: int, discounts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each n-gram's discounted share of its context, and the contexts' weights of the lower order."""
    off = discounts[np.minimum(counts, 3)]
    total = np.bincount(group, counts, groups)
    return (counts - off) / total[group], np.bincount(group, off, groups) / np.maximum(total, 1)


@dataclass
class Counts:
    """A shard's distinct trigrams and how often each occurs."""

    a: np.ndarray
    b: np.ndarray
    c: np.ndarray
    n: np.ndarray

    @classmethod
    def of(cls, a: np.ndarray, b: np.ndarray, c: np.ndarray, n: np.ndarray) -> Counts:
        _, first, back = np.unique(_pair(_pair(a, b), c), return_index=True, return_inverse=True)
        return cls(a[first], b[first], c[first], np.bincount(back, n, len(first)).astype(np.int64))

    def bigrams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(b, c, of each trigram its bigram, seen): a bigram counts once per word before it; those after the start once per
        document, as nothing stands before it."""
        _, first, back = np.unique(_pair(self.b, self.c), return_index=True, return_inverse=True)
        return self.b[first], self.c[first], back, np.bincount(back, np.where(self.b == _START, self.n, 1), len(first)).astype(np.int64)


@dataclass
class Unigrams:
    """Sorted words with their probabilities; ``unknown`` is that of all others."""

    keys: np.ndarray
    p: np.ndarray
    unknown: float

    @classmethod
    def of(cls, keys: np.ndarray, seen: np.ndarray) -> Unigrams:
        order = np.argsort(keys)
        keys, seen = keys[order], seen[order]
        p, left = np.zeros(len(keys)), 1.0
        if len(keys):
            p, weight = _lower_part(np.zeros(len(keys), np.int64), seen, 1, _discounts(_occur(seen)))
            left = weight[0]
        unknown = left / (len(keys) + 1)  # the words, the end and the unknown; the start is never predicted
        return cls(keys, p + unknown, unknown)

    def of_words(self, wanted: np.ndarray) -> np.ndarray:
        return _looked(self.keys, self.p, wanted, self.unknown)[0]


def _looked(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> tuple[np.ndarray, np.ndarray]:
    """The values of the wanted keys in a sorted table, and whether it has them."""
    if not len(keys):
        return np.full(len(wanted), default), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    there = keys[at] == wanted
    return np.where(there, values[at], default), there


#: A shard's sorted tables: trigrams, contexts of two words, bigrams, contexts of one word.
_TABLES = ("k3", "p3", "k12", "w12", "k2", "p2", "k1", "w1")


def shard_tables(counts: Counts, d3: np.ndarray, d2: np.ndarray, unigrams: Unigrams | _FarUnigrams) -> dict[str, np.ndarray]:
    b, c, pair, seen = counts.bigrams()
    heads, head = np.unique(b, return_inverse=True)
    share2, w1 = _lower_part(head, seen, len(heads), d2)
    p2 = share2 + w1[head] * unigrams.of_words(c)
    k12, context = np.unique(_pair(counts.a, counts.b), return_inverse=True)
    share3, w12 = _lower_part(context, counts.n, len(k12), d3)
    k3, k2 = _pair(_pair(counts.a, counts.b), counts.c), _pair(b, c)
    o3, o2 = np.argsort(k3), np.argsort(k2)
    single = lambda x: x.astype(np.float32)
    return dict(zip(_TABLES, (k3[o3], single((share3 + w12[context] * p2[pair])[o3]), k12, single(w12), k2[o2], single(p2[o2]), heads, single(w1)), strict=True))


@dataclass
class Model:
    """Word probabilities, and a way to a shard's tables."""

    unigrams: Unigrams | _FarUnigrams
    shard: Callable[[int], dict[str, np.ndarray]]
    shards: int

    @classmethod
    def fit(cls, texts: list[bytes], shards: int = SHARDS) -> Model:
        """The model of a few texts, in this process; ``fit`` makes the same in Spark."""
        _, a, b, c = _trigrams(texts)
        of = (b % np.uint64(shards)).astype(np.int64)
        counts = [Counts.of(a[of == s], b[of == s], c[of == s], np.ones(int((of == s).sum()), np.int64)) for s in range(shards)]
        bi = [x.bigrams() for x in counts]
        last, back = np.unique(np.concatenate([x[1] for x in bi]), return_inverse=True)
        unigrams = Unigrams.of(last, np.bincount(back, minlength=len(last)).astype(np.int64))
        d3, d2 = (_discounts(np.sum([_occur(x) for x in xs], axis=0).tolist()) for xs in ([x.n for x in counts], [x[3] for x in bi]))
        tables = [shard_tables(x, d3, d2, unigrams) for x in counts]
        return cls(unigrams, tables.__getitem__, shards)

    def score(self, texts: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens with the end, sum of log10 probabilities) of each text.

        Texts are taken one by one and a token is a place in a list of hashes, so that about 24 bytes a token are held."""
        hashes = array("Q", (int(_START), int(_END)))
        places, rows = _Places(hashes), []
        for t in texts:
            ws = words(t)
            row = np.zeros(len(ws) + 3, np.uint32)  # two starts, the words and the end
            row[2:-1], row[-1] = np.fromiter(map(places.__getitem__, ws), np.uint32, len(ws)), 1
            rows.append(row)
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0)
        places.clear()
        of_word, sizes = np.frombuffer(hashes, np.uint64), np.array([len(r) for r in rows], np.int64)
        flat = np.concatenate(rows)
        del rows, row, ws
        begin = np.cumsum(sizes) - sizes
        # by the shard of the word before it, every token's place in flat; starts come last and have no probability
        shard = (of_word % np.uint64(self.shards)) << np.uint64(32)
        order = np.empty(len(flat), np.uint64)
        order[1:] = shard[flat[:-1]]
        order[begin] = order[begin + 1] = self.shards << 32
        order += np.arange(len(flat), dtype=np.uint32)
        order.sort()
        cuts = np.searchsorted(order, np.arange(self.shards + 1, dtype=np.uint64) << np.uint64(32))
        order = order.astype(np.uint32)
        single = self.unigrams.of_words(of_word)
        p = np.ones(len(flat))
        for s in range(self.shards):
            at = order[cuts[s] : cuts[s + 1]]
            if not len(at):
                continue
            x, y, z = (of_word[flat[at - np.uint32(k)]] for k in (2, 1, 0))
            t = self.shard(s)
            two, known = _looked(t["k2"], t["p2"], _pair(y, z), 0.0)
            low = np.where(known, two, _looked(t["k1"], t["w1"], y, 1.0)[0] * single[flat[at]])
            before = _pair(x, y)
            weight, known = _looked(t["k12"], t["w12"], before, 1.0)
            full, there = _looked(t["k3"], t["p3"], _pair(before, z), 0.0)
            p[at] = np.where(known & there, full, weight * low)
        return sizes - 2, np.add.reduceat(np.log10(p, out=p), begin)


def _half() -> Column:
    """0: the model's half of the trusted ids; 1: the thresholds'."""
    return F.pmod(F.xxhash64(F.col("_t_id"), F.lit("half")), F.lit(2))


def _trusted_rows(docs: DataFrame, trusted: DataFrame, doc_id: str, text: str, max_documents: int | None, max_characters: int | None) -> DataFrame:
    """The rows of ``docs`` that the model is of, with _t_id."""
    ids = trusted.select(F.col(doc_id).alias("_t_id")).where("_t_id is not null").where(_half() == 0).distinct()
    if max_documents is not None:
        ids = ids.orderBy(F.xxhash64("_t_id"), "_t_id").limit(max_documents)
    of = docs if max_characters is None else docs.where(F.length(F.col(text)) <= max_characters)
    return of.join(F.broadcast(ids) if ids.count() <= MANY_IDS else ids, F.col(doc_id) == F.col("_t_id"))


def trusted_sample(docs: DataFrame, trusted: DataFrame, doc_id: str = "doc_id", text: str = "text", max_documents: int | None = None, max_characters: int | None = None) -> DataFrame:
    """(_t_text): whole texts of all trusted ids of the model's half.  A caller may bound them: at most ``max_documents`` (by the
    smallest hashes of ids), none over ``max_characters``.  Of rows that repeat an id the least text counts."""
    of = _trusted_rows(docs, trusted, doc_id, text, max_documents, max_characters)
    return of.groupBy("_t_id").agg(F.min(utf8(text)).alias("_t_text")).select("_t_text")


def _blobs(shard: int, arrays: dict[str, np.ndarray]) -> pd.DataFrame:
    return pd.DataFrame({"shard": [shard], **{k: [v.tobytes()] for k, v in arrays.items()}})


def _fields(names) -> str:
    return "shard int, " + ", ".join(f"{n} binary" for n in names)


def _stored(df: DataFrame, name: str) -> dict[int, str]:
    """A table with one row a shard, written to the shared folder: each shard's file."""
    table = written(df, name, partition="shard")
    return {r["shard"]: r["file"] for r in table.select("shard", F.input_file_name().alias("file")).collect()}


def _kind(name: str) -> type:
    """Keys are hashes; probabilities and weights are single, but for those of words."""
    return np.uint64 if name[0] == "k" else np.float64 if name == "p0" else np.float32


def _read(file: str, names: tuple[str, ...]) -> dict[str, np.ndarray]:
    fs, path = pafs.FileSystem.from_uri(file)
    with fs.open_input_file(path) as f:
        found = pq.ParquetFile(f).read(columns=list(names), use_threads=False)
    return {k: np.frombuffer(found[k][0].as_buffer(), _kind(k)) for k in names}


@dataclass
class _FarUnigrams:
    """``Unigrams`` dealt by the word into shards in the shared folder, one read at a time."""

    files: dict[int, str]
    unknown: float
    shards: int

    def of_words(self, wanted: np.ndarray) -> np.ndarray:
        p = np.full(len(wanted), self.unknown)
        of = (wanted % np.uint64(self.shards)).astype(np.uint16 if self.shards <= 1 << 16 else np.uint32)
        order = np.argsort(of, kind="stable")
        cuts = np.searchsorted(of[order], np.arange(self.shards + 1))
        for s, file in self.files.items():
            at = order[cuts[s] : cuts[s + 1]]
            if len(at):
                t = _read(file, ("k0", "p0"))
                p[at] = _looked(t["k0"], t["p0"], wanted[at], self.unknown)[0]
        return p


@dataclass
class _Sent:
    """What a task needs to read the model, whatever its size."""

    unigrams: _FarUnigrams
    files: dict[int, str]
    shards: int

    def model(self) -> Model:
        empty = {k: np.zeros(0, _kind(k)) for k in _TABLES}
        return Model(self.unigrams, lambda s: _read(self.files[s], _TABLES) if s in self.files else empty, self.shards)


def fit_model(sample: DataFrame, shards: int = SHARDS) -> _Sent:
    """The model of the sample's texts (_t_text), counted in Spark; ``shards`` is a power of two."""
    spark = sample.sparkSession
    small_batches(spark)

    def count(batches):
        for part in _parts((t for b in batches for t in b.column(0).to_pylist()), 2 << 20):
            _, x, y, z = _trigrams(part)
            found = Counts.of(x, y, z, np.ones(len(x), np.int64))
            of = (found.b % np.uint64(shards)).astype(np.int32)
            order = np.argsort(of, kind="stable")
            held, cuts = np.unique(of[order], return_index=True)
            rows = [packed(*(v[at] for v in (found.a, found.b, found.c, found.n))) for at in np.split(order, cuts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(held), *(pa.array([r[k] for r in rows], pa.binary()) for k in TRIGRAMS)], names=["shard", *TRIGRAMS])
        _HASHES.clear()
        trim_memory()

    def packed(a: np.ndarray, b: np.ndarray, c: np.ndarray, n: np.ndarray) -> dict[str, bytes]:
        """Trigrams with their words as places in a list, in half the bytes."""
        heads, at = np.unique(np.concatenate((a, b, c)), return_inverse=True)
        a, b, c = at.astype(np.uint16 if len(heads) <= 1 << 16 else np.uint32).reshape(3, -1)
        return dict(zip(TRIGRAMS, (heads.tobytes(), a.tobytes(), b.tobytes(), c.tobytes(), n.astype(np.uint32).tobytes()), strict=True))

    def unpacked(r: dict[str, bytes]) -> list[np.ndarray]:
        heads = np.frombuffer(r["words"], np.uint64)
        at = np.uint16 if len(heads) <= 1 << 16 else np.uint32
        return [*(heads[np.frombuffer(r[k], at)] for k in "abc"), np.frombuffer(r["n"], np.uint32).astype(np.int64)]

    def add(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        counts = Counts.of(*(np.concatenate(x) for x in zip(*map(unpacked, part.to_dict("records")), strict=True)))
        _, last, _, seen = counts.bigrams()
        uni, times = np.unique(last, return_counts=True)
        stats = np.array(_occur(counts.n) + _occur(seen), np.int64)
        out = _blobs(int(key[0]), {"last": uni, "times": times.astype(np.int64), "stats": stats}).assign(**{k: [v] for k, v in packed(counts.a, counts.b, counts.c, counts.n).items()})
        trim_memory()
        return out

    counted = sample.mapInArrow(count, _fields(TRIGRAMS))
    mark = made()
    counted = written(counted.groupBy("shard").applyInPandas(add, _fields((*TRIGRAMS, "last", "times", "stats"))), "ngrams")
    stats = np.zeros(8, np.int64)
    for r in counted.select("stats").toLocalIterator():
        stats += np.frombuffer(bytes(r["stats"]), np.int64)
    d3, d2 = _discounts(stats[:4].tolist()), _discounts(stats[4:].tolist())

    def lasts(batches):
        for b in batches:
            for keys, times in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(keys, np.int64)), pa.array(np.frombuffer(times, np.int64))], names=["key", "times"])

    seen = written(counted.select("last", "times").mapInArrow(lasts, "key bigint, times bigint").groupBy("key").agg(F.sum("times").alias("times")), "words")
    n = seen.agg(F.count(F.lit(1)), F.sum("times"), *(F.count_if(F.col("times") == k) for k in (1, 2, 3, 4))).first()
    d1 = _discounts(list(n[2:]))
    off = F.element_at(F.array(*(F.lit(float(x)) for x in d1[1:])), F.least(F.col("times"), F.lit(3)).cast("int"))
    left = seen.agg(F.sum(off)).first()[0] / n[1] if n[0] else 1.0
    unknown = left / (n[0] + 1)

    def singles(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        keys, times = part["key"].to_numpy().view(np.uint64), part["times"].to_numpy()
        order = np.argsort(keys)
        return _blobs(int(key[0]), {"k0": keys[order], "p0": ((times - d1[np.minimum(times, 3)]) / n[1] + unknown)[order]})

    words_dealt = seen.withColumn("shard", F.col("key").bitwiseAND(F.lit(shards - 1)).cast("int")).groupBy("shard").applyInPandas(singles, _fields(("k0", "p0")))
    unigrams = _FarUnigrams(_stored(words_dealt, "unigrams"), unknown, shards)

    def tables(parts):
        for part in parts:
            for r in part.to_dict("records"):
                yield _blobs(r["shard"], shard_tables(Counts(*unpacked(r)), d3, d2, unigrams))
                trim_memory()

    files = _stored(counted.select("shard", *TRIGRAMS).mapInPandas(tables, _fields(_TABLES)), "model")
    discard_since(spark, mark, 2)
    return _Sent(unigrams, files, shards)


def _parts(texts: Iterable[bytes], most: int = 1 << 20) -> Iterator[list[bytes]]:
    """Lists of texts of about ``most`` bytes each, so that what is computed of them at once stays small."""
    part, weight = [], 0
    for t in texts:
        part.append(t or b"")
        weight += len(part[-1])
        if weight > most:
            yield part
            part, weight = [], 0
    if part:
        yield part


def _scored(sent: _Sent, batches, at: int):
    """Each batch with its (tokens, score) columns.  Batches are scored some at a time, as each time all shards are read."""
    model = sent.model()
    try:
        for some in _chunks(batches, at):
            n, p = model.score(t or b"" for b in some for t in b.column(at).cast(pa.binary()).to_pylist())
            trim_memory()
            i = 0
            while some:  # each goes when it is done, before the next are read
                j = i + some[0].num_rows
                yield some.pop(0), pa.array(n[i:j]), pa.array(-p[i:j] / n[i:j])
                i = j
    finally:
        trim_memory()


def _chunks(batches, at: int) -> Iterator[list[pa.RecordBatch]]:
    """Lists of batches of about ``CHUNK_BYTES`` of text each."""
    some, weight = [], 0
    for b in batches:
        some.append(b)
        weight += b.column(at).nbytes
        b = None  # else it would be held while the next is read
        if weight >= CHUNK_BYTES:
            yield some
            some, weight = [], 0
    if some:
        yield some


def scores(docs: DataFrame, sent, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(doc_id, lang, n_tokens, score): one row per row of ``docs``; a null language is ''."""
    small_batches(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        for b, n, s in _scored(sent, batches, 2):
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), n, s], names=["doc_id", "lang", "n_tokens", "score"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"), utf8(text).alias("_t_text")).mapInArrow(run, f"doc_id {kind}, lang string, n_tokens bigint, score double")


def trusted_ids(labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Ids labelled of good quality and not toxic; null labels don't count as such."""
    return labels.where("quality = 1 and toxic = 0").select(F.col(doc_id).alias("doc_id")).where("doc_id is not null").distinct()


def thresholds(scored: DataFrame, trusted: DataFrame, high: float = HIGH, few: int = FEW) -> DataFrame:
    """(lang, threshold) from all rows of the thresholds' half; lang null is that of all languages.  No rows: no threshold."""
    of = scored.join(trusted.withColumn("_t_id", F.col("doc_id")).where(_half() == 1), "doc_id", "left_semi")
    both = of.select(F.explode(F.array(F.col("lang"), F.lit(None).cast("string"))).alias("lang"), "score")
    found = both.groupBy("lang").agg(F.percentile_approx("score", F.lit(high), 10_000).alias("threshold"), F.count(F.lit(1)).alias("n"))
    return found.where(F.col("lang").isNull() | (F.col("n") >= few)).select("lang", "threshold")


@dataclass
class Fitted:
    """A model with its scores of all documents and the table of the languages' thresholds."""

    sent: _Sent
    scored: DataFrame
    by_lang: DataFrame

    def limited(self, rows: DataFrame, lang: Column, name: str) -> DataFrame:
        """``rows`` with their language's threshold, or else that of all; null where nothing was trusted, which rejects nothing."""
        own = self.by_lang.where("lang is not null").select(F.col("lang").alias("_t_lang"), F.col("threshold").alias("_t_own"))
        own = F.broadcast(own) if own.count() <= MANY else own
        whole = self.by_lang.where("lang is null").select("threshold").first()
        out = rows.join(own, lang == F.col("_t_lang"), "left")
        return out.withColumn(name, F.coalesce("_t_own", F.lit(whole and whole[0]).cast("double"))).drop("_t_lang", "_t_own")


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", high: float = HIGH, **sample) -> Fitted:
    trusted = trusted_ids(labels, doc_id)
    trusted_by = trusted.withColumnRenamed("doc_id", doc_id)
    bounds = [sample.get(k) for k in ("max_documents", "max_characters")]
    size = _trusted_rows(docs, trusted_by, doc_id, text, *bounds).agg(F.sum(F.octet_length(utf8(text)))).first()[0] or 0
    shards = max(SHARDS, 1 << max(0, math.ceil(size / SHARD_BYTES) - 1).bit_length())
    sent = fit_model(trusted_sample(docs, trusted_by, doc_id, text, **sample), shards)
    scored = written(scores(docs, sent, doc_id, text, lang), "scores")
    return Fitted(sent, scored, written(thresholds(scored, trusted, high), "thresholds"))


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", **how) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang, n_tokens, perplexity, threshold (a perplexity), kept.

    Null texts are empty (one token, the end).  Rows that repeat keep a row each.  Without trusted rows all are kept.
    """
    f = fit(docs, labels, doc_id, text, lang, **how)
    limited = f.limited(f.scored, F.col("lang"), "_t_limit")
    return limited.select("doc_id", "lang", "n_tokens", F.pow(F.lit(10.0), F.least(F.col("score"), F.lit(300.0))).alias("perplexity"), F.pow(F.lit(10.0), "_t_limit").alias("threshold"), F.coalesce(F.col("score") <= F.col("_t_limit"), F.lit(True)).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", **how) -> DataFrame:
    """``docs`` without the rows that the classifier rejects: scored once more, next to the text, so that no text is shuffled.

    Null texts are empty, null languages one of their own; a row whose score is the threshold stays; rows that repeat go or
    stay alike; without trusted rows all stay.
    """
    f = fit(docs, labels, doc_id, text, lang, **how)
    columns, sent = docs.columns, f.sent
    limited = f.limited(docs, F.coalesce(F.col(lang).cast("string"), F.lit("")), "_t_limit")
    at = columns.index(text)

    def run(batches):
        for b, _, s in _scored(sent, batches, at):
            limit = b.column(len(columns)).to_pylist()
            keep = [m is None or x <= m for x, m in zip(s.to_pylist(), limit, strict=True)]
            yield b.filter(pa.array(keep, pa.bool_())).select(list(range(len(columns))))

    return limited.select(*(F.col(f"`{c}`") for c in columns), "_t_limit").mapInArrow(run, docs.schema)
