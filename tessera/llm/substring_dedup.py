"""Substring dedup over sliding sentence spans.

A text is cut into sentences, and sentences of over ``LONG`` words into stretches that end at words whose hash says so (or
after 2 * ``LONG`` words), so that a passage is cut alike wherever it stands.  A span
starts at every sentence and takes as many as give it at least ``SENTENCES`` sentences and ``WORDS`` words; another ends at
every sentence and takes as many before it, so that the last sentences of a passage are covered too.  A span's words, lower
case and joined by blanks, are hashed to 96 bits.  All spans' hashes meet globally: a span is a repeat if it occurred earlier in
its own document, or if a document with a smaller id has it too.  Sentences covered by any repeat are removed.

Sentences end at ASCII marks, line ends and the marks of other scripts.  In scripts without blanks (Chinese, Japanese, Thai, Lao,
Burmese, Khmer) every character is a word that counts half.

A span occurs once per document in the global table, and hashes are combined in each task before they are shuffled; the join
that brings repeats back broadcasts the at most 1000 hashes that can hold a thousandth of all spans each, so a passage that
a third of all documents share never meets in one task.  Texts that lose nothing stay where they are as long as the list of the
others is short enough to be broadcast (``FEW``).
"""

from __future__ import annotations

import re
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, join_groups, small_batches, trimmed, utf8, written

SENTENCES = 2
WORDS = 20
LONG = 16
_SENTENCE = re.compile(rb"[^.!?\n]+[.!?\n]*\s*|[.!?\n]+\s*")
_WORD = re.compile(rb"\S+\s*")
#: Texts whose list of losers is up to so long stay unless they are on it; about 50 bytes each are broadcast.
FEW = 500_000
_END = rb"(?:[.!?\n]|\xe3\x80\x82|\xef\xbc[\x81\x8e\x9f]|\xef\xbd\xa1|\xe0\xa5\xa4|\xd8\x9f|\xdb\x94)"
_WIDE = rb"(?:[\xe4-\xe9][\x80-\xbf]{2}|\xe3[\x81-\xbf][\x80-\xbf]|\xe0[\xb8-\xbb][\x80-\xbf]|\xe1[\x80-\x82\x9e\x9f][\x80-\xbf])"
#: What may start a mark or a character of these; texts without it take the plain way, which cuts them alike.
_OTHER = re.compile(rb"[\xe0\xe1\xe3-\xe9\xef]|\xd8\x9f|\xdb\x94")
_OTHER_SENTENCE = re.compile(rb"(?:(?!" + _END + rb").)+" + _END + rb"*\s*|" + _END + rb"+\s*", re.S)
_OTHER_WORD = re.compile(rb"(?:" + _WIDE + rb"|(?:(?!" + _WIDE + rb")\S)+)\s*")
_WIDE_START = re.compile(_WIDE)


def _split(said: bytes, other: bool) -> list[bytes]:
    return [w.rstrip() for w in _OTHER_WORD.findall(said)] if other else said.split()


def _pieces(low: bytes, other: bool, long: int, every: bool) -> list[tuple[int, int, list[bytes]]]:
    """Byte ranges that make up the whole text, each a sentence or a stretch of one, with their words if ``every`` has them."""
    out, hashed = [], xxhash.xxh32_intdigest
    for m in (_OTHER_SENTENCE if other else _SENTENCE).finditer(low):
        a, b = m.span()
        if b - a <= 2 * long and not every:
            out.append((a, b, []))
            continue
        said = m[0]
        ws = _split(said, other)
        if b - a <= 2 * long or len(ws) <= long:
            out.append((a, b, ws))
            continue
        blanks = b - a - sum(map(len, ws))
        if not other and said.startswith(ws[0]) and blanks == len(ws) - 1 + len(said) - len(said.rstrip()):  # one between words
            ends = [a + n + k for k, n in enumerate(accumulate(map(len, ws)), 1)]
            ends[-1] = b
        else:
            ends = [w.end() for w in (_OTHER_WORD if other else _WORD).finditer(low, a, b)]
        i = 0
        for k, w in enumerate(ws, 1):
            if k - i == 2 * long or not hashed(w) & 7:
                out.append((a, ends[k - 1], ws[i:k]))
                a, i = ends[k - 1], k
        if a < b:
            out.append((a, b, ws[i:]))
    return out


def sentences(text: bytes, long: int = LONG) -> list[tuple[int, int]]:
    """Byte ranges that make up the whole text, each a sentence or a stretch of one."""
    return [(a, b) for a, b, _ in _pieces(text.translate(LOWER), bool(_OTHER.search(text)), long, False)]


def spans(text: bytes, least_sentences: int = SENTENCES, least_words: int = WORDS, long: int = LONG) -> tuple[list[tuple[int, int]], list[tuple[int, int, int, int]]]:
    """(sentences, spans): spans are (first sentence, one past the last, 64 and 32 bits of the hash) by place; the shortest
    that start and the shortest that end at each sentence, those of the same words once."""
    other = bool(_OTHER.search(text))
    pieces = _pieces(text.translate(LOWER), other, long, True)
    units, said = [(a, b) for a, b, _ in pieces], [ws for _, _, ws in pieces]
    words = [w for s in said for w in s]
    at, mass, n, x = [0], [0.0], 0, 0.0  # words before each sentence, and what they count
    for s in said:
        n += len(s)
        x += len(s) if not other else sum(0.5 if _WIDE_START.match(w) else 1 for w in s)
        at.append(n)
        mass.append(x)
    joined = b" ".join(words)
    begin = [n + k for k, n in enumerate(accumulate(map(len, words), initial=0))]  # where each word starts in the joined text
    found, j, hash128 = {}, 0, xxhash.xxh3_128_intdigest
    for i in range(len(units)):
        if not said[i]:
            continue
        j = max(j, i + least_sentences)
        while j <= len(units) and mass[j] - mass[i] < least_words:
            j += 1
        if j > len(units):
            break
        found[at[i], at[j]] = i, j
    i = 0
    for j in range(least_sentences, len(units) + 1):
        if not said[j - 1] or mass[j] < least_words:
            continue
        while i + 1 <= j - least_sentences and mass[j] - mass[i + 1] >= least_words:
            i += 1
        found.setdefault((at[i], at[j]), (i, j))
    out = []
    for (a, z), (i, j) in sorted(found.items()):
        h = hash128(joined[begin[a] : begin[z] - 1])
        g, h = h >> 96, h & (1 << 64) - 1
        out.append((i, j, h - (1 << 64) if h >> 63 else h, g - (1 << 32) if g >> 31 else g))
    return units, out


def _first_and_again(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int, bool]]:
    """A text's spans at their first places, and the merged stretches of those that came before (True)."""
    out, seen, again = [], set(), []
    for i, j, h, g in found:
        if (h, g) not in seen:
            seen.add((h, g))
            out.append((i, j, h, g, False))
        elif again and i <= again[-1][1]:
            again[-1] = (min(i, again[-1][0]), max(j, again[-1][1]), *again[-1][2:])
        else:
            again.append((i, j, h, g, True))
    return out + again


def _row_key(doc_id: str, text: str) -> Column:
    return F.xxhash64(F.col(doc_id), F.col(text))


def span_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """(h, g, doc, row, first, past, again): a row per distinct span of each row of ``docs``, at its first place there.

    With ``again`` there is a row per stretch of sentences covered by spans that the text has had before, with the hash of the
    stretch's first one."""
    small_batches(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        for b in batches:
            rows, columns = [], ([], [], [], [], [])
            for k, t in enumerate(b.column(2).to_pylist()):
                of = _first_and_again(spans(t, **how)[1])
                rows += [k] * len(of)
                for held, x in zip(columns, zip(*of, strict=True)):
                    held += x
            take = pa.array(rows, pa.int64())
            first, past, high, low, again = columns
            yield pa.RecordBatch.from_arrays([pa.array(high, pa.int64()), pa.array(low, pa.int32()), b.column(0).take(take), b.column(1).take(take), pa.array(first, pa.int32()), pa.array(past, pa.int32()), pa.array(again, pa.bool_())], names=["h", "g", "doc", "row", "first", "past", "again"])

    return docs.select(F.col(doc_id).alias("doc"), _row_key(doc_id, text).alias("row"), utf8(text).alias("_t_text")).mapInArrow(trimmed(run), f"h bigint, g int, doc {kind}, row bigint, first int, past int, again boolean")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One row per row of ``docs``: doc_id, text (without repeats), n_sentences, n_removed, removed array<struct<start, end>>.

    removed has byte ranges of the text in UTF-8, merged.  Null and empty texts come back as empty.  Null ids count as
    largest; rows that share an id (null included) count as one document, so they keep what they share among themselves.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    table = written(span_table(docs, doc_id, text, **how), "spans")
    total = table.count()
    groups = table.groupBy("h", "g").agg(F.min("doc").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = written(groups, "repeated")
    # a span that its text has again is counted twice, so it is among the groups
    later = join_groups(table, groups, ["h", "g"], "n", total).where(F.col("again") | ~F.col("doc").eqNullSafe(F.col("least")))
    gone = later.groupBy(F.col("row").alias("_t_row"), F.col("doc").alias("_t_doc")).agg(F.collect_list(F.struct("first", "past")).alias("gone"))
    gone = written(gone, "gone")
    texts = docs.select(F.col(doc_id).alias("doc_id"), utf8(text).alias("_t_text"), _row_key(doc_id, text).alias("row"))
    same = (F.col("row") == F.col("_t_row")) & F.col("doc_id").eqNullSafe(F.col("_t_doc"))
    # rows that repeat id and text share a key and a list of the same places twice over: they are removed alike
    if gone.count() <= FEW:
        losers = F.broadcast(gone.select("_t_row", "_t_doc"))
        whole = texts.join(losers, same, "left_anti").select("doc_id", "_t_text", F.lit(None).cast(gone.schema["gone"].dataType).alias("gone"))
        joined = whole.unionByName(texts.join(losers, same, "left_semi").join(gone, same).select("doc_id", "_t_text", "gone"))
    else:
        joined = texts.join(gone, same, "left").select("doc_id", "_t_text", "gone")

    def run(batches):
        for b in batches:
            texts, counts, removed, ranges = [], [], [], []
            for t, lost in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                units = sentences(t, how.get("long", LONG))
                if not lost:
                    texts.append(t)
                    counts.append(len(units))
                    removed.append(0)
                    ranges.append([])
                    continue
                covered = bytearray(len(units))
                for x in lost:
                    covered[x["first"] : x["past"]] = b"\1" * (x["past"] - x["first"])
                cut: list[list[int]] = []
                for (a, z), c in zip(units, covered, strict=True):
                    if c and cut and cut[-1][1] == a:
                        cut[-1][1] = z
                    elif c:
                        cut.append([a, z])
                texts.append(b"".join(t[a:z] for (a, z), c in zip(units, covered, strict=True) if not c))
                counts.append(len(units))
                removed.append(sum(covered))
                ranges.append([{"start": a, "end": z} for a, z in cut])
            struct = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.binary()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(ranges, struct)], names=["doc_id", "text", "n_sentences", "n_removed", "removed"])

    out = joined.mapInArrow(trimmed(run), f"doc_id {kind}, text binary, n_sentences bigint, n_removed bigint, removed array<struct<start:bigint,end:bigint>>")
    return out.withColumn("text", F.col("text").cast("string"))
