"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark windows scans each text once.

Normalising lower-cases A-Z and turns every ASCII byte that is no letter or digit into a blank, byte for byte, so offsets
in the normalised text are offsets in the original.  The automaton is sent to every task; it is built from at most
``max_windows`` windows.  A larger benchmark is cut into blocks of that many, each sent by itself: a task reads about
``HELD_BYTES`` of texts, scans them with one block's automaton after another and unites the findings.  So an automaton's size
has a bound, no window is left out, and texts are read once and never shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import small_batches, trimmed, utf8, written

WINDOW = 10
#: An automaton has about 50 bytes a character of its windows: 100,000 windows of 60 characters take about 300 MB.
MAX_WINDOWS = 100_000
#: Texts that a task scans with one block's automaton before it builds the next one's.
HELD_BYTES = 32 << 20
_CUT = 10_000
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isdigit() or 97 <= b <= 122 else 32 for b in range(256))
_WORD = re.compile(rb"[^ ]+")


def words(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()  # blanks are the only ASCII white space left


def _windows(ws: list[bytes], size: int) -> list[bytes]:
    if not ws:
        return []
    return [b" ".join(ws[i : i + size]) for i in range(max(1, len(ws) - size + 1))]


class Scanner:
    """The automaton of (window, item) pairs and what it finds in a text."""

    def __init__(self, found: list[tuple[str, bytes]]) -> None:
        import ahocorasick

        by: dict[bytes, set[str]] = {}
        for item, window in found:
            by.setdefault(window, set()).add(item)
        self.automaton = ahocorasick.Automaton()
        for window, items in by.items():
            self.automaton.add_word(f" {window.decode('latin-1')} ", (window.count(b" ") + 1, items))
        self.any = bool(by)
        if by:
            self.automaton.make_automaton()

    def __call__(self, text: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
        """(words of the text, hit ranges of word numbers, merged and half-open, items found)."""
        ws = words(text)
        items: set[str] = set()
        ranges: list[tuple[int, int]] = []
        if self.any and ws:
            said = f" {b' '.join(ws).decode('latin-1')} "
            ends: list[int] = []
            for at, (n, of) in self.automaton.iter(said):
                if not ends:
                    x = 0
                    for w in ws:
                        x += len(w) + 1
                        ends.append(x)  # where the blank after each word stands
                last = bisect_left(ends, at) + 1
                items |= of
                first = last - n
                while ranges and ranges[-1][1] >= first:  # the scan goes by window ends; shorter windows may lie within
                    first = min(first, ranges.pop()[0])
                ranges.append((first, last))
        return len(ws), ranges, items


def spans(text: bytes, ranges: list[tuple[int, int]]) -> list[dict]:
    """Code point offsets in the original text of ranges of word numbers."""
    if not ranges:
        return []
    at = [m.span() for m in _WORD.finditer(text.translate(_NORMAL))]
    out, done, points = [], 0, 0
    for a, b in ranges:
        begin, end = at[a][0], at[b - 1][1]
        start = points + len(text[done:begin].decode("utf-8", "replace"))
        stop = start + len(text[begin:end].decode("utf-8", "replace"))
        out.append({"start": start, "end": stop})
        done, points = end, stop
    return out


def benchmark_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """(item, win): the distinct windows; an item of fewer than ``size`` words, but not none, is one; null ids are "null"."""

    def run(batches):
        for b in batches:
            for item, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ws = words(t)
                found = list(dict.fromkeys(_windows(ws, size)))
                for i in range(0, len(found), _CUT):
                    part = found[i : i + _CUT]
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(part), pa.string()), pa.array(part, pa.binary())], names=["item", "win"])

    return benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"), utf8(text).alias("_t_text")).mapInArrow(run, "item string, win binary").distinct()


def _blocks(benchmark: DataFrame, item_id: str, item_text: str, size: int, max_windows: int) -> list:
    """The windows of each block, broadcast; the driver holds one block at a time."""
    found = written(benchmark_windows(benchmark, item_id, item_text, size), "windows")
    blocks = max(1, -(-found.count() // max_windows))
    sent = []
    for k in range(blocks):
        part = found.where(F.pmod(F.xxhash64("item", "win"), F.lit(blocks)) == k) if blocks > 1 else found
        sent.append(found.sparkSession.sparkContext.broadcast([(r["item"], bytes(r["win"])) for r in part.collect()]))
    return sent


def _loaded(sent, cache: dict = {}) -> Scanner:  # noqa: B006  one automaton a worker process
    if cache.get("of") is not sent:
        cache.clear()
        cache["scanner"] = Scanner(sent.value)
        cache["of"] = sent
        sent.__dict__.pop("_value", None)  # the broadcast's own copy; it is read again from its file
    return cache["scanner"]


def _held(batches, at: int, blocks: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches to scan together: one by one, or so many that building a block's automaton is worth it."""
    held, weight = [], 0
    for b in batches:
        held.append(b)
        weight += b.column(at).nbytes
        if blocks == 1 or weight >= HELD_BYTES:
            yield held
            held, weight = [], 0
    if held:
        yield held


def _united(ranges: list[tuple[int, int]], more: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges + more) if ranges and more else ranges or more:
        if out and out[-1][1] >= a:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, items array<string>, spans array<struct<start, end>>.

    n_hit counts words within any occurrence of a window; items are the ids (as strings) of items with an occurring window,
    sorted; spans are hit stretches, in code points of the original text, half-open.  Null texts have no words.  Rows that
    repeat keep a row each.  An empty benchmark hits nothing.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()
    blocks = _blocks(benchmark, item_id, item_text, size, max_windows)

    def run(batches):
        for held in _held(batches, 1, len(blocks)):
            texts = [b.column(1).to_pylist() for b in held]
            n: list[int] = []
            ranges: list[list[tuple[int, int]]] = [[] for ts in texts for _ in ts]
            items: list[set[str]] = [set() for _ in ranges]
            for k, sent in enumerate(blocks):
                scanner = _loaded(sent)
                for i, t in enumerate(t for ts in texts for t in ts):
                    count, hit, of = scanner(t)
                    ranges[i] = _united(ranges[i], hit)
                    items[i] |= of
                    if not k:
                        n.append(count)
            i = 0
            for b, ts in zip(held, texts, strict=True):
                j = i + len(ts)
                yield pa.RecordBatch.from_arrays(_found(b.column(0), ts, n[i:j], ranges[i:j], [sorted(x) for x in items[i:j]]), names=["doc_id", "n_words", "n_hit", "items", "spans"])
                i = j

    schema = f"doc_id {kind}, n_words bigint, n_hit bigint, items array<string>, spans array<struct<start:bigint,end:bigint>>"
    return docs.select(F.col(doc_id).alias("doc_id"), utf8(text).alias("_t_text")).mapInArrow(run, schema)


def _found(ids, texts, n, ranges, items) -> list[pa.Array]:
    return [
        ids, pa.array(n, pa.int64()), pa.array([sum(b - a for a, b in r) for r in ranges], pa.int64()), pa.array(items, pa.list_(pa.string())),
        pa.array([spans(t, r) for t, r in zip(texts, ranges, strict=True)], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ]


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """``docs`` without the rows in which any window occurs; nothing is shuffled.

    Null and empty texts have no words and stay, also if an item has none; rows that repeat go or stay alike; an empty
    benchmark drops nothing.
    """
    small_batches(docs.sparkSession)
    at = docs.columns.index(text)
    blocks = _blocks(benchmark, item_id, item_text, size, max_windows)

    def run(batches):
        for held in _held(batches, at, len(blocks)):
            texts = [b.column(at).cast(pa.binary()).to_pylist() for b in held]
            stays = [[True] * len(ts) for ts in texts]
            for sent in blocks:
                scanner = _loaded(sent)
                for ts, keep in zip(texts, stays, strict=True):
                    for i, t in enumerate(ts):
                        if keep[i] and t and scanner(t)[1]:
                            keep[i] = False
            for b, keep in zip(held, stays, strict=True):
                yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(trimmed(run), docs.schema)
