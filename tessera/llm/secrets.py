"""Secret scans: three base patterns, and password guess costs of values in credential contexts.

A value after a credential word and ``=`` or ``:`` is cut into words, dates, repeats, keyboard walks and brute-force spans
so that the guesses an attacker needs are fewest; dynamic programming over the value's positions finds that minimum.  Values
that take at least ``LEAST`` (log10) guesses are reported as ``guess`` spans besides the base ones.

Words are ranked from data: first a few that passwords are commonly made of, then the ``MOST_WORDS`` most common words of all
the documents, counted over whole texts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import small_batches, utf8, written

KINDS = ("assign", "access", "hex", "guess")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # the longest runs of 16 and more are the runs of [0-9a-f]+ that pass
#: Words that announce a credential; the value runs to white space or a closing mark, and has at least 6 characters.
_CONTEXT = re.compile(r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|api_?key|access_?key|private_?key|auth(?:orization)?)["']?\x20*[:=]\x20*(["']?)([^\s"'<>,;]{6,})""", re.I | re.A)
#: log10 of guesses from which a value counts as a secret.
LEAST = 8.0

#: So many of the documents' most common words (a to z, 3 to 24 letters) are collected and sent to the tasks, about 10 bytes each.
MOST_WORDS = 50_000
#: Words that passwords are made of, most common first.
WORDS = (
    "password", "admin", "welcome", "letmein", "monkey", "dragon", "master", "login", "princess", "sunshine", "football", "shadow", "michael", "superman", "batman",
    "trustno", "hello", "charlie", "freedom", "whatever", "secret", "summer", "winter", "spring", "autumn", "love", "angel", "flower", "hunter", "soccer", "baseball",
    "starwars", "computer", "internet", "test", "guest", "root", "user", "default", "changeme", "qwerty", "pass", "access", "server", "system", "example", "sample",
    "token", "key", "api", "the", "and", "you", "that", "with", "this", "have", "from", "your", "none", "null", "true", "false", "required", "value", "string",
)
#: Rows of a keyboard; walks go along a row either way.
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
#: Letters that stand for others.
LEET = {"4": "a", "@": "a", "3": "e", "1": "i", "!": "i", "0": "o", "$": "s", "5": "s", "7": "t"}

_DATE = re.compile(r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d|(?:19|20)\d\d")
_BRUTE = math.log10(10)


@dataclass
class Ranks:
    """log10 of the guesses that each word takes, the most common first."""

    cost: dict[str, float]
    longest: int

    @classmethod
    def of(cls, words: Iterable[str]) -> Ranks:
        listed = list(dict.fromkeys(words))
        return cls({w: math.log10(i + 2) for i, w in enumerate(listed)}, max(map(len, listed), default=0))


COMMON = Ranks.of(WORDS)


def common_words(docs: DataFrame, text: str = "text", most: int = MOST_WORDS) -> list[str]:
    """The most common words of all texts, of which at least two occur; ties by the word.  Null texts have none."""
    said = F.lower(F.col(text).cast("string"))
    counted = docs.select(F.explode(F.regexp_extract_all(said, F.lit("(?<![a-z])[a-z]{3,24}(?![a-z])"), F.lit(0))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    # tasks send the driver no more words than it wants: a histogram of the counts tells from which count on
    counted = written(counted.where("n > 1").withColumn("level", F.floor(F.log2("n") * 64)), "words")
    left, last = most, None
    for r in sorted(counted.groupBy("level").agg(F.count(F.lit(1)).alias("words")).collect(), reverse=True):
        if r["words"] > left:
            last = r["level"]
            break
        left -= r["words"]
    order = (F.desc("n"), "word")
    if last is None:
        return [r["word"] for r in counted.orderBy(*order).collect()]
    return [r["word"] for part in (counted.where(F.col("level") > last).orderBy(*order), counted.where(F.col("level") == last).orderBy(*order).limit(left)) for r in part.collect()]


def _spans(value: str, words: Ranks):
    """(start, end, log10 guesses, kind) of all pieces but brute force; their number grows linearly with the value."""
    ranks, longest = words.cost, words.longest
    low = value.lower()
    plain = "".join(LEET.get(c, c) for c in low)
    n = len(value)
    # by size: how many characters from each place on equal the one that many places later
    same = {size: [0] * (n + 1) for size in (1, 2, 3, 4)}
    for size, run in same.items():
        for i in range(n - size - 1, -1, -1):
            run[i] = run[i + 1] + 1 if value[i] == value[i + size] else 0
    for i in range(n):
        for j in range(i + 3, min(n, i + longest) + 1):
            for said, extra in ((low, 0.0), (plain, 0.3)):
                cost = ranks.get(said[i:j])
                if cost is not None:
                    yield i, j, cost + extra + (0.3 if value[i:j] != low[i:j] else 0.0), "word"
                    break
        if m := _DATE.match(value, i):
            yield i, m.end(), math.log10(365 * 100) if m.end() - i > 4 else 2.0, "date"
        for size in (1, 2, 3, 4):
            j = i + size * (1 + same[size][i] // size)
            if j - i >= max(3, 2 * size):
                yield i, j, size * _BRUTE + math.log10((j - i) / size), "repeat"
        for row in ROWS:
            for line in (row, row[::-1]):
                at = line.find(low[i])
                j = i
                while at >= 0 and j < n and at + j - i < len(line) and line[at + j - i] == low[j]:
                    j += 1
                if j - i >= 3:
                    yield i, j, math.log10(47 * 2 * (j - i)), "walk"


def guess_cost(value: str, words: Ranks = COMMON) -> tuple[float, list[tuple[int, int, str]]]:
    """(log10 guesses, the cheapest segmentation).  A brute-force character costs a factor of 10, each piece a factor of 2."""
    n, part = len(value), math.log10(2)
    ending: list[list[tuple[int, float, str]]] = [[] for _ in range(n + 1)]
    for i, j, cost, kind in _spans(value, words):
        ending[j].append((i, cost, kind))
    best: list[tuple[float, int, str]] = [(0.0, 0, "")]
    for j in range(1, n + 1):
        # a brute-force character goes on with a brute-force span before it, or opens one
        before, _, kind = best[j - 1]
        options = [(before + _BRUTE + (0.0 if kind == "brute" else part), j - 1, "brute")]
        options += [(best[i][0] + cost + part, i, kind) for i, cost, kind in ending[j]]
        best.append(min(options))
    out: list[tuple[int, int, str]] = []
    j = n
    while j:
        _, i, kind = best[j]
        if out and kind == "brute" == out[-1][2]:
            out[-1] = (i, out[-1][1], kind)
        else:
            out.append((i, j, kind))
        j = i
    return best[n][0], out[::-1]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns' matches, by start and then kind as listed."""
    out = [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(*m.span(), "access") for m in _ACCESS.finditer(text) if len(m[0]) >= 18] if "AKIA" in text else []
    out += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def guess_spans(text: str, words: Ranks = COMMON, least: float = LEAST) -> list[tuple[int, int, str]]:
    """(start, end, "guess") of values in credential contexts that take at least 10 ** ``least`` guesses."""
    return [(*m.span(2), "guess") for m in _CONTEXT.finditer(text) if guess_cost(m[2], words)[0] >= least]


def _loaded(sent, cache: dict = {}) -> Ranks:  # noqa: B006  one dictionary a worker process
    if cache.get("of") is not sent.value:
        cache["of"], cache["ranks"] = sent.value, Ranks.of(sent.value)
    return cache["ranks"]


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: list[str] | None = None, least: float = LEAST) -> DataFrame:
    """One row per row of ``docs``: doc_id, spans array<struct<start, end, kind>>, by start and then kind as listed.

    Offsets count code points, ends are exclusive.  A null text is empty; an empty text has no spans; rows that repeat keep
    a row each.  Whole texts are scanned.  ``words``, the most common first, are by default ``WORDS`` and then those of
    ``common_words``.
    """
    sent = docs.sparkSession.sparkContext.broadcast(list(WORDS) + common_words(docs, text) if words is None else words)
    small_batches(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()
    struct = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])
    order = {k: i for i, k in enumerate(KINDS)}

    def run(batches):
        ranks = _loaded(sent)
        for b in batches:
            found = []
            for raw in b.column(1).to_pylist():
                t = raw.decode("utf-8", "replace")
                spans = sorted(base_spans(t) + guess_spans(t, ranks, least), key=lambda s: (s[0], order[s[2]], s[1]))
                found.append([{"start": a, "end": z, "kind": k} for a, z, k in spans])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(struct))], names=["doc_id", "spans"])

    return docs.select(F.col(doc_id).alias("doc_id"), utf8(text).alias("_t_text")).mapInArrow(run, f"doc_id {kind}, spans array<struct<start:bigint,end:bigint,kind:string>>")
