"""Exact dedup: a Bloom filter of doubly hit cells finds possibly repeated texts; only those rows shuffle.

The texts are read once, for a table of (id, 64-bit hash, SHA-256).  Pass 1 takes each hash to one 64-bit word of a filter and
to two bits of that word, and counts the rows of each (word, bit) cell; the counts are combined before they are shuffled.
Cells hit at least twice make up the filter, whose words grow with the rows.  Pass 2 looks each hash up: a row with a cell hit
once has no equal and passes straight through; the others are shuffled by SHA-256 and grouped exactly, so a false positive of
the filter costs a shuffled row and never a wrong result.

A filter of up to ``max_broadcast_words`` rows of 16 bytes is broadcast; a larger one meets the rows' hashes, not their texts,
in a join by word.  DataFrame functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import join_groups, written

#: Filter bits a text; with 32, two texts share each filter word and under one in a hundred is a false positive.
BITS_A_TEXT = 32
HASHES = 2
#: Filter words that are broadcast: 2,097,152 are under 100 MB as a table.
MAX_BROADCAST_WORDS = 1 << 21
#: Rows that go, as (id, SHA-256), that are broadcast when texts are dropped: about 150 bytes each.
MAX_BROADCAST_ROWS = 500_000


def _words(rows: int) -> int:
    return max(1024, rows * BITS_A_TEXT // 64)


def _text(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def _address(words: int) -> tuple[Column, list[Column]]:
    """Filter word, and the bits in it, of the hash in ``_t_h``."""
    h = F.col("_t_h")
    bits = [F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(HASHES)]
    return F.pmod(F.shiftrightunsigned(h, 6 * HASHES), F.lit(words)), bits


def _mask(bits: list[Column]) -> Column:
    return reduce(lambda a, b: a.bitwiseOR(b), (F.call_function("shiftleft", F.lit(1).cast("long"), b) for b in bits))


def repeat_filter(hashed: DataFrame, words: int) -> DataFrame:
    """(_t_word, _t_bits): the filter words with the bits that at least two rows of ``_t_h`` hit."""
    word, bits = _address(words)
    cells = hashed.select(word.alias("_t_word"), F.explode(F.array_distinct(F.array(*bits))).alias("_t_bit"))
    twice = cells.groupBy("_t_word", "_t_bit").agg(F.count(F.lit(1)).alias("_t_n")).where("_t_n > 1")
    return twice.groupBy("_t_word").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_t_bit"))).alias("_t_bits"))


def hashes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_broadcast_words: int = MAX_BROADCAST_WORDS) -> tuple[DataFrame, int]:
    """((doc_id, text_sha256, _t_maybe), rows): written; ``_t_maybe`` is false only where no other row has the same text."""
    hashed = written(docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(_text(text)).alias("_t_h"), F.sha2(_text(text), 256).alias("text_sha256")), "hashes")
    rows = hashed.count()
    words = _words(rows)
    found = written(repeat_filter(hashed, words), "filter")
    small = found.count() <= max_broadcast_words
    word, bits = _address(words)
    probed = hashed.withColumns({"_t_word": word, "_t_mask": _mask(bits)})
    # a hot text's rows have one word, so the join by word is Spark's to split where it is skewed
    looked = probed.join(F.broadcast(found), "_t_word", "left") if small else probed.hint("merge").join(found, "_t_word", "left")
    maybe = F.coalesce(F.col("_t_bits").bitwiseAND(F.col("_t_mask")) == F.col("_t_mask"), F.lit(False))
    return written(looked.select("doc_id", "text_sha256", maybe.alias("_t_maybe")), "flagged"), rows


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_broadcast_words: int = MAX_BROADCAST_WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256 (of the text in UTF-8).

    Texts are equal when identical byte by byte; a null text is an empty one.  Of equal texts the row with the largest id
    stays.  Null ids count as smallest (keep_id is null only where all ids of the group are); rows that repeat an id along
    with its text are each marked kept.  An empty table gives an empty result; other columns are not read.
    """
    flagged, rows = hashes(docs, doc_id, text, max_broadcast_words)
    single = flagged.where("not _t_maybe").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    maybe = flagged.where("_t_maybe").select("doc_id", "text_sha256")
    groups = written(maybe.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "groups")
    joined = join_groups(maybe, groups, "text_sha256", "group_size", rows)
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")
    return single.unionByName(joined.select("doc_id", "keep_id", "group_size", kept, "text_sha256"))


def drop_exact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_broadcast_words: int = MAX_BROADCAST_WORDS, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``docs`` with one row of each text, that with the largest id (null ids count as smallest; of rows that tie, any one).

    The groups are found as (id, SHA-256) alone.  The rows that go are then left out where the texts lie, by a broadcast list
    of up to ``max_broadcast_rows`` of (id, SHA-256); a longer list meets the texts in one shuffle by hash, without a sort.  Of
    rows that repeat the id and the text that stay, one is picked, combined in each task first.
    """
    groups = exact_groups(docs, doc_id, text, max_broadcast_words).where("group_size > 1")
    marked = written(groups.groupBy(F.col("doc_id").alias("_t_id"), F.col("text_sha256").alias("_t_sha")).agg(F.bool_or("kept").alias("_t_kept"), F.count(F.lit(1)).alias("_t_n")).where("not _t_kept or _t_n > 1"), "gone")
    few = marked.count() <= max_broadcast_rows
    ties = marked.where("_t_kept")
    same = (F.sha2(_text(text), 256) == F.col("_t_sha")) & F.col(doc_id).eqNullSafe(F.col("_t_id"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    side = F.broadcast if few else (lambda x: x.hint("shuffle_hash"))
    stays = docs.join(side(marked), same, "left_anti")
    if ties.isEmpty():
        return stays
    again = docs.join(side(ties), same).groupBy("_t_id", "_t_sha").agg(F.first(F.struct(*columns)).alias("_t_row"))
    return stays.unionByName(again.select("_t_row.*"))
