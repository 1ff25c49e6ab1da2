"""The ten queries and the pipeline on tables: digests and formatted columns against plain versions."""

import hashlib
import zlib
from collections import Counter

import pytest
import xxhash

import corpus_pipeline
from tessera.llm import queries, secrets
from tests.llm.brute import groups_of, lower, split_words

SF = "/root/testdata/sf0.001"
WHITE = " \t\n\x0b\x0c\r"


def rows(spark, name):
    return queries.QUERIES[name](spark, SF).collect()


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def test_op1(spark, texts):
    from tests.llm.test_dedup import slow_removal

    plain = [(i, t) for i, t in texts.items() if t.isascii()]
    assert len(plain) > 20
    got = {r["doc_id"]: r for r in rows(spark, "op1_substring_dedup")}
    assert set(got) == set(texts) and all(r["changed"] == (r["n_removed"] > 0) == (r["text"] != texts[i]) for i, r in got.items())
    alone = spark.createDataFrame(plain, "doc_id bigint, text string")
    from tessera.llm import substring_dedup

    assert {r["doc_id"]: r["text"] for r in substring_dedup.remove_repeats(alone).collect()} == slow_removal(plain)


def test_op4(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode
    lengths = [len(encode(t, add_special_tokens=False).ids) for t in texts.values()]
    got = {r["n_tokens"]: r for r in rows(spark, "op4_token_counts")}
    assert {k: r["n_docs"] for k, r in got.items()} == Counter(lengths)
    assert all(r["tokens_ge"] == sum(x for x in lengths if x >= k) and r["truncated_tokens"] == sum(min(x, k) for x in lengths) for k, r in got.items())


def test_op5(spark, texts):
    prints = {}
    for i, t in texts.items():
        ws = split_words(lower(t), WHITE)
        hashes = [xxhash.xxh64_intdigest(" ".join(ws[k : k + 3]).encode(), 42) for k in range(max(1, len(ws) - 2))] if ws else []
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    near = [(a, b) for a in texts for b in texts if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    groups = groups_of(texts, near)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows(spark, "op5_simhash")}
    assert got == {i: (f"{prints[i]:016x}", groups[i]) for i in texts}


def test_op8(spark, texts):
    from tests.llm.test_text_operators import slow_base

    order = {k: n for n, k in enumerate(secrets.KINDS)}
    for r in rows(spark, "op8_secrets"):
        base = sorted(slow_base(texts[r["doc_id"]]), key=lambda s: (s[0], order[s[2]]))
        said = [f"{k}:{a}:{z}" for a, z, k in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(said).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(s[2] == k for s in base) for k in ("assign", "access", "hex")]
        every = [x.split(":") for x in r["spans"].split(",") if x]
        assert [":".join(x) for x in every if x[0] != "guess"] == said
        assert every == sorted(every, key=lambda x: (int(x[1]), order[x[0]], int(x[2])))


def test_op6_and_op7_give_a_row_a_document(spark, texts):
    for name in ("op6_lm_scoring", "op7_quality"):
        assert sorted(r["doc_id"] for r in rows(spark, name)) == sorted(texts)


def test_op9(spark, texts):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode
    ids = {i: np.array([*encode(t, add_special_tokens=False).ids, 1], "<u4") for i, t in texts.items()}
    got = rows(spark, "op9_packing")
    at, fill = {}, {}
    for r in sorted(got, key=lambda r: (r["doc_id"], r["start"])):
        i, part = r["doc_id"], ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["start"] == at.get(i, 0) and len(part) == r["length"] and zlib.crc32(part.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids[i])
        at[i] = r["start"] + r["length"]
        fill.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert at == {i: len(x) for i, x in ids.items()}
    for parts in fill.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and sum(n for _, n in parts) <= 2048
    assert sum(len(x) for x in ids.values()) > 0.9 * 2048 * (len(fill) - 1)


def test_pipeline_on_awkward_tables(spark, awkward, nothing, tmp_path):
    whole = spark.read.parquet(f"{SF}/documents.parquet")
    odd = awkward.select(*whole.columns).collect()
    for name, docs in (("odd", spark.createDataFrame(odd, whole.schema)), ("none", whole.where("false"))):
        folder = str(tmp_path / name)
        docs.write.parquet(f"{folder}/documents.parquet")
        for t in ("labels", "benchmark"):
            table = spark.read.parquet(f"{SF}/{t}.parquet")
            (table if name == "odd" else table.where("false")).write.parquet(f"{folder}/{t}.parquet")
        found = corpus_pipeline.run(spark, folder).collect()
        assert bool(found) == (name == "odd")
        assert {r["doc_id"] for r in found} <= {r["doc_id"] for r in odd}
