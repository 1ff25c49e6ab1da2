"""Token counts, packing, decontamination, secrets against brute force."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import decontaminate, packing, secrets, tokens
from tests.llm.brute import first_fit, lower, split_words

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "a" * 5000, " " * 3000 + "x", "\n\n\n a\t b", "naïve 日本語 ✓✓ 🏳️‍🌈", "don't we'll I'm 'tis", "x <|endoftext|> y", "1234567890 3.14", "​　﻿", "áé", "\x00\x01"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_ids_are_the_tokenizers(spark, tokenizer):
    texts = ODD + [r["text"] for t in ("documents", "conversations", "benchmark") for r in spark.read.parquet(f"{SF}/{t}.parquet").select("text").collect()]
    encode = tokens.encoder()
    assert all(encode(t.encode()) == ids(tokenizer, t) for t in texts)


def test_histogram_and_suffix_sums(spark, tokenizer, awkward, nothing):
    df = spark.createDataFrame([(t,) for t in ODD * 3 + [None]], "text string")
    lengths = sorted([len(ids(tokenizer, t)) for t in ODD * 3 + [None]])
    sums = tokens.suffix_sums(tokens.length_histogram(df), width=4)
    got = {r["n_tokens"]: r for r in sums.collect()}
    assert {k: r["n_docs"] for k, r in got.items()} == Counter(lengths)
    for k, r in got.items():
        assert r["docs_ge"] == sum(x >= k for x in lengths) and r["tokens_ge"] == sum(x for x in lengths if x >= k)
        assert r["truncated_tokens"] == sum(min(x, k) for x in lengths) and r["rank"] == sum(x <= k for x in lengths)
        assert (r["total_docs"], r["total_tokens"]) == (len(lengths), sum(lengths))
    limits = [0, 1, 3, 7, 500, 10**6]
    assert {r["limit"]: r["truncated_tokens"] for r in tokens.truncated_totals(sums, limits).collect()} == {m: sum(min(x, m) for x in lengths) for m in limits}
    parts = {r["part"]: r["n_tokens"] for r in tokens.quantiles(sums, [0.01, 0.5, 0.9, 1.0]).collect()}
    assert parts == {p: lengths[int(np.ceil(p * len(lengths))) - 1] for p in (0.01, 0.5, 0.9, 1.0)}
    assert tokens.length_histogram(awkward).agg({"n_docs": "sum"}).first()[0] == 12
    assert tokens.suffix_sums(tokens.length_histogram(nothing)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_first_fit_decreasing(seed):
    rng = random.Random(seed)
    sizes = [rng.randint(1, 64) for _ in range(rng.randint(0, 300))]
    assert packing.first_fit_decreasing(sizes, 64) == first_fit(sizes, 64)


def check_packed(rows, texts, tokenizer, context):
    """Every id of every document in exactly one piece; sequences gapless and not too long."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert by_doc.keys() == texts.keys()
    for d, parts in by_doc.items():
        all_ids, at = [*ids(tokenizer, texts[d]), 1], 0
        for r in sorted(parts, key=lambda r: r["start"]):
            part = all_ids[r["start"] : r["start"] + r["length"]]
            assert r["start"] == at and r["doc_tokens"] == len(all_ids) and r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            at += r["length"]
        assert at == len(all_ids)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= context
    return len(by_sequence)


def test_packing_holds_all_ids(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    n = check_packed(packing.pack(docs).collect(), texts, tokenizer, 2048)
    total = sum(len(ids(tokenizer, t)) + 1 for t in texts.values())
    assert n <= -(-total // 2048) * 1.03 + 1
    check_packed(packing.pack(docs, context=100, group_size=50).collect(), texts, tokenizer, 100)


def test_packing_awkward(spark, tokenizer, awkward, nothing):
    got = packing.pack(awkward, with_ids=True).collect()
    assert sum(r["length"] for r in got) == sum(len(ids(tokenizer, r["text"])) + 1 for r in awkward.collect())
    assert all(len(r["ids"]) == r["length"] for r in got)
    assert packing.pack(nothing).count() == 0


def slow_contamination(text, items, size=10):
    sep = [chr(c) for c in range(128) if not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122)]
    words = split_words(lower(text or ""), sep)
    hit, found = set(), set()
    for item, t in items:
        w = split_words(lower(t or ""), sep)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            window = w[i : i + size]
            for j in range(len(words) - len(window) + 1):
                if words[j : j + len(window)] == window:
                    hit |= set(range(j, j + len(window)))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


def contamination_case(seed=2):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "été", "x1", "GAMMA", "日本", "d"]
    say = lambda n: "".join(rng.choice(words) + rng.choice([" ", ", ", "\n", "--"]) for _ in range(n))
    items = [(i, say(rng.choice([1, 2, 5, 10, 12, 25]))) for i in range(12)] + [(90, None), (91, ""), (92, "!!"), (93, say(30)), (93, say(11)), (94, "beta")]
    docs = []
    for d in range(40):
        t = say(rng.randint(0, 40))
        if rng.random() < 0.6:
            t += rng.choice(items)[1] or ""
        docs.append((d, t + say(rng.randint(0, 9))))
    return docs + [(100, None), (101, "")], items


@pytest.mark.parametrize("most", [100_000, 7])
def test_contamination_brute_force(spark, most):
    docs, items = contamination_case()
    items = [x for x in items if x[0] not in (0, 94)] if most == 7 else items
    d, b = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    got = {r["doc_id"]: r for r in decontaminate.contamination(d, b, max_windows=most).collect()}
    want = {i: slow_contamination(t, items) for i, t in docs}
    assert {i: (r["n_words"], r["n_hit"], r["items"]) for i, r in got.items()} == want
    for i, t in docs:
        marked = [(t or "")[s["start"] : s["end"]] for s in got[i]["spans"]]
        assert sum(slow_contamination(m, [])[0] for m in marked) == want[i][1]
    kept = {r["doc_id"] for r in decontaminate.drop_contaminated(d, b, max_windows=most).collect()}
    assert kept == {i for i, x in want.items() if not x[1]}


def test_contamination_awkward(spark, awkward, nothing):
    items = spark.createDataFrame([(None, "lost id"), (1, None)], "item_id bigint, text string")
    got = decontaminate.contamination(awkward, items).collect()
    assert len(got) == 12 and [r["items"] for r in got if r["n_hit"]] == [["null"]]
    assert decontaminate.drop_contaminated(awkward, items).count() == 11
    assert decontaminate.contamination(awkward, items.where("false")).where("n_hit > 0").count() == 0
    assert decontaminate.contamination(nothing, items).count() == 0 and decontaminate.drop_contaminated(nothing, items).count() == 0


def slow_base(text):
    """The contract's patterns as they stand."""
    out = [(m.start(), 0, m.end(), "assign") for m in re.finditer(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return [(a, z, k) for a, _, z, k in sorted(out)]


def test_base_spans(spark):
    rng = random.Random(8)
    parts = ["password", "PassWd", "api_key", "apikey", "API_KEY", "toKen", "ſecret", "toKen", '"', "'", " ", "=", ":", "AKIA", "AKIAAKIA", "ABCDEF0123456789", "0123456789abcdef", "deadbeef", "short", "x" * 12, "a.b-c_d/e+f==", "é", "\n", "\t"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert all(secrets.base_spans(t) == slow_base(t) for t in texts)
    assert any(slow_base(t) for t in texts)


def slow_cost(value, words):
    """The cheapest of all segmentations, one after another."""
    n = len(value)
    pieces = {}
    for i, j, cost, _ in secrets._spans(value, words):
        pieces[i, j] = min(cost, pieces.get((i, j), cost))
    best = float("inf")
    for r in range(n):
        for cuts in combinations(range(1, n), r):
            ends = [0, *cuts, n]
            total = 0.0
            for a, b in zip(ends, ends[1:]):
                brute, known = (b - a) * secrets._BRUTE, pieces.get((a, b), float("inf"))
                if known < brute:
                    total += known
                else:
                    total += brute
                total += np.log10(2)
            best = min(best, total)
    return best


@pytest.mark.parametrize("value", ["password", "p4ssw0rd1", "qwertyui", "aaaaaabb", "20240131", "xk3!vq", "lovelove9", "abcabcabc", "Zz"])
def test_guess_cost_is_the_minimum(value):
    cost, parts = secrets.guess_cost(value)
    assert cost == pytest.approx(slow_cost(value, secrets.COMMON))
    assert [a for a, _, _ in parts] == [0, *(z for _, z, _ in parts[:-1])] and parts[-1][1] == len(value)


def test_guesses_tell_secrets_from_plain_values():
    found = lambda t: [t[a:z] for a, z, _ in secrets.guess_spans(t)]
    assert found("password: xK9!vq2#Lm") == ["xK9!vq2#Lm"]
    assert found("password = password1") == [] and found("pwd: qwertyuiop") == [] and found("token: required") == []
    assert secrets.guess_cost("x" * 200)[0] < 10 < secrets.guess_cost("8fKq2LzW9p")[0]


def test_long_values_are_whole():
    rng = random.Random(21)
    secret = "".join(rng.choice("abcdefghijkmnpqrstuvwxyzABCDEFGH23456789") for _ in range(900))
    for value in (secret, "x" * 200 + secret[:60]):
        text = f"pwd: {value} end"
        assert [text[a:z] for a, z, _ in secrets.guess_spans(text)] == [value]
    assert secrets.guess_cost(secret)[0] > secrets.guess_cost(secret[:200])[0] + 500
    assert secrets.guess_cost("x" * 50_000)[0] < 10


def test_secrets_awkward(spark, awkward, nothing):
    got = {r["doc_id"]: r["spans"] for r in secrets.scan(awkward).collect()}
    text = "AKIA" + "Z" * 16 + " password = hunter2hunter2"
    assert [(s["kind"], text[s["start"] : s["end"]]) for s in got[9]][:2] == [("access", "AKIA" + "Z" * 16), ("assign", "password = hunter2hunter2")]
    assert got[3] == [] and secrets.scan(nothing).count() == 0 and secrets.scan(awkward).count() == 12


def test_words_are_ranked_from_the_documents(spark):
    rows = [(1, "The butterfly's wing; butterfly nets. Configuration FILES configuration"), (2, "wing of a butterfly wing"), (3, None), (4, "once upon " + "x" * 30 + " " + "x" * 30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert secrets.common_words(docs) == ["butterfly", "wing", "configuration"]
    many = spark.createDataFrame([(" ".join(f"{chr(97 + k % 26)}{chr(97 + k // 26)}x" for k in range(90) for _ in range(2 + (k * 7) % 40)),)], "text string")
    every = secrets.common_words(many)
    assert len(every) == 90 and all(secrets.common_words(many, most=m) == every[:m] for m in (1, 7, 40, 89, 90))
    assert secrets.common_words(docs, most=1) == ["butterfly"] and secrets.common_words(docs.where("false")) == []


def test_guesses_find_secrets_and_leave_prose(spark):
    """Precision on values that are words of the documents, and recall on random ones."""
    import random
    import string

    rng = random.Random(11)
    prose = ["".join(rng.choice("aeiou" if k % 2 else "bcdfghklmnprst") for k in range(rng.randint(6, 14))) for _ in range(400)]
    plain = [f"the {rng.choice(('password', 'token', 'secret', 'auth'))}: {rng.choice(prose)} of {rng.choice(prose)} and {rng.choice(prose)}" for _ in range(400)]
    plain += [f"secret = {w}_{x}" for w, x in zip(prose[:100], prose[100:200], strict=True)]
    hidden = [f"api_key = {''.join(rng.choice(string.ascii_letters + string.digits) for _ in range(rng.randint(10, 40)))}" for _ in range(200)]
    rows = [(i, t) for i, t in enumerate([*plain, *hidden, *(" ".join(prose) for _ in range(3))])]
    found = {r["doc_id"]: [s for s in r["spans"] if s["kind"] == "guess"] for r in secrets.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    hit = [i for i, x in found.items() if x]
    planted = range(len(plain), len(plain) + len(hidden))
    assert sum(i in planted for i in hit) == len(hidden)
    assert len(hit) <= 1.2 * len(hidden)
