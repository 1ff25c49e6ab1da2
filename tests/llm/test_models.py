"""The language models: proper distributions, exact base scores, held-out gains, thresholds."""

import math
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import language_model, quality
from tessera.llm.common import written
from tests.llm.brute import lower, split_words

WHITE = " \t\n\x0b\x0c\r"


def kneser_ney(texts):
    """Interpolated modified Kneser-Ney by dictionaries: probability of c after (a, b)."""
    rows = [["<s>", "<s>", *t.split(), "</s>"] for t in texts]
    tri = Counter(tuple(r[i : i + 3]) for r in rows for i in range(len(r) - 2))
    bi = Counter()
    for (a, b, c), n in tri.items():
        bi[b, c] += n if b == "<s>" else 1
    uni = Counter(c for _, c in bi)
    vocabulary = {w for r in rows for w in r[2:]}

    def discounts(counts):
        n = [sum(c == k for c in counts) for k in range(5)]
        if not all(n[1:]):
            return [0.0, 0.5, 0.75, 0.9]
        y = n[1] / (n[1] + 2 * n[2])
        return [0.0, *(min(max(d, 0.05), k - 0.01) for k, d in ((1, 1 - 2 * y * n[2] / n[1]), (2, 2 - 3 * y * n[3] / n[2]), (3, 3 - 4 * y * n[4] / n[3])))]

    d3, d2, d1 = (discounts(list(x.values())) for x in (tri, bi, uni))

    def p1(c):
        total = sum(uni.values())
        left = sum(d1[min(n, 3)] for n in uni.values()) / total
        return (uni[c] - d1[min(uni[c], 3)]) / total + left / (len(vocabulary) + 1)

    def p2(b, c):
        seen = {k: n for k, n in bi.items() if k[0] == b}
        if not seen:
            return p1(c)
        total = sum(seen.values())
        left = sum(d2[min(n, 3)] for n in seen.values()) / total
        n = seen.get((b, c), 0)
        return (n - d2[min(n, 3)]) / total + left * p1(c)

    def p3(a, b, c):
        seen = {k: n for k, n in tri.items() if k[:2] == (a, b)}
        if not seen:
            return p2(b, c)
        total = sum(seen.values())
        left = sum(d3[min(n, 3)] for n in seen.values()) / total
        n = seen.get((a, b, c), 0)
        return (n - d3[min(n, 3)]) / total + left * p2(b, c)

    return p3, vocabulary


def corpus(n, seed=1, size=14):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(size)]
    return [" ".join(words[min(int(rng.expovariate(0.4)), size - 1)] for _ in range(rng.randint(0, 12))) for _ in range(n)]


@pytest.mark.parametrize("n", [1, 3, 60])
def test_kneser_ney_against_dictionaries(n):
    train = corpus(n)
    p3, vocabulary = kneser_ney(train)
    model = quality.Model.fit([t.encode() for t in train])
    tests = corpus(25, 9, 17) + ["", "unknown words only"]
    counts, logs = model.score([t.encode() for t in tests])
    for t, k, got in zip(tests, counts, logs, strict=True):
        r = ["<s>", "<s>", *t.split(), "</s>"]
        want = sum(math.log10(p3(*r[i : i + 3])) for i in range(len(r) - 2))
        assert k == len(r) - 2 and got == pytest.approx(want, rel=1e-4)
    for a, b in (("<s>", "<s>"), ("w0", "w1"), ("zzz", "w0"), ("zzz", "zzz")):
        assert sum(p3(a, b, c) for c in [*vocabulary, "unknown"]) == pytest.approx(1)


def test_model_without_text():
    n, p = quality.Model.fit([]).score([b"a b", b""])
    assert n.tolist() == [3, 1] and np.isfinite(p).all()


def test_scoring_holds_few_bytes_a_token():
    rng = random.Random(5)
    texts = [" ".join(f"w{int(rng.paretovariate(0.5)) % 5000}" for _ in range(rng.randint(1, 2000))).encode() for _ in range(300)]
    model = quality.Model.fit(texts[::3], 64)
    one = [model.score([t]) for t in texts]
    tracemalloc.start()
    n, p = model.score(iter(texts))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n.tolist() == [x.item() for x, _ in one] and p == pytest.approx([x.item() for _, x in one], rel=1e-12)
    assert peak < 40 * n.sum()


def good_and_bad(spark):
    rng = random.Random(2)
    words = [f"word{i}" for i in range(60)]
    docs, labels = [], []
    for i in range(600):
        bad = i % 10 == 0
        t = " ".join(rng.choice(words) + ("$$$" if bad else "") for _ in range(rng.randint(30, 80)))
        docs.append((i, t, ("en", "de", None)[i % 3], "s", len(t)))
        if i % 2 == 0:
            labels.append((i, 0 if bad else 1, 0))
    labels += [(None, 1, 0), (3, None, None), (0, 0, 1), (2, 1, 0)]
    return spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_quality_rejects_junk_and_keeps_clean(spark):
    docs, labels = good_and_bad(spark)
    got = {r["doc_id"]: r for r in quality.classify(docs, labels).collect()}
    assert len(got) == 600
    assert all(not got[i]["kept"] for i in range(0, 600, 10))
    assert sum(got[i]["kept"] for i in range(600) if i % 10) >= 0.99 * 540
    kept = quality.keep_good(docs, labels)
    assert kept.schema == docs.schema and {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["kept"]}


@pytest.mark.parametrize("many", [0, quality.MANY])
def test_kept_by_brute_force(spark, monkeypatch, many):
    """The model of the sample's texts in one process (held against dictionaries above), quantiles by sorting."""
    monkeypatch.setattr(quality, "MANY", many)
    docs, labels = good_and_bad(spark)
    rows = {r["doc_id"]: (r["text"], r["lang"] or "") for r in docs.collect()}
    half = {r["doc_id"]: r["h"] for r in quality.trusted_ids(labels).withColumn("_t_id", F.col("doc_id")).select("doc_id", quality._half().alias("h")).collect()}
    model = quality.Model.fit([rows[i][0].encode() for i, h in half.items() if h == 0], shards=3)
    n, p = model.score([t.encode() for t, _ in rows.values()])
    score = dict(zip(rows, -p / n, strict=True))
    by = defaultdict(list)
    for i, h in half.items():
        if h:
            by[rows[i][1]].append(score[i])
            by[None].append(score[i])
    limit = {k: sorted(v)[math.ceil(0.9 * len(v)) - 1] for k, v in by.items() if k is None or len(v) >= quality.FEW}
    got = quality.classify(docs, labels, high=0.9).collect()
    for r in got:
        most = limit.get(r["lang"], limit[None])
        assert math.log10(r["perplexity"]) == pytest.approx(score[r["doc_id"]], rel=1e-6) and math.log10(r["threshold"]) == pytest.approx(most, rel=1e-6)
        assert r["kept"] == (score[r["doc_id"]] <= most + 1e-12) or abs(score[r["doc_id"]] - most) < 1e-9


def test_quality_sample_is_bounded_and_whole(spark):
    docs = spark.createDataFrame([(i, "w " * (10 + i)) for i in range(200)] + [(3, "again")] * 300, "doc_id bigint, text string")
    ids = spark.createDataFrame([(i,) for i in range(200)], "doc_id bigint")
    got = [bytes(r[0]) for r in quality.trusted_sample(docs, ids, max_documents=20).collect()]
    assert len(got) == 20 and all(t == b"again" or t == b"w " * (len(t) // 2) for t in got)


def test_quality_model_is_of_all_trusted_text(spark, monkeypatch):
    """Over 4000 trusted documents of the model's half and one of over 20,000 characters, in more shards than the least."""
    monkeypatch.setattr(quality, "SHARD_BYTES", 5000)
    monkeypatch.setattr(quality, "CHUNK_BYTES", 30_000)
    texts = {i: f"w{i % 50} u{i} w{i % 7}" for i in range(9000)} | {9000 + i: f"long{i} text " * 2500 for i in range(8)}
    docs = spark.createDataFrame([(i, t, "en") for i, t in texts.items()], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in texts], "doc_id bigint, quality int, toxic int")
    half = {r["doc_id"] for r in labels.withColumn("_t_id", F.col("doc_id")).where(quality._half() == 0).collect()}
    assert len(half) > 4000 and any(i >= 9000 for i in half)
    n, p = quality.Model.fit([texts[i].encode() for i in half]).score([t.encode() for t in texts.values()])
    want = dict(zip(texts, -p / n, strict=True))
    for r in quality.classify(docs, labels).collect():
        assert math.log10(r["perplexity"]) == pytest.approx(want[r["doc_id"]], rel=1e-6)


def test_quality_awkward(spark, awkward, nothing):
    _, labels = good_and_bad(spark)
    assert quality.classify(awkward, labels).count() == 12
    kept = quality.keep_good(awkward, labels.where("false"))
    assert kept.count() == 12 and kept.schema.names == awkward.schema.names
    assert quality.classify(awkward, labels.where("false")).where("kept").count() == 12
    assert quality.classify(nothing, labels).count() == 0 and quality.keep_good(nothing, labels).count() == 0


def is_held_out(i):
    return zlib.crc32(str(i).encode()) % 7 == 2 if i is not None else False


def check_base(rows, got):
    counts = Counter()
    for i, t in rows:
        if not is_held_out(i):
            counts.update([*split_words(lower(t or ""), WHITE), "\n"])
    n, v = sum(counts.values()), len(counts)
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    for i, t in rows:
        words = [*split_words(lower(t or ""), WHITE), "\n"]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        want = (is_held_out(i), len(words), sum(counts[w] > 0 for w in words), n)
        assert any((r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == want and math.isclose(r["base_score"], base, rel_tol=1e-9, abs_tol=1e-9) for r in by[i])


def bilingual(n=500):
    rng = random.Random(4)
    sides = [[f"a{i}" for i in range(80)], [f"b{i}" for i in range(80)]]
    return [(i, " ".join(rng.choice(sides[i % 2]) if rng.random() < 0.9 else f"Rare{rng.randrange(2000)}" for _ in range(rng.randint(5, 60)))) for i in range(n)]


@pytest.mark.parametrize("frequent", [40, language_model.FREQUENT])
def test_language_model_base_and_gain(spark, frequent):
    rows = bilingual()
    got = language_model.score(spark.createDataFrame(rows, "doc_id bigint, text string"), frequent=frequent).collect()
    check_base(rows, got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) * (0.97 if frequent > 100 else 1.05)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def fitted(spark, rows, frequent=50, classes=4, buckets=512):
    df = spark.createDataFrame([(i, False, 0, t.encode()) for i, t in rows], "doc_id bigint, held_out boolean, part bigint, text binary")
    kinds = language_model.word_counts(df.select("text"))
    v = language_model.vocabulary(kinds, kinds.groupBy("word").agg(F.sum("n").alias("n")), frequent, classes)
    return v, *language_model.train(written(language_model.numbered(df, language_model._send(spark, "vocabulary", v)), "numbered"), v, buckets, 1)


def test_language_model_is_a_distribution(spark):
    rows = bilingual(200)
    v, w, nodes = fitted(spark, rows)
    assert np.abs(w).sum() > 0 and np.abs(nodes).sum() > 0 and len(v.trees.bias) > 20
    rare = -1 - 77
    for history in ([], [3], [5, 1], [rare, 7, 2], [9, 9, 9, rare]):
        texts = [np.array([language_model._START] * 3 + history + [x, language_model._START], np.int32) for x in [*range(v.rare), rare]]
        texts.append(np.array([language_model._START] * 3 + history + [language_model._START], np.int32))
        found = [language_model.log_probabilities([t], v, w, nodes) for t in texts]
        end = v.words[language_model.END]
        said = [math.exp(x[len(history)]) for k, x in enumerate(found) if k != end]
        assert sum(said) == pytest.approx(1, rel=1e-4)
    left = sum((n + 1) / (v.rare_tokens + v.rare_distinct + 1) for n in rare_counts(rows, v)) + 1 / (v.rare_tokens + v.rare_distinct + 1)
    assert left == pytest.approx(1)


def slow_log10(text, v, w, nodes, counts):
    """The model's log10 probability of a text, word by word."""
    said = [*split_words(lower(text), WHITE), "\n"]
    code = language_model._Numbers(v.words)
    ids = [language_model._START] * 3 + [code[x.encode()] for x in said[:-1]]
    total = 0.0
    for k, word in enumerate(said):
        row = np.array([*ids[k : k + 3], language_model._START], np.int32)
        context = language_model._contexts([row])
        z = [float(w[y, 0] + sum(w[y, f] for f in language_model._features(context, w.shape[1])[:, 0])) for y in range(v.wide)]
        least = sum(map(math.exp, z))
        i = ids[k + 3] if k + 3 < len(ids) else None
        y = v.wide - 1 if i is None else v.classes[max(i, -1) if i >= 0 else v.rare]
        total += math.log10(math.exp(z[y]) / least)
        if i is not None and i < 0:
            total += math.log10((counts[word] + 1) / (v.rare_tokens + v.rare_distinct + 1))
        elif i is not None:
            t = v.trees
            for place in range(t.at[i], t.at[i] + t.long[i]):
                odds = float(t.bias[place]) + sum(float(nodes[x[0]]) for x in language_model._node_features(context, np.zeros(1, int), t.salt[place : place + 1], len(nodes)))
                total -= math.log10(1 + math.exp(-odds if t.right[place] else odds))
    return total


def test_score_by_brute_force(spark, monkeypatch):
    rows = bilingual(150) + [(1000, ""), (1001, None), (1002, "never seen words")]
    kept = {}
    for name in ("vocabulary", "train"):
        monkeypatch.setattr(language_model, name, lambda *a, f=getattr(language_model, name), name=name, **k: kept.setdefault(name, f(*a, **k)))
    got = {r["doc_id"]: r["score"] for r in language_model.score(spark.createDataFrame(rows, "doc_id bigint, text string"), frequent=60, buckets=256).collect()}
    v, (w, nodes) = kept["vocabulary"], kept["train"]
    counts = Counter(x for i, t in rows if not is_held_out(i) for x in [*split_words(lower(t or ""), WHITE), "\n"])
    for i, t in rows[::5] + rows[-3:]:
        assert got[i] == pytest.approx(slow_log10(t or "", v, w, nodes, counts), rel=1e-4)


def test_words_of_a_class_follow_their_history(spark):
    """One class alone: what tells words apart is the model within it."""
    rng = random.Random(7)
    rows = []
    for i in range(600):
        ws = [rng.randrange(20)]
        for _ in range(40):
            ws.append((ws[-1] * 7 + 3) % 20 if rng.random() < 0.9 else rng.randrange(20))
        rows.append((i, " ".join(f"w{x}" for x in ws)))
    v, w, nodes = fitted(spark, rows, classes=1)
    text = language_model._padded(np.array([v.words[x.encode()] for x in rows[0][1].split()], np.int32).tobytes())
    with_history = language_model.log_probabilities([text], v, w, nodes)[1:-1].mean()
    without = language_model.log_probabilities([text], v, w, np.zeros_like(nodes))[1:-1].mean()
    assert with_history > without + 1


ODD_TEXTS = [b"", b" \t\n", b"One two ONE", b"  b a\x0bb\x0ca\r", b"\xff\xfe x\x00y X\x00Y", "\u00c4 \u00e4 \u65e5\u672c\u00a0z\x1cq \u2003".encode(), b"x"]


def test_words_are_split_whole_batches_at_a_time():
    for texts, skip in ((ODD_TEXTS, 0), (ODD_TEXTS[:2], 0), ([], 0), (ODD_TEXTS, 3)):
        many, distinct, codes = language_model.split(pa.array(texts, pa.binary()).slice(skip))
        texts = texts[skip:]
        want = [t.lower().split() for t in texts]  # of bytes both know ASCII alone
        assert many.tolist() == [len(w) for w in want]
        assert [distinct[k].as_py() for k in codes] == [x for w in want for x in w] and len(set(distinct.to_pylist())) == len(distinct)


def test_parts_of_batches_hold_every_row(monkeypatch):
    monkeypatch.setattr(language_model, "PART_BYTES", 8)
    for sizes in ([], [0], [0, 0, 3, 30, 0, 5, 2, 1, 8, 100], [1] * 20):
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(sizes)), pa.int64()), pa.array([b"x" * n for n in sizes], pa.binary())], names=["a", "b"])
        parts = list(language_model._parts(batch, 1))
        assert [x for p in parts for x in p.column(0).to_pylist()] == list(range(len(sizes)))
        assert all(len(p) == 1 or sum(len(x) for x in p.column(1).to_pylist()[1:]) < 8 for p in parts if len(p))


def test_word_counts_by_the_first_of_the_most_common_words(spark):
    rng = random.Random(3)
    texts = [*ODD_TEXTS, *(" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))).encode() for _ in range(300))]
    want = Counter()
    for t in texts:
        ws = t.lower().split()
        kind = zlib.crc32(Counter(ws).most_common(1)[0][0]) % language_model.KINDS if ws else 0
        want.update((w, kind) for w in [*ws, b"\n"])
    got = language_model.word_counts(spark.createDataFrame([(t,) for t in texts], "text binary")).collect()
    assert len(got) == len(want) and {(bytes(r["word"]), r["kind"]): r["n"] for r in got} == want


def peak_mb(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_steps_and_scores_work_in_pieces_that_a_cache_holds():
    rng, many, words, wide, buckets = np.random.default_rng(5), 1 << 16, 4000, 26, 1 << 12
    contexts = rng.integers(0, 1 << 32, (4, many), np.uint32)
    ids, y = rng.integers(0, words, many).astype(np.int32), rng.integers(0, wide, many)
    trees = language_model.Trees.of(np.arange(1.0, words + 1), np.zeros(words, np.int64))
    nodes, node_sums = np.zeros(1 << 14, np.float32), np.ones(1 << 14, np.float32)
    assert peak_mb(lambda: language_model.node_steps(nodes, node_sums, trees, contexts, ids)) < 10
    weights, sums = (np.full((wide, buckets), x, np.float32, order="F") for x in (0, 1))
    features = language_model._features(contexts, buckets)
    assert peak_mb(lambda: language_model.gradient_steps(weights, sums, features, y)) < 8
    assert np.abs(weights).sum() > 0 and np.abs(nodes).sum() > 0


@pytest.mark.parametrize("wide", [2, 3, 7])
def test_gradient_steps_by_brute_force(wide):
    rng, many, buckets = np.random.default_rng(wide), language_model.PIECE + 500, 40
    features, y = rng.integers(1, buckets, (4, many)), rng.integers(0, wide, many)
    weights = np.asfortranarray(rng.normal(size=(wide, buckets)).astype(np.float32))
    sums = np.ones_like(weights)
    z = np.array([weights[:, f].sum(1) for f in features.T], np.float64) + weights[:, 0]
    p = np.exp(z) / np.exp(z).sum(1, keepdims=True) - np.eye(wide)[y]
    total = np.zeros((wide, buckets))
    for f, g in zip(features.T, p, strict=True):
        np.add.at(total.T, f, g)
        total[:, 0] += g
    want = weights - 0.3 * total / np.sqrt(1 + total**2 + 1e-6)
    language_model.gradient_steps(weights, sums, features, y, 0.3)
    assert np.allclose(weights, want, atol=1e-4) and np.allclose(sums, 1 + total**2, rtol=1e-3)


def rare_counts(rows, v):
    counts = Counter(w for _, t in rows for w in [*lower(t).split(), "\n"])
    return [n for w, n in counts.items() if w.encode() not in v.words]


def test_language_model_awkward(spark, awkward, nothing):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    got = language_model.score(awkward).collect()
    assert len(got) == 12
    check_base(rows, got)
    assert language_model.score(nothing).count() == 0
    alone = language_model.score(spark.createDataFrame([(i, "a b") for i in range(40) if is_held_out(i)], "doc_id bigint, text string")).collect()
    assert all(r["train_tokens"] == 0 and math.isfinite(r["score"]) for r in alone)
