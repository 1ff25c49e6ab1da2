"""Exact, near and substring dedup against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
import xxhash

from tessera.llm import components, exact_dedup, simhash, substring_dedup
from tests.llm.brute import groups_of, lower


def documents(spark, n=120, seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(n):
        kind = rng.random()
        if texts and kind < 0.25:
            texts.append(rng.choice(texts))
        elif texts and kind < 0.6:
            w = rng.choice(texts).split()
            for _ in range(rng.randint(1, 3)):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(words)
            texts.append(" ".join(w))
        else:
            texts.append(" ".join(rng.choice(words) + ("." if rng.random() < 0.15 else "") for _ in range(rng.randint(0, 120))))
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("most", [0, exact_dedup.MAX_BROADCAST_WORDS])
def test_exact_groups_brute_force(spark, most):
    rows = documents(spark)
    got = {r["doc_id"]: r for r in exact_dedup.exact_groups(spark.createDataFrame(rows, "doc_id bigint, text string"), max_broadcast_words=most).collect()}
    of = defaultdict(list)
    for i, t in rows:
        of[t].append(i)
    for i, t in rows:
        r = got[i]
        assert (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) == (max(of[t]), len(of[t]), i == max(of[t]), hashlib.sha256(t.encode()).hexdigest())


def test_filter_clears_most_single_texts(spark):
    df = spark.createDataFrame([(i, f"text {i}") for i in range(3000)] + [(9000, "text 7")], "doc_id bigint, text string")
    for most in (0, exact_dedup.MAX_BROADCAST_WORDS):
        flagged, rows = exact_dedup.hashes(df, max_broadcast_words=most)
        assert rows == 3001 and flagged.where("_t_maybe").count() < 60
        assert flagged.where("_t_maybe and doc_id in (7, 9000)").count() == 2
        assert "text" not in flagged.columns  # what later steps shuffle has no texts


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_drop_exact_keeps_one_row_of_each_text(spark, most):
    rows = [(i % 50, f"text {i % 70}", i) for i in range(700)] + [(None, "text 3", -1), (None, None, -2), (None, "", -3), (7, "", -4), (7, None, -5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, other int")
    got = exact_dedup.drop_exact(df, max_broadcast_words=most, max_broadcast_rows=most).collect()
    best = {}
    for i, t, _ in rows:
        best[t or ""] = max(best.get(t or "", -1), -1 if i is None else i)
    assert sorted((r["text"] or "", -1 if r["doc_id"] is None else r["doc_id"]) for r in got) == sorted(best.items())
    assert all((r["doc_id"], r["text"], r["other"]) in rows for r in got)


def test_exact_awkward(awkward, nothing):
    got = exact_dedup.exact_groups(awkward).collect()
    assert len(got) == 12
    empty = [r for r in got if r["text_sha256"] == hashlib.sha256(b"").hexdigest()]
    assert {r["group_size"] for r in empty} == {3} and {r["keep_id"] for r in empty} == {4}
    assert sorted(r["kept"] for r in got if r["doc_id"] == 2) == [True, True]
    kept = exact_dedup.drop_exact(awkward)
    assert kept.schema.names == awkward.schema.names
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 2, 4, 6, 7, 8, 9]
    assert exact_dedup.exact_groups(nothing).count() == 0 and exact_dedup.drop_exact(nothing).count() == 0


def slow_fingerprint(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words, word = [], ""
    for c in low + " ":
        if c == " " or "\t" <= c <= "\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_against_loops():
    for t in ("", " ", "A b", "x y z", "Über straße naïve Éa éa", "a b c d e f g " * 50, "one\ttwo\x0bthree\x1cfour five six"):
        assert simhash.fingerprint(t.encode())[0] & (2**64 - 1) == slow_fingerprint(t, 3)


def test_near_duplicates_brute_force(spark):
    rows = documents(spark, 160, 3)
    prints = {i: slow_fingerprint(t, 3) for i, t in rows}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    expected = groups_of(prints, links)
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == expected
    assert all(r["f0"] & (2**64 - 1) == prints[r["doc_id"]] for r in got)


def test_every_pair_within_two_bits_is_linked(spark):
    rng = random.Random(9)
    base = rng.getrandbits(64)
    codes = {base} | {base ^ 1 << a for a in range(64)} | {base ^ 1 << a ^ 1 << b for a in range(0, 64, 3) for b in range(a)}
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    nodes = spark.createDataFrame([(c, c) for c in signed], "node bigint, f0 bigint")
    want = {tuple(sorted((a, b))) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    assert {tuple(sorted((r["u"], r["v"]))) for r in simhash.links(nodes).collect()} == want


def test_components_brute_force(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(500, x) for x in range(501, 560)]
    got = {r["node"]: r["comp"] for r in components.components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    nodes = {x for p in links if p[0] != p[1] for x in p}
    assert got == {k: v for k, v in groups_of(nodes, links).items() if k in nodes}
    assert components.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_near_awkward(awkward, nothing):
    got = simhash.near_duplicates(awkward).collect()
    assert len(got) == 12
    assert {r["component_id"] for r in got if r["f0"] == 0} == {3}
    assert {r["component_id"] for r in got if r["doc_id"] in (1, 2)} == {1}
    kept = simhash.drop_near(awkward, **simhash.FIVE_WORDS)
    assert kept.schema.names == awkward.schema.names
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 1, 3, 5, 8, 9]
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.drop_near(nothing, **simhash.FIVE_WORDS).count() == 0


def test_five_words_links_close_texts_and_leaves_others(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(3000)]
    rows, close = [], []
    for g in range(25):
        w = [rng.choice(words) for _ in range(300)]
        v = list(w)
        v[rng.randrange(300)] = "changed"
        u = [x if rng.random() > 0.12 else rng.choice(words) for x in w]
        rows += [(3 * g, " ".join(w)), (3 * g + 1, " ".join(v)), (3 * g + 2, " ".join(u))]
        close.append((3 * g, 3 * g + 1))
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), **simhash.FIVE_WORDS).collect()}
    assert all(got[a] == got[b] for a, b in close)
    assert all(got[3 * g + 2] == 3 * g + 2 for g in range(25))


def five_word_jaccard(a, b):
    one, two = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (a.split(), b.split()))
    return len(one & two) / len(one | two)


def test_five_words_finds_block_edits(spark):
    rng = random.Random(12)
    run = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    rows = []
    for g in range(60):
        w, share = run(400), 0.805 + 0.09 * g / 60
        if g % 2:
            other = w + run(round(400 / share) - 400)
        else:
            k = round(400 * (1 - share) / (1 + share)) - 4
            other = w[:100] + run(k) + w[100 + k :]
        rows += [(2 * g, " ".join(w)), (2 * g + 1, " ".join(other))]
    rows += [(200, " ".join(x := run(400))), (201, " ".join(x + run(125)))]
    assert all(0.8 <= five_word_jaccard(rows[2 * g][1], rows[2 * g + 1][1]) < 0.92 for g in range(60))
    assert five_word_jaccard(rows[-2][1], rows[-1][1]) < 0.8
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), **simhash.FIVE_WORDS).collect()}
    assert all(got[2 * g] == got[2 * g + 1] == 2 * g for g in range(60))
    assert got[201] == 201


def test_five_words_on_the_documents(spark):
    """All pairs of 0.8 and more, found by an index of shingles, connect the same documents: none missed, none added."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    sets = {}
    for r in docs.collect():
        ws = lower(r["text"] or "").split()
        sets[r["doc_id"]] = {" ".join(ws[k : k + 5]) for k in range(max(1, len(ws) - 4))} if ws else set()
    held = defaultdict(list)
    for i, x in sets.items():
        for said in x:
            held[said].append(i)
    shared = defaultdict(int)
    for ids in held.values():
        for a, i in enumerate(ids):
            for j in ids[a + 1 :]:
                shared[i, j] += 1
    near = [(i, j) for (i, j), n in shared.items() if n >= 0.8 * (len(sets[i]) + len(sets[j]) - n)]
    empty = [i for i, x in sets.items() if not x]
    want = groups_of(sets, near + [(empty[0], i) for i in empty[1:]])
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs, **simhash.FIVE_WORDS).collect()}
    assert len(near) > 100
    found = sum(got[i] == got[j] for i, j in near)
    assert found >= 0.99 * len(near)
    # precision: who is together without need
    assert all(want[i] == want[got[i]] for i in got)


def test_five_words_counts_a_repeated_line_once(spark):
    rng = random.Random(13)
    run = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    line, rows = run(10), []
    for g in range(12):
        w = run(400)
        rows += [(4 * g, " ".join(w)), (4 * g + 1, " ".join(w + w[-10:] * (10 + g))), (4 * g + 2, " ".join(run(200) + line * (20 + g))), (4 * g + 3, " ".join(run(200) + line * (20 + g)))]
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), **simhash.FIVE_WORDS).collect()}
    assert all(got[4 * g] == got[4 * g + 1] == 4 * g for g in range(12))
    assert all(got[i] == i for i in got if i % 4 > 1)


def slow_units(text, long=16):
    """Sentences of a text in ASCII, character by character: what isn't an end, then ends, then blanks; long ones cut at words."""
    out, at, ends, blank = [], 0, ".!?\n", " \t\n\r\x0b\x0c"
    while at < len(text):
        i = at
        for kind in (lambda c: c not in ends, lambda c: c in ends, lambda c: c in blank):
            while i < len(text) and kind(text[i]):
                i += 1
        unit, at = text[at:i], i
        words = re.findall(r"\S+\s*", unit)
        lead = unit[: len(unit) - len("".join(words))]
        if len(unit) <= 2 * long or len(words) <= long:
            out.append(unit)
            continue
        held = lead
        n = 0
        for w in words:
            held += w
            n += 1
            if n == 2 * long or xxhash.xxh32_intdigest(w.strip().lower().encode()) % 8 == 0:
                out.append(held)
                held, n = "", 0
        if held:
            out.append(held)
    return out


def slow_spans(units, sentences=2, words=20):
    """Of every start the shortest span of enough sentences and words, and of every end; (first, past, what it says)."""
    said = [u.lower().split() for u in units]
    many = lambda i, j: sum(map(len, said[i:j]))
    found = {}
    for i in range(len(units)):
        for j in range(i + sentences, len(units) + 1):
            if said[i] and many(i, j) >= words:
                found.setdefault((many(0, i), many(0, j)), (i, j))
                break
    for j in range(len(units) + 1):
        for i in range(j - sentences, -1, -1):
            if said[j - 1] and many(i, j) >= words:
                found.setdefault((many(0, i), many(0, j)), (i, j))
                break
    return [(i, j, " ".join(w for s in said[i:j] for w in s)) for _, (i, j) in sorted(found.items())]


def slow_removal(rows):
    """The definition, document by document: what each span's smallest document is, then what is covered."""
    least, cut = {}, {}
    for i, t in rows:
        units = slow_units(t)
        cut[i] = units, slow_spans(units)
        for _, _, said in cut[i][1]:
            least[said] = min(least.get(said, i), i)
    out = {}
    for i, _ in rows:
        units, found = cut[i]
        gone, seen = set(), set()
        for a, b, said in found:
            if said in seen or least[said] != i:
                gone |= set(range(a, b))
            seen.add(said)
        out[i] = "".join(u for k, u in enumerate(units) if k not in gone)
    return out


def test_substring_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    sentence = lambda: " ".join(rng.choice("abcdefghij") * rng.randint(1, 6) for _ in range(rng.randint(2, 12))) + rng.choice([". ", "! ", "\n"])
    passage = "".join(sentence() for _ in range(9))
    rows = []
    for i in range(40):
        t = "".join(sentence() for _ in range(rng.randint(0, 12)))
        rows.append((i, t + (passage if i % 4 == 0 else "") + "".join(sentence() for _ in range(3))))
    got = {r["doc_id"]: r["text"] for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == slow_removal(rows)
    long = [(i, " ".join(f"w{rng.randrange(40)}" for _ in range(90)) + rng.choice(["", ". x", "\n\n . "])) for i in range(6)]
    long += [(9, long[0][1] + " " + long[1][1]), (10, "  lead. " + long[2][1]), (11, "")]
    got = {r["doc_id"]: r["text"] for r in substring_dedup.remove_repeats(spark.createDataFrame(long, "doc_id bigint, text string")).collect()}
    assert got == slow_removal(long)
    got = {r["doc_id"]: r["text"] for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    monkeypatch.setattr(substring_dedup, "FEW", 0)
    assert got == {r["doc_id"]: r["text"] for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert passage[40:-40] in got[0] and all(passage[40:-40] not in got[i] for i in range(4, 40, 4))


def test_repeats_within_a_text_come_from_the_span_table(spark):
    """The last pass only cuts sentences: what a text says again is found when its spans are hashed, once."""
    rng = random.Random(15)
    sentence = lambda: " ".join(f"t{rng.randrange(9000)}" for _ in range(rng.randint(6, 14))) + rng.choice([". ", "! ... ", "\n\n . "])
    rows = []
    for i in range(30):
        own, chorus = [sentence() for _ in range(8)], "".join(sentence() for _ in range(5))
        rows.append((i, "".join(x + (chorus if rng.random() < i / 20 else "") for x in own)))
    rows += [(40, "one line of ten words that comes again and again. " * 12), (41, " . . ")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    again = defaultdict(set)
    for r in substring_dedup.span_table(docs).where("again").collect():
        again[r["doc"]] |= set(range(r["first"], r["past"]))
    for i, t in rows:
        want, seen = set(), set()
        for a, b, said in slow_spans(slow_units(t)):
            if said in seen:
                want |= set(range(a, b))
            seen.add(said)
        assert again[i] == want
    assert any(again.values()) and not all(again[i] for i, _ in rows)
    assert {r["doc_id"]: r["text"] for r in substring_dedup.remove_repeats(docs).collect()} == slow_removal(rows)


def test_last_sentences_of_a_repeat_are_removed(spark):
    rng = random.Random(14)
    sentence = lambda n: " ".join(f"t{rng.randrange(9000)}" for _ in range(n)) + ". "
    rows = []
    for g in range(20):
        passage = "".join(sentence(rng.randint(5, 14)) for _ in range(6)) + sentence(3) + "... "
        own = "".join(sentence(12) for _ in range(3))
        rows += [(3 * g, passage), (3 * g + 1, passage), (3 * g + 2, passage + own)]
    got = {r["doc_id"]: r["text"] for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert all(got[3 * g] == rows[3 * g][1] for g in range(20))
    assert all(got[3 * g + 1].strip(" .") == "" for g in range(20))
    assert all(got[3 * g + 2].strip(" .") == rows[3 * g + 2][1][len(rows[3 * g][1]) :].strip(" .") for g in range(20))


def test_long_sentences_without_stops(spark):
    rng = random.Random(6)
    run = lambda n: " ".join(f"t{rng.randrange(500)}" for _ in range(n))
    shared = run(120)
    rows = [(i, f"{run(17 + i)} {shared} {run(23)}") for i in range(4)] + [(9, run(200))]
    got = {r["doc_id"]: r for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[0]["n_removed"] == 0 and got[9]["n_removed"] == 0
    assert all(got[i]["n_removed"] >= 6 and len(got[i]["text"].split()) < 90 for i in (1, 2, 3))


def test_scripts_without_blanks(spark):
    rng = random.Random(8)
    said = lambda n: "".join(chr(rng.randrange(0x4E00, 0x9F00)) for _ in range(n))
    thai = "".join(chr(rng.randrange(0x0E01, 0x0E2E)) for _ in range(160))
    passage = "".join(said(rng.randint(8, 20)) + rng.choice("。！？") for _ in range(6))
    rows = [(i, said(30) + "。" + passage + said(25) + "。own words here.") for i in range(3)] + [(9, "plain text. " + thai + " end."), (10, "other start. " + thai + " stop.")]
    got = {r["doc_id"]: r["text"] for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[0] == rows[0][1] and passage not in got[1] + got[2] and all(rows[i][1][:31] == got[i][:31] for i in (1, 2))
    assert got[9] == rows[3][1] and thai[40:120] not in got[10]


def test_plain_and_other_ways_cut_alike(monkeypatch):
    rng = random.Random(9)
    texts = ["".join(rng.choice(["word ", "Other ", "é. ", "x! ", "\n", "longer_word ", ".. "]) for _ in range(120)) for _ in range(30)] + ["w " * 200]
    plain = [substring_dedup.spans(t.encode()) for t in texts]
    monkeypatch.setattr(substring_dedup, "_OTHER", re.compile(b""))
    assert plain == [substring_dedup.spans(t.encode()) for t in texts]


def test_sentences_cover_the_text():
    for t in (". 。字" * 30, "สวัสดี" * 20, "", "a", ". . a.b!c\n\nd ", "é" * 50 + ". x", "w " * 200):
        units = substring_dedup.sentences(t.encode())
        assert b"".join(t.encode()[a:b] for a, b in units) == t.encode()


def test_substring_awkward(awkward, nothing):
    got = substring_dedup.remove_repeats(awkward).collect()
    assert len(got) == 12
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by[3]["text"] == "" and by[4]["text"] == "" and by[2]["n_removed"] == 0
    assert by[6]["text"] == "" and 0 < len(by[5]["text"]) < 300
    assert substring_dedup.remove_repeats(nothing).count() == 0
