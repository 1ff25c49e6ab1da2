"""Golden vectors of the operators."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import numbers
from tessera.operators import annotate, asof, dedup, frames, intervals, privacy, quality, review, robust, scene, sequence, timeline, validate


def stream(spark, ts, **more):
    rows = [("s", i, t, *(v[i] for v in more.values())) for i, t in enumerate(ts)]
    kinds = {name: "string" if isinstance(v[0], str) else "boolean" if isinstance(v[0], bool) else "double" for name, v in more.items()}
    return spark.createDataFrame(rows, "k string, i bigint, t bigint" + "".join(f", {n} {k}" for n, k in kinds.items()))


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.mark.parametrize("slice_rows", [None, 1, 2, 4])
def test_continuity_golden_vector(spark, slice_rows):
    out = timeline.continuity(stream(spark, [100, 110, 110, 90, 100, 1000]), ["k"], "i", "t", 100, 10.0, slice_rows)
    got = out.orderBy("i").collect()
    assert [r["continuity_group"] for r in got] == [0, 0, 1, 2, 2, 3]
    assert [r["continuity_start_reason"] for r in got] == ["stream_start", "", "timestamp_duplicate", "timestamp_rollback", "", "timestamp_gap"]
    assert [r["delta_ns"] for r in got] == [0, 10, 0, -20, 10, 900]


def test_clock_fixtures(spark):
    report = lambda ts: timeline.clock_report(stream(spark, ts), ["k"], "i", "t", 3.0, 5_000_000).first()
    assert report([0, 5_000_000, 5_000_000, 10_000_000])["duplicate_count"] == 1
    assert report([0, 10_000_000, 5_000_000, 15_000_000])["regression_count"] == 1
    gap = report([0, 5_000_000, 50_000_000, 55_000_000])
    assert (gap["gap_count"], gap["gap_total_ns"]) == (1, 45_000_000)


def test_gap_rounding_is_half_even(spark):
    got = timeline.timestamp_gaps(stream(spark, [0, 25, 60, 61]), ["k"], "i", "t", 10, 2.0, 30)
    assert rows(got, "frame_index", "gap_ns", "estimated_missing", "decision") == [(1, 25, 1, "keep_with_flag"), (2, 35, 3, "split")]


def test_empty_and_single(spark):
    empty = stream(spark, [0]).where("false")
    assert timeline.continuity(empty, ["k"], "i", "t").count() == 0
    assert timeline.continuity(stream(spark, [5]), ["k"], "i", "t").first()["continuity_group"] == 0
    assert intervals.merge(empty.withColumnsRenamed({"i": "s", "t": "e"}), ["k"], "s", "e").count() == 0


def test_spikes_and_zero_mad(spark):
    values = [1.0] * 20 + [100.0]
    s = stream(spark, list(range(21)), v=values)
    assert rows(robust.spikes(s, ["k"], "v", 4.0), "i") == [(20,)]
    assert robust.spikes(s, ["k"], "v", 4.0, "skip").count() == 0
    noisy = stream(spark, list(range(4)), v=[float("nan"), 1.0, float("inf"), 1.0])
    assert robust.spikes(noisy, ["k"], "v", 4.0).count() == 0


def test_median_smooth_golden(spark):
    out = robust.median_smooth(stream(spark, range(5), v=[0.0, 0.0, 1.0, 0.0, 0.0]), ["k"], "i", "v")
    assert [r["smoothed"] for r in out.orderBy("i").collect()] == [0.0] * 5


@pytest.mark.parametrize("seed", range(3))
def test_local_z_against_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    values = rng.normal(size=80).tolist()
    got = [r["z"] for r in robust.local_z(stream(spark, range(80), v=values), ["k"], "i", "v").orderBy("i").collect()]
    for i, v in enumerate(values):
        near = values[max(0, i - 30) : i] + values[i + 1 : i + 31]
        assert math.isclose(got[i], (v - np.mean(near)) / np.std(near), rel_tol=1e-9)


@pytest.mark.parametrize("slice_rows", [None, 3])
def test_freeze_rules(spark, slice_rows):
    nan = float("nan")
    s = stream(spark, range(8), v=[1.0, 1.0, 1.0, nan, nan, 2.0, 2.0, 3.0])
    at = lambda rule: rows(intervals.freeze_spans(s, ["k"], "i", ["v"], 2, rule, slice_rows=slice_rows), "first", "last")
    assert at("equal") == [(0, 2), (5, 6)]
    assert at("finite") == [(0, 2), (5, 6)]
    assert at("near") == [(0, 6)]


def test_time_spans_extend_by_the_interval_before(spark):
    s = stream(spark, [0, 10, 30, 35, 50], f=[False, True, True, False, True])
    assert rows(intervals.time_spans(s, ["k"], "i", "t", "f"), "start_ns", "end_ns", "rows") == [(10, 50, 2), (50, 65, 1)]


def test_interval_algebra(spark):
    ivs = lambda xs: spark.createDataFrame([("s", a, b) for a, b in xs], "k string, s bigint, e bigint")
    assert rows(intervals.merge(ivs([(0, 2), (3, 5), (4, 9), (20, 21)]), ["k"], "s", "e", 1), "s", "e") == [(0, 9), (20, 21)]
    whole = spark.createDataFrame([("s", 0, 10)], "k string, lo bigint, hi bigint")
    cut = lambda xs: rows(intervals.subtract(whole, ivs(xs), ["k"], "s", "e", "lo", "hi"), "s", "e")
    assert cut([(2, 3), (3, 4), (8, 20)]) == [(0, 2), (4, 8)]
    assert cut([(0, 10)]) == []
    assert cut([(20, 30)]) == [(0, 10)]


def test_planner_crossing_case(spark):
    holes = [(6, 25, "split"), (0, 36, "split"), (12, 18, "split"), (25, 26, "split")]
    issues = spark.createDataFrame([("s", n, *x) for n, x in enumerate(holes)], "k string, o int, start_ns bigint, end_ns bigint, decision string")
    session = spark.createDataFrame([("s", 0, 30)], "k string, start_ns bigint, end_ns bigint")
    assert rows(intervals.plan_segments_in_order(issues, session, "k", "o", 2), "place", "start_ns", "end_ns") == [(0, 0, 6)]
    issues = spark.createDataFrame([("s", *h) for h in holes], "k string, start_ns bigint, end_ns bigint, decision string")
    session = spark.createDataFrame([("s", 0, 30)], "k string, start_ns bigint, end_ns bigint")
    assert intervals.plan_segments(issues, session, ["k"], 2).count() == 0


def test_planner_agrees_with_input_order_inside_the_range(spark):
    rng = np.random.default_rng(7)
    issues, sessions, expected = [], [], set()
    for k in range(60):
        cut = [tuple(sorted(rng.integers(0, 100, 2).tolist())) for _ in range(int(rng.integers(0, 6)))]
        kinds = [str(rng.choice(["split", "keep", "exclude_range"])) for _ in cut]
        sessions.append((k, 0, 100))
        issues += [(k, n, a, b, d) for n, ((a, b), d) in enumerate(zip(cut, kinds, strict=True))]
        free = set(range(100)) - {x for (a, b), d in zip(cut, kinds, strict=True) if d != "keep" for x in range(a, b)}
        for x in sorted(free):
            if x - 1 not in free:
                end = next(y for y in range(x, 101) if y not in free)
                expected |= {(k, x, end)} if end - x >= 5 else set()
    i = spark.createDataFrame(issues, "k bigint, o int, start_ns bigint, end_ns bigint, decision string")
    s = spark.createDataFrame(sessions, "k bigint, start_ns bigint, end_ns bigint")
    plain = set(rows(intervals.plan_segments(i, s, ["k"], 5), "k", "start_ns", "end_ns"))
    parted = {k for k, _, a, b, d in issues if a == b and d != "keep"}  # an empty interval parts what it lies in
    in_order = set(rows(intervals.plan_segments_in_order(i, s, "k", "o", 5), "k", "start_ns", "end_ns"))
    assert plain == in_order and len(parted) < 20
    assert {x for x in plain if x[0] not in parted} == {x for x in expected if x[0] not in parted}


def test_trims(spark):
    s = spark.createDataFrame([("s", 0, 100)], "k string, start_ns bigint, end_ns bigint")
    i = spark.createDataFrame([("s", 0, 10, "trim"), ("s", 90, 100, "trim")], "k string, start_ns bigint, end_ns bigint, decision string")
    assert rows(intervals.plan_segments(i, s, ["k"], 1), "start_ns", "end_ns", "reason") == [(10, 90, "trimmed_by_quality_boundary")]


def test_edge_idle(spark):
    s = stream(spark, range(5), a=[1.0, 0.0, 0.0, 0.0, 1.0], b=[0.0] * 5)
    assert intervals.edge_idle(s, ["k"], "i", "t", {"a": 0.0, "b": 0.0}).count() == 0
    assert rows(intervals.edge_idle(s, ["k"], "i", "t", {"b": 0.0}), "edge", "rows") == [("head", 5), ("tail", 5)]


@pytest.mark.parametrize("tie", ["earlier", "later"])
def test_nearest_against_brute_force(spark, tie):
    rng = np.random.default_rng(3)
    left = [(k, i, int(t)) for k in range(4) for i, t in enumerate(rng.integers(0, 200, 40))]
    right = [(k, i, int(t)) for k in range(3) for i, t in enumerate(sorted(rng.integers(0, 200, 25)))]
    out = asof.nearest(spark.createDataFrame(left, "k int, i bigint, t bigint"), spark.createDataFrame(right, "k int, j bigint, u bigint"), ["k"], "t", "u", "j", tie)
    got = {(r["k"], r["i"]): (r["match_ts"], r["match_index"]) for r in out.collect()}
    assert len(got) == len(left)
    for k, i, t in left:
        ts = np.array([u for kk, _, u in right if kk == k])
        if not len(ts):
            assert got[k, i] == (None, None)
            continue
        if tie == "earlier":
            best = int(np.argmin(np.abs(ts - t)))
        else:
            at = int(np.searchsorted(ts, t))
            best = len(ts) - 1 if at >= len(ts) else 0 if at == 0 else at - 1 if abs(ts[at - 1] - t) < abs(ts[at] - t) else at
        assert got[k, i] == (ts[best], best)


def test_sample_map_grid_lengths(spark):
    frames = stream(spark, [0, 33, 66, 100])
    span = spark.createDataFrame([("s", 0, 100)], "k string, s bigint, e bigint")
    n = lambda image: asof.sample_map(frames, span, ["k"], "t", "i", "s", "e", 1e9 / 30, image).count()
    assert (n(False), n(True)) == (4, 3)


def test_cross_correlation_finds_the_shift(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=220)
    a, b = stream(spark, range(200), v=x[:200].tolist()), stream(spark, range(200), v=x[7:207].tolist())
    assert asof.cross_correlation(a, b, ["k"], "i", "v", 20).first()["lag_samples"] == 7


@pytest.mark.parametrize("cut", [500, 37, None])
def test_cross_correlation_by_brute_force(spark, monkeypatch, cut):
    """Signals with gaps, nulls, infinities and one row, cut into short stretches."""
    monkeypatch.setattr(asof, "STRETCH", 16)
    rng = np.random.default_rng(6)
    signals = {("x", n): {i: float(v) for i, v in enumerate(rng.normal(size=90)) if rng.random() < 0.9} for n in (0, 1)}
    signals |= {("y", 0): {0: 1.0, 1: None, 2: 5.0}, ("y", 1): {0: None, 1: 2.0, 2: 3.0, 3: 9.0}, ("z", 0): {0: 4.0}, ("z", 1): {0: 2.0}, ("only", 0): {0: 1.0}, ("i", 0): {0: 1.0, 1: float("inf")}, ("i", 1): {0: 3.0, 1: 1.0}}
    signals |= {(None, 0): {0: 1.0}, (None, 1): {0: 1.0}, ("far", 0): {0: 1.0, 1: 2.0}, ("far", 1): {40: 1.0, 41: 2.0}}
    a, b = (spark.createDataFrame([(k, i, v) for (k, m), of in signals.items() if m == n for i, v in of.items()], "k string, i bigint, v double") for n in (0, 1))
    got = {r["k"]: (r["lag_samples"], r["correlation_peak"]) for r in asof.cross_correlation(a, b, ["k"], "i", "v", 5, cut).collect()}
    assert set(got) == {"x", "y", "z", "i"}
    for k in ("x", "y", "z"):
        x, y = ({i: v for i, v in signals[k, n].items() if cut is None or i < cut} for n in (0, 1))
        n = min(len(x), len(y))
        x, y = ({i: v for i, v in s.items() if i < n} for s in (x, y))
        x, y = ({i: None if v is None else v - np.mean([u for u in s.values() if u is not None]) for i, v in s.items()} for s in (x, y))
        sums = {lag: sum(x[i] * y[i - lag] for i in x if None not in (x[i], y.get(i - lag))) for lag in range(-5, 6)}
        want = max(sums, key=lambda lag: (round(abs(sums[lag]), 6), -lag))
        assert (k == "z" and got[k] == (0, 0.0)) or got[k] == (want, pytest.approx(sums[want]))
    assert math.isnan(got["i"][1])


def test_cross_correlation_repeats_no_row_for_each_lag(spark):
    a, b = (stream(spark, range(200), v=np.random.default_rng(n).normal(size=200).tolist()) for n in (0, 1))
    plan = asof.cross_correlation(a, b, ["k"], "i", "v", 20)
    held = plan._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Generate .*\[lag#", held)


def test_scene_peaks_hysteresis_duration(spark):
    p = spark.createDataFrame([("s", i, s) for i, s in ((9, 0.5), (10, 0.9), (11, 0.9), (17, 0.2))], "k string, i bigint, s double")
    assert rows(scene.peaks(p, ["k"], "i", "s"), "i") == [(10,), (17,)]
    c = spark.createDataFrame([("s", 10, 100, 0.5, False), ("s", 11, 110, 0.4, True), ("s", 13, 130, 0.9, False), ("s", 30, 300, 0.7, False)], "k string, frame_index bigint, timestamp_ns bigint, confidence double, is_hard_cut boolean")
    h = scene.hysteresis(c, ["k"])
    assert rows(h, "frame_index", "confidence", "is_hard_cut") == [(11, 0.9, True), (30, 0.7, False)]
    ends = h.withColumns({"a": F.lit(0).cast("bigint"), "z": F.lit(310).cast("bigint")})
    assert rows(scene.minimum_duration(ends, ["k"], "a", "z", 50), "frame_index") == [(11,)]
    assert scene.merge_same_scenes([(10, False), (20, True), (30, False)], 0, 40, lambda a, b: 1.0, 0.5) == [(20, True)]


def test_scene_fusion_score(spark):
    p = spark.createDataFrame([("s", 9, "a", 0.4, False), ("s", 10, "b", 0.8, True)], "k string, frame_index bigint, source string, score double, is_hard_cut boolean")
    sm = spark.createDataFrame([("s", 9, "a", 0.6)], "k string, frame_index bigint, source string, smoothed double")
    got = scene.fuse(p, sm, ["k"], {"a": 1.0, "b": 2.0, "c": 1.0}, 1, 30.0).first()
    assert (got["frame_index"], got["is_hard_cut"], got["sources"]) == (10, True, ["a", "b"])
    assert math.isclose(got["score"], (0.6 + 1.6) / 4)


def test_threshold_sweep_and_recommendation(spark):
    df = spark.createDataFrame([(1.0, True), (2.0, True), (2.0, False), (3.0, False)], "v double, y boolean")
    sweep = review.threshold_sweep(df, "v", "y")
    assert rows(sweep, "threshold", "tp", "fp", "fn") == [(1.0, 1, 0, 1), (2.0, 2, 1, 0), (3.0, 2, 2, 0)]
    assert review.recommended(sweep).first()["threshold"] == 2.0


def test_apply_review(spark):
    issue = "issue_id string, issue_type string, stream_id string, start_ns bigint, end_ns bigint, severity string, decision string"
    known = spark.createDataFrame([(f"iss_{i:06d}", "gap", "s", i, i + 1, "error", "split") for i in range(1, 5)], issue)
    entries = spark.createDataFrame([("iss_000001", "rejected", "gap", "s", 1, 2, "error", "split"), ("iss_000002", "modified", "gap", "s", 50, 40, "warning", "keep"), ("iss_000003", "modified", "gap", "s", 3, 4, "error", "bogus"), ("new", "added", "black", "s", 5, 6, "warning", "trim"), ("odd", "added", None, "s", 5, 6, "warning", "trim")], issue.replace("issue_id string,", "issue_id string, status string,"))
    assert rows(review.apply_review(known, entries), "issue_id", "outcome", "start_ns", "end_ns", "decision") == [("iss_000002", "modified", 50, 50, "keep"), ("iss_000003", "kept", 3, 4, "split"), ("new", "added", 5, 6, "trim")]


def test_statuses(spark):
    df = spark.createDataFrame([("a", "critical"), ("b", "warn"), ("c", "info"), ("d", "error"), ("e", "fatal")], "k string, severity string")
    assert rows(quality.quality_status(df, ["k"]), "k", "quality_status", "strict_status") == [("a", "pass", "fail"), ("b", "warning", "warning"), ("c", "pass", "pass"), ("d", "fail", "fail"), ("e", "pass", "fail")]
    assert rows(quality.overall(df, ["k"]), "k", "passed", "disposition") == [("a", True, "pass"), ("b", True, "quarantine"), ("c", True, "pass"), ("d", False, "quarantine"), ("e", False, "reject")]


def test_strong_identifiers(spark):
    texts = {"11010519491231002X": "id_card", "110105491231002": "id_card", "call 13912345678 now": "phone", "4111111111111111": "bank_card", "12345": "", "x13912345678": ""}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["t"]: r["k"] for r in df.select("t", privacy.strong_identifier(F.col("t")).alias("k")).collect()}
    assert got == texts


def test_histogram_is_numpys(spark):
    v = [0.0, 0.1, 0.55, 1.0, 1.0, 3.0]
    got = [r["density"] for r in dedup.histogram(stream(spark, range(6), v=v), ["k"], "v").orderBy("bin").collect()]
    assert np.allclose(got, np.histogram(v, bins=20, density=True)[0])
    flat = [r["density"] for r in dedup.histogram(stream(spark, range(3), v=[2.0] * 3), ["k"], "v").orderBy("bin").collect()]
    assert np.allclose(flat, np.histogram([2.0] * 3, bins=20, density=True)[0])


def test_slices_change_nothing(spark):
    import random

    rng = random.Random(3)
    left = [("ab"[k % 2], rng.randrange(1000), k) for k in range(60)] + [("c", 5, 60), (None, 7, 61), ("a", None, 62)]
    right = [("ab"[k % 2], rng.randrange(1000) if k < 20 else 100 + k % 3, k) for k in range(40)] + [(None, 900, 41)]
    a, b = (spark.createDataFrame(x, "k string, t bigint, n int") for x in (left, right))
    for tie in ("earlier", "later"):
        want = asof.nearest(a, b, ["k"], "t", "t", "n", tie).collect()
        for size in (1, 37, 400, 10**6):
            assert sorted(map(str, asof.nearest(a, b, ["k"], "t", "t", "n", tie, size).collect())) == sorted(map(str, want))
    flagged = spark.createDataFrame([("ab"[k % 2], k // 2, 10 * k + rng.randrange(9), rng.random() < 0.7) for k in range(120)], "k string, i bigint, t bigint, f boolean")
    for size in (1, 7, 1000):
        assert sorted(intervals.time_spans(flagged, ["k"], "i", "t", "f", slice_rows=size).collect()) == sorted(intervals.time_spans(flagged, ["k"], "i", "t", "f").collect())
        assert sorted(intervals.frame_spans(flagged, ["k"], "i", "f", slice_rows=size).collect()) == sorted(intervals.frame_spans(flagged, ["k"], "i", "f").collect())


def test_correlated_pairs_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(4)
    base = rng.normal(size=(12, 20))
    held = np.concatenate([base, base[:6] * 3 + 1 + rng.normal(size=(6, 20)) * 0.3, base[:2], np.ones((1, 20))])
    df = spark.createDataFrame([(k, i, float(v)) for k, row in enumerate(held) for i, v in enumerate(row)], "k bigint, bin int, v double")
    for least in (0.2, 0.6, 0.9, 0.99):
        got = {(r["key_a"], r["key_b"]): r["correlation"] for r in dedup.correlated_pairs(df, "k", ["bin"], "v", least).collect()}
        own = [k for k in range(len(held)) if held[k].std() and not any((held[j] == held[k]).all() for j in range(k))]
        want = {(a, b): np.corrcoef(held[a], held[b])[0, 1] for a in own for b in own if a < b and np.corrcoef(held[a], held[b])[0, 1] >= least}
        assert set(got) == set(want) and all(got[x] == pytest.approx(want[x]) for x in want)


def test_correlated_pairs_in_parts_without_a_join(spark, monkeypatch):
    """Products cut into pieces of a few rows, keys that are text, a print with an infinite value."""
    rng = np.random.default_rng(8)
    held = rng.normal(size=(300, 6))
    df = spark.createDataFrame([(f"k{k}", i, float(v)) for k, row in enumerate(held) for i, v in enumerate(row)] + [("bad", i, float("inf") if i else 1.0) for i in range(6)], "k string, bin int, v double")
    assert "Join" not in dedup.correlated_pairs(df, "k", ["bin"], "v", 0.6)._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(dedup, "DEALT", 3)
    monkeypatch.setattr(dedup, "PRODUCT", 700)
    got = [(r["key_a"], r["key_b"]) for r in dedup.correlated_pairs(df, "k", ["bin"], "v", 0.6).collect()]
    all_r = np.corrcoef(held)
    want = {tuple(sorted((f"k{a}", f"k{b}"))) for a in range(300) for b in range(a) if all_r[a, b] >= 0.6}
    assert len(got) == len(want) and set(got) == want


def test_classes_of_equal_codes(spark):
    df = spark.createDataFrame([(3, 7), (1, 7), (2, 6), (9, 7), (5, None)], "k bigint, c bigint")
    assert rows(dedup.class_members(df, "k", "c"), "k", "representative") == [(1, 1), (2, 2), (3, 1), (9, 1)]
    assert rows(dedup.hamming_pairs(df, "k", "c", 1), "key_a", "key_b", "distance") == [(1, 2, 1)]


def test_hamming_pairs_brute_force(spark):
    rng = np.random.default_rng(5)
    codes = [int(x) for x in rng.integers(-(2**63), 2**63 - 1, 40)]
    codes += [c ^ (1 << int(rng.integers(0, 63))) for c in codes[:20]]
    df = spark.createDataFrame(list(enumerate(codes)), "k bigint, c bigint")
    near = {(i, j) for i in range(60) for j in range(i + 1, 60) if ((codes[i] ^ codes[j]) & (2**64 - 1)).bit_count() <= 4}
    assert set(rows(dedup.hamming_pairs(df, "k", "c", 4), "key_a", "key_b")) == near


def test_masks_and_boxes(spark):
    rng = np.random.default_rng(2)
    for mask in (rng.random((5, 7)) > 0.5, np.zeros((3, 3), bool), np.ones((2, 2), bool)):
        counts = annotate.encode_mask(mask)
        assert (annotate.decode_mask(counts, *mask.shape) == mask).all()
        df = spark.createDataFrame([(counts,)], "c array<bigint>")
        assert df.select(annotate.mask_area(F.col("c")).alias("a")).first()["a"] == mask.sum()
    with pytest.raises(ValueError):
        annotate.decode_mask([3], 2, 2)
    box = spark.createDataFrame([(-5.0, 2.0, 30.0, 8.0)], "x1 double, y1 double, x2 double, y2 double")
    got = annotate.box_clip(box, ["x1", "y1", "x2", "y2"], 20, 10).first()
    assert (got["x1"], got["x2"], got["was_clipped"], got["area"]) == (0.0, 20.0, True, 120.0)


def ogg_packets(data):
    """(packets, flags and granules of the pages) of an Ogg stream; every checksum is held."""
    import struct

    at, packets, open_, pages = 0, [], b"", []
    while at < len(data):
        magic, _, flags, granule, _, number, crc, n = struct.unpack_from("<4sBBqIIIB", data, at)
        table = data[at + 27 : at + 27 + n]
        end = at + 27 + n + sum(table)
        page = data[at:end]
        assert magic == b"OggS" and number == len(pages) and annotate.ogg_crc(page[:22] + bytes(4) + page[26:]) == crc
        assert bool(flags & 1) == bool(open_)
        x = at + 27 + n
        for size in table:
            open_ += data[x : x + size]
            x += size
            if size < 255:
                packets.append(open_)
                open_ = b""
        pages.append((flags, granule))
        at = end
    return packets, pages


def test_ogg_opus(spark):
    for sizes in ([3], [0, 255, 254, 300], [200] * 70, [65_025, 70_000, 10], [65_024] * 3, [255 * 255, 1]):
        packets = [bytes([k % 251]) * n for k, n in enumerate(sizes)]
        got, pages = ogg_packets(annotate.ogg_opus(packets, channels=2, preskip=7))
        assert got[2:] == packets and got[0][:8] == b"OpusHead" and got[0][9] == 2 and len(got[0]) == 19 and got[1].startswith(b"OpusTags")
        assert pages[0] == (2, 0) and pages[1] == (0, 0) and pages[-1][0] & 4 and pages[-1][1] == 960 * len(sizes) + 7
    with pytest.raises(ValueError):
        annotate.ogg_opus([])
    df = spark.createDataFrame([("s", 2, b"two"), ("s", 1, b"one"), ("t", 1, None)], "k string, i int, p binary")
    got = annotate.opus_files(df, ["k"], "i", "p").collect()
    assert [(r["k"], r["packets"], ogg_packets(bytes(r["content"]))[0][2:]) for r in got] == [("s", 2, [b"one", b"two"])]


def test_structural_similarity_and_cuts(spark):
    import numpy as np

    from tessera.operators import frames

    rng = np.random.default_rng(1)
    one, two = (rng.integers(0, 256, (12, 12), dtype=np.uint8) for _ in range(2))
    shots = [one] * 8 + [two] * 8
    df = spark.createDataFrame([("v", i, x.tobytes(), 12, 12) for i, x in enumerate(shots)], "k string, i bigint, content binary, h int, w int")
    found = scene.structural_similarity(df, ["k"], "i", "content", "h", "w").orderBy("i").collect()
    assert [r["similarity"] for r in found] == pytest.approx([1.0] * 8 + [frames.similarity(one, two)] + [1.0] * 7)
    assert found[4]["lag_similarity"] is None and found[7]["lag_similarity"] == pytest.approx(1) and found[10]["lag_similarity"] == pytest.approx(frames.similarity(one, two))
    cuts = scene.structural_cuts(spark.createDataFrame(found), ["k"], "i")
    assert [(r["i"], round(r["score"], 6)) for r in cuts.collect()] == [(8, round(min(1.0, 1 - frames.similarity(one, two)), 6))]


def test_video_hashes(spark):
    import numpy as np

    from tessera.operators import frames

    rng = np.random.default_rng(2)
    shots = [rng.integers(0, 256, (16, 24), dtype=np.uint8) for _ in range(25)]
    df = spark.createDataFrame([("v", i, x.tobytes(), 16, 24) for i, x in enumerate(shots)] + [("bad", 0, b"x", 2, 2), ("null", 0, None, 2, 2)], "k string, i bigint, content binary, h int, w int")
    got = {r["bit"]: r["share"] for r in frames.video_hashes(df, ["k"], "i", "content", "h", "w").collect()}
    want = frames.perceptual_hash([shots[int(i * 2.5)] for i in range(10)]).ravel()
    assert [got[i] for i in range(64)] == pytest.approx(want.tolist())


def test_sequential_twins(spark):
    s = stream(spark, [0, 5, 9, 12, 30])
    assert [r["inferred"] for r in privacy.sampled(s, "k", "t", 10).orderBy("t").collect()] == [True, False, False, True, True]


def test_validators(spark):
    s = stream(spark, [0, 5, 5, 4])
    assert validate.strictly_increasing(s, ["k"], "i", ["t"]).first()["not_increasing_t"] == 2
    assert validate.violations(s, {"early": F.col("t") > 4}, ["k"]).first()["early"] == 2


def test_null_keys_are_streams_too(spark):
    df = spark.createDataFrame([(None, 0, 1), (None, 1, 5), ("a", 0, 2)], "k string, i bigint, t bigint")
    for n in (None, 1):
        got = sequence.previous(df, ["k"], "i", ["t"], n)
        assert rows(got, "k", "i", "prev_t") == sorted([(None, 0, None), (None, 1, 1), ("a", 0, None)], key=repr)


def test_numbers(spark):
    df = spark.createDataFrame([(2.5, 3.5, -1.5)], "a double, b double, c double")
    assert tuple(df.select(numbers.half_even("a"), numbers.half_even("b"), numbers.truncated("c")).first()) == (2.0, 4.0, -1)


def test_frames(spark):
    rng = np.random.default_rng(0)
    flat, noise = np.full((16, 16), 250, np.uint8), rng.integers(0, 255, (16, 16)).astype(np.uint8)
    assert frames.laplacian_variance(flat) == 0 < frames.laplacian_variance(noise)
    assert frames.similarity(noise, noise) == pytest.approx(1) and frames.similarity(noise, flat) < 0.5
    assert np.allclose(frames.dct_matrix(8) @ frames.dct_matrix(8).T, np.eye(8))
    assert (frames.perceptual_hash([noise]) == frames.perceptual_hash([noise, noise])).all()
    df = spark.createDataFrame([(1, bytearray(flat.tobytes()), 16, 16), (2, bytearray(b"x"), 16, 16), (3, None, 1, 1)], "i int, c binary, h int, w int")
    got = {r["i"]: r for r in frames.frame_metrics(df, ["i"], "c", "h", "w", 1).collect()}
    assert (got[1]["gray_mean"], got[1]["saturated_ratio"], got[2]["p95"], got[3]["p95"]) == (250.0, 1.0, None, None)
    d = spark.createDataFrame([(1, [0, 0, 5, 7]), (2, []), (3, [0])], "i int, p array<int>")
    s = {r["i"]: r for r in frames.depth_stats(d, ["i"], "p").collect()}
    assert (s[1]["zero_ratio"], s[1]["mean"], s[1]["std"], s[1]["max"]) == (0.5, 6.0, 1.0, 7)
    assert s[2]["all_zero"] and s[2]["valid_ratio"] == 0.0 and s[3]["all_zero"]
    t = spark.createDataFrame([("v", 0, 0.0, 0.0, 10.0, 10.0), ("v", 1, 1.0, 1.0, 11.0, 11.0), ("v", 1, 50.0, 50.0, 60.0, 60.0), ("v", 2, 51.0, 50.0, 61.0, 60.0)], "k string, f int, a double, b double, c double, d double")
    assert [r["track_id"] for r in frames.match_tracks(t, "k", "f", ["a", "b", "c", "d"]).orderBy("f", "a").collect()] == [0, 0, 1, 1]


def test_depth_means_are_rounded_as_numpy_does(spark):
    sums = [49, 93, 179, 201, 357, 651]  # of 40 pixels: their means are ties as decimals, and as doubles lie to either side
    d = spark.createDataFrame([(i, [n // 40] * (40 - n % 40) + [n // 40 + 1] * (n % 40)) for i, n in enumerate(sums)], "i int, p array<int>")
    assert [r["mean"] for r in frames.depth_stats(d, ["i"], "p").orderBy("i").collect()] == [float(np.round(n / 40, 2)) for n in sums]


def test_continuity_is_recomputed(spark):
    rows = timeline.continuity(stream(spark, [0, 10, 5, 6]), ["k"], "i", "t", 100)
    good = rows.withColumn("stored", F.col("continuity_group"))
    assert tuple(validate.continuity_holds(good, ["k"], "i", "stored", "t", "continuity_group").first())[1:] == (0, 0, 0, 0)
    bad = rows.withColumn("stored", F.when(F.col("i") < 3, 1).otherwise(3).cast("bigint"))
    assert tuple(validate.continuity_holds(bad, ["k"], "i", "stored", "t", "continuity_group").first())[1:] == (1, 1, 1, 3)


def test_regions_are_averaged_with_the_frame_before(spark):
    df = spark.createDataFrame([("v", 0, 0.0, 0.0, 10.0, 10.0), ("v", 1, 2.0, 0.0, 12.0, 10.0), ("v", 2, 90.0, 90.0, 99.0, 99.0)], "k string, f int, a double, b double, c double, d double")
    assert rows(privacy.smooth_regions(df, "k", "f", ["a", "b", "c", "d"]), "f", "a", "c") == [(0, 0.0, 10.0), (1, 1.0, 11.0), (2, 90.0, 99.0)]


def test_representative_frames(spark):
    df = spark.createDataFrame([(0, 10**9, 30), (10**9, 10**9 + 1, 31), (9 * 10**9, 10**10, 30)], "a bigint, z bigint, n bigint").withColumn("s", F.lit(0).cast("bigint"))
    got = scene.representative_frames(df, "a", "z", 30.0, "n", "s")
    assert rows(got, "first_frame", "middle_frame", "last_frame") == [(0, 14, 29), (29, 29, 29), (30, 30, 30)]


def test_redaction_and_distinct_classification(spark):
    df = spark.createDataFrame([("call 13912345678", 1), ("call 13912345678", 2), ("none", 3), (None, 4)], "t string, n int")
    seen = []

    def classify(texts):
        seen.append(texts.count())
        return texts.withColumn("category", privacy.strong_identifier(F.col("t")))

    got = privacy.classify_distinct(df, "t", classify)
    assert rows(got, "n", "category") == [(1, "phone"), (2, "phone"), (3, ""), (4, None)] and seen == [3]
    assert df.select(privacy.redacted(F.col("t")).alias("x")).first()["x"] == "call [REDACTED]"


def test_fused_reasons_and_short_spans(spark):
    spans = spark.createDataFrame([("s", 0, 4), ("s", 5, 6)], "k string, a bigint, z bigint")
    n = spark.createDataFrame([("s", 20)], "k string, n bigint")
    assert rows(intervals.invert(spans, n, ["k"], "a", "z", "n"), "a", "z") == [(4, 5), (6, 20)]
    assert rows(intervals.keep_long(spans, n, ["k"], "a", "z", "n", 0, 3), "a", "z") == [(6, 20)]
    assert rows(intervals.keep_long(spans, n, ["k"], "a", "z", "n", 1, 15), "a", "z") == []
