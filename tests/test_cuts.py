"""Greedy cuts over frame rows, interval subtraction, containment and exact group quantiles against plain folds."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomwright.functions.tables import group_quantiles
from loomwright.operators import activity, manifests, reports, transcripts
from loomwright.operators.cuts import chunk_frames, greedy_chunks
from loomwright.sources import audio
from tests.plain_signal import silence_chunks


def fold(frames, low, high, end):
    """One recording from its first frame to its last."""
    out, at = [], 0
    while end - at > high:
        ok = [(v, abs(2 * i - 2 * at - low - high), -i, i) for i, v, quiet in frames[at + low : at + high + 1] if quiet and v is not None]
        cut = min(ok)[3] if ok else at + high
        out.append((at, cut, "silence" if ok else "max"))
        at = cut
    return [*out, (at, end, "end")] if end > at else out


@pytest.mark.parametrize("low,high,levels", [(3, 9, 3), (1, 4, 1), (5, 20, 50), (2, 2, 4)])
def test_greedy_chunks_equal_a_fold(spark, low, high, levels):
    pick = random.Random(low * 100 + levels)
    rows, want = [], []
    for key, n in ((None, 60), ("a", 400), ("b", 1), ("c", high), ("d", high + 1), ("e", 333)):
        frames = [(i, float(pick.randint(1, levels)), pick.random() < (0.02 if key == "e" else 0.6)) for i in range(n)]
        end = n + pick.choice([0, 0, 2])
        rows += [(key, i, v, q, end) for i, v, q in frames]
        want += [(key, *x) for x in fold(frames, low, high, end)]
    df = spark.createDataFrame(rows, "k string, i int, v double, quiet boolean, n int").repartition(5)
    got = greedy_chunks(df, "k", "i", "v", "quiet", low, high, "n")
    assert sorted(map(str, (tuple(r) for r in got.select("k", "start", "stop", "method").collect()))) == sorted(map(str, want))
    assert greedy_chunks(df.limit(0), "k", "i", "v", "quiet", low, high, "n").count() == 0


def test_chunks_of_recordings_equal_the_fold_over_signals(spark):
    rate, rng = 8000, np.random.default_rng(5)
    files, want = [], {}
    for k, seconds in enumerate((41.0, 15.0, 3.0, 16.005)):
        x = rng.normal(0, 0.2, int(seconds * rate)).astype(np.float32)
        for a in rng.integers(0, len(x), 30):
            x[a : a + int(rng.integers(200, 2000))] *= 0.001
        content = audio.encode_wav(x, rate)
        files.append((f"f{k}", content))
        want[f"f{k}"] = [(a / rate, z / rate) for a, z in silence_chunks(audio.decode_wav(content)[0], rate, 5, 15)]
    files.append(("broken", b"no wav"))
    got = {}
    rows = chunk_frames(audio.frames(spark.createDataFrame(files, "stem string, content binary").repartition(3), rate)).collect()
    assert [r.problem[:10] for r in rows if r.stem == "broken"] == ["read_error"]
    for r in rows:
        if r.problem is None:
            got.setdefault(r.stem, []).append((r.start_sec, r.end_sec))
    for stem, chunks in want.items():
        assert np.allclose(sorted(got[stem]), chunks, atol=1e-6), stem


def test_subtraction_equals_a_plain_one(spark):
    pick = random.Random(2)
    interval = lambda: (a := pick.randint(0, 60), a + pick.randint(0, 15))
    whole = [(k, *interval()) for k in (1, 1, 1, 2, 3, None) for _ in range(4)]
    whole += whole[:3]
    holes = [(k, *interval()) for k in (1, 2, 2, None, 9) for _ in range(3)]
    want = []
    for k, s, e in whole:
        left = [t for t in range(s, e) if not any(h == k and a <= t < b for h, a, b in holes)]
        runs = [t for t in left if t - 1 not in left]
        want += [(k, t, next(u for u in range(t, e + 1) if u not in left)) for t in runs]
    w, h = (spark.createDataFrame(x, "k int, start int, end int") for x in (whole, [x for x in holes if x[1] < x[2]]))
    got = [tuple(r) for r in activity.subtract_intervals(w, h, "k").select("k", "start", "end").collect()]
    # neighbouring wholes of a cell list are runs of one interval each, so holes between them are kept apart
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_containment_of_overlapping_segments(spark):
    pick = random.Random(7)
    segments = [(s, a, a + pick.randint(0, 300)) for s in (1, 2) for a in pick.sample(range(500), 12)]
    tokens = [(s, i) for s in (1, 2, 3) for i in range(0, 700, 3)]
    want = sorted((s, a, z, i) for s, a, z in segments for t, i in tokens if s == t and a <= i <= z)
    found = transcripts.contained(spark.createDataFrame(segments, "source_id int, first_token int, last_token int"), spark.createDataFrame(tokens, "source_id int, idx int"))
    assert sorted((r.source_id, r.first_token, r.last_token, r.idx) for r in found.collect()) == want


def test_plans_have_no_product_within_a_key(spark, sf):
    """Joins are on a key and a bin or number, never on the source alone."""
    import re

    from __spark_entry__ import queries

    for name in ("segment_transcripts", "silent_complement"):
        plan = queries()[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        held = [x for x in plan.splitlines() if "Join" in x and re.search(r"<=|>=|<|>", x.replace("<=>", ""))]
        assert all("_bin" in x for x in held), held


@pytest.mark.parametrize("n", [1, 2, 7, 200])
def test_group_quantiles(spark, n):
    rng = np.random.default_rng(n)
    rows = [(k, float(rng.integers(0, 20)), float(x) if rng.random() < 0.8 else None) for k in ("a", None) for x in rng.normal(size=n)] + [("none", 1.0, None)]
    df = spark.createDataFrame(rows, "k string, x double, y double").repartition(3)
    got = {r.k: r for r in group_quantiles(df, ["k"], {"m": ("x", 0.5, True), "p": ("x", 0.95, False), "q": ("y", 0.9, True)}).collect()}
    for k in ("a", None):
        x = sorted(r[1] for r in rows if r[0] == k)
        y = [r[2] for r in rows if r[0] == k and r[2] is not None]
        assert got[k].m == pytest.approx(np.quantile(x, 0.5)) and got[k].p == x[max(0, int(np.ceil(len(x) * 0.95)) - 1)]
        assert got[k].q == (pytest.approx(np.quantile(y, 0.9)) if y else None)
    assert got["none"].q is None and got["none"].m == 1.0


def test_summaries_by_ranks(spark):
    rows = spark.createDataFrame([("s", 2.0, True, 100.0, False), ("s", 4.0, False, None, True), (None, 9.0, True, 50.0, False)], "k string, sec double, hit boolean, ms double, fell boolean")
    got = {r.k: r for r in reports.cut_summary(rows, ["k"], "sec", F.col("hit"), "ms", F.col("fell")).collect()}
    assert (got["s"].segments, got["s"].median_sec, got["s"].silence_median_ms, got["s"].hit_percent, got["s"].fallbacks) == (2, 3.0, 100.0, 50.0, 1)
    assert got[None].median_sec == 9.0
    assert manifests.numeric_summary(rows, ["k"], "sec").where("k = 's'").first().p95 == 4.0


@pytest.mark.parametrize("seed", range(3))
def test_packing_equals_a_fold_of_each_source(spark, seed):
    from tests.plain_activity import pack_levels

    pick = random.Random(seed)
    regions, rows = [], []
    for key in ("a", "b", "c", "bare", "one", "x"):
        at = pick.randint(0, 50)
        for _ in range(0 if key in ("bare", "one") else pick.randint(1, 25)):
            length = pick.choice([1, 3, 8, 20, 20, 75, 200])
            regions.append((key, at, at + length))
            at += length + pick.randint(0, 12)
        times = [5] * 3 if key == "one" else sorted(pick.choices(range(max(at, 300)), k=pick.choice([0, 40, 150])))
        rows += [(key, t, float(pick.randint(1, 4)) if key != "x" else 1.0) for t in times]
    r, e = spark.createDataFrame(regions, "k string, start long, end long").repartition(4), spark.createDataFrame(rows, "k string, t long, v double").repartition(3)
    columns = ["k", "chunk", "start", "end", "n"]
    got = sorted(tuple(x) for x in activity.pack_levels(r, e, "k", 30, 7, "t", "v").select(columns).collect())
    assert got == sorted(tuple(x) for x in pack_levels(r, e, "k", 30, 7, "t", "v").select(columns).collect())
    plain = []
    for key in sorted({x[0] for x in regions}):
        out = []
        for a, z in sorted(x[1:] for x in regions if x[0] == key):
            if out and z - out[-1][0] <= 30 and out[-1][1] - out[-1][0] <= 30:
                out[-1] = (out[-1][0], max(out[-1][1], z), out[-1][2] + 1)
            else:
                out.append((a, z, 1))
        plain += [(key, k, *x) for k, x in enumerate(out)]
    assert sorted(tuple(x) for x in activity.pack_regions(r, "k", 30).select(columns).collect()) == plain
    assert activity.pack_levels(r.limit(0), e.limit(0), "k", 30, 7, "t", "v").count() == 0
