"""The volume tool, reports, window selection and quiet boundaries."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomwright.operators import loudness, reports, signal, volume
from tests.plain_planners import Boundary, Quantiles, Source, next_window
from loomwright.operators.speakers import prune_outliers
from loomwright.sources.audio import decode_wav, encode_wav

RATE = 8000


def tone(seconds, level=0.5, rate=RATE):
    return (level * np.sin(2 * np.pi * 997 * np.arange(int(seconds * rate)) / rate)).astype(np.float32)


def test_loudness_by_convolution_is_that_of_the_filters():
    pick = np.random.default_rng(4)
    for rate, n in ((8000, 30_000), (16_000, 9_000), (8000, 100_000)):
        x = pick.normal(0, 0.1, n)
        want = x
        for b, a in volume.k_weighting(rate):
            want = volume._biquad(want, b, a)
        assert np.abs(volume.weighted_signal(x, rate) - want).max() < 1e-9
    # a full-scale sine of 997 Hz at 48 kHz measures -3.01 LUFS
    assert volume.integrated_loudness(tone(2, 1.0, 48_000), 48_000) == pytest.approx(-3.01, abs=0.05)


def test_volume_tool(spark):
    sounds = {"loud": tone(2, 0.8), "soft": tone(2, 0.1), "faint": tone(2, 0.002), "gaps": np.concatenate([tone(0.5, 0.5), np.zeros(4 * RATE, np.float32)]), "short": tone(0.1)}
    rows = [(k, encode_wav(x, RATE)) for k, x in sounds.items()] + [("broken", b"no wav"), ("none", None)]
    files = spark.createDataFrame(rows, "stem string, content binary")
    decided = loudness.decide(loudness.measure_files(files), -20.0)
    got = {r.stem: r for r in decided.collect()}
    assert set(got) == {k for k, _ in rows}
    assert {k for k, r in got.items() if r.problem} == {"short", "broken", "none"}
    assert not got["loud"].pruned and not got["soft"].pruned
    assert any("too quiet" in x for x in got["faint"].reasons) and any("active audio" in x for x in got["gaps"].reasons)
    assert got["loud"].active_ratio == pytest.approx(1, abs=0.02) and got["loud"].peak_dbfs == pytest.approx(20 * np.log10(0.8), abs=0.01)
    out = {r.stem: r for r in loudness.normalise_files(files, decided).collect()}
    assert set(out) == {"loud", "soft"}
    for r in out.values():
        x, rate = decode_wav(bytes(r.content))
        assert volume.integrated_loudness(x, rate) == pytest.approx(-20, abs=0.1) and not r.peak_limited
    assert loudness.analysis_report(decided, -20.0).count() == len(rows)
    records = spark.createDataFrame([("faint", '{"b": 1, "a": "x"}'), ("loud", "{}"), ("gaps", "{}"), ("broken", "[1]")], "stem string, payload string")
    marked = {r.stem: r.payload for r in loudness.pruned_records(records, decided).collect()}
    assert marked["faint"].startswith('{"b": 1, "a": "x", ') and json.loads(marked["faint"])["normalization_pruned"] is True
    assert json.loads(marked["gaps"])["normalization_reasons"] and marked["broken"] == "[1]" and "loud" not in marked


def test_limiter():
    out, gain, held = loudness.limited(tone(1, 0.5), 12.0)
    assert held and np.abs(out).max() == pytest.approx(10 ** (-1 / 20), abs=1e-4) and gain < 12
    out, gain, held = loudness.limited(tone(1, 0.1), 6.0)
    assert not held and gain == 6.0
    assert loudness.limited(np.zeros(0, np.float32), 3.0)[1:] == (3.0, False)


def test_speaker_reports(spark, tmp_path):
    rows = [(k, f"a{k}.wav", 0.9 + k / 1000, json.dumps({"k": k})) for k in range(30)] + [(30, "x.wav", 0.1, "{}"), (31, "y.wav", 0.2, "{}"), (32, "z.wav", 0.3, "{}"), (33, "u.wav", 0.31, "{}")]
    scored = spark.createDataFrame(rows, "line long, audio string, similarity double, payload string")
    pruned = prune_outliers(scored, F.col("line"))
    one = reports.speaker_summary(pruned).first()
    assert (one.row_count, one.pruned_count, one.kept_count, one.threshold_prune_count, one.capped_prune_count, one.max_allowed_prune_count) == (34, 3, 31, 4, 1, 3)
    assert one.median == pytest.approx(np.median([r[2] for r in rows])) and one.pruning_disabled_reason is None
    report = {r.jsonl_row: r for r in reports.speaker_report(pruned, "line", "audio").collect()}
    assert report[30].similarity == "0.10000000" and report[30].rank_lowest_first == 1 and report[30].pruned
    assert {json.loads(r.payload)["speaker_similarity"] for r in reports.speaker_pruned_records(pruned).collect()} == {0.1, 0.2, 0.3}
    reports.write_summary(reports.speaker_summary(pruned), f"{tmp_path}/s")
    assert json.loads(spark.read.text(f"{tmp_path}/s").first()[0])["pruned_count"] == 3
    reports.write_by_source(pruned, f"{tmp_path}/d", "reason")
    assert spark.read.json(f"{tmp_path}/d").count() == 34
    few = reports.speaker_summary(prune_outliers(scored.limit(3), F.col("line"))).first()
    assert few.pruned_count == 0 and few.pruning_disabled_reason


def test_diff_and_cut_reports(spark):
    found = spark.createDataFrame([("a", "changed", ["text"], "old  text", "n" * 100), ("b", "added", [], None, None), ("c", "same", [], "x", "x")], "key string, status string, changed_fields array<string>, l string, r string")
    lines = [(r.key, r.line, r.text) for r in reports.diff_lines(found, "key", {"text": ("l", "r")}).orderBy("key", "line").collect()]
    assert lines == [("a", 0, "changed a"), ("a", 1, f"  text: old text -> {'n' * 77}..."), ("b", 0, "added b")]
    cuts = spark.createDataFrame([("f", 4.0, True, 100.0, False), ("f", 6.0, True, 300.0, False), ("f", 1.0, False, None, True)], "f string, sec double, hit boolean, ms double, fallback boolean")
    r = reports.cut_summary(cuts, ["f"], "sec", F.col("hit"), "ms", F.col("fallback")).first()
    assert (r.segments, r.median_sec, round(r.hit_percent, 2), r.silence_median_ms, r.silence_p90_ms, r.fallbacks) == (3, 4.0, 66.67, 200.0, 280.0, 1)
    stats = spark.createDataFrame([("s", 5, 119.6)], "s string, n long, p50 double")
    assert tuple(reports.compact_pauses(stats, ["s"], "n", ["p50"]).first()) == ("s", 5, 120)


def test_next_window():
    kinds = ["weak", "strong", "weak", "strong", "strong", "weak", "strong", "strong", "final"]
    marks = [Boundary(2 * k + 1, x, 100.0, k) for k, x in enumerate(kinds)]
    source = Source([float(k) for k in range(18)], [k + 0.9 for k in range(18)], marks, Quantiles(), Quantiles(), 3, 10)
    assert [b.token for b in next_window(source, 0)] == [1, 3, 5, 7, 9, 11, 13, 15]  # three sentences, then two more
    assert [b.token for b in next_window(source, 0, least_sec=3.0)] == [1, 3, 5, 7, 9]  # long enough after one sentence, then two more
    assert [b.token for b in next_window(source, 15)] == [15, 17] and next_window(source, 18) == []


def test_quiet_boundaries():
    x = np.concatenate([tone(12), np.zeros(RATE // 2, np.float32), tone(12)])
    cut = signal.quiet_boundary(x, RATE, 0, 20 * RATE)
    assert 12 * RATE <= cut <= 12.5 * RATE
    assert signal.quiet_boundary(np.ones(20 * RATE, np.float32), RATE, 0, 15 * RATE) == 15 * RATE
    assert signal.quiet_boundary(x[:RATE], RATE, 0, 30 * RATE) == 30 * RATE
    chunks = signal.budget_chunks(x, RATE, [(0, len(x))], 15)
    assert chunks[0][0] == 0 and chunks[-1][1] == len(x) and all(a[1] == b[0] for a, b in zip(chunks, chunks[1:])) and all(z - a <= 15 * RATE for a, z in chunks)
    assert signal.budget_chunks(x, RATE, [], 15) == chunks and signal.budget_chunks(x, RATE, [], 0) == [(0, len(x))]
    assert signal.budget_chunks(x, RATE, [(0, RATE), (2 * RATE, 3 * RATE), (14 * RATE, 20 * RATE)], 15) == [(0, 3 * RATE), (14 * RATE, 20 * RATE)]
