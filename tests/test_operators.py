"""Text rules, activity, levels, manifests and audio on small inputs."""

import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loomwright.functions import levels, tables
from loomwright.functions import text as T
from loomwright.operators import activity, manifests, pauses, speakers, volume
from loomwright.sources import audio
from loomwright.sources import manifests as sources


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("char,silent", [(" ", True), ("。", True), ("＋", True), ("a", False), ("<", False), ("《", False), ("（", False), ("字", False), ("\x1c", True), ("，", True)])
def test_silent(spark, char, silent):
    assert one(spark, T.is_silent(F.lit(char))) == silent


def test_text_rules(spark):
    assert one(spark, T.spoken(F.lit("a, b。（c）"))) == "ab（c）"
    assert one(spark, T.run_after(F.lit("ab?, c"), F.lit(1))) == "?, "
    assert one(spark, T.run_after(F.lit("ab  c"), F.lit(1))) == ""
    assert [one(spark, T.pause_category(F.lit(x))) for x in ("，？", "?,", "：", "")] == ["weak", "strong", "no_punc", "no_punc"]
    assert [one(spark, T.boundary_kind(F.lit(x))) for x in ("，？", ",", "：", " ")] == ["strong", "weak", "weak", None]
    assert one(spark, T.safe_stem(F.lit("a b/ç.wav"))) == "a_b_.wav"
    assert [one(spark, T.unsafe_path(F.lit(x))) for x in ("a/b", "/a", "a/../b", "..", "a..b")] == [False, True, True, True, False]
    assert one(spark, T.extension(F.lit("WAV"))) == ".wav"


def test_levels(spark):
    assert one(spark, levels.dbfs(F.lit(0.1))) == pytest.approx(-20)
    assert one(spark, levels.gain(F.lit(-20.0))) == pytest.approx(0.1)
    assert one(spark, levels.percent(F.lit(1), F.lit(0))) == 0
    assert one(spark, levels.rms(F.array(F.lit(3.0), F.lit(-4.0)))) == pytest.approx(np.sqrt(12.5))
    assert one(spark, levels.peak(F.array(F.lit(3.0), F.lit(-4.0)))) == 4
    assert one(spark, levels.nearly_equal(F.lit(1.0), F.lit(1.0 + 1e-12), 0.0))
    with pytest.raises(Exception, match="no finite length"):
        one(spark, levels.unit(F.array(F.lit(0.0))))


def test_quantiles_and_ranks(spark):
    values = [5.0, 1.0, 4.0, 4.0, 9.0, 2.0, 7.5]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    points = [0.05, 0.25, 0.5, 0.8]
    assert tables.quantiles(df, "v", points) == pytest.approx(np.quantile(values, points))
    assert tables.quantiles(df.limit(0), "v", points) is None
    ranks = tables.with_rank(df.where("v is not null"), [F.col("v")], "r").collect()
    assert [r.v for r in sorted(ranks, key=lambda r: r.r)] == sorted(values) and {r.r for r in ranks} == set(range(1, 8))


def test_pause_fallback(spark):
    rows = [("a", k, k * 1.0, k * 1.0 + 0.5) for k in range(6)] + [("a", 6, 9.5, 9.9)]
    found = pauses.token_pauses(spark.createDataFrame(rows, "source_id string, idx int, start_sec double, end_sec double"))
    assert [r.pause_ms for r in found.orderBy("idx").collect()] == pytest.approx([500] * 5 + [4000])
    stats = {r.category: r for r in pauses.pause_quantiles(found.withColumn("category", F.lit("weak"))).collect()}
    assert stats["weak"].n == 5 and not stats["weak"].is_fallback and stats["weak"].p80 == 500
    assert stats["strong"].is_fallback and stats["strong"].p5 == 150


def test_speakers(spark):
    rng = np.random.default_rng(1)
    rows = [(k, (np.array([1.0, 0, 0]) + rng.normal(0, 0.05, 3)).tolist()) for k in range(40)] + [(99, [-1.0, 0.2, 0.0])]
    df = spark.createDataFrame(rows, "id long, embedding array<double>")
    pruned = {r.id for r in speakers.prune_outliers(speakers.cosine_scores(df), F.col("id")).where("pruned").collect()}
    assert 99 in pruned and len(pruned) <= 4
    assert speakers.prune_outliers(speakers.cosine_scores(df.limit(5)), F.col("id")).where("pruned").count() == 0
    assert speakers.prune_outliers(speakers.cosine_scores(df), F.col("id"), ratio=0).where("pruned").count() == 0


def frame(spark, rows, names="start long, end long"):
    return spark.createDataFrame([("a", *r) for r in rows], f"k string, {names}")


def pairs(df):
    return sorted((r.start, r.end) for r in df.collect())


def test_intervals(spark):
    rows = frame(spark, [(0, 5), (3, 4), (5, 8), (20, 30)])
    assert pairs(activity.merge_intervals(rows, "k")) == [(0, 8), (20, 30)]
    assert pairs(activity.subtract_intervals(frame(spark, [(0, 40)]), rows, "k")) == [(8, 20), (30, 40)]
    assert pairs(activity.subtract_intervals(frame(spark, [(50, 60)]), rows, "k")) == [(50, 60)]
    assert pairs(activity.split_fixed(frame(spark, [(0, 25)]), "start", "end", 10)) == [(0, 10), (10, 20), (20, 25)]
    packed = activity.pack_regions(frame(spark, [(0, 4), (5, 9), (11, 30), (31, 33)]), "k", 10).orderBy("chunk").collect()
    assert [(r.start, r.end, r.n) for r in packed] == [(0, 9, 2), (11, 30, 1), (31, 33, 1)]


def test_packing_cuts_long_regions_where_it_is_quiet(spark):
    levels = [(t, 5.0 + t % 3 - 4 * (t in (17, 24, 26))) for t in range(34)]
    regions = frame(spark, [(0, 4), (5, 9), (11, 30), (31, 33)])
    rows = spark.createDataFrame([(k, *x) for k in "ab" for x in levels] + [("a", 18, None), ("c", 3, 1.0)], "k string, t long, v double")
    got = {}
    for r in activity.pack_levels(regions, rows, "k", 10, 4, "t", "v").orderBy("k", "chunk").collect():
        got.setdefault(r.k, []).append((r.start, r.end, r.n))
    assert got["a"] == [(0, 9, 2), (11, 17, 1), (17, 24, 1), (24, 33, 2)]
    # no regions: cut all over, each cut at the least level from 4 after the last one until before 10
    assert [b for _, b, _ in got["b"]][-1] == 33 and all(b - a <= 10 and n == 0 for a, b, n in got["b"])
    assert [a for a, _, _ in got["b"]] == [0, *(b for _, b, _ in got["b"][:-1])] and {17, 24} <= {a for a, _, _ in got["b"]}
    assert got["c"] == [(3, 3, 0)]
    flat = spark.createDataFrame([("a", t, 1.0) for t in range(34)], "k string, t long, v double")
    cuts = activity.pack_levels(frame(spark, [(0, 25)]), flat, "k", 10, 4, "t", "v").orderBy("chunk").collect()
    assert [(r.start, r.end) for r in cuts] == [(0, 10), (10, 20), (20, 25)]


def test_region_packing_query_keeps_the_budget(spark, sf):
    from loomwright.plans import catalogue

    rows = catalogue.QUERIES["region_packing"](spark, sf).collect()
    assert rows and all(0 <= r.end - r.start <= 259_200 for r in rows)


def test_overlaps(spark):
    rng = np.random.default_rng(2)
    left = sorted({(int(a), int(a + d)) for a, d in zip(rng.integers(0, 300, 40), rng.integers(1, 90, 40))})
    right = sorted({(int(a), int(a + d)) for a, d in zip(rng.integers(0, 300, 40), rng.integers(1, 90, 40))})
    got = activity.overlaps(frame(spark, left), frame(spark, right), "k", 25.0).collect()
    want = sorted((max(a, c), min(b, d)) for a, b in left for c, d in right if a < d and c < b)
    assert sorted((r.overlap_start, r.overlap_end) for r in got) == want


def test_volume(spark):
    rows = spark.createDataFrame([("a", 1.0, 1.0), ("a", 2.0, 1.0), ("a", 9.0, 5.0), ("a", 0.0, -3.0)], "k string, v double, w double")
    assert volume.weighted_median(rows, "k", "v", "w").first().weighted_median == 9.0
    why = volume.prune_reasons(F.lit(-50.0), F.lit(3.0), F.lit(0.1), F.lit(50.0), -23.0, 20.0, 1.0, 0.3, 35.0)
    assert one(spark, why) == ["too_quiet", "would_clip", "inactive", "too_dynamic"]
    t = np.arange(48_000 * 2) / 48_000
    assert volume.integrated_loudness(np.sin(2 * np.pi * 997 * t), 48_000) == pytest.approx(-3.01, abs=0.05)
    with pytest.raises(ValueError):
        volume.integrated_loudness(np.zeros(10), 48_000)
    out, gain = volume.restore_gain(np.array([0.1, -0.2]), np.array([0.2, -0.4]), "rms-peak")
    assert gain == pytest.approx(2.0) and out.tolist() == pytest.approx([0.2, -0.4])


def test_manifest_scans(spark, tmp_path):
    lines = ['{"audio": "a.wav", "text": "é", "duration": 1.5, "extra": 1}', "", "not json", "[1]", '{"text": "x"}', '{"audio": "/abs.wav"}', '{"audio": "../up.wav"}', '{"audio": "a.wav"}']
    (tmp_path / "m.jsonl").write_text("\n".join(lines), encoding="utf-8")
    rows = sources.scan(spark, str(tmp_path / "m.jsonl")).orderBy("line").collect()
    assert [(r.line, r.problem) for r in rows] == [(1, None), (3, "invalid JSON"), (4, "not an object"), (5, "missing audio"), (6, "unsafe path"), (7, "unsafe path"), (8, None)]
    assert rows[0].raw == lines[0] and rows[0].duration == 1.5
    keys = [r.unique_key for r in sources.scan_lenient(spark, str(tmp_path / "m.jsonl")).orderBy("line").collect()]
    assert keys == ["a.wav", "_line:5", "/abs.wav", "../up.wav", "a.wav#2"]
    with pytest.raises(Exception, match="line 3: invalid JSON"):
        sources.scan_strict(spark, str(tmp_path / "m.jsonl")).collect()


def test_writers(spark, tmp_path):
    rows = spark.createDataFrame([("b", "ü", 2.34567), ("a", "x", 1.0)], "audio string, text string, duration double")
    sources.write_jsonl(rows, str(tmp_path / "j"), ["audio", "text", "duration"], ["audio"])
    got = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "j")).collect()]
    assert sorted(x["duration"] for x in got) == [1.0, 2.346]
    sources.write_tsv(rows, str(tmp_path / "t"), ["audio", "duration"], ["audio"])
    assert {(r.audio, r.duration) for r in sources.read_tsv(spark, str(tmp_path / "t"), "audio string, duration string").collect()} == {("a", "1.000"), ("b", "2.346")}
    with pytest.raises(Exception, match="already exists"):
        sources.write_tsv(rows, str(tmp_path / "t"), ["audio"], ["audio"])


def test_manifest_diff(spark):
    left = spark.createDataFrame([(1, "a", 1.0), (2, "b", 1.0), (3, "c", 1.0)], "k int, t string, d double")
    right = spark.createDataFrame([(1, "a", 1.0 + 1e-9), (2, "B", 2.0), (4, "d", 1.0)], "k int, t string, d double")
    got = {r.k: (r.status, r.changed_fields) for r in manifests.diff(left, right, "k", ["t", "d"], {"d": 1e-6}).collect()}
    assert got == {1: ("same", []), 2: ("changed", ["t", "d"]), 3: ("removed", []), 4: ("added", [])}


def test_audio(spark, tmp_path):
    rate = 8000
    t = np.arange(rate) / rate
    tone = (0.5 * np.sin(2 * np.pi * 440 * t)).astype(np.float32)
    signal = np.concatenate([tone, np.zeros(rate, np.float32), tone])
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "A.WAV").write_bytes(audio.encode_wav(signal, rate))
    (tmp_path / "bad.wav").write_bytes(b"not real audio")
    (tmp_path / "note.txt").write_text("x")
    decoded, got = audio.decode_wav(audio.encode_wav(signal, rate))
    assert got == rate and np.allclose(decoded, signal, atol=1e-3)
    files = audio.scan(spark, str(tmp_path))
    assert files.count() == 2 and audio.duplicate_stems(files).count() == 0
    frames = audio.frames(files, rate)
    assert frames.where("problem is not null").count() == 1
    runs = activity.true_runs(frames.where("problem is null"), "stem", ["idx"], F.col("rms") < 0.01).collect()
    assert len(runs) == 1 and abs(runs[0].run_length - 200) <= 5
    assert audio.trim(np.concatenate([np.zeros(8000), tone, np.zeros(8000)]))[0] == pytest.approx(8000, abs=2048)
    assert audio.trim(np.zeros(100)) == (0, 0)
    assert isinstance(frames.toPandas(), pd.DataFrame)
