"""Transcripts, signals, models, streams and settings on small inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomwright.operators import models, signal, transcripts
from loomwright.operators.pauses import NAMES
from loomwright.sources import audio
from loomwright.sources import files as files_
from loomwright.sources.config import Settings
from loomwright.streaming import regions
from tests.plain_signal import silence_chunks

RATE = 8000


def tone(seconds, level=0.5):
    return (level * np.sin(2 * np.pi * 440 * np.arange(int(RATE * seconds)) / RATE)).astype(np.float32)


def quiet(seconds):
    return np.zeros(int(RATE * seconds), np.float32)


@pytest.fixture(scope="module")
def spoken(spark):
    texts = spark.createDataFrame([("s", "a,b. cd？e"), ("t", "")], "source_id string, text string")
    tokens = spark.createDataFrame([("s", k, c, 0.5 * k, 0.5 * k + 0.4) for k, c in enumerate("abcde")], "source_id string, idx int, char string, start_sec double, end_sec double")
    return texts, tokens, transcripts.align(texts, tokens)


def test_align_and_boundaries(spoken):
    texts, tokens, aligned = spoken
    assert {r.idx: r.positions for r in aligned.collect()} == {0: [0], 1: [2], 2: [5], 3: [6], 4: [8]}
    marks = transcripts.boundaries(texts, aligned)
    assert {r.idx: (r.category, r.kind) for r in marks.collect()} == {0: ("weak", "weak"), 1: ("strong", "strong"), 2: ("no_punc", None), 3: ("strong", "strong"), 4: ("no_punc", "final")}
    numbered = transcripts.sentences(marks)
    assert [r.sentence for r in numbered.orderBy("idx").collect()] == [0, 0, 1, 1, 2]
    groups = transcripts.sentence_groups(numbered, 2, 1).collect()
    assert {(r.sentence, r.group_id, r.core) for r in groups} == {(0, 0, True), (1, 0, True), (1, 1, False), (2, 1, True), (2, 0, False)}


def test_segment_texts(spark, spoken):
    texts, tokens, aligned = spoken
    segments = spark.createDataFrame([("s", 0, 1), ("s", 2, 4), ("u", 0, 0)], "source_id string, first_token int, last_token int")
    got = {(r.source_id, r.first_token): r.transcript for r in transcripts.segment_texts(segments, texts, aligned, tokens).collect()}
    assert got == {("s", 0): "a,b.", ("s", 2): "cd？e", ("u", 0): ""}


def test_edits(spark, spoken):
    texts, _, aligned = spoken
    pauses = spark.createDataFrame([("s", 0, 5.0), ("s", 1, 900.0), ("s", 2, 900.0), ("s", 3, 5.0)], "source_id string, idx int, pause_ms double")
    q = F.struct(*(F.lit(float(50 + k)).alias(n) for k, n in enumerate(NAMES)))
    stats = spark.createDataFrame([("s",)], "source_id string").select("source_id", q.alias("strong"), q.alias("weak"), q.alias("no_punc"))
    edits = transcripts.punctuation_edits(texts, aligned, pauses, stats)
    got = {r.source_id: (r.corrected, r.n_edits) for r in transcripts.apply_edits(texts, edits).collect()}
    assert got == {"s": ("ab. c，de", 3), "t": ("", 0)}
    bad = spark.createDataFrame([("s", 0, 1, "")], "source_id string, at int, upto int, mark string")
    assert {r.corrected for r in transcripts.apply_edits(texts, bad).collect()} == {"a,b. cd？e", ""}


def test_ranges_and_stitch(spark):
    rows = spark.createDataFrame([("s", 0, 2), ("s", 3, 4), ("s", 6, 7), ("s", 6, 6)], "source_id string, first int, last int")
    assert sorted((r["first"], r["last"]) for r in transcripts.merged_ranges(rows).collect()) == [(0, 4), (6, 7)]
    chunks = spark.createDataFrame([("s", 1, 10.0, " b "), ("s", 0, 0.0, "a"), ("s", 2, 20.0, " ")], "source_id string, chunk int, start_sec double, text string")
    tokens = spark.createDataFrame([("s", 1, 0, "b", 0.5, 0.9), ("s", 0, 0, "a", 0.1, 0.2)], "source_id string, chunk int, idx int, char string, start_sec double, end_sec double")
    whole, moved = transcripts.stitch(chunks, tokens)
    assert whole.first().text == "a b"
    assert [(r.idx, r.char, r.start_sec) for r in moved.orderBy("idx").collect()] == [(0, "a", 0.1), (1, "b", 10.5)]


def test_chunks_cut_in_silence():
    x = np.concatenate([tone(6), quiet(0.5), tone(7), quiet(0.5), tone(9)])
    chunks = silence_chunks(x, RATE, 5, 10)
    assert chunks[0][0] == 0 and chunks[-1][1] == len(x) and all(a[1] == b[0] for a, b in zip(chunks, chunks[1:]))
    assert 6 * RATE <= chunks[0][1] <= 6.5 * RATE and all(b - a <= 10 * RATE for a, b in chunks)
    assert silence_chunks(quiet(0), RATE) == []


def test_speech_and_silence():
    x = np.concatenate([quiet(1), tone(2), quiet(1), tone(1), quiet(1)])
    found = signal.speech_regions(x, RATE)
    # frames of 2048 every 512, centred: the first that meets the tone is 14, the last 48; 0.2 s on both sides
    assert len(found) == 2 and found[0] == (14 * 512 - 1600, 49 * 512 + 1600)
    assert signal.speech_regions(quiet(1), RATE) == [(0, RATE)] and signal.speech_regions(quiet(0), RATE) == []  # no frame is under the loudest
    spans = signal.low_energy_spans(x, RATE, 0.5, 4.9)
    assert any(abs(a - 3) < 0.05 and abs(z - 4) < 0.05 for a, z in spans)
    assert signal.low_energy_spans(quiet(2), RATE, 0, 2) == []
    assert signal.silence_around(np.concatenate([tone(1), quiet(0.3), tone(1)]), RATE, 1.1, 1.15) == pytest.approx(300, abs=45)
    assert signal.silence_around(tone(0.01), RATE, 0.0, 0.2) == pytest.approx(200)


def test_edges_and_windows():
    start, end = signal.edge_features(np.concatenate([tone(0.5), quiet(0.5)]), RATE)
    assert start[1] > 0.3 and end[1] == 0 and start[5] > 0


def test_files(spark, tmp_path):
    (tmp_path / "a.wav").write_bytes(audio.encode_wav(np.concatenate([tone(2), quiet(1), tone(2)]), RATE))
    (tmp_path / "b.wav").write_bytes(b"junk")
    files = audio.scan(spark, str(tmp_path))
    for found, n in ((signal.speech_files(files, RATE), 2), (signal.edges_of_files(files), 2), (signal.longest_run_files(files, RATE, 1, 3), 2), (signal.budget_files(files, 2.0, RATE), 3), (signal.gap_cut_files(files, RATE, 1, 3, 2), 2), (signal.level_files(files), 1), (signal.speech_levels(files, RATE), 1)):
        rows = found.collect()
        assert sum(r.problem is None for r in rows) >= n and [r.stem for r in rows if r.problem is not None] == ["b"]
    rows = signal.chunk_files(files, RATE, 1, 3).collect()
    assert sum(r.problem is None for r in rows) >= 2 and [r.stem for r in rows if r.problem] == ["b"]
    assert {r.side for r in signal.edges_of_files(files).where("problem is null").collect()} == {"start", "end"}


def test_even_parts_as_files(spark, tmp_path):
    x = np.concatenate([tone(9), quiet(0.5), tone(10)])
    rows = spark.createDataFrame([("a", audio.encode_wav(x, RATE)), ("s", audio.encode_wav(tone(2), RATE)), ("bad", b"")], "stem string, content binary")
    parts = signal.even_part_files(rows, 10)
    files_.write_files(files_.part_files(parts.where("problem is null")), str(tmp_path / "o"))
    first, second = (audio.decode_wav((tmp_path / f"o/a_part00{k}.wav").read_bytes())[0] for k in (1, 2))
    assert len(first) + len(second) == len(x) and 9 * RATE <= len(first) <= 9.5 * RATE
    assert (tmp_path / "o/s.wav").exists() and [r.stem for r in parts.where("problem is not null").collect()] == ["bad"]


def test_silences_at_marks(spark):
    x = np.concatenate([tone(1), quiet(0.3), tone(1)])
    rows = spark.createDataFrame([("a", audio.encode_wav(x, RATE)), ("bad", b""), ("none", b"")], "stem string, content binary")
    marks = spark.createDataFrame([("a", 0, 1.1, 1.15), ("a", 1, 0.3, 0.3), ("bad", 0, 0.0, 0.0)], "stem string, idx long, left_end_sec double, right_start_sec double")
    got = {(r.stem, r.idx): r.silence_ms for r in signal.mark_silences(rows, marks).collect()}
    assert got["a", 0] == pytest.approx(300, abs=45) and got["a", 1] == signal.silence_around(audio.decode_wav(audio.encode_wav(x, RATE))[0], RATE, 0.3, 0.3) and ("bad", None) in got and len(got) == 3


def test_library_target_and_gains(spark):
    loud, low = tone(3, 0.5), tone(1, 0.05)
    rows = spark.createDataFrame([("a", audio.encode_wav(loud, RATE)), ("b", audio.encode_wav(low, RATE)), ("c", audio.encode_wav(quiet(1), RATE))], "stem string, content binary")
    levels = {r.stem: r for r in signal.speech_levels(rows, RATE).collect()}
    assert set(levels) == {"a", "b"} and levels["a"].speech_dbfs == pytest.approx(20 * np.log10(0.5 / 2**0.5), abs=0.3) and levels["a"].peak_dbfs == pytest.approx(-6.02, abs=0.05)
    assert signal.library_target(signal.speech_levels(rows, RATE)).first().target == pytest.approx(min(levels["a"].speech_dbfs, levels["a"].safe_dbfs, levels["b"].safe_dbfs))
    outputs = rows.selectExpr("stem", "content as wav").where("stem <> 'c'").replace("a", "t", "stem").replace("b", "a", "stem").replace("t", "b", "stem")
    for mode, target in (("rms", None), ("peak", None), ("none", None), ("target-rms", -20.0), ("target-peak", -3.0), ("target-rms", 0.0)):
        got = {r.stem: r for r in signal.restored_files(rows, outputs, mode, target).collect()}
        y = {k: audio.decode_wav(r.content)[0] for k, r in got.items()}
        if mode in ("rms", "peak"):
            assert np.abs(y["a"]).max() == pytest.approx(0.5, abs=0.01) and np.abs(y["b"]).max() == pytest.approx(0.05, abs=0.005)
        elif mode == "none":
            assert got["a"].gain == 1 and got["a"].reason == "disabled"
        elif target == -20:
            assert 20 * np.log10(np.sqrt(np.mean(y["a"] ** 2))) == pytest.approx(-20, abs=0.1)
        else:
            assert np.abs(y["a"]).max() == pytest.approx(10 ** (min(target, -1.0) / 20), abs=0.01) and (target < 0 or "limited" in got["a"].reason)


def test_abrupt_edges(spark):
    rng = np.random.default_rng(2)
    smooth = [np.concatenate([quiet(0.3), tone(0.5) * rng.uniform(0.5, 1), quiet(0.3)]) + rng.normal(0, 1e-4, int(1.1 * RATE)).astype(np.float32) for _ in range(9)]
    rows = spark.createDataFrame([(f"s{k}", audio.encode_wav(x, RATE)) for k, x in enumerate(smooth)] + [("cut", audio.encode_wav(tone(0.5), RATE)), ("bad", b"")], "stem string, content binary")
    edges = signal.abrupt_edges(rows)
    got = {(r.stem, r.side): r for r in edges.collect()}
    assert len(got) == 20 and got["cut", "start"].likelihood > 0.9 and all(r.likelihood < 0.9 for (s, _), r in got.items() if s != "cut")
    logs = np.array([np.log10(got[s, "end"].edge_rms + 1e-8) for s in sorted({s for s, _ in got})])
    z = 0.67448975 * (logs - np.median(logs)) / np.median(np.abs(logs - np.median(logs)))
    assert z.argmax() == sorted({s for s, _ in got}).index("cut")


def test_manifest_of_the_volume_tool(spark):
    from loomwright.operators import loudness

    rows = spark.createDataFrame([("a", audio.encode_wav(tone(2, 0.1), RATE)), ("b", b"")], "stem string, content binary")
    measured = loudness.measure_files(rows).cache()
    written = loudness.normalise_files(rows, loudness.decide(measured, -20.0))
    records = spark.createDataFrame([("a", 1, "x/a.wav", "o/a.wav", '{"id": 7, "audio": "x/a.wav", "t": "é"}'), ("b", 2, "x/b.wav", "o/b.wav", "[]")], "stem string, jsonl_row int, source_audio string, output_audio string, payload string")
    m = loudness.normalised_manifest(measured, written, records).collect()
    assert len(m) == 1 and len(m[0]) == 10 and m[0].duration_sec == "2.000" and m[0].source_sample_rate == RATE and m[0].source_lufs[-4] == "."
    assert [r.payload for r in loudness.moved_records(records).collect()] == ['{"id": 7, "audio": "o/a.wav", "t": "é"}', "[]"]


def test_models(spark):
    rows = spark.createDataFrame([(k, "x" * k) for k in range(5)], "id int, text string")
    got = models.apply_model(rows, ["text"], "label", "string", "labels", lambda: models.scripted_labeler({"xx": "good"}), "id").collect()
    assert {r.id: r.label for r in got} == {0: "ok", 1: "ok", 2: "good", 3: "ok", 4: "ok"}

    def broken():
        def fail(_):
            raise RuntimeError("no model")

        return fail

    assert {r.label_problem for r in models.apply_model(rows, ["text"], "label", "string", "broken", broken).collect()} == {"RuntimeError: no model"}
    assert models.even_aligner()([("abcd", 2.0)]) == [[0, 0.5, 1.0, 1.5]]
    assert len(models.fixed_rate_transcriber()([(bytes(4 * 16000), 16000)])[0]) == 4
    assert np.linalg.norm(models.hashed_embedder()([("a",)])[0]) == pytest.approx(1)


def test_stream(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    events.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    q = regions.session_regions(stream, "user_id", "ts", "5 hours", "1 hour").writeStream.outputMode("append").format("memory").queryName("regions").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    got = spark.sql("SELECT count(*) AS n, sum(n) AS events FROM regions").first()
    assert 0 < got.n and got.events <= events.count()
    levels = regions.window_levels(stream, "ts", "value", "1 hour", "30 minutes", "1 hour")
    q = levels.writeStream.outputMode("append").format("memory").queryName("levels").option("checkpointLocation", str(tmp_path / "d")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("levels").count() > 0


def test_settings(tmp_path):
    (tmp_path / "e").write_text("# x\nA=1\nexport B='two'\nC=0.5\nD=yes\nE=\nbad\n")
    s = Settings.load(str(tmp_path / "e"))
    assert (s.whole("A", 0), s.text("B"), s.number("C", 0), s.flag("D"), s.text("E", "d"), s.whole("B", 7)) == (1, "two", 0.5, True, "d", 7)
    assert Settings.load(str(tmp_path / "none")).values == {}


def test_trim_and_cut(spark, tmp_path):
    x = np.concatenate([quiet(1), tone(2), quiet(1), tone(1), quiet(2)])
    (tmp_path / "a.wav").write_bytes(audio.encode_wav(x, RATE))
    files = audio.scan(spark, str(tmp_path))
    rough = spark.createDataFrame([("a", 0, 0.0, 4.0), ("a", 1, 4.0, 5.5), ("a", 2, 5.5, 7.0)], "stem string, segment_index long, start_sec double, end_sec double")
    cut = {r.segment_index: r for r in signal.trim_segments(files, rough).collect()}
    assert cut[0].cut_start_sec == pytest.approx(0.8, abs=0.2) and cut[0].cut_end_sec == pytest.approx(3.2, abs=0.2)
    assert cut[2].problem == "trim_empty" and cut[2].cut_end_sec == 7.0
    segments = signal.trim_segments(files, rough).withColumn("status", F.lit("kept"))
    for r in signal.cut_segments(files, segments).collect():
        y, rate = audio.decode_wav(r.wav)
        assert rate == RATE and len(y) / rate == pytest.approx(cut[r.segment_index].cut_end_sec - cut[r.segment_index].cut_start_sec, abs=0.01)


def test_more_signals(spark, tmp_path):
    parts, forced = signal.split_at_gaps([(0, 6 * RATE), (7 * RATE, 20 * RATE), (20 * RATE, 40 * RATE)], 0, 40 * RATE, RATE)
    assert parts[0] == (0, int(6.5 * RATE)) and parts[-1][1] == 40 * RATE and forced >= 1
    assert all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
    x = np.concatenate([tone(9), quiet(0.5), tone(10)])
    (cut, method), = signal.even_cuts(x, RATE, 10)
    assert 9 <= cut <= 9.5 and method == "longest_silence"
    y, back = signal.level_to(tone(1, 0.01), RATE)
    assert np.allclose(y * back, tone(1, 0.01), atol=1e-6) and np.sqrt(np.mean(y**2)) == pytest.approx(10 ** (-25 / 20), rel=0.1)
    (tmp_path / "d").mkdir()
    for n in "ab":
        (tmp_path / "d" / f"{n}.wav").write_bytes(audio.encode_wav(tone(0.1), RATE))
    (tmp_path / "list.scp").write_text("utt1 a.wav\n\n")
    assert [r.stem for r in audio.scan_list(spark, str(tmp_path / "list.scp"), str(tmp_path / "d")).collect()] == ["a"]


def test_names(spark):
    from loomwright.functions.text import first_mismatch
    from loomwright.operators import manifests

    df = spark.createDataFrame([("abc", "abd"), ("ab", "abc"), ("x", "x")], "a string, b string")
    assert [r.x for r in df.select(first_mismatch(F.col("a"), F.col("b")).alias("x")).collect()] == [2, 2, None]
    names = spark.createDataFrame([("n", 1), ("n", 2), ("m", 3)], "name string, k int")
    assert sorted(r.unique_name for r in manifests.unique_names(names, "name", ["k"]).collect()) == ["m", "n", "n__dup2"]
    sides = spark.createDataFrame([("f", "start", 1.0), ("f", "end", 1.0), ("g", "end", 2.0), ("g", "start", 1.0)], "file string, side string, score double")
    assert {(r.file, r.side) for r in manifests.worst_of_each(sides, "file", "side", "score").collect()} == {("f", "start"), ("g", "end")}


def test_revision_and_bounds(spark):
    df = spark.createDataFrame([("a,b", "a。b"), ("ab", "a c")], "x string, y string")
    assert [r.z for r in df.select(transcripts.accepted_revision(F.col("x"), F.col("y")).alias("z")).collect()] == ["a。b", "ab"]
    rows = spark.createDataFrame([("s", 0, 0.0, 1.0), ("s", 1, 1.1, 2.0), ("s", 2, 5.0, 6.0)], "source_id string, idx int, start_sec double, end_sec double")
    got = [(r.opens_sec, r.closes_sec) for r in transcripts.padded_bounds(rows).orderBy("idx").collect()]
    assert got == [(0.0, pytest.approx(1.05)), (pytest.approx(1.05), pytest.approx(2.1)), (pytest.approx(4.9), 6.0)]
