"""Line numbers of split manifests, the file sink, resampling, windows of long signals, mel energies."""

import json
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomwright.operators import spectra
from loomwright.sources import audio, files, manifests

RATE = 8000


def tone(seconds, hz=440.0, rate=RATE, level=0.5):
    return (level * np.sin(2 * np.pi * hz * np.arange(int(seconds * rate)) / rate)).astype(np.float32)


@pytest.fixture()
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_line_numbers_hold_for_any_split(spark, tmp_path, small_splits):
    pick = random.Random(2)
    want = set()
    for name in ("a", "b b", "empty"):
        lines = [pick.choice(["", " ", f"  line {k} é", "x" * pick.randint(1, 400)]) for k in range(0 if name == "empty" else 500)]
        (tmp_path / f"{name}.txt").write_text("\n".join(lines))
        want |= {(name[0], k + 1, x.strip()) for k, x in enumerate(lines) if x.strip()}
    rows = manifests.read_lines(spark, str(tmp_path))
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
    got = {(os.path.basename(r["path"])[0], r["line"], r["raw"]) for r in rows.collect()}
    assert got == want


def test_strict_scans(spark, tmp_path):
    os.makedirs(tmp_path / "audio/x")
    (tmp_path / "audio/x/a.wav").write_bytes(b"RIFF")
    path = tmp_path / "m.jsonl"
    path.write_text('{"audio": "x/a.wav", "text": "t"}\n\n{"audio": "x/b.wav"}\n')
    assert manifests.scan_strict(spark, str(path)).count() == 2
    with pytest.raises(Exception, match="line 3: missing file"):
        manifests.scan_strict(spark, str(path), str(tmp_path / "audio")).collect()
    path.write_text("\n \n")
    with pytest.raises(ValueError, match="no records"):
        manifests.scan_strict(spark, str(path))
    assert manifests.discover(spark, str(tmp_path)).endswith("/m.jsonl")
    (tmp_path / "n.jsonl").write_text("{}")
    with pytest.raises(ValueError, match="found 2"):
        manifests.discover(spark, str(tmp_path))
    with pytest.raises(ValueError, match="found 0"):
        manifests.discover(spark, str(tmp_path), "*.other")


def tree(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names if not f.endswith(".crc"))


def test_layout_of_segments(spark, tmp_path):
    root = str(tmp_path / "out")
    rows = [("s 1", 0, "kept", b"W0", "hello", None), ("s 1", 1, "too_short", b"W1", None, '{"why": 1}'), ("s2", 0, "kept", None, "no sound", None)]
    segments = spark.createDataFrame(rows, "source_id string, segment_index int, status string, wav binary, transcript string, meta string")
    files.write_files(files.segment_files(segments), root)
    found = tree(root)
    stem = next(f for f in found if "discarded" in f).split("/")[0]
    assert found == sorted(["_SUCCESS", f"{stem}/audios/{stem}_0000.wav", f"{stem}/discarded_audios/{stem}_0001.json", f"{stem}/discarded_audios/{stem}_0001.txt", f"{stem}/discarded_audios/{stem}_0001.wav", f"{stem}/transcripts/{stem}_0000.txt", "s2/transcripts/s2_0000.txt"])
    assert open(f"{root}/{stem}/audios/{stem}_0000.wav", "rb").read() == b"W0" and open(f"{root}/s2/transcripts/s2_0000.txt").read() == "no sound"
    with pytest.raises(FileExistsError):
        files.write_files(files.segment_files(segments), root)
    files.write_files(files.segment_files(segments.withColumn("wav", F.lit(b"new"))), root, overwrite=True)
    assert open(f"{root}/{stem}/audios/{stem}_0000.wav", "rb").read() == b"new"
    traces = spark.createDataFrame([("s2", "rough", 2, "b"), ("s2", "rough", 1, "a")], "source_id string, phase string, at int, what string")
    files.write_files(files.trace_files(traces), root)
    assert [x["what"] for x in json.load(open(f"{root}/s2/traces/rough.json"))] == ["a", "b"]


def test_names_of_parts_and_speakers(spark):
    parts = spark.createDataFrame([("a", 0, 1, b""), ("b", 0, 2, b""), ("b", 1, 2, b"")], "stem string, part_index int, part_count int, wav binary")
    assert [r.path for r in files.part_files(parts).collect()] == ["a.wav", "b_part001.wav", "b_part002.wav"]
    outputs = spark.createDataFrame([("a", 1, 1, b""), ("b", 1, 2, b""), ("b", 2, 2, b"")], "stem string, speaker int, n_speakers int, wav binary")
    assert [r.path for r in files.enhanced_files(outputs).collect()] == ["a.wav", "b_s1.wav", "b_s2.wav"]


def test_failed_and_repeated_tasks_leave_whole_files(spark, tmp_path):
    rows = spark.range(40).select(F.concat(F.lit("d/"), "id").alias("path"), F.encode(F.repeat(F.lit("x"), 1000), "UTF-8").alias("content"))
    root = str(tmp_path / "out")
    bad = rows.repartition(4).withColumn("content", F.when(F.col("path") == "d/7", F.raise_error(F.lit("lost")).cast("binary")).otherwise(F.col("content")))
    with pytest.raises(Exception, match="lost"):
        files.write_files(bad, root)
    assert all(f.startswith("d/") and os.path.getsize(f"{root}/{f}") == 1000 for f in tree(root))  # no halves, no mark of success
    writer = files._Writer(root, "j", True)  # two attempts of one task, the first one killed in the middle

    def killed():
        yield {"path": "d/1", "content": b"x" * 1000}
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        writer.write(killed())
    writer.write(iter([{"path": "d/1", "content": b"x" * 1000}, {"path": "d/2", "content": b"x" * 1000}]))
    writer.commit([])
    files.write_files(rows, root, overwrite=True)
    assert tree(root) == sorted(["_SUCCESS", *(f"d/{k}" for k in range(40))]) and all(os.path.getsize(f"{root}/d/{k}") == 1000 for k in range(40))
    with pytest.raises(Exception, match="unsafe path"):
        files.write_files(rows.limit(1).withColumn("path", F.lit("../x")), root, overwrite=True)
    with pytest.raises(FileExistsError, match="two rows"):
        files.write_files(rows.withColumn("path", F.lit("same")), root, overwrite=True)


def level_db(x):
    return 20 * np.log10(np.sqrt(np.mean(np.square(x[len(x) // 4 : -len(x) // 4], dtype=np.float64))) + 1e-12)


@pytest.mark.parametrize("rate,wanted", [(48000, 16000), (44100, 16000), (48000, 44100), (16000, 8000)])
def test_no_aliases_under_60_db(rate, wanted):
    for hz in np.linspace(wanted / 2 * 1.03, rate / 2 * 0.98, 6):
        assert level_db(audio.resample(tone(1, hz, rate), rate, wanted)) < level_db(tone(1, hz, rate)) - 60, hz
    for hz in (100.0, wanted * 0.2, wanted * 0.4):
        got, want = audio.resample(tone(1, hz, rate), rate, wanted), tone(1, hz, wanted)
        assert len(got) == len(want) and np.abs(got - want)[200:-200].max() < 2e-3, hz


def test_upsampling_and_short_signals():
    got = audio.resample(tone(1, 1000, 16000), 16000, 48000)
    assert np.abs(got - tone(1, 1000, 48000))[300:-300].max() < 2e-3
    for n in (1, 2, 50):
        assert len(audio.resample(np.ones(n, np.float32), 44100, 16000)) == round(n * 16000 / 44100)
    assert np.allclose(audio.resample(np.ones(4000, np.float32), 44100, 16000)[200:-200], 1, atol=1e-4)


def identity():
    return lambda x: x


def clipped():
    return lambda x: np.clip(x * 2, -0.4, 0.4)


@pytest.mark.parametrize("seconds", [0.0, 1.0, 21.0, 25.3, 24.0])
def test_windows_stitch_to_the_whole_signal(spark, seconds):
    x = tone(seconds, 300) * np.linspace(0.1, 1, int(seconds * RATE)).astype(np.float32)
    rows = spark.createDataFrame([("a", audio.encode_wav(x, RATE)), ("bad", b"zz")], "stem string, content binary")
    for model in (identity, clipped):
        got = {r.stem: r for r in spectra.enhanced(rows, RATE, model).collect()}
        whole = audio.decode_wav(audio.encode_wav(model()(audio.decode_wav(audio.encode_wav(x, RATE))[0]), RATE))[0]
        assert np.allclose(audio.decode_wav(got["a"].wav)[0], whole, atol=1e-4) and got["bad"].wav is None and got["bad"].problem
    assert spectra.signal_windows(rows, RATE).where("stem = 'a'").count() == (1 if seconds <= 20 else 1 + -(-(int(seconds * RATE) - 4 * RATE) // (3 * RATE)))


def plain_fbank(signal, rate, bands):
    """One frame at a time, by a direct transform."""
    length, hop, size = round(rate * 0.025), round(rate * 0.01), 1
    while size < length:
        size *= 2
    mel = lambda f: 1127.0 * np.log(1 + f / 700.0)
    edges = [mel(20.0) + (mel(rate / 2) - mel(20.0)) * k / (bands + 1) for k in range(bands + 2)]
    turn = np.exp(-2j * np.pi * np.outer(np.arange(size // 2 + 1), np.arange(length)) / size)
    out = []
    for a in range(0, len(signal) - length + 1, hop):
        x = signal[a : a + length].astype(np.float64)
        x = x - x.mean()
        y = np.array([x[k] - 0.97 * x[max(0, k - 1)] for k in range(length)])
        y *= [0.54 - 0.46 * np.cos(2 * np.pi * k / (length - 1)) for k in range(length)]
        power = np.abs(turn @ y) ** 2
        row = []
        for b in range(bands):
            lo, mid, hi = edges[b : b + 3]
            weight = [max(0.0, min((m - lo) / (mid - lo), (hi - m) / (hi - mid))) for m in (mel(k * rate / size) for k in range(size // 2 + 1))]
            row.append(np.log(max(np.dot(power, weight), np.finfo(np.float32).eps)))
        out.append(row)
    return np.array(out)


def test_mel_energies_equal_a_direct_transform(spark):
    x = tone(0.3, 700) + np.random.default_rng(1).normal(0, 0.01, int(0.3 * RATE)).astype(np.float32)
    content = audio.encode_wav(x, RATE)
    rows = spectra.fbank_frames(spark.createDataFrame([("a", content), ("bad", b"")], "stem string, content binary"), RATE, 23).collect()
    want = plain_fbank(audio.decode_wav(content)[0], RATE, 23)
    got = np.array([r.mel for r in sorted((r for r in rows if r.stem == "a"), key=lambda r: r.frame)])
    assert got.shape == want.shape and np.allclose(got, want, atol=2e-3)
    assert [r.problem is not None for r in rows if r.stem == "bad"] == [True]
    assert spectra.fbank(x[:10], RATE).shape == (0, 80)


def test_spectra_and_their_compression():
    x = tone(1, 500)
    s = spectra.stft(x[:4096])
    assert np.allclose(spectra.istft(s, 4096), x[:4096], atol=1e-6)
    assert np.allclose(spectra.compressed(spectra.compressed(s), 1 / 0.3), s, atol=1e-6)
    assert np.allclose(np.abs(spectra.compressed(s)), np.abs(s) ** 0.3)
