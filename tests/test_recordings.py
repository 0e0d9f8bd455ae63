"""Decoding beyond integer WAV, voices of a separator, and recordings made of texts."""

import struct
import sys
import types

import numpy as np
import pytest

from loomwright.operators import signal
from loomwright.plans import recordings
from loomwright.sources import audio
from loomwright.sources import files as files_
from tests.plain_signal import silence_chunks


def riff(tag, bits, channels, data, own=None, between=b""):
    """A RIFF file; ``own``: the tag within an extensible format."""
    fmt = struct.pack("<HHIIHH", tag, channels, 8000, 8000 * channels * bits // 8, channels * bits // 8, bits)
    if own is not None:
        fmt += struct.pack("<HHI", 22, bits, 0) + struct.pack("<H", own) + b"\0\0\0\0\x10\0\x80\0\0\xaa\0\x38\x9b\x71"
    body = b"fmt " + struct.pack("<I", len(fmt)) + fmt + between + b"data" + struct.pack("<I", len(data)) + data
    return b"RIFF" + struct.pack("<I", 4 + len(body)) + b"WAVE" + body


@pytest.mark.parametrize(("bits", "own"), [(32, None), (64, None), (32, 3), (64, 3)])
def test_float_wav(bits, own):
    pairs = np.array([[0.5, 0.25], [-0.5, 0.0], [1.5, 0.5]])  # over full scale: floats may be
    data = pairs.astype(f"<f{bits // 8}").tobytes()
    odd = b"LIST" + struct.pack("<I", 3) + b"abc\0"  # an odd chunk is padded
    x, rate = audio.decode(riff(0xFFFE if own else 3, bits, 2, data, own, odd))
    assert rate == 8000 and x.dtype == np.float32 and x.tolist() == [0.375, -0.25, 1.0]
    cut = audio.decode(riff(3, bits, 2, data)[:-5])[0]  # a file that breaks off keeps its whole frames
    assert cut.tolist() == [0.375, -0.25]
    assert audio.decode(riff(3, bits, 1, b""))[0].tolist() == []


def test_integer_wav_goes_on_to_the_standard_library():
    x = np.array([0.0, 0.5, -0.5], np.float32)
    assert np.allclose(audio.decode(audio.encode_wav(x, 8000))[0], x, atol=1e-4)
    with pytest.raises(Exception, match=".+"):
        audio.decode(riff(7, 8, 1, b"\0\0"))  # a codec that nothing here reads


def test_other_formats_need_soundfile(monkeypatch):
    monkeypatch.setitem(sys.modules, "soundfile", None)
    with pytest.raises(ValueError, match="soundfile is not installed"):
        audio.decode(b"fLaC....")
    there = types.ModuleType("soundfile")
    there.read = lambda f, dtype, always_2d: (np.array([[0.5, 0.0], [1.0, 0.5]], dtype), 44100)
    monkeypatch.setitem(sys.modules, "soundfile", there)
    x, rate = audio.decode(b"fLaC....")
    assert x.tolist() == [0.25, 0.75] and rate == 44100


def test_files_of_any_kind_have_rows(spark):
    data = np.linspace(-0.5, 0.5, 400).astype("<f4").tobytes()
    rows = spark.createDataFrame([("f", riff(3, 32, 1, data)), ("m", b"ID3...")], "stem string, content binary")
    got = {r.stem: r for r in audio.frames(rows, 8000).where("idx = 0 or idx is null").collect()}
    assert got["f"].problem is None and got["f"].duration_sec == 0.05 and "soundfile" in got["m"].problem
    got = {(r.stem, r.side): r for r in signal.edges_of_files(rows).collect()}
    assert got["f", "start"].boundary == 0.5 and got["m", None].problem


def test_voices_come_back_at_the_rate_of_their_file(spark):
    x = (0.4 * np.sin(2 * np.pi * 200 * np.arange(16_000) / 16_000)).astype(np.float32)

    def factory():
        seen = []

        def model(y, rate):
            seen.append(rate)
            assert rate == 8000 and set(seen) == {8000}
            return [y, -y, y * 0]

        return model

    rows = spark.createDataFrame([("a", audio.encode_wav(x, 16_000)), ("e", audio.encode_wav(x[:0], 16_000)), ("bad", b"RIFF")], "stem string, content binary")
    found = signal.separated_files(rows, factory, 8000)
    got = {(r.stem, r.speaker): r for r in found.collect()}
    assert len(got) == 7 and got["bad", None].problem and {r.n_speakers for r in got.values()} == {3, None}
    one, rate = audio.decode(got["a", 1].wav)
    assert rate == 16_000 and len(one) == len(x) and np.abs(one[800:-800] - x[800:-800]).max() < 1e-3
    two = audio.decode(got["a", 2].wav)[0]
    assert np.allclose(one, -two, atol=1e-4) and not audio.decode(got["a", 3].wav)[0].any() and len(audio.decode(got["e", 1].wav)[0]) == 0
    paths = {r.path for r in files_.enhanced_files(found.where("problem is null")).collect()}
    assert paths == {f"{s}_s{k}.wav" for s in "ae" for k in (1, 2, 3)}


def test_recordings_of_texts(spark):
    rows = spark.createDataFrame([(1, "a 9é"), (2, None), (3, ""), (4, "z" * 70_000)], "id long, text string")
    got = {r.stem: audio.decode(r.content)[0] * 32768 for r in recordings.recorded(rows, "id", "text").collect()}
    sample = lambda c: 0 if ord(c) < 48 else (ord(c) * 37 % 101 - 50) * 256
    assert got["1"].tolist() == [sample(c) for c in "a 9é"] and got["2"].tolist() == got["3"].tolist() == []
    assert len(got["4"]) == 70_000 and set(got["4"].tolist()) == {sample("z")}


def test_small_batches_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(recordings, "MOST_BYTES", 100)
    rows = spark.range(50).selectExpr("id", "repeat('a', int(id)) AS text")
    assert {r.stem: len(r.content) for r in recordings.recorded(rows, "id", "text").collect()} == {str(k): 44 + 2 * k for k in range(50)}


def test_chunks_of_all_documents_equal_a_fold(spark, sf):
    want = {}
    for r in recordings.documents(spark, sf).collect():
        want[int(r.stem)] = [(round(a / 1000, 4), round(z / 1000, 4)) for a, z in silence_chunks(audio.decode(r.content)[0], 1000, 0.5, 1.5)]
    got = {}
    for r in recordings.recording_chunks(spark, sf).orderBy("doc_id", "start_sec").collect():
        got.setdefault(r.doc_id, []).append((r.start_sec, r.end_sec))
    assert got.keys() == want.keys()
    assert all(len(got[k]) == len(want[k]) and np.allclose(got[k], want[k], atol=1.1e-3) for k in want)
