"""Long signals as rows of windows for models, and spectra, mel energies and compressed powers of frames.

A window is a row, so the windows of one long file are dealt over tasks; what
a model makes of them is stitched by its offset.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwright.sources.audio import decode, encode_wav, resample

PROBLEM = "problem string"


def signal_windows(files: DataFrame, rate: int, window: float = 4.0, stride: float = 0.75, whole_below: float = 20.0) -> DataFrame:
    """``stem, place, keep_from, keep_to, n_samples, samples, problem``: windows of each file at ``rate``, as float32 bytes.

    ``place`` is the window's first sample; of what a model makes of it,
    samples ``keep_from`` to ``keep_to`` count: at inner edges the half of
    the overlap that the neighbour sees better is left out. A short file is
    one window; the last one of a long file is filled up with zeros. A file
    that cannot be read keeps a row with its problem.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["stem", "place", "keep_from", "keep_to", "n_samples", "samples", "problem"]
        for batch in batches:
            for stem, content in zip(batch["stem"], batch["content"], strict=True):
                try:
                    signal, own = decode(content)
                except Exception as e:  # noqa: BLE001  whatever a broken file raises
                    yield pd.DataFrame([(stem, None, None, None, None, None, f"{type(e).__name__}: {e}")], columns=columns)
                    continue
                x = np.ascontiguousarray(resample(signal, own, rate), np.float32)
                size = int(window * rate)
                if len(x) <= whole_below * rate or len(x) <= size:
                    yield pd.DataFrame([(stem, 0, 0, len(x), len(x), x.tobytes(), None)], columns=columns)
                    continue
                hop = int(size * stride)
                give = (size - hop) // 2
                last = -(-(len(x) - size) // hop) * hop
                for a in range(0, last + 1, hop):
                    part = np.zeros(size, np.float32)
                    part[: len(x[a : a + size])] = x[a : a + size]
                    ends = (0 if a == 0 else give, min(size, len(x) - a) if a == last else size - give)
                    yield pd.DataFrame([(stem, a, *ends, len(x), part.tobytes(), None)], columns=columns)

    fields = f"stem string, place long, keep_from long, keep_to long, n_samples long, samples binary, {PROBLEM}"
    return files.select("stem", "content").mapInPandas(run, fields)


def enhanced(files: DataFrame, rate: int, factory: Callable[[], Callable[[np.ndarray], np.ndarray]], window: float = 4.0, stride: float = 0.75, whole_below: float = 20.0) -> DataFrame:
    """``stem, wav, problem``: a model over the windows of each file, stitched to one signal of the file's length at ``rate``.

    Windows are dealt by file and place; a model is made once a task. Only
    what counts of each window goes on to be stitched, in the task that
    writes the file.
    """
    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = signal_windows(files, rate, window, stride, whole_below).repartition(n, "stem", "place")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for batch in batches:
            kept = []
            for samples, a, z in zip(batch["samples"], batch["keep_from"], batch["keep_to"], strict=True):
                if samples is None:
                    kept.append(None)
                    continue
                model = model or factory()
                kept.append(np.ascontiguousarray(model(np.frombuffer(samples, np.float32))[int(a) : int(z)], np.float32).tobytes())
            yield batch[["stem", "n_samples", "problem"]].assign(place=batch["place"] + batch["keep_from"], samples=kept)[["stem", "place", "n_samples", "samples", "problem"]]

    pieces = dealt.mapInPandas(run, f"stem string, place long, n_samples long, samples binary, {PROBLEM}")

    def stitch(table: pa.Table) -> pa.Table:
        rows = [r for r in table.to_pylist() if r["samples"] is not None]
        if not rows:
            return pa.table({"stem": table["stem"].slice(0, 1), "wav": pa.nulls(1, pa.binary()), "problem": table["problem"].slice(0, 1)})
        out = np.zeros(rows[0]["n_samples"], np.float32)
        for r in rows:
            x = np.frombuffer(r["samples"], np.float32)
            out[r["place"] : r["place"] + len(x)] = x
        return pa.table({"stem": [rows[0]["stem"]], "wav": [encode_wav(out, rate)], "problem": pa.nulls(1, pa.string())})

    return pieces.groupBy("stem").applyInArrow(stitch, f"stem string, wav binary, {PROBLEM}")


@lru_cache(maxsize=8)
def mel_filters(rate: int, size: int, bands: int, low: float, high: float) -> np.ndarray:
    """Triangular filters, evenly spaced in mels (1127 ln(1 + f / 700)), over the bins of a spectrum: (bands, size // 2 + 1)."""
    mel = lambda f: 1127.0 * np.log1p(np.asarray(f) / 700.0)
    edges = np.linspace(mel(low), mel(high), bands + 2)
    at = mel(np.arange(size // 2 + 1) * rate / size)
    up = (at - edges[:-2, None]) / (edges[1:-1] - edges[:-2])[:, None]
    down = (edges[2:, None] - at) / (edges[2:] - edges[1:-1])[:, None]
    return np.clip(np.minimum(up, down), 0, None)


def frame_matrix(signal: np.ndarray, length: int, hop: int) -> np.ndarray:
    """Whole frames of a signal, a row each; none of a shorter signal."""
    return np.lib.stride_tricks.sliding_window_view(signal, length)[::hop] if len(signal) >= length else np.zeros((0, length))


def fbank(signal: np.ndarray, rate: int, bands: int = 80, frame_ms: float = 25.0, hop_ms: float = 10.0, emphasis: float = 0.97) -> np.ndarray:
    """Log mel energies of the frames: mean taken off, pre-emphasis, Hamming window, power spectrum; floor of float32's precision."""
    length, hop = round(rate * frame_ms / 1000), round(rate * hop_ms / 1000)
    x = frame_matrix(signal.astype(np.float64), length, hop)
    x = x - x.mean(1, keepdims=True) if len(x) else x
    x = x - emphasis * np.concatenate([x[:, :1], x[:, :-1]], 1)
    size = 1 << (length - 1).bit_length()
    power = np.abs(np.fft.rfft(x * np.hamming(length), size)) ** 2
    return np.log(np.maximum(power @ mel_filters(rate, size, bands, 20.0, rate / 2).T, np.finfo(np.float32).eps))


def stft(signal: np.ndarray, size: int = 512, hop: int = 128) -> np.ndarray:
    """Hann-windowed spectra, one row for each frame of the reflected signal."""
    x = np.pad(signal.astype(np.float64), size // 2, mode="reflect")
    return np.fft.rfft(np.lib.stride_tricks.sliding_window_view(x, size)[::hop] * np.hanning(size + 1)[:-1])


def istft(spectra: np.ndarray, length: int, size: int = 512, hop: int = 128) -> np.ndarray:
    w = np.hanning(size + 1)[:-1]
    out, norm = np.zeros((len(spectra) - 1) * hop + size), np.zeros((len(spectra) - 1) * hop + size)
    for k, frame in enumerate(np.fft.irfft(spectra, size)):
        out[k * hop : k * hop + size] += frame * w
        norm[k * hop : k * hop + size] += w * w
    return (out / np.maximum(norm, 1e-12))[size // 2 : size // 2 + length]


def compressed(spectra: np.ndarray, power: float = 0.3) -> np.ndarray:
    """Magnitudes to a power, phases as they are; 1 / power undoes it."""
    return np.abs(spectra) ** power * np.exp(1j * np.angle(spectra))


def fbank_frames(files: DataFrame, rate: int = 16_000, bands: int = 80, frame_ms: float = 25.0, hop_ms: float = 10.0) -> DataFrame:
    """``stem, frame, center_sec, mel array<float>, problem``: log mel energies of each file's frames."""
    fields = f"stem string, frame long, center_sec double, mel array<float>, {PROBLEM}"
    names = [f.split()[0] for f in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for stem, content in zip(batch["stem"].to_pylist(), batch["content"].to_pylist(), strict=True):
                try:
                    signal, own = decode(content)
                except Exception as e:  # noqa: BLE001  whatever a broken file raises
                    none = (pa.nulls(1, t) for t in (pa.int64(), pa.float64(), pa.list_(pa.float32())))
                    yield pa.RecordBatch.from_arrays([pa.array([stem]), *none, pa.array([f"{type(e).__name__}: {e}"])], names)
                    continue
                mel = fbank(resample(signal, own, rate), rate, bands, frame_ms, hop_ms).astype(np.float32)
                for k in range(0, len(mel), 4096):
                    part = mel[k : k + 4096]
                    m = len(part)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(m + 1, dtype=np.int32) * bands), pa.array(part.reshape(-1)))
                    centre = ((np.arange(k, k + m) * round(rate * hop_ms / 1000)) + round(rate * frame_ms / 1000) / 2) / rate
                    yield pa.RecordBatch.from_arrays([pa.array([stem] * m), pa.array(np.arange(k, k + m)), pa.array(centre), lists, pa.nulls(m, pa.string())], names)

    return files.select("stem", "content").mapInArrow(run, fields)


def problems_of(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("problem").isNotNull()).select("stem", "problem").distinct()
