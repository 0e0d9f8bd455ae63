"""Audio files as rows: recursive scan, WAV decoding, frame levels. Signals never pass a shuffle."""

from __future__ import annotations

import io
import math
import re
import struct
import wave
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EXTENSIONS = (".wav", ".flac", ".mp3", ".m4a", ".ogg")


@dataclass(frozen=True)
class Made:
    """Recordings that the task which uses them makes, one at a time: ``rows`` has ``stem`` and ``of``, and ``make`` gives the file of an ``of``."""

    rows: DataFrame
    make: Callable[[Any], bytes]


def scan(spark: SparkSession, path: str, extensions: tuple[str, ...] = EXTENSIONS, recursive: bool = True) -> DataFrame:
    """``path, length, content, stem`` of the files with one of the extensions (any case)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path)
    return named(files.select("path", "length", "content"), extensions)


def named(files: DataFrame, extensions: tuple[str, ...] = EXTENSIONS) -> DataFrame:
    """Those of ``files`` (``path`` and any columns) with one of the extensions (any case), and their ``stem``."""
    dotted = [e.lower() if e.startswith(".") else f".{e.lower()}" for e in extensions]
    found = files.where(F.lower(F.regexp_extract("path", r"(\.[^./\\]+)$", 1)).isin(*dotted))
    return found.withColumn("stem", F.regexp_extract("path", r"([^/\\]+?)(\.[^./\\]*)?$", 1))


def scan_list(spark: SparkSession, listing: str, root: str) -> DataFrame:
    """The files under ``root`` that a list names, one relative path a line (of several fields, the last)."""
    wanted = spark.read.text(listing).select(F.element_at(F.split(F.trim("value"), r"\s+"), -1).alias("name")).where("name <> ''").distinct()
    files = scan(spark, root)
    base = root.rstrip("/")
    relative = F.regexp_replace(F.col("path"), "^.*?" + re.escape(base) + "/", "")
    return files.withColumn("name", relative).join(wanted, "name").drop("name")


def duplicate_stems(files: DataFrame) -> DataFrame:
    return files.groupBy("stem").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("path")).alias("paths")).where("n > 1")


def numbered(files: DataFrame, start: int = 1, digits: int = 6) -> DataFrame:
    """``numbered_file`` by path order."""
    from loomwright.functions.tables import with_rank

    ranked = with_rank(files.select("path"), [F.col("path")], "_n")
    return ranked.select(F.concat(F.lpad((F.col("_n") - 1 + start).cast("string"), digits, "0"), F.lit(".wav")).alias("numbered_file"), F.col("path").alias("source_file"))


def decode_wav(content: bytes) -> tuple[np.ndarray, int]:
    """Mono float32 signal (mean of the channels) and sample rate of 8, 16, 24 or 32 bit PCM."""
    with wave.open(io.BytesIO(content)) as f:
        width, channels, rate, raw = f.getsampwidth(), f.getnchannels(), f.getframerate(), f.readframes(f.getnframes())
    if width == 1:
        x = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    elif width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = (((b[:, 0] | b[:, 1] << 8 | b[:, 2] << 16) ^ 0x800000) - 0x800000).astype(np.float32) / (1 << 23)
    else:
        x = np.frombuffer(raw, f"<i{width}").astype(np.float32) / (1 << (8 * width - 1))
    return x.reshape(-1, channels).mean(1).astype(np.float32), rate


#: Format tags of a RIFF file, and where an extensible format keeps its own tag.
IEEE_FLOAT, EXTENSIBLE, OWN_TAG = 3, 0xFFFE, 24


def _float_wav(content: bytes) -> tuple[np.ndarray, int] | None:
    """Mono signal and rate of a WAV of 32- or 64-bit floats; None for any other file."""
    if content[:4] != b"RIFF" or content[8:12] != b"WAVE":
        return None
    at, shape = 12, None
    while at + 8 <= len(content):
        name, size, body = content[at : at + 4], struct.unpack_from("<I", content, at + 4)[0], at + 8
        if name == b"fmt ":
            tag, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", content, body)
            if tag == EXTENSIBLE and size > OWN_TAG + 1:
                tag = struct.unpack_from("<H", content, body + OWN_TAG)[0]
            if tag != IEEE_FLOAT or bits not in (32, 64):
                return None
            shape = channels, rate, bits // 8
        elif name == b"data" and shape:
            channels, rate, width = shape
            n = min(size, len(content) - body) // (width * channels) * channels
            return np.frombuffer(content, f"<f{width}", n, body).reshape(-1, channels).mean(1).astype(np.float32), rate
        at = body + size + (size & 1)
    return None


def decode(content: bytes) -> tuple[np.ndarray, int]:
    """Mono float32 signal and sample rate of a WAV of integers or floats; other formats by soundfile where it is installed, else an error that says so."""
    content = bytes(content)
    if content[:4] == b"RIFF":
        return _float_wav(content) or decode_wav(content)
    try:
        import soundfile
    except ImportError:
        raise ValueError("no WAV, and soundfile is not installed") from None
    signal, rate = soundfile.read(io.BytesIO(content), dtype="float32", always_2d=True)
    return signal.mean(1), rate


def encode_wav(signal: np.ndarray, rate: int) -> bytes:
    """16-bit PCM mono."""
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1), f.setsampwidth(2), f.setframerate(rate)
        f.writeframes(np.clip(np.round(signal * 32767), -32768, 32767).astype("<i2").tobytes())
    return out.getvalue()


#: Zero crossings of the resampling filter on each side, and the shape of its window (about 90 dB down beyond it).
CROSSINGS, KAISER = 32, 9.0


@lru_cache(maxsize=16)
def _phases(up: int, down: int) -> tuple[np.ndarray, int]:
    """(taps of each phase of a windowed sinc, taps before the middle) for a change of rate by up / down."""
    cut = min(1.0, up / down) * 0.94  # of the lower of both bands
    half = int(np.ceil(CROSSINGS / cut))
    k = np.arange(-half, half + 1)
    place = k[None, :] - np.arange(up)[:, None] / up  # of the inputs about the output, for each phase
    taps = cut * np.sinc(cut * place) * np.i0(KAISER * np.sqrt(np.clip(1 - (place / (half + 1)) ** 2, 0, None))) / np.i0(KAISER)
    return taps / taps.sum(1, keepdims=True), half


def resample(signal: np.ndarray, rate: int, wanted: int) -> np.ndarray:
    """Another rate by a windowed sinc in phases: what the lower rate cannot hold is filtered out first."""
    if rate == wanted or not len(signal):
        return signal
    up, down = wanted // math.gcd(rate, wanted), rate // math.gcd(rate, wanted)
    n = int(round(len(signal) * wanted / rate))
    taps, half = _phases(up, down)
    at = np.arange(n, dtype=np.int64) * down
    base, phase = at // up, at % up
    padded = np.pad(signal.astype(np.float64), (half, half + 1 + max(0, int(base[-1]) + 1 - len(signal)) if n else half))
    windows = np.lib.stride_tricks.sliding_window_view(padded, 2 * half + 1)
    out = np.empty(n)
    for p in range(min(up, n)):
        mine = np.arange(p * pow(down, -1, up) % up if up > 1 else 0, n, up)  # outputs of this phase lie ``up`` apart
        for k in range(0, len(mine), 1 << 16):
            out[mine[k : k + (1 << 16)]] = windows[base[mine[k : k + (1 << 16)]]] @ taps[p]
    return out.astype(np.float32)


def frame_rms(signal: np.ndarray, rate: int, frame_ms: float = 20.0, hop_ms: float = 5.0) -> tuple[np.ndarray, np.ndarray]:
    """(rms of each frame, its centre in seconds); a signal shorter than a frame is padded with zeros."""
    size, hop = max(1, int(round(frame_ms * rate / 1000))), max(1, int(round(hop_ms * rate / 1000)))
    x = np.pad(signal.astype(np.float64), (0, max(0, size - len(signal))))
    total = np.append(0, np.cumsum(x * x))
    starts = np.arange(0, len(x) - size + 1, hop)
    return np.sqrt(np.maximum(total[starts + size] - total[starts], 0) / size), (starts + size / 2) / rate


def trim(signal: np.ndarray, top_db: float = 60.0, frame: int = 2048, hop: int = 512) -> tuple[int, int]:
    """First and last sample of the frames no more than ``top_db`` under the loudest; (0, 0) when there is none."""
    if not len(signal):
        return 0, 0
    x = np.pad(signal.astype(np.float64), frame // 2)
    total = np.append(0, np.cumsum(x * x))
    starts = np.arange(0, len(x) - frame + 1, hop)
    power = np.maximum(total[starts + frame] - total[starts], 0) / frame
    loud = np.flatnonzero(10 * np.log10(np.maximum(power, 1e-10)) - 10 * np.log10(max(power.max(), 1e-10)) > -top_db) if power.max() > 0 else []
    return (int(loud[0] * hop), int(min(len(signal), (loud[-1] + 1) * hop))) if len(loud) else (0, 0)


def frames(files: DataFrame, rate: int = 16_000, frame_ms: float = 20.0, hop_ms: float = 5.0) -> DataFrame:
    """``stem, idx, center_sec, rms, duration_sec, problem``: the frame levels of each file, decoded within the task.

    A file that cannot be read gives one row with its ``problem``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for stem, content in zip(batch["stem"], batch["content"], strict=True):
                try:
                    signal, own = decode(content)
                    duration = len(signal) / own
                    level, centre = frame_rms(resample(signal, own, rate), rate, frame_ms, hop_ms)
                    yield pd.DataFrame({"stem": stem, "idx": np.arange(len(level)), "center_sec": centre, "rms": level, "duration_sec": duration, "problem": None})
                except (wave.Error, EOFError, struct.error, ValueError, RuntimeError) as e:
                    yield pd.DataFrame({"stem": [stem], "idx": [None], "center_sec": [None], "rms": [None], "duration_sec": [None], "problem": [f"read_error: {e}"]})

    return files.select("stem", "content").mapInPandas(run, "stem string, idx long, center_sec double, rms double, duration_sec double, problem string")
