"""Signals of whole files within one task each: speech regions, cuts, parts, edges, levels.

Each operator takes ``stem, content`` rows (see sources.audio.scan) and
returns small rows; decoded signals stay in the task. A file that cannot be
read has one row, with its stem and the ``problem``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwright.functions.tables import sorted_sides
from loomwright.operators.volume import EDGE_CENTRE, edge_score, restored, robust_z, target_level
from loomwright.sources.audio import Made, decode, encode_wav, frame_rms, resample, trim

EPS = 1e-8


def threshold_of(level: np.ndarray, low: float = 25, scale: float = 1.8, least: float = 1e-6) -> float:
    return max(float(np.percentile(level, low)) * scale, float(np.percentile(level, 50)) * 0.45, float(level.max()) * 0.025, least)


def runs_of(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def longest_run_cuts(
    signal: np.ndarray, rate: int, shortest: float = 5.0, longest: float = 15.0, silence_ms: float = 80.0, frame_ms: float = 25.0, hop_ms: float = 5.0, fallback: str = "max"
) -> list[tuple[float, float, float, float, float, float, str]]:
    """(start, end, silence start, silence end, silence ms, silence rms, fallback) in seconds of segments cut in the middle of the longest silence ahead.

    Of equally long silences the quieter one counts, then the one nearer to
    the middle of the window. Without a silence of ``silence_ms`` the cut is
    at the window's end, or half way to it (``fallback`` midpoint). The last
    segment is a tail. No samples, no segments.
    """
    if not len(signal):
        return []
    level, centre = frame_rms(signal, rate, frame_ms, hop_ms)
    limit, total = threshold_of(level), len(signal) / rate
    step = centre[1] - centre[0] if len(centre) > 1 else hop_ms / 1000
    frames = max(1, int(np.ceil(silence_ms / 1000 / max(step, 1e-6))))
    sums = np.append(0, np.cumsum(level))
    out, now = [], 0.0
    while total - now > longest:
        middle = now + (shortest + longest) / 2
        lo, hi = np.searchsorted(centre, now + shortest), np.searchsorted(centre, now + longest, side="right")
        runs = [(a + lo, z + lo) for a, z in runs_of(level[lo:hi] <= limit) if z - a >= frames]
        if runs:
            a, z = max(runs, key=lambda r: (r[1] - r[0], -(sums[r[1]] - sums[r[0]]) / (r[1] - r[0]), -abs((centre[r[0]] + centre[r[1] - 1]) / 2 - middle)))
            first, last = float(centre[a]), float(centre[z - 1])
            cut = (first + last) / 2
            out.append((now, cut, first, last, (last - first) * 1000, float(sums[z] - sums[a]) / (z - a), ""))
        else:
            cut = now + (longest if fallback == "max" else longest / 2)
            out.append((now, cut, cut, cut, 0.0, 0.0, f"no_silence_{fallback}"))
        now = max(cut, now + 0.1)
    return [*out, (now, total, total, total, 0.0, 0.0, "tail")] if total - now > 1e-6 else out


def speech_regions(signal: np.ndarray, rate: int, sensitivity: float = 0.5, pad_sec: float = 0.2, shortest: float = 0.25, silence: float = 0.3, frame: int = 2048, hop: int = 512) -> list[tuple[int, int]]:
    """Energy-based activity: frames (centred on multiples of ``hop``) within a range of the loudest, padded and clipped, short ones left out, near ones joined."""
    if not len(signal):
        return []
    half = frame // 2
    total = np.append(0, np.cumsum(np.square(np.pad(signal.astype(np.float64), half))))
    at = np.arange(1 + len(signal) // hop) * hop
    power = np.maximum((total[at + frame] - total[at]) / frame, 1e-10)
    loud = 10 * np.log10(power / power.max()) > -max(10, round((1 - sensitivity) * 60))
    pad, least, quiet = int(rate * pad_sec), int(rate * shortest), int(rate * silence)
    out: list[list[int]] = []
    for a, z in runs_of(loud):
        start, end = max(0, a * hop - pad), min(len(signal), min(z * hop, len(signal)) + pad)
        if end - start < least:
            continue
        if out and start - out[-1][1] < quiet:
            out[-1][1] = end
        else:
            out.append([start, end])
    return [tuple(x) for x in out]


def quiet_boundary(signal: np.ndarray, rate: int, start: int, end: int, least_sec: float = 10.0, window_ms: float = 100.0) -> int:
    """The quietest sample of the quietest 100 ms between ``least_sec`` after ``start`` and ``end``; ``end`` where nothing is quieter than the rest."""
    lo = max(start + 1, min(int(start + round(least_sec * rate)), len(signal)))
    hi = max(lo, min(end, len(signal)))
    part = np.abs(signal[lo:hi].astype(np.float64))
    if not len(part):
        return end
    size = max(4, round(window_ms * rate / 1000))
    if len(part) <= size:
        return lo + int(np.argmin(part))
    total = np.append(0, np.cumsum(part))
    sums = total[size:] - total[:-size]
    if sums.max() - sums.min() <= 1e-6:
        return end
    at = int(np.argmin(sums))
    return lo + at + int(np.argmin(part[at : at + size]))


def budget_chunks(signal: np.ndarray, rate: int, regions: list[tuple[int, int]], budget_sec: float, least_sec: float = 10.0) -> list[tuple[int, int]]:
    """Regions packed into chunks of at most the budget; a longer region, or a signal without regions, is cut at quiet boundaries.

    A budget of 0 gives one chunk of everything.
    """
    if not len(signal):
        return []
    if budget_sec <= 0:
        return [(0, len(signal))]
    most, out = int(budget_sec * rate), []
    for start, end in regions or [(0, len(signal))]:
        if out and end - out[-1][0] <= most:
            out[-1] = (out[-1][0], end)
            continue
        while end - start > most:
            cut = quiet_boundary(signal, rate, start, start + most, min(least_sec, budget_sec / 2))
            out.append((start, cut))
            start = cut
        out.append((start, end))
    return out


def low_energy_spans(signal: np.ndarray, rate: int, start: float, end: float, shortest: float = 0.03) -> list[tuple[float, float]]:
    """Quiet spans in seconds within a window; none where the level is flat."""
    level, centre = frame_rms(signal[round(start * rate) : round(end * rate)], rate)
    if np.ptp(level) <= 1e-8:
        return []
    limit, median = threshold_of(level, 20, 1.8, 1e-5), float(np.percentile(level, 50))
    if median > 1e-7:
        limit = min(limit, median * 0.95)
    spans = [(start + centre[a] - 0.01, start + centre[z - 1] + 0.01) for a, z in runs_of(level <= limit)]
    return [(a, z) for a, z in spans if z - a >= shortest]


def split_at_gaps(regions: list[tuple[int, int]], start: int, end: int, rate: int, low: float = 5.0, high: float = 15.0, hard: float = 10.0) -> tuple[list[tuple[int, int]], int]:
    """Parts of [start, end) cut in the middle of the longest gap between regions 5 to 15 s ahead, or hard at 10 s; and how often hard."""
    out, forced = [], 0
    while end - start > high * rate:
        a, z = start + round(low * rate), start + round(high * rate)
        gaps = [(max(x[1], a), min(y[0], z)) for x, y in zip(regions, regions[1:], strict=False)]
        best = max((g for g in gaps if g[1] > g[0]), key=lambda g: (g[1] - g[0], -g[0]), default=None)
        forced += best is None
        cut = (best[0] + best[1]) // 2 if best else start + round(hard * rate)
        out.append((start, cut))
        start = cut
    return [*out, (start, end)], forced


def even_cuts(signal: np.ndarray, rate: int, target: float, window: float = 10.0, shortest: float = 0.03) -> list[tuple[float, str]]:
    """(second, method) of the cuts of a long signal into even parts, each moved to the longest quiet span near its ideal place."""
    length = len(signal) / rate
    parts = 1 if length <= target else max(2, int(length // target) + 1)
    out: list[tuple[float, str]] = []
    for k in range(1, parts):
        ideal = k * length / parts
        a, z = max(0.0, ideal - window / 2), min(length, ideal + window / 2)
        spans = low_energy_spans(signal, rate, a, z, shortest)
        if spans:
            best = max(spans, key=lambda s: (round(s[1] - s[0], 6), -abs(sum(s) / 2 - ideal)))
            cut, method = sum(best) / 2, "longest_silence"
        else:
            level, centre = frame_rms(signal[round(a * rate) : round(z * rate)], rate)
            cut, method = a + float(centre[int(np.argmin(level))]), "quietest_frame"
        least = out[-1][0] if out else 0.0
        out.append((max(cut, least), method if cut >= least else f"{method}_clamped"))
    return out


def level_to(signal: np.ndarray, rate: int, db: float = -25.0) -> tuple[np.ndarray, float]:
    """The signal scaled so that its louder-than-average 100 ms pieces have the level; and the factor that undoes it."""
    def rms(x: np.ndarray) -> float:
        return float(np.sqrt(np.mean(np.square(x, dtype=np.float64)))) if len(x) else 0.0

    want, factor = 10 ** (db / 20), 1.0
    if rms(signal) > EPS:
        factor = want / rms(signal)
        pieces = [rms(signal[k : k + rate // 10]) * factor for k in range(0, len(signal), max(1, rate // 10))]
        loud = [p for p in pieces if p > np.mean(pieces)]
        if loud:
            factor *= want / float(np.sqrt(np.mean(np.square(loud))))
    return (signal * factor).astype(np.float32), 1 / factor


def silence_around(signal: np.ndarray, rate: int, left_end: float, right_start: float, scan: float = 0.55) -> float:
    """Milliseconds of quiet around a punctuation mark, at least the gap between its neighbours' times."""
    gap = max(0.0, (right_start - left_end) * 1000)
    anchor = (left_end + right_start) / 2 if right_start >= left_end else left_end
    a, z = max(0, round((min(left_end, anchor) - scan) * rate)), min(len(signal), round((max(right_start, anchor) + scan) * rate))
    if z - a < round(0.02 * rate):
        return gap
    level, centre = frame_rms(signal[a:z], rate)
    centre = centre + a / rate
    quiet = level <= threshold_of(level, 20, 1.8, 1e-5)
    near = int(np.argmin(np.abs(centre - anchor)))
    close = [i for i in np.flatnonzero(quiet).tolist() if abs(i - near) <= 24]
    if not close:
        return gap
    best = near if quiet[near] else min(close, key=lambda i: abs(centre[i] - anchor))
    first, last = next((s, e) for s, e in runs_of(quiet) if s <= best < e)
    return max(gap, (centre[last - 1] - centre[first] + 0.02) * 1000)


def edge_features(signal: np.ndarray, rate: int) -> list[tuple[str, float, float, float, float, float]]:
    """(side, edge rms, edge peak, first sample, sustain ratio, zero crossings) of the start and the end."""
    def rms(x: np.ndarray) -> float:
        return float(np.sqrt(np.mean(np.square(x, dtype=np.float64)))) if len(x) else 0.0

    out = []
    for side, x in (("start", signal), ("end", signal[::-1])):
        edge, top, inner = x[: max(1, round(rate * 0.05))], x[: max(1, round(rate * 0.01))], x[round(rate * 0.05) : round(rate * 0.25)]
        crossings = float(np.mean(np.signbit(edge[1:]) != np.signbit(edge[:-1]))) if len(edge) > 1 else 0.0
        out.append((side, rms(edge), float(np.abs(top).max(initial=0)), float(abs(x[0])) if len(x) else 0.0, rms(edge) / (rms(inner) + EPS), crossings))
    return out


#: Rows and bytes that a task hands on at once.
MOST_ROWS, MOST_BYTES = 4096, 1 << 23
_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}


def per_file(files: DataFrame | Made, schema: str, work: Callable[..., list[tuple]], rate: int | None = None, beside: DataFrame | None = None) -> DataFrame:
    """``stem``, the rows that ``work(signal, rate)`` gives for each file, and ``problem``.

    With ``beside`` (a row a stem, with ``own``, the list of what belongs to
    it) the work gets that list too, and files without one are left out. A
    task holds one signal at a time and hands rows on by thousands.
    """
    names, kinds = zip(*(c.split() for c in schema.split(", ")), strict=True)
    made = files if isinstance(files, Made) else Made(files.select("stem", F.col("content").alias("of")), bytes)
    rows, make, alone = made.rows, made.make, beside is None
    if beside is not None:
        rows = rows.join(sorted_sides(beside.select("stem", "own")), "stem")
    arrow = pa.schema([("stem", pa.string()), *((n, _ARROW[k]) for n, k in zip(names, kinds, strict=True)), ("problem", pa.string())])
    heavy = [k for k, kind in enumerate(kinds, 1) if kind in ("binary", "string")]

    def packed(found: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([f[k] for f in found], c.type, from_pandas=True) for k, c in enumerate(arrow)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        held = 0
        for batch in batches:
            stems, of, lists = batch.column("stem"), batch.column("of"), None if alone else batch.column("own")
            for k in range(batch.num_rows):
                stem, own = stems[k].as_py(), () if alone else (lists[k].as_py(),)
                try:
                    signal, have = decode(make(of[k].as_py()))
                except Exception as e:  # noqa: BLE001  whatever a broken file raises
                    found.append((stem, *(None for _ in names), f"{type(e).__name__}: {e}"))
                    continue
                for row in work(resample(signal, have, rate) if rate else signal, rate or have, *own):
                    found.append((stem, *row, None))
                    held += sum(len(found[-1][c] or ()) for c in heavy)
                    if len(found) >= MOST_ROWS or held >= MOST_BYTES:
                        yield packed(found)
                        found, held = [], 0
        if found:
            yield packed(found)

    return rows.mapInArrow(run, f"stem string, {schema}, problem string")


def _own(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.groupBy("stem").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("own"))


def frame_stats(files: DataFrame | Made, low: float, rate: int = 16_000) -> DataFrame:
    """``stem, n_frames, mean_rms, top_rms, n_low, problem``: the frame levels of each file in sum; ``n_low`` counts those under ``low``."""

    def work(x: np.ndarray, r: int) -> list[tuple]:
        level = frame_rms(x, r)[0]
        return [(len(level), float(level.mean()), float(level.max()), int((level < low).sum()))]

    return per_file(files, "n_frames long, mean_rms double, top_rms double, n_low long", work, rate)


def frame_chunks(signal: np.ndarray, rate: int, shortest: float, longest: float, duration: float, frame_ms: float = 20.0, hop_ms: float = 5.0) -> list[tuple[float, float, str]]:
    """(start, end, method) in seconds: the chunks of ``cuts.chunk_frames`` for one signal."""
    level = frame_rms(signal, rate, frame_ms, hop_ms)[0]
    limit, lead, step = threshold_of(level), round(frame_ms / hop_ms / 2), hop_ms / 1000
    low, high = math.ceil(shortest * 1000 / hop_ms - 1e-9), math.floor(longest * 1000 / hop_ms + 1e-9)
    end, last, at, out = math.floor(duration * 1000 / hop_ms + 0.5), lead + len(level) - 1, 0, []
    while end - at > high and at <= last:
        first = max(at + low, lead)
        part = level[first - lead : at + high + 1 - lead]
        quiet = np.flatnonzero(part <= limit)
        if len(quiet):
            place = quiet[part[quiet] == part[quiet].min()] + first
            stop = int(place[np.lexsort((-place, np.abs(2 * place - 2 * at - low - high)))[0]])
        else:
            stop = at + high
        out.append((at * step, stop * step, "silence" if len(quiet) else "max"))
        at = stop
    return [*out, (at * step, duration, "end")] if end > at else out


def chunk_files(files: DataFrame | Made, rate: int = 16_000, shortest: float = 5.0, longest: float = 15.0) -> DataFrame:
    """``stem, start_sec, end_sec, method, problem``: chunks cut at the quietest silent frames, found where a file is decoded (``cuts.chunk_frames`` does it for rows of frames)."""

    def work(x: np.ndarray, own: int) -> list[tuple]:
        return frame_chunks(resample(x, own, rate), rate, shortest, longest, len(x) / own)

    return per_file(files, "start_sec double, end_sec double, method string", work)


def longest_run_files(files: DataFrame | Made, rate: int = 16_000, shortest: float = 5.0, longest: float = 15.0, silence_ms: float = 80.0) -> DataFrame:
    """The cut experiment over files; ``reports.cut_summary`` sums it up."""
    schema = "start_sec double, end_sec double, silence_start_sec double, silence_end_sec double, silence_ms double, silence_rms double, fallback string"
    return per_file(files, schema, lambda x, r: longest_run_cuts(x, r, shortest, longest, silence_ms), rate)


def speech_files(files: DataFrame | Made, rate: int = 16_000) -> DataFrame:
    return per_file(files, "start long, end long", speech_regions, rate)


def budget_files(files: DataFrame | Made, budget_sec: float, rate: int = 16_000, least_sec: float = 10.0) -> DataFrame:
    """``stem, chunk, start, end, problem``: speech regions packed into chunks of at most the budget, long ones cut at quiet boundaries; a file without speech is cut all over."""

    def work(x: np.ndarray, r: int) -> list[tuple]:
        return [(k, *c) for k, c in enumerate(budget_chunks(x, r, speech_regions(x, r), budget_sec, least_sec))]

    return per_file(files, "chunk long, start long, end long", work, rate)


def gap_cut_files(files: DataFrame | Made, rate: int = 16_000, low: float = 5.0, high: float = 15.0, hard: float = 10.0) -> DataFrame:
    """``stem, part, start_sec, end_sec, forced, problem``: files cut in the middle of the longest gaps of their speech; ``forced`` counts the file's hard cuts."""

    def work(x: np.ndarray, r: int) -> list[tuple]:
        parts, forced = split_at_gaps(speech_regions(x, r), 0, len(x), r, low, high, hard)
        return [(k, a / r, z / r, forced) for k, (a, z) in enumerate(parts) if z > a]

    return per_file(files, "part long, start_sec double, end_sec double, forced long", work, rate)


def even_part_files(files: DataFrame | Made, target: float, window: float = 10.0) -> DataFrame:
    """``stem, part_index, part_count, start_sec, end_sec, method, wav, problem``: long files as even parts cut at silences near their ideal places, ready for ``sources.files.part_files``.

    ``method`` is that of the part's end, ``end`` for the last one.
    """

    def work(x: np.ndarray, r: int) -> list[tuple]:
        cuts = [*even_cuts(x, r, target, window), (len(x) / r, "end")]
        starts = [0.0, *(c for c, _ in cuts)]
        return [(k, len(cuts), a, z, how, encode_wav(x[round(a * r) : round(z * r)], r)) for k, (a, (z, how)) in enumerate(zip(starts, cuts, strict=False))]

    return per_file(files, "part_index long, part_count long, start_sec double, end_sec double, method string, wav binary", work)


def level_files(files: DataFrame | Made, db: float = -25.0) -> DataFrame:
    """``stem, wav, undo, problem``: files brought to the level of their loud pieces (as float32 bytes), and the factor that takes it back."""

    def work(x: np.ndarray, r: int) -> list[tuple]:
        y, undo = level_to(x, r, db)
        return [(r, y.tobytes(), undo)]

    return per_file(files, "rate int, samples binary, undo double", work)


def mark_silences(files: DataFrame | Made, marks: DataFrame, scan: float = 0.55) -> DataFrame:
    """``stem, idx, silence_ms, problem``: the quiet around each punctuation mark (stem, idx, left_end_sec, right_start_sec)."""

    def work(x: np.ndarray, r: int, own: list) -> list[tuple]:
        return [(m["idx"], silence_around(x, r, m["left_end_sec"], m["right_start_sec"], scan)) for m in own]

    return per_file(files, "idx long, silence_ms double", work, beside=_own(marks, "idx", "left_end_sec", "right_start_sec"))


def speech_levels(files: DataFrame | Made, rate: int = 16_000) -> DataFrame:
    """``stem, speech_sec, speech_dbfs, peak_dbfs, safe_dbfs, problem``: level of the samples in speech regions, and the highest level that keeps the peak under -1 dBFS. Files without speech have no row."""

    def work(x: np.ndarray, r: int) -> list[tuple]:
        parts = [x[a:z].astype(np.float64) for a, z in speech_regions(x, r)]
        n, peak = sum(map(len, parts)), float(np.max(np.abs(x), initial=0))
        power = sum(float(p @ p) for p in parts) / n if n else 0.0
        if power <= EPS**2 or peak <= EPS:
            return []
        level, top = 10 * np.log10(power), 20 * np.log10(peak)
        return [(n / r, level, top, level - 1.0 - top)]

    return per_file(files, "speech_sec double, speech_dbfs double, peak_dbfs double, safe_dbfs double", work, rate)


def library_target(levels: DataFrame) -> DataFrame:
    """One row ``target``: the median level of all speech, weighted by its seconds, not over any file's safe level."""
    return target_level(levels.where("problem is null"), "speech_dbfs", "speech_sec", "safe_dbfs")


def restored_files(files: DataFrame | Made, outputs: DataFrame, mode: str, target_dbfs: float | None = None) -> DataFrame:
    """``stem, content, gain, reason, problem``: a model's outputs (stem, wav) at the level of their sources (``rms``, ``peak``, ``rms-peak``), at a target (``target-rms``, ``target-peak``) or as they are (``none``)."""

    def work(x: np.ndarray, r: int, own: list) -> list[tuple]:
        y, rate = decode(own[0]["wav"])
        z, gain, why = restored(y, x, mode, target_dbfs)
        return [(encode_wav(z, rate), gain, why)]

    return per_file(files, "content binary, gain double, reason string", work, beside=_own(outputs, "wav"))


def restored_voices(files: DataFrame | Made, factory: Callable[[], Callable[[np.ndarray, int], list[np.ndarray]]], rate: int, modes: list[tuple[str, float | None]]) -> DataFrame:
    """``stem, mode, gain, reason, n_bytes, problem``: the first voice of a separator at the level of its source or at a target, in each of ``modes`` (mode, target).

    The same as :func:`restored_files` of :func:`separated_files` for each
    mode, in one pass over the files and with no output moved.
    """
    made: list = []

    def work(x: np.ndarray, r: int) -> list[tuple]:
        if not made:
            made.append(factory())
        y, own = decode(encode_wav(resample(made[0](resample(x, r, rate), rate)[0], rate, r), r))
        found = ((mode, restored(y, x, mode, target)) for mode, target in modes)
        return [(mode, gain, why, len(encode_wav(z, own))) for mode, (z, gain, why) in found]

    return per_file(files, "mode string, gain double, reason string, n_bytes long", work)


def separated_files(files: DataFrame | Made, factory: Callable[[], Callable[[np.ndarray, int], list[np.ndarray]]], rate: int) -> DataFrame:
    """``stem, speaker, n_speakers, wav, problem``: the voices that a separator finds in each file, ready for ``sources.files.enhanced_files``.

    ``factory`` makes the model, once a task; it takes a signal at ``rate`` and
    gives one signal for each voice. Voices come back at the file's own rate
    and, but for what a model adds or leaves, at its length.
    """
    made: list = []

    def work(x: np.ndarray, r: int) -> list[tuple]:
        if not made:
            made.append(factory())
        voices = made[0](resample(x, r, rate), rate)
        return [(k, len(voices), encode_wav(resample(v, rate, r), r)) for k, v in enumerate(voices, 1)]

    return per_file(files, "speaker long, n_speakers long, wav binary", work)


def edges_of_files(files: DataFrame | Made) -> DataFrame:
    return per_file(files, "side string, edge_rms double, edge_peak double, boundary double, sustain double, crossings double", edge_features)


def abrupt_edges(files: DataFrame | Made) -> DataFrame:
    """``stem, side``, the edge features, ``score, likelihood``: how abruptly each file starts and ends beside all others.

    Levels count by their logarithms; features are distances to the median
    of their side. ``manifests.top_per_group`` gives the worst ones, and
    ``manifests.worst_of_each`` the worse side of each file.
    """
    edges = edges_of_files(files).where("problem is null")
    logs = {f"_{c}": F.log10(F.col(c) + EPS) for c in ("edge_rms", "edge_peak", "boundary", "sustain")}
    names = [*logs, "crossings"]
    rated = robust_z(edges.withColumns(logs), "side", names)
    score = edge_score([F.col(f"z_{n}") for n in names])
    likely = 1 / (1 + F.exp(-F.greatest(F.lit(-60.0), F.least(F.lit(60.0), score - EDGE_CENTRE))))
    return rated.select("stem", "side", "edge_rms", "edge_peak", "boundary", "sustain", "crossings", score.alias("score"), likely.alias("likelihood"))


def cut_segments(files: DataFrame | Made, segments: DataFrame) -> DataFrame:
    """``stem, segment_index, status, wav, problem``: the 16-bit WAV of each segment (stem, segment_index, status, cut_start_sec, cut_end_sec), for ``sources.files.segment_files``.

    Each file is decoded once, beside the list of its own segments.
    """

    def work(x: np.ndarray, r: int, own: list) -> list[tuple]:
        return [(c["segment_index"], c["status"], encode_wav(x[round(c["cut_start_sec"] * r) : round(c["cut_end_sec"] * r)], r)) for c in own]

    return per_file(files, "segment_index long, status string, wav binary", work, beside=_own(segments, "segment_index", "status", "cut_start_sec", "cut_end_sec"))


def trim_segments(files: DataFrame | Made, segments: DataFrame, padding: float = 0.2, top_db: float = 60.0) -> DataFrame:
    """``stem, segment_index, cut_start_sec, cut_end_sec, problem``: rough segments (start_sec, end_sec) without silent ends, padded within their rough bounds.

    A segment that is silent as a whole keeps its rough bounds and says so.
    """

    def work(x: np.ndarray, r: int, own: list) -> list[tuple]:
        rows = []
        for c in own:
            a, z = round(c["start_sec"] * r), min(len(x), round(c["end_sec"] * r))
            first, last = trim(x[a:z], top_db)
            if last <= first:
                rows.append((c["segment_index"], c["start_sec"], c["end_sec"], "trim_empty"))
            else:
                rows.append((c["segment_index"], max(c["start_sec"], (a + first) / r - padding), min(c["end_sec"], (a + last) / r + padding), None))
        return rows

    found = per_file(files, "segment_index long, cut_start_sec double, cut_end_sec double, empty string", work, beside=_own(segments, "segment_index", "start_sec", "end_sec"))
    return found.withColumn("problem", F.coalesce("problem", "empty")).drop("empty")
