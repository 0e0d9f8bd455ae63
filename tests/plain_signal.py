"""A plain fold over one signal, to hold operators over frame rows to."""

from __future__ import annotations

import numpy as np

from loomwright.operators.signal import threshold_of
from loomwright.sources.audio import frame_rms


def silence_chunks(signal: np.ndarray, rate: int, shortest: float = 5.0, longest: float = 15.0, frame_ms: float = 20.0, hop_ms: float = 5.0) -> list[tuple[int, int]]:
    """Chunks of at most ``longest`` seconds, each cut at the quietest silent frame between the bounds."""
    level, centre = frame_rms(signal, rate, frame_ms, hop_ms)
    limit, out, at = threshold_of(level), [], 0
    least, most = max(1, round(shortest * rate)), max(1, round(longest * rate))
    while len(signal) - at > most:
        now = at / rate
        ok = np.flatnonzero((centre >= now + shortest) & (centre <= now + longest) & (level <= limit))
        far = np.abs(centre[ok] - (now + (shortest + longest) / 2))
        cut = now + longest if not len(ok) else centre[ok[np.lexsort((-centre[ok], far, level[ok]))[0]]]
        z = min(max(round(cut * rate), at + least), at + most)
        out.append((at, z))
        at = z
    return [*out, (at, len(signal))] if len(signal) > at else out
