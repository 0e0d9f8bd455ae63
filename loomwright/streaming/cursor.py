"""Cursor segmentation of a stream of level frames: cuts at quiet frames, as soon as the watermark has passed a window."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from loomwright.operators.signal import threshold_of

_STATE = "cursor long, at array<long>, level array<double>"


def _cut(cursor: int, at: np.ndarray, level: np.ndarray, shortest: int, longest: int) -> tuple[int, str]:
    """Where to cut after ``cursor``: the quietest silent frame of the window, of equals the one nearest to its middle, then the later one."""
    ahead = (at >= cursor + shortest) & (at <= cursor + longest)
    if ahead.any():
        quiet = np.flatnonzero(ahead & (level <= threshold_of(level[at <= cursor + longest])))
        if len(quiet):
            far = np.abs(at[quiet] - (cursor + (shortest + longest) // 2))
            return int(at[quiet[np.lexsort((-at[quiet], far, level[quiet]))[0]]]), "silence"
    return cursor + longest, "max"


def cursor_segments(stream: DataFrame, key: str, time: str, level: str, shortest_sec: float, longest_sec: float, lateness: str) -> DataFrame:
    """``key, start, end, method`` of segments of ``shortest_sec`` to ``longest_sec`` for each key, one after another.

    A window is settled once the watermark has passed its end: with a frame
    after it, it is cut (silence, or max where no frame is quiet enough for
    the levels held); without one the segment ends at its last frame (tail),
    and the next frame begins a new one. So the result does not hang on how
    frames fall into batches, and what is held of a key is bounded by one
    window and the lateness. Frames later than the watermark allows, and
    frames without key, time or level, are left out.
    """
    short, long = round(shortest_sec * 1e6), round(longest_sec * 1e6)
    kind = stream.schema[key].dataType.simpleString()

    def run(keys: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        cursor, at, levels = state.get if state.exists else (None, [], [])
        at, levels = np.array(at, np.int64), np.array(levels, float)
        passed = state.getCurrentWatermarkMs() * 1000
        for part in frames:
            new = part["at"].to_numpy(np.int64)
            use = new > passed
            at, levels = np.append(at, new[use]), np.append(levels, part["level"].to_numpy(float)[use])
        order = np.lexsort((levels, at))
        at, levels = at[order], levels[order]
        rows = []
        while len(at):
            cursor = int(at[0]) if cursor is None else min(cursor, int(at[0]))
            if passed < cursor + long:
                break
            if at[-1] > cursor + long:
                end, method = _cut(cursor, at, levels, short, long)
                keep = at >= end
            else:
                end, method, keep = int(at[-1]), "tail", np.zeros(len(at), bool)
            rows.append((keys[0], cursor, end, method))
            at, levels, cursor = at[keep], levels[keep], end if keep.any() else None
        if len(at):
            state.update((cursor, at.tolist(), levels.tolist()))
            state.setTimeoutTimestamp(max((cursor + long) // 1000 + 1, passed // 1000 + 1))
        elif state.exists:
            state.remove()
        if rows:
            yield pd.DataFrame(rows, columns=[key, "start", "end", "method"])

    timed = stream.withWatermark(time, lateness).where(F.col(key).isNotNull() & F.col(time).isNotNull() & F.col(level).isNotNull())
    flat = timed.select(key, time, F.unix_micros(time).alias("at"), F.col(level).cast("double").alias("level"))
    found = flat.groupBy(key).applyInPandasWithState(run, f"`{key}` {kind}, start long, end long, method string", _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return found.select(key, F.timestamp_micros("start").alias("start"), F.timestamp_micros("end").alias("end"), "method")
