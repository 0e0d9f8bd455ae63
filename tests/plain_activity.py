"""Packing of a source's regions by one fold, to hold the operator over rows to."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame


def pack_levels(regions: DataFrame, rows: DataFrame, key: str, budget: float, least: float, time: str, level: str, start: str = "start", end: str = "end") -> DataFrame:
    """``pack_regions`` with no chunk over the budget: longer regions are cut, again and again, where the source is quietest.

    A cut is the row of ``rows`` (key, time, level) with the least level from
    ``least`` after the last cut until before the budget (the first of
    equals); where all are alike or none is, the budget itself. Parts cut
    off are chunks of their own, the last part is packed with what follows.
    A source without regions is cut all over from its first row to its last.
    ``n`` counts regions and their parts; a source without regions has 0.
    """
    if budget <= 0:
        raise ValueError("the budget must be positive")
    kind = regions.schema[key].dataType.simpleString()
    times = regions.schema[start].dataType.simpleString()

    def fold(of: tuple, part: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        found = found.dropna(subset=[time, level]).sort_values(time, kind="stable")
        at, loud = found[time].to_numpy(), found[level].to_numpy(float)

        def cut(a, hard):
            i, j = at.searchsorted(a + least, "left"), at.searchsorted(hard, "left")
            i = max(i, at.searchsorted(a, "right"))
            here = loud[i:j]
            if not len(here) or (len(here) > 1 and here.max() - here.min() <= 1e-6):
                return hard
            return at[i + here.argmin()]

        out: list[tuple] = []
        if not len(part) and len(at):
            a, last = at[0], at[-1]
            while a < last:
                b = cut(a, min(a + budget, last))
                out.append((a, b, 0))
                a = b
            if not out:  # all rows at one time
                out.append((a, last, 0))
        now = None
        for a, b in part.sort_values([start, end])[[start, end]].itertuples(index=False):
            if now and b - a > budget:
                out.append(now)
                now = None
            while b - a > budget:
                c = cut(a, a + budget)
                out.append((a, c, 1))
                a = c
            if now and b - now[0] <= budget:
                now = (now[0], max(now[1], b), now[2] + 1)
            else:
                out += [now] if now else []
                now = (a, b, 1)
        out += [now] if now else []
        return pd.DataFrame([(of[0], k, *x) for k, x in enumerate(out)], columns=[key, "chunk", start, end, "n"])

    levels = rows.select(key, time, level).groupBy(key)
    return regions.select(key, start, end).groupBy(key).cogroup(levels).applyInPandas(fold, f"{key} {kind}, chunk long, {start} {times}, {end} {times}, n long")
