"""Planners that cut a source's tokens into segments of bounded length at punctuation pauses.

A strategy is a list of phases over regions that end at must-cuts. In each
phase a chain of segments is chosen by dynamic programming: the chain starts
where its region does, every link has an admissible trimmed length, and the
best reachable end wins. What is solved is taken out of the regions before
the next phase; what no phase covers is left over and dropped.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwright.operators.pauses import FALLBACK, FEWEST, NAMES, POINTS
from loomwright.sources.audio import decode_wav, trim

# Fixed values of the rules, in seconds and milliseconds.
PADDING_SEC = 0.1
SLACK_SEC = 0.35
OVERSHOOT_SEC = 8.0
ANCHOR_SEC = (15.0, 30.0)
STRATEGIES = ("legacy_dp", "priority_silence_v1", "priority_silence_v2", "priority_silence_v3", "dp_strategy_2", "llm_pause_priority_silence_v2")


@dataclass(frozen=True)
class Boundary:
    token: int
    kind: str
    pause: float
    ident: int = -1
    quality: str = "bad"
    policy: str = "normal"
    label: str = "ok"


@dataclass(frozen=True)
class Link:
    first: int
    end: Boundary
    raw: float
    trimmed: float
    valid: bool
    phase: str

    def row(self) -> tuple:
        return (self.first, self.end.token, self.raw, self.trimmed, self.valid, self.phase == "leftover", self.phase, self.end.kind, self.end.pause)


@dataclass
class Quantiles:
    p5: float = FALLBACK[0]
    p20: float = FALLBACK[1]
    p40: float = FALLBACK[2]
    p50: float = FALLBACK[3]
    p60: float = FALLBACK[4]
    p80: float = FALLBACK[5]
    p95: float = FALLBACK[6]

    @classmethod
    def of(cls, values: Sequence[float]) -> Quantiles:
        return cls(**dict(zip(NAMES, np.quantile(values, POINTS).tolist(), strict=True))) if len(values) >= FEWEST else cls()


@dataclass
class Source:
    """Token times of one source, its boundaries by token, quantiles, and how long a stretch is once trimmed."""

    starts: Sequence[float]
    ends: Sequence[float]
    boundaries: list[Boundary]
    strong: Quantiles
    weak: Quantiles
    shortest: float
    longest: float
    trim: Callable[[float, float], float] | None = None  # none: nothing is taken off
    most_trim: float | None = None  # the most seconds that ``trim`` takes off; without it no stretch is too long to try

    def opens(self, k: int) -> float:
        if k == 0:
            return self.starts[0]
        return max((self.ends[k - 1] + self.starts[k]) / 2, self.starts[k] - PADDING_SEC)

    def closes(self, k: int) -> float:
        if k + 1 >= len(self.ends):
            return self.ends[k]
        return min((self.ends[k] + self.starts[k + 1]) / 2, self.ends[k] + PADDING_SEC)

    def lengths(self, first: int, last: int) -> tuple[float, float]:
        a, b = self.opens(first), self.closes(last)
        return max(0.0, b - a), self.trim(a, b) if self.trim else b - a

    def reach(self) -> float:
        """Seconds beyond which no untrimmed stretch can be valid."""
        taken = 0.0 if self.trim is None else math.inf if self.most_trim is None else self.most_trim
        return self.longest + taken + 1e-9

    def link(self, first: int, end: Boundary, phase: str) -> Link:
        raw, trimmed = self.lengths(first, end.token)
        return Link(first, end, round(raw, 3), round(trimmed, 3), self.shortest <= trimmed <= self.longest, phase)


Region = tuple[int, Boundary]


def chain(source: Source, region: Region, inner: Sequence[Boundary], phase: str, zero: tuple, add: Callable[[tuple, Link], tuple], to_end: bool) -> list[Link]:
    """The best chain of valid links from the start of a region; ``to_end``: it must reach the region's end."""
    start, last = region
    stops = {b.token: b for b in inner if start <= b.token < last.token}
    stops[last.token] = last
    points = [stops[t] for t in sorted(stops)]
    reached: list[tuple[tuple, int, Link | None]] = [(zero, -1, None)]  # place 0: nothing chosen yet
    where = [start]
    latest = [source.opens(start)]  # of this place and all before it
    reach = source.reach()
    for b in points:
        best, closes = None, source.closes(b.token)
        for k in range(len(where) - 1, -1, -1):
            if closes - latest[k] > reach:  # so are all places before it
                break
            first = where[k]
            if first is None or first > b.token:
                continue
            link = source.link(first, b, phase)
            if link.valid and link.trimmed > 0:
                score = add(reached[k][0], link)
                if best is None or score >= best[0]:  # of equals the earliest place
                    best = (score, k, link)
        reached.append(best or (zero, -1, None))
        where.append(b.token + 1 if best else None)
        latest.append(max(latest[-1], source.opens(b.token + 1)) if best and b.token + 1 < len(source.starts) else latest[-1])
    ends = [k for k, first in enumerate(where) if first is not None]
    if to_end:
        if where[-1] is None:
            return []
        at = len(where) - 1
    else:
        at = max(ends, key=lambda k: (reached[k][0], -k))
    out = []
    while at > 0:
        out.append(reached[at][2])
        at = reached[at][1]
    return out[::-1]


def _more_segments(score: tuple, link: Link) -> tuple:
    return (score[0] + link.trimmed, score[1] + 1, score[2] + link.end.pause)


def _more_silence(score: tuple, link: Link) -> tuple:
    return (score[0] + link.trimmed, score[1] + round(link.end.pause), score[2] + 1)


def regions_of(source: Source, must: Callable[[Boundary], bool]) -> list[Region] | None:
    """Stretches between must-cuts; None unless the last boundary closes the source."""
    cuts = [b for b in source.boundaries if must(b)]
    if not cuts or cuts[-1].kind != "final":
        return None
    out, start = [], 0
    for b in cuts:
        if start <= b.token:
            out.append((start, b))
        start = b.token + 1
    return out


def without(regions: list[Region], solved: list[Link]) -> list[Region]:
    """Regions less what is solved; a stretch before a solved link ends at a synthetic boundary."""
    out = []
    links = sorted(solved, key=lambda x: (x.first, x.end.token))
    firsts = [x.first for x in links]
    for start, last in regions:
        at = start
        # solved links do not overlap: only the one before may reach into the region
        for link in links[max(0, bisect.bisect_left(firsts, start) - 1) : bisect.bisect_right(firsts, last.token)]:
            if link.end.token < at:
                continue
            if at < link.first:
                out.append((at, Boundary(link.first - 1, "synthetic", 0.0)))
            at = max(at, link.end.token + 1)
        if at <= last.token:
            out.append((at, last))
    return out


def inside(boundaries: Sequence[Boundary], regions: list[Region]) -> list[Boundary]:
    spans = sorted((start, last.token) for start, last in regions)  # they do not overlap
    firsts = [x for x, _ in spans]

    def held(token: int) -> bool:
        k = bisect.bisect_right(firsts, token) - 1
        return k >= 0 and token < spans[k][1]

    return [b for b in boundaries if held(b.token)]


@dataclass(frozen=True)
class Phase:
    name: str
    pick: Callable[[list[Boundary]], list[Boundary]]
    add: Callable[[tuple, Link], tuple]
    needs_inner: bool = False


def by_phases(source: Source, must: Callable[[Boundary], bool], phases: Sequence[Phase]) -> list[Link] | None:
    regions = regions_of(source, must)
    if regions is None:
        return None
    solved: list[Link] = []
    left = regions
    for phase in phases:
        picked = sorted(phase.pick([b for b in inside(source.boundaries, left) if not must(b)]), key=lambda b: b.token)
        tokens = [b.token for b in picked]
        found = []
        for region in left:
            inner = picked[bisect.bisect_left(tokens, region[0]) : bisect.bisect_left(tokens, region[1].token)]
            links = chain(source, region, inner, phase.name, (0.0, 0, 0), phase.add, False)
            if phase.needs_inner and not any(x.end.token < region[1].token for x in links):
                links = []
            found += links
        solved += found
        left = without(left, found)
    solved += [source.link(start, last, "leftover") for start, last in left]
    return sorted(solved, key=lambda x: (x.first, x.end.token))


def better_half(boundaries: Sequence[Boundary]) -> list[Boundary]:
    """Strong ones first, then weak ones, each by longer pause, token and id; half of them, rounded up."""
    order = sorted((b for b in boundaries if b.kind in ("strong", "weak")), key=lambda b: (b.kind != "strong", -b.pause, b.token, b.ident))
    return order[: math.ceil(len(boundaries) / 2)]


def _keep(rule: Callable[[Boundary], bool]) -> Callable[[list[Boundary]], list[Boundary]]:
    return lambda bs: [b for b in bs if rule(b)]


def priority_v1(s: Source) -> list[Link] | None:
    floor = max(s.weak.p60, 120.0)
    must = lambda b: b.kind == "final" or (b.kind == "strong" and b.pause >= max(s.strong.p80, 220.0))
    return by_phases(s, must, [
        Phase("good_cut", _keep(lambda b: b.kind == "strong" and b.pause >= floor), _more_segments, True),
        Phase("valid_cut", _keep(lambda b: b.pause >= floor), _more_silence),
    ])


def priority_v2(s: Source) -> list[Link] | None:
    legal = lambda b: b.kind in ("strong", "weak") and b.pause >= s.weak.p60
    must = lambda b: b.kind == "final" or (b.kind == "strong" and b.pause >= max(s.strong.p80, 220.0))
    return by_phases(s, must, [
        Phase("good_cut", _keep(lambda b: b.kind == "strong" and b.pause >= s.weak.p60), _more_segments, True),
        Phase("top50_cut", lambda bs: better_half([b for b in bs if legal(b)]), _more_silence),
        Phase("remaining50_cut", _keep(legal), _more_silence),
    ])


def priority_v3(s: Source) -> list[Link] | None:
    q = Quantiles.of([b.pause for b in s.boundaries if b.kind in ("strong", "weak")])
    marked = lambda b, least: b.kind in ("strong", "weak") and b.pause >= least
    must = lambda b: b.kind == "final" or (b.kind == "strong" and b.pause >= q.p80)
    return by_phases(s, must, [
        Phase("combined_p60_strong_cut", _keep(lambda b: b.kind == "strong" and b.pause >= q.p60), _more_segments, True),
        Phase("combined_p60_cut", _keep(lambda b: marked(b, q.p60)), _more_silence),
        Phase("combined_p40_cut", _keep(lambda b: marked(b, q.p40)), _more_silence),
    ])


def labelled_step(s: Source, b: Boundary) -> str:
    """The step in which a labelled boundary may be cut at."""
    if b.kind == "final" or (b.label == "good" and b.pause >= s.strong.p80):
        return "must_cut"
    if b.label == "bad" or b.pause <= s.weak.p20:
        return "not_candidate"
    if b.pause >= s.weak.p50:
        return "step2_good_median" if b.label == "good" else "step3_good_or_ok"
    return "step3_good_or_ok" if b.label == "good" else "step4_not_bad"


def labelled_v2(s: Source) -> list[Link] | None:
    steps = ("step2_good_median", "step3_good_or_ok", "step4_not_bad")
    phases = [
        Phase(name, _keep(lambda b, k=k: labelled_step(s, b) in steps[: k + 1]), _more_segments if k == 0 else _more_silence, k == 0)
        for k, name in enumerate(steps)
    ]
    return by_phases(s, lambda b: labelled_step(s, b) == "must_cut", phases)


def dp_score(s: Source, b: Boundary) -> int | None:
    """What a cut is worth under dp_strategy_2; None where it must not be made."""
    if b.kind == "final":
        return 0
    if b.kind not in ("strong", "weak") or b.pause <= s.weak.p20:
        return None
    steps = ((s.strong.p80, 3), (max(s.strong.p60, s.weak.p60), 2), (s.weak.p60, 1))
    worth = next((v for least, v in steps if b.pause >= least), -1)
    return worth + (2 if b.kind == "strong" else -1)


def dp_strategy_2(s: Source) -> list[Link] | None:
    must = lambda b: b.kind == "final" or (b.kind == "strong" and b.pause >= s.strong.p80)
    regions = regions_of(s, must)
    if regions is None:
        return None
    strong = sorted((b for b in s.boundaries if b.kind == "strong"), key=lambda b: b.token)
    tokens = [b.token for b in strong]
    middle = (s.shortest + s.longest) / 2
    floor = max(s.strong.p60, s.weak.p60)
    between = np.append(0, np.cumsum([floor < b.pause < s.strong.p80 for b in strong], dtype=np.int64)).tolist()

    def add(score: tuple, link: Link) -> tuple:
        a, z = bisect.bisect_left(tokens, link.first), bisect.bisect_left(tokens, link.end.token)
        spoilt = z - a + between[z] - between[a]
        worth = (dp_score(s, link.end) or 0) + (link.trimmed <= middle) - spoilt
        ms = round(link.trimmed * 1000)
        return (score[0] + ms, score[1] + worth, min(score[2], -ms), score[3] + 1, score[4] + round(link.end.pause))

    out: list[Link] = []
    for region in regions:
        legal = [b for b in inside(s.boundaries, [region]) if dp_score(s, b) is not None and not must(b)]
        out += chain(s, region, legal, "dp_strategy_2", (0, 0, 0, 0, 0), add, True) or [s.link(*region, "leftover")]
    return out


class Unplanned(Exception):
    """A planner got stuck; it carries the segments made so far."""

    def __init__(self, problem: str, links: list[Link]):
        super().__init__(problem)
        self.links = links


def legacy(s: Source) -> list[Link]:
    """Windows up to an anchor 15 to 30 s ahead; in each the path with the fewest bad lengths and cuts."""
    rank = {"perfect": 0, "ok": 1}
    order = lambda b: (b.policy != "must_cut", rank.get(b.quality, 2), -round(b.pause), b.token)
    target = (s.shortest + s.longest) / 2
    out: list[Link] = []
    start = 0
    while start < len(s.starts):
        ahead = [(s.closes(b.token) - s.opens(start), b) for b in s.boundaries if b.token >= start and b.policy != "no_cut"]
        near = [b for d, b in ahead if d <= ANCHOR_SEC[1] + 1e-6]
        window = [b for d, b in ahead if ANCHOR_SEC[0] <= d <= ANCHOR_SEC[1] + 1e-6]
        if not near:
            raise Unplanned("unable to choose planning anchor", out)
        if near[-1].kind == "final":
            anchor = near[-1]
        else:
            stops = [b for b in window if b.kind in ("strong", "final")] or [b for b in window if b.kind == "weak"]
            anchor = min(stops, key=order) if stops else max(window, key=lambda b: (b.pause, -rank.get(b.quality, 2), -b.token)) if window else max(near, key=lambda b: b.token)
        points = [b for b in s.boundaries if start <= b.token <= anchor.token]
        best: list[tuple[tuple, int, Link] | None] = []
        for j, b in enumerate(points):
            found = None
            for i in range(j - 1, -2, -1) if b.policy != "no_cut" else ():
                if i + 1 < j and points[i + 1].policy == "must_cut":
                    break  # a must-cut would be skipped
                if i >= 0 and best[i] is None:
                    continue
                first = start if i < 0 else points[i].token + 1
                raw, trimmed = s.lengths(first, b.token)
                if first > b.token or raw > s.longest + OVERSHOOT_SEC:
                    continue
                fits = s.shortest <= trimmed <= s.longest
                nearly = s.shortest <= raw <= s.longest or max(0.0, s.shortest - SLACK_SEC) <= trimmed <= s.longest + SLACK_SEC
                cost = (not fits and not nearly, not fits and nearly, b.quality not in rank, b.quality == "ok", round(abs(trimmed - target) * 1000))
                score = tuple(map(sum, zip(best[i][0] if i >= 0 else (0,) * 5, cost, strict=True)))
                if found is None or score <= found[0]:  # towards earlier starts, so that the first of equals stays
                    found = (score, i, s.link(first, b, "legacy_dp"))
            best.append(found)
        if best[-1] is None:
            raise Unplanned("unable to plan a cut path to the selected anchor", out)
        path, at = [], len(points) - 1
        while at >= 0:
            path.append(best[at][2])
            at = best[at][1]
        out += path[::-1]
        start = anchor.token + 1
    return out


def valid_cuts(submitted: list[int], markers: list[int]) -> str | None:
    """Why a list of cut markers is refused: it must rise, be known and end at the last marker; None if it is fine."""
    if not submitted:
        return "no cuts"
    if any(b <= a for a, b in zip(submitted, submitted[1:], strict=False)):
        return "cuts must be strictly increasing"
    if unknown := sorted(set(submitted) - set(markers)):
        return f"unknown markers: {unknown}"
    return None if submitted[-1] == markers[-1] else "the last cut must be the last marker"


def sliced_by_asker(s: Source, ask: Callable[[list[int], str], list[int]], attempts: int = 3, padding: float = 0.2) -> tuple[list[Link], str]:
    """Segments at the markers (places in ``boundaries``) that an asker submits; ``submitted``, ``unconfirmed`` or ``fallback``.

    A refused list, or one with segments out of bounds once padded, goes
    back with its reason; an asker that submits the same list again
    confirms it. Without a valid list priority_silence_v3 plans.
    """
    markers, said, last = list(range(len(s.boundaries))), "", None
    for _ in range(attempts):
        cuts = ask(markers, said)
        if problem := valid_cuts(cuts, markers):
            said = problem
            continue
        firsts = [0, *(s.boundaries[c].token + 1 for c in cuts[:-1])]
        links = [s.link(a, s.boundaries[c], "submitted") for a, c in zip(firsts, cuts, strict=True)]
        off = [f"{x.first}-{x.end.token}: {x.trimmed + 2 * padding:.2f} s" for x in links if not s.shortest <= x.trimmed + 2 * padding <= s.longest]
        if not off or (last is not None and last[0] == cuts):
            return links, "submitted"
        last, said = (cuts, links), "out of bounds: " + "; ".join(off)
    return (last[1], "unconfirmed") if last else (priority_v3(s) or [], "fallback")


PLANNERS: dict[str, Callable[[Source], list[Link] | None]] = dict(zip(STRATEGIES, (legacy, priority_v1, priority_v2, priority_v3, dp_strategy_2, labelled_v2), strict=True))
PLAN_SCHEMA = "first_token long, last_token long, raw_sec double, trimmed_sec double, valid boolean, dropped boolean, phase string, kind string, pause_ms double, problem string"


def plan(strategy: str, source: Source) -> tuple[list[Link], str | None]:
    """Segments of a source, or what kept the strategy from making them."""
    if strategy not in PLANNERS:
        return [], f"unknown rough cut strategy: {strategy}"
    if not source.boundaries:
        return [], "no candidate punctuation boundaries found"
    try:
        links = PLANNERS[strategy](source)
    except Unplanned as e:
        return e.links, str(e)
    return (links, None) if links is not None else ([], f"{strategy} found no final must_cut boundary")


def trimmed_lengths(signal: np.ndarray, rate: int, top_db: float = 60.0, frame: int = 2048, hop: int = 512) -> tuple[Callable[[float, float], float], float]:
    """How many seconds of a stretch are left without its silent ends, and the most seconds that this takes off any stretch.

    What is taken off lies in runs of frames under the loudest of the whole
    signal by as much; 6 dB and two frames allow for other frame places.
    """
    known: dict[tuple[int, int], float] = {}

    def left(start: float, end: float) -> float:
        key = max(0, round(start * rate)), min(len(signal), round(end * rate))
        if key not in known:
            first, last = trim(signal[slice(*key)], top_db, frame, hop) if key[1] > key[0] else (0, 0)
            known[key] = (last - first) / rate
        return known[key]

    x = np.pad(signal.astype(np.float64), frame // 2)
    total = np.append(0, np.cumsum(x * x))
    at = np.arange(0, len(x) - frame + 1, hop)
    power = (total[at + frame] - total[at]) / frame
    edge = np.flatnonzero(np.diff(np.concatenate([[0], (power <= power.max() * 10 ** (-top_db / 10) * 4).astype(np.int8), [0]])))
    longest = int((edge[1::2] - edge[::2]).max(initial=0))
    return left, 2 * (longest * hop + 2 * frame) / rate


def plan_segments(tokens: DataFrame, strategy: str, shortest: float, longest: float, source: str = "source_id", audio: DataFrame | None = None) -> DataFrame:
    """Segments of every source, planned side by side.

    ``tokens``: a row for each token with idx, start_sec, end_sec; where a
    boundary follows, kind, pause_ms (and quality, policy, label); structs
    strong and weak of the source's pause quantiles. With ``audio`` (the
    source and WAV ``content``, a row each) segments are judged by their
    lengths without silent ends; a source without audio by its whole lengths.
    """
    kind = tokens.schema[source].dataType.simpleString()

    def planned(part: pd.DataFrame, sound: tuple) -> pd.DataFrame:
        part = part.sort_values("idx")
        cut = part[part["kind"].notna()]
        extra = {c: cut[c].tolist() if c in cut else [d] * len(cut) for c, d in (("quality", "bad"), ("policy", "normal"), ("label", "ok"))}
        place = {int(i): k for k, i in enumerate(part["idx"])}
        boundaries = [Boundary(place[int(t)], k, float(p), n, *x) for n, (t, k, p, *x) in enumerate(zip(cut["idx"], cut["kind"], cut["pause_ms"], *extra.values(), strict=True))]
        quantile = [Quantiles(**{n: float(part[f"{c}_{n}"].iloc[0]) for n in NAMES}) for c in ("strong", "weak")]
        links, problem = plan(strategy, Source(part["start_sec"].tolist(), part["end_sec"].tolist(), boundaries, *quantile, shortest, longest, *sound))
        rows = [(*x.row(), None) for x in links] + ([(None,) * 9 + (problem,)] if problem else [])
        names = [c.split()[0] for c in PLAN_SCHEMA.split(", ")]
        return pd.DataFrame(rows, columns=names).assign(**{source: part[source].iloc[0]})[[source, *names]]

    # flat columns, and only those that are read: a struct on each token would become a dict on each token
    used = [c for c in (source, "idx", "start_sec", "end_sec", "kind", "pause_ms", "quality", "policy", "label") if c in tokens.columns]
    flat = tokens.select(*used, *(F.col(c)[n].alias(f"{c}_{n}") for c in ("strong", "weak") for n in NAMES))
    if audio is None:
        return flat.groupBy(source).applyInPandas(lambda part: planned(part, ()), f"{source} {kind}, {PLAN_SCHEMA}")

    def heard(part: pd.DataFrame, files: pd.DataFrame) -> pd.DataFrame:
        if not len(part):
            return pd.DataFrame(columns=[source, *(c.split()[0] for c in PLAN_SCHEMA.split(", "))])
        return planned(part, trimmed_lengths(*decode_wav(files["content"].iloc[0])) if len(files) else ())

    return flat.groupBy(source).cogroup(audio.select(source, "content").groupBy(source)).applyInPandas(heard, f"{source} {kind}, {PLAN_SCHEMA}")


def next_window(source: Source, first: int, least_sec: float = 15.0, sentences: int = 3, extension: int = 2) -> list[Boundary]:
    """Boundaries of the window that a model is shown next: from token ``first`` until it is long enough or has its sentences, then up to ``extension`` sentences more."""
    out: list[Boundary] = []
    ended, most = 0, None
    for b in source.boundaries:
        if b.token < first:
            continue
        if most is not None and ended >= most:
            break
        out.append(b)
        ended += b.kind in ("strong", "final")
        if most is None and (source.closes(b.token) - source.opens(first) >= least_sec or ended >= sentences or b.kind == "final"):
            most = ended + extension
        if b.kind == "final":
            break
    return out
