"""Planners that cut a source's tokens into segments of bounded length at punctuation pauses.

A strategy is a set of rules over boundary rows: which are must-cuts, which
may be cut at in which phase, what a cut is worth. Must-cuts number the
regions of a source by a running sum; a region's rows meet in one task, sorted,
and a chain of segments is chosen there by dynamic programming over a window of
starts: it begins where the region does, every link has an admissible trimmed
length, and the best reachable end wins. What a phase has solved is the head
of its region; the next phase goes on behind it, and what none covers is left
over. Regions of one source are independent, so a long source spreads over
tasks.

Tokens are in the order of time within a source.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomwright.functions.pointers import sorted_groups
from loomwright.functions.tables import written
from loomwright.operators.pauses import LONGEST_PAUSE_MS, beside
from loomwright.sources.audio import decode, trim

# Fixed values of the rules, in seconds and milliseconds.
PADDING_SEC = 0.1
SLACK_SEC = 0.35
OVERSHOOT_SEC = 8.0
ANCHOR_SEC = (15.0, 30.0)
STRATEGIES = ("legacy_dp", "priority_silence_v1", "priority_silence_v2", "priority_silence_v3", "dp_strategy_2", "llm_pause_priority_silence_v2")
PLAN_FIELDS = "first_token long, last_token long, raw_sec double, trimmed_sec double, valid boolean, dropped boolean, phase string, kind string, pause_ms double, problem string"


# -- boundaries as rows ------------------------------------------------------


def boundary_rows(tokens: DataFrame, source: str = "source_id", keep: tuple[str, ...] = ("quality", "policy", "label")) -> DataFrame:
    """A row for each token that a boundary follows.

    ``token`` is its place in the source; a stretch that ends here
    ``closes`` in the pause behind it, and one that begins behind the row
    before begins at ``from_token`` and opens at ``from_opens``. ``row``
    numbers the boundaries, ``n_tokens`` counts the source's tokens.

    Where tokens know their ``place`` in the source, when the next one starts
    (``next_sec``, null behind the last) and the first one (``first_sec``),
    those that no boundary follows may be left out, but for a source's last;
    either all of a source's tokens know their place or none does.
    """
    return _rows_of_all(tokens, source, keep).where("kind is not null")


def _rows_of_all(tokens: DataFrame, source: str, keep: tuple[str, ...], ends: bool = False) -> DataFrame:
    """Boundary rows, and of each source that no boundary divides its last token, which has no kind; with ``ends`` the last token of every source that no boundary follows.

    ``after`` is when the token behind starts, null behind the last.
    """
    by = Window.partitionBy(source).orderBy("idx")
    start, end, after = F.col("start_sec"), F.col("end_sec"), F.col("_after")
    # windows are columns of their own first: Spark computes one anew for each place it is named in
    timed = tokens.withColumns(
        {
            "token": F.row_number().over(by) - 1,
            "_after": F.lead(start).over(by),
            "_first_opens": F.first(start).over(by.rowsBetween(Window.unboundedPreceding, 0)),
            "_ends": F.lead(F.lit(1)).over(by).isNull(),
        }
    )
    if "place" in tokens.columns:
        known = F.col("place").isNotNull()
        told = {"token": F.col("place"), "_after": F.col("next_sec"), "_first_opens": F.col("first_sec"), "_ends": F.col("next_sec").isNull()}
        timed = timed.withColumns({c: F.when(known, x).otherwise(F.col(c)) for c, x in told.items()})
    # the last token stays for now, boundary or not: behind it there is no row that it could change
    timed = timed.where("kind is not null or _ends").withColumns(
        {
            "closes": F.when(after.isNull(), end).otherwise(F.least((end + after) / 2, end + PADDING_SEC)),
            "_next_opens": F.greatest((end + after) / 2, after - PADDING_SEC),
        }
    )
    rows = timed.withColumns(
        {
            "from_token": F.coalesce(F.lag("token").over(by) + 1, F.lit(0)),
            "from_opens": F.coalesce(F.lag("_next_opens").over(by), F.col("_first_opens")),
            "row": F.row_number().over(by) - 1,
            "n_tokens": (F.max("token").over(Window.partitionBy(source)) + 1).cast("long"),
        }
    )
    extra = [c for c in keep if c in tokens.columns]
    kept = rows if ends else rows.where("kind is not null or row = 0")
    return kept.select(source, "row", "token", "from_token", "from_opens", "closes", after.cast("double").alias("after"), "kind", F.col("pause_ms").cast("double").alias("pause_ms"), "n_tokens", *extra)


# -- rules of the strategies -------------------------------------------------


@dataclass(frozen=True)
class Rules:
    """What a strategy says about boundary rows; phases are tried in turn."""

    must: Column
    phases: tuple[tuple[str, Column], ...]
    needs_inner: bool = True  # the first phase counts only with a cut inside its region
    worth: Column | None = None  # of a cut, for chains that must reach the region's end
    spoils: Column | None = None  # what a boundary costs that a segment runs over


def _kind(*kinds: str) -> Column:
    return F.col("kind").isin(*kinds)


def rules_v1() -> Rules:
    pause, strong, weak = F.col("pause_ms"), F.col("strong"), F.col("weak")
    floor = F.greatest(weak["p60"], F.lit(120.0))
    must = _kind("final") | (_kind("strong") & (pause >= F.greatest(strong["p80"], F.lit(220.0))))
    return Rules(must, (("good_cut", _kind("strong") & (pause >= floor)), ("valid_cut", pause >= floor)))


def rules_v2() -> Rules:
    """The second phase takes the better half of what the first has left in a source (``in_top``)."""
    legal = _kind("strong", "weak") & (F.col("pause_ms") >= F.col("weak")["p60"])
    return Rules(rules_v1().must, (("good_cut", legal & _kind("strong")), ("top50_cut", F.col("in_top")), ("remaining50_cut", legal)))


def rules_v3() -> Rules:
    pause, q = F.col("pause_ms"), F.col("both")
    marked = _kind("strong", "weak")
    must = _kind("final") | (_kind("strong") & (pause >= q["p80"]))
    phases = (("combined_p60_strong_cut", _kind("strong") & (pause >= q["p60"])), ("combined_p60_cut", marked & (pause >= q["p60"])), ("combined_p40_cut", marked & (pause >= q["p40"])))
    return Rules(must, phases)


def labelled_step() -> Column:
    """The step in which a labelled boundary may be cut at."""
    pause, strong, weak, label = F.col("pause_ms"), F.col("strong"), F.col("weak"), F.col("label")
    good = label == "good"
    return (
        F.when(_kind("final") | (good & (pause >= strong["p80"])), "must_cut")
        .when((label == "bad") | (pause <= weak["p20"]), "not_candidate")
        .when(pause >= weak["p50"], F.when(good, "step2_good_median").otherwise("step3_good_or_ok"))
        .otherwise(F.when(good, "step3_good_or_ok").otherwise("step4_not_bad"))
    )


def rules_labelled() -> Rules:
    steps = ("step2_good_median", "step3_good_or_ok", "step4_not_bad")
    step = labelled_step()
    return Rules(step == "must_cut", tuple((name, step.isin(*steps[: k + 1])) for k, name in enumerate(steps)))


def dp_score() -> Column:
    """What a cut is worth under dp_strategy_2; null where it must not be made."""
    pause, strong, weak = F.col("pause_ms"), F.col("strong"), F.col("weak")
    worth = F.when(pause >= strong["p80"], 3).when(pause >= F.greatest(strong["p60"], weak["p60"]), 2).when(pause >= weak["p60"], 1).otherwise(-1)
    return F.when(_kind("final"), 0).when(_kind("strong", "weak") & (pause > weak["p20"]), worth + F.when(_kind("strong"), 2).otherwise(-1))


def rules_dp2() -> Rules:
    pause, strong, weak = F.col("pause_ms"), F.col("strong"), F.col("weak")
    between = (pause > F.greatest(strong["p60"], weak["p60"])) & (pause < strong["p80"])
    must = _kind("final") | (_kind("strong") & (pause >= strong["p80"]))
    spoils = F.when(_kind("strong"), 1 + between.cast("int")).otherwise(0)
    return Rules(must, (("dp_strategy_2", dp_score().isNotNull()),), False, F.coalesce(dp_score(), F.lit(0)), spoils)


RULES: dict[str, Callable[[], Rules]] = dict(zip(STRATEGIES[1:], (rules_v1, rules_v2, rules_v3, rules_dp2, rules_labelled), strict=True))


# -- chains of links within a region -----------------------------------------


class Region:
    """The rows of a region, in order: stretches ``a`` to ``z`` of the lists of whole batches."""

    def __init__(self, columns: dict[str, list], a: int, z: int):
        self.columns, self.a, self.z, self.n = columns, a, z, z - a
        self.from_opens, self.closes, self.pause_ms = (columns[c][a:z] for c in ("from_opens", "closes", "pause_ms"))

    def part(self, column: str) -> list:
        return self.columns[column][self.a : self.z]

    @cached_property
    def flags(self) -> list:
        return self.part("flags")

    @cached_property
    def worth(self) -> list:
        return self.part("worth")

    @cached_property
    def before(self) -> list:
        """What the boundaries before each row cost."""
        return [0, *itertools.accumulate(self.part("spoils"))]


@dataclass(frozen=True)
class Bounds:
    shortest: float
    longest: float
    trim: Callable[[float, float], float] | None = None  # none: nothing is taken off
    most_trim: float = 0.0  # the most seconds that ``trim`` takes off

    def lengths(self, r: Region, s: int, e: int) -> tuple[float, float]:
        a, b = r.from_opens[s], r.closes[e]
        return max(0.0, b - a), self.trim(a, b) if self.trim else b - a

    def fits(self, trimmed: float) -> bool:
        return self.shortest <= trimmed <= self.longest


Link = tuple[int, int]  # first and last row


def _more_segments(score: tuple, r: Region, s: int, e: int, trimmed: float) -> tuple:
    return (score[0] + trimmed, score[1] + 1, score[2] + r.pause_ms[e])


def _more_silence(score: tuple, r: Region, s: int, e: int, trimmed: float) -> tuple:
    return (score[0] + trimmed, score[1] + round(r.pause_ms[e]), score[2] + 1)


def _more_worth(middle: float) -> Callable[..., tuple]:
    def add(score: tuple, r: Region, s: int, e: int, trimmed: float) -> tuple:
        worth = r.worth[e] + (trimmed <= middle) - (r.before[e] - r.before[s])
        ms = round(trimmed * 1000)
        return (score[0] + ms, score[1] + worth, min(score[2], -ms), score[3] + 1, score[4] + round(r.pause_ms[e]))

    return add


def best_chain(r: Region, begin: int, cuts: list[int], bounds: Bounds, zero: tuple, add: Callable[..., tuple], to_end: bool) -> list[Link]:
    """The best chain of valid links from the row ``begin`` over ``cuts`` (rows, the region's last one included); ``to_end``: it must reach that."""
    shortest, longest, trim, opens = bounds.shortest, bounds.longest, bounds.trim, r.from_opens
    reach = longest + bounds.most_trim + 1e-9
    scores: list[tuple] = [zero]
    came: list[tuple[int, Link | None]] = [(-1, None)]
    starts: list[int | None] = [begin]  # row that a link from here begins with
    latest = [r.from_opens[begin]]  # of this place and all before it
    for e in cuts:
        best, closes = None, r.closes[e]
        for k in range(len(starts) - 1, -1, -1):
            if closes - latest[k] > reach:  # so are all places before it
                break
            s = starts[k]
            if s is None:
                continue
            trimmed = trim(opens[s], closes) if trim else closes - opens[s]
            if shortest <= trimmed <= longest and (short := round(trimmed, 3)) > 0:
                score = add(scores[k], r, s, e, short)
                if best is None or score >= best[0]:  # of equals the earliest place
                    best = (score, k, (s, e))
        scores.append(best[0] if best else zero)
        came.append((best[1], best[2]) if best else (-1, None))
        starts.append(e + 1 if best else None)
        latest.append(max(latest[-1], r.from_opens[e + 1]) if best and e + 1 < r.n else latest[-1])
    if to_end:
        if starts[-1] is None:
            return []
        at = len(starts) - 1
    else:
        at = max((k for k, s in enumerate(starts) if s is not None), key=lambda k: (scores[k], -k))
    out = []
    while at > 0:
        at, link = came[at]
        out.append(link)
    return out[::-1]


Found = list[tuple[Link, str]]


def by_phases(names: list[str], needs_inner: bool, worth: bool, leftover: bool = True) -> Callable[[Region, Bounds], Found]:
    """Chains of a region's phases, each behind what those before it have solved."""

    def solve(r: Region, bounds: Bounds) -> Found:
        out: Found = []
        begin, last = 0, r.n - 1
        for p, name in enumerate(names):
            cuts = [k for k in range(begin, last) if r.flags[k] >> p & 1] + [last]
            if worth:
                links = best_chain(r, begin, cuts, bounds, (0,) * 5, _more_worth((bounds.shortest + bounds.longest) / 2), True)
            else:
                inner = p == 0 and needs_inner
                links = best_chain(r, begin, cuts, bounds, (0.0, 0, 0), _more_segments if inner else _more_silence, False)
                if inner and all(e == last for _, e in links):
                    links = []
            out += [(x, name) for x in links]
            if links:
                begin = links[-1][1] + 1
            if begin > last:
                return out
        return [*out, ((begin, last), "leftover")] if leftover else out

    return solve


#: What a path costs as one whole number, so that sums are compared field by field: lengths out of bounds, nearly so, bad cuts, fair cuts, ms off the middle.
OFF, NEARLY, BAD, FAIR = (1 << b for b in (120, 96, 72, 48))


def legacy_path(r: Region, bounds: Bounds) -> Found | None:
    """Between two anchors, the path with the fewest bad lengths and cuts; none may skip a must-cut. None where there is no path."""
    grade, policy, opens, closes = r.part("grade"), r.part("policy"), r.from_opens, r.closes
    shortest, longest, trim = bounds.shortest, bounds.longest, bounds.trim
    target, furthest, least, most = (shortest + longest) / 2, longest + OVERSHOOT_SEC, max(0.0, shortest - SLACK_SEC), longest + SLACK_SEC
    must, never, of_grade = POLICIES["must_cut"], POLICIES["no_cut"], (0, FAIR, BAD)
    best: list[int | None] = []  # of a path that ends at each row; None where there is none
    came: list[int] = []
    for j in range(r.n):
        found, before = None, -1
        if policy[j] != never:
            end = closes[j]
            for i in range(j - 1, -2, -1):
                if i + 1 < j and policy[i + 1] == must:
                    break  # a must-cut would be skipped
                cost = best[i] if i >= 0 else 0
                if cost is None:
                    continue
                length = end - opens[i + 1]
                raw = max(0.0, length)
                if raw > furthest:
                    continue
                trimmed = trim(opens[i + 1], end) if trim else length
                cost += round(abs(trimmed - target) * 1000)
                if not shortest <= trimmed <= longest:
                    cost += NEARLY if shortest <= raw <= longest or least <= trimmed <= most else OFF
                if found is None or cost <= found:  # towards earlier starts, so that the first of equals stays
                    found, before = cost, i
        best.append(None if found is None else found + of_grade[grade[j]])
        came.append(before)
    if best[-1] is None:
        return None
    path, at = [], r.n - 1
    while at >= 0:
        path.append(((came[at] + 1, at), "legacy_dp"))
        at = came[at]
    return path[::-1]


# -- regions dealt over tasks ------------------------------------------------

_READ = ("region", "token", "from_token", "from_opens", "closes", "kind", "pause_ms", "flags", "worth", "spoils", "grade", "policy", "problem")
_LISTED = ("from_opens", "closes", "pause_ms", "flags", "worth", "spoils", "grade", "policy")  # what solving reads


def _listed(column: pa.ChunkedArray) -> list:
    """A column's values; numbers by way of numpy, which is many times faster."""
    return column.to_pylist() if column.null_count or not (pa.types.is_integer(column.type) or pa.types.is_floating(column.type)) else column.to_numpy().tolist()


def plan_regions(rows: DataFrame, source: str, solve: Callable[[Region, Bounds], Found | None], shortest: float, longest: float, audio: DataFrame | None = None) -> DataFrame:
    """Segments of each (source, region) of boundary rows; a region is solved in one task, and no task holds a source.

    A row with a ``problem`` stands for a source that has no plan. Where
    ``solve`` finds none, the region gives one row with a problem.
    """
    kind = rows.schema[source].dataType.simpleString()
    by = Window.partitionBy(source, "region").orderBy("token")
    used = [c for c in _READ if c in rows.columns]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # as many tasks, however few bytes the rows have
    dealt = rows.select(source, *used).repartition(n, source, "region").withColumn("opens_region", F.row_number().over(by) == 1)
    fields = f"{source} {kind}, region long, {PLAN_FIELDS}"
    names = [f.split()[0] for f in fields.split(", ")]
    types = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_(), pa.bool_(), pa.string(), pa.string(), pa.float64(), pa.string())

    def solved(table: pa.Table, bounds: Bounds) -> pa.Table:
        table = table.combine_chunks()
        columns = {c: _listed(table[c]) for c in _LISTED if c in table.column_names}
        begins = np.flatnonzero(table["opens_region"].to_numpy()).tolist()
        problems = table["problem"].take(pa.array(begins, pa.int64())).to_pylist()
        first, last, made = [], [], []  # the rows of each link, and what is said of it
        for a, z, said in zip(begins, [*begins[1:], table.num_rows], problems, strict=True):
            found = []
            if said is None:
                r = Region(columns, a, z)
                found = solve(r, bounds)
                if found is None:
                    found, said = [], "unable to plan a cut path to the selected anchor"
            for (s, e), phase in found:
                raw, trimmed = bounds.lengths(r, s, e)
                first.append(a + s)
                last.append(a + e)
                made.append((round(raw, 3), round(trimmed, 3), bounds.fits(trimmed), phase == "leftover", phase, None))
            if said is not None:
                first.append(a)
                last.append(None)
                made.append((None,) * 5 + (said,))
        at, to = pa.array(first, pa.int64()), pa.array(last, pa.int64())
        raw, trimmed, valid, dropped, phase, problem = (pa.array([x[k] for x in made], t) for k, t in enumerate((*types[2:7], types[9])))
        begun = table["from_token"].take(pc.if_else(pc.is_valid(to), at, None))
        out = [begun, table["token"].take(to), raw, trimmed, valid, dropped, phase, table["kind"].take(to), table["pause_ms"].take(to), problem]
        return pa.table([table[source].take(at), table["region"].take(at), *(c.cast(t) for c, t in zip(out, types, strict=True))], names)

    if audio is None:
        plain = Bounds(shortest, longest)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table in sorted_groups(batches, "opens_region"):
                yield from solved(table.combine_chunks(), plain).to_batches()

        return dealt.mapInArrow(run, fields)

    def heard(table: pa.Table, parts: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("token")
        if not table.num_rows:
            return solved(table, Bounds(shortest, longest))
        if not parts.num_rows:
            return solved(table, Bounds(shortest, longest))
        part = parts.slice(0, 1).to_pylist()[0]
        left = trimmed_lengths(np.frombuffer(part["samples"], np.float32), part["rate"], part["from_sample"])
        return solved(table, Bounds(shortest, longest, left, part["most_trim"]))

    parts = region_audio(dealt, audio, source)
    return dealt.groupBy(source, "region").cogroup(parts.groupBy(source, "region")).applyInArrow(heard, fields)


def region_audio(rows: DataFrame, audio: DataFrame, source: str) -> DataFrame:
    """The samples of each region, cut out of its source's file in one task a file: ``from_sample``, ``rate``, ``samples`` and ``most_trim``."""
    kind = rows.schema[source].dataType.simpleString()
    spans = rows.groupBy(source, "region").agg(F.min("from_opens").alias("a"), F.max("closes").alias("z"))
    names = [source, "region", "from_sample", "rate", "most_trim", "samples"]

    def cut(spans: pa.Table, files: pa.Table) -> pa.Table:
        out: list[list] = [[] for _ in names]
        if files.num_rows and spans.num_rows:
            signal, rate = decode(files["content"][0].as_py())
            signal = signal.astype(np.float32)
            most = most_trimmed(signal, rate)
            for k, (region, a, z) in enumerate(zip(*(spans[c].to_pylist() for c in ("region", "a", "z")), strict=True)):
                i, j = max(0, round(a * rate)), min(len(signal), round(z * rate))
                for column, value in zip(out, (k, region, i, rate, most, signal[i:j].tobytes()), strict=True):
                    column.append(value)
        at = pa.array(out[0], pa.int64())
        types = (None, pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.binary())
        return pa.table([spans[source].take(at), *(pa.array(v, t) for v, t in list(zip(out, types, strict=True))[1:])], names)

    files = audio.select(source, "content")
    return spans.groupBy(source).cogroup(files.groupBy(source)).applyInArrow(cut, f"{source} {kind}, region long, from_sample long, rate long, most_trim double, samples binary")


def trimmed_lengths(signal: np.ndarray, rate: int, offset: int = 0, top_db: float = 60.0, frame: int = 2048, hop: int = 512) -> Callable[[float, float], float]:
    """How many seconds of a stretch are left without its silent ends; ``signal`` begins at the source's sample ``offset``."""
    known: dict[tuple[int, int], float] = {}

    def left(start: float, end: float) -> float:
        key = max(0, round(start * rate) - offset), min(len(signal), round(end * rate) - offset)
        if key not in known:
            first, last = trim(signal[slice(*key)], top_db, frame, hop) if key[1] > key[0] else (0, 0)
            known[key] = (last - first) / rate
        return known[key]

    return left


def most_trimmed(signal: np.ndarray, rate: int, top_db: float = 60.0, frame: int = 2048, hop: int = 512) -> float:
    """The most seconds that trimming takes off any stretch.

    What is taken off lies in runs of frames under the loudest of the whole
    signal by as much; 6 dB and two frames allow for other frame places.
    """
    x = np.pad(signal.astype(np.float64), frame // 2)
    total = np.append(0, np.cumsum(x * x))
    at = np.arange(0, len(x) - frame + 1, hop)
    power = (total[at + frame] - total[at]) / frame
    edge = np.flatnonzero(np.diff(np.concatenate([[0], (power <= power.max() * 10 ** (-top_db / 10) * 4).astype(np.int8), [0]])))
    longest = int((edge[1::2] - edge[::2]).max(initial=0))
    return 2 * (longest * hop + 2 * frame) / rate


# -- strategies --------------------------------------------------------------


_BARE = "no candidate punctuation boundaries found"


def _with_stats(rows: DataFrame, stats: DataFrame, source: str) -> DataFrame:
    of = stats.withColumnRenamed(source, "_of")
    return rows.join(of, F.col(source).eqNullSafe(F.col("_of")), "left").drop("_of")


def _flagged(rows: DataFrame, phases: tuple[tuple[str, Column], ...]) -> DataFrame:
    bits = (F.when(may, F.lit(1 << p)).otherwise(F.lit(0)) for p, (_, may) in enumerate(phases))
    return rows.withColumn("flags", reduce(lambda a, b: a.bitwiseOR(b), bits))


def _regions(rows: DataFrame, rules: Rules, strategy: str, source: str) -> DataFrame:
    """Boundary rows with the number of their region: must-cuts before them, by a running sum.

    Rows behind the last must-cut are in no region; a source whose last
    must-cut is not its final boundary keeps one row, with the problem.
    """
    by = Window.partitionBy(source).orderBy("token")
    whole = Window.partitionBy(source)
    rows = rows.withColumn("_must", F.coalesce(rules.must, F.lit(False)))
    last = F.max(F.when(F.col("_must"), F.struct("token", "kind"))).over(whole)
    numbered = rows.withColumn("region", F.coalesce(F.sum(F.col("_must").cast("long")).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("_last", last)
    lost = ~F.coalesce(F.col("_last.kind") == "final", F.lit(False))
    bare = F.col("kind").isNull()
    numbered = numbered.withColumn("problem", F.when(bare, _BARE).when(lost, F.lit(f"{strategy} found no final must_cut boundary"))).withColumn("pause_ms", F.when(bare, 0.0).otherwise(F.col("pause_ms")))
    return numbered.where((F.col("problem").isNull() & (F.col("token") <= F.col("_last.token"))) | (F.col("problem").isNotNull() & (F.col("row") == 0)))


def _problem(sources: DataFrame, source: str, said: str, *more: str) -> DataFrame:
    none = [F.lit(None).cast(f.split()[1]).alias(f.split()[0]) for f in PLAN_FIELDS.split(", ")[:-1]]
    return sources.select(source, *more, *none, F.lit(said).alias("problem"))


def _in_top(rows: DataFrame, source: str) -> DataFrame:
    """``in_top``: the better half of a source's legal rows: strong ones first, then by longer pause, token and place."""
    by = Window.partitionBy(source, "_legal")
    place = F.row_number().over(by.orderBy(F.when(F.col("kind") == "strong", 0).otherwise(1), F.col("pause_ms").desc(), "token", "row"))
    return rows.withColumn("in_top", F.col("_legal") & (place <= F.ceil(F.count("*").over(by) / 2)))


def _plan_v2(rows: DataFrame, rules: Rules, source: str, bounds: tuple[float, float], audio: DataFrame | None) -> DataFrame:
    """The first phase by itself; then the rest of every region, with the better half ranked over its source."""
    held = written(rows.withColumn("_legal", F.col("problem").isNull() & ~F.col("_must") & F.coalesce(rules.phases[2][1], F.lit(False))))
    first = written(plan_regions(_flagged(held, rules.phases[:1]), source, by_phases(["good_cut"], True, False, False), *bounds, audio))
    solved = first.where("problem is null").groupBy(F.col(source).alias("_s"), F.col("region").alias("_r")).agg(F.max("last_token").alias("_to"))
    rest = held.where("problem is null").join(solved, F.col(source).eqNullSafe(F.col("_s")) & (F.col("region") == F.col("_r")), "left")
    rest = _in_top(rest.where(F.col("_to").isNull() | (F.col("token") > F.col("_to"))).drop("_s", "_r", "_to"), source)
    names = [name for name, _ in rules.phases[1:]]
    return first.unionByName(plan_regions(_flagged(rest, rules.phases[1:]), source, by_phases(names, False, False), *bounds, audio))


# How rows of windows from anchor to anchor are ranked: kinds that a window may stop at, qualities, policies.
STOPS, GRADES, POLICIES = {"weak": 1, "strong": 2, "final": 3}, {"perfect": 0, "ok": 1}, {"must_cut": 0, "no_cut": 2}


def _code(column: str, codes: dict[str, int], other: int) -> Column:
    return reduce(lambda when, x: when.when(F.col(column) == x[0], x[1]), codes.items(), F).otherwise(other)


def anchor_of(first: int, n: int, ended: bool, x: dict[str, list]) -> int | None:
    """The row that a window from the row ``first`` on ends with, of ``n`` rows in order; -1 where no cut lies within reach, None where rows behind them may count.

    ``ended``: no rows of the source come behind them.
    """
    stop, policy, closes, after = x["stop"], x["policy"], x["closes"], x["after"]
    opens, reach = x["from_opens"][first], ANCHOR_SEC[1] + 1e-6
    near = []
    for e in range(first, n):
        if policy[e] != POLICIES["no_cut"] and closes[e] - opens <= reach:
            near.append(e)
        if after[e] - opens > reach:  # what comes behind closes later than that
            break
    else:
        if not ended:
            return None
    if not near:
        return -1
    if stop[near[-1]] == STOPS["final"]:
        return near[-1]
    window = [e for e in near if closes[e] - opens >= ANCHOR_SEC[0]]
    if not window:
        return near[-1]
    grade, pause, token = x["grade"], x["pause"], x["token"]
    if stops := [e for e in window if stop[e] >= STOPS["strong"]] or [e for e in window if stop[e] == STOPS["weak"]]:
        return min(stops, key=lambda e: (policy[e], grade[e], x["shortness"][e], token[e]))
    return max(window, key=lambda e: (pause[e], -grade[e], -token[e]))


_PLACED = ("token", "from_token", "from_opens", "closes", "kind", "pause_ms", "grade", "policy")


def between_anchors(rows: DataFrame, source: str) -> DataFrame:
    """Rows of :func:`_rows_of_all`, with ends, and the number of the window from anchor to anchor that each lies in as its ``region``.

    One pass over a source's sorted rows, of which no more are held than lie
    within an anchor's reach. A source keeps no rows behind a window without
    an anchor, which is one row with the ``problem``. ``grade`` and
    ``policy`` are by GRADES and POLICIES.
    """
    by = Window.partitionBy(source).orderBy("row")
    none = float("-inf")
    coded = rows.withColumns(
        {
            "stop": _code("kind", STOPS, 0), "grade": _code("quality", GRADES, 2), "policy": F.when(F.col("kind").isNull(), POLICIES["no_cut"]).otherwise(_code("policy", POLICIES, 1)),
            "after": F.coalesce("after", F.lit(float("inf"))), "pause": F.coalesce("pause_ms", F.lit(none)), "shortness": F.coalesce(-F.bround("pause_ms"), F.lit(none)),
            "bare": F.col("kind").isNull() & (F.col("row") == 0), "opens_source": F.row_number().over(by) == 1,
        }
    ).select(source, *_PLACED, "stop", "after", "pause", "shortness", "bare", "opens_source")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        region, dead = 0, False

        def placed(table: pa.Table, last: bool) -> tuple[pa.Table, pa.Table]:
            """What is settled, and what waits for the rows behind it."""
            nonlocal region, dead
            table = table.combine_chunks()
            x = {c: _listed(table[c]) for c in ("token", "from_opens", "closes", "grade", "policy", "stop", "after", "pause", "shortness")}
            n, at = table.num_rows, 0
            opening = set(np.flatnonzero(table["opens_source"].to_numpy()).tolist())
            regions, spans, problems = [], [], {}
            for a, z in itertools.pairwise(sorted({0, *opening, n})):
                if a in opening:
                    region, dead = 0, False
                at, ended = a, last or z < n
                while at < z and not dead:
                    to = anchor_of(at, z, ended, x)
                    if to is None:
                        break
                    dead = to < 0
                    if dead:
                        problems[len(spans)] = _BARE if table["bare"][at].as_py() else "unable to choose planning anchor"
                    spans.append((at, at + 1 if dead else to + 1))
                    regions.append(region)
                    region, at = region + 1, spans[-1][1]
            begin, end = np.array(spans, np.int64).reshape(-1, 2).T
            size = end - begin
            take = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
            done = table.select([source, *_PLACED]).take(pa.array(take))
            done = done.append_column("region", pa.array(np.repeat(np.array(regions, np.int64), size)))
            said = pa.array([problems.get(k) for k in range(len(spans))], pa.string()) if problems else pa.nulls(len(spans), pa.string())
            return done.append_column("problem", said.take(pa.array(np.repeat(np.arange(len(spans)), size)))), table.slice(n if dead else at)

        for batch in batches:
            done, rest = placed(pa.Table.from_batches([*held, batch]), False)
            held = rest.to_batches()
            yield from done.to_batches()
        if held:
            yield from placed(pa.Table.from_batches(held), True)[0].to_batches()

    fields = ", ".join(f"{c} {coded.schema[c].dataType.simpleString()}" for c in _PLACED)
    return coded.mapInArrow(run, f"{source} {rows.schema[source].dataType.simpleString()}, {fields}, region long, problem string")


def _plan_legacy(rows: DataFrame, source: str, bounds: tuple[float, float], audio: DataFrame | None) -> DataFrame:
    """Windows from anchor to anchor, then each window by itself; what lies behind the first one of a source that has no plan is left out."""
    placed = between_anchors(rows, source)
    found = written(plan_regions(placed if audio is None else written(placed), source, legacy_path, *bounds, audio))
    failed = found.where("problem is not null").groupBy(F.col(source).alias("_s")).agg(F.min("region").alias("_at"))
    return found.join(failed, F.col(source).eqNullSafe(F.col("_s")), "left").where("_at is null or region <= _at").drop("_s", "_at")


def plan_segments(tokens: DataFrame, strategy: str, shortest: float, longest: float, source: str = "source_id", audio: DataFrame | None = None, stats: DataFrame | None = None) -> DataFrame:
    """Segments of every source: ``source, first_token, last_token`` (places in the source), lengths, phase, and the boundary that ends each.

    ``tokens``: a row for each token with idx, start_sec, end_sec; where a
    boundary follows, kind, pause_ms (and quality, policy, label). ``stats``:
    a row for each source with structs strong and weak of its pause
    quantiles; without it they are those of the boundaries' own pauses by
    ``category``, or where tokens have none stand on the tokens. With ``audio`` (the
    source and WAV ``content``, a row each) segments are judged by their
    lengths without silent ends; a source without audio by its whole lengths.
    What keeps a source from being planned is in ``problem``, on a row of its
    own.
    """
    if strategy not in STRATEGIES:
        return _problem(tokens.select(source).distinct(), source, f"unknown rough cut strategy: {strategy}")
    bounds = (shortest, longest)
    legacy = strategy == "legacy_dp"
    rows = _rows_of_all(tokens, source, ("quality", "policy") if legacy else ("label", "category"), legacy)
    if legacy:
        for c, d in (("quality", "bad"), ("policy", "normal")):
            if c not in rows.columns:
                rows = rows.withColumn(c, F.lit(d))
        return _plan_legacy(rows, source, bounds, audio).drop("region")
    if "label" not in rows.columns:
        rows = rows.withColumn("label", F.lit("ok"))
    if strategy == "priority_silence_v3":
        rows = beside(rows, source, both=F.when(_kind("strong", "weak"), F.col("pause_ms")))
    elif stats is None and "category" in rows.columns:
        counts = F.col("pause_ms") <= LONGEST_PAUSE_MS
        rows = beside(rows, source, **{c: F.when((F.col("category") == c) & counts, F.col("pause_ms")) for c in ("strong", "weak")})
    else:
        if stats is None:
            stats = tokens.groupBy(source).agg(F.any_value("strong").alias("strong"), F.any_value("weak").alias("weak"))
        rows = _with_stats(rows, stats, source)
    rules = RULES[strategy]()
    rows = _regions(rows, rules, strategy, source)
    if strategy == "priority_silence_v2":
        return _plan_v2(rows, rules, source, bounds, audio).drop("region")
    if rules.worth is not None:
        rows = rows.withColumns({"worth": rules.worth, "spoils": rules.spoils})
    solve = by_phases([name for name, _ in rules.phases], rules.needs_inner, rules.worth is not None)
    return plan_regions(_flagged(rows, rules.phases), source, solve, *bounds, audio).drop("region")
