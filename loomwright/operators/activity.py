"""Activity and silence on a time axis: thresholds, runs, regions, gaps, overlaps, nearest events, packing.

All of it works on rows (key, time, level) of any source: frames of a signal
or events of a log.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomwright.functions.pointers import followed, sorted_groups
from loomwright.functions.tables import spread, written


def adaptive_threshold(rows: DataFrame, key: str, level: str, quarter: float = 1.8, half: float = 0.45, top: float = 0.025, least: float = 1e-6) -> DataFrame:
    """``threshold`` for each key: the largest of scaled quartile, median and maximum, and a floor.

    Levels are compared with it exactly, so the quantiles are rounded as
    DuckDB rounds them; ranks are those of a sorted pass, not of a map of a
    key's values.
    """
    by = Window.partitionBy(key)
    v = F.col(level).cast("double")
    ranked = rows.select(key, v.alias("_v"), (F.row_number().over(by.orderBy(v.asc_nulls_last())) - 1).alias("_r"), F.count(v).over(by).alias("_n"))
    at = lambda place: F.max(F.when(F.col("_r") == place, F.col("_v")))
    place = {p: (F.col("_n") - 1) * p for p in (0.25, 0.5)}
    ends = [c for p, x in place.items() for c in (at(F.floor(x)).alias(f"_low{p}"), at(F.ceil(x)).alias(f"_high{p}"), F.max(x - F.floor(x)).alias(f"_part{p}"))]
    found = ranked.groupBy(key).agg(*ends, F.max("_v").alias("_top"))
    q1, q2 = (_between(F.col(f"`_low{p}`"), F.col(f"`_high{p}`"), F.col(f"`_part{p}`")) for p in place)
    return found.select(key, F.greatest(q1 * quarter, q2 * half, F.col("_top") * top, F.lit(least)).alias("threshold"))


def _between(low: Column, high: Column, part: Column) -> Column:
    """``low * (1 - part) + high * part`` for quarters, with ``low * (1 - part)`` not rounded before the sum (a fused multiply-add)."""
    three = part == 0.25  # the one product that would be rounded, as two that are not
    a, b, c = F.when(three, low * 0.5).otherwise(low * (1 - part)), F.when(three, low * 0.25).otherwise(0.0), high * part
    s = a + b
    t = s + c
    lost = (a - (s - (s - a))) + (b - (s - a)) + (s - (t - (t - s))) + (c - (t - s))
    return F.when(part == 0, low).otherwise(t + F.nanvl(lost, F.lit(0.0)))


def true_runs(rows: DataFrame, key: str, order: list[str], mask: Column) -> DataFrame:
    """Runs of consecutive rows where ``mask`` holds: ``run_start, run_end`` (positions, end exclusive) and ``run_length``."""
    by = Window.partitionBy(key).orderBy(*order)
    placed = rows.withColumn("_i", F.row_number().over(by) - 1).where(mask)
    islands = placed.withColumn("_g", F.col("_i") - F.row_number().over(Window.partitionBy(key).orderBy("_i")))
    return islands.groupBy(key, "_g").agg(F.min("_i").alias("run_start"), (F.max("_i") + 1).alias("run_end"), F.count("*").alias("run_length")).drop("_g")


def gap_regions(rows: DataFrame, key: str, time: str, largest_gap: float, order: list[str]) -> DataFrame:
    """Regions of rows no more than ``largest_gap`` apart: ``region, start, end, n`` for each key."""
    by = Window.partitionBy(key).orderBy(*order)
    rows = spread(rows, key)
    new = F.when(F.col(time) - F.lag(time).over(by) > largest_gap, 1).otherwise(0)
    numbered = rows.withColumn("_new", new).withColumn("region", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(key, "region").agg(F.min(time).alias("start"), F.max(time).alias("end"), F.count("*").alias("n"))


def merge_intervals(rows: DataFrame, key: str, start: str = "start", end: str = "end", largest_gap: float = 0) -> DataFrame:
    """Coalesced intervals of each key; those at most ``largest_gap`` apart become one."""
    by = Window.partitionBy(key).orderBy(start, end)
    rows = spread(rows, key)
    reach = F.max(end).over(by.rowsBetween(Window.unboundedPreceding, -1))
    flagged = rows.withColumn("_new", F.when(reach.isNull() | (F.col(start) - reach > largest_gap), 1).otherwise(0))
    grouped = flagged.withColumn("_g", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return grouped.groupBy(key, "_g").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_g")


def subtract_intervals(whole: DataFrame, holes: DataFrame, key: str, start: str = "start", end: str = "end") -> DataFrame:
    """What is left of each whole interval without the holes that lie in it (half-open); repeated rows stay, empty ones go.

    A sweep over the ends of holes and intervals counts, at each interval's
    start, the holes that have ended and, at its end, those that have begun:
    between the two lie the gaps it reaches, which it then meets by their
    numbers. Nothing is compared that is not part of the result. Merged
    holes and intervals are written, as the sweep reads them many times.
    """
    merged = written(merge_intervals(holes, key, start, end).select(F.col(key).alias("k"), F.col(start).alias("hs"), F.col(end).alias("he")))
    by = Window.partitionBy("k").orderBy("hs")
    numbered = merged.withColumn("j", F.row_number().over(by) - 1).withColumn("from", F.lag("he").over(by)).withColumn("next", F.lead("hs").over(by))
    gaps = numbered.select("k", "j", "from", F.col("hs").alias("to")).unionByName(numbered.where("next is null").select("k", (F.col("j") + 1).alias("j"), F.col("he").alias("from"), F.lit(None).cast(holes.schema[start].dataType).alias("to")))
    wholes = written(whole.groupBy(F.col(key).alias("k"), F.col(start).alias("s"), F.col(end).alias("e")).agg(F.count("*").alias("n")))
    none = F.lit(None)
    events = [
        merged.select("k", F.col("he").alias("at"), F.lit(0).alias("order"), none.alias("s"), none.alias("e"), none.alias("n")),
        wholes.select("k", F.col("s").alias("at"), F.lit(1).alias("order"), "s", "e", "n"),
        wholes.select("k", F.col("e").alias("at"), F.lit(1).alias("order"), "s", "e", "n"),
        merged.select("k", F.col("hs").alias("at"), F.lit(2).alias("order"), none.alias("s"), none.alias("e"), none.alias("n")),
    ]
    swept = Window.partitionBy("k").orderBy("at", "order").rowsBetween(Window.unboundedPreceding, 0)
    count = lambda order: F.sum((F.col("order") == order).cast("long")).over(swept)
    seen = spread(reduce(DataFrame.unionByName, events), "k").withColumn("ended", count(0)).withColumn("begun", count(2)).where("order = 1")
    reach = seen.groupBy("k", "s", "e").agg(F.max("n").alias("n"), F.min("ended").alias("i"), F.max("begun").alias("z")).where("s < e")
    parts = reach.select("k", "s", "e", F.explode(F.sequence("i", F.greatest("i", "z"))).alias("j"), "n").withColumnsRenamed({"k": "wk", "j": "wj"})
    parts = parts.join(gaps, F.col("wk").eqNullSafe(F.col("k")) & (F.col("wj") == F.col("j")), "left")
    left = parts.select(F.col("wk").alias(key), F.greatest("s", "from").alias(start), F.least("e", "to").alias(end), "n").where(F.col(start) < F.col(end))
    return left.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).drop("n", "_copy")


def overlaps(left: DataFrame, right: DataFrame, key: str, width: float, start: str = "start", end: str = "end") -> DataFrame:
    """Pairs of intervals of one key that overlap, with ``overlap_start, overlap_end``.

    Both sides are dealt into bins of ``width``; a pair is made in the bin
    where its overlap starts, so long intervals give no pair twice and the
    join stays an equi-join. Columns besides the key keep the prefixes
    ``l_`` and ``r_``.
    """

    def dealt(df: DataFrame, side: str) -> DataFrame:
        named = df.select(key, *(F.col(c).alias(f"{side}_{c}") for c in df.columns if c != key))
        first, last = F.floor(F.col(f"{side}_{start}") / width), F.floor(F.col(f"{side}_{end}") / width)
        return named.withColumn("_bin", F.explode(F.sequence(first.cast("long"), last.cast("long"))))

    a = F.greatest(f"l_{start}", f"r_{start}")
    b = F.least(f"l_{end}", f"r_{end}")
    both = dealt(left, "l").join(dealt(right, "r"), [key, "_bin"]).where((F.col(f"l_{start}") < F.col(f"r_{end}")) & (F.col(f"r_{start}") < F.col(f"l_{end}")))
    return both.withColumn("overlap_start", a).withColumn("overlap_end", b).where(F.col("_bin") == F.floor(F.col("overlap_start") / width)).drop("_bin")


def nearest(rows: DataFrame, key: str, time: str, order: list[str], anchor: Column, target: Column, value: str) -> DataFrame:
    """For each anchor row the target row of its key nearest in time (the earlier of equals): ``near_value, near_distance``.

    One window each way over the union of both, so no range join is needed.
    """
    seen = F.when(target, F.struct(F.col(time).alias("t"), F.col(value).alias("v")))
    before = F.last(seen, ignorenulls=True).over(Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    after = F.last(seen, ignorenulls=True).over(Window.partitionBy(key).orderBy(*(F.col(o).desc() for o in order)).rowsBetween(Window.unboundedPreceding, 0))
    found = rows.withColumn("_b", before).withColumn("_a", after).where(anchor)
    db, da = F.col(time) - F.col("_b.t"), F.col("_a.t") - F.col(time)
    first = F.col("_b").isNotNull() & (F.col("_a").isNull() | (db <= da))
    return found.withColumn("near_value", F.when(first, F.col("_b.v")).otherwise(F.col("_a.v"))).withColumn("near_distance", F.when(first, db).otherwise(da)).drop("_a", "_b")


def quietest_cut(rows: DataFrame, keys: list[str], time: str, level: str, middle: Column, limit: Column, latest: Column) -> DataFrame:
    """``cut_time, cut_method`` of each window: its quietest row under the limit (nearest to the middle, then latest), else ``latest``."""
    quiet = F.when(F.col(level) <= limit, F.struct(F.col(level), F.abs(F.col(time) - middle), -F.col(time)))
    best = rows.groupBy(*keys).agg(F.min_by(time, quiet).alias("_t"), F.min(quiet).isNotNull().alias("_quiet"), F.max(latest).alias("_latest"))
    return best.select(*keys, F.when(F.col("_quiet"), F.col("_t")).otherwise(F.col("_latest")).alias("cut_time"), F.when(F.col("_quiet"), "silence").otherwise("max").alias("cut_method"))


def longest_gap_cut(regions: DataFrame, key: str, low: float, high: float, start: str = "start", end: str = "end") -> DataFrame:
    """Middle of the longest gap between regions within [first start + low, first start + high]; the first of equals."""
    by = Window.partitionBy(key).orderBy(start)
    first = F.min(start).over(Window.partitionBy(key))
    gaps = regions.select(key, F.greatest(F.col(end), first + low).alias("a"), F.least(F.lead(start).over(by), first + high).alias("b")).where("b > a")
    best = gaps.groupBy(key).agg(F.max_by(F.struct("a", "b"), F.struct(F.col("b") - F.col("a"), -F.col("a"))).alias("g"))
    return best.select(key, ((F.col("g.a") + F.col("g.b")) / 2).alias("cut_time"), (F.col("g.b") - F.col("g.a")).alias("gap"))


def split_evenly(rows: DataFrame, key: str, length: str, target: float, window: float) -> DataFrame:
    """Cuts of long rows into even parts: ``part_index, part_count, part_start, part_end`` and the window of each cut.

    A row of at most ``target`` stays whole; others get
    max(2, floor(length / target) + 1) parts.
    """
    n = F.when(F.col(length) <= target, 1).otherwise(F.greatest(F.lit(2), F.floor(F.col(length) / target) + 1)).cast("long")
    parts = rows.select(key, length, n.alias("part_count")).withColumn("part_index", F.explode(F.sequence(F.lit(0).cast("long"), F.col("part_count") - 1)))
    edge = lambda k: F.floor(k * F.col(length) / F.col("part_count")).cast("long")
    k = F.col("part_index")
    return parts.select(
        key, "part_index", "part_count", edge(k).alias("part_start"), edge(k + 1).alias("part_end"),
        F.greatest(F.lit(0.0), edge(k + 1) - window / 2).alias("cut_from"), F.least(F.col(length).cast("double"), edge(k + 1) + window / 2).alias("cut_to"),
    )


def split_fixed(rows: DataFrame, start: str, end: str, longest: int) -> DataFrame:
    """Each interval cut every ``longest``; other columns are kept."""
    at = F.explode(F.sequence(F.col(start).cast("long"), F.greatest(F.col(start), F.col(end) - 1).cast("long"), F.lit(longest).cast("long")))
    return rows.where(F.col(end) > F.col(start)).withColumn("_at", at).withColumn(end, F.least(F.col(end), F.col("_at") + longest)).withColumn(start, F.col("_at")).drop("_at")


def pack_regions(regions: DataFrame, key: str, budget: float, start: str = "start", end: str = "end") -> DataFrame:
    """Neighbouring regions packed into chunks of at most ``budget`` from the first start to the last end: ``chunk, start, end, n``.

    Without levels there is no place to cut at, so a region longer than the
    budget is a chunk of its own; ``pack_levels`` cuts it.
    """
    alone = F.col(end) - F.col(start) > budget
    order = F.row_number().over(Window.partitionBy(key).orderBy(start, end))
    items = regions.select(F.col(key).alias("k"), order.alias("r"), F.lit(0).alias("p"), F.col(start).alias("a"), F.col(end).alias("z"), alone.alias("alone"), F.lit(1).alias("n"))
    return _packed(items, budget).select(F.col("k").alias(key), "chunk", F.col("a").alias(start), F.col("z").alias(end), "n")


def _packed(items: DataFrame, budget: float) -> DataFrame:
    """Chunks of items (k, r, p, a, z, alone, n) in the order of r and p: as many neighbours as the budget takes, those ``alone`` by themselves.

    An item that may be joined is not longer than the budget, so the first
    one behind it that reaches too far is the first at which the running
    maximum of ends does: one ordered pass finds it for all items at once.
    The chain of chunks is then followed from the first item on.
    """
    by = Window.partitionBy("k").orderBy("r", "p")
    upto = by.rowsBetween(Window.unboundedPreceding, 0)
    # items between two that stand alone are a run
    numbered = items.withColumn("q", (F.row_number().over(by) - 1).cast("long")).withColumn("run", F.sum(F.col("alone").cast("long")).over(upto))
    numbered = numbered.withColumn("behind", F.lead("q").over(by))
    numbered = written(numbered)
    run = Window.partitionBy("k", "run")
    open_ = numbered.where("not alone").withColumn("top", F.max("z").over(run.orderBy("q").rowsBetween(Window.unboundedPreceding, 0)))
    reached = open_.select("k", "run", "q", F.col("top").alias("v"), F.lit(1).alias("order"))
    asked = open_.select("k", "run", "q", (F.col("a") + budget).alias("v"), F.lit(0).alias("order"))
    far = F.min(F.when(F.col("order") == 1, F.col("q"))).over(run.orderBy(F.col("v").desc(), "order").rowsBetween(Window.unboundedPreceding, 0))
    both = reached.select("k", "run", "q", F.col("v").cast("double").alias("v"), "order").unionByName(asked.select("k", "run", "q", F.col("v").cast("double").alias("v"), "order"))
    stops = both.withColumn("far", far).where("order = 0").select(F.col("k").alias("sk"), F.col("q").alias("sq"), "far")
    ends = numbered.groupBy(F.col("k").alias("ek"), F.col("run").alias("er")).agg(F.max_by("behind", "q").alias("over"))
    ahead = numbered.join(stops, F.col("k").eqNullSafe(F.col("sk")) & (F.col("q") == F.col("sq")), "left").join(ends, F.col("k").eqNullSafe(F.col("ek")) & (F.col("run") == F.col("er")))
    ahead = written(ahead.withColumn("next", F.when(F.col("alone"), F.col("behind")).otherwise(F.coalesce("far", "over"))).drop("sk", "sq", "ek", "er"))
    firsts = followed(ahead, "k", "q", "next").select(F.col("k").alias("fk"), F.col("q").alias("fq"))
    marked = ahead.join(firsts, F.col("k").eqNullSafe(F.col("fk")) & (F.col("q") == F.col("fq")), "left")
    chunk = F.sum(F.col("fq").isNotNull().cast("long")).over(Window.partitionBy("k").orderBy("q").rowsBetween(Window.unboundedPreceding, 0)) - 1
    return marked.withColumn("chunk", chunk).groupBy("k", "chunk").agg(F.min_by("a", "q").alias("a"), F.max("z").alias("z"), F.sum("n").cast("long").alias("n"))


def pack_levels(regions: DataFrame, rows: DataFrame, key: str, budget: float, least: float, time: str, level: str, start: str = "start", end: str = "end") -> DataFrame:
    """``pack_regions`` with no chunk over the budget: longer regions are cut, again and again, where the source is quietest.

    A cut is the row of ``rows`` (key, time, level) with the least level from
    ``least`` after the last cut until before the budget (the first of
    equals); where all are alike or none is, the budget itself. Parts cut
    off are chunks of their own, the last part is packed with what follows.
    A source without regions is cut all over from its first row to its last.
    ``n`` counts regions and their parts; a source without regions has 0.

    Only long regions see levels, each in one task with the rows that lie in
    it; packing works on rows of all sources at once.
    """
    if budget <= 0:
        raise ValueError("the budget must be positive")
    times = regions.schema[start].dataType.simpleString()
    kind = regions.schema[key].dataType.simpleString()
    order = F.row_number().over(Window.partitionBy(key).orderBy(start, end))
    own = written(regions.select(F.col(key).alias("k"), order.cast("long").alias("r"), F.col(start).alias("a"), F.col(end).alias("z"), F.lit(False).alias("bare")))
    heard = rows.where(F.col(time).isNotNull() & F.col(level).isNotNull()).select(F.col(key).alias("lk"), F.col(time).alias("t"), F.col(level).cast("double").alias("v"))
    without = heard.groupBy("lk").agg(F.min("t").alias("a"), F.max("t").alias("z"))
    known = own.select(F.col("k").alias("ok")).distinct()
    without = without.join(known, F.col("lk").eqNullSafe(F.col("ok")), "left_anti").select(F.col("lk").alias("k"), F.lit(0).cast("long").alias("r"), F.col("a").cast(times).alias("a"), F.col("z").cast(times).alias("z"), F.lit(True).alias("bare"))
    long_ = own.where(F.col("z") - F.col("a") > budget).unionByName(without)
    bins = F.sequence(F.floor(F.col("a") / budget).cast("long"), F.floor(F.col("z") / budget).cast("long"))
    met = long_.withColumn("bin", F.explode(bins)).join(heard.withColumn("lb", F.floor(F.col("t") / budget).cast("long")), F.col("k").eqNullSafe(F.col("lk")) & (F.col("bin") == F.col("lb")))
    met = met.where((F.col("t") >= F.col("a")) & (F.col("t") <= F.col("z"))).select("k", "r", "a", "z", "bare", "t", "v")
    none = long_.select("*", F.lit(None).cast(heard.schema["t"].dataType).alias("t"), F.lit(None).cast("double").alias("v"))  # a region has a row, whatever lies in it
    by = Window.partitionBy("k", "r").orderBy(F.col("t").asc_nulls_first())
    dealt = met.unionByName(none).withColumn("first", F.row_number().over(by) == 1)

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, "first"):
            table = table.combine_chunks()
            begins = np.flatnonzero(table["first"].to_numpy()).tolist()
            out, place = [], []
            for x, y in zip(begins, [*begins[1:], table.num_rows], strict=True):
                a, z, bare = (table[c][x].as_py() for c in ("a", "z", "bare"))
                at, loud = (table[c].slice(x + 1, y - x - 1).to_numpy() for c in ("t", "v"))
                parts = _quiet_parts(at, loud, a, z, budget, least, bare)
                out += [(p, *part) for p, part in enumerate(parts)]
                place += [x] * len(parts)
            index = pa.array(place, pa.int64())
            edge = table.schema.field("a").type
            columns = [table["k"].take(index), table["r"].take(index), pa.array([o[0] for o in out], pa.int32()), *(pa.array([o[c] for o in out]).cast(edge, safe=False) for c in (1, 2))]
            yield from pa.table([*columns, pa.array([o[3] for o in out], pa.bool_()), pa.array([o[4] for o in out], pa.int32())], ["k", "r", "p", "a", "z", "alone", "n"]).to_batches()

    parts = dealt.mapInArrow(cut_up, f"k {kind}, r long, p int, a {times}, z {times}, alone boolean, n int")
    short = own.where(F.col("z") - F.col("a") <= budget).select("k", "r", F.lit(0).alias("p"), "a", "z", F.lit(False).alias("alone"), F.lit(1).alias("n"))
    return _packed(written(parts.unionByName(short)), budget).select(F.col("k").alias(key), "chunk", F.col("a").alias(start), F.col("z").alias(end), "n")


def _quiet_parts(at: np.ndarray, loud: np.ndarray, a, z, budget: float, least: float, bare: bool) -> list[tuple]:
    """(start, end, alone, n) of the parts of a long region, or of a source without regions (``bare``)."""

    def cut(a, hard):
        i, j = at.searchsorted(a + least, "left"), at.searchsorted(hard, "left")
        i = max(i, at.searchsorted(a, "right"))
        here = loud[i:j]
        if not len(here) or (len(here) > 1 and here.max() - here.min() <= 1e-6):
            return hard
        return at[i + here.argmin()].item()

    out: list[tuple] = []
    if bare:
        while a < z:
            b = cut(a, min(a + budget, z))
            out.append((a, b, True, 0))
            a = b
        return out or [(a, z, True, 0)]
    while z - a > budget:
        b = cut(a, a + budget)
        out.append((a, b, True, 1))
        a = b
    return [*out, (a, z, False, 1)]
