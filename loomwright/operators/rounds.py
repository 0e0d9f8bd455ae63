"""Askers in rounds: labels, cuts and revisions for many units at once, with repair rounds for what is refused.

An asker is a model (``models.apply_model``) over batches of rows. A round asks
it for all units that are open; answers are judged by column expressions; what
is refused goes into the next round with the reason, and what no round settles
gets its fallback. The units of a round are a written table, so a lost
executor never asks twice for what is settled.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomwright.functions import text as T
from loomwright.functions.tables import joined_by, written
from loomwright.operators.models import Model, apply_model
from loomwright.operators.planners import Bounds, Region, best_chain, plan_regions
from loomwright.operators.planners import _more_segments as more_segments

LABELS = ("good", "ok", "bad")


def asked_in_rounds(
    units: DataFrame, inputs: list[str], kind: str, name: str, factory: Callable[[], Model], refused: Column, doubtful: Column | None = None, attempts: int = 2
) -> DataFrame:
    """``units`` with ``answer``, ``how`` (accepted, unconfirmed, unanswered), ``attempt`` and ``said``, the last reason.

    The asker sees ``inputs`` and ``said``, what was wrong with its last
    answer (empty at first). ``refused`` and ``doubtful`` are reasons (null:
    none) over the units' columns and ``answer``. A doubtful answer counts
    once it is given again; the last doubtful one is kept as ``unconfirmed``.
    A batch that fails is refused with its problem.
    """
    own = units.columns
    none = F.lit(None).cast(kind)
    open_ = written(units.withColumn("said", F.lit("")).withColumn("_last", none))
    settled: list[DataFrame] = []
    for attempt in range(1, attempts + 1):
        answered = apply_model(open_, [*inputs, "said"], "answer", kind, f"{name}", factory)
        bad = F.coalesce("answer_problem", F.when(F.col("answer").isNull(), "no answer"), refused)
        doubt = F.when(F.col("answer").eqNullSafe(F.col("_last")), F.lit(None)).otherwise(doubtful) if doubtful is not None else F.lit(None).cast("string")
        judged = written(answered.withColumn("_bad", bad).withColumn("_doubt", F.when(F.col("_bad").isNull(), doubt)))
        sound = F.col("_bad").isNull() & F.col("_doubt").isNull()
        settled.append(judged.where(sound).select(*own, "answer", F.lit("accepted").alias("how"), F.lit(attempt).alias("attempt"), "said"))
        open_ = judged.where(~sound).select(*own, F.coalesce("_bad", "_doubt").alias("said"), F.when(F.col("_bad").isNull(), F.col("answer")).otherwise(F.col("_last")).alias("_last"))
        if open_.isEmpty():
            return reduce(DataFrame.unionByName, settled)
    how = F.when(F.col("_last").isNull(), "unanswered").otherwise("unconfirmed")
    rest = open_.select(*own, F.col("_last").alias("answer"), how.alias("how"), F.lit(attempts).alias("attempt"), "said")
    return reduce(DataFrame.unionByName, [*settled, rest])


def _same_elements(a: Column, b: Column) -> Column:
    return (F.size(a) == F.size(b)) & (F.array_sort(a) == F.array_sort(b))


def labelled_pauses(marks: DataFrame, name: str, factory: Callable[[], Model], size: int = 5, attempts: int = 2, source: str = "source_id", sentence: str = "sentence", ident: str = "token") -> DataFrame:
    """``marks`` with a ``label`` good, ok or bad from an asker that labels all marks of ``size`` sentences at once.

    The asker gets the ids of a group and gives ``(id, label)`` pairs, one
    for each; a group without a sound answer is ok throughout. Sentences
    without marks take part in no group.
    """
    targets = marks.select(source, sentence).distinct()
    group = F.floor((F.dense_rank().over(Window.partitionBy(source).orderBy(sentence)) - 1) / size).cast("long")
    numbered = joined_by(marks, targets.withColumn("group_id", group), [source, sentence])
    units = numbered.groupBy(source, "group_id").agg(F.array_sort(F.collect_list(F.col(ident).cast("long"))).alias("wanted"))
    given = F.transform("answer", lambda a: a["id"])
    refused = F.when(~_same_elements(given, F.col("wanted")), "labels for all and only the marks shown").when(
        F.exists("answer", lambda a: a["label"].isNull() | ~a["label"].isin(*LABELS)), "labels are good, ok or bad"
    )
    found = asked_in_rounds(units, ["wanted"], "array<struct<id: long, label: string>>", name, factory, refused, attempts=attempts)
    labels = found.where("how = 'accepted'").select(source, F.inline("answer"))
    labels = labels.select(F.col(source).alias("_s"), F.col("id").alias("_id"), "label")
    both = marks.join(labels, F.col(source).eqNullSafe(F.col("_s")) & (F.col(ident) == F.col("_id")), "left")
    return both.withColumn("label", F.coalesce("label", F.lit("ok"))).drop("_s", "_id")


# -- cuts --------------------------------------------------------------------

_MARK = "struct<row: long, from_opens: double, closes: double, token: long, from_token: long, kind: string, pause_ms: double>"


def _units(rows: DataFrame, source: str, group: str) -> DataFrame:
    """A row for each group of boundary rows: its marks in order, and their numbers as the ``markers`` to choose from."""
    mark = F.struct(*(F.col(f.split(":")[0]).cast(f.split(": ")[1]).alias(f.split(":")[0]) for f in _MARK[7:-1].split(", ")))
    units = rows.groupBy(source, group).agg(F.array_sort(F.collect_list(mark)).alias("marks"))
    return units.withColumn("markers", F.transform("marks", lambda m: m["row"]))


def refused_cuts(to_end: bool) -> Column:
    """Why a list of markers is no list of cuts; null where it is."""
    cuts = F.col("answer")
    unknown = F.array_except(cuts, F.col("markers"))
    rising = F.array_sort(F.array_distinct(cuts)) == cuts
    why = F.when(F.size(cuts) == 0, "no cuts").when(~rising, "cuts must be strictly increasing").when(F.size(unknown) > 0, F.concat(F.lit("unknown markers: "), F.to_json(unknown)))
    return why.when(F.element_at(cuts, -1) != F.element_at("markers", -1), "the last cut must be the last marker") if to_end else why


def _segments(cuts: Column) -> Column:
    """Segments that end at the cuts: first and last mark of each."""
    at = F.transform(cuts, lambda c: F.array_position("markers", c).cast("int"))
    return F.transform(at, lambda z, i: F.struct(F.element_at("marks", F.when(i == 0, 1).otherwise(F.get(at, i - 1) + 1)).alias("a"), F.element_at("marks", z).alias("z")))


def out_of_bounds(shortest: float, longest: float, padding: float) -> Column:
    """The segments of an answer that are too short or too long once padded, as text; null where none is."""
    length = lambda s: s["z"]["closes"] - s["a"]["from_opens"] + 2 * padding
    off = F.filter(_segments(F.col("answer")), lambda s: ~length(s).between(shortest, longest))
    shown = F.transform(off, lambda s: F.format_string("%d-%d: %.2f s", s["a"]["from_token"], s["z"]["token"], length(s)))
    return F.when(F.size(off) > 0, F.concat(F.lit("out of bounds: "), F.array_join(shown, "; ")))


def _cut_rows(found: DataFrame, source: str, group: str, shortest: float, longest: float) -> DataFrame:
    each = found.where("answer is not null").select(source, group, "how", F.explode(_segments(F.col("answer"))).alias("s"))
    raw = F.round(F.col("s.z.closes") - F.col("s.a.from_opens"), 3)
    return each.select(source, group, F.col("s.a.from_token").alias("first_token"), F.col("s.z.token").alias("last_token"), raw.alias("raw_sec"), raw.between(shortest, longest).alias("valid"), "how")


def slices_by_asker(
    rows: DataFrame, group: str, name: str, factory: Callable[[], Model], shortest: float, longest: float, attempts: int = 3, padding: float = 0.2, source: str = "source_id"
) -> DataFrame:
    """``source, group, first_token, last_token, raw_sec, valid, how``: segments of each group of boundary rows at the markers that an asker submits.

    Refused lists go back with the reason, and so do lists with segments out
    of bounds once padded; the same list submitted again is confirmed. A
    group without a valid list is planned by the chain of longest admissible
    segments (``fallback``).
    """
    held = written(rows)
    units = _units(held, source, group)
    found = written(asked_in_rounds(units, ["markers"], "array<bigint>", name, factory, refused_cuts(True), out_of_bounds(shortest, longest, padding), attempts))
    cut = _cut_rows(found, source, group, shortest, longest)
    open_ = found.where("answer is null").select(F.col(source).alias("_s"), F.col(group).alias("_g"))
    rest = held.join(open_, F.col(source).eqNullSafe(F.col("_s")) & (F.col(group) == F.col("_g"))).drop("_s", "_g")
    rest = rest.withColumn("region", F.col(group).cast("long")).withColumns({"flags": F.lit(1), "problem": F.lit(None).cast("string")})
    planned = plan_regions(rest, source, _admissible, shortest, longest)
    late = planned.select(source, F.col("region").alias(group), "first_token", "last_token", "raw_sec", "valid", F.lit("fallback").alias("how"))
    return cut.unionByName(late)


def _admissible(r: Region, bounds: Bounds) -> list:
    links = best_chain(r, 0, list(range(r.n)), bounds, (0.0, 0, 0), more_segments, False)
    begin = links[-1][1] + 1 if links else 0
    return [*((x, "fallback") for x in links), *([((begin, r.n - 1), "leftover")] if begin < r.n else [])]


def next_windows(rows: DataFrame, cursors: DataFrame, source: str = "source_id", least_sec: float = 15.0, sentences: int = 3, extension: int = 2) -> DataFrame:
    """The boundary rows that each source's asker is shown next: from its ``cursor`` (a row number) until they are long enough or have their sentences, then up to ``extension`` sentences more; never beyond the final one."""
    at = cursors.select(F.col(source).alias("_s"), "cursor")
    ahead = rows.join(at, F.col(source).eqNullSafe(F.col("_s"))).where("row >= cursor").drop("_s")
    by = Window.partitionBy(source).orderBy("row")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    ends = F.col("kind").isin("strong", "final").cast("long")
    run = ahead.withColumns({"_n": F.sum(ends).over(by.rowsBetween(Window.unboundedPreceding, 0)), "_open": F.first("from_opens").over(by.rowsBetween(Window.unboundedPreceding, 0))})
    run = run.withColumn("_full", (F.col("closes") - F.col("_open") >= least_sec) | (F.col("_n") >= sentences) | (F.col("kind") == "final"))
    base = F.min(F.when(F.col("_full"), F.struct("row", "_n"))).over(before)  # the row with which the window was long enough
    shown = run.withColumns({"_base": base, "_done": F.max(F.col("kind") == "final").over(before), "_had": F.lag("_n").over(by)})
    inside = F.col("_base").isNull() | (F.col("_had") < F.col("_base._n") + extension)
    keep = shown.where(inside & ~F.coalesce("_done", F.lit(False)))
    return keep.drop("_n", "_open", "_full", "_base", "_done", "_had")


def windows_by_asker(
    rows: DataFrame, name: str, factory: Callable[[], Model], shortest: float, longest: float, attempts: int = 3, padding: float = 0.2, source: str = "source_id", most_windows: int | None = None, least_sec: float = 15.0, sentences: int = 3, extension: int = 2,
) -> DataFrame:
    """``source, window, first_token, last_token, raw_sec, valid, how``: segments from window to window of each source.

    In each round every unfinished source shows its next window; the asker
    cuts it at some of its markers, and the next window begins behind the
    last cut. Refused and doubtful answers have their own repair rounds; an
    asker that never gives a valid list has its window cut at the furthest
    marker within bounds, or at the last one. Rows behind the cursor are no
    longer read. ``most_windows`` stops early (for trials).
    """
    left = written(rows)
    cursors = written(left.groupBy(source).agg(F.min("row").alias("cursor")))
    out: list[DataFrame] = []
    number = 0
    while not cursors.isEmpty() and (most_windows is None or number < most_windows):
        shown = next_windows(left, cursors, source, least_sec, sentences, extension).withColumn("window", F.lit(number))
        found = asked_in_rounds(_units(shown, source, "window"), ["markers"], "array<bigint>", f"{name}", factory, refused_cuts(False), out_of_bounds(shortest, longest, padding), attempts)
        first = F.element_at("marks", 1)["from_opens"]
        fits = F.filter("marks", lambda m: (m["closes"] - first).between(shortest, longest))
        furthest = F.coalesce(F.try_element_at(fits, F.lit(-1))["row"], F.element_at("markers", -1))
        found = written(found.withColumn("how", F.when(F.col("answer").isNull(), "fallback").otherwise(F.col("how"))).withColumn("answer", F.coalesce("answer", F.array(furthest))))
        out.append(_cut_rows(found, source, "window", shortest, longest))
        ahead = found.select(F.col(source).alias("_s"), (F.element_at("answer", -1) + 1).alias("_c"))
        left = written(left.join(ahead, F.col(source).eqNullSafe(F.col("_s"))).where("row >= _c").drop("_s", "_c"))
        cursors = written(left.groupBy(source).agg(F.min("row").alias("cursor")))
        number += 1
    if not out:
        kind = rows.schema[source].dataType.simpleString()
        return rows.sparkSession.createDataFrame([], f"{source} {kind}, window int, first_token long, last_token long, raw_sec double, valid boolean, how string")
    return reduce(DataFrame.unionByName, out)


# -- punctuation -------------------------------------------------------------


def warning_windows(spans: DataFrame, warnings: DataFrame, source: str = "source_id") -> DataFrame:
    """``source, first_sentence, last_sentence``: the sentences that are revised together.

    ``spans``: source, sentence, first_token, last_token; ``warnings``: source,
    left_idx, right_idx. A window grows from a sentence with a warning over
    each edge at which a warning stands, sentence by sentence; touching
    windows are one. How far it grows is the last sentence before it (or
    the first behind) whose edge is clean.
    """
    edges = warnings.select(F.col(source).alias("_s"), F.explode(F.array(F.struct(F.col("left_idx").alias("t"), F.lit(True).alias("left")), F.struct(F.col("right_idx").alias("t"), F.lit(False).alias("left")))).alias("e"))
    edges = edges.select("_s", F.col("e.t").alias("_t"), F.col("e.left").alias("_left"))
    width = 64
    dealt = spans.withColumn("_b", F.explode(F.sequence(F.floor(F.col("first_token") / width).cast("long"), F.floor(F.col("last_token") / width).cast("long"))))
    met = dealt.join(edges.withColumn("_eb", F.floor(F.col("_t") / width).cast("long")), F.col(source).eqNullSafe(F.col("_s")) & (F.col("_b") == F.col("_eb")))
    met = met.where("_t between first_token and last_token").groupBy(source, "sentence")
    marks = met.agg(F.max((~F.col("_left")) & (F.col("_t") == F.col("first_token"))).alias("opens"), F.max(F.col("_left") & (F.col("_t") == F.col("last_token"))).alias("closes"), F.lit(True).alias("warned"))
    rows = joined_by(spans.select(source, "sentence"), marks, [source, "sentence"])
    by = Window.partitionBy(source)
    up, down = by.orderBy("sentence"), by.orderBy(F.col("sentence").desc())
    upto = lambda w: w.rowsBetween(Window.unboundedPreceding, 0)
    clean = lambda c: F.when(~F.coalesce(c, F.lit(False)), F.col("sentence"))
    first = F.coalesce(F.last(clean("opens"), ignorenulls=True).over(upto(up)), F.min("sentence").over(by))
    last = F.coalesce(F.last(clean("closes"), ignorenulls=True).over(upto(down)), F.max("sentence").over(by))
    grown = rows.withColumn("first", first).withColumn("last", last).where("warned")
    reach = F.max("last").over(by.orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1))
    grown = grown.withColumn("_new", F.when(reach.isNull() | (F.col("first") > reach + 1), 1).otherwise(0))
    grown = grown.withColumn("_g", F.sum("_new").over(upto(by.orderBy("first", "last"))))
    return grown.groupBy(source, "_g").agg(F.min("first").alias("first_sentence"), F.max("last").alias("last_sentence")).drop("_g")


def revised_windows(windows: DataFrame, name: str, factory: Callable[[], Model], attempts: int = 3, text: str = "text") -> DataFrame:
    """``windows`` with ``revised``, ``how``, ``attempt``: texts whose marks an asker has set anew; one that changes a spoken character is refused, and in the end the text stays."""
    place = T.first_mismatch(F.col("_spoken"), T.spoken(F.col("answer")))
    refused = F.when(T.spoken(F.col("answer")) != F.col("_spoken"), F.concat(F.lit("the spoken text differs from character "), place.cast("string")))
    found = asked_in_rounds(windows.withColumn("_spoken", T.spoken(F.col(text))), [text], "string", name, factory, refused, attempts=attempts)
    return found.withColumn("revised", F.coalesce("answer", F.col(text))).drop("answer", "_spoken", "said")
