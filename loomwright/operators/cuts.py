"""Greedy cuts of long rows of frames: each chunk ends at the quietest frame between its bounds, whatever the length of a recording.

The cut that would follow is found for every frame by itself, as if a chunk
began there; then the chain of cuts is followed from the first frame on. So
no step needs a recording in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomwright.functions.pointers import followed
from loomwright.functions.tables import sorted_sides, written
from loomwright.operators.activity import adaptive_threshold


def _same(a: str, b: str):
    return F.col(a).eqNullSafe(F.col(b))


def next_cuts(rows: DataFrame, key: str, idx: str, level: str, quiet: str, low: int, high: int) -> DataFrame:
    """``key, idx, cut``: the quietest quiet frame from ``low`` to ``high`` frames on, null where none is quiet.

    Of equally quiet ones the nearest to the middle counts, then the later.
    The least level of a window of fixed length is that of the end of one
    block of frames and of the beginning of the next; the frame that has it
    is found among the frames of that level, by their order.
    """
    width = high - low + 1
    frames = rows.select(F.col(key).alias("k"), F.col(idx).cast("long").alias("i"), F.when(F.col(quiet), F.col(level).cast("double")).alias("v"))
    frames = written(frames.withColumn("block", F.floor(F.col("i") / width).cast("long")))
    by = Window.partitionBy("k", "block")
    ends = frames.select(
        "k", "i", F.min("v").over(by.orderBy(F.col("i").desc()).rowsBetween(Window.unboundedPreceding, 0)).alias("rest"), F.min("v").over(by.orderBy("i").rowsBetween(Window.unboundedPreceding, 0)).alias("head")
    )
    # a window's first or last frame may be missing at the end of a recording: blocks are asked for their part instead
    whole = frames.groupBy("k", "block").agg(F.max("i").alias("last"), F.min("v").alias("least"))
    a, z = F.col("i") + low, F.col("i") + high
    asked = frames.select(F.col("k").alias("qk"), F.col("i").alias("qi"), a.alias("a"), z.alias("z"), F.floor(a / width).cast("long").alias("ba"), F.floor(z / width).cast("long").alias("bz"))
    first = ends.select(F.col("k").alias("k1"), F.col("i").alias("i1"), "rest")
    last = ends.select(F.col("k").alias("k2"), F.col("i").alias("i2"), "head")
    over = whole.select(F.col("k").alias("k3"), F.col("block").alias("b3"), F.col("last").alias("last3"), F.col("least").alias("least3"))
    found = asked.join(sorted_sides(first), _same("qk", "k1") & (F.col("a") == F.col("i1")), "left").join(sorted_sides(last), _same("qk", "k2") & (F.col("z") == F.col("i2")), "left")
    found = found.join(sorted_sides(over), _same("qk", "k3") & (F.col("bz") == F.col("b3")), "left")
    tail = F.coalesce("head", F.when(F.col("last3") < F.col("z"), F.col("least3")))
    # a window that is one block whole has its end alone
    least = F.when(F.col("ba") == F.col("bz"), F.col("rest")).otherwise(F.least("rest", tail))
    wanted = found.select(F.col("qk").alias("k"), F.col("qi").alias("of"), least.alias("v"), (2 * F.col("qi") + low + high).alias("at"), F.lit(None).cast("long").alias("i")).where("v is not null")
    there = frames.where("v is not null").select("k", F.lit(None).cast("long").alias("of"), "v", (2 * F.col("i")).alias("at"), "i")
    level_of = Window.partitionBy("k", "v")
    before = F.last("i", ignorenulls=True).over(level_of.orderBy("at", F.col("i").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0))
    after = F.last("i", ignorenulls=True).over(level_of.orderBy(F.col("at").desc(), F.col("i").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0))
    near = wanted.unionByName(there).withColumn("b", before).withColumn("n", after).where("of is not null")
    inside = lambda c: F.when((F.col(c) >= F.col("of") + low) & (F.col(c) <= F.col("of") + high), F.col(c))
    near = near.withColumn("b", inside("b")).withColumn("n", inside("n"))
    later = F.col("n").isNotNull() & (F.col("b").isNull() | (2 * F.col("n") - F.col("at") <= F.col("at") - 2 * F.col("b")))
    cuts = near.select(F.col("k").alias("ck"), F.col("of").alias("ci"), F.when(later, F.col("n")).otherwise(F.col("b")).alias("cut"))
    return frames.select("k", "i").join(sorted_sides(cuts), _same("k", "ck") & (F.col("i") == F.col("ci")), "left").select(F.col("k").alias(key), F.col("i").alias(idx), "cut")


def greedy_chunks(rows: DataFrame, key: str, idx: str, level: str, quiet: str, low: int, high: int, end: str) -> DataFrame:
    """``key, start, stop, method``: chunks of a key from its first frame on, of at most ``high`` frames, up to ``end`` (a column of ``rows``, alike for a key).

    Frames are numbered without gaps. A chunk ends at :func:`next_cuts`, or
    ``high`` frames on where nothing is quiet (``max``); the last one, of at
    most ``high`` frames, at the end.
    """
    cuts = next_cuts(rows, key, idx, level, quiet, low, high)
    ends = rows.groupBy(F.col(key).alias("ek")).agg(F.max(end).cast("long").alias("stop_at"))
    ahead = cuts.join(sorted_sides(ends), _same(key, "ek")).drop("ek")
    more = F.col("stop_at") - F.col(idx) > high
    ahead = written(ahead.withColumn("next", F.when(more, F.coalesce("cut", F.col(idx) + high))))
    reached = followed(ahead.select(key, idx, "next"), key, idx, "next").select(F.col(key).alias("rk"), F.col(idx).alias("ri"))
    used = ahead.join(sorted_sides(reached), _same(key, "rk") & (F.col(idx) == F.col("ri"))).drop("rk", "ri")
    method = F.when(~more, "end").when(F.col("cut").isNull(), "max").otherwise("silence")
    chunks = used.select(key, F.col(idx).alias("start"), F.coalesce("next", "stop_at").alias("stop"), method.alias("method"), "stop_at")
    # a cut behind the last frame has no frame to go on from: what is left is the last chunk
    last = rows.groupBy(F.col(key).alias("lk")).agg(F.max(idx).cast("long").alias("last_idx"))
    beyond = chunks.join(sorted_sides(last), _same(key, "lk")).where((F.col("stop") > F.col("last_idx")) & (F.col("stop") < F.col("stop_at")))
    tails = beyond.select(key, F.col("stop").alias("start"), F.col("stop_at").alias("stop"), F.lit("end").alias("method"))
    return chunks.drop("stop_at").unionByName(tails).where("stop > start")


def chunk_frames(frames: DataFrame, shortest: float = 5.0, longest: float = 15.0, frame_ms: float = 20.0, hop_ms: float = 5.0) -> DataFrame:
    """``stem, start_sec, end_sec, method``: chunks of recordings whose frame levels are rows (``sources.audio.frames``).

    Cuts lie at centres of frames. A frame is quiet at or under its
    recording's adaptive threshold. A recording of at most ``longest``
    seconds is one chunk; an unreadable one keeps a row with its problem.
    """
    lead = round(frame_ms / hop_ms / 2)  # frames between the start of a recording and its first centre
    sound = frames.where("problem is null")
    limit = adaptive_threshold(sound, "stem", "rms").select(F.col("stem").alias("ts"), "threshold")
    rated = sound.join(sorted_sides(limit), _same("stem", "ts")).select("stem", (F.col("idx") + lead).alias("i"), "rms", (F.col("rms") <= F.col("threshold")).alias("quiet"), "duration_sec")
    whole = F.round(F.col("duration_sec") * 1000 / hop_ms).cast("long")
    start = sound.groupBy("stem").agg(F.max("duration_sec").alias("duration_sec"))
    head = start.select("stem", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lead - 1).cast("long"))).alias("i"), F.lit(None).cast("double").alias("rms"), F.lit(False).alias("quiet"), "duration_sec") if lead > 0 else None
    rows = (rated.unionByName(head) if head is not None else rated).withColumn("end_at", whole)
    low, high = math.ceil(shortest * 1000 / hop_ms - 1e-9), math.floor(longest * 1000 / hop_ms + 1e-9)
    chunks = greedy_chunks(written(rows), "stem", "i", "rms", "quiet", low, high, "end_at").withColumnRenamed("stem", "_s")
    step = hop_ms / 1000
    timed = start.join(sorted_sides(chunks), _same("stem", "_s")).select("stem", (F.col("start") * step).alias("start_sec"), F.when(F.col("method") == "end", F.col("duration_sec")).otherwise(F.col("stop") * step).alias("end_sec"), "method")
    lost = frames.where("problem is not null").select("stem", *(F.lit(None).cast("double").alias(c) for c in ("start_sec", "end_sec")), F.lit(None).cast("string").alias("method"), "problem")
    return timed.withColumn("problem", F.lit(None).cast("string")).unionByName(lost)
