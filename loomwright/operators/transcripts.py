"""Transcripts as rows: aligning tokens with text, sentences, groups, punctuation edits, segment texts, stitching.

``texts``: source_id, text. ``tokens``: source_id, idx, char, start_sec,
end_sec. All joins are on the source and a rank within it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomwright.functions import text as T
from loomwright.functions.tables import sorted_sides
from loomwright.operators.pauses import pause_warning

# The mark that a rule inserts, and what it reports for each edit.
INSERTED = "，"
ACTIONS = {"long_without_punctuation": "add_comma", "short_at_weak": "remove_punctuation", "short_at_strong": "remove_punctuation"}


def text_chars(texts: DataFrame) -> DataFrame:
    """``source_id, pos, char`` of each code point."""
    return texts.select("source_id", F.posexplode(F.split("text", "")).alias("pos", "char")).where("char <> ''")


def align(texts: DataFrame, tokens: DataFrame) -> DataFrame:
    """``source_id, idx, positions``: the n-th spoken character of the tokens belongs to the n-th of the text; what is over is left out."""
    spoken_text = text_chars(texts).where(~T.is_silent(F.col("char")))
    in_text = spoken_text.withColumn("n", F.row_number().over(Window.partitionBy("source_id").orderBy("pos")))
    units = tokens.select("source_id", "idx", F.posexplode(F.split("char", "")).alias("k", "unit")).where("unit <> ''").where(~T.is_silent(F.col("unit")))
    in_tokens = units.withColumn("n", F.row_number().over(Window.partitionBy("source_id").orderBy("idx", "k")))
    both = in_tokens.select("source_id", "idx", "n").join(sorted_sides(in_text.select("source_id", "pos", "n")), ["source_id", "n"])
    return both.groupBy("source_id", "idx").agg(F.array_sort(F.collect_list("pos")).alias("positions"))


def boundaries(texts: DataFrame, aligned: DataFrame) -> DataFrame:
    """``source_id, idx, run, category, kind`` for each aligned token; ``kind`` is null where no boundary follows, final at the last one."""
    rows = aligned.join(sorted_sides(texts), "source_id").withColumn("run", T.run_after(F.col("text"), F.array_max("positions")))
    last = F.col("idx") == F.max("idx").over(Window.partitionBy("source_id"))
    return rows.select("source_id", "idx", "run", T.pause_category(F.col("run")).alias("category"), F.when(last, "final").otherwise(T.boundary_kind(F.col("run"))).alias("kind"))


def sentences(marks: DataFrame) -> DataFrame:
    """``sentence``: a running number that goes up after each strong or final boundary."""
    by = Window.partitionBy("source_id").orderBy("idx")
    closes = F.when(F.col("kind").isin("strong", "final"), 1).otherwise(0)
    return marks.withColumn("sentence", F.coalesce(F.sum(closes).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def sentence_groups(numbered: DataFrame, size: int = 5, padding: int = 1) -> DataFrame:
    """``group_id, core`` for each sentence: groups of ``size``, with ``padding`` sentences of the neighbours (core false)."""
    own = F.floor(F.col("sentence") / size).cast("long")
    near = F.sequence(F.greatest(F.lit(0), F.col("sentence") - padding), F.col("sentence") + padding)
    groups = F.array_distinct(F.concat(F.array(own), F.transform(near, lambda s: F.floor(s / size).cast("long"))))
    rows = numbered.select("source_id", "sentence").distinct()
    most = F.max(own).over(Window.partitionBy("source_id"))
    return rows.withColumn("_m", most).withColumn("group_id", F.explode(groups)).where(F.col("group_id") <= F.col("_m")).select("source_id", "sentence", "group_id", (F.col("group_id") == own).alias("core"))


def merged_ranges(ranges: DataFrame, first: str = "first", last: str = "last") -> DataFrame:
    """Ranges of indices (ends included) with touching or overlapping ones joined."""
    by = Window.partitionBy("source_id").orderBy(first, last)
    reach = F.max(last).over(by.rowsBetween(Window.unboundedPreceding, -1))
    rows = ranges.withColumn("_new", F.when(reach.isNull() | (F.col(first) > reach + 1), 1).otherwise(0))
    rows = rows.withColumn("_g", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy("source_id", "_g").agg(F.min(first).alias(first), F.max(last).alias(last)).drop("_g")


def punctuation_edits(texts: DataFrame, aligned: DataFrame, pauses: DataFrame, stats: DataFrame) -> DataFrame:
    """``source_id, idx, action, at, upto, mark``: runs to take out after short pauses, marks to put in at long ones.

    ``pauses``: source_id, idx, pause_ms; ``stats``: a row for each source
    with structs strong, weak and no_punc of quantiles.
    """
    rows = aligned.join(sorted_sides(texts), "source_id").join(sorted_sides(pauses), ["source_id", "idx"]).join(sorted_sides(stats), "source_id")
    rows = rows.withColumn("end", F.array_max("positions") + 1).withColumn("run", T.run_after(F.col("text"), F.col("end") - 1))
    why = pause_warning(T.pause_category(F.col("run")), F.col("pause_ms"), F.col("strong"), F.col("weak"), F.col("no_punc"))
    found = rows.withColumn("why", why).where(F.col("why").isNotNull() & ((F.col("why") == "long_without_punctuation") | (F.col("run") != "")))
    adds = F.col("why") == "long_without_punctuation"
    action = F.when(adds, ACTIONS["long_without_punctuation"]).otherwise(ACTIONS["short_at_weak"])
    return found.select("source_id", "idx", action.alias("action"), F.col("end").alias("at"), F.when(adds, F.col("end")).otherwise(F.col("end") + F.length("run")).alias("upto"), F.when(adds, INSERTED).otherwise("").alias("mark"))


def apply_edits(texts: DataFrame, edits: DataFrame) -> DataFrame:
    """``source_id, corrected, n_edits``: edits from left to right, overlapping ones skipped; none if a spoken character would change."""
    by = edits.groupBy("source_id").agg(F.array_sort(F.collect_list(F.struct("at", "upto", "mark"))).alias("edits"))
    rows = texts.join(sorted_sides(by), "source_id", "left")
    start = F.struct(F.lit(0).alias("done"), F.lit("").alias("out"), F.lit(0).alias("n"))

    def step(acc: Column, e: Column) -> Column:
        fits = e["at"] >= acc["done"]
        piece = F.concat(acc["out"], F.substring("text", acc["done"] + 1, e["at"] - acc["done"]), e["mark"])
        return F.struct(F.when(fits, e["upto"]).otherwise(acc["done"]).alias("done"), F.when(fits, piece).otherwise(acc["out"]).alias("out"), F.when(fits, acc["n"] + 1).otherwise(acc["n"]).alias("n"))

    folded = F.aggregate(F.coalesce("edits", F.array().cast("array<struct<at:int,upto:int,mark:string>>")), start, step)
    whole = F.concat(folded["out"], F.substring("text", folded["done"] + 1, F.length("text")))
    same = T.spoken(whole) == T.spoken(F.col("text"))
    return rows.select("source_id", F.when(same, whole).otherwise(F.col("text")).alias("corrected"), F.when(same, folded["n"]).otherwise(0).alias("n_edits"))


def contained(segments: DataFrame, tokens: DataFrame, width: int = 64) -> DataFrame:
    """Tokens with each segment (first_token to last_token) that holds them.

    Both meet in bins of ``width`` places, so a token is compared with the
    segments of its neighbourhood alone, and a long source is dealt over
    tasks; segments may overlap.
    """
    bin_ = lambda c: F.floor(F.col(c) / width).cast("long")
    dealt = segments.withColumn("_bin", F.explode(F.sequence(bin_("first_token"), bin_("last_token"))))
    return tokens.withColumn("_bin", bin_("idx")).join(sorted_sides(dealt), ["source_id", "_bin"]).where("idx between first_token and last_token").drop("_bin")


def segment_texts(segments: DataFrame, texts: DataFrame, aligned: DataFrame, tokens: DataFrame) -> DataFrame:
    """``transcript`` of each segment (first_token to last_token): its stretch of text with the marks that follow, or its tokens joined."""
    placed = tokens.select("source_id", "idx", "char").join(sorted_sides(aligned.select("source_id", "idx", "positions")), ["source_id", "idx"], "left")
    inside = contained(segments.select("source_id", "first_token", "last_token").distinct(), placed)
    said = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "char"))), lambda x: x["char"]), "")
    found = inside.groupBy("source_id", "first_token", "last_token").agg(F.min(F.array_min("positions")).alias("a"), F.max(F.array_max("positions")).alias("z"), said.alias("said"))
    rows = segments.join(sorted_sides(texts), "source_id", "left").join(sorted_sides(found), ["source_id", "first_token", "last_token"], "left")
    tail = F.regexp_extract(F.substring("text", F.col("z") + 2, F.length("text")), f"^{T.SILENT}*", 0)
    text = F.concat(F.substring("text", F.col("a") + 1, F.col("z") - F.col("a") + 1), tail)
    plain = F.btrim(F.regexp_replace(text, "\r\n|\n", " "))
    return rows.withColumn("transcript", F.when(F.col("a").isNull(), F.btrim(F.coalesce("said", F.lit("")))).otherwise(plain)).drop("text", "a", "z", "said")


def stitch(chunks: DataFrame, tokens: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chunks of a source made one: its texts joined by spaces, and its tokens renumbered with times from the source's start.

    ``chunks``: source_id, chunk, start_sec, text; ``tokens``: source_id,
    chunk, idx, char, start_sec, end_sec counted from the chunk.
    """
    some = F.when(F.trim("text") != "", F.struct("chunk", F.trim("text").alias("t")))  # a chunk without a result adds nothing, its source stays
    parts = chunks.groupBy("source_id").agg(F.array_sort(F.collect_list(some)).alias("p"))
    whole = parts.select("source_id", F.array_join(F.transform("p", lambda x: x["t"]), " ").alias("text"))
    moved = tokens.join(sorted_sides(chunks.select("source_id", "chunk", F.col("start_sec").alias("_o"))), ["source_id", "chunk"])
    place = F.row_number().over(Window.partitionBy("source_id").orderBy("chunk", "idx")) - 1
    return whole, moved.select("source_id", place.alias("idx"), "char", (F.col("start_sec") + F.col("_o")).alias("start_sec"), (F.col("end_sec") + F.col("_o")).alias("end_sec"))


def accepted_revision(original: Column, revised: Column) -> Column:
    """The revised text if it has the same spoken characters, else the original one."""
    return F.when(T.spoken(original) == T.spoken(revised), revised).otherwise(original)


def padded_bounds(tokens: DataFrame, padding: float = 0.1) -> DataFrame:
    """``opens_sec, closes_sec`` of each token: half way to its neighbours, but no more than ``padding`` away."""
    by = Window.partitionBy("source_id").orderBy("idx")
    before, after = F.lag("end_sec").over(by), F.lead("start_sec").over(by)
    opens = F.coalesce(F.greatest((before + F.col("start_sec")) / 2, F.when(before.isNotNull(), F.col("start_sec") - padding)), F.col("start_sec"))
    closes = F.coalesce(F.least((F.col("end_sec") + after) / 2, F.when(after.isNotNull(), F.col("end_sec") + padding)), F.col("end_sec"))
    return tokens.withColumn("opens_sec", opens).withColumn("closes_sec", closes)
