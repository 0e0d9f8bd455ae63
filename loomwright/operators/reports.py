"""Reports of the audits as tables: speaker outliers, manifest differences, cut experiments, and one-row summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwright.functions.tables import group_quantiles, joined_by
from loomwright.operators.loudness import marked_payload


def speaker_report(pruned: DataFrame, row: str, audio: str) -> DataFrame:
    """One row for each record of ``speakers.prune_outliers``, scores with eight decimals as text."""
    eight = [F.format_string("%.8f", c).alias(c) for c in ("similarity", "threshold", "median", "mad")]
    return pruned.select(F.col(row).alias("jsonl_row"), F.col(audio).alias("audio"), eight[0], "rank_lowest_first", *eight[1:], "pruned", "reason")


def speaker_summary(pruned: DataFrame, ratio: float = 0.1, fewest: int = 8) -> DataFrame:
    """One row: how many records, how many are kept and pruned, the threshold, and how many the cap spared."""
    under = F.count_if(F.col("similarity") < F.col("threshold"))
    n = F.count("*")
    why = F.when(n < fewest, f"fewer than {fewest} rows").when(F.lit(ratio) <= 0, "ratio is 0")
    most = F.when(why.isNotNull(), 0).otherwise(F.least(n, F.greatest(F.lit(1), F.floor(n * ratio))))
    return pruned.agg(
        n.alias("row_count"), F.count_if(~F.col("pruned")).alias("kept_count"), F.count_if("pruned").alias("pruned_count"), F.first("threshold").alias("threshold"),
        F.first("median").alias("median"), F.first("mad").alias("mad"), under.alias("threshold_prune_count"), (under - F.count_if("pruned")).alias("capped_prune_count"),
        most.cast("long").alias("max_allowed_prune_count"), why.alias("pruning_disabled_reason"),
    )


def speaker_pruned_records(pruned: DataFrame, payload: str = "payload") -> DataFrame:
    """Payloads of the pruned records, marked with that, their similarity and the reason."""
    return marked_payload(pruned.where("pruned"), payload, {"speaker_outlier_pruned": "pruned", "speaker_similarity": "similarity", "speaker_outlier_reason": "reason"})


def cut_summary(segments: DataFrame, by: list[str], seconds: str, hit: Column, silence_ms: str, fallback: Column) -> DataFrame:
    """Segments of a cut experiment: count, lengths, share of cuts in a silence (percent), silence lengths, fallbacks that are no tails."""
    plain = segments.groupBy(*by).agg(
        F.count("*").alias("segments"), F.avg(seconds).alias("mean_sec"), F.min(seconds).alias("least_sec"), F.max(seconds).alias("most_sec"),
        (F.avg(hit.cast("double")) * 100).alias("hit_percent"), F.count_if(fallback).alias("fallbacks"),
    )
    ranked = group_quantiles(segments, by, {"median_sec": (seconds, 0.5, True), "silence_median_ms": (silence_ms, 0.5, True), "silence_p90_ms": (silence_ms, 0.9, True)})
    return joined_by(plain, ranked, by).select(*by, "segments", "mean_sec", "median_sec", "least_sec", "most_sec", "hit_percent", "silence_median_ms", "silence_p90_ms", "fallbacks")


def compact_pauses(stats: DataFrame, by: list[str], count: str, points: list[str]) -> DataFrame:
    """Pause quantiles as whole milliseconds beside their count."""
    return stats.select(*by, F.col(count).alias("count"), *(F.round(p).cast("long").alias(f"{p}_ms") for p in points))


def diff_lines(found: DataFrame, key: str, fields: dict[str, tuple[str, str]], width: int = 80) -> DataFrame:
    """Lines of text of a manifest diff (key, status, changed_fields): ``key, line, text``, a head for each key and a line for each field.

    ``fields``: for each field the columns with its value on the left and on
    the right; long values are cut to ``width`` characters in the line.
    """

    def shown(c: str) -> Column:
        text = F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("-")), r"\s+", " ")
        return F.when(F.length(text) > width, F.concat(F.left(text, F.lit(width - 3)), F.lit("..."))).otherwise(text)

    each = [F.when(F.array_contains("changed_fields", f), F.concat(F.lit(f"  {f}: "), shown(a), F.lit(" -> "), shown(b))) for f, (a, b) in fields.items()]
    lines = F.array_compact(F.array(F.concat(F.col("status"), F.lit(" "), F.col(key).cast("string")), *each))
    return found.where("status != 'same'").select(key, F.posexplode(lines).alias("line", "text"))


def part_mapping(parts: DataFrame, source: str = "source_path", output: str = "output_path") -> DataFrame:
    """The nine columns that map the parts of a pre-split to their sources, seconds with three decimals as text.

    ``parts``: the two paths, part_index, part_count, start_sec, end_sec,
    cut_method and silence_sec (null for the last part: final, no silence).
    """
    three = lambda c: F.format_string("%.3f", c.cast("double"))
    return parts.select(
        F.col(source).alias("source_path"), F.col(output).alias("output_path"), "part_index", "part_count", three(F.col("start_sec")).alias("start_sec"), three(F.col("end_sec")).alias("end_sec"),
        three(F.col("end_sec") - F.col("start_sec")).alias("duration_sec"), F.coalesce("cut_method", F.lit("final")).alias("cut_method"), three(F.coalesce("silence_sec", F.lit(0.0))).alias("silence_sec"),
    )


def write_mapping(mapping: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The mapping as CSV with a header, in the order of sources and parts."""
    mapping.orderBy("source_path", "part_index").write.mode(mode).option("header", True).csv(path)


def write_summary(row: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A table of one row (an aggregate) as one JSON object in one file; the commit of the write makes it appear whole."""
    row.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).coalesce(1).write.mode(mode).text(path)


def write_by_source(rows: DataFrame, path: str, source: str, mode: str = "errorifexists") -> None:
    """Rows laid out in one folder for each source, as JSON lines."""
    rows.write.mode(mode).partitionBy(source).json(path)
