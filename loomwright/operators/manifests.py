"""Comparing manifests by key, and statistics of their texts and numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomwright.functions.levels import nearly_equal, percent
from loomwright.functions.tables import group_quantiles, joined_by
from loomwright.functions.text import ending_kind


def unique_keys(rows: DataFrame, key: str, order: list[str], name: str = "unique_key") -> DataFrame:
    """The n-th row of a key (n > 1) is called ``key#n``; ``is_duplicate`` marks it."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    text = F.col(key).cast("string")
    return rows.withColumn("_n", n).withColumn(name, F.when(F.col("_n") > 1, F.concat(text, F.lit("#"), F.col("_n").cast("string"))).otherwise(text)).withColumn("is_duplicate", F.col("_n") > 1).drop("_n")


def diff(left: DataFrame, right: DataFrame, key: str, fields: list[str], numbers: dict[str, float] | None = None) -> DataFrame:
    """Each key with ``status`` (added, removed, changed, same) and ``changed_fields``.

    ``numbers``: fields that are compared with a tolerance.
    """
    numbers = numbers or {}
    a = left.select(key, F.lit(True).alias("_l"), *(F.col(f).alias(f"_l_{f}") for f in fields))
    b = right.select(key, F.lit(True).alias("_r"), *(F.col(f).alias(f"_r_{f}") for f in fields))
    both = a.join(b, key, "full_outer")

    def same(f: str) -> Column:
        x, y = F.col(f"_l_{f}"), F.col(f"_r_{f}")
        equal = x.eqNullSafe(y)
        return equal | F.coalesce(nearly_equal(x, y, numbers[f]), F.lit(False)) if f in numbers else equal

    changed = F.array_compact(F.array(*(F.when(~same(f), F.lit(f)) for f in fields)))
    status = F.when(F.col("_l").isNull(), "added").when(F.col("_r").isNull(), "removed").when(F.size("_c") > 0, "changed").otherwise("same")
    return both.withColumn("_c", changed).withColumn("status", status).select(key, "status", F.when(F.col("status") == "changed", F.col("_c")).otherwise(F.array().cast("array<string>")).alias("changed_fields"))


def changed_field_counts(found: DataFrame) -> DataFrame:
    """How often each field changed, the most often first."""
    return found.select(F.explode("changed_fields").alias("field")).groupBy("field").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "field")


def numeric_summary(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """Rows, least, median, mean, 95th percentile by nearest rank, and largest."""
    plain = rows.groupBy(*by).agg(F.count(value).alias("n"), F.min(value).alias("least"), F.avg(value).alias("mean"), F.max(value).alias("largest"))
    ranked = group_quantiles(rows, by, {"median": (value, 0.5, True), "p95": (value, 0.95, False)})
    return joined_by(plain, ranked, by).select(*by, "n", "least", "median", "mean", "p95", "largest")


def ending_stats(rows: DataFrame, by: list[str], text: str) -> DataFrame:
    """How many texts end with a strong or a weak mark, and in percent."""
    kind = ending_kind(F.col(text))
    found = rows.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(kind == "strong").alias("strong_endings"), F.count_if(kind == "weak").alias("weak_endings"))
    return found.withColumn("strong_percent", percent(F.col("strong_endings"), F.col("n"))).withColumn("weak_percent", percent(F.col("weak_endings"), F.col("n")))


def top_endings(rows: DataFrame, text: str, order: str, k: int = 8) -> DataFrame:
    """The k most frequent last characters; of equals the one seen first."""
    last = F.right(F.rtrim(F.col(text)), F.lit(1))
    return rows.where(F.rtrim(F.col(text)) != "").groupBy(last.alias("ending")).agg(F.count("*").alias("n"), F.min(order).alias("first_seen")).orderBy(F.col("n").desc(), "first_seen").limit(k)


def top_per_group(rows: DataFrame, by: str, order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group with their ``place``."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("place") <= k)


def status_counts(rows: DataFrame, by: list[str], status: Column, values: list[str], seconds: Column) -> DataFrame:
    """Rows of each status side by side, and the hours of the first one."""
    counts = [F.count_if(status == v).alias(f"n_{v}") for v in values]
    hours = F.round(F.coalesce(F.sum(F.when(status == values[0], seconds)), F.lit(0.0)) / 3600, 4).alias(f"{values[0]}_hours")
    return rows.groupBy(*by).agg(F.count("*").alias("n"), *counts, hours)


def final_filter(segments: DataFrame, source: str, order: str, duration: Column, drop: Column, shortest: float, longest: float) -> DataFrame:
    """``segment_index`` over all segments of a source, and ``status``: kept, dropped_llm (marked) or dropped_length."""
    fits = (duration >= shortest - 1e-6) & (duration <= longest + 1e-6)
    status = F.when(drop, "dropped_llm").when(~fits, "dropped_length").otherwise("kept")
    return segments.withColumn("segment_index", F.row_number().over(Window.partitionBy(source).orderBy(order)) - 1).withColumn("status", status)


def unique_names(rows: DataFrame, name: str, order: list[str]) -> DataFrame:
    """``unique_name``: the second of a name gets ``__dup2``, the third ``__dup3``."""
    n = F.row_number().over(Window.partitionBy(name).orderBy(*order))
    return rows.withColumn("_n", n).withColumn("unique_name", F.when(F.col("_n") > 1, F.concat(F.col(name), F.lit("__dup"), F.col("_n").cast("string"))).otherwise(F.col(name))).drop("_n")


def worst_of_each(rows: DataFrame, by: str, label: str, score: str) -> DataFrame:
    """The label with the highest score of each group; of equals the one that sorts last ("start" before "end")."""
    return rows.groupBy(by).agg(F.max(score).alias(score), F.max_by(label, F.struct(score, label)).alias(label))
