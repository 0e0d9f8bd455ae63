"""Outliers among embeddings: centroid, cosine scores, a MAD threshold with a cap on what it prunes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwright.functions.levels import dot, unit
from loomwright.functions.tables import group_quantiles, with_rank, written

MAD_SCALE = 1.4826  # fixed value: MAD of a normal distribution to its deviation


def cosine_scores(rows: DataFrame, embedding: str = "embedding") -> DataFrame:
    """``similarity`` of each embedding to the normalised mean of all unit embeddings; an error for a zero one."""
    units = rows.withColumn("_unit", unit(F.col(embedding)))
    # one number for each dimension, whatever the corpus
    means = [r["m"] for r in sorted(units.select(F.posexplode("_unit").alias("k", "x")).groupBy("k").agg(F.avg("x").alias("m")).collect(), key=lambda r: r["k"])]
    length = sum(m * m for m in means) ** 0.5 or 1.0
    centroid = F.array(*(F.lit(m / length) for m in means)).cast("array<double>")
    return units.withColumn("similarity", dot(F.col("_unit"), centroid)).drop("_unit")


def _middle(values: DataFrame) -> tuple[int, float | None]:
    """(count, exact median) of ``v``."""
    one = values.withColumn("all", F.lit(1))
    found = one.groupBy("all").agg(F.count("v").alias("n")).join(group_quantiles(one, ["all"], {"m": ("v", 0.5, True)}), "all").first()
    return (found["n"], found["m"]) if found else (0, None)


def prune_outliers(scored: DataFrame, order: Column, multiplier: float = 3.0, ratio: float = 0.1, fewest: int = 8) -> DataFrame:
    """``rank_lowest_first, threshold, median, mad, pruned, reason`` beside each score.

    A score under median - multiplier * 1.4826 * MAD is pruned, the lowest
    first, up to max(1, floor(rows * ratio)); none with a ratio of 0 or
    fewer than ``fewest`` rows.
    """
    # written first: the range sort reads its input twice, and scores are dear
    ranked = with_rank(written(scored), [F.col("similarity"), order], "rank_lowest_first")
    n, median = _middle(ranked.select(F.col("similarity").alias("v")))
    if not n:
        empty = scored.withColumn("rank_lowest_first", F.lit(0).cast("long"))
        return empty.withColumns({c: F.lit(0.0) for c in ("threshold", "median", "mad")} | {"pruned": F.lit(False), "reason": F.lit("")})
    _, mad = _middle(ranked.select(F.abs(F.col("similarity") - median).alias("v")))
    threshold = median - multiplier * MAD_SCALE * mad
    most = min(n, max(1, int(n * ratio)) if ratio > 0 else 0) if n >= fewest else 0
    pruned = (F.col("similarity") < threshold) & (F.col("rank_lowest_first") <= most)
    return ranked.withColumns(
        {"threshold": F.lit(threshold), "median": F.lit(median), "mad": F.lit(mad), "pruned": pruned, "reason": F.when(pruned, "below speaker similarity threshold").otherwise("")}
    )
