"""Pauses between tokens: measuring, quantiles by category, warnings, ranks and boundary rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomwright.functions.tables import fresh

POINTS = (0.05, 0.2, 0.4, 0.5, 0.6, 0.8, 0.95)
NAMES = ("p5", "p20", "p40", "p50", "p60", "p80", "p95")
# Quantiles of a category with fewer than five pauses, the longest pause that counts, the categories.
FALLBACK = (150.0, 280.0, 420.0, 500.0, 600.0, 900.0, 1500.0)
LONGEST_PAUSE_MS = 3000.0
FEWEST = 5
CATEGORIES = ("strong", "weak", "no_punc")


def token_pauses(tokens: DataFrame, source: str = "source_id", order: str = "idx", start: str = "start_sec", end: str = "end_sec") -> DataFrame:
    """``pause_ms`` after each token but the last of its source, not below 0."""
    after = F.lead(start).over(Window.partitionBy(source).orderBy(order))
    return tokens.withColumn("pause_ms", F.when(after.isNotNull(), F.greatest(F.lit(0.0), (after - F.col(end)) * 1000))).where(F.col("pause_ms").isNotNull())


def _quantiles(n: Column, q: Column) -> list[Column]:
    few = n < FEWEST
    return [F.when(few, F.lit(f)).otherwise(q[k]).alias(name) for k, (name, f) in enumerate(zip(NAMES, FALLBACK, strict=True))]


def pause_quantiles(pauses: DataFrame, source: str = "source_id", category: str = "category", value: str = "pause_ms", longest: float = LONGEST_PAUSE_MS) -> DataFrame:
    """Seven interpolated quantiles for each source and category; categories with fewer than five pauses get the fixed ones.

    Every source has all three categories; pauses beyond ``longest`` do not
    count.
    """
    kept = pauses.where(F.col(value) <= longest)
    found = kept.groupBy(source, category).agg(F.count("*").alias("n"), F.percentile(value, F.array(*map(F.lit, POINTS))).alias("q"))
    full = pauses.select(source).distinct().withColumn(category, F.explode(F.array(*map(F.lit, CATEGORIES))))
    n = F.coalesce("n", F.lit(0))
    return full.join(found, [source, category], "left").select(source, category, n.alias("n"), *_quantiles(n, F.col("q")), (n < FEWEST).alias("is_fallback"))


def by_category(stats: DataFrame, source: str = "source_id", category: str = "category") -> DataFrame:
    """One row for each source with structs strong, weak and no_punc."""
    cell = F.struct(*NAMES, "n", "is_fallback")
    return stats.groupBy(source).agg(*(F.max(F.when(F.col(category) == c, cell)).alias(c) for c in CATEGORIES))


def combined_quantiles(pauses: DataFrame, source: str = "source_id", category: str = "category", value: str = "pause_ms") -> DataFrame:
    """Quantiles of strong and weak boundaries together."""
    found = pauses.where(F.col(category).isin("strong", "weak")).groupBy(source).agg(F.count("*").alias("n"), F.percentile(value, F.array(*map(F.lit, POINTS))).alias("q"))
    return found.select(source, "n", *_quantiles(F.col("n"), F.col("q")), (F.col("n") < FEWEST).alias("is_fallback"))


def quantiles_of(values: Column) -> Column:
    """The struct of the seven quantiles of a sorted array of pauses, as ``percentile`` interpolates them."""
    n = F.size(values)

    def at(point: float) -> Column:
        x = (n - 1) * F.lit(point)
        below, above = (F.try_element_at(values, f(x).cast("int") + 1) for f in (F.floor, F.ceil))
        return F.when(below == above, below).otherwise((F.ceil(x) - x) * below + (x - F.floor(x)) * above)

    return F.struct(*(F.when(n < FEWEST, F.lit(f)).otherwise(at(p)).alias(name) for name, p, f in zip(NAMES, POINTS, FALLBACK, strict=True)))


def beside(rows: DataFrame, source: str = "source_id", **pauses: Column) -> DataFrame:
    """``rows`` with structs of the seven quantiles of a source's pauses (null ones do not count), on each of its rows: those meet sorted, no map of groups is kept.

    Counts and quantiles are columns of their own before the structs are
    made of them, as Spark computes a window anew for each place it is named in.
    """
    whole = Window.partitionBy(source)
    n, q = ({c: fresh(rows, f"_{x}_{c}") for c in pauses} for x in ("n", "q"))
    found = rows.withColumns({n[c]: F.count(p).over(whole) for c, p in pauses.items()} | {q[c]: F.percentile(p, F.array(*map(F.lit, POINTS))).over(whole) for c, p in pauses.items()})
    return found.withColumns({c: F.struct(*_quantiles(F.col(n[c]), F.col(q[c]))) for c in pauses}).drop(*n.values(), *q.values())


def pause_warning(category: Column, pause: Column, strong: Column, weak: Column, bare: Column) -> Column:
    """Why a pause looks wrong for its punctuation, or null."""
    return (
        F.when((category == "no_punc") & (pause >= F.greatest(bare["p95"], F.lit(180.0))), "long_without_punctuation")
        .when((category == "weak") & (pause <= F.greatest(weak["p5"], bare["p60"])), "short_at_weak")
        .when((category == "strong") & (pause <= F.greatest(strong["p5"], weak["p20"])), "short_at_strong")
    )


def boundary_quality(kind: Column, pause: Column, strong: Column, weak: Column, bare: Column) -> Column:
    """perfect, ok or bad for a strong or weak boundary; a final one is perfect."""
    good_strong = F.greatest(strong["p50"], weak["p80"], F.lit(180.0))
    fair_strong = F.greatest(strong["p20"], weak["p50"], F.lit(90.0))
    good_weak = F.greatest(weak["p80"], bare["p95"], F.lit(220.0))
    fair_weak = F.greatest(weak["p50"], bare["p80"], F.lit(120.0))
    return (
        F.when(kind == "final", "perfect")
        .when(kind == "strong", F.when(pause >= good_strong, "perfect").when(pause >= fair_strong, "ok").otherwise("bad"))
        .otherwise(F.when(pause >= good_weak, "perfect").when(pause >= fair_weak, "ok").otherwise("bad"))
    )


def cut_policy(kind: Column, pause: Column, strong: Column, weak: Column) -> Column:
    """must_cut, no_cut or normal."""
    return (
        F.when(kind == "final", "must_cut")
        .when((kind == "strong") & (pause >= strong["p80"]), "must_cut")
        .when((kind == "weak") & (pause >= F.least(strong["p80"], weak["p95"])), "must_cut")
        .when((kind == "weak") & (pause <= weak["p20"]), "no_cut")
        .otherwise("normal")
    )


def pause_classes(pauses: DataFrame, source: str = "source_id", value: str = "pause_ms") -> DataFrame:
    """``pause_rank`` from the longest pause (ties share the lowest rank) and its class in fifths."""
    by = Window.partitionBy(source)
    ranked = pauses.withColumn("pause_rank", F.rank().over(by.orderBy(F.col(value).desc()))).withColumn("_n", F.count("*").over(by))
    share = F.col("pause_rank") / F.col("_n")
    label = F.when(share <= 0.2, "very long pause").when(share <= 0.4, "long pause").when(share <= 0.6, "median pause").when(share <= 0.8, "short pause").otherwise("very short pause")
    return ranked.withColumn("pause_class", label).drop("_n")


def top_half(candidates: DataFrame, source: str, kind: str, pause: str, token: str, ident: str) -> DataFrame:
    """``in_top``: the better half of a source's candidates, strong ones first, then by longer pause, token and id."""
    by = Window.partitionBy(source)
    place = F.row_number().over(by.orderBy(F.when(F.col(kind) == "strong", 0).otherwise(1), F.col(pause).desc(), token, ident))
    return candidates.withColumn("in_top", place <= F.ceil(F.count("*").over(by) / 2))
