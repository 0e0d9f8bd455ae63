"""Levels, gains and tolerant comparisons as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dbfs(amplitude: Column) -> Column:
    return 20 * F.log10(F.greatest(amplitude, F.lit(1e-12)))


def gain(db: Column) -> Column:
    return F.pow(F.lit(10.0), db / 20)


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-F.least(F.greatest(x, F.lit(-60.0)), F.lit(60.0))))


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, 0.0).otherwise(F.round(100.0 * part / whole, 2))


def nearly_equal(a: Column, b: Column, tolerance: float) -> Column:
    return F.abs(a - b) <= F.greatest(1e-9 * F.greatest(F.abs(a), F.abs(b)), F.lit(tolerance))


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def unit(v: Column) -> Column:
    """The vector at length 1; an error for a zero or non-finite one."""
    n = norm(v)
    checked = F.when((n > 1e-12) & (n < float("inf")), n).otherwise(F.raise_error(F.lit("embedding has no finite length above 1e-12")).cast("double"))
    return F.transform(v, lambda x: x.cast("double") / checked)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def rms(samples: Column) -> Column:
    """Root of the mean square of an array; 0 for an empty one."""
    n = F.size(samples)
    return F.when(n > 0, F.sqrt(F.aggregate(samples, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")) / n)).otherwise(0.0)


def peak(samples: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(samples, lambda x: F.abs(x))), F.lit(0.0))
