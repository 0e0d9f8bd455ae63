"""Loudness: robust targets, reasons to prune, gain modes, K-weighted loudness of a signal."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomwright.functions.tables import group_quantiles, written

# Z scale of a MAD, weights of the positive edge scores, centre of their likelihood, ceiling of a target.
Z_SCALE = 0.67448975
EDGE_WEIGHTS = (0.30, 0.20, 0.30, 0.15, 0.05)
EDGE_CENTRE = 1.5
CEILING_DBFS = -1.0


def weighted_median(rows: DataFrame, by: str, value: str, weight: str) -> DataFrame:
    """``weighted_median``: the least value at which the weights sum to half of the total; weights of 0 or less do not count.

    Equal values are summed, the sums range-sorted, and running sums kept
    within a range: what came before it is one number for each key and
    range, so no key is held in one task.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sums = written(rows.where(F.col(weight) > 0).groupBy(by, value).agg(F.sum(weight).alias("_w")))
    dealt = written(sums.repartitionByRange(n, by, value).withColumn("_part", F.spark_partition_id()))
    parts = dealt.groupBy(by, "_part").agg(F.sum("_w").alias("_in"))
    key = Window.partitionBy(by)
    before = F.coalesce(F.sum("_in").over(key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select(F.col(by).alias("_by"), F.col("_part").alias("_p"), before.alias("_before"), F.sum("_in").over(key).alias("_total"), "_in")
    # only the range in which the half is reached is summed up row by row
    parts = parts.where((F.col("_before") < F.col("_total") / 2) & (F.col("_before") + F.col("_in") >= F.col("_total") / 2))
    near = dealt.join(parts, dealt[by].eqNullSafe(F.col("_by")) & (F.col("_part") == F.col("_p")))
    upto = F.col("_before") + F.sum("_w").over(Window.partitionBy(by, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    return near.withColumn("_upto", upto).where(F.col("_upto") >= F.col("_total") / 2).groupBy(by).agg(F.min(value).alias("weighted_median"))


def target_level(rows: DataFrame, level: str, weight: str, headroom_target: str, ceiling: float = CEILING_DBFS) -> DataFrame:
    """One row: the weighted median level of all files, not above any file's safe target nor the ceiling."""
    all_ = rows.withColumn("_all", F.lit(1))
    median = weighted_median(all_, "_all", level, weight)
    safe = all_.groupBy("_all").agg(F.min(headroom_target).alias("_safe"))
    return median.join(safe, "_all").select(F.least("weighted_median", "_safe", F.lit(ceiling)).alias("target"))


def prune_reasons(level: Column, headroom: Column, active: Column, dynamic: Column, target: float, most_gain: float, margin: float, least_active: float, most_dynamic: float) -> Column:
    """Array of what speaks against a segment: too_quiet, would_clip, inactive, too_dynamic."""
    needed = F.lit(target) - level
    return F.array_compact(
        F.array(
            F.when(needed > most_gain, F.lit("too_quiet")),
            F.when(needed > headroom - margin, F.lit("would_clip")),
            F.when(active < least_active, F.lit("inactive")),
            F.when(dynamic > most_dynamic, F.lit("too_dynamic")),
        )
    )


def robust_z(rows: DataFrame, by: str, features: list[str]) -> DataFrame:
    """``z_<feature>``: distance to the group's median in MADs, or in population deviations where the MAD vanishes.

    Medians are exact (``group_quantiles``), and no group is held in one
    task.
    """
    cells = F.explode(F.array(*(F.struct(F.lit(k).alias("f"), F.col(f).cast("double").alias("v")) for k, f in enumerate(features)))).alias("c")
    values = written(rows.where(F.col(by).isNotNull()).select(by, cells).select(by, "c.f", "c.v").where("v is not null"))
    medians = group_quantiles(values, [by, "f"], {"med": ("v", 0.5, True)})
    medians = written(medians.join(values.groupBy(by, "f").agg(F.stddev_pop("v").alias("std")), [by, "f"]))
    far = values.join(medians, [by, "f"]).select(by, "f", F.abs(F.col("v") - F.col("med")).alias("v"))
    spread = group_quantiles(far, [by, "f"], {"mad": ("v", 0.5, True)})
    scale = F.when(F.col("mad") >= 1e-9, F.col("mad") / Z_SCALE).when(F.col("std") > 1e-9, F.col("std")).otherwise(1.0)
    wide = medians.join(spread, [by, "f"]).withColumn("scale", scale).groupBy(by).agg(F.map_from_entries(F.collect_list(F.struct("f", F.struct("med", "scale")))).alias("_m"))
    out = rows.join(written(wide), by)
    return out.withColumns({f"z_{f}": (F.col(f) - F.col("_m")[k]["med"]) / F.col("_m")[k]["scale"] for k, f in enumerate(features)}).drop("_m")


def edge_score(zs: list[Column], weights: tuple[float, ...] = EDGE_WEIGHTS) -> Column:
    total = F.lit(0.0)
    for z, w in zip(zs, weights, strict=False):
        total = total + F.greatest(z, F.lit(0.0)) * w
    return total


def restore_gain(enhanced: np.ndarray, reference: np.ndarray, mode: str) -> tuple[np.ndarray, float]:
    """The enhanced signal brought back to the reference's rms or peak (or the lower gain of both), never clipping."""
    def rms(x: np.ndarray) -> float:
        return float(np.sqrt(np.mean(np.square(x, dtype=np.float64)))) if len(x) else 0.0

    def top(x: np.ndarray) -> float:
        return float(np.max(np.abs(x))) if len(x) else 0.0

    gains = []
    if mode in ("rms", "rms-peak") and rms(enhanced) > 1e-8:
        gains.append(rms(reference) / rms(enhanced))
    if mode in ("peak", "rms-peak") and top(enhanced) > 1e-8:
        gains.append(top(reference) / top(enhanced))
    gain = min(gains) if gains else 1.0
    if top(enhanced) * gain > 1.0:
        gain = 1.0 / top(enhanced)
    return (enhanced * gain).astype(np.float32), gain


def restored(enhanced: np.ndarray, reference: np.ndarray, mode: str, target_dbfs: float | None = None, ceiling: float = CEILING_DBFS) -> tuple[np.ndarray, float, str]:
    """(signal, gain, reason) by a gain mode: that of the reference (:func:`restore_gain`), a target under the ceiling, or none; a silent output is left as it is."""
    if mode == "none":
        return enhanced, 1.0, "disabled"
    if mode in ("rms", "peak", "rms-peak"):
        out, gain = restore_gain(enhanced, reference, mode)
        return out, gain, f"source {mode}"
    if mode not in ("target-rms", "target-peak") or target_dbfs is None:
        raise ValueError(f"unknown gain mode {mode}, or no target for it")
    peak = float(np.max(np.abs(enhanced), initial=0))
    level = float(np.sqrt(np.mean(np.square(enhanced, dtype=np.float64)))) if mode == "target-rms" and len(enhanced) else peak
    if peak <= 1e-8 or level <= 1e-8:
        return enhanced, 1.0, "silent output"
    wanted, most = 10 ** (target_dbfs / 20) / level, 10 ** (min(ceiling, 0.0) / 20) / peak
    gain = min(wanted, most)
    why = f"{mode.replace('-', ' ')} {target_dbfs:.1f} dBFS" if gain == wanted else f"limited by peak ceiling {ceiling:.1f} dBFS"
    return (enhanced * gain).astype(np.float32), gain, why


def _biquad(x: np.ndarray, b: np.ndarray, a: np.ndarray) -> np.ndarray:
    out = np.empty_like(x)
    z1 = z2 = 0.0
    for k, v in enumerate(x.tolist()):
        y = b[0] * v + z1
        z1 = b[1] * v - a[1] * y + z2
        z2 = b[2] * v - a[2] * y
        out[k] = y
    return out


@lru_cache(maxsize=8)
def _weighting_response(rate: int) -> np.ndarray:
    """Impulse response of both filters over one second, by when it has died away."""
    out = np.zeros(rate)
    out[0] = 1.0
    for b, a in k_weighting(rate):
        out = _biquad(out, b, a)
    return out


def weighted_signal(x: np.ndarray, rate: int) -> np.ndarray:
    """The K-weighted signal, by convolution with the filters' response in blocks (overlap-add)."""
    h = _weighting_response(rate)
    size = 1 << max(15, (2 * len(h) - 1).bit_length())
    step = size - len(h) + 1
    spectrum = np.fft.rfft(h, size)
    out = np.zeros(len(x) + len(h) - 1)
    for k in range(0, len(x), step):
        part = np.fft.irfft(np.fft.rfft(x[k : k + step], size) * spectrum, size)
        part = part[: len(out) - k]
        out[k : k + len(part)] += part
    return out[: len(x)]


def k_weighting(rate: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The two filters of ITU-R BS.1770 at any sample rate (a high shelf, then a high pass)."""
    def shelf(f0: float, gain_db: float, q: float) -> tuple[np.ndarray, np.ndarray]:
        k, vh = np.tan(np.pi * f0 / rate), 10 ** (gain_db / 20)
        vb = vh**0.4996667741545416
        a0 = 1 + k / q + k * k
        return np.array([vh + vb * k / q + k * k, 2 * (k * k - vh), vh - vb * k / q + k * k]) / a0, np.array([1, 2 * (k * k - 1) / a0, (1 - k / q + k * k) / a0])

    def high_pass(f0: float, q: float) -> tuple[np.ndarray, np.ndarray]:
        k = np.tan(np.pi * f0 / rate)
        a0 = 1 + k / q + k * k
        return np.array([1.0, -2.0, 1.0]), np.array([1, 2 * (k * k - 1) / a0, (1 - k / q + k * k) / a0])

    return [shelf(1681.974450955533, 3.999843853973347, 0.7071752369554196), high_pass(38.13547087602444, 0.5003270373238773)]


def integrated_loudness(signal: np.ndarray, rate: int) -> float:
    """LUFS of a mono signal: K-weighted blocks of 400 ms every 100 ms, gated at -70 LUFS and 10 LU under the mean."""
    size, step = int(round(0.4 * rate)), int(round(0.1 * rate))
    if len(signal) < size:
        raise ValueError("the signal is shorter than a block of 400 ms")
    x = weighted_signal(signal.astype(np.float64), rate)
    total = np.append(0, np.cumsum(x * x))
    starts = np.arange(0, len(x) - size + 1, step)
    power = (total[starts + size] - total[starts]) / size
    level = -0.691 + 10 * np.log10(np.maximum(power, 1e-30))
    loud = power[level >= -70]
    if not len(loud):
        return float("-inf")
    gate = -0.691 + 10 * np.log10(loud.mean()) - 10
    kept = power[(level >= -70) & (level > gate)]
    return float(-0.691 + 10 * np.log10(kept.mean())) if len(kept) else float("-inf")
