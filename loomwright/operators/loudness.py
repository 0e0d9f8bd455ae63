"""The volume tool over files: measure, decide what to prune, bring the rest to one loudness, and report.

Files are rows (stem, content); signals are worked on in batches inside
tasks, everything after the measurement is column expressions.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwright.operators.signal import per_file
from loomwright.operators.volume import integrated_loudness
from loomwright.sources.audio import Made, encode_wav

# Fixed value: the least amplitude that levels are taken of.
LEAST = 1e-12
MEASURES = "seconds double, rate int, lufs double, peak_dbfs double, headroom_db double, active_ratio double, dynamic_range_db double"


def frame_levels(signal: np.ndarray, rate: int) -> np.ndarray:
    """Level in dB of centred frames of 50 ms (256 to 2048 samples) every quarter of a frame."""
    size = min(2048, max(256, int(rate * 0.05)))
    hop = max(1, size // 4)
    total = np.append(0, np.cumsum(np.square(np.pad(signal.astype(np.float64), size // 2))))
    at = np.arange(1 + len(signal) // hop) * hop
    at = at[at + size < len(total)]
    return 20 * np.log10(np.maximum(np.sqrt(np.maximum(total[at + size] - total[at], 0) / size), LEAST))


def measures(signal: np.ndarray, rate: int, silence_db: float = 40.0) -> tuple[float, int, float, float, float, float, float]:
    """One row of ``MEASURES``; an error for an empty signal, one under 400 ms, or one without a finite loudness."""
    if not len(signal):
        raise ValueError("empty audio")
    lufs = integrated_loudness(signal, rate)
    if not np.isfinite(lufs):
        raise ValueError("no finite loudness")
    level = frame_levels(signal, rate)
    active = level[level >= level.max() - silence_db]
    low, high = np.percentile(active, [10, 95])
    peak = 20 * float(np.log10(max(float(np.max(np.abs(signal))), LEAST)))
    return len(signal) / rate, rate, lufs, peak, -peak, len(active) / len(level), float(high - low)


def measure_files(files: DataFrame | Made, silence_db: float = 40.0) -> DataFrame:
    """``stem``, the measures and ``problem``: each file has one row, a file that cannot be measured only its reason."""

    def work(signal: np.ndarray, rate: int) -> list[tuple]:
        try:
            return [(*measures(signal, rate, silence_db), None)]
        except ValueError as e:
            return [(*(None for _ in MEASURES.split(", ")), str(e))]

    found = per_file(files, f"{MEASURES}, unmeasured string", work)
    return found.withColumn("problem", F.coalesce("problem", "unmeasured")).drop("unmeasured")


def decide(measured: DataFrame, target: float, most_gain: float = 12.0, margin: float = 1.0, least_active: float = 0.3, most_dynamic: float = 35.0) -> DataFrame:
    """``needed_gain_db, reasons, pruned`` beside the measures; a file with a problem is pruned for it."""
    needed, room = F.lit(target) - F.col("lufs"), F.col("headroom_db") - margin
    reasons = F.array(
        F.when(F.col("problem").isNotNull(), F.col("problem")),
        F.when(needed > most_gain, F.format_string(f"too quiet; needs +%.1f dB to reach {target:.1f} LUFS", needed)),
        F.when(needed > room, F.format_string("would clip before target; needs +%.1f dB but has %.1f dB safe headroom", needed, room)),
        F.when(F.col("active_ratio") < least_active, F.format_string("only %.1f%% active audio", F.col("active_ratio") * 100)),
        F.when(F.col("dynamic_range_db") > most_dynamic, F.format_string(f"dynamic range %.1f dB > {most_dynamic:.1f} dB", "dynamic_range_db")),
    )
    return measured.withColumn("needed_gain_db", needed).withColumn("reasons", F.array_compact(reasons)).withColumn("pruned", F.size("reasons") > 0)


def limited(signal: np.ndarray, gain_db: float, margin: float = 1.0) -> tuple[np.ndarray, float, bool]:
    """(signal with the gain, the gain that was given in dB, was it held back): the peak stays ``margin`` dB under full scale."""
    out, most = signal.astype(np.float64) * 10 ** (gain_db / 20), 10 ** (-margin / 20)
    peak = float(np.max(np.abs(out))) if len(out) else 0.0
    if peak <= most:
        return out.astype(np.float32), gain_db, False
    return (out * (most / peak)).astype(np.float32), gain_db + 20 * float(np.log10(most / peak)), True


def normalise_files(files: DataFrame | Made, decided: DataFrame, margin: float = 1.0) -> DataFrame:
    """``stem, content`` (16-bit WAV), ``requested_gain_db, applied_gain_db, peak_limited`` of each file that is not pruned; one that cannot be read ends the job."""
    kept = decided.where(~F.col("pruned")).select("stem", F.array("needed_gain_db").alias("own"))

    def work(signal: np.ndarray, rate: int, own: list[float]) -> list[tuple]:
        out, applied, held = limited(signal, own[0], margin)
        return [(encode_wav(out, rate), own[0], applied, held)]

    found = per_file(files, "content binary, requested_gain_db double, applied_gain_db double, peak_limited boolean", work, beside=kept)
    whole = F.when(F.col("problem").isNotNull(), F.raise_error("problem")).otherwise(F.col("stem"))
    return found.select(whole.alias("stem"), "content", "requested_gain_db", "applied_gain_db", "peak_limited")


def analysis_report(decided: DataFrame, target: float) -> DataFrame:
    """One row for each file with rounded measures and the reasons in one text, for :func:`loomwright.sources.manifests.write_tsv`."""
    shown = [F.round(c, 6).alias(c) for c in ("seconds", "lufs", "peak_dbfs", "headroom_db", "active_ratio", "dynamic_range_db", "needed_gain_db")]
    return decided.select("stem", "rate", *shown, F.lit(target).alias("target_lufs"), "pruned", F.array_join("reasons", "; ").alias("reasons"))


def marked_payload(records: DataFrame, payload: str, fields: dict[str, str]) -> DataFrame:
    """``payload`` (a JSON object as text, its own fields and their order kept) with more fields at its end, each from the named column.

    A payload that is no object stays as it is.
    """
    more = F.to_json(F.struct(*(F.col(c).alias(name) for name, c in fields.items())), {"ignoreNullFields": "false"})
    body = F.regexp_extract(payload, r"(?s)^\s*\{(.*)\}\s*$", 1)
    joined = F.concat(F.lit("{"), body, F.when(F.trim(body) == "", "").otherwise(", "), F.substring(more, F.lit(2), F.length(more) - 1))
    return records.withColumn(payload, F.when(F.regexp_like(payload, F.lit(r"(?s)^\s*\{.*\}\s*$")), joined).otherwise(F.col(payload)))


def pruned_records(records: DataFrame, decided: DataFrame, payload: str = "payload") -> DataFrame:
    """Records (stem, payload) of pruned files, marked with that and with the reasons."""
    some = records.join(decided.where("pruned").select("stem", F.col("pruned").alias("_p"), "reasons"), "stem")
    return marked_payload(some, payload, {"normalization_pruned": "_p", "normalization_reasons": "reasons"}).drop("_p", "reasons")


def normalised_manifest(measured: DataFrame, normalised: DataFrame, records: DataFrame) -> DataFrame:
    """One row for each file that was written, levels and seconds with three decimals as text: row, paths, seconds, rates, loudness, asked and given gain, and whether its peak held it back.

    ``records``: stem, jsonl_row, source_audio, output_audio.
    """
    three = lambda c: F.format_string("%.3f", c)
    rows = records.join(normalised.drop("content"), "stem").join(measured.select("stem", "seconds", "rate", "lufs"), "stem")
    return rows.select(
        "jsonl_row", "source_audio", "output_audio", three("seconds").alias("duration_sec"), F.col("rate").alias("source_sample_rate"), F.col("rate").alias("output_sample_rate"),
        three("lufs").alias("source_lufs"), three("requested_gain_db").alias("requested_gain_db"), three("applied_gain_db").alias("applied_gain_db"), "peak_limited",
    )


def moved_records(records: DataFrame, payload: str = "payload", audio: str = "output_audio", field: str = "audio") -> DataFrame:
    """Records whose payload (a JSON object as text) names the file that was written; its other fields and their order stay, and so does what is no object."""
    import pyarrow as pa

    names = records.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, path in zip(batch.column(payload).to_pylist(), batch.column(audio).to_pylist(), strict=True):
                try:
                    held = json.loads(text)
                except (TypeError, ValueError):
                    held = None
                out.append(json.dumps(held | {field: path}, ensure_ascii=False) if isinstance(held, dict) else text)
            yield batch.set_column(names.index(payload), payload, pa.array(out, pa.string()))

    return records.mapInArrow(run, records.schema)
