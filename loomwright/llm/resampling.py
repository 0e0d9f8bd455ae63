"""Quality selection by importance resampling over hashed n-grams.

Two bags of hashed words and word pairs are counted: one over the target
texts, one over all raw texts. The log ratio of the two generative models
weighs a document; Gumbel noise is added to the weight and the k largest
sums are taken, which samples k documents in proportion to their weights
without replacement.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwright.llm.bytesets import mix, text_batches, word_hashes
from loomwright.llm.common import ranked

BITS = 14
KEEP = 0.85


def _slots(column: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and word pairs of a column, and the row of each."""
    h, bounds = word_hashes(column)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    if not len(h):
        return np.zeros(0, np.int64), row
    inside = row[1:] == row[:-1]
    slots = np.concatenate([h, mix(h[:-1] * np.uint64(3) + h[1:])[inside]]) >> np.uint64(64 - bits)
    return slots.astype(np.int64), np.concatenate([row, row[1:][inside]])


def bag_ratios(docs: DataFrame, bits: int = BITS) -> np.ndarray:
    """log P_target - log P_raw of each bucket, over all rows of ``docs`` (columns text, target boolean)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
        for whole in batches:
            for batch in text_batches(whole, "text", 4 << 20):
                slots, row = _slots(batch.column("text"), bits)
                wanted = batch.column("target").to_numpy(zero_copy_only=False).astype(bool)
                raw += np.bincount(slots, minlength=1 << bits)
                target += np.bincount(slots[wanted[row]], minlength=1 << bits)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(target[some])], ["slot", "raw", "target"])

    raw, target = np.ones(1 << bits), np.ones(1 << bits)
    rows = docs.select("text", "target").mapInArrow(run, "slot long, raw long, target long").groupBy("slot").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    for r in rows.collect():  # one row for each bucket at most
        raw[r["slot"]] += r["raw"]
        target[r["slot"]] += r["target"]
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def log_ratios(docs: DataFrame, ratios: np.ndarray, bits: int = BITS, temper: float = 0.0) -> DataFrame:
    """``doc_id, log_ratio, noise`` of each whole text: the sum of its features' log ratios, divided by their number to the power ``temper``.

    With 0 (the default) it is the ratio of the two generative models, 0.5
    takes most of the influence of length away. Null and empty texts have 0.
    """
    sent = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_batches(whole, "text", 4 << 20):
                slots, row = _slots(batch.column("text"), bits)
                n = np.bincount(row, minlength=batch.num_rows)
                sums = np.bincount(row, sent.value[slots], batch.num_rows) / np.maximum(n, 1) ** temper
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sums), batch.column("noise")], ["doc_id", "log_ratio", "noise"])

    uniform = (F.xxhash64(F.lit("gumbel"), "doc_id", "text").bitwiseAND((1 << 52) - 1).cast("double") + 0.5) / float(1 << 52)
    noisy = docs.select("doc_id", "text", (-F.log(-F.log(uniform))).alias("noise"))
    return noisy.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, log_ratio double, noise double")


def resample(docs: DataFrame, labels: DataFrame, keep: float = KEEP, bits: int = BITS, temper: float = 0.0) -> DataFrame:
    """One row per document: ``doc_id, log_ratio, sort_key, kept``; the share ``keep`` of rows with the largest keys is kept.

    The target texts are those that ``labels`` (doc_id, quality) give
    quality 1. The noise is a hash of id and text, so repeated rows share
    it and a run can be repeated. Null ids are no targets but are weighed;
    an empty table gives no rows.
    """
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct().withColumn("target", F.lit(True))
    # labels grow with the corpus, so they are never broadcast, however few they are here
    counted = docs.select("doc_id", "text").join(good.hint("merge"), "doc_id", "left").select("text", F.coalesce("target", F.lit(False)).alias("target"))
    weighed = log_ratios(docs, bag_ratios(counted, bits), bits, temper).withColumn("sort_key", F.col("log_ratio") + F.col("noise"))
    order = ranked(weighed, [F.col("sort_key").desc(), F.col("doc_id")], "_rank")
    most = round(keep * docs.count())
    return order.select("doc_id", "log_ratio", "sort_key", (F.col("_rank") < most).alias("kept"))
