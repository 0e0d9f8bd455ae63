"""Toxicity scores by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are its words, word pairs and pairs with one word left
out, in lower case and without ASCII punctuation, hashed into 2**bits slots. Training keeps a rate of its own for each
coordinate and an L1 pull to zero, so only slots that carry evidence keep a
weight; those few are sent to the executors.

Neutral words outnumber telling ones in long texts, so the score adds the
weights of present features once each (a slot counts once a text).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwright.llm.bytesets import PLAIN, forget, give_back, mix, ragged, text_batches, word_hashes

BITS = 20
MAX_TRAINING_ROWS = 20_000
_PART = 256


def features(column: pa.Array, bits: int = BITS, table: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the distinct features of each row, one row after another, and their n+1 offsets.

    With a ``table`` of weights, only slots that have one.
    """
    h, bounds = word_hashes(column, PLAIN)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    found = []
    for k, salt in ((0, 0), (1, 0x51ED270B), (2, 0xB5297A4D)):
        if len(h) <= k:
            continue
        slot = h if not k else mix(h[:-k] * np.uint64(3) + h[k:] + np.uint64(salt))
        slot = slot >> np.uint64(64 - bits)
        use = row[k:] == row[: len(row) - k] if k else None
        if table is not None:
            weighty = table[slot.view(np.int64)] != 0
            use = weighty if use is None else use & weighty
        found.append(((row[k:].astype(np.uint64) << np.uint64(bits)) | slot) if use is None else (row[k:][use].astype(np.uint64) << np.uint64(bits)) | slot[use])
    key = np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)
    return (key & np.uint64((1 << bits) - 1)).astype(np.int64), np.searchsorted(key, np.arange(len(bounds)).astype(np.uint64) << np.uint64(bits))


def ftrl(slots: np.ndarray, starts: np.ndarray, sizes: np.ndarray, labels: np.ndarray, bits: int = BITS, alpha: float = 1.0, beta: float = 1.0, l1: float | None = None, l2: float = 1.0, passes: int = 4, group: int = 16, positive: float = 4.0) -> tuple[np.ndarray, float]:
    """Weights and bias after ``passes`` over the rows (slots[starts[k] : starts[k] + sizes[k]] of row k), ``group`` rows for each step; ``positive``: what a row of label 1 counts.

    ``l1`` is 24 unless given, less for under 3,000 rows: it follows the
    root of their number, as chance sums of gradients do.
    """
    l1 = max(6.0, 24.0 * min(1.0, (len(labels) / 3000) ** 0.5)) if l1 is None else l1
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    zb = nb = 0.0
    bias = 0.0
    order = np.random.Generator(np.random.PCG64(7))
    for _ in range(passes):
        deal = order.permutation(len(labels))
        for k in range(0, len(deal), group):
            rows = deal[k : k + group]
            size = sizes[rows]
            own = np.repeat(np.arange(len(rows)), size)
            f = ragged(slots, starts[rows], size)
            use, inverse = np.unique(f, return_inverse=True)
            zu, nu = z[use], n[use]
            w = np.where(np.abs(zu) <= l1, 0.0, -(zu - np.sign(zu) * l1) / ((beta + np.sqrt(nu)) / alpha + l2))
            p = 1 / (1 + np.exp(-np.clip(bias + np.bincount(own, w[inverse], len(rows)), -30, 30)))
            err = (p - labels[rows]) * np.where(labels[rows] > 0, positive, 1.0)
            g = np.bincount(inverse, err[own], len(use))
            g2 = np.bincount(inverse, err[own] ** 2, len(use))
            step = (np.sqrt(nu + g2) - np.sqrt(nu)) / alpha
            z[use] = zu + g - step * w
            n[use] = nu + g2
            gb, gb2 = err.sum(), (err**2).sum()
            zb += gb - (np.sqrt(nb + gb2) - np.sqrt(nb)) / alpha * bias
            nb += gb2
            bias = -zb / ((beta + np.sqrt(nb)) / alpha)
    w = np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))
    return w, float(bias)


def held_out(doc_id) -> F.Column:
    """One document in five is never learnt from (by the crc32 of its id as text)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, bits: int = BITS, most_rows: int = MAX_TRAINING_ROWS, label: str = "toxic") -> tuple[np.ndarray, np.ndarray, float]:
    """(slots, weights, bias) from at most ``most_rows`` labelled rows, picked by a hash of their id; held-out rows are left out.

    The pick is of labelled rows for training alone; scoring covers every
    row. Of rows that share an id one is learnt from, ids may be of any type. The fit runs in one task over that bounded sample. Without labelled
    rows there are no weights, and every score is 0.5.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id")).groupBy("doc_id").agg(F.max(label).cast("double").alias("y"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
    rows = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    # one row for each id, however often it is repeated: as many rows as picked labels at most
    rows = rows.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), F.col("text").alias("text"), F.col("y").alias("y"))).alias("one"))
    rows = rows.select(F.xxhash64("doc_id").alias("key"), "one.text", "one.y")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for whole in batches:
            for batch in text_batches(whole, size=2 << 20):
                slots, bounds = features(batch.column("text"), bits)
                # rows of a few slots each, so that no Arrow batch of the one learning task is large
                parts = np.maximum(1, -(-np.diff(bounds) // _PART))
                row = np.repeat(np.arange(len(parts)), parts)
                start = bounds[row] + (np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)) * _PART
                lists = pa.ListArray.from_arrays(pa.array(np.append(start, bounds[-1]).astype(np.int32)), pa.array(slots.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(row)), pa.array(start.astype(np.int32)), batch.column("y").take(pa.array(row)), lists], ["key", "at", "y", "slots"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # parts come sorted, so that the slots of a row stand together where they are first put; one array of them is held, and grown in place
        forget()
        slots, used, sizes, keys, labels_ = np.zeros(1 << 16, np.int32), 0, [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        for batch in batches:
            lists = batch.column("slots")
            part = lists.flatten().to_numpy()
            if used + len(part) > len(slots):
                slots.resize(used + len(part) + len(slots) // 4, refcheck=False)
            slots[used : used + len(part)] = part
            used += len(part)
            sizes.append(np.diff(lists.offsets.to_numpy()).astype(np.int64))
            keys.append(batch.column("key").to_numpy().copy())
            labels_.append(batch.column("y").to_numpy().copy())
            del batch, lists, part
        give_back()
        size, key, y = np.concatenate(sizes), np.concatenate(keys), np.concatenate(labels_)
        ids, first = np.unique(key, return_index=True)
        size = np.add.reduceat(size, first) if len(ids) else size
        w, bias = ftrl(slots[:used], np.cumsum(size) - size, size, y[first] if len(ids) else y, bits)
        del slots
        give_back()
        use = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(use, -1)), pa.array(np.append(w[use], bias))], ["slot", "weight"])

    # one task, for a sample of bounded size; rows in the same order whatever task they came from
    parts = rows.mapInArrow(extract, "key long, at int, y double, slots array<int>").repartition(1).sortWithinPartitions("key", "at")
    found = parts.mapInArrow(learn, "slot long, weight double").toPandas()
    bias = float(found.loc[found["slot"] < 0, "weight"].sum())
    found = found[found["slot"] >= 0]
    return found["slot"].to_numpy(np.int64), found["weight"].to_numpy(float), bias


def _scorer(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], bits: int):
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def values(texts: pa.Array) -> np.ndarray:
        slots, weights, bias = sent.value
        table = np.zeros(1 << bits)
        table[slots] = weights
        found, bounds = features(texts, bits, table)
        sums = np.append(0, np.cumsum(table[found]))
        return 1 / (1 + np.exp(-np.clip(bias + sums[bounds[1:]] - sums[bounds[:-1]], -30, 30)))

    return values


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], bits: int = BITS) -> DataFrame:
    """``doc_id, score`` for each row; null and empty texts get the bias alone."""
    values = _scorer(docs, model, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for whole in batches:
            for batch in text_batches(whole, size=2 << 20):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values(batch.column("text")))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def score_toxicity(docs: DataFrame, labels: DataFrame, bits: int = BITS, most_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    ``labels`` has doc_id and toxic (0 or 1); only these two of its columns
    are read, and only the text of ``docs`` enters a score. Repeated rows
    stay; a null id is never held out nor learnt from. An empty table gives
    no rows.
    """
    scored = score(docs, fit(docs, labels, bits, most_rows), bits)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, bits: int = BITS, most_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """The rows of ``docs`` with a score under 0.5, all columns kept.

    A model that learnt from no rows (every label is null, held out or of
    no document), or from so few that no slot has a weight, gives all texts
    one score and tells none apart: all rows are kept then.
    """
    model = fit(docs, labels, bits, most_rows)
    if not len(model[0]):
        return docs
    values = _scorer(docs, model, bits)
    plain = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))  # any names may stand in ``docs``
    text = f"c{docs.columns.index('text')}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for whole in batches:
            for batch in text_batches(whole, text, 2 << 20):
                yield batch.filter(pa.array(values(batch.column(text)) < 0.5))

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
