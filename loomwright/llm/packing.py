"""Bulk-synchronous best-fit packing of token pieces into sequences of bounded length.

Pieces are range-sorted by length, which gives each a rank. Lengths are at
most the capacity, so all pieces of one length, and all gaps of one size,
are alike: what the sweeps work on is a table of (length, count) and of runs
of equal gaps, bounded by the capacity whatever the corpus. In each step the
pieces of the largest length left meet their successors among the gaps, the
smallest gaps that hold them; the k-th piece takes the k-th gap, the gaps are
updated, and the step repeats until all are placed, new sequences opening
where no gap fits. The outcome is runs of ranks, in which each piece finds
its place on its own.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwright.llm.bytesets import forget, text_batches
from loomwright.llm.common import fresh, materialise, quoted, ranked
from loomwright.llm.token_counts import counter, loaded

CAPACITY = 4096
END_ID = 1


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, ids binary`` (little-endian unsigned 32-bit): the ids of each whole text, then ``end_id``, cut only where longer than ``capacity``.

    Null texts count as empty (the end id alone). Repeated rows stay, null
    ids are allowed, other columns are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget(loaded)
        tokens = counter(vocabulary)
        for whole in batches:
            for batch in text_batches(whole, "text", 4 << 20):
                ids, bounds = tokens.encode(batch.column("text"))
                ids = np.insert(ids, bounds[1:], end_id).astype("<u4")
                bounds = bounds + np.arange(len(bounds))
                size = np.diff(bounds)
                count = -(-size // capacity)
                row = np.repeat(np.arange(len(size)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * capacity
                length = np.minimum(size[row] - start, capacity)
                ends = np.append(0, np.cumsum(length)).astype(np.int32) * 4
                blob = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(ends), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), blob], ["doc_id", "piece", "start", "length", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids binary")


def best_fit(counts: dict[int, int], capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first rank, first sequence, offset) of runs: pieces by falling length, one to each sequence of its run.

    ``counts``: how many pieces there are of each length, at most
    ``capacity`` entries.
    """
    runs: list[tuple[int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # size -> runs of sequences with such a gap
    sizes: list[int] = []  # sizes that have runs, rising
    rank = opened = 0

    def put(size: int, first: int, n: int) -> None:
        if size > 0 and n > 0:
            if size not in gaps:
                gaps[size] = []
                bisect.insort(sizes, size)
            gaps[size].append((first, n))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect.bisect_left(sizes, length)
            if at < len(sizes):  # the successors of this length
                size = sizes[at]
                first, n = gaps[size].pop()
                if not gaps[size]:
                    del gaps[size], sizes[at]
            else:
                size, first, n = capacity, opened, -(-left // (capacity // length))
                opened += n
            each = size // length  # an updated gap is the nearest successor again, so each is filled up
            full = min(n, left // each)
            layers = [(full, each)]
            if full < n and left - full * each:  # the last one takes what is left
                layers.append((1, left - full * each))
            for m, deep in layers:
                for k in range(deep if m else 0):
                    runs.append((rank, first, capacity - size + k * length))
                    rank += m
                    left -= m
                put(size - deep * length, first, m)
                first, n = first + m, n - m
            put(size, first, n)
    found = np.array(runs, np.int64).reshape(-1, 3)
    return found[:, 0], found[:, 1], found[:, 2]


def pack(pieces: DataFrame, capacity: int = CAPACITY, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """``pieces`` (with ``length`` of 1 to ``capacity``) and, for each, ``sequence_id`` and ``offset``.

    Sequences are gapless from offset 0. Ties in ``order`` are broken by the
    range sort; extra columns are carried along, whatever their names. An
    empty table gives none.
    """
    pieces = materialise(pieces)
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    if counts and not 0 < min(counts) <= max(counts) <= capacity:
        raise ValueError(f"lengths must be from 1 to {capacity}")
    # the runs are bounded by the capacity: each step uses up a length or a run of gaps
    runs = pieces.sparkSession.sparkContext.broadcast(best_fit(counts, capacity))

    @F.pandas_udf("sequence_id long, offset long")
    def placed(rank: pd.Series) -> pd.DataFrame:
        begins, sequences, offsets = runs.value
        at = rank.to_numpy(np.int64)
        run = np.searchsorted(begins, at, "right") - 1
        return pd.DataFrame({"sequence_id": sequences[run] + at - begins[run], "offset": offsets[run]})

    rank = fresh(pieces, "_rank")
    place = fresh(pieces, "_place")
    sorted_ = ranked(pieces, [F.col("length").desc(), *(quoted(c) for c in order)], rank).withColumn(place, placed(rank))
    return sorted_.select(*(quoted(c) for c in pieces.columns), F.col(f"{place}.sequence_id"), F.col(f"{place}.offset"))


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """:func:`token_pieces` packed; with the ids of each piece, or with their ``ids_crc32`` alone."""
    pieces = token_pieces(docs, vocabulary, capacity, end_id)
    return pack(pieces if with_ids else pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), capacity)
