"""Chains of pointers over rows of a key: what is reached from its first row, without one task a key."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomwright.functions.tables import sorted_sides, written

BLOCK = 4096


def sorted_groups(batches: Iterator[pa.RecordBatch], first: str) -> Iterator[pa.Table]:
    """Whole groups of sorted rows; ``first`` is true where one begins."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        at = np.flatnonzero(batch.column(first).to_numpy(zero_copy_only=False))
        if len(at):
            if held or at[0]:
                yield pa.Table.from_batches([*held, batch.slice(0, int(at[0]))])
            if len(at) > 1:
                yield pa.Table.from_batches([batch.slice(int(at[0]), int(at[-1] - at[0]))])
            held = [batch.slice(int(at[-1]))]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def followed(rows: DataFrame, key: str, here: str, next_: str, block: int = BLOCK) -> DataFrame:
    """The ``key, here`` that are reached from each key's least ``here``, from pointer to pointer.

    ``here`` is a whole number, once for each key, and ``next_`` a larger
    one; null, or one that no row has, ends the chain. Keys are cut into
    blocks of ``block`` numbers. Within a block each row learns in one pass
    where the chain that it is on leaves the block; between blocks chains are
    followed by pointer doubling, so that a key of B blocks takes log2(B)
    joins; a second pass marks what lies on the chain that enters a block.
    Keys may be null.
    """
    at = F.floor(F.col(here) / block).cast("long")
    by = Window.partitionBy("k", "block").orderBy("here")
    dealt = rows.select(F.col(key).alias("k"), F.col(here).cast("long").alias("here"), F.col(next_).cast("long").alias("next"), at.alias("block"))
    dealt = dealt.withColumn("first", F.row_number().over(by) == 1)

    def leave(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, "first"):
            whole = table.combine_chunks()
            place, to = whole["here"].to_numpy(), whole["next"].to_numpy(zero_copy_only=False)
            begins = np.flatnonzero(whole["first"].to_numpy())
            target = np.where(np.isnan(to), -1, to).astype(np.int64) if to.dtype.kind == "f" else to.astype(np.int64)
            out = np.full(len(place), -1, np.int64)
            for a, z in zip(begins.tolist(), [*begins[1:].tolist(), len(place)], strict=True):
                end = (place[a] // block + 1) * block
                inner = np.searchsorted(place[a:z], target[a:z])
                inside = (target[a:z] >= 0) & (target[a:z] < end)
                known = inside & (place[a:z][np.minimum(inner, z - a - 1)] == target[a:z])
                exits = np.where(inside, -1, target[a:z]).tolist()
                for i, (j, held) in reversed(list(enumerate(zip(inner.tolist(), known.tolist(), strict=True)))):
                    if held:
                        exits[i] = exits[j]
                out[a:z] = exits
            yield from whole.append_column("exit", pa.array(out, mask=out < 0)).to_batches()

    kind = rows.schema[key].dataType.simpleString()
    table = written(dealt.mapInArrow(leave, f"k {kind}, here long, next long, block long, first boolean, exit long"))
    entered = written(table.groupBy("k").agg(F.min("here").alias("here")))
    jumps = table.where("exit is not null").select(F.col("k").alias("jk"), F.col("here").alias("from"), F.col("exit").alias("to"))
    while True:
        on = F.col("k").eqNullSafe(F.col("jk")) & (F.col("here") == F.col("from"))
        more = written(entered.join(sorted_sides(jumps), on).select("k", F.col("to").alias("here")))
        if more.isEmpty():
            break
        entered = entered.union(more)
        again = jumps.select(F.col("jk").alias("k2"), F.col("from").alias("from2"), F.col("to").alias("to2"))
        jumps = written(jumps.join(sorted_sides(again), F.col("jk").eqNullSafe(F.col("k2")) & (F.col("to") == F.col("from2"))).select("jk", "from", F.col("to2").alias("to")))
    entry = entered.select(F.col("k").alias("ek"), F.floor(F.col("here") / block).cast("long").alias("eb"), F.col("here").alias("entry"))
    marked = table.drop("exit", "first").join(sorted_sides(entry), F.col("k").eqNullSafe(F.col("ek")) & (F.col("block") == F.col("eb"))).drop("ek", "eb")
    marked = marked.withColumn("first", F.row_number().over(by) == 1)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = -1
        for batch in batches:
            seen = np.zeros(batch.num_rows, bool)
            for i, (place, to, entry, first) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("here", "next", "entry", "first")), strict=True)):
                if first:
                    now = entry
                if place == now:
                    seen[i] = True
                    now = -1 if to is None else to
            yield batch.select(["k", "here"]).filter(pa.array(seen))

    return marked.mapInArrow(visit, f"k {kind}, here long").select(F.col("k").alias(key), F.col("here").alias(here))
