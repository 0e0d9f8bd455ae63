"""Exact deduplication by deterministic block naming, in DataFrame operations only.

1. Each text (UTF-8 bytes) is cut into blocks of a fixed size. The distinct
   blocks are sorted and numbered: the number is the block's integer name.
2. Adjacent names are paired, and the distinct pairs are sorted and numbered
   again, until one name is left for each document. Equal names at the end
   mean equal texts and nothing else, as a name stands for one content.

Blocks meet by a 64-bit routing hash, so their content is shuffled once, with
equal blocks summed before. A routing hash that two different blocks share is
found, and those blocks are named by content alone. Ends of texts are part of
the blocks (only a last block is short), so texts of different length differ
in their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwright.llm.common import fresh, materialise, settled, text_rows, with_row_ids

BLOCK_BYTES = 4096


def _route(x: Column, bits: int) -> Column:
    h = F.xxhash64(x)
    return h if bits >= 64 else F.pmod(h, F.lit(1 << bits))


def _blocks(text: Column, size: int) -> Column:
    raw = F.encode(text, "UTF-8")
    n = F.greatest(F.lit(1), F.ceil(F.octet_length(raw) / F.lit(size)).cast("int"))
    return F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.substring(raw, k * size + 1, F.lit(size)))


def name_blocks(docs: DataFrame, size: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """(route -> name) for the routing hashes of one block only, and (route, block -> name) for the rest."""
    cells = docs.select(F.explode(_blocks(F.col("text"), size)).alias("block"))
    distinct = cells.groupBy(_route(F.col("block"), bits).alias("route"), "block").agg(F.count("*").alias("n"))
    # Hash partitions hold whole sets of equal blocks; sorted within each, the row number is the name.
    named = distinct.sortWithinPartitions("route", "block").select("route", F.monotonically_increasing_id().alias("name"))
    named = materialise(named)
    # written, so that a join with it has no aggregate on either side and a route of many rows can be split
    shared = materialise(named.groupBy("route").agg(F.count("*").alias("n"), F.min("name").alias("name")))
    single = shared.where("n = 1").select("route", "name")
    routes = shared.where("n > 1").select("route")
    if routes.isEmpty():
        return single, None
    # Different blocks with one routing hash: only these are ordered by content; negative names keep them apart.
    again = cells.select(_route(F.col("block"), bits).alias("route"), "block").join(routes, "route", "left_semi").groupBy("route", "block").agg(F.count("*").alias("n"))
    again = again.sortWithinPartitions("route", "block").select("route", "block", (-1 - F.monotonically_increasing_id()).alias("name"))
    return single, materialise(again)


def identities(docs: DataFrame, size: int = BLOCK_BYTES, bits: int = 64) -> DataFrame:
    """``rid, doc_id, level, name`` and the sha256 for rows ``rid, doc_id, text``: (level, name) is equal for equal texts only."""
    single, rest = name_blocks(docs, size, bits)
    heads = docs.select("rid", "doc_id", F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"), F.transform(_blocks(F.col("text"), size), lambda x: _route(x, bits)).alias("routes"))
    heads = materialise(heads)
    cells = heads.select("rid", F.posexplode("routes").alias("pos", "route")).join(single, "route", "left" if rest is not None else "inner").select("rid", "pos", "name")
    if rest is not None:
        known = cells.where("name is not null")
        odd = docs.select("rid", F.posexplode(_blocks(F.col("text"), size)).alias("pos", "block")).withColumn("route", _route(F.col("block"), bits))
        cells = known.unionByName(odd.join(rest, ["route", "block"]).select("rid", "pos", "name"))
    level, done = 0, None
    lengths = heads.agg(F.max(F.size("routes"))).first()[0] or 0
    cells = cells.withColumn("level", F.lit(0))
    if lengths > 1:
        cells = materialise(cells.join(heads.select("rid", F.size("routes").alias("m")), "rid"))
        done = cells.where("m = 1").select("rid", "level", "name")
        cells = cells.where("m > 1")
        while lengths > 1:
            level += 1
            pairs = cells.groupBy("rid", F.shiftright("pos", 1).alias("pos")).agg(
                F.max(F.when(F.col("pos").bitwiseAND(1) == 0, F.col("name"))).alias("a"), F.max(F.when(F.col("pos").bitwiseAND(1) == 1, F.col("name"))).alias("b"), F.first("m").alias("m")
            )
            pairs = materialise(pairs)
            names = pairs.groupBy("a", "b").agg(F.count("*").alias("n")).sortWithinPartitions("a", "b").select("a", "b", F.monotonically_increasing_id().alias("name"))
            names = materialise(names)
            lengths = (lengths + 1) // 2
            cells = pairs.join(names, pairs["a"].eqNullSafe(names["a"]) & pairs["b"].eqNullSafe(names["b"])).select("rid", "pos", names["name"], F.ceil(F.col("m") / 2).cast("int").alias("m"), F.lit(level).alias("level"))
            if lengths > 1:
                cells = materialise(cells)
            done = done.unionByName(cells.where("m = 1").select("rid", "level", "name"))
            cells = cells.where("m > 1")
    else:
        done = cells.select("rid", "level", "name")
    return heads.select("rid", "doc_id", "text_sha256").join(done, "rid")


def mark_duplicates(docs: DataFrame, size: int = BLOCK_BYTES, bits: int = 64) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256`` and the row id ``rid``.

    Texts are equal when identical; null counts as empty, so null and empty
    texts form one group. Of equal texts the row with the largest doc_id
    stays (null ids last; of rows with one doc_id and text, the last read).
    An empty table gives no rows; other columns are not read. ``bits`` of
    the routing hash are only lowered by tests, to make blocks share it.
    """
    rows = text_rows(docs)
    found = materialise(identities(rows, size, bits))
    groups = materialise(found.groupBy("level", "name").agg(F.max(F.struct("doc_id", "rid")).alias("keep"), F.count("*").alias("group_size")))
    return found.join(groups, ["level", "name"]).select(
        "rid", "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size", (F.col("rid") == F.col("keep.rid")).alias("kept"), "text_sha256"
    )


def drop_duplicates(docs: DataFrame, size: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that :func:`mark_duplicates` keeps, with all their columns."""
    docs = settled(docs)
    rid = fresh(docs, "rid")
    kept = mark_duplicates(docs, size).where("kept").select(F.col("rid").alias(rid)).hint("merge")  # as many ids as documents: never broadcast
    return with_row_ids(docs, rid).join(kept, rid, "left_semi").drop(rid)
