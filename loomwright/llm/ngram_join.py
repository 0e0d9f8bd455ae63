"""Jaccard self-join on word n-grams: MinHash bands find candidates, full n-gram sets verify them.

Bands and rows are chosen so that a pair at the threshold is found with the
target recall. Documents with the same n-gram set are one class from the
start, and only one of each class goes on. The shuffle is on band hashes; a
bucket is taken apart in square blocks of its members, and a pair belongs to
the first band in which the two meet, so it is verified once. Only members
with a pair of their own in a bucket fetch their texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwright.llm.bytesets import forget, give_back, mix, ragged, text_batches, word_hashes
from loomwright.llm.common import fresh, materialise, settled, text_rows, with_row_ids

_BLOCK = 256


def bands_for(threshold: float, recall: float, most_hashes: int = 128) -> tuple[int, int]:
    """(bands, rows): the most rows for which bands * rows <= most_hashes reaches the recall at the threshold."""
    best = (most_hashes, 1)
    for rows in range(1, most_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)) if threshold < 1 else 1
        if bands * rows <= most_hashes:
            best = (bands, rows)
    return best


def ngrams(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of each row one after another, and their offsets. Texts of 1 to n-1 words are one n-gram."""
    h, bounds = word_hashes(column)
    counts = np.diff(bounds)
    row = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(h)) - np.repeat(bounds[:-1], counts)
    size = np.minimum(counts, n)[row]
    starts = place + size <= counts[row]
    g = np.zeros(len(h), np.uint64)
    for k in range(n):
        take = np.minimum(np.arange(len(h)) + k, max(len(h) - 1, 0))
        g = np.where(k < size, mix(g * np.uint64(0x100000001B3) + h[take]), g)
    g, row = g[starts], row[starts]
    order = np.lexsort((g, row))
    g, row = g[order], row[order]
    new = np.append(True, (g[1:] != g[:-1]) | (row[1:] != row[:-1])) if len(g) else np.zeros(0, bool)
    g, row = g[new], row[new]
    return g, np.searchsorted(row, np.arange(len(counts) + 1))


def _salts(k: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(404)).integers(1, 2**63, (2, k), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def band_hashes(g: np.ndarray, bounds: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(documents, bands) hashes of the least n-grams under bands * rows hash functions; documents must not be empty."""
    salts = _salts(bands * rows)
    out = np.zeros((len(bounds) - 1, bands), np.uint64)
    starts = bounds[:-1]
    for b in range(bands):
        for r in range(rows):
            k = b * rows + r
            v = (g ^ salts[0, k]) * salts[1, k]
            v ^= v >> np.uint64(32)
            v *= np.uint64(0x9E3779B97F4A7C15)
            out[:, b] = mix(out[:, b] * np.uint64(31) + np.minimum.reduceat(v, starts))
    return out


def _sign(n: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for whole in batches:
            for batch in text_batches(whole, "text", 1 << 20):
                g, bounds = ngrams(batch.column("text"), n)
                some = np.flatnonzero(np.diff(bounds))
                size = np.diff(bounds)
                sums = [np.zeros(len(size), np.uint64), np.zeros(len(size), np.uint64)]
                hashes = np.zeros((len(size), bands), np.uint64)
                if len(some):
                    inner = np.append(bounds[some], bounds[-1])
                    for s, salt in zip(sums, (0x1357, 0x2468), strict=True):
                        s[some] = np.add.reduceat(mix(g + np.uint64(salt)), inner[:-1])
                    hashes[some] = band_hashes(g, inner, bands, rows)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(hashes.view(np.int64).ravel()), bands).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("doc_id"), pa.array(size), *(pa.array(s.view(np.int64)) for s in sums), lists], ["rid", "doc_id", "n", "set_a", "set_b", "bands"])

    return run


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str], at_once: int = 4096) -> Iterator[pa.Table]:
    """Whole groups of a stream sorted by ``keys``, some at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < at_once:
            continue
        cols = [batch.column(k).to_numpy() for k in keys]
        other = np.flatnonzero(np.any([c != c[-1] for c in cols], axis=0))
        if len(other):
            cut = int(other[-1]) + 1
            yield pa.Table.from_batches([*held[:-1], batch.slice(0, cut)])
            held = [batch.slice(cut)]
    if held and sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held)


def _starts(table: pa.Table, keys: list[str]) -> list[int]:
    cols = [table.column(k).to_numpy() for k in keys]
    new = np.any([c[1:] != c[:-1] for c in cols], axis=0)
    return [0, *(np.flatnonzero(new) + 1).tolist(), table.num_rows]


def _pairs(bands: np.ndarray, side: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a bucket's block that meet in no earlier band. side: 0 rows, 1 columns, 2 both (a block on the diagonal)."""
    if (side == 2).all():
        i, j = np.triu_indices(len(bands), 1)
    else:
        i, j = (x.ravel() for x in np.meshgrid(np.flatnonzero(side == 0), np.flatnonzero(side == 1), indexing="ij"))
    if band:
        free = np.ones(len(i), bool)
        for b in range(band):
            free &= bands[i, b] != bands[j, b]
        i, j = i[free], j[free]
    return i, j


_KEYS = ["band", "hash", "u", "v"]


def _bands_of(table: pa.Table, a: int, z: int) -> np.ndarray:
    lists = table.column("bands").slice(a, z - a).combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy().reshape(z - a, -1)


def _open_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members of blocks that have a pair there; other columns as they are."""
    for table in _groups(batches, _KEYS):
        table = table.combine_chunks()
        cuts = _starts(table, _KEYS)
        all_bands = _bands_of(table, 0, table.num_rows)
        side, band = table.column("side").to_numpy(), table.column("band").to_numpy()
        keep = np.zeros(table.num_rows, bool)
        for a, z in zip(cuts[:-1], cuts[1:], strict=True):
            if z - a == 2 and side[a] == 2:
                keep[a:z] = not (all_bands[a, : band[a]] == all_bands[a + 1, : band[a]]).any()
                continue
            i, j = _pairs(all_bands[a:z], side[a:z], int(band[a]))
            keep[a + i] = True
            keep[a + j] = True
        yield from table.filter(pa.array(keep)).to_batches()


def _verify(n: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, _KEYS, 512):
            table = table.combine_chunks()
            cuts = _starts(table, _KEYS)
            text = table.column("text").combine_chunks()
            text = text.chunk(0) if isinstance(text, pa.ChunkedArray) else text
            all_bands = _bands_of(table, 0, table.num_rows)
            side, band, rid, copies = (table.column(c).to_numpy() for c in ("side", "band", "rid", "copies"))
            links = np.zeros(table.num_rows, np.int64)
            edges: list[tuple[int, int]] = []
            for a, z in zip(cuts[:-1], cuts[1:], strict=True):
                i, j = _pairs(all_bands[a:z], side[a:z], int(band[a]))
                if not len(i):
                    continue
                g, bounds = ngrams(text.slice(a, z - a), n)
                size = np.diff(bounds)
                near = size[i] * 1.0 >= threshold * size[j] - 1e-9
                near &= size[j] * 1.0 >= threshold * size[i] - 1e-9
                i, j = i[near], j[near]
                if not len(i):
                    continue
                _, g = np.unique(g, return_inverse=True)
                both = np.zeros(len(i), np.int64)
                member = np.zeros(int(g.max()) + 1 if len(g) else 0, bool)
                order = np.argsort(i, kind="stable")
                rows, heads = np.unique(i[order], return_index=True)
                for row, k, e in zip(rows.tolist(), heads.tolist(), [*heads[1:].tolist(), len(i)], strict=True):  # one set against all its partners
                    own, pair = g[bounds[row] : bounds[row + 1]], order[k:e]
                    partner = j[pair]
                    member[own] = True
                    both[pair] = np.add.reduceat(member[ragged(g, bounds[partner], size[partner])], np.cumsum(size[partner]) - size[partner], dtype=np.int64)
                    member[own] = False
                match = both >= threshold * (size[i] + size[j] - both) - 1e-9
                i, j = i[match] + a, j[match] + a
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                edges += _forest(i, j, rid)
            some = np.flatnonzero(links)
            own = [rid[some], np.full(len(some), -1), links[some]]
            rows = [np.append(own[0], [e[0] for e in edges]), np.append(own[1], [e[1] for e in edges]), np.append(own[2], np.zeros(len(edges)))]
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in rows], ["rid", "other", "links"])
        give_back()

    return run


def _forest(i: np.ndarray, j: np.ndarray, rid: np.ndarray) -> list[tuple[int, int]]:
    """Enough of the links to connect what they connect."""
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    out = []
    for p, q in zip(rid[i].tolist(), rid[j].tolist(), strict=True):
        a, b = top(p), top(q)
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((p, q))
    return out


def components(edges: DataFrame) -> DataFrame:
    """(rid, root) for the ends of ``edges`` (rid, other): the least rid that is connected to it.

    Each round hangs every root with a lower neighbour below the lowest one
    and then takes two steps up, until nothing changes; rounds grow with the
    logarithm of the longest chain.
    """
    pairs = materialise(edges.select("rid", "other").unionByName(edges.select(F.col("other").alias("rid"), F.col("rid").alias("other"))).distinct())
    label = pairs.groupBy("rid").agg(F.least(F.col("rid"), F.min("other")).alias("root"))
    while True:
        label = materialise(label)
        up = label.select(F.col("rid").alias("root"), F.col("root").alias("above"))
        far = pairs.join(label.select(F.col("rid").alias("other"), F.col("root").alias("near")), "other").groupBy("rid").agg(F.min("near").alias("near"))
        hung = label.join(far, "rid").select("root", "near").groupBy("root").agg(F.min("near").alias("near"))  # what a root's members reach
        new = label.join(hung, "root").join(up, "root", "left").select("rid", F.least("root", "near", "above").alias("next"), F.col("root").alias("old"))
        new = materialise(new)
        if new.where("next < old").isEmpty():
            return label
        label = new.select("rid", F.col("next").alias("root"))


def jaccard_classes(docs: DataFrame, threshold: float = 0.8, n: int = 5, recall: float = 0.9999, block: int = _BLOCK) -> DataFrame:
    """One row per document: ``rid, doc_id, class_id, n_links``.

    Two documents are linked when the Jaccard index of their sets of word
    n-grams is ``threshold`` or more; words are runs without ASCII white
    space. ``n_links`` counts the other documents linked to this one, copies
    included; ``class_id`` is the least doc_id among those that links
    connect. Texts of fewer than n words are one n-gram of all their words;
    a text without words (or a null) has no links. Rows with a null id take
    part; a class of such rows alone has a null class_id. Repeated rows are
    copies. Other columns are not read.
    """
    return _rooted_classes(docs, threshold, n, recall, block).drop("root")


def _rooted_classes(docs: DataFrame, threshold: float, n: int, recall: float, block: int = _BLOCK) -> DataFrame:
    """``jaccard_classes`` with ``root``: the least rid of a class, which no other class has, whatever ids its rows have."""
    bands, rows = bands_for(threshold, recall)
    docs = text_rows(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    signed = materialise(docs.mapInArrow(_sign(n, bands, rows), f"rid long, doc_id {kind}, n long, set_a long, set_b long, bands array<long>"))
    worded = signed.where("n > 0")
    classes = worded.groupBy("n", "set_a", "set_b").agg(F.min("rid").alias("rep"), F.count("*").alias("copies"), F.min("doc_id").alias("least"))
    classes = materialise(classes)  # no aggregate beside the join, so that a set of many copies can be split
    member = materialise(worded.select("rid", "doc_id", "n", "set_a", "set_b").join(classes, ["n", "set_a", "set_b"]).select("rid", "doc_id", "rep", "copies", "least"))
    reps = materialise(signed.join(member.where("rid = rep").select("rid", "copies"), "rid").select("rid", "copies", "bands"))

    cells = reps.select("rid", F.posexplode("bands").alias("band", "hash"))
    full = cells.groupBy("band", "hash").agg(F.count("*").alias("m")).where("m > 1")
    full = materialise(full)
    # only cells that meet another are joined with the bands of their documents
    met = materialise(cells.join(full, ["band", "hash"]).join(reps, "rid").select("rid", "copies", "bands", "band", "hash", "m"))
    # buckets of more than one block are dealt in square blocks; the block of a member is a hash of its rid, so no bucket is ever sorted
    small = met.where(F.col("m") <= block).select("*", F.lit(0).alias("u"), F.lit(0).alias("v"), F.lit(2).alias("side"))
    count = F.ceil(F.col("m") / block).cast("int")
    large = met.where(F.col("m") > block).withColumn("part", F.pmod(F.xxhash64("rid"), count).cast("int"))
    squares = F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda k: F.struct(F.least(F.col("part"), k).alias("u"), F.greatest(F.col("part"), k).alias("v"), F.when(k == F.col("part"), 2).when(F.col("part") < k, 0).otherwise(1).alias("side")),
    )
    large = large.withColumn("square", F.explode(squares)).select(*met.columns, "square.u", "square.v", "square.side")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = small.unionByName(large).drop("m").repartition(parts, *_KEYS).sortWithinPartitions(*_KEYS, "rid")
    open_ = materialise(dealt.mapInArrow(_open_members, dealt.schema))
    with_text = open_.join(docs.select("rid", "text"), "rid").repartition(parts, *_KEYS).sortWithinPartitions(*_KEYS, "rid")
    found = materialise(with_text.mapInArrow(_verify(n, threshold), "rid long, other long, links long"))

    links = found.where("other < 0").groupBy(F.col("rid").alias("rep")).agg(F.sum("links").alias("links"))
    joined = components(found.where("other >= 0").select("rid", "other")).select(F.col("rid").alias("rep"), "root")
    ends = member.where("rid = rep").join(joined, "rep").groupBy("root").agg(F.min("least").alias("class_id"))
    linked = joined.join(ends, "root").join(links, "rep", "left").select("rep", "root", "class_id", "links")
    some = member.join(linked, "rep", "left").select(
        "rid", F.coalesce("root", "rep").alias("root"), F.coalesce("class_id", "least").alias("class_id"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    return signed.select("rid", "doc_id", "n").join(some, "rid", "left").select(
        "rid", "doc_id", F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("root", "rid").alias("root"),
    )


def keep_one_of_each(docs: DataFrame, threshold: float = 0.8, n: int = 5, recall: float = 0.9999) -> DataFrame:
    """The rows of ``docs`` with one document of each class: the one with the least doc_id (of equal ids, the first read)."""
    docs = settled(docs)
    rid = fresh(docs, "rid")
    found = materialise(_rooted_classes(docs, threshold, n, recall))
    lone = found.where("n_links = 0").select("rid")
    first = found.where("n_links > 0").groupBy("root").agg(F.min(F.struct("doc_id", "rid")).alias("one")).select("one.rid")
    return with_row_ids(docs, rid).join(lone.unionByName(first).withColumnRenamed("rid", rid).hint("merge"), rid, "left_semi").drop(rid)
