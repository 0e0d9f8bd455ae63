"""Ranked lexical search: the best documents for each item of a query set.

One pass over the documents writes posting lists of the items' terms, in
segments of a task's documents, with the number of terms of each document.
Document frequencies and lengths are grouped aggregates of these lists. A
second pass traverses each segment's lists in windows of ``WINDOW`` document
numbers: contributions of an item's terms are scatter-added into an array of
that many sums, a bitset marks the documents that occur, and what is marked is
harvested into the item's heap of the best so far. A document's score depends
on no other document, so segments and windows are independent of each other;
postings are never shuffled, only each task's heaps are.

The query set is read in blocks of a bounded number of terms; each block is
one search over all documents.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from loomwright.llm.bytesets import BLOCK, WHITE, UnitCache, Units, blocks, give_back, ragged, text_batches, text_bytes, word_starts
from loomwright.llm.common import materialise

TOP = 10
#: Documents of a window; its sums are 32 KB.
WINDOW = 4096
#: Text bytes of a segment.
SEGMENT = 8 << 20
#: Terms of the items searched at once.
BLOCK_TERMS = 1 << 20
#: Length correction in percent, and its weight (fixed values of the score).
FULL, SHARE = 100, 90
_SALTS = 64
#: A-Z in lower case, ASCII other than letters and digits as spaces, all beyond ASCII as it is.
TERM_BYTES = np.arange(256, dtype=np.uint8)
TERM_BYTES[[c for c in range(128) if not chr(c).isalnum()]] = 32
TERM_BYTES[65:91] += 32


def _term_units(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[Units, np.ndarray]]:
    """The terms of all rows, in blocks: (units, row of each piece)."""
    data, offsets = TERM_BYTES[data[offsets[0] : offsets[-1]]], offsets - offsets[0]
    for b, pieces, rows in blocks(data, offsets, lambda x: WHITE[x], BLOCK):
        yield Units(b, pieces, word_starts, True), rows


def terms_of(column: pa.Array) -> list[list[bytes]]:
    """The terms of each row with repeats, in order."""
    out: list[list[bytes]] = [[] for _ in range(len(column))]
    for u, rows in _term_units(*text_bytes(column)):
        found = u.take(np.arange(len(u.at)))
        for row, a, b in zip(rows.tolist(), u.bounds[:-1].tolist(), u.bounds[1:].tolist(), strict=True):
            out[row] += found[a:b]
    return out


class QueryTerms:
    """The distinct terms of a block of items, found by hash and compared by their bytes."""

    def __init__(self, terms: list[bytes]):
        self.cache = UnitCache(max(1, len(terms)), longest=1 << 40)
        raw = np.frombuffer(b" ".join(terms), np.uint8)
        self.extra: dict[bytes, int] = {}
        self.number = np.zeros(0, np.int64)  # of a unit's place in the cache
        if not terms:
            return
        u = Units(raw, np.zeros(1, np.int64), word_starts, True)
        h = u.hashes()
        flat, size = u.bytes_of(np.arange(len(terms)))
        self.cache.add(h, flat, size, np.zeros(0, np.int32), np.zeros(len(terms), np.int64))
        place = self.cache.find(h, flat, size)
        self.extra = {terms[k]: k for k in np.flatnonzero(place < 0).tolist()}  # its hash belongs to another term
        self.number = np.zeros(self.cache.n, np.int64)
        self.number[place[place >= 0]] = np.flatnonzero(place >= 0)

    def find(self, u: Units) -> tuple[np.ndarray, np.ndarray]:
        """(units that are terms of the block, the number of each one's term)."""
        h = u.hashes()
        at = np.flatnonzero(self.cache.with_hash(h) >= 0)
        raw, size = u.bytes_of(at)
        place = self.cache.find(h[at], raw, size)
        number = np.where(place >= 0, self.number[place], -1) if len(self.number) else place
        if self.extra:
            odd = np.flatnonzero(place < 0)
            number[odd] = [self.extra.get(x, -1) for x in u.take(at[odd])]
        return at[number >= 0], number[number >= 0]


def segments(docs: DataFrame, terms: list[bytes], id_column: str, text_column: str, size: int = SEGMENT) -> DataFrame:
    """Posting lists of ``terms``, a row for each segment of documents.

    ``doc_ids, lengths`` (terms of each document) by document number;
    ``terms`` that occur, ``ends`` of their lists in ``docs`` (document numbers,
    ascending) and ``times``. ``n_docs, n_terms``: documents with a term, and
    all terms.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(terms)
    fields = f"n_docs long, n_terms long, doc_ids array<{kind}>, lengths array<int>, terms array<int>, ends array<int>, docs array<int>, times array<int>"
    names = [x.split()[0] for x in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = QueryTerms(sent.value)
        for whole in batches:
            for batch in text_batches(whole, text_column, size):
                lengths = np.zeros(batch.num_rows, np.int64)
                found, where = [], []
                for u, rows in _term_units(*text_bytes(batch.column(text_column))):
                    np.add.at(lengths, rows, np.diff(u.bounds))
                    at, number = known.find(u)
                    found.append(number)
                    where.append(rows[np.searchsorted(u.bounds, at, "right") - 1])
                cells = np.concatenate(found) * batch.num_rows + np.concatenate(where) if found else np.zeros(0, np.int64)
                cells, times = np.unique(cells, return_counts=True)
                term, doc = np.divmod(cells, max(1, batch.num_rows))
                last = np.flatnonzero(np.append(term[1:] != term[:-1], True)) if len(term) else np.zeros(0, np.int64)
                lists = (lengths, term[last], last + 1, doc, times)
                one = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v.astype(np.int32))) for v in lists]
                ids = pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column(id_column))
                yield pa.RecordBatch.from_arrays([pa.array([int((lengths > 0).sum())]), pa.array([int(lengths.sum())]), ids, *one], names)
                give_back()

    return docs.select(id_column, text_column).mapInArrow(run, fields)


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def contributions(weight: int, times: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term adds to the score of documents that hold it ``times`` among ``lengths`` terms; whole numbers throughout."""
    n, m = lengths.astype(np.int64), n_docs * SHARE
    if len(n) and int(n.max()) * m >= 1 << 63:  # a product beyond 64 bits
        share = np.array([int(x) * m // n_terms for x in n], np.int64)
    else:
        share = n * m // n_terms
    return weight * (1_000_000_000 * times.astype(np.int64) // (1000 * times.astype(np.int64) + 8 * (FULL - SHARE + share)))


class Harvest:
    """Per item, the best documents so far: highest score, then lowest id (null ids last)."""

    def __init__(self, top: int):
        self.top, self.heaps = top, {}

    def add(self, item: int, scores: np.ndarray, docs: np.ndarray, ids: list) -> None:
        heap = self.heaps.setdefault(item, [])
        if len(heap) == self.top:
            keep = scores >= heap[0][0]
            scores, docs = scores[keep], docs[keep]
        if len(scores) > self.top:  # only ties of the last place and better can enter
            keep = scores >= np.partition(scores, len(scores) - self.top)[len(scores) - self.top]
            scores, docs = scores[keep], docs[keep]
        for score, doc in zip(scores.tolist(), docs.tolist(), strict=True):
            entry = (score, _Last(ids[doc]))
            if len(heap) < self.top:
                heapq.heappush(heap, entry)
            elif heap[0] < entry:
                heapq.heapreplace(heap, entry)


class _Last:
    """Orders ids downwards, so that the heap's least entry has the highest id of equal scores; null is the highest."""

    __slots__ = ("id",)

    def __init__(self, id):
        self.id = id

    def __lt__(self, other: _Last) -> bool:
        if self.id is None or other.id is None:
            return self.id is None and other.id is not None
        return self.id > other.id


def traverse(found: dict, items: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int, into: Harvest, window: int = WINDOW) -> None:
    """Scores a segment's documents for all items, window after window."""
    lengths, terms, docs, times = (np.asarray(found[c], np.int64) for c in ("lengths", "terms", "docs", "times"))
    ends = np.asarray(found["ends"], np.int64)
    starts = np.append(0, ends[:-1])
    if not len(terms):
        return
    added = contributions(1, times, lengths[docs], n_docs, n_terms)
    added *= np.repeat(weights[terms], ends - starts)
    # a term's list in each window: its documents are ascending
    edges = np.arange(0, len(lengths) + window, window)
    key = np.repeat(np.arange(len(terms)), ends - starts) * len(edges) + docs // window
    bounds = np.searchsorted(key, np.arange(len(terms) * len(edges) + 1))
    held = [np.intersect1d(x, terms, return_indices=True)[2] for x in items]  # places of an item's terms among the segment's
    sums, marks = np.zeros(window, np.int64), np.zeros(window // 8 + 1, np.uint8)
    for w, begin in enumerate(edges[:-1].tolist()):
        for item, mine in enumerate(held):
            cell = mine * len(edges) + w
            a, size = bounds[cell], bounds[cell + 1] - bounds[cell]
            if not size.any():
                continue
            at = ragged(docs, a, size) - begin
            np.add.at(sums, at, ragged(added, a, size))
            np.bitwise_or.at(marks, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
            some = np.flatnonzero(np.unpackbits(marks, bitorder="little")[:window])
            scores = sums[some]
            into.add(item, scores[scores > 0], some[scores > 0] + begin, found["doc_ids"])
            sums[some] = 0
            marks[:] = 0


def _block_of_items(rows: list[tuple]) -> tuple[list, list[int], list[bytes], list[np.ndarray]]:
    """(item ids, how often each row occurs, their distinct terms, places of each item's terms among them)."""
    rows.sort(key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, r[1] or ""))
    per = [sorted(set(x)) for x in terms_of(pa.array([r[1] for r in rows], pa.string()))]
    terms = sorted({t for x in per for t in x})
    place = {t: k for k, t in enumerate(terms)}
    return [r[0] for r in rows], [r[2] for r in rows], terms, [np.array([place[t] for t in x], np.int64) for x in per]


def search(
    docs: DataFrame, items: DataFrame, top: int = TOP, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text",
    block_terms: int = BLOCK_TERMS, size: int = SEGMENT, window: int = WINDOW,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` best documents of each item, equal scores by ascending id.

    Terms are runs of letters and digits of ASCII and of all characters
    beyond it, A-Z in lower case. Null texts have none; documents and items
    without terms, and empty tables, give no rows. Each row of ``items`` is
    an item, each row of ``docs`` a document, repeated ones too; documents
    with a null id rank behind equal ones. Other columns are not read.

    Items are searched in blocks of about ``block_terms`` terms (by a hash of
    the row), each sent to all tasks; an item is never split.
    """
    spark = docs.sparkSession
    kind, item_kind = docs.schema[id_column].dataType.simpleString(), items.schema[item_column].dataType.simpleString()
    asked = items.groupBy(F.col(item_column).alias("item_id"), F.col(item_text).cast("string").alias("text")).agg(F.count("*").alias("copies"))
    bound = asked.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0  # a term has a byte and a separator at least
    n_blocks = max(1, -(-bound // (2 * block_terms)))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))
    parts = []
    for k in range(n_blocks):
        ids, copies, terms, per = _block_of_items([tuple(r) for r in asked.where(block == k).collect()])  # of bounded size
        if terms:
            parts.append(_search_block(docs, list(zip(ids, copies, strict=True)), terms, per, k, top, id_column, text_column, size, window, kind, item_kind))
    if not parts:
        return spark.createDataFrame([], f"item_id {item_kind}, rank int, doc_id {kind}, score long")
    found = parts[0]
    for more in parts[1:]:
        found = found.union(more)

    def best(df: DataFrame, *keys: str) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    # heaps of some tasks first, so that no task holds those of all for an item
    few = best(found, "block", "item", "salt").drop("rank")
    ranked = best(few, "block", "item").withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    return ranked.select("item_id", "rank", "doc_id", "score")


def _search_block(docs, asked, terms, per, number, top, id_column, text_column, size, window, kind, item_kind) -> DataFrame:
    lists = materialise(segments(docs, terms, id_column, text_column, size))
    n_docs, n_terms = lists.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    begin = F.concat(F.array(F.lit(0)), F.slice("ends", 1, F.greatest(F.size("ends") - 1, F.lit(0))))
    each = lists.select(F.inline(F.arrays_zip(F.col("terms").alias("term"), F.zip_with("ends", begin, lambda b, a: b - a).alias("n")))).where("term is not null")
    weights = np.zeros(len(terms), np.int64)
    for r in each.groupBy("term").agg(F.sum("n").alias("df")).collect():  # a row for each term of the block
        weights[r["term"]] = term_weight(n_docs, r["df"])
    sent = docs.sparkSession.sparkContext.broadcast((per, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight = sent.value
        heaps = Harvest(top)
        for batch in batches:
            for k in range(batch.num_rows):
                found = {c: batch.column(c)[k].values.to_numpy(zero_copy_only=False) for c in ("lengths", "terms", "ends", "docs", "times")}
                traverse(found | {"doc_ids": _Ids(batch.column("doc_ids")[k].values)}, items, weight, n_docs, n_terms, heaps, window)
        rows = [(i, e[0], e[1].id) for i, heap in sorted(heaps.heaps.items()) for e in heap]
        salt = TaskContext.get().partitionId() % _SALTS
        item = pa.array([r[0] for r in rows], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                item, pa.array([asked[r[0]][0] for r in rows], item_type), pa.array([asked[r[0]][1] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2] for r in rows], doc_type), pa.array(np.full(len(rows), salt, np.int32)),
            ],
            ["item", "item_id", "copies", "score", "doc_id", "salt"],
        )

    doc_type, item_type = (to_arrow_type(DataType.fromDDL(x)) for x in (kind, item_kind))
    found = lists.select("doc_ids", "lengths", "terms", "ends", "docs", "times").mapInArrow(run, f"item int, item_id {item_kind}, copies long, score long, doc_id {kind}, salt int")
    return found.withColumn("block", F.lit(number))


class _Ids:
    """Ids by place, read one by one."""

    def __init__(self, values: pa.Array):
        self.values = values

    def __getitem__(self, k: int):
        return self.values[k].as_py()
